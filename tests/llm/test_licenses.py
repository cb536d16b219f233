"""License scan against brute force over all blocks."""
import re
from fractions import Fraction

from webfoot.llm import licenses, queries

SF = "/root/testdata/sf0.001"


def _words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def _plain(text):
    w = _words(text)
    places = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(w))
              if w[i:i + len(p.split())] == p.split()]
    labels, score = {l for _, l in places}, 0.0
    for label, body in licenses.TEMPLATES:
        t = _words(body)
        for lo in range(0, max(len(w), 1), len(t)):
            shared = len(set(t) & set(w[lo:lo + 2 * len(t)]))
            if Fraction(shared, len(set(t))) >= Fraction(4, 5):
                labels.add(label)
                score = max(score, shared / len(set(t)))
    starts = [i for i, _ in places]
    return (len(w), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({l for _, l in places})), ",".join(sorted(labels)), 1.0 if places else score)


def test_query_against_all_blocks(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op2_license_scan(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        assert tuple(r)[1:] == _plain(docs[r.doc_id]), r.doc_id


def test_edge_cases(spark):
    mit = "Permission is hereby granted, free of charge, to ANY person obtaining copies of this software and documentation files"
    texts = [None, "", "under the mit license", "UNDER THE MIT LICENSE!under-the.mit_license", "Licensed under CC-BY NC 4.0",
             "x " * 31 + mit, "license " * 5000, "gnu general public license work is this licensed", "Übér the mit license",
             "released\x00under the MIT licence", "licensed under the apache license version two", mit * 20,
             "under the mit", "K\u212a mit license"]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)] + [(3, texts[3], 1)], "doc_id long, text string, labels int")
    got = licenses.license_scan(df).select("doc_id", *[f.name for f in licenses.FIELDS[:-1]]).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        assert tuple(r)[1:] == _plain(texts[r.doc_id]), r.doc_id
    assert licenses.license_scan(df.limit(0)).count() == 0


def test_matches_name_their_block(spark):
    df = spark.createDataFrame([(1, "a b c " * 20 + "Licensed under the Apache License, Version 2.0.")], "doc_id long, text string")
    m = licenses.license_scan(df).first().matches
    assert m and all(x.label == "apache-2" and x.start < x.end and 0.8 <= x.containment <= 1 for x in m)

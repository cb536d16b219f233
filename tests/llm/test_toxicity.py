"""Toxicity: the automaton against edit distances, held-out accuracy, odd rows."""
import zlib

from webfoot.llm import queries, toxicity
from webfoot.llm.toxicity import Automaton, Entry, Model, Scorer

SF = "/root/testdata/sf0.1"


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_equals_edit_distance():
    import random
    rng = random.Random(1)
    entries = [Entry("stupid"), Entry("idiot"), Entry("disgusting"), Entry("scum"), Entry("loser", exact=True), Entry("vequ", stem=True)]
    automaton = Automaton(entries)
    words = ["vequa", "vequ", "veq", "losers", "loser", "scum", "scumm", ""]
    for e in entries:
        for _ in range(300):
            w = list(e.text)
            for _ in range(rng.randint(0, 3)):
                at = rng.randint(0, len(w))
                w[at:at + rng.randint(0, 1)] = rng.choice(["", "a", "s", "x"])
            words.append("".join(w))
    for w in words:
        near = [(_distance(w, e.text), i) for i, e in enumerate(entries) if not e.stem and _distance(w, e.text) <= e.budget]
        got = automaton.match(w)
        if w.startswith("vequ") and (not near or min(near)[0]):
            assert got == (5, 0), w
        else:
            assert (got and (got[1], got[0])) == min(near, default=None), w
    small = Automaton(entries, max_states=20)
    assert [small.match(w) for w in words] == [automaton.match(w) for w in words]


def test_context_windows():
    scorer = Scorer(Model([Entry("stupid"), Entry("worthless")]))
    weight = lambda t: sum(h[4] for h in scorer.hits(t.lower(), toxicity.words_of(t)))
    assert weight("the critic said the word \"stupid\" was used") < weight("a \"stupid\" thing") < weight("a stupid thing")
    assert weight("you are stupid") > weight("it is stupid") and weight("it is stpid") < weight("it is stupid")
    assert weight("er nannte es «stupid» gestern") < weight("stupid") and weight("clean text") == 0


def test_held_out_accuracy_and_stable_rows(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    got = queries.op3_toxicity(spark, SF).collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    right = {0: [0, 0], 1: [0, 0]}
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        if r.held_out and r.doc_id in labels:
            right[labels[r.doc_id]][int(r.predicted == labels[r.doc_id])] += 1
    assert right[0][1] / sum(right[0]) > 0.99 and right[1][1] / sum(right[1]) > 0.88


def test_labels_of_held_out_rows_are_not_read(spark):
    docs = [(i, ("awful " * 4 if i % 2 else "fine ") + f"word{i} other text here") for i in range(200)]
    labels = [(i, 1, i % 2) for i in range(200)]
    lie = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    a, b = (toxicity.learn(d, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, lie))
    assert a.entries == b.entries and a.curve == b.curve and a.entries


def test_a_clean_neighbour_leaves_misspellings_to_the_automaton(spark):
    docs = [(i, ("trash " * 3 if i % 2 else "crash ") + f"word{i} other text here") for i in range(200)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.learn(d, spark.createDataFrame([(i, 1, i % 2) for i in range(200)], "doc_id long, quality int, toxic int"))
    scorer = Scorer(model)
    hit = lambda w: [h[1:3] for h in scorer.hits(w, [w])]
    assert hit("trash") == [("trash", 0)] and hit("tr4sh") == hit("traash") == [("trash", 1)]
    assert hit("crash") == [] and model.known == {"crash"}


def test_edge_cases(spark):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    texts = [None, "", "plain", "x" * 100_000, "ok " * 50_000]
    d = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)] + [(None, "plain", None)],
                              "doc_id long, text string, SCORE string")
    model = toxicity.learn(d, empty)
    rows = toxicity.score(d, model).collect()
    assert len(rows) == 6 and {r.predicted for r in rows} == {0} and model.entries == []
    nulls = spark.createDataFrame([(1, 1, None), (None, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.learn(d, nulls).entries == []
    kept = toxicity.clean(d, Model([Entry("plain")], (-1.0, 50.0)))
    assert kept.columns == d.columns and kept.count() == 4
    assert toxicity.score(d.limit(0), model).count() == 0

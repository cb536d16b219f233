"""Range covers are exact and minimal; the join equals BETWEEN on numbers."""
import ipaddress
import random

from pyspark.sql import functions as F

from webfoot.operators import rangejoin


def test_covers_equal_the_stdlib_summary(spark):
    rng, rows = random.Random(3), [(0, 2**32 - 1), (0, 0), (2**32 - 1, 2**32 - 1), (5, 4), (1, 2**32 - 2), (2**31 - 1, 2**31), (8, 15), (7, 16)]
    for _ in range(150):
        a = rng.randrange(2**32)
        rows.append((a, min(2**32 - 1, a + rng.randrange(2 ** rng.randrange(1, 32)))))
    wide = [(0, 2**128 - 1), (1, 2**128 - 2), (2**64 - 3, 2**64 + 9)]
    bits = [(format(a, "032b"), format(b, "032b")) for a, b in rows] + [(format(a, "0128b"), format(b, "0128b")) for a, b in wide]
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(bits)], "i int, lo string, hi string")
    got = {r.i: r.c for r in df.select("i", rangejoin.range_cover(F.col("lo"), F.col("hi")).alias("c")).collect()}
    for i, (a, b) in enumerate(rows + wide):
        kind = ipaddress.IPv4Address if i < len(rows) else ipaddress.IPv6Address
        width = 32 if i < len(rows) else 128
        if a > b:
            assert got[i] is None
            continue
        want = [format(int(n.network_address), f"0{width}b")[:n.prefixlen] for n in ipaddress.summarize_address_range(kind(a), kind(b))]
        assert sorted(got[i]) == sorted(want), (a, b)


def test_join_equals_between(spark):
    rng = random.Random(5)
    name = lambda n, v=4: str(ipaddress.IPv4Address(n) if v == 4 else ipaddress.IPv6Address(n))
    base = int(ipaddress.IPv4Address("10.0.0.0"))
    ranges = [(base + rng.randrange(3000), rng.randrange(1, 2000)) for _ in range(60)]
    ranges = [(a, a + n) for a, n in ranges]
    points = [base + rng.randrange(5000) for _ in range(300)]
    six = int(ipaddress.IPv6Address("fd00::ff00"))
    df = spark.createDataFrame(
        [(name(a), name(b), f"r{i}") for i, (a, b) in enumerate(ranges)] + [(name(six, 6), name(six + 300, 6), "six"),
         ("10.0.0.9", "10.0.0.1", "back"), ("x", "10.0.0.1", "bad"), (None, "10.0.0.1", "null"), ("10.0.0.1", "fd00::1", "mixed")],
        "lo string, hi string, name string")
    pts = spark.createDataFrame([(name(p),) for p in points + points[:5]] + [(name(six + k, 6),) for k in (0, 300, 301)] + [("no",), (None,)], "ip string")
    got = sorted((r.ip, r.name) for r in rangejoin.in_ranges(pts, "ip", df).collect())
    want = {(name(p), f"r{i}") for p in points for i, (a, b) in enumerate(ranges) if a <= p <= b}
    assert got == sorted(want | {(name(six, 6), "six"), (name(six + 300, 6), "six")})
    assert rangejoin.in_ranges(pts, "ip", df.limit(0)).count() == 0 and rangejoin.in_ranges(pts.limit(0), "ip", df).count() == 0

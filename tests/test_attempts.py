"""O54 attempt resolution against literal outcomes."""
from collections import Counter

from webfoot.operators import attempts as A
from webfoot.sources import fixtures as FX

SF01 = "/root/testdata/sf0.01"


CASES = {  # target: (outcomes of the tries in order, then for 4 and for 2 tries at most:
    # status, tries, url, timeout of the last try, sum of the timeouts, last failed try)
    "https://a.com/": ([1], (200, 1, "https://a.com/", 15000, 15000, None), (200, 1, "https://a.com/", 15000, 15000, None)),
    "https://b.com/": ([0, 1], (200, 2, "https://www.b.com/", 30000, 45000, 0), (200, 2, "https://www.b.com/", 30000, 45000, 0)),
    "http://c.com/?u=https://d.com": (
        [0, 0, 0, 0, 1], (400, 4, "http://c.com/?u=https://www.www.www.www.d.com", 120000, 225000, 3),
        (400, 2, "http://c.com/?u=https://www.www.d.com", 30000, 45000, 1)),
    "https://e.com/?u=https://f.com": (
        [0, 0, 1], (200, 3, "https://www.e.com/?u=https://www.f.com", 60000, 105000, 1),
        (400, 2, "https://www.e.com/?u=https://www.f.com", 30000, 45000, 1)),
    "https://www.g.com/": ([0, 0], (400, 2, "https://www.g.com/", 30000, 45000, 1), (400, 2, "https://www.g.com/", 30000, 45000, 1)),
    "http://h.com/": ([0, 1], (200, 2, "http://h.com/", 30000, 45000, 0), (200, 2, "http://h.com/", 30000, 45000, 0)),
}


def test_expected_outcomes(spark):
    rows = [(t, i, i, bool(ok)) for t, (tries, *_) in CASES.items() for i, ok in enumerate(tries)]
    log = spark.createDataFrame(rows, "target string, attempt_id long, ts long, ok boolean")
    for column, most in ((1, 4), (2, 2)):
        got = {r.target: (r.status, r.tries, r.url, r.timeout_ms, r.total_timeout_ms, r.last_error_id)
               for r in A.resolve_attempts(log, max_tries=most).collect()}
        assert got == {t: case[column] for t, case in CASES.items()}


def test_fixture_facts(spark):
    got = A.resolve_attempts(FX.attempts(spark, SF01), max_tries=4).collect()
    assert Counter((r.status, r.tries) for r in got) == {(200, 1): 113, (200, 2): 30, (200, 3): 6, (200, 4): 1}


def test_window_limit_is_partial(spark):
    plan = A.resolve_attempts(FX.attempts(spark, SF01))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_hot_target_is_limited_before_the_shuffle(spark):
    """One target holding a third of all attempts: each task keeps at most max_tries rows of it."""
    from pyspark.sql import functions as F
    log = FX.attempts(spark, SF01)
    hot = log.withColumn("target", F.when(F.col("attempt_id") % 3 == 0, F.lit("https://hot.example.com/"))
                         .otherwise(F.col("target")))
    out = A.resolve_attempts(hot, max_tries=4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    head, _, tail = plan.partition("Exchange hashpartitioning(target")
    assert "WindowGroupLimit" in tail and "Partial" in tail     # below the exchange: map side
    rows = {r.target: r for r in out.collect()}
    assert rows["https://hot.example.com/"].tries <= 4

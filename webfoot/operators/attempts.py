"""Attempt resolution.

The reference tries a URL up to ``max_tries`` times; the first success gives
status 200, otherwise 400; after each failure the URL may gain ``www.`` (O27)
and the timeout is multiplied by ``timeout_index`` (O28).  Here the tries
are rows of an attempt log; per target the first ``max_tries`` rows in
``(ts, attempt_id)`` order count.

``row_number() <= max_tries`` is planned with a partial WindowGroupLimit
before the shuffle, so a target with a huge log sends at most ``max_tries``
rows per input partition.  After the limit each target has at most
``max_tries`` rows, so collecting them is bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls as U

# --- fixed values: defaults of the reference program ---
MAX_TRIES = 4
PAGE_TIMEOUT_MS = 15000
TIMEOUT_INDEX = 2
# --- end of fixed values ---


def try_timeout(k: Column, page_timeout: int, timeout_index: int) -> Column:
    """Timeout of 1-based try ``k``: ``page_timeout * timeout_index^(k-1)``."""
    return (F.lit(page_timeout) * F.pow(F.lit(timeout_index), k - 1)).cast("bigint")


def redirects(final_urls: DataFrame) -> DataFrame:
    """The final URL where it differs from the requested one, else null."""
    return final_urls.select(
        "url", F.when(F.col("url") != F.col("final_url"), F.col("final_url")).alias("redirect"))


def resolve_attempts(log: DataFrame, max_tries: int = MAX_TRIES,
                     page_timeout: int = PAGE_TIMEOUT_MS,
                     timeout_index: int = TIMEOUT_INDEX) -> DataFrame:
    """One outcome per target from ``log(target, attempt_id, ts, ok)``.

    Output: target, status, tries, url (as last attempted), timeout_ms of the
    last try, total_timeout_ms over the tries, last_error_id (the last failed
    try before the outcome, null if none).  A target with no rows gets no
    outcome (D17).
    """
    w = Window.partitionBy("target").orderBy("ts", "attempt_id")
    kept = (log.withColumn("try", F.row_number().over(w))
            .where(F.col("try") <= max_tries))
    per = kept.groupBy("target").agg(
        F.min(F.when(F.col("ok"), F.col("try"))).alias("ok_try"),
        F.count(F.lit(1)).alias("n"),
        F.array_sort(F.collect_list(F.struct("try", "ok", "attempt_id"))).alias("__wf_tries"),
    )
    tries = F.coalesce(F.col("ok_try"), F.col("n")).cast("int")
    status = F.when(F.col("ok_try").isNotNull(), F.lit(200)).otherwise(F.lit(400))
    failed_before = F.filter("__wf_tries", lambda t: ~t.ok & (t["try"] <= tries))
    last_err = F.element_at(F.transform(failed_before, lambda t: t.attempt_id), -1)
    ks = F.sequence(F.lit(1), tries)
    total = F.aggregate(F.transform(ks, lambda k: try_timeout(k, page_timeout, timeout_index)),
                        F.lit(0).cast("bigint"), lambda a, x: a + x)
    failures = F.when(status == 400, tries).otherwise(tries - 1)
    return per.select(
        "target",
        status.alias("status"),
        tries.alias("tries"),
        U.www_fallback_times("target", failures).alias("url"),
        try_timeout(tries, page_timeout, timeout_index).alias("timeout_ms"),
        total.alias("total_timeout_ms"),
        F.when(F.size(failed_before) > 0, last_err).alias("last_error_id"),
    )


def resolve_fetches(log: DataFrame, max_tries: int = MAX_TRIES) -> DataFrame:
    """O54 with what each try saw: one outcome per target of ``log(target, attempt_id, ts, ok, error, title, final_url)``.

    Output: target, status, tries, url (as last attempted), exception (of the
    last failed try), title and redirect (the last that any counted try saw,
    failed ones too: D15).  A try redirects where its final URL is not the URL
    it asked for, which each failure before it has rewritten (O27).
    """
    w = Window.partitionBy("target").orderBy("ts", "attempt_id")
    kept = log.withColumn("try", F.row_number().over(w)).where(F.col("try") <= max_tries)
    per = kept.groupBy("target").agg(
        F.min(F.when(F.col("ok"), F.col("try"))).alias("ok_try"), F.count(F.lit(1)).alias("n"),
        F.array_sort(F.collect_list(F.struct("try", "ok", "error", "title", "final_url"))).alias("__wf_tries"))
    per = per.withColumn("tries", F.coalesce("ok_try", "n").cast("int")).withColumn(
        "__wf_tries", F.slice("__wf_tries", F.lit(1), F.col("tries")))

    def last(values: Column) -> Column:
        return F.try_element_at(F.filter(values, lambda v: v.isNotNull()), F.lit(-1))

    good = F.col("ok_try").isNotNull()
    asked = lambda t: U.www_fallback_times("target", t["try"] - 1)
    return per.select(
        "target", F.when(good, F.lit(200)).otherwise(F.lit(400)).alias("status"), "tries",
        U.www_fallback_times("target", F.when(good, F.col("tries") - 1).otherwise(F.col("tries"))).alias("url"),
        last(F.transform("__wf_tries", lambda t: F.when(~t.ok, t.error))).alias("exception"),
        last(F.transform("__wf_tries", lambda t: t.title)).alias("title"),
        last(F.transform("__wf_tries", lambda t: F.when(t.final_url != asked(t), t.final_url))).alias("redirect"))

"""Plan checks: native expressions only, no nested-loop joins, pruned scans."""
import pytest

from webfoot.plans import queries

SF = "/root/testdata/sf0.001"
QUERIES = queries.queries()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_nested_loops(spark, name):
    plan = _plan(QUERIES[name](spark, SF))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "BroadcastNestedLoopJoin", "CartesianProduct"):
        assert bad not in plan, (name, bad)


def test_html_column_pruned_where_not_needed(spark):
    plan = _plan(QUERIES["key_digest"](spark, SF))
    assert "ReadSchema: struct<page_id:bigint,url:string>" in plan


def test_links_need_no_key_shuffle(spark):
    """Per-page link work is narrow: no exchange by key (a small input may be spread round-robin)."""
    for name in ("resolved_links", "outlink_bundle", "url_nums", "distinct_refs"):
        plan = _plan(QUERIES[name](spark, SF))
        assert "Exchange hashpartitioning" not in plan and "rangepartitioning" not in plan, name


def test_html_is_scanned_once(spark):
    """Exploding the links must not copy the HTML scan into an inferred filter."""
    for name in ("resolved_links", "distinct_refs", "seen_union", "first_referrer", "inlinks",
                 "unseen_targets", "links_to_hosts", "url_host"):
        plan = _plan(QUERIES[name](spark, SF))
        assert plan.count("(?:script|img)") == 1, name

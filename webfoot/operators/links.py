"""Per-page link work (O17-O24, O30a-c, O45).

Everything here is a narrow transformation of one page row: the HTML is
read once, tag by tag (``functions/markup.py``), references are de-duplicated inside the row
(``array_distinct``), resolved and bundled, so none of it shuffles.  The
``html`` column is dropped as soon as the links and the title are taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import markup
from ..functions import urls as U


def extract_refs(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Per page: ``title`` and ``refs`` = distinct ``struct(kind, raw)``.

    Distinctness is per page and kind, on the *raw* reference (D3); order is
    first appearance.  A page with no HTML gets an empty list (O30a).
    """
    refs = F.array_distinct(markup.tag_refs("html"))
    return pages.select(
        *keep, markup.title("html").alias("title"),
        F.coalesce(refs, F.array().cast("array<struct<kind:string,raw:string>>")).alias("refs"))


def with_resolved(refs_df: DataFrame, base: str = "url") -> DataFrame:
    """Add ``__wf_res`` = refs with their resolved ``target`` (null where unresolvable)."""
    staged = refs_df.withColumn("__wf_bp", U.url_parts(base))
    raws = F.transform("refs", lambda x: x.raw)
    targets = U.resolve_array(F.col(base), F.col("__wf_bp"), raws)
    return staged.withColumn(
        "__wf_res", F.arrays_zip(F.col("refs").alias("ref"), targets.alias("target"))
    ).drop("__wf_bp")


def kind_targets(resolved: Column, kind: str) -> Column:
    """Resolved, defragmented targets of one kind, sorted (D4); duplicates kept (D3)."""
    picked = F.filter(resolved, lambda x: (x.ref.kind == kind) & x.target.isNotNull())
    return F.array_sort(F.transform(picked, lambda x: x.target))


def bundle(refs_df: DataFrame, base: str = "url") -> DataFrame:
    """``next_url`` struct of the four lists and ``url_nums``."""
    res = with_resolved(refs_df, base)
    r = F.col("__wf_res")
    return res.withColumn(
        "next_url", F.struct(*[kind_targets(r, k).alias(k) for k in H.LINK_KINDS]),
    ).withColumn("url_nums", F.size(F.filter("refs", lambda x: x.kind == "a"))).drop("__wf_res")


def explode_rows(df: DataFrame, keep, arr, names: tuple[str, ...], with_pos: bool = False) -> DataFrame:
    """Explode an expensive computed array without evaluating it twice.

    Plain ``explode`` makes Catalyst infer ``size(arr) > 0`` and push that
    filter below the projections, where it inlines (and so recomputes) the
    whole expression that built ``arr``, e.g. the HTML scan.  The ``_outer``
    form infers nothing; its null rows for empty arrays are dropped right
    after the generator, where no filter can move below it.
    """
    if with_pos:
        g = F.posexplode_outer(arr).alias("pos", *names)
    else:
        g = F.explode_outer(arr).alias(*names)
    return df.select(*keep, g).where(F.col(names[0]).isNotNull())


def ref_rows(refs_df: DataFrame, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """One row per distinct (page, kind, raw) with its position in the page."""
    return explode_rows(refs_df, keep, F.col("refs"), ("ref",), with_pos=True).select(
        *keep, "pos", F.col("ref.kind").alias("kind"), F.col("ref.raw").alias("raw"))


def resolved_rows(refs_df: DataFrame, keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """O21/O22 over the exploded refs: ``target`` per (page, kind, raw)."""
    return U.resolve_refs(ref_rows(refs_df, keep), "url", "raw", "target")


def page_edges(refs_df: DataFrame, kinds: tuple[str, ...] = ("a",),
               schemes: tuple[str, ...] | None = None) -> DataFrame:
    """Edges ``(src, dst)`` from a page to each distinct resolved target.

    Only ``a`` links are followed by default (O30c).  Distinct inside the row.
    ``schemes`` (e.g. ``("http", "https")``) keeps only targets with one of
    those schemes; off by default, as the reference follows every reference
    (``mailto:``, ``javascript:`` ...) (D11).
    """
    res = with_resolved(refs_df, "url")
    r = F.col("__wf_res")
    targets = F.array_distinct(F.flatten(F.array(*[kind_targets(r, k) for k in kinds])))
    if schemes:
        allowed = [s.lower() for s in schemes]
        targets = F.filter(targets, lambda t: F.lower(F.regexp_extract(t, U.URL_PARTS, 1)).isin(allowed))
    return explode_rows(res, [F.col("url").alias("src")], targets, ("dst",))

"""URL column expressions.

All of them are native Catalyst expressions: no Python runs per row.

Reference resolution (O21) follows the rules of Python's ``urljoin`` followed
by ``urldefrag``, which is what the captured pages were resolved with; the
projections so that each parsed part is computed once per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values (must equal Python's urllib.parse for identical results) ---
# Schemes that resolve relative references.
USES_RELATIVE = ["", "ftp", "http", "gopher", "nntp", "imap", "wais", "file",
                 "https", "shttp", "mms", "prospero", "rtsp", "rtsps", "rtspu",
                 "sftp", "svn", "svn+ssh", "ws", "wss"]
# Schemes written with a '//' authority.
USES_NETLOC = ["", "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais",
               "file", "mms", "https", "shttp", "snews", "prospero", "rtsp",
               "rtsps", "rtspu", "rsync", "svn", "svn+ssh", "sftp", "nfs", "git",
               "git+ssh", "ws", "wss", "itms-services"]
# --- end of fixed values ---

# scheme, authority, path, query, fragment (fragment split first, then query).
URL_PARTS = r"^(?s)(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
HOST_PATTERN = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
DOT_SEGMENT = r"(^|/)\.\.?(/|$)"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_url(c) -> Column:
    """Left-strip C0 controls and spaces, drop tab/CR/LF anywhere."""
    return F.regexp_replace(F.regexp_replace(_c(c), r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")


def url_host(c) -> Column:
    """The netloc, port/userinfo/case kept, '' when there is no '//'."""
    return F.regexp_extract(clean_url(c), HOST_PATTERN, 1)


def key_digest(c) -> Column:
    """Hex md5 of the UTF-8 key."""
    return F.md5(_c(c).cast("string"))


def https_prefix(c) -> Column:
    """O9 (positional seeds)."""
    return F.concat(F.lit("https://"), _c(c))


def http_prefix(c) -> Column:
    """O9 (header seeds)."""
    return F.concat(F.lit("http://"), _c(c))


def fix_scheme(c) -> Column:
    """Add http:// only when there is no '://'."""
    c = _c(c)
    return F.when(~c.contains("://"), F.concat(F.lit("http://"), c)).otherwise(c)


def www_fallback(c) -> Column:
    """Unless it starts https://www., replace every https:// by https://www."""
    c = _c(c)
    return F.when(~c.startswith("https://www."),
                  F.replace(c, F.lit("https://"), F.lit("https://www."))).otherwise(c)


def www_fallback_times(c, times: Column) -> Column:
    """O27 applied once for each of ``times`` failures."""
    return F.when(times > 0, F.aggregate(F.sequence(F.lit(1), F.greatest(times, F.lit(1))), _c(c),
                                         lambda url, _: www_fallback(url))).otherwise(_c(c))


def defrag(c) -> Column:
    """Drop the fragment."""
    return F.regexp_replace(_c(c), r"(?s)#.*$", "")


def artifact_path(out_dir: str | None, url, ext: str) -> Column:
    """``dir/netloc_md5(url).ext``, null when no directory is given."""
    if not out_dir:
        return F.lit(None).cast("string")
    u = _c(url)
    return F.concat(F.lit(out_dir.rstrip("/") + "/"), url_host(u), F.lit("_"),
                    F.md5(u), F.lit("." + ext))


def _parts(u: Column) -> Column:
    return F.struct(
        F.lower(F.regexp_extract(u, URL_PARTS, 1)).alias("scheme"),
        F.regexp_extract(u, URL_PARTS, 2).alias("netloc"),
        F.regexp_extract(u, URL_PARTS, 3).alias("path"),
        F.regexp_extract(u, URL_PARTS, 4).alias("query"),
        (F.instr(u, "#") > 0).alias("has_frag"),
    )


def _unsplit(scheme: Column, netloc: Column, path: Column, query: Column) -> Column:
    """Python's urlunsplit without the fragment."""
    with_auth = (
        F.when(netloc != "",
               F.concat(F.lit("//"), netloc,
                        F.when((path != "") & ~path.startswith("/"), F.lit("/")).otherwise(F.lit("")),
                        path))
        .when(path.startswith("//"), F.concat(F.lit("//"), path))
        .when((scheme != "") & scheme.isin(USES_NETLOC) & ((path == "") | path.startswith("/")),
              F.concat(F.lit("//"), path))
        .otherwise(path)
    )
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit("")),
        with_auth,
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")),
    )


def _bad_netloc(n: Column) -> Column:
    return (F.instr(n, "[") > 0) != (F.instr(n, "]") > 0)


def _fold_dots(path: Column) -> Column:
    """Remove '.' and '..' segments; '..' at the floor is dropped."""
    segs = F.split(path, "/")
    folded = F.aggregate(
        segs, F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1))
                              .otherwise(acc))
        .when(s == ".", acc)
        .otherwise(F.concat(acc, F.array(s))))
    last = F.element_at(segs, -1)
    folded = F.when(last.isin(".", ".."), F.concat(folded, F.array(F.lit("")))).otherwise(folded)
    return F.array_join(folded, "/")


def _merged(pb: Column, pr: Column) -> Column:
    """Merge step: ref path alone if it starts '/', else base dir + ref, inner '//' folded."""
    base_dir = F.when(pb.path == "", F.lit("/")).otherwise(F.regexp_extract(pb.path, r"^(?s)(.*/)", 1))
    return F.when(pr.path.startswith("/"), pr.path).otherwise(
        F.regexp_replace(F.concat(base_dir, pr.path), "/{2,}", "/"))


def _normalized(m: Column) -> Column:
    """Dot segments removed; an empty result is '/'."""
    folded = F.when(m.rlike(DOT_SEGMENT), _fold_dots(m)).otherwise(m)
    return F.when(folded == "", F.lit("/")).otherwise(folded)


def _final(b: Column, r: Column, pb: Column, pr: Column, norm: Column) -> Column:
    """urljoin + urldefrag from the raw strings, their parsed parts and the merged path."""
    rs = F.when(pr.scheme == "", pb.scheme).otherwise(pr.scheme)
    as_given_ref = F.when(pr.has_frag, _unsplit(pr.scheme, pr.netloc, pr.path, pr.query)).otherwise(r)
    as_given_base = F.when(pb.has_frag, _unsplit(pb.scheme, pb.netloc, pb.path, pb.query)).otherwise(b)
    return (
        F.when(b.isNull() | r.isNull(), F.lit(None).cast("string"))
        .when(b == "", as_given_ref)
        .when(r == "", as_given_base)
        .when(_bad_netloc(pb.netloc) | _bad_netloc(pr.netloc), F.lit(None).cast("string"))
        .when((rs != pb.scheme) | ~rs.isin(USES_RELATIVE), as_given_ref)
        .when(pr.netloc != "", _unsplit(rs, pr.netloc, pr.path, pr.query))
        .when(pr.path == "", _unsplit(rs, pb.netloc, pb.path,
                                      F.when(pr.query != "", pr.query).otherwise(pb.query)))
        .otherwise(_unsplit(rs, pb.netloc, norm, pr.query))
    )


def url_parts(c) -> Column:
    """Parsed parts of a URL, to be staged in its own column (see :func:`resolve_array`)."""
    return _parts(clean_url(_c(c)))


def resolve_array(base, base_parts, refs) -> Column:
    """O21 + O22 for every element of an array of refs against one base.

    ``base_parts`` must be a column reference holding :func:`url_parts` of the
    base.  The steps are nested ``transform`` calls so that each parsed part
    is computed once per element and the expression stays small.
    """
    b, pb = _c(base), _c(base_parts)
    a1 = F.transform(_c(refs), lambda r: F.struct(r.alias("raw"), _parts(clean_url(r)).alias("p")))
    a2 = F.transform(a1, lambda x: F.struct(x.raw.alias("raw"), x.p.alias("p"),
                                           _merged(pb, x.p).alias("m")))
    a3 = F.transform(a2, lambda x: F.struct(x.raw.alias("raw"), x.p.alias("p"),
                                           _normalized(x.m).alias("n")))
    return F.transform(a3, lambda x: _final(b, x.raw, pb, x.p, x.n))


def resolve_refs(df: DataFrame, base: str, ref: str, out: str) -> DataFrame:
    """O21 + O22: add column ``out`` = defragmented ``urljoin(base, ref)``.

    Null where Python raises (unbalanced '[' ']' in an authority).  Each step
    is its own projection, so each parsed part is computed once per row.
    """
    staged = df.withColumn("__wf_b", url_parts(base)).withColumn("__wf_r", url_parts(ref))
    staged = staged.withColumn("__wf_m", _merged(F.col("__wf_b"), F.col("__wf_r")))
    staged = staged.withColumn("__wf_n", _normalized(F.col("__wf_m")))
    res = _final(F.col(base), F.col(ref), F.col("__wf_b"), F.col("__wf_r"), F.col("__wf_n"))
    return staged.withColumn(out, res).drop("__wf_b", "__wf_r", "__wf_m", "__wf_n")

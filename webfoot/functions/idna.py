"""Internationalised host names (O13): Punycode labels read and written by native expressions.

A label is a list of code points and both directions are folds over it (RFC
3492), so no Python runs per row.  A label that is no valid Punycode stays as
it is.  Texts are taken as composed (NFC); no mapping beyond lower case and
the three full-width dots is applied.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the parameters of RFC 3492 for host names ---
BASE, TMIN, TMAX, SKEW, DAMP, INITIAL_BIAS, INITIAL_N = 36, 1, 26, 38, 700, 72, 128
DIGITS = "abcdefghijklmnopqrstuvwxyz0123456789"
PREFIX = "xn--"
# Dots of other scripts that separate labels too.
DOTS = "。．｡"
# --- end of fixed values ---
OVERFLOW = 2**31  # no valid label reaches it
MAX_DIGITS = 14  # base digits of the largest delta of a label below 10^7 characters


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _div(a: Column, b) -> Column:
    return F.floor(a / b)


def _threshold(k: Column, bias: Column) -> Column:
    return F.greatest(F.lit(TMIN).cast("bigint"), F.least(F.lit(TMAX).cast("bigint"), k - bias))


def _adapted(delta: Column, points: Column, first: Column) -> Column:
    """The next bias: the delta is damped, then divided by 35 until it is 455 or less."""
    top = ((BASE - TMIN) * TMAX) // 2
    damped = F.when(first, _div(delta, DAMP)).otherwise(_div(delta, 2))

    def settled(d: Column) -> Column:
        turns = sum((F.when(d >= (top + 1) * (BASE - TMIN) ** i, 1).otherwise(0) for i in range(8)), F.lit(0))
        return _let(turns, lambda m: _let(_div(d, F.pow(F.lit(BASE - TMIN), m)),
                                          lambda r: m * BASE + _div((BASE - TMIN + 1) * r, r + SKEW)))
    return _let(damped, lambda d: _let(d + _div(d, points), settled))


def _long(n) -> Column:
    return F.lit(n).cast("bigint")


def _text(points: Column) -> Column:
    return F.array_join(F.transform(points, lambda p: F.decode(F.unhex(F.lpad(F.hex(p), 8, "0")), "UTF-32")), "")


def _characters(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def _decoded(body: Column) -> Column:
    """The text of a label without its prefix; null if it is no valid Punycode."""
    tail = F.substring_index(body, "-", -1)
    basic = F.when(body.contains("-"), body.substr(F.lit(1), F.length(body) - F.length(tail) - 1)).otherwise("")

    def state(n, i, old, w, bias, k, out, ok) -> Column:
        return F.struct(n.alias("n"), i.alias("i"), old.alias("old"), w.alias("w"), bias.alias("bias"), k.alias("k"),
                        out.alias("out"), ok.alias("ok"))

    def step(s: Column, ch: Column) -> Column:
        def turn(v: Column) -> Column:
            points = F.size(s.out) + 1
            ended = state(s.n + _div(v.i, points), v.i % points + 1, v.i % points + 1, _long(1),
                          _adapted(v.i - s.old, points, s.old == 0), _long(BASE),
                          _let((v.i % points).cast("int"), lambda at: F.concat(
                              F.slice(s.out, F.lit(1), at), F.array(s.n + _div(v.i, points)),
                              F.slice(s.out, at + 1, F.size(s.out)))),
                          (s.n + _div(v.i, points)).between(INITIAL_N, 0x10FFFF)
                          & ~(s.n + _div(v.i, points)).between(0xD800, 0xDFFF))
            more = state(s.n, v.i, s.old, s.w * (BASE - v.t), s.bias, s.k + BASE, s.out, s.w < OVERFLOW)
            lost = state(s.n, s.i, s.old, s.w, s.bias, s.k, s.out, F.lit(False))
            return F.when((v.digit < 0) | (v.i >= OVERFLOW), lost).when(v.digit < v.t, ended).otherwise(more)
        digit = F.call_function("instr", F.lit(DIGITS), ch) - 1
        values = F.struct(digit.alias("digit"), (s.i + digit * s.w).alias("i"), _threshold(s.k, s.bias).alias("t"))
        return F.when(s.ok, _let(values, turn)).otherwise(s)

    begin = state(_long(INITIAL_N), _long(0), _long(0), _long(1), _long(INITIAL_BIAS), _long(BASE),
                  F.transform(_characters(basic), lambda ch: F.ascii(ch).cast("bigint")),
                  ~body.rlike(r"[^\x00-\x7f]") & (F.length(tail) > 0))
    return F.aggregate(_characters(tail), begin, step,
                       lambda s: F.when(s.ok & (s.k == BASE), _text(s.out)))


def _encoded(label: Column) -> Column:
    """The Punycode of a label (without the prefix)."""
    def digits(delta: Column, bias: Column) -> Column:
        def put(s: Column, _) -> Column:
            t = _threshold(s.k, bias)
            sign = F.when(s.q < t, s.q).otherwise(t + (s.q - t) % (BASE - t))
            return F.when(s.done, s).otherwise(F.struct(
                F.when(s.q < t, s.q).otherwise(_div(s.q - t, BASE - t)).alias("q"), (s.k + BASE).alias("k"),
                F.concat(s.text, F.substring(F.lit(DIGITS), (sign + 1).cast("int"), F.lit(1))).alias("text"),
                (s.q < t).alias("done")))
        begin = F.struct(delta.alias("q"), _long(BASE).alias("k"), F.lit("").alias("text"), F.lit(False).alias("done"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(MAX_DIGITS)), begin, put, lambda s: s.text)

    def state(n, delta, done, bias, out) -> Column:
        return F.struct(n.alias("n"), delta.alias("delta"), done.alias("done"), bias.alias("bias"), out.alias("out"))

    def of_points(points: Column) -> Column:
        basic = F.filter(points, lambda p: p < INITIAL_N)

        def character(s: Column, p: Column) -> Column:
            hit = state(s.n, _long(0), s.done + 1, _adapted(s.delta, s.done + 1, s.done == F.size(basic)),
                        F.concat(s.out, digits(s.delta, s.bias)))
            return F.when(p < s.n, state(s.n, s.delta + 1, s.done, s.bias, s.out)).when(p == s.n, hit).otherwise(s)

        def point(s: Column, m: Column) -> Column:
            begin = state(m, s.delta + (m - s.n) * (s.done + 1), s.done, s.bias, s.out)
            return F.aggregate(points, begin, character,
                               lambda e: state(e.n + 1, e.delta + 1, e.done, e.bias, e.out))
        others = F.array_sort(F.array_distinct(F.filter(points, lambda p: p >= INITIAL_N)))
        begin = state(_long(INITIAL_N), _long(0), F.size(basic).cast("bigint"), _long(INITIAL_BIAS), F.lit(""))
        lead = F.when(F.size(basic) > 0, F.concat(_text(basic), F.lit("-"))).otherwise("")
        return F.concat(lead, F.aggregate(others, begin, point, lambda s: s.out))
    return _let(F.transform(_characters(label), lambda ch: F.ascii(ch).cast("bigint")), of_points)


def label_to_unicode(c) -> Column:
    """A lower-case label with its Punycode read; any other label as it is."""
    c = _c(c)
    return F.when(c.startswith(PREFIX), F.coalesce(_decoded(F.substring(c, len(PREFIX) + 1, 1 << 30)), c)).otherwise(c)


def label_to_ascii(c) -> Column:
    """A lower-case label written in ASCII."""
    c = _c(c)
    return F.when(c.rlike(r"[^\x00-\x7f]"), F.concat(F.lit(PREFIX), _encoded(c))).otherwise(c)


def ascii_dots(c) -> Column:
    return F.translate(_c(c), DOTS, "." * len(DOTS))


def unicode_labels(labels: Column, host: Column) -> Column:
    """``label_to_unicode`` of each label; hosts without the prefix pay nothing."""
    return F.when(host.contains(PREFIX), F.transform(labels, label_to_unicode)).otherwise(labels)


def host_to_unicode(c) -> Column:
    """A host in lower case, its labels in Unicode."""
    return _let(F.lower(ascii_dots(c)), lambda h: F.array_join(unicode_labels(F.split(h, r"\."), h), "."))


def host_to_ascii(c) -> Column:
    """A host in lower case, its labels in ASCII."""
    return _let(F.lower(ascii_dots(c)), lambda h: F.array_join(F.transform(F.split(h, r"\."), label_to_ascii), "."))

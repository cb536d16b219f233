"""Near-duplicate documents: banded MinHash candidates, odd sketches, exact confirmation.

A document's set holds its distinct ``k``-word shingles.  Documents with a
Jaccard similarity of ``percent`` or more are linked; a component is what
links connect, and its smallest id stands for it.

1. One row-local pass gives each document its set size, a 128-bit fingerprint
   of the set, band keys of ``BANDS`` x ``ROWS`` MinHash values, and an odd
   sketch: the MinHash samples of one permutation cut into ``BINS`` ranges (the
   smallest hash of each) folded into a parity bitmap.  The population count
   of two sketches' XOR estimates the samples' difference and so a high
   similarity closely; for sets much smaller than ``BINS`` almost exactly.
2. Documents with equal sets form a class; only its smallest id goes on, so
   thousands of copies cost one row.
3. Representatives that share a band key form a bucket.  Every bucket names a
   pivot and each member is a candidate with the pivot: as many candidates as
   members, never all pairs.  Sketch and size filters drop the hopeless ones;
   the rest are confirmed on their full sets, first each document's best
   candidate, then those that would still join two components.
4. What pivots leave open is decided exactly: in buckets that still hold more
   than one component, members of different components are compared by sketch,
   in blocks of bounded size.  Members with a promising partner come back with
   their full sets, again in blocks, and are confirmed inside the task: it
   returns only links that join components, never pairs.  Pairs inside a
   component need no further look.

The bands miss a pair of similarity 0.8 with a probability below 1e-7.  The
sketch filter's threshold lies more than four standard deviations (of 0.008)
under 0.8, so only pairs near the threshold are left to confirm.

Scale: the text is shuffled only for candidates, buckets hold ids and 64-bit
keys, a hot bucket or class is pre-aggregated and joined (not grouped) so that
Spark can split it, and components come from alternating star contractions
written to the shared folder, in a number of rounds logarithmic in the longest
chain.  Nothing of the corpus is collected.

Defined cases: null and empty texts and texts without words have an empty set
and link with nothing; rows with a null id are linked with nothing and stay;
rows that repeat an id count as one document (their sets are linked); repeated
rows all get the document's result; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from webfoot.llm.common import col, discard, lean, materialize, text_slices

PERCENT = 80
BANDS, ROWS = 32, 4
BINS = 4096  # MinHash samples in a sketch at most, a power of two
BITS = 4096
MARGIN = 0.036  # below the threshold, for the sketch's estimate
SLACK_BITS = 3  # for sets of a few dozen, where one lost sample weighs more than the margin
GLANCE_WORDS = 8  # 64-bit words of a sketch that are compared first
BLOCK = 2048  # members of a bucket compared at once
BLOCK_SHINGLES = 500_000  # and shingles of theirs: 4 MB of sets
PAIRS_AT_ONCE = 1 << 13  # with 512 bytes of sketch on either side: 8 MB if none is dropped before
MEMO = 300_000
BROADCAST_IDS = 500_000  # ids of 8 bytes: 4 MB

_rng = np.random.default_rng(20240101)
_FACTORS = _rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _rng.integers(0, 2**63, (8, 64), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def _mix(h: np.ndarray) -> np.ndarray:
    """The finalizer of MurmurHash3 (a public bijection of 64-bit numbers)."""
    h = (h ^ (h >> np.uint64(33))) * _M1
    h = (h ^ (h >> np.uint64(33))) * _M2
    return h ^ (h >> np.uint64(33))


class Shingler:
    """Distinct shingles of a text as sorted 64-bit hashes; words are runs of other than the six ASCII spaces."""

    def __init__(self, k: int):
        self.k, self.memo = k, {}

    def __call__(self, raw: bytes | None) -> np.ndarray:
        words = (raw or b"").lower().split()  # on bytes: A-Z only
        if not words:
            return np.empty(0, np.uint64)
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        for w in set(words).difference(memo):
            memo[w] = xxhash.xxh3_64_intdigest(w)
        ids = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
        k = self.k
        if len(words) < k:  # the whole sequence is one shingle, of a kind of its own
            return _mix(np.array([(ids * _PLACES[len(words) % 7 + 1, :len(words)]).sum(dtype=np.uint64)]))
        h = np.zeros(len(ids) - k + 1, np.uint64)
        for i in range(k):
            h += ids[i:len(ids) - k + 1 + i] * _PLACES[0, i]
        return np.unique(_mix(h))


def minima(shingles: np.ndarray) -> np.ndarray:
    """``BANDS * ROWS`` MinHash values."""
    best = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 512):
        part = _FACTORS[:, None] * shingles[None, at:at + 512]
        np.minimum(best, part.min(axis=1), out=best)
    return best >> np.uint64(32)


def band_keys(best: np.ndarray) -> np.ndarray:
    rows = best.reshape(BANDS, ROWS)
    h = np.arange(1, BANDS + 1, dtype=np.uint64) * _M2
    for i in range(ROWS):
        h = _mix(h ^ rows[:, i]) + _PLACES[7, i]
    return h.view(np.int64)


def odd_sketch(shingles: np.ndarray) -> tuple[np.ndarray, int]:
    """Parity of the samples that fall on each bit, and the number of samples.

    The hashes are sorted, so the smallest of each range is where the range begins.
    """
    ranges = shingles >> np.uint64(64 - (BINS - 1).bit_length())
    samples = shingles[np.flatnonzero(np.append(True, ranges[1:] != ranges[:-1]))]
    place = _mix(samples ^ _M1) % np.uint64(BITS)
    odd = (np.bincount(place.astype(np.int64), minlength=BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64), len(samples)


def most_differing_bits(filled, similarity, exp):
    """XOR population count to expect of two sketches of ``filled`` samples together at ``similarity``.

    A range's samples agree when the smallest hash of the union is shared, which
    has the similarity's probability; the union fills ``BINS * (1 - x ** (2 / (1 + similarity)))``
    ranges where ``x`` is the share of ranges that a set leaves empty.
    """
    empty = 1 - filled / (2 * BINS)
    difference = filled - 2 * BINS * similarity * (1 - empty ** (2 / (1 + similarity)))
    return BITS / 2 * (1 - exp(-2.0 * difference / BITS)) + SLACK_BITS


def signatures(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """``(doc_id, n, f1, f2, bands, sketch, filled)`` for each row."""
    def run(batches):
        shingle = Shingler(k)
        for batch, texts in text_slices(batches, 1):
            n, f1, f2, bands, sketches, filled = [], [], [], [], [], []
            for raw in texts:
                s = shingle(raw)
                n.append(len(s))
                print_ = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64)
                f1.append(int(print_[0]))
                f2.append(int(print_[1]))
                bands.append(band_keys(minima(s)) if len(s) else [])
                sketch, samples = odd_sketch(s) if len(s) else ([], 0)
                sketches.append(sketch)
                filled.append(samples)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()),
                 pa.array(bands, longs), pa.array(sketches, longs), pa.array(filled, pa.int64())],
                names=["doc_id", "n", "f1", "f2", "bands", "sketch", "filled"])

    return docs.select(col(id_col).cast("long").alias("doc_id"), col(text_col).cast("string").alias("text")).mapInArrow(
        lean(run), "doc_id long, n long, f1 long, f2 long, bands array<long>, sketch array<long>, filled long")


def _differing(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def promising(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """``(a, b, differing)`` of the pairs that pass the size and the sketch filter."""
    one = reps.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"), F.col("filled").alias("fa"))
    two = reps.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"), F.col("filled").alias("fb"))
    filled = F.col("fa") + F.col("fb")
    most = most_differing_bits(filled, percent / 100 - MARGIN, F.exp)
    return (pairs.join(one, "a").join(two, "b").where(_sizes_fit(F.col("na"), F.col("nb"), percent))
            .withColumn("differing", _differing(F.col("sa"), F.col("sb"))).where(F.col("differing") <= most)
            .select("a", "b", "differing"))


def _texts(needed: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, text)`` of the documents ``needed(id)``."""
    if needed.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        needed = F.broadcast(needed)  # at most 4 MB of ids; beyond that the join shuffles
    return docs.select(col(id_col).cast("long").alias("id"), col(text_col).cast("string").alias("text")).join(
        needed, "id", "left_semi")


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """The exact condition on two full sets."""
    same = len(np.intersect1d(x, y, assume_unique=True))
    return same > 0 and 100 * same >= percent * (len(x) + len(y) - same)


def confirm(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are similar enough."""
    texts = _texts(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), docs, id_col, text_col)
    both = (pairs.select("a", "b").join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
            .join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb"))

    def run(batches):
        shingle, last, held = Shingler(k), None, None
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            left, right = batch.column(2).cast(pa.binary()), batch.column(3).cast(pa.binary())
            good = []
            for i in range(batch.num_rows):
                if b[i] != last:  # rows of one pivot often stand together
                    last, held = b[i], (raw := right[i].as_py(), shingle(raw))
                elif (raw := right[i].as_py()) != held[0]:
                    held = raw, shingle(raw)
                if similar(shingle(left[i].as_py()), held[1], percent):
                    good.append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array([a[i] for i in good], pa.int64()), pa.array([b[i] for i in good], pa.int64())],
                names=["a", "b"])

    return both.mapInArrow(lean(run), "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """``(node, root)``: for each linked node the smallest node of its component.

    Alternating large and small stars until nothing changes; each round is
    written to the shared folder.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .where("u <> v").distinct(), "links")
    before, last = None, edges
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lower = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lower, "u")
        edges = materialize(
            small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(lower.select("u", F.col("m").alias("v"))).distinct(), "stars")
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u") % 1_000_003)).first()
        discard(last)
        last = edges
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state


def _with_root(df: DataFrame, roots: DataFrame, node: str, name: str) -> DataFrame:
    return df.join(roots.select(F.col("node").alias(node), F.col("root").alias(name)), node, "left").withColumn(
        name, F.coalesce(name, node))


def crossing(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose ends lie in different components."""
    return _with_root(_with_root(pairs, roots, "a", "_ra"), roots, "b", "_rb").where("_ra <> _rb").drop("_ra", "_rb")


def whole_groups(batches):
    """Tables of the sorted record batches, cut only where a group ``(key, i, j)`` ends."""
    held = None
    for batch in batches:
        if batch.num_rows:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held else table
            last = int(_group_starts(table)[-1])
            if last:
                yield table.slice(0, last)
            held = table.slice(last)
    if held:
        yield held


def _group_starts(table: pa.Table) -> np.ndarray:
    new = np.zeros(table.num_rows, bool)
    new[0] = True
    for name in ("key", "i", "j"):
        ids = table[name].to_numpy()
        new[1:] |= ids[1:] != ids[:-1]
    return np.flatnonzero(new)


def _partner_ranges(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """For each row where the rows begin and end that it is compared with: later ones of its block, or the other block's."""
    i, j, block = (table[c].to_numpy() for c in ("i", "j", "block"))
    starts, here = _group_starts(table), np.arange(table.num_rows)
    sizes = np.diff(starts, append=table.num_rows)
    end = np.repeat(starts + sizes, sizes)
    other = np.repeat(starts + np.add.reduceat((block == i).astype(np.int64), starts), sizes)
    return np.where(i == j, here + 1, np.where(block == i, other, end)), end


def promising_pairs(table: pa.Table, percent: int):
    """Positions ``(left, right)`` of rows of one group that may be linked, nearest first, some at a time.

    ``table`` has whole groups, sorted by key, i, j and block.  Two rows that
    share several keys are a pair under the smallest of them only.
    """
    key, rep, root, n, filled = (table[c].to_numpy() for c in ("key", "rep", "root", "n", "filled"))
    bits = table["sketch"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, BITS // 64)
    glance = np.ascontiguousarray(bits[:, :GLANCE_WORDS])
    share = GLANCE_WORDS * 64 / BITS
    begin, end = _partner_ranges(table)
    counts = end - begin
    before = np.append(0, np.cumsum(counts))
    shared: dict[int, frozenset] = {}

    def smallest(a: int, b: int) -> int:
        for x in (a, b):
            if x not in shared:
                shared[x] = frozenset(table["keys"][x].as_py())
        return min(shared[a] & shared[b])

    lo = 0
    while lo < len(counts):
        hi = max(lo + 1, int(np.searchsorted(before, before[lo] + PAIRS_AT_ONCE, "right")) - 1)
        some = counts[lo:hi]
        left = np.repeat(np.arange(lo, hi), some)
        right = np.arange(len(left)) + np.repeat(begin[lo:hi] - (before[lo:hi] - before[lo]), some)
        lo = hi
        fit = (root[left] != root[right]) & (
            np.minimum(n[left], n[right]) * 100 >= np.maximum(n[left], n[right]) * percent)
        left, right = left[fit], right[fit]
        most = most_differing_bits(filled[left] + filled[right], percent / 100 - MARGIN, np.exp)
        # A part of the bitmap first: its count lies within five deviations of its share of the whole.
        first = np.bitwise_count(glance[left] ^ glance[right]).sum(axis=1)
        near = first <= most * share + 5 * np.sqrt(most * share) + 1
        left, right, most = left[near], right[near], most[near]
        differing = np.bitwise_count(bits[left] ^ bits[right]).sum(axis=1)
        good = np.flatnonzero(differing <= most)
        good = good[np.argsort(differing[good], kind="stable")]
        pairs = [(a, b) for a, b in zip(left[good].tolist(), right[good].tolist()) if smallest(a, b) == key[a]]
        if pairs:
            yield pairs


def open_links(keys: DataFrame, reps: DataFrame, roots: DataFrame, docs: DataFrame, id_col: str, text_col: str,
               k: int, percent: int) -> DataFrame:
    """Links between different components whose members share a bucket.

    A bucket with many members or shingles is compared block by block, each
    pair of blocks in a group of its own.  Most buckets are small, so a task
    takes the groups of its partition one batch after the other, not one by one.
    """
    members = _with_root(keys, roots, "rep", "root").join(reps.select("rep", "n"), "rep")
    mixed = (members.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"),
                                        F.count(F.lit(1)).alias("m"), F.sum("n").alias("s")).where("lo <> hi")
             .select("key", F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("int").alias("blocks")))
    opened = materialize(members.join(mixed, "key"), "open-buckets")
    own = opened.groupBy("rep").agg(F.collect_set("key").alias("keys"))  # BANDS at most
    group = ["key", "i", "j", "block"]
    rows = (opened.join(reps.join(own, "rep").select("rep", "sketch", "filled", "keys"), "rep")
            .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
            .select(*group, "rep", "root", "n", "filled", "keys", "sketch"))

    def flag(batches):
        for table in whole_groups(batches):
            seen = np.zeros(table.num_rows, bool)
            for pairs in promising_pairs(table, percent):
                seen[np.array(pairs).ravel()] = True
            yield from table.filter(pa.array(seen)).to_batches()

    def sorted_groups(df):
        return df.repartition("key", "i", "j").sortWithinPartitions(*group)

    flagged = materialize(sorted_groups(rows).mapInArrow(lean(flag), rows.schema), "flagged")
    sets = shingle_sets(flagged.select(F.col("rep").alias("id")).distinct(), docs, id_col, text_col, k)

    def link(batches):
        merged: dict[int, int] = {}

        def find(x):
            while x in merged:
                x = merged[x]
            return x

        for table in whole_groups(batches):
            rep, root = table["rep"].to_pylist(), table["root"].to_pylist()
            out = []
            for pairs in promising_pairs(table, percent):
                for x, y in pairs:
                    a, b = find(root[x]), find(root[y])
                    if a != b and similar(*(np.frombuffer(table["shingles"][p].as_buffer(), np.uint64) for p in (x, y)),
                                          percent):
                        merged[max(a, b)] = min(a, b)
                        out.append((min(rep[x], rep[y]), max(rep[x], rep[y])))
            yield pa.RecordBatch.from_arrays([pa.array([p[at] for p in out], pa.int64()) for at in (0, 1)],
                                             names=["a", "b"])

    return sorted_groups(flagged.join(sets, "rep").select(*rows.columns, "shingles")).mapInArrow(
        lean(link), "a long, b long").distinct()


def shingle_sets(needed: DataFrame, docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """``(rep, shingles)``: the full sets of the documents ``needed(id)`` as bytes of 64-bit hashes."""
    def run(batches):
        shingle = Shingler(k)
        for batch, texts in text_slices(batches, 1):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([shingle(t).tobytes() for t in texts], pa.binary())], names=["rep", "shingles"])

    return _texts(needed, docs, id_col, text_col).mapInArrow(lean(run), "rep long, shingles binary")


def _extended(links: DataFrame, roots: DataFrame, more: DataFrame) -> tuple[DataFrame, DataFrame]:
    more = materialize(more, "links-more")
    if more.isEmpty():
        return links, roots
    links = links.unionByName(more)
    return links, components(links)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                    percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for each row of ``docs``."""
    signed = materialize(signatures(docs, id_col, text_col, k), "signatures")
    reps = materialize(
        signed.where("n > 0 and doc_id is not null").groupBy("f1", "f2")
        .agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"),
             F.first("sketch").alias("sketch"), F.first("filled").alias("filled")), "classes")
    keys = reps.select("rep", F.explode("bands").alias("key"))
    buckets = (keys.groupBy("key").agg(F.count(F.lit(1)).alias("m"),
                                       F.min_by("rep", F.xxhash64("rep", "key")).alias("pivot")).where("m > 1").drop("m"))
    shared = materialize(keys.join(buckets, "key"), "buckets")
    candidates = materialize(promising(
        shared.where("rep <> pivot").select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b"))
        .distinct(), reps, percent), "candidates")

    best = candidates.groupBy("b").agg(F.min_by("a", F.struct("differing", "a")).alias("a")).select("a", "b")
    links = materialize(confirm(materialize(best, "best"), docs, id_col, text_col, k, percent), "links-best")
    roots = components(links)
    rest = materialize(crossing(candidates.select("a", "b").join(best, ["a", "b"], "left_anti"), roots), "rest")
    links, roots = _extended(links, roots, confirm(rest, docs, id_col, text_col, k, percent))
    links, roots = _extended(links, roots, open_links(
        shared.select("key", "rep"), reps, roots, docs, id_col, text_col, k, percent))
    # An id whose rows have different sets stands for all of them: each of its classes is linked with the first.
    classes = (signed.where("n > 0 and doc_id is not null").join(reps.select("f1", "f2", "rep"), ["f1", "f2"])
               .select("doc_id", "rep").distinct())
    several = classes.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b")
    same_id = several.select("doc_id", "a").join(classes, "doc_id").where("rep <> a").select("a", F.col("rep").alias("b")).distinct()
    _, roots = _extended(links, roots, same_id)

    discard(shared, candidates, links)
    classes = _with_root(reps.select("f1", "f2", "rep"), roots, "rep", "root").select("f1", "f2", "root")
    return (signed.select("doc_id", "n", "f1", "f2")
            .join(classes, ["f1", "f2"], "left")
            .withColumn("component_id", F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("root"))
                        .otherwise(F.col("doc_id")))
            .select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, unchanged, that stay: one of each component.

    Of rows that repeat an id that stays, the one with the smallest text does;
    rows with a null id all stay.
    """
    decided = materialize(near_duplicates(docs, id_col, text_col, k, percent).where("doc_id is not null"), "decided")
    gone = decided.where("not kept").select(F.col("doc_id").alias("_wf_id")).distinct()
    again = decided.where("kept").groupBy(F.col("doc_id").alias("_wf_id")).agg(F.count(F.lit(1)).alias("n")).where(
        "n > 1").drop("n")
    if gone.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)  # at most 4 MB of ids; beyond that the join shuffles
    same = col(id_col).cast("long") == F.col("_wf_id")
    rest = docs.join(gone, same, "left_anti")
    if again.isEmpty():
        return rest
    order = Window.partitionBy(col(id_col)).orderBy(col(text_col).asc_nulls_last())
    first = rest.join(again, same, "left_semi").withColumn("_wf_nth", F.row_number().over(order)).where("_wf_nth = 1")
    return rest.join(again, same, "left_anti").unionByName(first.drop("_wf_nth"))

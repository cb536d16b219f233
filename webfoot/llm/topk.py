"""Exact top-k inner products: norm-sorted blocks, rotated partial sums, residual bounds.

Components become integers, ``floor(scale * x)``.  Vectors are range-partitioned
by descending length into blocks; queries form blocks of their own, and every
query block meets every vector block by an equi-join on the query block's
number.  A task walks one block's vectors from the longest on:

* when the length bound (query length times vector length) is below every
  query's k-th best score, the rest of the block is done;
* vectors and queries are rotated by the singular vectors of the corpus (from
  its second moments, summed by Spark), so the first coordinates carry most of
  a product; partial sum plus the product of the residual lengths bounds the
  score from above (Cauchy-Schwarz) and pairs below the k-th best are dropped;
* what is left is multiplied exactly in integers.

A first join with the block of the longest vectors gives every query a lower
bound to begin with.  Bounds only ever drop pairs that cannot be among the k
best, ties included.  Each pair of blocks returns at most k rows a query, and
Spark ranks these.

Memory: a task holds two blocks of at most ``BLOCK_BYTES``.  The driver gets one
``dimension x dimension`` matrix for each dimension up to ``MAX_ROTATED``.

Defined cases: null ids, null or empty vectors and vectors that hold null or
non-finite components take no part; vectors of different dimensions are not
compared; ties go to the smaller id; a row with the query's own id is not its
candidate; rows that repeat an id and vector count once; an id with several
vectors asks with each and is found by each, and its ``k`` best are taken of all
its pairs; vectors may have any number of components; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from webfoot.llm.common import col, materialize

SCALE = 1024.0
VECTOR_BLOCK = 4096
QUERY_BLOCK = 2048
CHUNK = 512
LEAD_SHARE = 0.6  # of the corpus' energy in the leading coordinates
BLOCK_BYTES = 64 << 20  # of vectors in a block at most
MAX_ROTATED = 2048  # components of vectors that are rotated; longer ones are bounded by length alone

_BLOCK_SCHEMA = "dim int, ids array<long>, data binary, longest double"


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """``(dim, length, vec_id, data)``: integer components as bytes of doubles."""
    v = col(vector_col)
    rows = (vectors.select(col(id_col).cast("long").alias("vec_id"), v.cast("array<double>").alias("v"))
            .where(F.col("vec_id").isNotNull() & (F.size("v") > 0)).where(
                F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), F.lit(False)))))

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            flat = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            ends = np.cumsum(pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False))
            parts = np.split(flat, ends[:-1]) if len(ends) else []
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(p) for p in parts], pa.int32()), pa.array([float(np.sqrt(p @ p)) for p in parts], pa.float64()),
                 batch.column(0), pa.array([p.tobytes() for p in parts], pa.binary())],
                names=["dim", "length", "vec_id", "data"])

    return rows.mapInArrow(run, "dim int, length double, vec_id long, data binary").groupBy("vec_id", "data").agg(
        F.first("dim").alias("dim"), F.first("length").alias("length")).select("dim", "length", "vec_id", "data")


def second_moments(rows: DataFrame) -> dict[int, np.ndarray]:
    """Sum of the outer products of all vectors, for each dimension."""
    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(0).to_numpy()
            for d in np.unique(dims):
                x = np.frombuffer(b"".join(batch.column(1).filter(pa.array(dims == d)).to_pylist())).reshape(-1, d)
                sums[int(d)] = sums.get(int(d), 0.0) + x.T @ x
        for d, m in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(d * d, d), pa.int32()), pa.array(np.arange(d * d), pa.int32()), pa.array(m.ravel())],
                names=["dim", "cell", "v"])

    cells = rows.where(F.col("dim") <= MAX_ROTATED).select("dim", "data").mapInArrow(run, "dim int, cell int, v double").groupBy("dim", "cell").agg(
        F.sum("v").alias("v")).collect()
    out: dict[int, np.ndarray] = {}
    for r in cells:
        out.setdefault(r["dim"], np.zeros(r["dim"] ** 2))[r["cell"]] = r["v"]
    return {d: m.reshape(d, d) for d, m in out.items()}


def rotations(moments: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, int]]:
    """For each dimension the rotation, strongest direction first, and the number of leading coordinates."""
    out = {}
    for d, m in moments.items():
        values, directions = np.linalg.eigh((m + m.T) / 2)
        share = np.cumsum(values[::-1]) / max(values.sum(), 1e-300)
        out[d] = directions[:, ::-1].copy(), int(min(max(np.searchsorted(share, LEAD_SHARE) + 1, 1), d))
    return out


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows of one partition, in their order, as blocks of at most ``size`` vectors."""
    def run(batches):
        held: dict[int, list] = {}

        def block(d):
            part = held.pop(d)
            return pa.RecordBatch.from_arrays(
                [pa.array([d], pa.int32()), pa.array([[p[0] for p in part]], pa.list_(pa.int64())),
                 pa.array([b"".join(p[1] for p in part)], pa.binary()), pa.array([max(p[2] for p in part)], pa.float64())],
                names=["dim", "ids", "data", "longest"])

        for batch in batches:
            for d, length, i, data in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(d, []).append((i, data, length))
                if len(held[d]) >= min(size, max(1, BLOCK_BYTES // (8 * d))):
                    yield block(d)
        for d in list(held):
            yield block(d)

    return rows.select("dim", "length", "vec_id", "data").mapInArrow(run, _BLOCK_SCHEMA)


def best_of_block(q_ids, q, c_ids, c, floor_, rotation, lead: int, k: int):
    """Rows (query row, vector id, score) that hold each query's ``k`` best of the block at or above its floor.

    ``c`` is in order of descending length.
    """
    lengths, q_lengths = np.linalg.norm(c, axis=1), np.linalg.norm(q, axis=1)
    order = np.argsort(-lengths, kind="stable")
    c, c_ids, lengths = c[order], c_ids[order], lengths[order]
    exact = float(q_lengths.max(initial=0)) * float(lengths.max(initial=0)) < 2.0 ** 52
    rq, rc = (q, c) if rotation is None else (q @ rotation, c @ rotation)
    q_rest = np.sqrt(np.maximum(q_lengths ** 2 - (rq[:, :lead] ** 2).sum(axis=1), 0))
    c_rest = np.sqrt(np.maximum(lengths ** 2 - (rc[:, :lead] ** 2).sum(axis=1), 0))
    best, names = np.full((len(q), k), -np.inf), np.zeros((len(q), k), np.int64)
    need = floor_.astype(float).copy()
    for at in range(0, len(c), CHUNK):
        part = slice(at, at + CHUNK)
        slack = 1e-9 * q_lengths * lengths[at] + 1e-6
        live = q_lengths * lengths[at] + slack >= need  # length bound: this and all later vectors are no longer
        if not live.any():
            break
        rows = np.flatnonzero(live)
        bound = rq[rows, :lead] @ rc[part, :lead].T + np.outer(q_rest[rows], c_rest[part]) + slack[rows, None]
        maybe = (bound >= need[rows, None]) & (c_ids[part][None, :] != q_ids[rows, None])
        some = np.flatnonzero(maybe.any(axis=1))
        if not len(some):
            continue
        rows, maybe = rows[some], maybe[some]
        cols = np.flatnonzero(maybe.any(axis=0))
        left, right = q[rows], c[part][cols]
        score = left @ right.T if exact else np.array(
            left.astype(object) @ right.T.astype(object), dtype=np.float64)
        score = np.where(maybe[:, cols], score, -np.inf)
        merged = np.concatenate([best[rows], score], axis=1)
        ids = np.concatenate([names[rows], np.broadcast_to(c_ids[part][cols], score.shape)], axis=1)
        top = np.lexsort((ids, -merged), axis=1)[:, :k]
        best[rows] = np.take_along_axis(merged, top, axis=1)
        names[rows] = np.take_along_axis(ids, top, axis=1)
        need[rows] = np.maximum(need[rows], best[rows, k - 1])
    at = np.nonzero(best > -np.inf)
    return at[0], names[at], best[at]


def _search(pairs: DataFrame, turned: dict, k: int) -> DataFrame:
    """Pairs of a query block and a vector block to ``(query_id, vec_id, score)``."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                dim = batch.column(0)[i].as_py()
                q_ids, c_ids = (batch.column(j)[i].values.to_numpy() for j in (1, 4))
                q, c = (np.frombuffer(batch.column(j)[i].as_py()).reshape(-1, dim) for j in (2, 5))
                known = dict(batch.column(3)[i].as_py() or ())
                lows = np.array([known.get(x, -np.inf) for x in q_ids.tolist()])
                rows, ids, scores = best_of_block(q_ids, q, c_ids, c, lows, *turned.get(dim, (None, 0)), k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[rows]), pa.array(ids), pa.array(scores.astype(np.int64))],
                    names=["query_id", "vec_id", "score"])

    return pairs.select("dim", "q_ids", "q_data", "known", "ids", "data").mapInArrow(
        run, "query_id long, vec_id long, score long")


def top_k(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: float = SCALE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best of every row whose id fulfils ``is_query``.

    ``is_query`` maps the id column ``vec_id`` to a condition.
    """
    rows = materialize(integer_vectors(vectors, id_col, vector_col, scale), "vectors")
    turned = rotations(second_moments(rows))
    queries = rows.where(is_query(F.col("vec_id")))
    n, n_queries = rows.count(), queries.count()
    banded = rows.repartitionByRange(max(1, -(-n // VECTOR_BLOCK)), "dim", F.desc("length"), "vec_id").sortWithinPartitions(
        "dim", F.desc("length"), "vec_id")
    cells = materialize(blocks(banded, VECTOR_BLOCK), "vector-blocks")
    asked = materialize(blocks(queries.repartitionByRange(  # queries of like length together: their blocks are pruned alike
        max(1, -(-n_queries // QUERY_BLOCK)), "dim", F.desc("length"), "vec_id"), QUERY_BLOCK).select(
        "dim", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"), F.col("longest").alias("q_longest"),
        F.monotonically_increasing_id().alias("q_block")), "query-blocks")

    # The block of the longest vectors of each dimension gives every query a floor.
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    first = cells.groupBy("dim").agg(F.max_by(F.struct("ids", "data"), F.struct("longest", F.xxhash64("ids"))).alias("b"))
    seeds = asked.join(first.select("dim", "b.ids", "b.data"), "dim").withColumn(
        "known", F.lit(None).cast("map<long,double>"))
    floors = (_search(seeds, turned, k).withColumn("r", F.row_number().over(rank)).where(F.col("r") == k)
              .select("query_id", F.col("score").cast("double").alias("floor")))
    known = (asked.select("q_block", F.explode("q_ids").alias("query_id")).distinct().join(floors, "query_id", "left")
             .groupBy("q_block").agg(
                 F.map_from_entries(F.collect_list(F.when(F.col("floor").isNotNull(), F.struct("query_id", "floor")))).alias("known"),
                 F.when(F.count_if(F.col("floor").isNull()) == 0, F.min("floor")).alias("low")))  # one entry a query of the block
    ready = materialize(asked.join(known, "q_block", "left"), "query-blocks-ready")

    # Query blocks against vector blocks: the stated queries against all rows, but for blocks whose longest
    # vector cannot reach the lowest floor of a query block; those never move.
    numbers = ready.groupBy("dim").agg(F.collect_list(F.struct("q_block", "q_longest", "low")).alias("asked"))
    reach = F.col("asked.q_longest") * F.col("longest") * (1 + 1e-9) + 1e-6
    pairs = (cells.join(numbers, "dim").withColumn("asked", F.explode("asked"))
             .where(F.col("asked.low").isNull() | (reach >= F.col("asked.low")))
             .withColumn("q_block", F.col("asked.q_block")).drop("asked", "dim").join(ready, "q_block"))
    return (_search(pairs, turned, k).withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))

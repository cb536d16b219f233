"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webfoot.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Texts handed to the per-batch helpers at once hold about this many bytes.
SLICE_BYTES = 2 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its literal name (dots and backticks allowed)."""
    return F.col("`" + name.replace("`", "``") + "`")


def lower_az(c: Column) -> Column:
    """Lower-case A-Z only, whatever the locale."""
    return F.translate(c, UPPER, LOWER)


def without(df: DataFrame, names: list[str]) -> list[str]:
    """Columns of ``df`` whose names do not clash with ``names`` (case-insensitive)."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage: what follows reads files that outlive any executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``materialize`` wrote, once nothing reads them any more."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = sc._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def _slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    start = held = 0
    for i, n in enumerate(sizes):
        if held and held + n > SLICE_BYTES:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes)


def text_slices(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Record batches cut to about ``SLICE_BYTES`` of text, with their texts as bytes (None: null)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        raw = batch.column(at).cast(pa.binary())
        sizes = [n or 0 for n in pa.compute.binary_length(raw).to_pylist()]
        for lo, hi in _slices(sizes):
            yield batch.slice(lo, hi - lo), raw.slice(lo, hi - lo).to_pylist()
        del batch, raw  # not held while the next one arrives


def give_back() -> None:
    """Return what this process has freed to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim:
        trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` for ``mapInArrow``, whose memory goes back when its task ends.

    Workers are used again by later stages and stand beside the executor's
    heap: what one stage leaves there would add to the needs of the next.
    """
    @wraps(run)
    def whole(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return whole


def append_columns(df: DataFrame, text_col: str, fields: list[T.StructField],
                   make: Callable[[], Callable[[list], list[list]]],
                   keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with ``fields`` computed from the text column.

    ``make()`` runs once per task and gives a function from a list of texts
    (bytes, None for null) to one list per field.  Columns of ``df`` with the
    name of a field are replaced.
    """
    kept = without(df.select(*map(col, keep)) if keep is not None else df, [f.name for f in fields])
    schema = T.StructType([df.schema[c] for c in kept] + fields)
    text = "_wf_text"
    while text in kept:
        text += "_"
    source = df.select(*map(col, kept), col(text_col).cast("string").alias(text))
    width = len(kept)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        fn = make()
        for part, texts in text_slices(batches, width):
            made = fn(texts)
            cols = [part.column(i) for i in range(width)]
            cols += [pa.array(v, type=arrow.field(width + i).type) for i, v in enumerate(made)]
            yield pa.RecordBatch.from_arrays(cols, names=arrow.names)

    return source.mapInArrow(lean(run), schema)


def filter_rows(df: DataFrame, text_col: str, make: Callable[[], Callable[[list], list]]) -> DataFrame:
    """The rows of ``df``, unchanged, for whose text the function gives True."""
    at = df.columns.index(text_col)
    as_text = dict(df.dtypes)[text_col] == "string"
    text = "_wf_text"
    while text in df.columns:
        text += "_"
    width = len(df.columns)
    source = df if as_text else df.select(*map(col, df.columns), col(text_col).cast("string").alias(text))

    def run(batches):
        fn = make()
        for part, texts in text_slices(batches, at if as_text else width):
            yield part.filter(pa.array(fn(texts), pa.bool_())).select(range(width))

    return source.mapInArrow(lean(run), df.schema)

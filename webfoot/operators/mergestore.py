"""Merge-on-read record store (O58, O8, O26): a bucketed base and append-only deltas.

The base is a Parquet table in buckets by ``(store, key_md5)`` with one row a
key.  An upsert writes the newest row of each key it brings as one delta folder:
bytes in proportion to its input, whatever the base holds.  Reading joins the
deltas, reduced to one row a key, to the base; only the deltas are shuffled, to
the base's buckets.  ``compact`` writes base and deltas as the next base.

Layout below ``path``: ``base-<n>`` and ``delta-<n>-<m>``; the deltas of base
``n`` are numbered from 0.  A folder counts once Spark has committed it (its
``_SUCCESS`` file), and the highest committed base is the store, so a writer
that is killed leaves the store as it was and its next write replaces the rest.
One writer at a time; readers keep the folders they began with.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import store as S

KEY = ["store", "key_md5"]


class MergeStore:
    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        """``buckets`` holds for a new store and for the next compaction; an existing base keeps its own."""
        self.spark, self.path = spark, path.rstrip("/")
        # Fewer buckets than shuffle partitions would make Spark move the base.
        self.buckets = max(buckets or 1, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def _committed(self, name: str) -> bool:
        sc = self.spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}/_SUCCESS")
        return path.getFileSystem(sc._jsc.hadoopConfiguration()).exists(path)

    def _count(self, prefix: str) -> int:
        n = 0
        while self._committed(f"{prefix}{n}"):
            n += 1
        return n

    @property
    def version(self) -> int:
        """The number of the current base, -1 before the first."""
        return self._count("base-") - 1

    def _deltas(self) -> DataFrame | None:
        """The newest row of each key in the deltas of the current base."""
        prefix = f"delta-{self.version}-"
        n = self._count(prefix)
        if not n:
            return None
        rows = self.spark.read.schema(S.STORE_SCHEMA).parquet(*[f"{self.path}/{prefix}{i}" for i in range(n)])
        return S.newest_per_key(rows)

    def _base(self) -> DataFrame | None:
        """The base as a bucketed table, registered for this session under a name of its own."""
        if self.version < 0:
            return None
        where = f"{self.path}/base-{self.version}"
        count = self.spark.read.text(f"{where}/_buckets").first()[0]
        name = f"wf_store_{uuid.uuid5(uuid.NAMESPACE_URL, where).hex[:16]}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({S.STORE_SCHEMA}) USING parquet "
                       f"CLUSTERED BY ({', '.join(KEY)}) SORTED BY ({', '.join(KEY)}) INTO {count} BUCKETS "
                       f"LOCATION '{where}/rows'")
        return self.spark.table(name)

    def upsert(self, rows: DataFrame) -> None:
        """Write ``rows`` (store rows) over what the store holds."""
        n = self._count(f"delta-{self.version}-")
        S.newest_per_key(rows).write.mode("overwrite").parquet(f"{self.path}/delta-{self.version}-{n}")

    def read(self) -> DataFrame:
        """The store: one row a key, the newest by ``seq``."""
        base, new = self._base(), self._deltas()
        if base is None or new is None:
            held = base if base is not None else new
            return held if held is not None else self.spark.createDataFrame([], S.STORE_SCHEMA)
        return self._merged(base, new)

    @staticmethod
    def _merged(base: DataFrame, new: DataFrame) -> DataFrame:
        b = base.select(*KEY, F.struct("seq", "value", "key").alias("__wf_b"))
        d = new.select(*KEY, F.struct("seq", "value", "key").alias("__wf_d"))
        won = F.greatest("__wf_b", "__wf_d")  # one of them may be null
        return b.join(d, KEY, "full_outer").select(*KEY, won.alias("__wf_w")).select(
            *KEY, "__wf_w.key", "__wf_w.value", "__wf_w.seq")

    def lookup(self, keys: DataFrame, key: str, schema: str, name: str) -> DataFrame:
        """Records of the store ``name`` by key; keys meet the base in its buckets."""
        return S.lookup(keys, key, self.read(), schema, name)

    def compact(self) -> None:
        """Write base and deltas as the next base."""
        n = self.version + 1
        held, where = self.read(), f"{self.path}/base-{n}"
        name = f"wf_store_{uuid.uuid4().hex[:16]}"
        writer = held.repartition(self.buckets, *KEY).write.mode("overwrite")
        try:
            writer.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", f"{where}/rows").saveAsTable(name)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: the files stay
        one = self.spark.createDataFrame([(str(self.buckets),)], "value string").coalesce(1)
        one.write.mode("overwrite").text(f"{where}/_buckets")
        # Last of all the mark that makes it the store.
        sc = self.spark.sparkContext
        mark = sc._jvm.org.apache.hadoop.fs.Path(f"{where}/_SUCCESS")
        mark.getFileSystem(sc._jsc.hadoopConfiguration()).create(mark, True).close()

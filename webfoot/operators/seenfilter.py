"""Two-level seen check (O36, O63): bitmap pages first, exact digests only for what they cannot rule out.

Every key has a place among ``places`` (a hash).  A page of the filter is the bitmap
of ``PAGE`` places, so the pages are rows that are dealt and joined by number,
however many there are.  A key whose bit is clear was never seen; only keys whose
bit is set meet the exact digests.  In a crawl most links are new or repeat a few,
so the digests are hardly moved: what is left of a batch is small, and Spark
broadcasts it where it measures it so.

Nothing is held in the state of a stream: a batch's keys and pages are one folder
named by the batch.  A batch sees only folders before its own and replaces its own,
so one that is run again gives the same rows.  ``fold`` merges folders (pages by
``bitmap_or_agg``), so their number stays small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE = 1 << 15
PLACES = 1 << 36  # 8 GB of bitmaps when all pages are in use
KEYS_SCHEMA = "digest binary"
PAGES_SCHEMA = "page long, bits binary"


def _committed(spark: SparkSession, path: str) -> bool:
    sc = spark.sparkContext
    mark = sc._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(sc._jsc.hadoopConfiguration()).exists(mark)


def is_set(bits: Column, at: Column) -> Column:
    """Whether bit ``at`` of a bitmap is set; False for a null bitmap."""
    byte = F.conv(F.hex(F.substring(bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))


class SeenFilter:
    def __init__(self, spark: SparkSession, path: str, places: int = PLACES):
        """``places`` belongs to the store: a folder keeps the number it was begun with."""
        self.spark, self.path, self.places = spark, path.rstrip("/"), places

    def _folders(self, kind: str, before: int) -> list[str]:
        """Folders that hold what batches below ``before`` brought."""
        folds = [b for b in range(before) if _committed(self.spark, f"{self.path}/fold-{b}/{kind}")
                 and _committed(self.spark, f"{self.path}/fold-{b}/pages")]
        first, out = (folds[-1], [f"{self.path}/fold-{folds[-1]}/{kind}"]) if folds else (-1, [])
        names = [f"{self.path}/batch-{b}/{kind}" for b in range(first + 1, before)]
        return out + [n for n in names if _committed(self.spark, n)]

    def _read(self, kind: str, schema: str, before: int) -> DataFrame:
        folders = self._folders(kind, before)
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def _placed(self, df: DataFrame, key: str) -> DataFrame:
        place = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(self.places))
        return df.withColumn("__wf_page", F.floor(place / PAGE)).withColumn("__wf_bit", place % PAGE)

    def _pages(self, before: int) -> DataFrame:
        return self._read("pages", PAGES_SCHEMA, before).groupBy("page").agg(F.bitmap_or_agg("bits").alias("bits"))

    def unseen(self, candidates: DataFrame, key: str, batch: int) -> DataFrame:
        """The rows of ``candidates`` whose key no batch below ``batch`` brought; null keys stay."""
        pages = self._pages(batch).select(F.col("page").alias("__wf_page"), F.col("bits").alias("__wf_bits"))
        marked = self._placed(candidates, key).join(pages, "__wf_page", "left").withColumn(
            "__wf_maybe", is_set(F.col("__wf_bits"), F.col("__wf_bit")) & F.col(key).isNotNull())
        new = marked.where(~F.col("__wf_maybe")).select(*candidates.columns)
        doubt = marked.where("__wf_maybe").withColumn("digest", F.unhex(F.md5(F.col(key).cast("string"))))
        exact = doubt.join(self._read("keys", KEYS_SCHEMA, batch), "digest", "left_anti").select(*candidates.columns)
        return new.unionByName(exact)

    def add(self, keys: DataFrame, key: str, batch: int) -> None:
        """Write the distinct keys that ``batch`` brings; run again, it replaces them."""
        rows = self._placed(keys.select(key).where(F.col(key).isNotNull()).distinct(), key)
        folder = f"{self.path}/batch-{batch}"
        rows.groupBy(F.col("__wf_page").alias("page")).agg(F.bitmap_construct_agg("__wf_bit").alias("bits")) \
            .write.mode("overwrite").parquet(f"{folder}/pages")
        rows.select(F.unhex(F.md5(F.col(key).cast("string"))).alias("digest")).write.mode("overwrite").parquet(f"{folder}/keys")

    def fold(self, batch: int) -> None:
        """Merge what all batches up to ``batch`` brought into one folder."""
        folder = f"{self.path}/fold-{batch}"
        self._read("keys", KEYS_SCHEMA, batch + 1).distinct().write.mode("overwrite").parquet(f"{folder}/keys")
        self._pages(batch + 1).write.mode("overwrite").parquet(f"{folder}/pages")

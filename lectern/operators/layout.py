"""Tables laid out by key, and joins that leave them where they lie.

A table that is joined again and again by one key is written once in buckets by that key, sorted in each. A join on
the key then shuffles the other side only, to the table's buckets, and merges without sorting the table;
a look-up of single keys reads single buckets. The number of buckets follows the size, and is no smaller than that of
shuffle partitions, for Spark re-deals a table of fewer.

Layouts are catalogue tables with files under the shared folder; ``drop`` removes both.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.sources.shared import shared_dir

#: Bytes of a bucket, about.
BUCKET = 256 << 20


class Layout:
    """A table in buckets by ``keys``."""

    def __init__(self, spark: SparkSession, name: str, keys: list[str], place: str):
        self.spark, self.name, self.keys, self.place = spark, name, keys, place

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.place)
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


def buckets(spark: SparkSession, size: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET))


def lay_out(df: DataFrame, keys: list[str], size: int = 0) -> Layout:
    """``df`` written in buckets; ``size``: its bytes, where they are known."""
    spark, name = df.sparkSession, f"layout_{uuid.uuid4().hex}"
    place, n = f"{shared_dir(spark)}/{name}", buckets(df.sparkSession, size)
    # dealt by bucket first, so that a bucket is one file
    df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys).option("path", place).format("parquet").saveAsTable(name)
    return Layout(spark, name, keys, place)


def remaining(work: DataFrame, done: Layout) -> DataFrame:
    """Work whose key ``done`` lacks; the hint keeps Spark from sending either side whole to every task."""
    return work.hint("merge").join(done.read().select(*done.keys), done.keys, "left_anti")


def rekeyed(references: DataFrame, column: str, old_to_new: Layout) -> DataFrame:
    """``references`` with ``column`` moved from old to new ids (old, new); what has no new id stays."""
    ids = old_to_new.read().select(F.col("old").alias("_old"), F.col("new").alias("_new"))
    moved = references.hint("merge").join(ids, F.col(column) == F.col("_old"), "left")
    return moved.select(*(F.coalesce("_new", column).alias(c) if c == column else F.col(c) for c in references.columns))


def looked_up(table: Layout, *values) -> DataFrame:
    """Rows of the given keys: of a table by one key, single buckets are read."""
    return table.read().filter(F.col(table.keys[0]).isin(list(values)))

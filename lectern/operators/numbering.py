"""Row numbers over a whole table in a stated order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.sources.shared import written


def numbered(rows: DataFrame, order: list[str], name: str = "number") -> DataFrame:
    """``rows`` with their place in the order of all, from 0; ``order`` names no two rows alike.

    Range partitions are sorted each; a row's place is its place there and the sizes of the partitions before.
    """
    at = F.monotonically_increasing_id()  # the partition above, the place in it in the lower 33 bits
    spread = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at), "numbered")
    part = F.shiftright("_at", 33).alias("_part")
    sizes = spread.groupBy(part).agg(F.count("*").alias("n"))  # a row for each partition
    before = F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    joined = spread.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return joined.select(*rows.columns, (F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))).alias(name))

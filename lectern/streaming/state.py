"""Streams with keyed state that expires: each passage once, and counters that a restart goes on with.

State lies in Spark's state store under the checkpoint, by key, beside the tasks that use it; a batch reads and
writes the keys that it meets, not what was written before. What is older than the latest record by more than the
expiry leaves the state, so its size follows the expiry, not the stream's age. Repetitions that come later
than that are passed on again, and records that late are not counted: choose the expiry by how late a crawler
may be. (``deduplicated`` in ``lectern.streaming.ingest`` forgets nothing, and reads its whole output for it.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators.store import Store
from lectern.sources.files import good
from lectern.streaming.ingest import records

COUNTERS = "day date, lang string, records long, n_chars long"


def _timed(stream: DataFrame, expiry: str) -> DataFrame:
    """Records with their time, or that of their arrival, as what expires."""
    return stream.withColumn("crawled_at", F.coalesce("crawled_at", F.current_timestamp())).withWatermark("crawled_at", expiry)


def once_within(spark: SparkSession, path: str, out: str, checkpoint: str, expiry: str = "1 day", files_per_trigger: int = 64) -> None:
    """Append each (lang, passage_id) of the JSON lines under ``path`` to Parquet files, once within ``expiry``."""
    keyed = good(records(spark, path, files_per_trigger))
    fresh = _timed(keyed, expiry).dropDuplicatesWithinWatermark(["lang", "passage_id"])
    # the file sink knows its batches: one that is repeated after a failure adds nothing
    fresh.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def count_imports(spark: SparkSession, path: str, store: Store, checkpoint: str, expiry: str = "7 days", files_per_trigger: int = 64) -> None:
    """Running totals per day and language, merged into the store's table ``counters`` after each batch.

    A batch's records are summed up before they are shuffled, so a language that has nearly all of them is one row per
    task. Totals are whole numbers since the start, so a batch that is repeated merges the same rows.
    """
    size: Column = F.coalesce(F.length("content"), F.lit(0))
    totals = _timed(good(records(spark, path, files_per_trigger)), expiry).groupBy(F.window("crawled_at", "1 day"), "lang").agg(F.count("*").alias("records"), F.sum(size).cast("long").alias("n_chars"))
    rows = totals.select(F.to_date("window.start").alias("day"), F.coalesce("lang", F.lit("")).alias("lang"), "records", "n_chars")

    def merge(batch: DataFrame, number: int) -> None:
        store.merge("counters", COUNTERS, batch, ["day", "lang"], ["records", "n_chars"])

    rows.writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

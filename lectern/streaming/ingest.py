"""JSON-lines ingestion as a stream of files: checkpointed, resumable and idempotent."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators.load import load
from lectern.operators.store import Store
from lectern.sources.files import bad, good, parse_records


def records(spark: SparkSession, path: str, files_per_trigger: int = 64) -> DataFrame:
    """New lines of the folder; the number of files per trigger is the back-pressure."""
    return parse_records(spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path))


def readable(spark: SparkSession, checkpoint: str) -> bool:
    """Whether a checkpoint's files can be understood; one that does not exist yet can."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/metadata")
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(at.getParent()):
        return True
    logs = [x.getPath() for folder in ("offsets", "commits") if files.exists(jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/{folder}")) for x in files.listStatus(jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/{folder}")) if x.getPath().getName().isdigit()]
    try:
        json.loads("".join(r["value"] for r in spark.read.text(at.toString()).collect()))["id"]
        return all(spark.read.text(p.toString()).first()["value"].startswith("v") for p in logs)
    except Exception:  # a missing, empty or broken file
        return False


def ingest(spark: SparkSession, path: str, store: Store, checkpoint: str, files_per_trigger: int = 64, report: Callable[[int, dict], None] | None = None, warn: Callable[[str], None] = print):
    """Merge everything that has arrived, then stop; run it again to go on where it ended.

    A batch that is repeated after a failure changes nothing, because merges are by key. For the same
    reason a checkpoint that cannot be read is put aside, and everything is merged afresh.
    """

    def merge(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            done = load(store, good(batch))
            done["malformed"] = {"rows": bad(batch).count()}
            if report:
                report(number, done)
        finally:
            batch.unpersist()

    if not readable(spark, checkpoint):
        warn(f"checkpoint {checkpoint} cannot be read; starting afresh")
        old = spark._jvm.org.apache.hadoop.fs.Path(checkpoint)
        old.getFileSystem(spark._jsc.hadoopConfiguration()).rename(old, old.suffix(f".unreadable-{uuid.uuid4().hex}"))
    query = records(spark, path, files_per_trigger).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def deduplicated(spark: SparkSession, path: str, out: str, checkpoint: str) -> None:
    """Append each (lang, passage_id) once to a folder of Parquet files, over any number of runs.

    What is there already is known from the folder itself, by an anti-join on its two key columns, so
    the stream keeps no state that grows. A batch that is repeated finds its own rows there.
    """
    keys = ["lang", "passage_id"]

    def append(batch: DataFrame, number: int) -> None:
        fresh = batch.dropDuplicates(keys)
        at = spark._jvm.org.apache.hadoop.fs.Path(out)
        if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
            there = spark.read.schema(batch.schema).parquet(out).select(*(F.col(k).alias(f"there_{k}") for k in keys))
            fresh = fresh.join(there, [F.col(k).eqNullSafe(F.col(f"there_{k}")) for k in keys], "left_anti")
        fresh.write.mode("append").parquet(out)

    stream = good(records(spark, path))
    stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()

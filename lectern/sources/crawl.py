"""A crawl in numbered time slots that keeps what it has.

Schedule. Requests are numbered over the whole work list, by range partitions and their sizes, so no task sees all
rows. Number n is sent n / rate seconds after the start, in lane n modulo ``lanes``. A lane is a partition of
its own and owns the slots of its remainder; a request that finds its slot gone takes the next one of its lane.
So a slot is used once at most, whatever the tasks' pace, and no window holds more requests than the rate allows,
as far as the executors' clocks agree. Lanes differ by one request at most, so none idles for another's load.

Slices. A slice of so many numbers is one job: its answers are written, the passages are appended to the JSON lines, and
the requests' states are merged by key. A run that stops, or loses a job, keeps all slices before; the next one asks
for the rest, and for passages of a slice that were appended but not merged it does not ask again.

Failures. What may succeed later is asked again after a delay that doubles, up to ``limit`` times over any
number of runs, and then given up for good (``dead``). Each attempt is a request of a schedule of its own, so
retries take later slots and keep the rate as well.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from lectern.operators.numbering import numbered
from lectern.operators.store import Store
from lectern.sources import rest
from lectern.sources.files import append_records, completed_or_fresh
from lectern.sources.shared import written

#: The state of each request that was ever sent; ``due``: when it may be sent again.
REQUESTS = "lang string, passage_id string, state string, attempts int, status int, error string, due timestamp"
KEYS = ["lang", "passage_id"]
DONE, MISSING, WAITING, DEAD = "done", "missing", "waiting", "dead"
#: Statuses that no further attempt changes.
FINAL = (200, 403, 404)

#: From rows with url and attempts to the same with status, body and error.
Transport = Callable[[DataFrame], DataFrame]


def schedule(work: DataFrame, order: list[str], per_second: float, lanes: int, slice_size: int) -> DataFrame:
    """``work`` with number, lane, slice, and slot_ms, the milliseconds from the start to its first slot."""
    n = F.col("number")
    slot = F.floor(n * F.lit(1000.0 / per_second)).cast("long")
    return numbered(work, order).withColumns({"lane": (n % lanes).cast("int"), "slice": F.floor(n / F.lit(slice_size)).cast("int"), "slot_ms": slot})


def next_slot(last: int, lane: int, lanes: int, per_second: float, passed: float) -> int:
    """The first slot of a lane after ``last`` (its place in the lane) that lies ``passed`` seconds after the start or later."""
    return max(last + 1, math.ceil((passed * per_second - lane) / lanes))


def http(per_second: float, lanes: int, headers: dict[str, str] | None = None, timeout: float = 30.0, get=rest.http_get, now=time.time, sleep=time.sleep) -> Transport:
    """Sends each row's request in its lane's slots; one attempt each. Rows need number and lane."""
    sent = headers or {}

    def answers(rows: DataFrame) -> DataFrame:
        kept, start = rows.schema, now() + 1 / per_second  # after all slots of the slice before

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            last = -1
            for batch in batches:
                urls, own = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("url", "lane"))
                for i, (url, lane) in enumerate(zip(urls, own, strict=True)):
                    last = next_slot(last, lane, lanes, per_second, now() - start)
                    sleep(max(0.0, start + (last * lanes + lane) / per_second - now()))
                    status, body, error = rest.ask(url, sent, timeout, get)  # passed on at once: a body may be large
                    answer = [pa.array([status], pa.int32()), pa.array([body], pa.string()), pa.array([error], pa.string())]
                    yield pa.RecordBatch.from_arrays([*(c.slice(i, 1) for c in batch.columns), *answer], names=[*batch.schema.names, "status", "body", "error"])

        schema = StructType([*kept.fields, StructField("status", IntegerType()), StructField("body", StringType()), StructField("error", StringType())])
        return rows.repartitionById(lanes, F.col("lane")).sortWithinPartitions("number").mapInArrow(run, schema)

    return answers


def delay(key: Column, attempts: Column, base: float, cap: float = 60.0) -> Column:
    """Seconds until the next attempt: doubling from ``base``, a quarter more or less by a checksum, ``cap`` at most.

    The checksum stands for chance, so that an executor's second try gives the same times."""
    draw = F.conv(F.substring(F.md5(F.concat_ws(":", key, attempts).cast("binary")), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    return F.least(F.lit(float(cap)), F.lit(float(base)) * F.pow(F.lit(2.0), attempts - 1) * (F.lit(0.75) + F.lit(0.5) * draw))


def outcome(answers: DataFrame, limit: int, base: float, now: float) -> DataFrame:
    """Rows of ``REQUESTS`` from answers with content; ``attempts``: those before this one."""
    tries = F.col("attempts") + 1
    given_up = F.col("status").isin(*FINAL) & ~((F.col("status") == 200) & (F.col("error") == "no content")) | (tries >= limit)
    state = F.when(F.col("content").isNotNull(), DONE).when(F.col("status") == 404, MISSING).when(given_up, DEAD).otherwise(WAITING)
    due = F.timestamp_seconds(F.lit(float(now)) + delay(F.concat_ws("/", *KEYS), tries, base))
    return answers.select(*KEYS, state.alias("state"), tries.cast("int").alias("attempts"), "status", "error", F.when(state == WAITING, due).alias("due"))


def remaining(work: DataFrame, store: Store, path: str, now: float, limit: int) -> DataFrame:
    """Work that was never answered and is not given up, with the attempts so far; what waits comes when it is due."""
    spark = work.sparkSession
    known = store.read("requests", REQUESTS).select(*KEYS, "state", "attempts", "due")
    left = work.join(completed_or_fresh(spark, path), KEYS, "left_anti").join(known, KEYS, "left")
    due = F.col("state").isNull() | ((F.col("state") == WAITING) & (F.col("due") <= F.timestamp_seconds(F.lit(float(now)))) & (F.col("attempts") < limit))
    return left.filter(due).select(*work.columns, F.coalesce("attempts", F.lit(0)).alias("attempts"))


def crawl(work: DataFrame, store: Store, path: str, transport: Transport, urls: Callable[[DataFrame], DataFrame], version_id: int, per_second: float, lanes: int = 8, slice_size: int = 10_000, limit: int = 5, base: float = 1.0, passes: int = 1, stop: Callable[[int], bool] = lambda done: False, now=time.time, sleep=time.sleep) -> dict[str, int]:
    """Ask for the passages that are left, and keep the answers slice by slice; returns how many requests ended how.

    ``work``: lang, passage_id, book_sort, chapter_sort, verse_sort; ``urls`` adds url. ``stop`` is asked before each slice, with the number
    of slices done. ``passes``: how often this run goes over what is left; it waits for what failed in the pass before to be due.
    """
    found, slices = {DONE: 0, MISSING: 0, WAITING: 0, DEAD: 0}, 0
    order = ["book_sort", "chapter_sort", "verse_sort", *KEYS]
    for turn in range(passes):
        if turn and (wait := _latest_due(store)) is not None:
            sleep(max(0.0, wait - now()))
        left = urls(remaining(work, store, path, now(), limit))
        planned = written(schedule(left, order, per_second, lanes, slice_size), "schedule", "slice")
        count = planned.agg(F.max("slice")).first()[0]
        if count is None:
            break
        failed = found[WAITING]
        for n in range(count + 1):
            if stop(slices):
                return found
            answers = transport(planned.filter(F.col("slice") == n))
            content = F.from_json("body", rest.PASSAGE)["content"]
            error = F.coalesce("error", F.when((F.col("status") == 200) & content.isNull(), "no content"))
            answers = written(answers.select(*work.columns, "attempts", "status", error.alias("error"), content.alias("content")), "answers")  # each url is asked once
            keep(answers, path, version_id)
            states = outcome(answers, limit, base, now())
            store.merge("requests", REQUESTS, states, KEYS, ["state", "attempts"])
            for r in states.groupBy("state").agg(F.count("*").alias("n")).collect():
                found[r["state"]] += r["n"]
            slices += 1
        if found[WAITING] == failed:
            break
    return found


def keep(answers: DataFrame, path: str, version_id: int) -> None:
    """Append the passages among the answers to the JSON lines under ``path``."""
    record = answers.filter("content IS NOT NULL").select("passage_id", "lang", F.lit(version_id).alias("bible_id"), "book_sort", "chapter_sort", "verse_sort", "content", F.current_timestamp().alias("crawled_at"))
    append_records(record, path)


def _latest_due(store: Store) -> float | None:
    due = store.read("requests", REQUESTS).filter(F.col("state") == WAITING).agg(F.max(F.unix_micros("due"))).first()[0]
    return None if due is None else due / 1e6


def served(pages: DataFrame) -> Transport:
    """Answers from a table (url, status, body, fails) instead of a network: the first ``fails`` attempts get status 503.

    Urls that the table lacks are not found. For replays of recorded crawls."""

    def answers(rows: DataFrame) -> DataFrame:
        there = pages.select("url", F.col("status").alias("_status"), F.col("body").alias("_body"), "fails")
        failing = F.col("attempts") < F.col("fails")
        status = F.when(F.col("_status").isNull(), 404).when(failing, 503).otherwise(F.col("_status")).cast("int")
        error = F.when(failing, "status 503").when(F.col("_status") == 403, "forbidden")
        return rows.join(there, "url", "left").select(*rows.columns, status.alias("status"), F.when(~failing & (F.col("_status") == 200), F.col("_body")).alias("body"), error.alias("error"))

    return answers


def summary(spark: SparkSession, store: Store) -> DataFrame:
    """Requests by state: how many there are, and how often they were sent."""
    return store.read("requests", REQUESTS).groupBy("state").agg(F.count("*").alias("requests"), F.sum("attempts").alias("sent"))

"""Decoding of REST responses, and a fetch operator with retries that runs on the executors.

``lectern.sources.crawl`` keeps one rate over all tasks, partial results and failures over runs.
"""

from __future__ import annotations

import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from lectern.functions import text as T

VERSION = "struct<id:int,abbreviation:string,title:string,localized_title:string,language_tag:string,copyright:string,books:array<string>>"
CHAPTER = "struct<id:string,passage_id:string,title:string,verses:array<struct<id:string,passage_id:string,title:string>>>"
BOOK = f"struct<id:string,title:string,full_title:string,abbreviation:string,canon:string,chapters:array<{CHAPTER}>,intro:variant>"
PASSAGE = "struct<id:string,content:string,reference:string>"
DAY = "struct<day:int,passage_id:string>"
VERSE = "struct<id:string,passage_id:string,title:string>"
MAX_BODY, MAX_ERROR = 10 << 20, 4 << 10


def decode(responses: DataFrame, schema: str, column: str = "body") -> DataFrame:
    """One object per response; broken text gives nulls."""
    return responses.select(F.from_json(column, f"data {schema}" if schema.startswith("array") else f"r {schema}").alias("x") if schema.startswith("array") else F.from_json(column, schema).alias("x")).select("x.*")


def versions(responses: DataFrame) -> DataFrame:
    return decode(responses, f"array<{VERSION}>").select(F.inline("data"))


def version(responses: DataFrame) -> DataFrame:
    return decode(responses, VERSION)


def books(responses: DataFrame) -> DataFrame:
    """Books of a response with their position, which is their number."""
    return decode(responses, f"array<{BOOK}>").select(F.posexplode("data").alias("pos", "b")).select((F.col("pos") + 1).alias("book_sort"), "b.*")


def book(responses: DataFrame) -> DataFrame:
    return decode(responses, BOOK)


def chapter(responses: DataFrame) -> DataFrame:
    return decode(responses, CHAPTER)


def verse(responses: DataFrame) -> DataFrame:
    """Structure of one verse; its text is a passage."""
    return decode(responses, VERSE)


def days(responses: DataFrame) -> DataFrame:
    return decode(responses, f"array<{DAY}>").select(F.inline("data"))


def passage(responses: DataFrame) -> DataFrame:
    return decode(responses, PASSAGE)


def verse_work(found: DataFrame) -> DataFrame:
    """Verses of decoded books: numbers of book and chapter are positions, that of the verse its id.

    Verses without a positive number are left out.
    """
    chapters = found.select("book_sort", F.posexplode("chapters").alias("pos", "c")).select("book_sort", (F.col("pos") + 1).alias("chapter_sort"), F.explode("c.verses").alias("v"))
    number = F.when(F.col("v.id").rlike(r"^[+-]?[0-9]+$"), F.col("v.id").try_cast("int"))
    return chapters.select("book_sort", "chapter_sort", number.alias("verse_sort"), F.col("v.passage_id").alias("passage_id")).filter("verse_sort > 0")


def http_get(url: str, headers: dict[str, str], timeout: float) -> tuple[int, bytes]:
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=timeout) as r:
            return r.status, r.read(MAX_BODY + 1)
    except urllib.error.HTTPError as e:
        return e.code, e.read(MAX_ERROR)


def ask(url: str, headers: dict[str, str], timeout: float, get=http_get) -> tuple[int, str | None, str | None]:
    """One attempt: status (0: no answer), body and error. 404 is an answer without a body."""
    try:
        status, raw = get(url, headers, timeout)
    except OSError as e:
        return 0, None, str(e)
    if status == 200:
        if len(raw) > MAX_BODY:
            return status, None, "body too large"
        return (status, raw.decode("utf-8", "replace"), None) if raw.strip() else (status, None, "empty body")
    if status in (403, 404):
        return status, None, None if status == 404 else "forbidden"
    return status, None, f"status {status}: {raw[:MAX_ERROR].decode('utf-8', 'replace')}"


def delay(attempt: int, base: float, cap: float = 60.0, draw: Callable[[], float] = random.random) -> float:
    """Doubling with a quarter of jitter either way, no more than ``cap``."""
    return min(cap, base * 2**attempt * (0.75 + 0.5 * draw()))


def pause(index: int, share: int, of: int, per_second: float, draw: Callable[[], float] = random.random) -> float:
    """Seconds before a request: partitions begin one after the other, then each keeps its part of the rate,
    with a quarter of jitter either way."""
    return share / per_second if index == 0 else of / per_second * (0.75 + 0.5 * draw())


def fetch(urls: DataFrame, per_second: float, retries: int = 5, base: float = 1.0, timeout: float = 30.0, headers: dict[str, str] | None = None, get=http_get, sleep=time.sleep, partitions: int = 8) -> DataFrame:
    """Each row of ``urls`` with status, body and error. Each partition gets its share of the rate.

    404 is an answer without a body; 403 and empty or overlong bodies are final; all else is tried
    again, ``retries`` times. Other columns are kept, in front.
    """
    sent = headers or {}
    kept = urls.schema

    def one(url: str) -> tuple:
        for attempt in range(retries + 1):
            if attempt:
                sleep(delay(attempt - 1, base))
            status, body, error = ask(url, sent, timeout, get)
            if status in (200, 403, 404):
                break
        return status, body, error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, sent_ = TaskContext.get().partitionId(), 0
        for batch in batches:
            for i, url in enumerate(batch.column(batch.schema.get_field_index("url")).to_pylist()):
                sleep(pause(sent_, share, partitions, per_second))
                sent_ += 1
                status, body, error = one(url)  # passed on at once: a body may be large
                answer = [pa.array([status], pa.int32()), pa.array([body], pa.string()), pa.array([error], pa.string())]
                yield pa.RecordBatch.from_arrays([*(c.slice(i, 1) for c in batch.columns), *answer], names=[*batch.schema.names, "status", "body", "error"])

    schema = StructType([*kept.fields, StructField("status", IntegerType()), StructField("body", StringType()), StructField("error", StringType())])
    return urls.repartition(partitions).mapInArrow(run, schema)


def fetched(responses: DataFrame) -> DataFrame:
    return responses.filter(F.col("body").isNotNull())


def failed(responses: DataFrame) -> DataFrame:
    """Errors; a missing page is none."""
    return responses.filter(F.col("error").isNotNull())


def books_url(base: str, version_id: int) -> str:
    return f"{base}/bibles/{version_id}/books"


def passage_urls(work: DataFrame, base: str, version_id: int) -> DataFrame:
    return work.withColumn("url", F.concat(F.lit(f"{base}/bibles/{version_id}/passages/"), T.path_escape(F.col("passage_id"))))

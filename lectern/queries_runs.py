"""Registered queries on what goes on over several runs: schedules, crawls, merges in batches; and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.ids import make_id
from lectern.operators import layout, load
from lectern.operators.store import Store
from lectern.plans.models import table
from lectern.sources import crawl, files, rest
from lectern.sources.shared import shared_dir
from lectern.streaming import state
from lectern.streaming.ingest import ingest

#: Requests a second, lanes and requests in a slice of the scheduled queries.
RATE, LANES, SLICE, ATTEMPTS = 15.0, 8, 1000, 3
BATCHES = 4


def request_schedule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A request for each order: its number, lane, slice and time slot."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return crawl.schedule(orders, ["o_custkey", "o_orderkey"], RATE, LANES, SLICE).select("o_orderkey", "number", "lane", "slice", "slot_ms")


def retry_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How long the request of each order waits after a number of attempts."""
    attempts = (F.col("o_orderkey") % 9 + 1).cast("int")
    wait = crawl.delay(F.col("o_orderkey").cast("string"), attempts, 1.0)
    return table(spark, sf_dir, "orders").select("o_orderkey", attempts.alias("attempts"), F.round(wait, 6).alias("seconds"))


def crawl_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as passages of a site that fails now and then; a run that is stopped after one slice of three, and one that goes on.

    Of the texts' lengths, tens are no page, nines never answer, eights are forbidden, sevens answer at the second attempt.
    """
    at = f"{shared_dir(spark)}/crawl-{uuid.uuid4().hex}"
    turns = table(spark, sf_dir, "conversations")
    work = turns.select(F.col("role").alias("lang"), F.concat_ws(".", "conv_id", "turn").alias("passage_id"), (F.col("conv_id") + 1).cast("int").alias("book_sort"), F.lit(1).alias("chapter_sort"), (F.col("turn") + 1).cast("int").alias("verse_sort"))
    n, urls = F.length("text"), lambda rows: rest.passage_urls(rows, "https://example.org", 1)
    body = F.to_json(F.struct(F.col("passage_id").alias("id"), F.col("text").alias("content")))
    fails = F.when(n % 9 == 0, ATTEMPTS).when((n % 8 != 0) & (n % 7 == 0), 1).otherwise(0)
    there = turns.filter(n % 10 != 0).select(F.concat_ws(".", "conv_id", "turn").alias("passage_id"), F.when(n % 8 == 0, 403).otherwise(200).alias("status"), "text", fails.alias("fails"))
    pages = urls(there.withColumn("body", body)).select("url", "status", "body", "fails")
    store, lines = Store(spark, f"{at}/store"), f"{at}/lines"
    size = max(1, -(-work.count() // 3))
    go = lambda **o: crawl.crawl(work, store, lines, crawl.served(pages), urls, 1, RATE, LANES, size, limit=ATTEMPTS, base=0.0, **o)
    go(stop=lambda done: done == 1)
    go(passes=ATTEMPTS + 1)
    kept = files.good(files.read_records(spark, lines)).select("lang", "passage_id", F.md5(F.col("content").cast("binary")).alias("digest"))
    return store.read("requests", crawl.REQUESTS).select("lang", "passage_id", "state", "attempts").join(kept, crawl.KEYS, "left")


def _merged(spark: SparkSession, sf_dir: str) -> tuple[Store, str, list[tuple]]:
    """Turns merged in batches: a first one, and then a quarter of all at a time, of which a third has changed."""
    turns = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).cast("long").alias("k"), F.md5(F.col("text").cast("binary")).alias("v"))
    store, schema, done = Store(spark, f"{shared_dir(spark)}/batches-{uuid.uuid4().hex}", ratio=10.0), "k long, v string", []
    for batch in range(BATCHES + 1):
        rows = turns.filter("k % 11 <> 0")
        if batch:
            rows = turns.filter(F.col("k") % BATCHES == batch - 1).withColumn("v", F.when(F.col("k") % 3 == 0, F.concat("v", F.lit(f":{batch}"))).otherwise(F.col("v")))
        before = store.current("turns")
        counts = store.merge("turns", schema, rows, ["k"], ["v"])
        now = store.current("turns")
        new = [f.rows for f in now.folders if not before or f not in before.folders]
        done.append((batch, counts["insert"], counts["noop"], counts["update"], sum(new)))
    return store, schema, done


def merge_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each batch of a merge did, and how many rows its version has written."""
    return spark.createDataFrame(_merged(spark, sf_dir)[2], "batch int, inserted long, unchanged long, updated long, written long")


def merged_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows after all batches, and after a compaction."""
    store, schema, _ = _merged(spark, sf_dir)
    apart = store.read("turns", schema)
    store.compact("turns", schema)
    return apart.withColumn("compacted", F.lit(False)).unionByName(store.read("turns", schema).withColumn("compacted", F.lit(True)))


def _streamed(spark: SparkSession, sf_dir: str, run, lang: Column | None = None) -> None:
    """Conversations as JSON lines, the even chapters first and then all, with a run of a stream after each."""
    at = f"{shared_dir(spark)}/state-{uuid.uuid4().hex}"
    chapter = (F.col("conv_id") + 1).cast("int")
    when = F.timestamp_seconds(F.lit(1_700_000_000) + chapter % 100 * 3600)
    passage = F.concat_ws(".", chapter, F.floor(F.col("turn") / 2) + 1)  # two turns have one passage
    rows = table(spark, sf_dir, "conversations").select(passage.alias("passage_id"), (F.col("role") if lang is None else lang).alias("lang"), F.lit(1).alias("bible_id"), F.lit(1).alias("book_sort"), chapter.alias("chapter_sort"), (F.col("turn") + 1).cast("int").alias("verse_sort"), F.col("text").alias("content"), when.alias("crawled_at"))
    for part in (rows.filter("chapter_sort % 2 = 0"), rows):
        files.append_records(part, f"{at}/lines")
        run(at)


def stream_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that a stream with expiring state has passed on, over a restart: each once."""
    places = []
    _streamed(spark, sf_dir, lambda at: (state.once_within(spark, f"{at}/lines", f"{at}/out", f"{at}/checkpoint", "30 days"), places.append(at)))
    return spark.read.parquet(f"{places[-1]}/out").groupBy("lang", "passage_id").agg(F.count("*").alias("times"))


def stream_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals per day and language after a restart."""
    stores = []

    def run(at: str) -> None:
        stores.append(Store(spark, f"{at}/store"))
        state.count_imports(spark, f"{at}/lines", stores[-1], f"{at}/checkpoint", "30 days")

    _streamed(spark, sf_dir, run)
    return stores[-1].read("counters", state.COUNTERS)


def resume_laid_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns that are left when those of every third length are done; what is done lies in buckets by key."""
    turns = table(spark, sf_dir, "conversations").select(F.col("role").alias("lang"), F.concat_ws(".", "conv_id", "turn").alias("passage_id"), F.length("text").alias("n"))
    done = layout.lay_out(turns.filter("n % 3 = 0").select("lang", "passage_id"), ["lang", "passage_id"])
    return layout.remaining(turns.select("lang", "passage_id"), done)


def rekey_laid_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References to lines' sections moved from old ids to new ones, which lie in buckets by old id."""
    lines = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") + 1).alias("o"), F.col("l_linenumber").alias("n"))
    ids = lines.distinct().filter("(o + n) % 7 <> 0").select(make_id("section", F.col("o"), F.col("n")).alias("old"), make_id("section", F.col("o"), F.col("n"), salt="second-").alias("new"))
    references = lines.select("o", "n", make_id("section", F.col("o"), F.col("n")).alias("ref"))
    return layout.rekeyed(references, "ref", layout.lay_out(ids, ["old"]))


def stream_fresh_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents after an import whose checkpoint was spoiled between two runs: everything is merged afresh, once."""
    places, warnings = [], []

    def run(at: str) -> None:
        if places:  # the second run finds a checkpoint that cannot be read
            files_, metadata = places[0]._hadoop(f"{at}/checkpoint/metadata")
            files_.delete(metadata, False)
            out = files_.create(metadata, True)
            out.write(bytearray(b"spoiled"))
            out.close()
        places.append(Store(spark, f"{at}/store"))
        ingest(spark, f"{at}/lines", places[-1], f"{at}/checkpoint", warn=warnings.append)

    _streamed(spark, sf_dir, run, lang=F.when(F.col("role") == "user", "chinese").otherwise("english"))
    written = places[-1].read("section_contents", load.RULES["section_contents"][0])
    return written.groupBy("language").agg(F.count("*").alias("contents")).withColumn("warnings", F.lit(len(warnings)))


def failed_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads of turns by role, in a language of that name: one of which nothing can be written fails, and says so."""
    turns, out = table(spark, sf_dir, "conversations"), []
    for lang, sort in (("english", 1), ("klingon", 1), ("chinese", 0)):
        rows = turns.select(F.lit(lang).alias("lang"), F.lit(1).alias("book_sort"), (F.col("conv_id") + 1).cast("int").alias("chapter_sort"), (F.lit(sort) * (F.col("turn") + 1)).cast("int").alias("verse_sort"), F.col("text").alias("content"))
        try:
            done = load.load(Store(spark, f"{shared_dir(spark)}/failing-{uuid.uuid4().hex}"), rows, strict=True)
            out.append((lang, done["section_contents"]["insert"], None))
        except ValueError as error:
            out.append((lang, 0, str(error)))
    return spark.createDataFrame(out, "lang string, written long, error string")


_TURNS = "t AS (SELECT conv_id * 1000 + turn AS k, md5(text) AS v FROM conversations)"

SQL = {
    "request_schedule": f"""SELECT o_orderkey, n AS number, n % {LANES} AS lane, n // {SLICE} AS slice, floor(n * {1000.0 / RATE!r})::BIGINT AS slot_ms
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1 AS n FROM orders)""",
    "retry_delays": """SELECT o_orderkey, a AS attempts, round(least(60.0, pow(2.0, a - 1) * (0.75 + 0.5 * (('0x' || substr(md5(o_orderkey || ':' || a), 1, 8))::BIGINT / 4294967296.0))), 6) AS seconds
FROM (SELECT o_orderkey, o_orderkey % 9 + 1 AS a FROM orders)""",
    "crawl_conversations": f"""SELECT role AS lang, conv_id || '.' || turn AS passage_id,
  CASE WHEN n % 10 = 0 THEN 'missing' WHEN n % 9 = 0 OR n % 8 = 0 THEN 'dead' ELSE 'done' END AS state,
  CASE WHEN n % 10 = 0 THEN 1 WHEN n % 9 = 0 THEN {ATTEMPTS} WHEN n % 8 = 0 THEN 1 WHEN n % 7 = 0 THEN 2 ELSE 1 END AS attempts,
  CASE WHEN n % 10 <> 0 AND n % 9 <> 0 AND n % 8 <> 0 THEN md5(text) END AS digest
FROM (SELECT *, length(text) AS n FROM conversations)""",
    "merge_batches": f"""WITH {_TURNS}
SELECT 0 AS batch, count(*) AS inserted, 0 AS unchanged, 0 AS updated, count(*) AS written FROM t WHERE k % 11 <> 0
UNION ALL SELECT k % {BATCHES} + 1, count(*) FILTER (WHERE k % 11 = 0), count(*) FILTER (WHERE k % 11 <> 0 AND k % 3 <> 0), count(*) FILTER (WHERE k % 11 <> 0 AND k % 3 = 0),
  count(*) FILTER (WHERE k % 11 = 0 OR k % 3 = 0) FROM t GROUP BY ALL""",
    "merged_rows": f"""WITH {_TURNS} SELECT k, v || CASE WHEN k % 3 = 0 THEN ':' || (k % {BATCHES} + 1) ELSE '' END AS v, compacted FROM t CROSS JOIN (VALUES (false), (true)) AS c(compacted)""",
    "stream_once": "SELECT DISTINCT role AS lang, (conv_id + 1) || '.' || (turn // 2 + 1) AS passage_id, 1 AS times FROM conversations",
    "stream_counters": """SELECT (to_timestamp(1700000000 + (conv_id + 1) % 100 * 3600) AT TIME ZONE 'UTC')::DATE AS day, role AS lang, sum(1 + (conv_id % 2))::BIGINT AS records, sum(length(text) * (1 + conv_id % 2))::BIGINT AS n_chars
FROM conversations GROUP BY ALL""",
    "stream_fresh_start": """SELECT CASE role WHEN 'user' THEN 'chinese' ELSE 'english' END AS language, count(DISTINCT (conv_id, turn)) AS contents, 1 AS warnings FROM conversations WHERE trim(text) <> '' GROUP BY ALL""",
    "failed_loads": """SELECT 'english' AS lang, count(DISTINCT (conv_id, turn)) AS written, NULL AS error FROM conversations WHERE trim(text) <> ''
UNION ALL SELECT l, 0, 'no verse written, ' || count(*) || ' rejected' FROM conversations CROSS JOIN (VALUES ('klingon'), ('chinese')) AS v(l) GROUP BY l""",
    "resume_laid_out": "SELECT role AS lang, conv_id || '.' || turn AS passage_id FROM conversations WHERE length(text) % 3 <> 0",
    "rekey_laid_out": """SELECT o, n, CASE WHEN (o + n) % 7 <> 0 THEN md5('second-section:' || o || ':' || n) ELSE md5('section:' || o || ':' || n) END AS ref FROM (SELECT l_orderkey + 1 AS o, l_linenumber AS n FROM lineitem)""",
}

QUERIES = {f.__name__: f for f in (request_schedule, retry_delays, crawl_conversations, merge_batches, merged_rows, stream_once, stream_counters, resume_laid_out, rekey_laid_out, stream_fresh_start, failed_loads)}

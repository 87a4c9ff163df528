"""Operator 5: site-relative line frequency, in DataFrame functions only.

Documents are grouped by host. A line's share is the number of the host's pages that contain it
over the host's page total; lines whose share exceeds ``ratio`` are boilerplate and are dropped.
Every row with a text is a page, and a page counts once for a line, however often it has it. A line must
be on ``min_hits`` pages at least: on one page alone it is not repeated, whatever the share (in a host
of nine pages it has a ninth of them).

Lines are told apart by their MD5. A host has at most (mean lines per page) / ratio boilerplate lines, whatever
its size, because each must lie in more than that share of its pages. Where these are ``MANY`` or fewer they
travel as one short array per host, and the texts are filtered row by row, without a shuffle. For hosts of more,
whose pages are long, the lines themselves are laid out and joined with the host's boilerplate, and a page is put
together again from the lines that are left: its work grows with its lines, not with their square.

Defined results: null hosts form one host; a null text stays null with no lines and is no page; an empty
text has one blank line; blank lines are never dropped; repeated rows are pages of their own and are
treated alike, so the lines of a page that a host repeats often go with it; an empty table gives no
rows; all columns of the input are kept, but for those named like the two that are added (``cleaned``
keeps them as well).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import stored

RATIO, MIN_HITS = 0.1, 2
#: Boilerplate lines of a host that are looked up in an array.
MANY = 256


def _host(df: DataFrame, host_col: str) -> Column:
    return F.coalesce(df[host_col].cast("string"), F.lit(""))


def _key(line: Column) -> Column:
    return F.md5(line.cast("binary"))


def _lines(body: str) -> Column:
    return F.split(body, "\n", -1)


def boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, min_hits: int = MIN_HITS) -> DataFrame:
    """(host_key, line): the keys of each host's boilerplate lines."""
    page = docs.select(_host(docs, host_col).alias("host_key"), docs[text_col].alias("body")).filter("body IS NOT NULL")
    totals = page.groupBy("host_key").agg(F.count("*").alias("pages"))
    written = F.filter(_lines("body"), lambda x: F.trim(x) != "")
    # once for each page: counted before anything is shuffled
    lines = page.select("host_key", F.explode(F.array_distinct(F.transform(written, _key))).alias("line"))
    hits = lines.groupBy("host_key", "line").agg(F.count("*").alias("hits"))
    frequent = hits.filter(F.col("hits") >= min_hits).join(totals, "host_key").filter(F.col("hits") > ratio * F.col("pages"))
    return frequent.select("host_key", "line")


def cleaned(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, min_hits: int = MIN_HITS) -> DataFrame:
    """(row, text, n_lines, n_dropped): each row of ``docs`` as it is, its cleaned text and two counts."""
    # written and read back, so that Spark knows its size before it decides to broadcast it
    found = stored(boilerplate(docs, host_col, text_col, ratio, min_hits), "boilerplate")
    sizes = stored(found.groupBy("host_key").agg(F.count("*").alias("n")), "hosts")
    short = sizes.filter(F.col("n") <= MANY).select("host_key")
    lists = stored(found.join(short, "host_key", "left_semi").groupBy("host_key").agg(F.collect_list("line").alias("dropped_keys")), "lists")
    work = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), _host(docs, host_col).alias("host_key"), docs[text_col].alias("body"))
    long = sizes.filter(F.col("n") > MANY).select("host_key")
    if long.isEmpty():
        return _filtered(work, lists)
    return _filtered(work.join(long, "host_key", "left_anti"), lists).unionByName(_put_together(work.join(long, "host_key", "left_semi"), found.join(long, "host_key", "left_semi")))


def _filtered(work: DataFrame, lists: DataFrame) -> DataFrame:
    """Each page filtered by its host's array."""
    work = work.join(lists, "host_key", "left")
    lines = _lines("body")
    kept = F.when(F.col("dropped_keys").isNull(), lines).otherwise(F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains(F.col("dropped_keys"), _key(x))))
    work = work.select("row", "body", "dropped_keys", F.size(lines).alias("all"), kept.alias("kept"))
    text = F.when(F.col("dropped_keys").isNull(), F.col("body")).otherwise(F.array_join("kept", "\n"))
    n_all = F.when(F.col("body").isNull(), 0).otherwise(F.col("all")).cast("long")
    n_kept = F.when(F.col("body").isNull(), 0).otherwise(F.size("kept")).cast("long")
    return work.select("row", text.alias("text"), n_all.alias("n_lines"), (n_all - n_kept).alias("n_dropped"))


def _put_together(work: DataFrame, found: DataFrame) -> DataFrame:
    """Each page from those of its lines that its host's boilerplate lacks."""
    pages = stored(work.withColumn("page", F.monotonically_increasing_id()), "pages")
    lines = pages.filter("body IS NOT NULL").select("page", "host_key", F.posexplode(_lines("body")).alias("pos", "text"))
    lines = lines.withColumn("line", F.when(F.trim("text") != "", _key(F.col("text"))))
    left = lines.join(found, ["host_key", "line"], "left_anti").groupBy("page").agg(F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("kept"))
    kept = left.select(F.col("page").alias("of"), F.size("kept").cast("long").alias("n_kept"), F.array_join(F.transform("kept", lambda x: x["text"]), "\n").alias("text"))
    joined = pages.join(kept, F.col("page") == F.col("of"), "left")
    text = F.when(F.col("body").isNotNull(), F.coalesce("text", F.lit("")))
    n_all = F.when(F.col("body").isNull(), 0).otherwise(F.size(_lines("body"))).cast("long")
    return joined.select("row", text.alias("text"), n_all.alias("n_lines"), (n_all - F.coalesce("n_kept", F.lit(0))).alias("n_dropped"))


def own_columns(names: list[str], but: tuple[str, ...] = (), **changed: Column) -> list[Column]:
    """The columns of ``row``, some changed, without those named in ``but``."""
    return [changed[c].alias(c) if c in changed else F.col("row").getField(c).alias(c) for c in names if c not in but]


def line_dedup(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = RATIO, min_hits: int = MIN_HITS) -> DataFrame:
    """``docs`` with the text cleaned, and the columns n_lines and n_dropped (long)."""
    found = cleaned(docs, host_col, text_col, ratio, min_hits)
    return found.select(*own_columns(docs.columns, ("n_lines", "n_dropped"), **{text_col: F.col("text")}), "n_lines", "n_dropped")


def oracle(table: str = "documents", ratio: float = RATIO, min_hits: int = MIN_HITS) -> str:
    return f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, text FROM {table}),
     l AS (SELECT doc_id, host, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d),
     t AS (SELECT host, count(text) AS pages FROM d GROUP BY host),
     b AS (SELECT l.host, line, true AS hit FROM l JOIN t ON l.host = t.host WHERE trim(line) <> '' GROUP BY l.host, line, pages
           HAVING count(DISTINCT doc_id) >= {min_hits} AND count(DISTINCT doc_id) > {ratio}::DOUBLE * pages),
     k AS (SELECT doc_id, count(*) AS n_lines, count(hit) AS n_dropped, coalesce(string_agg(l.line, chr(10) ORDER BY pos) FILTER (WHERE hit IS NULL), '') AS cleaned
           FROM l LEFT JOIN b ON l.host = b.host AND l.line = b.line GROUP BY doc_id)
SELECT d.doc_id, cleaned AS text, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped FROM d LEFT JOIN k ON d.doc_id = k.doc_id"""

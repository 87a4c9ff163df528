"""Registered queries as SQL text over the library's views and table functions, in a stated order, and on odd
pages and specifications; and their DuckDB SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern import queries as Q
from lectern import sql
from lectern.functions import text as T
from lectern.functions.catalogue import books as canon
from lectern.functions.catalogue import catalogue
from lectern.operators import extract, spec
from lectern.operators.numbering import numbered
from lectern.plans import validation as V
from lectern.plans.models import c_model, t_model, table
from lectern.sources import files
from lectern.sources.shared import shared_dir

#: Queries over the conversations' library; the others are over the larger one.
_SMALL = {"bilingual_viewer", "missing_pairs", "spot_check_keys"}
_WITH_PARAMETERS = {"bilingual_viewer", "missing_pairs"}


def as_text(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of the validation queries, run as SQL text."""
    wanted = spark.createDataFrame(Q.KEYS, sql.WANTED)
    library = c_model(spark, sf_dir) if name in _SMALL else t_model(spark, sf_dir, surrogate=False)
    sql.open_library(spark, library, catalogue(spark), wanted)
    parameters = {"book": Q.BOOK, "chapter": Q.CHAPTER} if name in _WITH_PARAMETERS else {}
    return sql.run(spark, name, **parameters)


def sql_parse_chapter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``parse_chapter`` through the table function, page by page."""
    Q.chapter_pages(spark, sf_dir).createOrReplaceTempView("chapter_pages")
    sql.register_extraction(spark)
    return spark.sql("""SELECT page_id, verse_sort, sub_title, md5(content) AS digest, note, cross_ref, error
FROM chapter_verses(TABLE(SELECT page_id, html, usfm, chapter_sort FROM chapter_pages) PARTITION BY page_id)""")


def sql_list_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of the list pages, in batches where they lie and beside their page; both must agree."""
    Q.list_pages(spark, sf_dir).createOrReplaceTempView("list_pages")
    sql.register_extraction(spark)
    return spark.sql("""SELECT page_id, pos, md5(text) AS digest, 'batch' AS way FROM ordered_items(TABLE(SELECT page_id, html FROM list_pages)) WHERE error IS NULL
UNION ALL SELECT p.page_id, i.pos, md5(i.text), 'beside' FROM list_pages p, LATERAL items_of(p.html) i""")


def sections_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing sections with their place in the order of books, chapters and sections."""
    return numbered(V.sections_missing_content(t_model(spark, sf_dir, surrogate=False)), ["book_sort", "chapter_sort", "section_sort"], "row_number")


def viewer_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All contents of the conversations' library with their place in the order of language and place."""
    lib = c_model(spark, sf_dir)
    places = lib.sections.select(F.col("id").alias("section_id"), "chapter_id", F.col("sort").alias("verse_num")).join(lib.chapters.select(F.col("id").alias("chapter_id"), F.col("sort").alias("chapter_sort")), "chapter_id")
    rows = lib.section_contents.join(places, "section_id").select("language", "chapter_sort", "verse_num", "title")
    return numbered(rows, ["language", "chapter_sort", "verse_num"], "row_number")


def parse_odd_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chapter pages with bad keys, verses in two fragments, and verses that name two later ones, the last first."""
    turns = table(spark, sf_dir, "conversations")
    n, chapter, kind = F.col("turn") + 1, (F.pmod("conv_id", F.lit(T.MAX_CHAPTER)) + 1).cast("int"), F.pmod("turn", F.lit(5))
    key = lambda number: F.concat(F.lit("GEN."), chapter, F.lit("."), number)
    named = F.when(kind == 2, F.concat(key(n), F.lit("+"), key(n + 200), F.lit(" "), key(n + 100))).otherwise(key(n))
    span = lambda refs, text: F.concat(F.lit('<div><span data-usfm="'), refs, F.lit('" class="x__verse"><span class="x__content">'), text, F.lit("</span></span></div>"))
    again = F.when(kind == 1, span(key(n), F.format_string("again %d", n))).otherwise("")
    blocks = turns.select("conv_id", chapter.alias("c"), F.struct("turn", F.concat(span(named, Q.escaped(F.col("text"))), again).alias("span")).alias("x")).groupBy("conv_id", "c").agg(F.array_sort(F.collect_list("x")).alias("b"))
    html = F.concat(F.lit('<div data-usfm="GEN.'), F.col("c"), F.lit('">'), F.array_join(F.transform("b", lambda x: x["span"]), ""), F.lit("</div>"))
    fault = F.pmod("conv_id", F.lit(11))
    pages = blocks.select(F.col("conv_id").alias("page_id"), html.alias("html"), F.when(fault == 3, "gen").otherwise("GEN").alias("usfm"), F.when(fault == 4, T.MAX_CHAPTER + 1).otherwise(F.col("c")).alias("chapter_sort"))
    return extract.chapters(pages).select("page_id", "pos", "verse_sort", F.md5(F.col("content").cast("binary")).alias("digest"), "note", "error")


def _spec_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A specification of as many books as the catalogue, with orders for verses, as it comes back from its file."""
    at = f"{shared_dir(spark)}/spec-{uuid.uuid4().hex}"
    orders = table(spark, sf_dir, "orders")
    counts = orders.groupBy((F.col("o_orderkey") % len(canon()) + 1).cast("int").alias("book_sort"), (F.col("o_custkey") % 40 + 1).cast("int").alias("chapter_sort")).agg(F.count("*").cast("int").alias("verses"))
    files.write_spec(spec.verses_map(counts).withColumns({"name": F.lit("n"), "testament": F.lit("t")}), at, "T", "V", T.ENGLISH)
    back = files.read_spec(spark, at)
    spec.assert_catalogue(back)
    return spec.spec_rows(back).select("number", "position", "verses")


def spec_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _spec_of_orders(spark, sf_dir)


def verse_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the specification expects of the chapter that each customer asks for, or why it expects nothing."""
    customers = table(spark, sf_dir, "customer")
    wanted = customers.select("c_custkey", (F.col("c_custkey") % 70 + 1).cast("int").alias("number"), (F.col("c_custkey") % 45 + 1).cast("int").alias("position"))
    return spec.verse_bounds(_spec_of_orders(spark, sf_dir), wanted)


def request_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests for the chapters of orders, as text, each fault in some of them."""
    o = F.col("o_orderkey")
    digest = F.md5(o.cast("string").cast("binary"))
    dashed = F.concat_ws("-", *(F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))
    raw = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(o % 11 == 0, " ").when(o % 13 == 0, F.concat(F.lit("x"), digest)).when(o % 2 == 0, dashed).otherwise(digest).alias("book_id"),
        F.when(o % 17 == 0, "-1").otherwise(F.concat(F.lit(" "), (o % 66).cast("string"))).alias("book_index"),
        F.when(o % 19 == 0, "0").when(o % 23 == 0, "one").otherwise((o % 150 + 1).cast("string")).alias("chapter_sort"),
        F.when(o % 29 != 0, F.concat(F.lit("+"), (o % 176 + 1).cast("string"))).alias("max_verses"),
        F.when(o % 31 == 0, "latin").when(o % 2 == 0, "chinese").otherwise(" english ").alias("lang"),
    )
    return spec.request_contexts(raw).drop("book_id")


def books_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All books in the order of their number, however they were written."""
    return numbered(t_model(spark, sf_dir).books.select(F.col("sort").alias("book_sort")), ["book_sort"], "row_number")


_FUNCTIONS = (request_contexts, books_in_order, sql_parse_chapter, sql_list_items, sections_in_order, viewer_in_order, parse_odd_chapters, spec_of_orders, verse_bounds)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f"sql_{name}": partial(as_text, name) for name in sql.QUERIES} | {f.__name__: f for f in _FUNCTIONS}

_TABLES = Q.oracle_sql()
_SPEC = f"""c AS (SELECT o_orderkey % {len(canon())} + 1 AS number, o_custkey % 40 + 1 AS chapter, count(*) AS verses FROM orders GROUP BY ALL),
s AS (SELECT number::INT AS number, row_number() OVER (PARTITION BY number ORDER BY chapter)::INT AS position, verses::INT AS verses FROM c)"""

SQL = {f"sql_{name}": _TABLES[name] for name in sql.QUERIES} | {
    "sql_parse_chapter": _TABLES["parse_chapter"],
    "sql_list_items": """SELECT conv_id AS page_id, (row_number() OVER (PARTITION BY conv_id, way ORDER BY turn) - 1)::INT AS pos,
  md5(CASE WHEN length(text) % 7 = 0 THEN chr(160) || ' ' ELSE text END) AS digest, way FROM conversations CROSS JOIN (VALUES ('batch'), ('beside')) AS w(way)""",
    "sections_in_order": f"SELECT *, row_number() OVER (ORDER BY book_sort, chapter_sort, section_sort) - 1 AS row_number FROM ({_TABLES['sections_missing_content']})",
    "viewer_in_order": f"""WITH {Q._C} SELECT language, chapter_sort, section_sort AS verse_num, title, row_number() OVER (ORDER BY language, chapter_sort, section_sort) - 1 AS row_number FROM C_contents""",
    "parse_odd_chapters": f"""WITH v AS (SELECT conv_id, turn, turn + 1 AS n, turn % 5 AS kind, conv_id % 11 AS fault, trim(regexp_replace(text, '[\\s\\x0b\\x{{85}}\\p{{Z}}]+', ' ', 'g')) AS body FROM conversations),
  w AS (SELECT conv_id, turn, 0 AS place, n, body || CASE WHEN kind = 1 THEN ' again ' || n ELSE '' END AS content, '' AS note FROM v WHERE fault NOT IN (3, 4) AND n <= {T.MAX_VERSE}
    UNION ALL SELECT conv_id, turn, 1, n + 100, '{T.MERGED}', 'merged' FROM v WHERE fault NOT IN (3, 4) AND kind = 2 AND n + 100 <= {T.MAX_VERSE}
    UNION ALL SELECT conv_id, turn, 2, n + 200, '{T.MERGED}', 'merged' FROM v WHERE fault NOT IN (3, 4) AND kind = 2 AND n + 200 <= {T.MAX_VERSE})
  SELECT conv_id AS page_id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn, place) - 1)::INT AS pos, n::INT AS verse_sort, md5(content) AS digest, note, NULL::VARCHAR AS error FROM w
  UNION ALL SELECT DISTINCT conv_id, NULL, NULL, NULL, NULL, 'bad chapter key' FROM v WHERE fault IN (3, 4)""",
    "request_contexts": """SELECT o_orderkey, CASE WHEN error IS NULL THEN o % 66 END AS book_index, CASE WHEN error IS NULL THEN o % 150 + 1 END AS chapter_sort, CASE WHEN error IS NULL THEN o % 176 + 1 END AS max_verses,
  CASE WHEN o % 31 = 0 THEN 'latin' WHEN o % 2 = 0 THEN 'chinese' ELSE 'english' END AS lang, error
FROM (SELECT o_orderkey, o_orderkey AS o, CASE WHEN o % 11 = 0 THEN 'missing book_id' WHEN o % 13 = 0 THEN 'invalid book_id' WHEN o % 17 = 0 THEN 'invalid book_index' WHEN o % 19 = 0 OR o % 23 = 0 THEN 'invalid chapter_sort'
  WHEN o % 29 = 0 THEN 'invalid max_verses' WHEN o % 31 = 0 THEN 'unsupported language' END AS error FROM orders)""",
    "books_in_order": "SELECT (c_custkey + 1)::INT AS book_sort, row_number() OVER (ORDER BY c_custkey) - 1 AS row_number FROM customer",
    "spec_of_orders": f"WITH {_SPEC} SELECT * FROM s",
    "verse_bounds": f"""WITH {_SPEC}, w AS (SELECT c_custkey, (c_custkey % 70 + 1)::INT AS number, (c_custkey % 45 + 1)::INT AS position FROM customer)
  SELECT w.*, s.verses, CASE WHEN NOT EXISTS (SELECT 1 FROM s x WHERE x.number = w.number) THEN 'book out of range' WHEN s.verses IS NULL THEN 'chapter out of range' END AS error
  FROM w LEFT JOIN s ON s.number = w.number AND s.position = w.position""",
}

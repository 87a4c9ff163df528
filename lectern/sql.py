"""The library as SQL: views over the six tables, functions in SQL, extraction as table functions, and the
validation queries as text with named parameters.

``open_library`` registers all of it in a session; ``run`` runs one of ``QUERIES``, and any other text may use the
same names:

* views ``books``, ``book_contents``, ``chapters``, ``chapter_contents``, ``sections``, ``section_contents``,
  ``expected_children`` and ``wanted_keys``;
* ``present(id)``, ``is_blank(text)``, and the table functions ``book_names()`` and
  ``chapter_sections(book, chapter)``, which the optimizer unfolds like views;
* ``chapter_verses(TABLE(...))`` over page_id, html, usfm and chapter_sort, and ``ordered_items(TABLE(...))`` over
  page_id and html: Arrow batches where the rows lie, or PARTITION BY page_id; and ``LATERAL items_of(html)``,
  row by row, for pages beside other columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import text as T
from lectern.operators import extract
from lectern.schemas import Library

EXPECTED = "book_sort int, name_zh string, name_en string, total_chapters int"
WANTED = "book_sort int, chapter_sort int, verse_sort int, resolution_method string, cross_ref_source string"

_FUNCTIONS = (
    "present(id STRING) RETURNS STRING RETURN CASE WHEN id IS NULL THEN 'MISSING' ELSE 'OK' END",
    "is_blank(x STRING) RETURNS BOOLEAN RETURN trim(coalesce(x, '')) = ''",
    f"""book_names() RETURNS TABLE (book_id STRING, book_sort INT, zh_id STRING, zh_title STRING, en_id STRING, en_title STRING) RETURN
SELECT b.id, b.sort, zh.id, zh.title, en.id, en.title FROM books b
LEFT JOIN book_contents zh ON zh.book_id = b.id AND zh.language = '{T.CHINESE}'
LEFT JOIN book_contents en ON en.book_id = b.id AND en.language = '{T.ENGLISH}'""",
    """chapter_sections(book STRING, chapter INT) RETURNS TABLE (section_id STRING, verse_num INT) RETURN
SELECT s.id, s.sort FROM sections s
LEFT SEMI JOIN (SELECT c.id FROM chapters c LEFT SEMI JOIN (SELECT min(x.book_id) AS id FROM book_contents x WHERE x.title = chapter_sections.book) t ON c.book_id = t.id
  WHERE c.sort = chapter_sections.chapter) c ON s.chapter_id = c.id""",
)


def _level(name: str, parents: str, contents: str, key: str) -> str:
    return f"""SELECT '{name}' AS level, (SELECT count(DISTINCT id) FROM {parents}) AS total,
  count(DISTINCT id) FILTER (WHERE language = '{T.CHINESE}') AS has_chinese, count(DISTINCT id) FILTER (WHERE language = '{T.ENGLISH}') AS has_english
FROM {contents} x LEFT SEMI JOIN {parents} p ON x.{key} = p.id"""


def _beside(contents: str, key: str, of: str) -> str:
    return f"""LEFT JOIN {contents} zh ON zh.{key} = {of} AND zh.language = '{T.CHINESE}'
LEFT JOIN {contents} en ON en.{key} = {of} AND en.language = '{T.ENGLISH}'"""


_NAMES = f"coalesce(n.zh_title, '{T.NO_NAME}') AS book_name_zh, coalesce(n.en_title, '{T.MISSING}') AS book_name_en"

#: Text, and the order that ``ordered`` asks for. Parameters: :book and :chapter.
QUERIES: dict[str, tuple[str, str]] = {
    "completeness_summary": (
        f"""SELECT level, total, has_chinese, has_english, total - has_chinese AS missing_chinese, total - has_english AS missing_english FROM (
{_level("Level 1: Books", "books", "book_contents", "book_id")}
UNION ALL {_level("Level 2: Chapters", "chapters", "chapter_contents", "chapter_id")}
UNION ALL {_level("Level 3: Sections", "sections", "section_contents", "section_id")})""",
        "level",
    ),
    "parents_missing_content": (
        f"""SELECT book_sort, coalesce(zh_title, '{T.MISSING}') AS title_zh, coalesce(en_title, '{T.MISSING}') AS title_en, present(zh_id) AS chinese_status, present(en_id) AS english_status
FROM book_names() WHERE zh_id IS NULL OR en_id IS NULL""",
        "book_sort",
    ),
    "chapters_missing_content": (
        f"""WITH gaps AS (SELECT c.book_id, c.sort, zh.id AS zh_id, zh.title AS zh, en.id AS en_id, en.title AS en FROM chapters c
{_beside("chapter_contents", "chapter_id", "c.id")} WHERE zh.id IS NULL OR en.id IS NULL)
SELECT n.book_sort, {_NAMES}, g.sort AS chapter_sort, coalesce(zh, '{T.MISSING}') AS chapter_title_zh, coalesce(en, '{T.MISSING}') AS chapter_title_en,
  present(g.zh_id) AS chinese_status, present(g.en_id) AS english_status FROM gaps g JOIN book_names() n ON n.book_id = g.book_id""",
        "book_sort, chapter_sort",
    ),
    "sections_missing_content": (
        f"""WITH gaps AS (SELECT s.book_id, s.chapter_id, s.sort, zh.id AS zh_id, zh.title AS zh, en.id AS en_id, en.title AS en FROM sections s
{_beside("section_contents", "section_id", "s.id")} WHERE zh.id IS NULL OR en.id IS NULL)
SELECT n.book_sort, {_NAMES}, c.sort AS chapter_sort, g.sort AS section_sort, coalesce(zh, '{T.MISSING}') AS section_title_zh, coalesce(en, '{T.MISSING}') AS section_title_en,
  present(g.zh_id) AS chinese_status, present(g.en_id) AS english_status FROM gaps g JOIN chapters c ON c.id = g.chapter_id JOIN book_names() n ON n.book_id = g.book_id""",
        "book_sort, chapter_sort, section_sort",
    ),
    "expected_vs_actual_children": (
        """WITH found AS (SELECT b.sort, count(c.id) AS n FROM books b JOIN chapters c ON c.book_id = b.id GROUP BY b.sort)
SELECT e.book_sort, name_zh AS book_name_zh, name_en AS book_name_en, total_chapters AS expected_chapters, coalesce(n, 0) AS actual_chapters, total_chapters - coalesce(n, 0) AS missing_chapters
FROM expected_children e LEFT JOIN found f ON f.sort = e.book_sort WHERE total_chapters <> coalesce(n, 0)""",
        "book_sort",
    ),
    "language_count_diff": (
        f"""WITH written AS (SELECT s.chapter_id, count(DISTINCT x.id) FILTER (WHERE x.language = '{T.CHINESE}') AS zh, count(DISTINCT x.id) FILTER (WHERE x.language = '{T.ENGLISH}') AS en
  FROM sections s JOIN section_contents x ON x.section_id = s.id GROUP BY s.chapter_id)
SELECT n.book_sort, coalesce(n.zh_title, '?') AS book_name_zh, coalesce(n.en_title, '?') AS book_name_en, c.sort AS chapter_sort, w.zh AS zh_section_count, w.en AS en_section_count, abs(w.zh - w.en) AS diff
FROM written w JOIN chapters c ON c.id = w.chapter_id JOIN book_names() n ON n.book_id = c.book_id WHERE w.zh <> w.en""",
        "book_sort, chapter_sort",
    ),
    "bilingual_viewer": (
        """SELECT :book AS book_name_param, :chapter AS chapter_num_param, s.verse_num, x.language, x.title, x.content, x.sub_title
FROM chapter_sections(:book, :chapter) s JOIN section_contents x ON x.section_id = s.section_id""",
        "language, verse_num",
    ),
    "missing_pairs": (
        f"""SELECT :book AS book_name_param, :chapter AS chapter_num_param, s.verse_num, l.language, '{T.MISSING}' AS title
FROM chapter_sections(:book, :chapter) s CROSS JOIN (VALUES {", ".join(f"('{x}')" for x in T.LANGUAGES)}) AS l(language)
WHERE NOT EXISTS (SELECT 1 FROM section_contents x WHERE x.section_id = s.section_id AND x.language = l.language)""",
        "verse_num, language",
    ),
    "language_totals": (
        """SELECT x.language, count(*) AS total_section_contents, count(DISTINCT s.id) AS unique_sections, count(DISTINCT c.id) AS unique_chapters, count(DISTINCT b.id) AS unique_books
FROM section_contents x JOIN sections s ON s.id = x.section_id JOIN chapters c ON c.id = s.chapter_id JOIN books b ON b.id = c.book_id GROUP BY x.language""",
        "language",
    ),
    "blank_content_guard": (
        f"""SELECT n.book_sort, {_NAMES}, c.sort AS chapter_sort, s.sort AS verse_sort, x.language, coalesce(x.content, 'NULL') AS content_preview
FROM section_contents x JOIN sections s ON s.id = x.section_id JOIN chapters c ON c.id = s.chapter_id JOIN book_names() n ON n.book_id = c.book_id WHERE is_blank(x.content)""",
        "book_sort, chapter_sort, verse_sort, language",
    ),
    "spot_check_keys": (
        f"""SELECT k.book_sort, {_NAMES}, k.chapter_sort, k.verse_sort, k.resolution_method, nullif(k.cross_ref_source, '') AS cross_ref_source,
  left(coalesce(zh.content, '{T.MISSING}'), 60) AS chinese_content, left(coalesce(en.content, '{T.MISSING}'), 60) AS english_content, CASE WHEN is_blank(en.content) THEN '{T.EMPTY}' ELSE 'OK' END AS english_status
FROM wanted_keys k JOIN book_names() n ON n.book_sort = k.book_sort JOIN chapters c ON c.book_id = n.book_id AND c.sort = k.chapter_sort
JOIN sections s ON s.chapter_id = c.id AND s.sort = k.verse_sort {_beside("section_contents", "section_id", "s.id")}""",
        "book_sort, chapter_sort, verse_sort",
    ),
}


class _Pages:
    """A table function over batches of pages: what ``extract`` gives for them."""

    columns: tuple[str, ...]

    def eval(self, pages: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        yield from extract.page_rows([pages.select(list(self.columns))], *self.how)


class ChapterVerses(_Pages):
    columns, how = ("page_id", "html", "usfm", "chapter_sort"), (extract.parse_chapter, extract.VERSE_ROWS)


class OrderedItems(_Pages):
    columns, how = ("page_id", "html"), (extract.parse_list_items, extract.ITEM_ROWS)


class ItemsOf:
    """The items of one page; none where it has no list."""

    def eval(self, html: str) -> Iterator[tuple]:
        yield from extract.parse_list_items(html)


def open_library(spark: SparkSession, lib: Library, expected: DataFrame | None = None, wanted: DataFrame | None = None) -> None:
    """Register views and functions in the session, in place of those of an earlier library."""
    for name, df in lib.tables().items():
        df.createOrReplaceTempView(name)
    (expected if expected is not None else spark.createDataFrame([], EXPECTED)).createOrReplaceTempView("expected_children")
    (wanted if wanted is not None else spark.createDataFrame([], WANTED)).createOrReplaceTempView("wanted_keys")
    for text in _FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {text}")
    register_extraction(spark)


def register_extraction(spark: SparkSession) -> None:
    spark.udtf.register("chapter_verses", F.arrow_udtf(ChapterVerses, returnType=f"page_id long, {extract.VERSE_ROWS}, error string"))
    spark.udtf.register("ordered_items", F.arrow_udtf(OrderedItems, returnType=f"page_id long, {extract.ITEM_ROWS}, error string"))
    spark.udtf.register("items_of", F.udtf(ItemsOf, returnType=extract.ITEM_ROWS))


def run(spark: SparkSession, name: str, ordered: bool = False, **parameters) -> DataFrame:
    """One of ``QUERIES`` over the library that is open."""
    text, order = QUERIES[name]
    return spark.sql(f"{text} ORDER BY {order}" if ordered else text, args=parameters)

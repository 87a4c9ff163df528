"""Completeness, gap, difference and look-up queries over the six tables.

Results carry no order of their own unless ``ordered``; a total order is a range shuffle that a
caller who writes or aggregates them does not need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as T
from lectern.schemas import Library


def _of(contents: DataFrame, key: str, lang: str, prefix: str, *columns: str) -> DataFrame:
    """The content rows of one language under prefixed names, filtered before any join."""
    return contents.filter(F.col("language") == lang).select(F.col(key).alias(f"{prefix}_key"), *(F.col(c).alias(f"{prefix}_{c}") for c in columns))


def _paired(parents: DataFrame, id_col: str, contents: DataFrame, key: str, name: str, *columns: str) -> DataFrame:
    """Parents with their Chinese and English content beside them, null where there is none."""
    for lang, tag in ((T.CHINESE, "zh"), (T.ENGLISH, "en")):
        side = _of(contents, key, lang, f"{name}_{tag}", *columns)
        parents = parents.join(side, F.col(id_col) == F.col(f"{name}_{tag}_key"), "left").drop(f"{name}_{tag}_key")
    return parents


def _status(column: Column) -> Column:
    return F.when(column.isNull(), "MISSING").otherwise("OK")


def _or(column: str, sentinel: str, name: str) -> Column:
    return F.coalesce(F.col(column), F.lit(sentinel)).alias(name)


def _books(lib: Library) -> DataFrame:
    named = _paired(lib.books.select(F.col("id").alias("b_id"), F.col("sort").alias("book_sort")), "b_id", lib.book_contents, "book_id", "book", "id", "title")
    return named


def _chapters(lib: Library) -> DataFrame:
    return lib.chapters.select(F.col("id").alias("c_id"), F.col("book_id").alias("c_book_id"), F.col("sort").alias("chapter_sort"))


def _sections(lib: Library) -> DataFrame:
    return lib.sections.select(F.col("id").alias("s_id"), F.col("book_id").alias("s_book_id"), F.col("chapter_id").alias("s_chapter_id"), F.col("sort").alias("section_sort"))


def completeness_summary(lib: Library) -> DataFrame:
    """Per level: distinct parents, and distinct contents of each language."""
    levels = (("Level 1: Books", lib.books, lib.book_contents, "book_id"), ("Level 2: Chapters", lib.chapters, lib.chapter_contents, "chapter_id"), ("Level 3: Sections", lib.sections, lib.section_contents, "section_id"))
    out = None
    for name, parents, contents, key in levels:
        # the outer joins only drop contents without a parent; a semi-join does so without pairing rows
        ids = parents.select("id").distinct()
        own = contents.join(ids.withColumnRenamed("id", key), key, "left_semi")
        side = lambda lang: F.count_distinct(F.when(F.col("language") == lang, F.col("id")))
        one = ids.agg(F.count("id").alias("total")).crossJoin(own.agg(side(T.CHINESE).alias("has_chinese"), side(T.ENGLISH).alias("has_english")))
        one = one.select(F.lit(name).alias("level"), "total", "has_chinese", "has_english", (F.col("total") - F.col("has_chinese")).alias("missing_chinese"), (F.col("total") - F.col("has_english")).alias("missing_english"))
        out = one if out is None else out.union(one)
    return out


def books_missing_content(lib: Library, ordered: bool = False) -> DataFrame:
    zh, en = F.col("book_zh_id"), F.col("book_en_id")
    out = _books(lib).filter(zh.isNull() | en.isNull()).select("book_sort", _or("book_zh_title", T.MISSING, "title_zh"), _or("book_en_title", T.MISSING, "title_en"), _status(zh).alias("chinese_status"), _status(en).alias("english_status"))
    return out.orderBy("book_sort") if ordered else out


def chapters_missing_content(lib: Library, ordered: bool = False) -> DataFrame:
    zh, en = F.col("chapter_zh_id"), F.col("chapter_en_id")
    gaps = _paired(_chapters(lib), "c_id", lib.chapter_contents, "chapter_id", "chapter", "id", "title").filter(zh.isNull() | en.isNull())
    out = gaps.join(_books(lib), F.col("c_book_id") == F.col("b_id")).select(
        "book_sort",
        _or("book_zh_title", T.NO_NAME, "book_name_zh"),
        _or("book_en_title", T.MISSING, "book_name_en"),
        "chapter_sort",
        _or("chapter_zh_title", T.MISSING, "chapter_title_zh"),
        _or("chapter_en_title", T.MISSING, "chapter_title_en"),
        _status(zh).alias("chinese_status"),
        _status(en).alias("english_status"),
    )
    return out.orderBy("book_sort", "chapter_sort") if ordered else out


def sections_missing_content(lib: Library, ordered: bool = False) -> DataFrame:
    """The gaps are found first, so only they are joined to their chapters and books."""
    zh, en = F.col("section_zh_id"), F.col("section_en_id")
    gaps = _paired(_sections(lib), "s_id", lib.section_contents, "section_id", "section", "id", "title").filter(zh.isNull() | en.isNull())
    out = (
        gaps.join(_chapters(lib), F.col("s_chapter_id") == F.col("c_id"))
        .join(_books(lib), F.col("s_book_id") == F.col("b_id"))
        .select(
            "book_sort",
            _or("book_zh_title", T.NO_NAME, "book_name_zh"),
            _or("book_en_title", T.MISSING, "book_name_en"),
            "chapter_sort",
            "section_sort",
            _or("section_zh_title", T.MISSING, "section_title_zh"),
            _or("section_en_title", T.MISSING, "section_title_en"),
            _status(zh).alias("chinese_status"),
            _status(en).alias("english_status"),
        )
    )
    return out.orderBy("book_sort", "chapter_sort", "section_sort") if ordered else out


def expected_vs_actual_children(lib: Library, spec: DataFrame, ordered: bool = False) -> DataFrame:
    """``spec``: book_sort, name_zh, name_en, total_chapters. Surplus chapters count negative."""
    counts = lib.chapters.groupBy("book_id").agg(F.count("id").alias("n"))
    found = lib.books.join(counts, F.col("id") == F.col("book_id"), "left").groupBy("sort").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"))
    actual = F.coalesce(F.col("n"), F.lit(0)).cast("long")
    out = (
        spec.join(found, F.col("book_sort") == F.col("sort"), "left")
        .select("book_sort", F.col("name_zh").alias("book_name_zh"), F.col("name_en").alias("book_name_en"), F.col("total_chapters").alias("expected_chapters"), actual.alias("actual_chapters"))
        .withColumn("missing_chapters", F.col("expected_chapters") - F.col("actual_chapters"))
        .filter("missing_chapters <> 0")
    )
    return out.orderBy("book_sort") if ordered else out


def language_count_diff(lib: Library, ordered: bool = False) -> DataFrame:
    """Contents are counted per chapter before the titles join, not after."""
    side = lambda lang: F.count_distinct(F.when(F.col("language") == lang, F.col("content_id")))
    written = lib.section_contents.select("section_id", "language", F.col("id").alias("content_id"))
    per = _sections(lib).join(written, F.col("s_id") == F.col("section_id")).groupBy("s_chapter_id").agg(side(T.CHINESE).alias("zh_section_count"), side(T.ENGLISH).alias("en_section_count"))
    out = (
        per.filter("zh_section_count <> en_section_count")
        .join(_chapters(lib), F.col("s_chapter_id") == F.col("c_id"))
        .join(_books(lib), F.col("c_book_id") == F.col("b_id"))
        .select(
            "book_sort",
            _or("book_zh_title", "?", "book_name_zh"),
            _or("book_en_title", "?", "book_name_en"),
            "chapter_sort",
            "zh_section_count",
            "en_section_count",
            F.abs(F.col("zh_section_count") - F.col("en_section_count")).alias("diff"),
        )
    )
    return out.orderBy("book_sort", "chapter_sort") if ordered else out


def _target(lib: Library, book_name: str, chapter: int) -> DataFrame:
    """Sections of one chapter of the book with a name in either language (the least id, if several)."""
    book = lib.book_contents.filter(F.col("title") == book_name).agg(F.min("book_id").alias("t_id"))
    chapters = _chapters(lib).filter(F.col("chapter_sort") == chapter).join(F.broadcast(book), F.col("c_book_id") == F.col("t_id"), "left_semi")
    return _sections(lib).join(chapters.select("c_id"), F.col("s_chapter_id") == F.col("c_id"), "left_semi")


def _params(df: DataFrame, book_name: str, chapter: int) -> list[Column]:
    return [F.lit(book_name).alias("book_name_param"), F.lit(chapter).alias("chapter_num_param")]


def bilingual_viewer(lib: Library, book_name: str, chapter: int, ordered: bool = False) -> DataFrame:
    found = _target(lib, book_name, chapter).join(lib.section_contents, F.col("s_id") == F.col("section_id"))
    out = found.select(*_params(found, book_name, chapter), F.col("section_sort").alias("verse_num"), "language", "title", "content", "sub_title")
    return out.orderBy("language", "verse_num") if ordered else out


def missing_pairs(lib: Library, book_name: str, chapter: int, ordered: bool = False) -> DataFrame:
    """(section, language) pairs of a chapter that should have content and have none."""
    pairs = _target(lib, book_name, chapter).select("s_id", "section_sort", F.explode(F.array(*map(F.lit, T.LANGUAGES))).alias("language"))
    there = lib.section_contents.select(F.col("section_id").alias("s_id"), "language")
    gaps = pairs.join(there, ["s_id", "language"], "left_anti")
    out = gaps.select(*_params(gaps, book_name, chapter), F.col("section_sort").alias("verse_num"), "language", F.lit(T.MISSING).alias("title"))
    return out.orderBy("verse_num", "language") if ordered else out


def language_totals(lib: Library, ordered: bool = False) -> DataFrame:
    rows = (
        lib.section_contents.select("language", "section_id")
        .join(_sections(lib), F.col("section_id") == F.col("s_id"))
        .join(_chapters(lib), F.col("s_chapter_id") == F.col("c_id"))
        .join(lib.books.select(F.col("id").alias("b_id")), F.col("c_book_id") == F.col("b_id"))
    )
    out = rows.groupBy("language").agg(F.count("*").alias("total_section_contents"), F.count_distinct("s_id").alias("unique_sections"), F.count_distinct("c_id").alias("unique_chapters"), F.count_distinct("b_id").alias("unique_books"))
    return out.orderBy("language") if ordered else out


def blank_content_guard(lib: Library, ordered: bool = False) -> DataFrame:
    """Null contents and those of spaces only; filtered before the joins."""
    blank = lib.section_contents.filter(T.is_blank(F.col("content"))).select("section_id", "language", "content")
    out = (
        blank.join(_sections(lib), F.col("section_id") == F.col("s_id"))
        .join(_chapters(lib), F.col("s_chapter_id") == F.col("c_id"))
        .join(_books(lib), F.col("c_book_id") == F.col("b_id"))
        .select("book_sort", _or("book_zh_title", T.NO_NAME, "book_name_zh"), _or("book_en_title", T.MISSING, "book_name_en"), "chapter_sort", F.col("section_sort").alias("verse_sort"), "language", _or("content", "NULL", "content_preview"))
    )
    return out.orderBy("book_sort", "chapter_sort", "verse_sort", "language") if ordered else out


def spot_check_keys(lib: Library, keys: DataFrame, ordered: bool = False) -> DataFrame:
    """``keys``: book_sort, chapter_sort, verse_sort, resolution_method, cross_ref_source.

    Keys without a section are left out, as inner joins have it.
    """
    places = (
        keys.join(lib.books.select(F.col("id").alias("b_id"), F.col("sort").alias("b_sort")), F.col("book_sort") == F.col("b_sort"))
        .join(_chapters(lib).withColumnRenamed("chapter_sort", "c_sort"), (F.col("c_book_id") == F.col("b_id")) & (F.col("c_sort") == F.col("chapter_sort")))
        .join(_sections(lib), (F.col("s_chapter_id") == F.col("c_id")) & (F.col("section_sort") == F.col("verse_sort")))
    )
    named = _paired(_paired(places, "b_id", lib.book_contents, "book_id", "book", "title"), "s_id", lib.section_contents, "section_id", "section", "content")
    preview = lambda c, name: F.left(F.coalesce(F.col(c), F.lit(T.MISSING)), F.lit(60)).alias(name)
    out = named.select(
        "book_sort",
        _or("book_zh_title", T.NO_NAME, "book_name_zh"),
        _or("book_en_title", T.MISSING, "book_name_en"),
        "chapter_sort",
        "verse_sort",
        "resolution_method",
        F.nullif(F.col("cross_ref_source"), F.lit("")).alias("cross_ref_source"),
        preview("section_zh_content", "chinese_content"),
        preview("section_en_content", "english_content"),
        F.when(T.is_blank(F.col("section_en_content")), T.EMPTY).otherwise("OK").alias("english_status"),
    )
    return out.orderBy("book_sort", "chapter_sort", "verse_sort") if ordered else out

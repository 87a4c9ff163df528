"""Specifications: expected counts, prefix sums, work lists and what is left of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions import text as T
from lectern.functions.catalogue import NEW_FROM, books


def spec_rows(spec: DataFrame) -> DataFrame:
    """(number, position, verses): counts in order of the chapter that each key names.

    Gaps between chapters shift later ones, as counts are stored by order. Bad keys raise.
    """
    entries = spec.select(F.explode("books").alias("b")).select("b.number", F.explode("b.verses_per_chapter").alias("key", "verses"))
    chapter = T.spec_chapter(F.col("key"))
    chapter = F.when(chapter.isNull(), F.raise_error(F.concat(F.lit("bad key: "), "key")).cast("int")).otherwise(chapter)
    order = Window.partitionBy("number").orderBy(F.col("chapter"))
    return entries.withColumn("chapter", chapter).select("number", F.row_number().over(order).alias("position"), "verses")


def assert_same_books(zh: DataFrame, en: DataFrame) -> None:
    a, b = (x.select(F.sum(F.size("books"))).first()[0] or 0 for x in (zh, en))
    if not a:
        raise ValueError("no books")
    if a != b:
        raise ValueError(f"different book counts: {a} and {b}")


def assert_catalogue(spec: DataFrame) -> None:
    """A specification must have as many books as the catalogue."""
    found, want = spec.select(F.sum(F.size("books"))).first()[0] or 0, len(books())
    if found != want:
        raise ValueError(f"specification has {found} books, the catalogue {want}; build it again")


def verse_bound(rows: DataFrame, number: Column, chapter: Column) -> DataFrame:
    """The expected count of one chapter; raises where it is out of range."""
    found = rows.filter((F.col("number") == number) & (F.col("position") == chapter))
    return found.agg(F.max("verses").alias("verses")).select(F.when(F.col("verses").isNull(), F.raise_error(F.lit("chapter out of range")).cast("int")).otherwise(F.col("verses")).alias("verses"))


_UUID = "^(?:urn:uuid:|\\{)?[0-9A-Fa-f]{8}(-?)[0-9A-Fa-f]{4}\\1[0-9A-Fa-f]{4}\\1[0-9A-Fa-f]{4}\\1[0-9A-Fa-f]{12}\\}?$"


def request_contexts(raw: DataFrame) -> DataFrame:
    """What a request for a chapter page carries as text, read and checked before anything is written.

    ``raw``: book_id, book_index, chapter_sort, max_verses, lang, all strings; other columns are kept. ``error`` tells
    the first fault; the numbers of rows with one are null.
    """
    text = lambda c: T.trim_u(F.coalesce(F.col(c), F.lit("")))
    number = lambda c: F.when(text(c).rlike(r"^[+-]?[0-9]+$"), text(c).try_cast("long"))
    bad = lambda c, least: F.coalesce(number(c) < least, F.lit(True))
    error = (
        F.when(text("book_id") == "", "missing book_id")
        .when(~text("book_id").rlike(_UUID), "invalid book_id")
        .when(bad("book_index", 0), "invalid book_index")
        .when(bad("chapter_sort", 1), "invalid chapter_sort")
        .when(bad("max_verses", 1), "invalid max_verses")
        .when(~text("lang").isin(*T.LANGUAGES), "unsupported language")
    )
    fields = ("book_id", "book_index", "chapter_sort", "max_verses", "lang")
    own = raw.select("*", error.alias("error"))
    read = [F.when(F.col("error").isNull(), number(c)).alias(c) if c in fields[1:4] else text(c).alias(c) for c in fields]
    return own.select(*(c for c in raw.columns if c not in fields), *read, "error")


def verse_bounds(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (number, position) with the expected count of each chapter, or an error where there is none."""
    known = rows.select("number", "position", "verses")
    books_ = known.groupBy("number").agg(F.max("position").alias("chapters"))
    found = wanted.join(known, ["number", "position"], "left").join(books_, "number", "left")
    error = F.when(F.col("chapters").isNull(), "book out of range").when(F.col("verses").isNull(), "chapter out of range")
    return found.select(*wanted.columns, "verses", error.alias("error"))


def global_starts(counted: DataFrame) -> DataFrame:
    """(book_sort, total_chapters, start): the running number of each book's first chapter.

    The window has one row per book and no partition; the catalogue is a closed list.
    """
    before = Window.orderBy("book_sort").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select("book_sort", "total_chapters", (1 + F.coalesce(F.sum("total_chapters").over(before), F.lit(0))).cast("long").alias("start"))


def starts_at_scale(books: DataFrame, width: int = 4096) -> DataFrame:
    """The same without a single ordered partition: sums of ranges of keys first, then within them."""
    books = books.withColumn("range", F.floor(F.col("book_sort") / width))
    totals = books.groupBy("range").agg(F.sum("total_chapters").alias("n"))
    before = totals.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))
    inside = Window.partitionBy("range").orderBy("book_sort").rowsBetween(Window.unboundedPreceding, -1)
    out = books.join(before, "range")
    return out.select("book_sort", "total_chapters", (1 + F.col("before") + F.coalesce(F.sum("total_chapters").over(inside), F.lit(0))).cast("long").alias("start"))


def work_items(books: DataFrame, chosen: list[int] | None = None) -> DataFrame:
    """(language, book_sort, chapter_sort) for every chapter of the chosen books in both languages."""
    if chosen:
        books = books.filter(F.col("book_sort").isin(*sorted(set(chosen))))
    chapters = books.filter("total_chapters > 0").select("*", F.explode(F.sequence(F.lit(1), F.col("total_chapters"))).alias("chapter_sort"))
    return chapters.select(F.explode(F.array(*map(F.lit, T.LANGUAGES))).alias("language"), *[c for c in chapters.columns if c != "total_chapters"])


def remaining(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work that no completed row matches."""
    return work.join(done.select(*keys).distinct(), keys, "left_anti")


def zipped(en: DataFrame, zh: DataFrame, key: str = "pos") -> DataFrame:
    """Two lists side by side by position; raises where their lengths differ."""
    both = en.join(zh, key, "full")
    whole = F.col("en_title").isNotNull() & F.col("zh_title").isNotNull()
    return both.select(key, F.when(whole, F.col("en_title")).otherwise(F.raise_error(F.lit("lists of different length"))).alias("en_title"), "zh_title")


def testament_summary(books: DataFrame) -> DataFrame:
    """Totals of both testaments: books, chapters and verses of each."""
    old = F.col("book_sort") < NEW_FROM
    part = lambda cond, value: F.coalesce(F.sum(F.when(cond, value)), F.lit(0)).cast("long")
    names = {"books": F.lit(1), "chapters": F.col("total_chapters"), "verses": F.col("total_verses")}
    return books.agg(*(part(cond, v).alias(f"{tag}_{n}") for tag, cond in (("old", old), ("new", ~old), ("all", F.lit(True))) for n, v in names.items()))


def verses_map(counts: DataFrame) -> DataFrame:
    """From (book_sort, chapter_sort, verses) one map per book with keys such as 01-[31]."""
    entry = F.struct(T.spec_key(F.col("chapter_sort"), F.col("verses")).alias("key"), F.col("verses").alias("value"))
    return counts.groupBy("book_sort").agg(F.map_from_entries(F.collect_list(entry)).alias("verses_per_chapter"), F.count("*").cast("int").alias("total_chapters"), F.sum("verses").cast("int").alias("total_verses"))

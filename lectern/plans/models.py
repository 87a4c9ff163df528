"""The six tables laid over the driver's tables, at scale (T) and with text (C)."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import text as T
from lectern.functions.ids import make_id, natural_key
from lectern.schemas import Library


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _per_language(df: DataFrame, keep: dict[str, Column]) -> DataFrame:
    """A copy of each row per language whose condition holds."""
    named = F.array(*(F.when(c, F.lit(lang)) for lang, c in keep.items()))
    return df.select("*", F.explode(F.array_compact(named)).alias("language"))


def t_model(spark: SparkSession, sf_dir: str, salt: str = "", surrogate: bool = True) -> Library:
    """Customers, their orders and the distinct lines of these, with gaps at every level.

    Without ``surrogate`` the ids are the natural keys, which MD5 only renames: plans that return no ids give the
    same rows, and their shuffles carry a few digits instead of 32 characters that do not compress.
    """
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("c"), "c_name")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("o"), F.col("o_custkey").alias("c"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("n"), "l_linestatus")
    name = partial(make_id, salt=salt) if surrogate else natural_key
    book, chapter, section = name("book", F.col("c") + 1), name("chapter", F.col("o") + 1), name("section", F.col("o") + 1, F.col("n"))
    named = _per_language(customer, {T.CHINESE: F.col("c") % 7 != 0, T.ENGLISH: F.col("c") % 5 != 0})
    titled = _per_language(orders, {T.CHINESE: F.col("o") % 11 != 0, T.ENGLISH: F.col("o") % 13 != 0})
    language = F.when(F.col("l_linestatus") == "F", T.CHINESE).otherwise(T.ENGLISH)
    content = F.when((F.col("o") + F.col("n")) % 50 == 0, "  ").otherwise(F.concat_ws(".", "o", "n", "language"))
    written = lines.withColumn("language", language).select("o", "n", "language").distinct()
    return Library(
        customer.select(book.alias("id"), (F.col("c") + 1).cast("int").alias("sort")),
        named.select(
            name("book_content", F.col("c") + 1, F.col("language")).alias("id"),
            book.alias("book_id"),
            "language",
            F.when(F.col("language") == T.CHINESE, F.concat(F.lit("書 "), "c_name")).otherwise(F.col("c_name")).alias("title"),
        ),
        orders.select(chapter.alias("id"), book.alias("book_id"), (F.col("o") + 1).cast("int").alias("sort")),
        titled.select(name("chapter_content", F.col("o") + 1, F.col("language")).alias("id"), chapter.alias("chapter_id"), "language", T.chapter_title(F.col("language"), F.col("o") + 1).alias("title")),
        # dealt by order before they are made distinct, so that their orders meet them where they lie
        lines.select("o", "n").repartition("o").distinct().join(orders, "o").select(section.alias("id"), book.alias("book_id"), chapter.alias("chapter_id"), F.col("n").cast("int").alias("sort")),
        written.select(
            name("section_content", F.col("o") + 1, F.col("n"), F.col("language")).alias("id"),
            section.alias("section_id"),
            "language",
            T.section_title(F.col("language"), F.col("n")).alias("title"),
            content.alias("content"),
            F.when(F.col("n") % 3 != 0, "").alias("sub_title"),
        ),
    )


def c_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as book, chapter and section numbers, with the role as raw language."""
    turns = table(spark, sf_dir, "conversations")
    raw = F.when(F.col("role") == "user", "  Chinese ").when(F.col("role") == "assistant", "ENGLISH").otherwise(F.col("role"))
    return turns.select(
        F.floor(F.col("conv_id") / 10 + 1).cast("int").alias("book_sort"),
        (F.col("conv_id") + 1).cast("int").alias("chapter_sort"),
        F.floor(F.col("turn") / 2 + 1).cast("int").alias("section_sort"),
        raw.alias("raw_language"),
        F.col("text").alias("content"),
    )


def c_model(spark: SparkSession, sf_dir: str) -> Library:
    """Conversations in blocks of ten, their turns in pairs, and the texts of both speakers."""
    rows = c_rows(spark, sf_dir).withColumn("language", T.language(F.col("raw_language"))).filter("language IS NOT NULL")
    book, chapter = make_id("book", F.col("book_sort")), make_id("chapter", F.col("book_sort"), F.col("chapter_sort"))
    section = make_id("section", F.col("book_sort"), F.col("chapter_sort"), F.col("section_sort"))
    both = F.explode(F.array(F.lit(T.CHINESE), F.lit(T.ENGLISH))).alias("language")
    books = rows.select("book_sort").distinct()
    chapters = rows.select("book_sort", "chapter_sort").distinct()
    name = F.when(F.col("language") == T.CHINESE, F.format_string("卷%d", "book_sort")).otherwise(F.format_string("Book %d", "book_sort"))
    written = rows.groupBy("book_sort", "chapter_sort", "section_sort", "language").agg(F.min("content").alias("content"))
    return Library(
        books.select(book.alias("id"), F.col("book_sort").alias("sort")),
        books.select("book_sort", both).select(make_id("book_content", F.col("book_sort"), F.col("language")).alias("id"), book.alias("book_id"), "language", name.alias("title")),
        chapters.select(chapter.alias("id"), book.alias("book_id"), F.col("chapter_sort").alias("sort")),
        chapters.select("book_sort", "chapter_sort", both).select(
            make_id("chapter_content", F.col("book_sort"), F.col("chapter_sort"), F.col("language")).alias("id"), chapter.alias("chapter_id"), "language", T.chapter_title(F.col("language"), F.col("chapter_sort")).alias("title")
        ),
        rows.select("book_sort", "chapter_sort", "section_sort").distinct().select(section.alias("id"), book.alias("book_id"), chapter.alias("chapter_id"), F.col("section_sort").alias("sort")),
        written.select(
            make_id("section_content", F.col("book_sort"), F.col("chapter_sort"), F.col("section_sort"), F.col("language")).alias("id"),
            section.alias("section_id"),
            "language",
            T.section_title(F.col("language"), F.col("section_sort")).alias("title"),
            "content",
            F.lit("").alias("sub_title"),
        ),
    )

"""From verse records to the rows of the six tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern import schemas
from lectern.functions import text as T
from lectern.functions.ids import make_id
from lectern.operators.merge import accepted, checked
from lectern.operators.store import Store
from lectern.sources.files import flatten

#: What identifies a row of each table, and what an upsert compares (nothing: get-or-create).
RULES = {
    "books": (schemas.BOOKS, ["sort"], []),
    "chapters": (schemas.CHAPTERS, ["book_id", "sort"], []),
    "sections": (schemas.SECTIONS, ["book_id", "chapter_id", "sort"], []),
    "book_contents": (schemas.BOOK_CONTENTS, ["book_id", "language"], ["title"]),
    "chapter_contents": (schemas.CHAPTER_CONTENTS, ["chapter_id", "language"], ["title"]),
    "section_contents": (schemas.SECTION_CONTENTS, ["section_id", "language"], ["title", "content", "sub_title"]),
}


def prepared(records: DataFrame, salt: str = "") -> DataFrame:
    """Records with ids, titles, normalised texts and a reject reason; one row per key, the last.

    ``records``: lang, book_sort, chapter_sort, verse_sort, content, and optionally sub_title,
    book_name and ``pos``, their place in the source.
    """
    if "book_name" not in records.columns:
        records = records.withColumn("book_name", F.lit(None).cast("string"))
    if "sub_title" not in records.columns:
        records = records.withColumn("sub_title", F.lit(""))
    if "pos" not in records.columns:
        records = records.withColumn("pos", F.coalesce(F.col("crawled_at"), F.lit("1970-01-01").cast("timestamp")) if "crawled_at" in records.columns else F.lit(0))
    lang = T.language(F.col("lang"))
    whole = F.least("book_sort", "chapter_sort", "verse_sort") > 0
    complete = F.col("book_sort").isNotNull() & F.col("chapter_sort").isNotNull() & F.col("verse_sort").isNotNull()
    rows = records.withColumns(
        {
            "section_id": F.when(complete, make_id("section", F.col("book_sort"), F.col("chapter_sort"), F.col("verse_sort"), salt=salt)),
            "sort": F.when(whole, F.col("verse_sort")).otherwise(0),
            "raw_language": F.col("lang"),
            "title": T.section_title(lang, F.coalesce("verse_sort", F.lit(0))),
        }
    )
    return checked(rows).select("book_sort", "chapter_sort", "verse_sort", "section_id", "sort", "language", "title", "content", "sub_title", "book_name", "pos", "reject_reason")


def tables(rows: DataFrame, salt: str = "") -> dict[str, DataFrame]:
    """What the accepted of ``prepared`` rows hold of each table."""
    rows = accepted(rows)
    names = book_titles(rows.select("book_sort", "language", F.col("book_name").alias("title"), "pos"), salt)
    keys = ["book_sort", "chapter_sort", "verse_sort", "section_id", "language"]
    rows = rows.groupBy(*keys).agg(F.max_by(F.struct("title", "content", "sub_title"), F.struct("pos", "content")).alias("last")).select(*keys, "last.*")
    book, chapter = make_id("book", F.col("book_sort"), salt=salt), make_id("chapter", F.col("book_sort"), F.col("chapter_sort"), salt=salt)
    chapters = rows.select("book_sort", "chapter_sort").distinct()
    in_language = rows.select("book_sort", "chapter_sort", "language").distinct()
    return {
        "books": rows.select("book_sort").distinct().select(book.alias("id"), F.col("book_sort").alias("sort")),
        "chapters": chapters.select(chapter.alias("id"), book.alias("book_id"), F.col("chapter_sort").alias("sort")),
        "sections": rows.select("book_sort", "chapter_sort", "verse_sort", "section_id").distinct().select(F.col("section_id").alias("id"), book.alias("book_id"), chapter.alias("chapter_id"), F.col("verse_sort").alias("sort")),
        "book_contents": names,
        "chapter_contents": in_language.select(make_id("chapter_content", F.col("book_sort"), F.col("chapter_sort"), F.col("language"), salt=salt).alias("id"), chapter.alias("chapter_id"), "language", T.chapter_title(F.col("language"), F.col("chapter_sort")).alias("title")),
        "section_contents": rows.select(make_id("section_content", F.col("section_id"), F.col("language"), salt=salt).alias("id"), "section_id", "language", "title", "content", "sub_title"),
    }


def book_titles(names: DataFrame, salt: str = "") -> DataFrame:
    """Rows of book_contents from (book_sort, language, title, pos); blank names go, the last one counts."""
    book = make_id("book", F.col("book_sort"), salt=salt)
    named = names.withColumn("title", T.trim_u(F.col("title"))).filter("title <> ''")
    named = named.groupBy("book_sort", "language").agg(F.max_by("title", F.struct("pos", "title")).alias("title"))
    return named.select(make_id("book_content", F.col("book_sort"), F.col("language"), salt=salt).alias("id"), book.alias("book_id"), "language", "title")


def load(store: Store, records: DataFrame, salt: str = "", strict: bool = False) -> dict[str, dict[str, int]]:
    """Merge records into the store; returns the actions of each table, and the rejected rows.

    The records are prepared once; the six merges, which touch a table each, run beside each other.
    ``strict``: records of which none can be written are an error.
    """
    with store.once(prepared(records, salt)) as rows:
        rejects = rows.filter("reject_reason IS NOT NULL").count()
        with ThreadPoolExecutor(len(RULES)) as pool:
            merges = {name: pool.submit(store.merge, name, RULES[name][0], incoming, *RULES[name][1:]) for name, incoming in tables(rows, salt).items()}
            done = {name: one.result() for name, one in merges.items()}
    if strict and rejects and not sum(done["section_contents"].values()):
        raise ValueError(f"no verse written, {rejects} rejected")
    return done | {"rejected": {"rows": rejects}}


def load_documents(store: Store, documents: DataFrame, salt: str = "") -> dict[str, dict[str, int]]:
    """Nested documents into the store; documents with books of which no verse can be written are an error."""
    verses = flatten(documents).withColumnRenamed("language", "lang")
    done = load(store, verses, salt, strict=True)
    if not sum(done["section_contents"].values()) and not documents.filter(F.size("books") > 0).isEmpty():
        raise ValueError("no verse written from documents with books")
    return done


def load_titles(store: Store, books: DataFrame, salt: str = "") -> dict[str, int]:
    """Names of books: (book_sort, language, title)."""
    rows = book_titles(books.select("book_sort", "language", "title", F.lit(0).alias("pos")), salt)
    return store.merge("book_contents", RULES["book_contents"][0], rows, *RULES["book_contents"][1:])

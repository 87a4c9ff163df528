"""Re-keying: keep references by natural key, empty the tables, resolve them to new ids, verify.

References are tables (id, ref): what a row of another application points at.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern import schemas
from lectern.operators.merge import get_or_create
from lectern.operators.store import Store
from lectern.schemas import Library

#: Source tables, and the column of each that refers to a section.
SOURCES = {"general_bibles": "bible_id", "general_template_bibles": "bible_id", "devotion_bibles": "bible_section_id"}


def coordinates(lib: Library) -> DataFrame:
    """Every section's id with its natural key."""
    books = lib.books.select(F.col("id").alias("book_id"), F.col("sort").alias("book_sort"))
    chapters = lib.chapters.select(F.col("id").alias("chapter_id"), F.col("sort").alias("chapter_sort"))
    return lib.sections.join(chapters, "chapter_id").join(books, "book_id").select(F.col("id").alias("section_id"), "book_sort", "chapter_sort", F.col("sort").alias("section_sort"))


def every_reference(references: dict[str, DataFrame]) -> DataFrame:
    """(source_table, source_id, old_section_id) of all tables."""
    every = None
    for name, refs in references.items():
        own = refs.select(F.lit(name).alias("source_table"), F.col("id").alias("source_id"), F.col(SOURCES[name]).alias("old_section_id"))
        every = own if every is None else every.unionByName(own)
    return every


def backup(lib: Library, references: dict[str, DataFrame], before: DataFrame | None = None) -> DataFrame:
    """Natural keys of all references; orphans have none. Rows of ``before`` win: first snapshot."""
    rows = every_reference(references).join(coordinates(lib), F.col("old_section_id") == F.col("section_id")).drop("section_id")
    return rows if before is None else before.unionByName(get_or_create(before, rows, ["source_table", "source_id"]))


def _same(section: Column) -> Column:
    return section


def _new_ids(lib: Library, saved: DataFrame) -> DataFrame:
    """(source_table, source_id, new_id) of the saved references whose place is known."""
    own = saved.select("source_table", "source_id", "book_sort", "chapter_sort", "section_sort")
    return own.join(coordinates(lib), ["book_sort", "chapter_sort", "section_sort"]).select("source_table", "source_id", F.col("section_id").alias("new_id"))


def restored(lib: Library, references: dict[str, DataFrame], saved: DataFrame) -> DataFrame:
    """(source_table, id, ref) of all references in one pass: moved to the new ids, or as they were where
    their place is gone."""
    joined = every_reference(references).join(_new_ids(lib, saved), ["source_table", "source_id"], "left")
    return joined.select("source_table", F.col("source_id").alias("id"), F.coalesce("new_id", "old_section_id").alias("ref"))


def rekeyed(old: Library, new: Library, references: dict[str, DataFrame], old_id: Callable[[Column], Column] = _same, new_id: Callable[[Column], Column] = _same) -> DataFrame:
    """What ``restored`` gives for a ``backup`` that is not kept, where both libraries are there at once.

    Old ids meet new ones by natural key first, so that a reference is shuffled once. ``old_id`` and ``new_id`` make
    the ids that references hold of those in the libraries, after what is joined by other keys.
    """
    place = ["book_sort", "chapter_sort", "section_sort"]
    there = coordinates(new).withColumnRenamed("section_id", "new_section")
    moved = coordinates(old).join(there, place).select(old_id(F.col("section_id")).alias("section_id"), "new_section")
    joined = every_reference(references).join(moved, F.col("old_section_id") == F.col("section_id"), "left")
    ref = F.when(F.col("new_section").isNull(), F.col("old_section_id")).otherwise(new_id(F.col("new_section")))
    return joined.select("source_table", F.col("source_id").alias("id"), ref.alias("ref"))


def restore(lib: Library, refs: DataFrame, name: str, saved: DataFrame) -> DataFrame:
    """One table's rows with all columns, moved in the same way."""
    new = _new_ids(lib, saved.filter(F.col("source_table") == name)).select("source_id", "new_id")
    column = SOURCES[name]
    joined = refs.join(new, F.col("id") == F.col("source_id"), "left")
    return joined.select(*(F.coalesce("new_id", column).alias(c) if c == column else F.col(c) for c in refs.columns))


def orphans(lib: Library, refs: DataFrame, name: str) -> DataFrame:
    """References to no section; null references count."""
    return refs.join(lib.sections.select(F.col("id").alias(SOURCES[name])), SOURCES[name], "left_anti")


def orphan_counts(lib: Library, references: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, refs in references.items():
        one = orphans(lib, refs, name).agg(F.count("*").alias("orphans")).select(F.lit(name).alias("source_table"), "orphans")
        out = one if out is None else out.union(one)
    return out


_TABLES = {"books": schemas.BOOKS, "book_contents": schemas.BOOK_CONTENTS, "chapters": schemas.CHAPTERS, "chapter_contents": schemas.CHAPTER_CONTENTS, "sections": schemas.SECTIONS, "section_contents": schemas.SECTION_CONTENTS}


class Migration:
    """The steps over a store, each with the number of rows it touched."""

    def __init__(self, store: Store):
        self.store = store

    def library(self) -> Library:
        return Library(**{name: self.store.read(name, schema) for name, schema in _TABLES.items()})

    def save(self, references: dict[str, DataFrame]) -> dict[str, int]:
        before = self.store.read("orphan_refs_backup", schemas.BACKUP)
        fresh = get_or_create(before, backup(self.library(), references), ["source_table", "source_id"])
        self.store.merge("orphan_refs_backup", schemas.BACKUP, fresh, ["source_table", "source_id"], [])
        saved = self.store.read("orphan_refs_backup", schemas.BACKUP)
        found = {r["source_table"]: r["n"] for r in saved.groupBy("source_table").agg(F.count("*").alias("n")).collect()}
        return {name: found.get(name, 0) for name in references}

    def truncate(self) -> None:
        for name, schema in _TABLES.items():
            self.store.truncate(name, schema)

    def restore(self, references: dict[str, DataFrame]) -> dict[str, DataFrame]:
        saved = self.store.read("orphan_refs_backup", schemas.BACKUP)
        return {name: restore(self.library(), refs, name, saved) for name, refs in references.items()}

    def verify(self, references: dict[str, DataFrame]) -> dict[str, int]:
        return {r["source_table"]: r["orphans"] for r in orphan_counts(self.library(), references).collect()} if references else {}

    def clean_up(self, references: dict[str, DataFrame]) -> bool:
        """Drop the backup, but only if nothing is orphaned."""
        if any(self.verify(references).values()):
            return False
        self.store.drop("orphan_refs_backup")
        return True

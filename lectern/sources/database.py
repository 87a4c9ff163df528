"""The six tables in a relational database: read in partitions, with Spark's filters in the database's query.

A table is read by ranges of a numeric column, one query per range; the bounds are asked for once, by an aggregate that
the database computes. Filters that the database can test, and the columns that are used, go into its query.
Writes go through one connection per partition, in batches.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lectern import schemas
from lectern.schemas import Library

#: The tables, each with the column whose ranges its partitions are; contents have none, and are read by one query.
SPLIT = {"books": "sort", "chapters": "sort", "sections": "sort", "book_contents": None, "chapter_contents": None, "section_contents": None}
SCHEMAS = {
    "books": schemas.BOOKS,
    "book_contents": schemas.BOOK_CONTENTS,
    "chapters": schemas.CHAPTERS,
    "chapter_contents": schemas.CHAPTER_CONTENTS,
    "sections": schemas.SECTIONS,
    "section_contents": schemas.SECTION_CONTENTS,
}


#: Characters of an id, a language or a title; databases compare and index short texts only.
SHORT = 1024


def column_types(table: str) -> str:
    """How the short texts of one of the six tables are to be created."""
    columns = (x.split() for x in SCHEMAS[table].split(", "))
    return ", ".join(f"{c} VARCHAR({SHORT})" for c, kind in columns if kind == "string" and c not in ("content", "sub_title"))


@dataclass(frozen=True)
class Database:
    """Where the tables are. ``partitions``: queries that run beside each other; ``fetch``: rows in a round trip."""

    url: str
    driver: str
    partitions: int = 8
    fetch: int = 10_000
    options: tuple[tuple[str, str], ...] = ()

    def _options(self, table: str) -> dict[str, str]:
        return {"url": self.url, "driver": self.driver, "dbtable": table, "fetchsize": str(self.fetch), "batchsize": str(self.fetch), **dict(self.options)}

    def bounds(self, spark: SparkSession, table: str, column: str) -> tuple[int, int] | None:
        quoted = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.url).quoteIdentifier(column)
        query = f"(SELECT min({quoted}) AS a, max({quoted}) AS b FROM {table}) t"
        low, high = spark.read.format("jdbc").options(**self._options(query)).load().first()
        return None if low is None else (int(low), int(high))

    def read(self, spark: SparkSession, table: str, column: str | None = None, schema: str | None = None) -> DataFrame:
        """A table; with a numeric ``column``, in ranges of it (rows without a value are in the first)."""
        reader = spark.read.format("jdbc").options(**self._options(table))
        if schema:
            reader = reader.option("customSchema", schema)
        found = self.bounds(spark, table, column) if column else None
        if found and found[1] > found[0]:
            reader = reader.options(partitionColumn=column, lowerBound=found[0], upperBound=found[1] + 1, numPartitions=self.partitions)
        return reader.load()

    def write(self, df: DataFrame, table: str, types: str | None = None, mode: str = "errorifexists") -> None:
        types = types or (column_types(table) if table in SCHEMAS else None)
        writer = df.repartition(self.partitions).write.format("jdbc").mode(mode).options(**self._options(table))
        (writer.option("createTableColumnTypes", types) if types else writer).save()

    def library(self, spark: SparkSession) -> Library:
        """The six tables, to be queried like any others."""
        return Library(**{name: self.read(spark, name, column).select(*(x.split()[0] for x in SCHEMAS[name].split(", "))) for name, column in SPLIT.items()})

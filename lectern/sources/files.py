"""JSON documents, JSON lines and specifications: readers with fixed schemas, and their writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lectern import schemas
from lectern.functions import text as T

#: Bytes that a nested document and a line may have.
MAX_DOCUMENT, MAX_LINE = 64 << 20, 1 << 20
_BAD = "_bad"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Nested documents, one per file of the folder and of those below it; a file over ``MAX_DOCUMENT``
    raises when it is read."""
    found = spark.read.schema(schemas.DOCUMENT).option("multiLine", True).option("recursiveFileLookup", True).json(path).select("*", "_metadata.file_size")
    size = F.when(F.col("file_size") > MAX_DOCUMENT, F.raise_error(F.lit("document too large")).cast("long")).otherwise(F.col("file_size"))
    return found.withColumn("file_size", size)


def flatten(documents: DataFrame) -> DataFrame:
    """One row per verse; ``pos`` is its place in the document. Empty books and chapters vanish."""
    books = documents.select("language", F.posexplode("books").alias("book_pos", "b"))
    chapters = books.select("language", "book_pos", "b.book_sort", "b.book_name", F.col("b.book_usfm").alias("usfm"), F.posexplode("b.chapters").alias("chapter_pos", "c"))
    verses = chapters.select("language", "book_pos", "book_sort", "book_name", "usfm", "chapter_pos", "c.chapter_sort", F.posexplode("c.verses").alias("verse_pos", "v"))
    pos = F.struct("book_pos", "chapter_pos", "verse_pos").alias("pos")
    text = lambda c: F.coalesce(F.col(f"v.{c}"), F.lit("")).alias(c)
    return verses.select("language", "book_sort", "book_name", "usfm", "chapter_sort", "v.verse_sort", text("sub_title"), text("content"), text("note"), text("cross_ref"), pos)


def nested(verses: DataFrame, per_book: bool = False) -> DataFrame:
    """Documents of books of chapters of verses, each in order: one per language, or one per book.

    A document is one row. Those of a language hold all its books, which suits one corpus; where a
    language has more text than a row may hold, write a document per book.
    """
    optional = lambda c: F.nullif(F.col(c), F.lit("")).alias(c)
    verse = F.struct("verse_sort", optional("sub_title"), "content", optional("note"), optional("cross_ref"))
    in_order = lambda c: F.transform(F.array_sort(F.collect_list(c)), lambda x: x["item"])
    item = lambda key, value: F.struct(F.col(key).alias("key"), value.alias("item"))
    chapters = verses.groupBy("language", "book_sort", "book_name", "usfm", "chapter_sort").agg(in_order(item("verse_sort", verse)).alias("verses"))
    books = chapters.groupBy("language", "book_sort", "book_name", "usfm").agg(in_order(item("chapter_sort", F.struct("chapter_sort", "verses"))).alias("chapters"))
    book = F.struct("book_sort", "book_name", F.col("usfm").alias("book_usfm"), "chapters")
    if per_book:
        return books.select("language", F.array(book).alias("books"))
    return books.groupBy("language").agg(in_order(item("book_sort", book)).alias("books"))


def document_totals(documents: DataFrame) -> DataFrame:
    """Books, chapters and verses of each language, summed over its documents."""
    chapters = F.flatten(F.transform("books", lambda b: b["chapters"]))
    verses = F.aggregate(F.transform(chapters, lambda c: F.size(c["verses"])), F.lit(0), lambda a, n: a + n)
    each = documents.select("language", F.size("books").cast("long").alias("books"), F.size(chapters).cast("long").alias("chapters"), verses.cast("long").alias("verses"))
    return each.groupBy("language").agg(*(F.sum(c).alias(c) for c in ("books", "chapters", "verses")))


def write_documents(documents: DataFrame, path: str) -> None:
    """One JSON document per row, each in a file of its own, as ``read_documents`` expects them.

    The commit protocol makes the write whole or absent.
    """
    stamped = documents.withColumn("crawled_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    text = stamped.select(F.to_json(F.struct("*"), {"pretty": "true"}).alias("value"), F.concat_ws("-", "language", F.monotonically_increasing_id()).alias("document"))
    text.write.mode("overwrite").partitionBy("document").option("lineSep", "\n").text(path)


def append_records(records: DataFrame, path: str) -> None:
    records.write.mode("append").json(path)


def parse_records(lines: DataFrame, column: str = "value") -> DataFrame:
    """JSON text to records and the column _bad: the text of lines that are no record.

    A line over ``MAX_LINE`` bytes raises.
    """
    schema = StructType.fromDDL(f"{schemas.RECORD}, {_BAD} string")
    line = F.when(F.octet_length(column) > MAX_LINE, F.raise_error(F.lit("line too long"))).otherwise(F.col(column))
    return lines.select(F.from_json(line, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}).alias("r")).select("r.*")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return parse_records(spark.read.text(path))


def good(records: DataFrame) -> DataFrame:
    return records.filter(F.col(_BAD).isNull() & F.col("passage_id").isNotNull()).drop(_BAD)


def bad(records: DataFrame) -> DataFrame:
    return records.filter(F.col(_BAD).isNotNull() | F.col("passage_id").isNull())


def read_completed(spark: SparkSession, path: str) -> DataFrame:
    """The keys of finished work: two of eight fields are decoded; no file means none is finished."""
    schema = "passage_id string, lang string"
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path).filter("passage_id IS NOT NULL AND lang IS NOT NULL").distinct()


def completed_or_fresh(spark: SparkSession, path: str, warn=print) -> DataFrame:
    """The same, read at once; a file that cannot be read is reported and counts as no work done."""
    try:
        found = read_completed(spark, path).persist()
        found.count()
    except Exception as e:  # whatever the storage raises: work done twice is merged by key
        warn(f"could not read {path}: {e}; starting afresh")
        return spark.createDataFrame([], "passage_id string, lang string")
    return found


def read_spec(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SPEC).option("multiLine", True).option("mode", "FAILFAST").json(path)


def write_spec(books: DataFrame, path: str, title: str, version: str, lang: str) -> None:
    """``books``: book_sort, name, testament, total_chapters, total_verses, verses_per_chapter."""
    tag = "zh" if lang == T.CHINESE else "en"
    testament = F.col("testament").alias("testament_zh" if tag == "zh" else "testament")
    book = F.struct(F.col("book_sort").alias("number"), testament, F.col("name").alias(f"name_{tag}"), "total_chapters", "total_verses", "verses_per_chapter")
    # a specification is one small document by nature: 66 books
    one = books.agg(F.array_sort(F.collect_list(F.struct("book_sort", book.alias("item"))), lambda a, b: a["book_sort"] - b["book_sort"]).alias("items"))  # maps have no order
    total = lambda c: F.aggregate(F.col("items"), F.lit(0), lambda a, x: a + x["item"][c]).alias(c)
    document = F.struct(F.lit(title).alias("title"), F.lit(version).alias("version"), F.struct(F.size("items").alias("total_books"), total("total_chapters"), total("total_verses")).alias("summary"), F.transform("items", lambda x: x["item"]).alias("books"))
    one.select(F.to_json(document, {"pretty": "true"}).alias("value")).write.mode("overwrite").text(path)

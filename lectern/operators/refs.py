"""Cross-reference resolution as a left self-join on the composed key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as T


def resolve_refs(verses: DataFrame, scope: list[str] | None = None) -> DataFrame:
    """Fill the content of rows with a ``cross_ref`` from the row they name.

    ``verses``: pos, usfm, chapter_sort, verse_sort, content, cross_ref, and the columns of ``scope``
    within which references hold (a language). Of several targets the last counts. Missing, blank
    and merged targets give a pointer in brackets. Nothing is resolved twice: targets are read as
    they were before.
    """
    scope = scope or []
    pointing = F.coalesce(F.col("cross_ref"), F.lit("")) != ""
    wanted = verses.filter(pointing).select(*scope, F.col("cross_ref").alias("key")).distinct()
    index = verses.select(*scope, T.ref_key(F.col("usfm"), F.col("chapter_sort"), F.col("verse_sort")).alias("key"), "pos", "content")
    # only named targets are aggregated and joined
    targets = index.join(wanted, [*scope, "key"], "left_semi").groupBy(*scope, "key").agg(F.max_by("content", "pos").alias("target"))
    # only rows that point are joined; the others, of no key, would all meet in one place
    joined = verses.filter(pointing).withColumn("key", F.col("cross_ref")).join(targets, [*scope, "key"], "left")
    usable = F.col("target").isNotNull() & (T.trim_u(F.col("target")) != "") & (F.col("target") != T.MERGED)
    filled = joined.withColumn("content", F.when(usable, F.col("target")).otherwise(T.see(F.col("key")))).select(*verses.columns)
    return verses.filter(~pointing).unionByName(filled)

"""Idempotent writes without a MERGE statement: insert-if-absent and equality-aware upsert.

A merge is planned as a table of actions; ``lectern.operators.store`` keeps the tables that they change.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as T

INSERT, NOOP, UPDATE = "insert", "noop", "update"


def get_or_create(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``incoming`` whose key ``target`` lacks, one per key (the least): what is to be appended."""
    values = [c for c in incoming.columns if c not in keys]
    if values:
        least = incoming.groupBy(*keys).agg(F.min(F.struct(*values)).alias("least"))
        one = least.select(*keys, *(F.col("least").getField(c).alias(c) for c in values))
    else:
        one = incoming.select(*keys).distinct()
    return one.select(*incoming.columns).join(target.select(*keys), keys, "left_anti")


def last_write(incoming: DataFrame, keys: list[str], position: str) -> DataFrame:
    """One row per key: the one with the greatest position in its source."""
    values = [c for c in incoming.columns if c not in (*keys, position)]
    latest = incoming.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col(position)).alias("latest"))
    return latest.select(*keys, *(F.col("latest").getField(c).alias(c) for c in values))


def upsert_actions(target: DataFrame, incoming: DataFrame, keys: list[str], compare: list[str]) -> DataFrame:
    """For each key of ``incoming`` its new values and an action.

    A stored null never equals an incoming value, so it is normalised once and then left alone.
    """
    old = target.select(*keys, *(F.col(c).alias(f"old_{c}") for c in compare), F.lit(True).alias("there"))
    same = reduce(Column.__and__, [F.coalesce(F.col(f"old_{c}") == F.col(c), F.lit(False)) for c in compare])
    action = F.when(F.col("there").isNull(), INSERT).when(same, NOOP).otherwise(UPDATE)
    return incoming.join(old, keys, "left").select(*incoming.columns, action.alias("action"))


def upserted(target: DataFrame, actions: DataFrame, keys: list[str]) -> DataFrame:
    """The target after the actions: untouched rows, then inserted and updated ones."""
    changed = actions.filter(F.col("action") != NOOP)
    kept = target.join(changed.select(*keys), keys, "left_anti")
    return kept.select(*target.columns).unionByName(changed.select(*target.columns))


def counts(actions: DataFrame) -> dict[str, int]:
    found = {r["action"]: r["n"] for r in actions.groupBy("action").agg(F.count("*").alias("n")).collect()}
    return {a: found.get(a, 0) for a in (INSERT, NOOP, UPDATE)}


def checked(rows: DataFrame) -> DataFrame:
    """Content rows with language and texts normalised, and ``reject_reason`` (null: valid).

    Needs the columns section_id, sort, raw_language, title, content, sub_title.
    """
    trimmed = lambda c: T.trim_u(F.coalesce(F.col(c), F.lit("")))
    rows = rows.withColumns({"language": T.language(F.col("raw_language")), "title": trimmed("title"), "content": trimmed("content"), "sub_title": trimmed("sub_title")})
    reason = (
        F.when(F.col("section_id").isNull(), "no id")
        .when(F.col("sort").isNull() | (F.col("sort") <= 0), "sort is not positive")
        .when(F.col("language").isNull(), "unsupported language")
        .when(F.col("title") == "", "blank title")
        .when(F.col("content") == "", "blank content")
        .when(F.octet_length("title") > T.MAX_TITLE, "title too long")
        .when(F.octet_length("content") > T.MAX_CONTENT, "content too long")
        .when(F.octet_length("sub_title") > T.MAX_SUB_TITLE, "sub_title too long")
    )
    return rows.withColumn("reject_reason", reason)


def accepted(rows: DataFrame) -> DataFrame:
    return rows.filter("reject_reason IS NULL")


def rejected(rows: DataFrame) -> DataFrame:
    return rows.filter("reject_reason IS NOT NULL")

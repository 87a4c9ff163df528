"""Deterministic surrogate ids, so that get-or-create needs no look-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def make_id(level: str, *keys: Column, salt: str = "") -> Column:
    """MD5 of the level and its natural key; another ``salt`` gives another generation of ids."""
    return F.md5(F.concat_ws(":", F.lit(salt + level), *(k.cast("string") for k in keys)).cast("binary"))


def natural_key(level: str, *keys: Column) -> Column:
    """What ``make_id`` digests, but for the level: ids of one table are as distinct, and shorter. One key alone stays a number."""
    return keys[0] if len(keys) == 1 else F.concat_ws(":", *(k.cast("string") for k in keys))

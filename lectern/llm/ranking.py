"""What searches over many shards share: rounds of shards, and the best results of many queries at once.

Shards are searched in rounds, a few first and ``WIDER`` times as many in each further one. The k-th best
score of all earlier rounds is a query's floor in the next one, so each round adds a few rows to a query's
results, however many shards there are.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: How many times more shards each round has than the one before.
WIDER = 4
_ROUNDS = 8


def round_of(content: str) -> Column:
    """The round of a shard, by a hash of its content."""
    lot = F.pmod(F.xxhash64(content), F.lit(WIDER**_ROUNDS))
    late = F.lit(0)
    for i in range(1, _ROUNDS + 1):
        late = late + F.when(lot % WIDER**i != 0, 1).otherwise(0)
    return late.cast("int")


def spread(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, each ``sizes`` long from ``first``, end to end."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(first - before, sizes) + np.arange(int(sizes.sum()))


def best(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best of each query, an id once; sorted by query and rank."""
    order = np.lexsort((-scores, ids, query))
    query, ids, scores = query[order], ids[order], scores[order]
    new = np.ones(len(query), bool)
    new[1:] = (query[1:] != query[:-1]) | (ids[1:] != ids[:-1])
    query, ids, scores = query[new], ids[new], scores[new]
    order = np.lexsort((ids, -scores, query))
    query, ids, scores = query[order], ids[order], scores[order]
    kept = np.arange(len(query)) - np.searchsorted(query, query) < k
    return query[kept], ids[kept], scores[kept]


def floors(query: np.ndarray, scores: np.ndarray, k: int, before: np.ndarray) -> np.ndarray:
    """Of sorted results the k-th best score of each query, or what it was before."""
    last = np.flatnonzero(np.arange(len(query)) - np.searchsorted(query, query) == k - 1)
    out = before.copy()
    out[query[last]] = np.maximum(out[query[last]], scores[last])
    return out


def raise_floors(floor: np.ndarray, queries: np.ndarray, found: DataFrame, id_col: str, k: int) -> None:
    """Set each query's floor to the k-th best score found so far: a number for each query of a block."""
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"))
    kth = found.groupBy("query_id", id_col).agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") == k)
    known = kth.select("query_id", "score").toArrow()
    floor[np.searchsorted(queries, known.column("query_id").to_numpy())] = known.column("score").to_numpy()

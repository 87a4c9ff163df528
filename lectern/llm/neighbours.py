"""Operator 2: approximate nearest neighbours by multi-index hashing.

A rotation is learned on a bounded sample (principal axes, then iterative quantization); the signs
of a rotated vector are its binary code. Every shard of rows cuts its codes into substrings of 16
bits and keeps, for each substring, a table from value to rows. A query probes the values that
differ from its own in no bit, then those in one bit, and so on, substring after substring; by the
pigeonhole principle the first r + 1 probes retrieve every code within Hamming radius r, and many
beyond it.

How far to probe is measured, not assumed: some rows of the sample ask the others, and the radius is
the least at which the share ``recall`` of their true neighbours is met. A query whose neighbours are
near stops earlier, once the radius covers, with ``z`` standard deviations, the distance at which a
vector nearer than the k-th one found would have its code (the bits of vectors at angle a, seen from the
centre, differ like coins of chance a / pi); one that has met fewer than k rows goes on. Retrieved
rows whose codes lie within that distance are reranked by the cosine of the original vectors in double
precision.

The index is a table, a row per shard, built once. Queries go out in blocks of bounded size, which
search the shards in rounds that hand on the k-th best score.

Defined results: vectors that are null, zero, hold null or non-finite components, or differ in
length from most of the sample, take no part, and so do null ids; components may be of any size, as
each vector is scaled by a power of two first; rows that share an id are one candidate with its best
score, and a query's own id is no candidate; of several query rows of one id the least vector asks;
equal scores go to the smaller id; with fewer candidates all are returned; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import shared_path, stored, tidy
from lectern.llm.ranking import best, floors, raise_floors, round_of, spread

SCHEMA = "query_id long, vec_id long, score double"
_SHARD = "rows long, ids binary, vectors binary, codes binary"
WIDTH = 16


@dataclass(frozen=True)
class Settings:
    """``sample`` rows learn the rotation, and ``judges`` of them ask the others how far to probe;
    ``shard`` rows are indexed, and ``block`` queries asked, at once."""

    sample: int = 10_000
    judges: int = 400
    rounds: int = 30
    bits: int = 256
    recall: float = 0.94
    z: float = 2.5
    shard: int = 16_384
    block: int = 16_384
    seed: int = 5


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one. Scaling by a power of two first is exact and keeps squares in range."""
    _, exponent = np.frexp(np.abs(x).max(axis=1, initial=0.0))
    x = np.ldexp(x, -exponent[:, None])
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


@dataclass
class Model:
    """Centre and rotation; the radius that the sample asked for; lengths of centred vectors."""

    centre: np.ndarray
    rotation: np.ndarray
    radius: int
    lengths: np.ndarray

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """Each row's code as substrings (u16)."""
        return np.packbits((unit - self.centre) @ self.rotation > 0, axis=1).view(np.uint16)

    def covering(self, query: np.ndarray, score: float, z: float) -> float:
        """The Hamming distance within which a vector of at least this cosine has its code, nearly always.

        Centring keeps differences, so the angle seen from the centre follows from the three lengths."""
        a, b, gap = np.sqrt(((query - self.centre) ** 2).sum()), self.lengths, 2.0 - 2.0 * score
        cosine = (a * a + b * b - gap) / np.maximum(2.0 * a * b, 1e-12)
        p = np.arccos(np.clip(cosine, -1.0, 1.0)).max() / np.pi
        bits = self.rotation.shape[1]
        return bits * p + z * np.sqrt(bits * p * (1.0 - p))


def differing(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Bits in which each substring of each code differs from that of ``code``."""
    return np.bitwise_count(codes ^ code)


def learn(sample: np.ndarray, settings: Settings, k: int = 5) -> Model:
    """Iterative quantization: rotate the principal axes until signs lose least; then the radius."""
    x = unit(sample)
    centre = x.mean(axis=0)
    y = x - centre
    bits = max(settings.bits // WIDTH, 1) * WIDTH
    _, axes = np.linalg.eigh(y.T @ y)
    axes = axes[:, ::-1]
    rng = np.random.default_rng(settings.seed)
    size = max(bits, x.shape[1])
    projected = y @ axes
    rotation = np.linalg.qr(rng.normal(size=(size, size)))[0][: x.shape[1], :bits]
    for _ in range(settings.rounds):
        u, _, v = np.linalg.svd(projected.T @ np.sign(projected @ rotation), full_matrices=False)
        rotation = u @ v
    lengths = np.quantile(np.sqrt((y * y).sum(axis=1)), [0.05, 0.5, 0.95])
    model = Model(centre, axes @ rotation, bits, lengths)
    codes, met = model.codes(x), []
    m = codes.shape[1]
    for i in range(0, len(x), max(1, len(x) // settings.judges)):
        scores = x @ x[i]
        scores[i] = -np.inf
        near = np.argpartition(-scores, min(k, len(x) - 1) - 1)[:k] if len(x) > 1 else np.zeros(0, np.int64)
        # a row is retrieved by the first probe that covers one of its substrings
        met += (differing(codes[near], codes[i]).astype(np.int64) * m + np.arange(m)).min(axis=1).tolist()
    model.radius = int(np.quantile(met, settings.recall, method="higher")) if met else bits
    return model


_POPCOUNT = np.bitwise_count(np.arange(1 << WIDTH, dtype=np.uint16))
#: The values of a substring at each distance from zero.
_AT = [np.flatnonzero(_POPCOUNT == d).astype(np.uint16) for d in range(WIDTH + 1)]


class MultiIndex:
    """One shard: for each substring position the rows of each of its values."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, codes: np.ndarray):
        self.ids, self.vectors, self.codes = ids, vectors, codes
        n, self.m = codes.shape
        self.rows = np.argsort(codes.T, axis=1, kind="stable").astype(np.int32).reshape(-1)
        #: row j: where each value's rows begin, one more for the end
        self.edges = np.empty((self.m, (1 << WIDTH) + 1), np.int32)
        for j in range(self.m):
            np.cumsum(np.bincount(codes[:, j], minlength=1 << WIDTH), out=self.edges[j, 1:])
            self.edges[j, 0] = 0
            self.edges[j] += j * n
        self.wide = codes.view(np.uint64)

    def probe(self, code: np.ndarray, first: int, last: int, met: np.ndarray) -> None:
        """Mark the rows that probes ``first`` to ``last`` meet: probe s * m + j takes the values that
        differ in s bits in substring j."""
        while first <= last:
            distance, j = divmod(first, self.m)
            until = min(self.m, j + last - first + 1)
            if distance > WIDTH:
                return
            at = np.arange(j, until)
            values = (code[at][:, None] ^ _AT[distance]).astype(np.int64)
            begin = self.edges[at[:, None], values].reshape(-1).astype(np.int64)
            sizes = self.edges[at[:, None], values + 1].reshape(-1) - begin
            held = sizes > 0
            met[self.rows[spread(begin[held], sizes[held])]] = True
            first += until - j

    def search(self, query_id: int, query: np.ndarray, code: np.ndarray, floor: float, k: int, model: Model, z: float) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids and cosines of the ``k`` best found and not below ``floor``; and how many rows were met."""
        met = np.zeros(len(self.ids), bool)
        ids, scores, probes, rows = np.zeros(0, np.int64), np.zeros(0), -1, np.zeros(0, np.int64)
        for radius in (2 * self.m - 1, model.radius, *range((model.radius // self.m + 2) * self.m - 1, (WIDTH + 1) * self.m, self.m)):
            if radius <= probes:
                continue
            self.probe(code, probes + 1, radius, met)
            probes = radius
            rows = np.flatnonzero(met)
            rows = rows[self.ids[rows] != query_id]
            away = np.bitwise_count(self.wide[rows] ^ code.view(np.uint64)).sum(axis=1, dtype=np.int64)
            enough = len(np.unique(self.ids[rows[:4096]])) >= k  # repeated ids are one candidate
            bar = floor
            if enough and len(rows) > 8 * k:
                some = rows[np.argpartition(away, 8 * k)[: 8 * k]]
                bar = max(bar, self._best(some, query, k)[1][-1:].max(initial=-1.0) if len(np.unique(self.ids[some])) >= k else -1.0)
            limit = model.covering(query, bar, z) if bar > -1.0 else np.inf
            ids, scores = self._best(rows[away <= limit], query, k)
            bar = max(floor, scores[k - 1]) if len(scores) >= k else floor
            if bar > -1.0 and (probes >= model.radius or probes >= model.covering(query, bar, z)):
                break
        kept = scores >= floor
        return ids[kept], scores[kept], int(met.sum())

    def _best(self, rows: np.ndarray, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        # products are summed row by row in one order, so equal vectors get equal scores
        scores = np.clip((unit(self.vectors[rows]) * query).sum(axis=1), -1.0, 1.0) if len(rows) else np.zeros(0)
        _, ids, scores = best(np.zeros(len(rows), np.int64), self.ids[rows], scores, k)
        return ids, scores


def valid(vector: Column) -> Column:
    """Not null, not zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def build(rows: DataFrame, model: Model, size: int, shard: int) -> DataFrame:
    """The index: a row per shard with its ids, vectors and codes. Nothing is shuffled."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # a matrix and a few numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors, held = [], [], 0

        def done() -> pa.RecordBatch:
            x = np.concatenate(vectors)
            packed = [np.concatenate(ids), x, shared.value.codes(unit(x))]
            return pa.RecordBatch.from_arrays([pa.array([len(x)], pa.int64()), *(pa.array([p.tobytes()], pa.binary()) for p in packed)], names=[x.split()[0] for x in _SHARD.split(", ")])

        for batch in batches:
            for at in range(0, batch.num_rows, shard):
                part = batch.slice(at, shard)
                ids.append(part.column(0).to_numpy(zero_copy_only=False))
                vectors.append(_matrix(part.column(1), size))
                held += part.num_rows
                if held >= shard:
                    yield done()
                    ids, vectors, held = [], [], 0
        if held:
            yield done()

    return rows.mapInArrow(tidy(run), _SHARD)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, settings: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For each row of ``queries`` its ``k`` nearest of ``vectors``: query_id, rank, vec_id, score, n_met.

    ``n_met`` is the number of rows that probing retrieved for the query.
    """
    spark = vectors.sparkSession
    take = lambda df: df.select(df[id_col].cast("long").alias("id"), df[vector_col].cast("array<double>").alias("v")).filter(F.col("id").isNotNull() & valid(F.col("v")))
    rows, asked = take(vectors), take(queries)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(settings.sample).collect()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double, n_met long")
    if not sample:
        return empty
    size = Counter(len(r["v"]) for r in sample).most_common(1)[0][0]
    model = learn(np.array([r["v"] for r in sample if len(r["v"]) == size]), settings, k)
    path = shared_path(spark, "vectors")
    build(rows.filter(F.size("v") == size), model, size, settings.shard).withColumn("round", round_of("ids")).write.partitionBy("round").parquet(path)
    index = spark.read.schema(f"{_SHARD}, round int").parquet(path)
    rounds = sorted(r["round"] for r in index.select("round").distinct().collect())
    asked = stored(asked.filter(F.size("v") == size).groupBy("id").agg(F.min("v").alias("v")), "asked")
    blocks = -(-asked.count() // settings.block)
    blocks = blocks if blocks <= 1 else 2 * blocks  # hashed blocks: half full, so that none overflows
    found = None
    for b in range(blocks):
        own = asked if blocks == 1 else asked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b)
        part = _search(index, rounds, own, model, k, settings, size)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return empty
    per = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))  # rows of one id in several shards
    # n_met comes with the rows of no candidate
    met = found.groupBy("query_id").agg(F.sum("n_met").alias("n_met"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    top = per.filter("vec_id IS NOT NULL").withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return top.join(met, "query_id").select("query_id", "rank", "vec_id", "score", "n_met")


def _search(index: DataFrame, rounds: list[int], asked: DataFrame, model: Model, k: int, settings: Settings, size: int) -> DataFrame:
    """What a block of queries finds in all rounds, and rows without candidate that say how many rows were met."""
    spark = index.sparkSession
    block = asked.orderBy("id").toArrow()  # a block: bounded
    ids, queries = block.column("id").to_numpy(), unit(_matrix(block.column("v").combine_chunks(), size)) if block.num_rows else np.zeros((0, size))
    shared = spark.sparkContext.broadcast((ids, queries, model.codes(queries), model))
    floor, found = np.full(len(ids), -np.inf), None
    for i, number in enumerate(rounds):
        part = stored(_round(index.filter(F.col("round") == number), shared, floor, k, settings.z, size), "found")
        found = part if found is None else found.unionByName(part)
        if i + 1 < len(rounds):
            raise_floors(floor, ids, found.filter("vec_id IS NOT NULL"), "vec_id", k)
    shared.destroy()
    return found


def _round(index: DataFrame, shared, floor: np.ndarray, k: int, z: float, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries, codes, model = shared.value
        least, seen = floor, np.zeros(len(query_ids), np.int64)
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        for batch in batches:
            for row in range(batch.num_rows if len(query_ids) else 0):
                read = lambda i, kind: np.frombuffer(batch.column(i)[row].as_buffer(), kind)  # noqa: B023, E731
                own = MultiIndex(read(0, np.int64), read(1, np.float64).reshape(-1, size), read(2, np.uint16).reshape(-1, codes.shape[1]))
                parts = []
                for q, (query_id, query, code) in enumerate(zip(query_ids.tolist(), queries, codes, strict=True)):
                    ids, scores, met = own.search(query_id, query, code, least[q], k, model, z)
                    seen[q] += met
                    parts.append((np.full(len(ids), q), ids, scores))
                held = best(*(np.concatenate(x) for x in zip(held, *parts, strict=True)), k)
                least = floors(held[0], held[2], k, least)
        if seen.any():
            numbers = np.flatnonzero(seen)
            who = np.concatenate((query_ids[held[0]], query_ids[numbers]))
            none = np.arange(len(who)) >= len(held[0])
            pad = np.zeros(len(numbers))
            columns = [pa.array(who), pa.array(np.concatenate((held[1], numbers)), mask=none), pa.array(np.concatenate((held[2], pad)), mask=none), pa.array(np.concatenate((np.zeros(len(held[0]), np.int64), seen[numbers])))]
            yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score", "n_met"])

    return index.select("ids", "vectors", "codes").mapInArrow(tidy(run), SCHEMA + ", n_met long")

"""Operator 3: exact n-gram Jaccard self-join in size-banded tiles with bitmap signatures.

Which documents meet. Sizes are cut into bands such that linked documents lie in one band or in
neighbouring ones. Two sets with Jaccard similarity t or more differ in at most
k(n) = (1 - t) / t * n shingles, n being either one's size. Each band spreads a set's shingles over
somewhat more than k hashed cells; a differing shingle spoils one cell, so linked sets agree in a
whole cell among the first k(n) + 1 that are not empty, in any order that depends on the cells'
contents alone. Cells with most infrequent shingles come first, so a line or passage that two
documents have in common does not make them meet. Frequencies come from a table of ``COUNTERS``
hashed counters, filled from all documents; its size is fixed, and it decides the order only. The
hash of (band, cell, content) is a key; documents with equal keys form blocks. (A set that leaves
too few cells filled also gets the keys of an ordinary prefix filter.) The keys of each set's ``FIRST`` cells
go first, alone: they connect nearly all copies. Then all keys meet, the first ones again, for a cell may
be among the first of one set and not of another; there, what is connected already stands as one, so a
pair of copies is not named again for each of the hundreds of keys that they share. A key that a task meets
with more than ``SAME`` owners leaves it with the least of them alone; the others are edges at once.

How they are compared. Blocks that share documents are united; each union is cut into tiles of two
size bands at a time and, where large, into hashed parts, so that no task holds more than two
parts. In a tile, documents are sorted by size; the bit count of the exclusive-or of two hashed
bitmaps bounds their overlap from above; only pairs that pass are intersected as sorted arrays.
Pairs already known to be connected are skipped: they cannot change a component.

A large union is mostly a group of near copies. There, each part first meets ``CLASSES`` representatives
of its own band and of its neighbours, which takes one tile for a document; what is connected then needs no
comparison any more. Only documents outside the largest such group of their union are compared with
everything, so tiles grow with their number and not with the square of the union.

Texts with equal sets are one class. A task announces a class once, however many copies it holds,
and a class's copies take its component, so the largest group of copies costs no more than any other.

Defined results: a null or empty text, or one of white space, has size 0 and is linked with
nothing; a null id takes part in nothing and has no component; repeated rows share a component, and
rows of one id with different texts join theirs where they have links; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from fractions import Fraction
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import WRITTEN, remove_stored, stored, tidy, utf8
from lectern.llm.components import components, hinted
from lectern.llm.shingles import U, mix, shingle_sets

#: A part of a large block holds about so many shingles, and so many documents, at most.
PART_SHINGLES, PART_DOCS = 500_000, 512
#: Slots of the table that tells which texts may be needed again; bounds what is broadcast.
SLOTS = 1 << 20
#: Counters of shingle frequencies; a power of two.
COUNTERS = 1 << 21
#: Sets that a task remembers to have announced (a further copy of another one is announced again), and
#: keys that it gathers before it passes them on.
ANNOUNCED, FLUSH_KEYS = 200_000, 500_000
#: Keys that are compared by one task, about: with few tasks a document is named by few.
TASK_KEYS = 1_000_000
_SLICE, SLICE_EDGES = 1 << 20, 1 << 16

#: Cells of each tile whose keys are compared first.
FIRST = 3
#: Owners of one key that a task sends on as they are.
SAME = 16
_OWN = "doc_id long, first binary, every binary"
_KEYS = "bucket int, base long, owners binary, low binary, high binary"
_SETS = "doc_id long, n long, s1 long, s2 long"
_PARTS = "tile long, part long, label long, doc_id long, hashes binary"
#: Representatives of a large union in each size band.
CLASSES = 8


class Bands:
    """Size bands for threshold ``t``: linked sizes lie in one band or in adjacent ones."""

    def __init__(self, threshold: Fraction, most: int = 1 << 40):
        self.t = threshold
        edges = [1, 2]
        while edges[-1] <= most:
            edges.append(max(edges[-1] + 1, (edges[-1] - 1) * threshold.denominator // threshold.numerator + 1))
        self.edges = np.array(edges, np.int64)  # band j: edges[j] .. edges[j + 1] - 1

    def of(self, n: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, n, "right") - 1

    def differ(self, n: np.ndarray) -> np.ndarray:
        """The most shingles in which a set of size ``n`` differs from a linked one."""
        return (self.t.denominator - self.t.numerator) * n // self.t.numerator

    def cells(self, band: np.ndarray) -> np.ndarray:
        return (self.differ(self.edges[band + 1] - 1) + 1) * 28 // 25 + 1


@cache
def bands(numerator: int, denominator: int) -> Bands:
    return Bands(Fraction(numerator, denominator))


def _counter(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> U(64 - COUNTERS.bit_length() + 1)).astype(np.int64)


def frequencies(docs: DataFrame, words: int) -> np.ndarray:
    """How often shingles of each counter occur; ``COUNTERS`` numbers, whatever the input."""
    block = COUNTERS >> 8
    packed = lambda x: zlib.compress(x.astype(np.uint32).tobytes(), 1)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for _, data, offsets in _chunks(batch):
                hashes, _ = shingle_sets(data, offsets, words)
                total += np.bincount(_counter(hashes), minlength=COUNTERS)
        for i in range(256):
            part = total[i * block : (i + 1) * block]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([packed(part)], pa.binary())], names=["block", "counts"])

    def add(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for table in tables:
            for i, raw in zip(table.column(0).to_pylist(), table.column(1).to_pylist(), strict=True):
                sums[i] = sums.get(i, 0) + np.frombuffer(zlib.decompress(raw), np.uint32).astype(np.int64)
        for i, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([packed(np.minimum(total, (1 << 32) - 1))], pa.binary())], names=["block", "counts"])

    schema = "block int, counts binary"
    out = np.zeros(COUNTERS, np.uint32)
    for row in docs.mapInArrow(tidy(count), schema).repartition("block").mapInArrow(tidy(add), schema).collect():
        out[row["block"] * block : (row["block"] + 1) * block] = np.frombuffer(zlib.decompress(row["counts"]), np.uint32)
    return out


def keys(hashes: np.ndarray, starts: np.ndarray, of: Bands, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all sets, with the number of the set of each, and whether it is one of its first."""
    sizes = np.diff(starts)
    live = np.flatnonzero(sizes)
    if not len(live):
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, bool)
    n = sizes[live]
    band, most = of.of(n), of.differ(n)
    owner = np.repeat(np.arange(len(live)), n)
    spread, content = mix(hashes ^ U(0x5851F42D4C957F2D)), mix(hashes + U(0x14057B7EF767814F))
    low, high = (content & U(0xFFFFFFFF)).astype(np.float64), (content >> U(32)).astype(np.float64)
    rare = (counts[_counter(hashes)] <= 4 * int(np.median(counts)) + 16).astype(np.float64)
    found, number, early = [], [], []
    for tile in (band, band + 1):
        cells = of.cells(tile)
        base = np.cumsum(cells) - cells
        total = int(cells.sum())
        cell = base[owner] + ((spread >> U(32)) * cells[owner].astype(U) >> U(32)).astype(np.int64)
        # cells are ordered by how many rare shingles they hold, then by how many in all
        score = np.bincount(cell, rare, total).astype(np.int64) << 20 | np.minimum(np.bincount(cell, minlength=total), (1 << 20) - 1)
        sums = mix(np.bincount(cell, low, total).astype(U)) + np.bincount(cell, high, total).astype(U)
        at = np.flatnonzero(score)
        whose = np.repeat(np.arange(len(live)), cells)[at]
        per = np.bincount(whose, minlength=len(live))
        order = np.lexsort((at, -score[at], whose))
        rank = np.arange(len(at)) - (np.cumsum(per) - per)[whose]  # of order[i] within its set
        chosen = order[rank <= most[whose]]
        early.append(rank[rank <= most[whose]] < FIRST)
        at, whose = at[chosen], whose[chosen]
        place = (at - base[whose]).astype(U) * U(0x9E3779B97F4A7C15) + tile[whose].astype(U)
        found.append(mix(sums[at] ^ mix(place)))
        number.append(live[whose])
        for i in np.flatnonzero(per <= most):  # too few cells filled: an ordinary prefix as well
            own = hashes[starts[live[i]] : starts[live[i] + 1]]
            need = -(-of.t.numerator * len(own) // of.t.denominator)
            prefix = own[: len(own) - need + 1]
            found.append(mix(prefix ^ U(0xD1B54A32D192ED03)))
            number.append(np.full(len(prefix), live[i]))
            early.append(np.zeros(len(prefix), bool))
    return np.concatenate(found), np.concatenate(number), np.concatenate(early)


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(ids, bytes, offsets) of runs of rows of about ``_SLICE`` bytes."""
    data, offsets = utf8(batch.column(1))
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + _SLICE, "right")) - 1)
        yield batch.column(0).slice(start, end - start), data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start]
        start = end


def _totals(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    sums = np.concatenate((np.zeros(1, U), np.cumsum(values, dtype=U)))
    return sums[starts[1:]] - sums[starts[:-1]]


def set_table(docs: DataFrame, words: int) -> DataFrame:
    """One row per document: the size of its set and two sums that stand for the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, data, offsets in _chunks(batch):
                hashes, starts = shingle_sets(data, offsets, words)
                s1, s2 = _totals(hashes, starts), _totals(mix(hashes + U(1)), starts)
                yield pa.RecordBatch.from_arrays([ids, pa.array(np.diff(starts)), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64))], names=["doc_id", "n", "s1", "s2"])

    return docs.mapInArrow(tidy(run), _SETS)


def _binaries(values: np.ndarray, number: np.ndarray, rows: int) -> pa.Array:
    """The 48-bit values of each row end to end. 48 bits of a key are kept: a chance match only adds a comparison."""
    order = np.argsort(number, kind="stable")
    data = values[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
    ends = 6 * np.cumsum(np.bincount(number, minlength=rows))
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(np.concatenate(([0], ends)).astype(np.int32).tobytes()), pa.py_buffer(data)])


def _values(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """What ``_binaries`` was given, by row."""
    raw, offsets = utf8(column)
    wide = np.zeros((len(raw) // 6, 8), np.uint8)
    wide[:, :6] = raw.reshape(-1, 6)
    return wide.view(np.uint64).reshape(-1), np.repeat(np.arange(len(column)), np.diff(offsets) // 6)


def own_keys(docs: DataFrame, words: int, of: tuple[int, int]) -> DataFrame:
    """The first keys of each document, and all its keys; of equal sets a task announces the first."""
    counts = docs.sparkSession.sparkContext.broadcast(frequencies(docs, words))  # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        announced: set[int] = set()
        for batch in batches:
            for ids, data, offsets in _chunks(batch):
                hashes, starts = shingle_sets(data, offsets, words)
                keep = ids.is_valid().to_numpy(zero_copy_only=False) & (np.diff(starts) > 0)
                sums = zip(_totals(hashes, starts).tolist(), _totals(mix(hashes + U(1)), starts).tolist(), strict=True)
                for i, (s1, s2) in enumerate(sums):
                    if keep[i]:
                        name = s1 << 64 | s2
                        keep[i] = name not in announced
                        if len(announced) < ANNOUNCED:
                            announced.add(name)
                sizes = np.where(keep, np.diff(starts), 0)[keep]
                hashes = hashes[np.repeat(keep, np.diff(starts))]
                key, number, early = keys(hashes, np.concatenate(([0], np.cumsum(sizes))), bands(*of), counts.value)
                key >>= U(16)
                columns = [ids.filter(pa.array(keep)), *(_binaries(key[part], number[part], len(sizes)) for part in (early, np.ones(len(key), bool)))]
                yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _OWN.split(", ")])

    return docs.mapInArrow(tidy(run), _OWN)


def packed(owned: DataFrame, buckets: int) -> DataFrame:
    """(owner, keys) as packed pairs by bucket of the key, each pair once for what a task holds.

    Rows of a bucket below 0 are edges between owners, to be dealt anywhere.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        count = 0

        def flush() -> pa.RecordBatch:
            nonlocal count
            key, owner = np.concatenate([k for k, _ in held]), np.concatenate([o for _, o in held])
            held.clear()
            count = 0
            bucket = (key % U(buckets)).astype(np.int64)
            order = np.lexsort((owner, key, bucket))
            key, owner, bucket = key[order], owner[order], bucket[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
            key, owner, bucket = key[new], owner[new], bucket[new]
            rows = []
            group = np.cumsum(np.concatenate(([False], key[1:] != key[:-1])))
            first = np.searchsorted(group, group)  # owners ascend, so the least of a key stands first
            many = np.bincount(group)[group] > SAME
            u, v = owner[many], owner[first[many]]
            for a in range(0, len(u), SLICE_EDGES):
                rows.append((-1 - (a // SLICE_EDGES + len(key)) % buckets, 0, b"", u[a : a + SLICE_EDGES].tobytes(), v[a : a + SLICE_EDGES].tobytes()))
            stays = ~many | (first == np.arange(len(key)))
            key, owner, bucket = key[stays], owner[stays], bucket[stays]
            edges = np.searchsorted(bucket, np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(edges)).tolist():
                own, mine = key[edges[b] : edges[b + 1]], owner[edges[b] : edges[b + 1]]
                base = int(mine.min())
                above = (mine - base).astype(U)
                wide = above.max() >= 1 << 32  # owners as far as they lie above the least
                rows.append((b, base, above.astype(np.uint64 if wide else np.uint32).tobytes(), (own & U(0xFFFFFFFF)).astype(np.uint32).tobytes(), (own >> U(32)).astype(np.uint16).tobytes()))
            kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 3)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[x.split()[0] for x in _KEYS.split(", ")])

        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                key, row = _values(part.column(1))
                held.append((key, part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)[row]))
                count += len(key)
                if count >= FLUSH_KEYS:
                    yield flush()
        if count:
            yield flush()

    return owned.mapInArrow(tidy(run), _KEYS)


def near(own: DataFrame) -> DataFrame:
    """(node, component): documents that are connected by equal keys."""

    held = own.agg(*(F.coalesce(F.sum(F.octet_length(c)), F.lit(0)).alias(c) for c in ("first", "every"))).first()

    def meet(owned: DataFrame, column: str) -> DataFrame:
        tasks = max(1, -(-held[column] // (6 * TASK_KEYS)))
        return block_edges(packed(owned.select("owner", column), 4 * tasks).repartition(tasks, "bucket"))

    first = stored(components(meet(own.withColumn("owner", F.col("doc_id")), "first")), "first")
    met = first.select(F.col("node").alias("doc_id"), F.col("component").alias("root"))
    owner = F.coalesce("root", "doc_id").alias("owner")
    if (few := hinted(met)) is not met:
        others = meet(own.join(few, "doc_id", "left").select(owner, "every"), "every")
    else:
        joined = may_be_in(own, met).join(met, "doc_id", "left").select(owner, "every")
        alone = may_be_in(own, met, "left_anti").select(F.col("doc_id").alias("owner"), "every")
        others = meet(joined.unionByName(alone), "every")
    return components(others.unionByName(first.select(F.col("node").alias("u"), F.col("component").alias("v"))))


class Forest:
    """Union-find over dense numbers; the root is the smallest member."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def block_edges(table: DataFrame) -> DataFrame:
    """(u, v): documents that agree in a key, each with the least of those it is connected to here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys_, owners, met = [np.zeros(0, U)], [np.zeros(0, np.int64)], [(np.zeros(0, np.int64),) * 2]
        for batch in batches:
            for bucket, base, own, low, high in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket < 0:
                    met.append((np.frombuffer(low, np.int64), np.frombuffer(high, np.int64)))
                    continue
                bits = np.frombuffer(low, np.uint32).astype(U) | np.frombuffer(high, np.uint16).astype(U) << U(32)
                keys_.append(bits)
                wide = len(own) > len(low)
                owners.append(base + np.frombuffer(own, np.uint64 if wide else np.uint32).astype(np.int64))
        key, owner = np.concatenate(keys_), np.concatenate(owners)
        keys_.clear()
        owners.clear()
        order = np.argsort(key, kind="stable")
        key = key[order]
        same = key[1:] == key[:-1]
        pairs = np.flatnonzero(same)
        u, v = (np.concatenate(x) for x in zip(*met, strict=True))
        a, b = np.concatenate((owner[order[pairs]], u)), np.concatenate((owner[order[pairs + 1]], v))
        differ = a != b
        nodes, ends = np.unique(np.concatenate((a[differ], b[differ])), return_inverse=True)
        forest = Forest(len(nodes))
        half = len(ends) // 2
        for x, y in np.unique(np.stack((ends[:half], ends[half:]), axis=1), axis=0).tolist():
            forest.join(x, y)
        roots = np.array([forest.root(i) for i in range(len(nodes))], np.int64)
        out = np.flatnonzero(roots != np.arange(len(nodes)))
        if len(out):
            yield pa.RecordBatch.from_arrays([pa.array(nodes[out]), pa.array(nodes[roots[out]])], names=["u", "v"])

    return table.mapInArrow(tidy(run), "u long, v long")


def tile_links(rows: list[tuple[int, int, int, np.ndarray]], t: Fraction) -> list[tuple[int, int]]:
    """Links that connect the documents of one tile, of (part, label, id, sorted hashes) rows.

    Documents of one label are connected already. With two parts, pairs within a part are another tile's.
    """
    rows.sort(key=lambda r: (len(r[3]), r[2]))
    sizes = np.array([len(r[3]) for r in rows], np.int64)
    parts = np.array([r[0] for r in rows], np.int64)
    apart = len(set(parts.tolist())) > 1
    bits = 1 << min(14, max(8, int(2 * sizes[-1]).bit_length()))
    maps = np.zeros((len(rows), bits // 8), np.uint8)
    for i, (*_, own) in enumerate(rows):
        slot = (mix(own) >> U(64 - bits.bit_length() + 1)).astype(np.int64)
        np.bitwise_or.at(maps[i], slot >> 3, (1 << (slot & 7)).astype(np.uint8))
    maps = maps.view(U)
    links: list[tuple[int, int]] = []
    labels = np.unique([r[1] for r in rows], return_inverse=True)[1]
    num, den = t.numerator, t.denominator
    for i in range(len(rows) - 1):
        top = int(np.searchsorted(sizes, sizes[i] * den // num, "right"))
        if top <= i + 1:
            continue
        others = np.arange(i + 1, top)
        others = others[labels[others] != labels[i]]
        if apart:
            others = others[parts[others] != parts[i]]
        if not len(others):
            continue
        unlike = np.bitwise_count(maps[others] ^ maps[i]).sum(axis=1, dtype=np.int64)
        bound = (sizes[others] + sizes[i] - unlike) // 2
        others = others[bound * (num + den) >= num * (sizes[others] + sizes[i])]
        own = rows[i][3]
        for j in others.tolist():
            if labels[j] == labels[i]:
                continue
            other = rows[j][3]
            at = np.searchsorted(other, own)
            at[at == len(other)] = 0
            overlap = int((other[at] == own).sum())
            if overlap * den >= num * (len(own) + len(other) - overlap):
                links.append((rows[i][2], rows[j][2]))
                old, new = max(labels[i], labels[j]), min(labels[i], labels[j])
                labels[labels == old] = new
    return links


def verified(parts: DataFrame, of: tuple[int, int]) -> DataFrame:
    """Exact links of each tile; rows of a tile follow each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, tile, rows = Fraction(*of), None, []

        def done() -> pa.RecordBatch:
            links = tile_links(rows, t) if len(rows) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in links], pa.int64()), pa.array([b for _, b in links], pa.int64())], names=["u", "v"])

        for batch in batches:
            for key, part, label, doc, hashes in zip(*(batch.column(i) for i in range(5)), strict=True):
                if key.as_py() != tile:
                    if rows:
                        yield done()
                    tile, rows = key.as_py(), []
                rows.append((part.as_py(), label.as_py(), doc.as_py(), np.frombuffer(hashes.as_py(), U)))
        if rows:
            yield done()

    return parts.mapInArrow(tidy(run), "u long, v long")


def _sized(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Blocks (doc_id, component, n, band, label) whose documents fit one tile, and the large ones."""
    whole = blocks.groupBy("component").agg(F.greatest(F.sum("n") / F.lit(2 * PART_SHINGLES), F.count("*") / F.lit(2 * PART_DOCS)).alias("tiles"))
    large = stored(whole.filter("tiles > 1").select("component"), "large")
    return blocks.join(large, "component", "left_anti"), blocks.join(large, "component", "left_semi")


def _splits(blocks: DataFrame, kind: str) -> DataFrame:
    """(component, ``kind``): for each band the number of parts."""
    per = blocks.groupBy("component", "band").agg(F.sum("n").alias("n"), F.count("*").alias("docs"))
    split = F.greatest(F.ceil(F.col("n") / PART_SHINGLES), F.ceil(F.col("docs") / PART_DOCS)).cast("int")
    return per.withColumn("split", split).groupBy("component").agg(F.map_from_entries(F.collect_list(F.struct("band", "split"))).alias(kind))


def _count(splits: str, shift: int) -> Column:
    return F.coalesce(F.try_element_at(splits, F.col("band") + shift), F.lit(0))


def _each(count: Column, make) -> Column:
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), make)).otherwise(F.array().cast("array<bigint>"))


def _part(splits: str) -> Column:
    return F.pmod(F.xxhash64("doc_id"), _count(splits, 0)).cast("int")


def _first_tiles(large: DataFrame) -> DataFrame:
    """Each part of a large block with the representatives of its bands; they go to all those parts."""
    chosen = F.min(F.struct(F.xxhash64("doc_id", F.lit(1)).alias("h"), "doc_id")).alias("least")
    some = large.groupBy("component", "band", F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(CLASSES)).alias("class")).agg(chosen).select("component", F.col("least.doc_id").alias("doc_id"), F.lit(True).alias("stands"))
    joined = large.join(_splits(large, "parts"), "component").join(some, ["component", "doc_id"], "left")
    name = lambda band, part: F.xxhash64("component", band, part)
    in_band = lambda d: _each(_count("parts", d), lambda j: name(F.col("band") + d, j))
    everywhere = F.concat(*map(in_band, (-1, 0, 1)))
    tiles = F.when(F.col("stands"), everywhere).otherwise(F.array(name(F.col("band"), _part("parts"))))
    return joined.select("doc_id", tiles.alias("tiles"), F.lit(0).cast("long").alias("part"), "label")


def _rest_tiles(large: DataFrame) -> DataFrame | None:
    """All pairs of parts with a document outside the largest group of its block; None: there is none."""
    sizes = large.groupBy("component", "label").agg(F.count("*").alias("docs"))
    main = stored(sizes.groupBy("component").agg(F.max_by("label", F.struct("docs", "label")).alias("main"), F.count("*").alias("groups")).filter("groups > 1"), "main")
    if main.isEmpty():
        return None
    blocks = stored(large.join(main.select("component", "main"), "component"), "rest")
    few, many = blocks.filter("label <> main"), blocks.filter("label = main")
    joined = few.join(_splits(few, "few"), "component").join(_splits(many, "many"), "component")
    part = _part("few")
    name = lambda b, i, c, j, kind: F.xxhash64("component", b, i, c, j, F.lit(kind))
    own = _each(_count("few", 0), lambda j: name(F.col("band"), F.least(part, j), F.col("band"), F.greatest(part, j), "few"))
    up = _each(_count("few", 1), lambda j: name(F.col("band"), part, F.col("band") + 1, j, "few"))
    down = _each(_count("few", -1), lambda j: name(F.col("band") - 1, j, F.col("band"), part, "few"))
    against = lambda d: _each(_count("many", d), lambda j: name(F.col("band"), part, F.col("band") + d, j, "many"))
    outside = joined.select("doc_id", F.concat(own, up, down, *map(against, (-1, 0, 1))).alias("tiles"), F.xxhash64(F.lit("few"), "band", part).alias("part"), "label")
    joined = many.join(_splits(few, "few"), "component").join(_splits(many, "many"), "component")
    part_ = _part("many")
    met = lambda d: _each(_count("few", d), lambda i: name(F.col("band") + d, i, F.col("band"), part_, "many"))
    inside = joined.select("doc_id", F.concat(*map(met, (-1, 0, 1))).alias("tiles"), F.xxhash64(F.lit("many"), "band", part_).alias("part"), "label")
    return outside.unionByName(inside.filter(F.size("tiles") > 0))


def _laid_out(docs: DataFrame, words: int) -> DataFrame:
    """From (doc_id, text, tiles, part, label) the sets, once for each tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in _PARTS.split(", ")]
        kinds = (*[pa.int64()] * 4, pa.binary())

        def laid(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)], names=names)

        for batch in batches:
            tiles, parts, labels, at = *(batch.column(i).to_pylist() for i in (2, 3, 4)), 0
            for ids, data, offsets in _chunks(batch):
                hashes, starts = shingle_sets(data, offsets, words)
                out: list[tuple] = []
                held = 0
                for i, doc in enumerate(ids.to_pylist()):
                    raw = hashes[starts[i] : starts[i + 1]].tobytes()
                    for tile in tiles[at + i] if raw else []:
                        out.append((tile, parts[at + i], labels[at + i], doc, raw))
                        held += len(raw)
                        if held >= 8 * _SLICE:
                            yield laid(out)
                            out, held = [], 0
                at += len(ids)
                if out:
                    yield laid(out)

    return docs.mapInArrow(tidy(run), _PARTS)


def _links(docs: DataFrame, tiles: DataFrame, words: int, threshold: tuple[int, int]) -> DataFrame:
    """Verified links of the documents that go to ``tiles``."""
    tiles = stored(tiles, "tiles")
    texts = may_be_in(docs, tiles).join(tiles, "doc_id").select("doc_id", "text", "tiles", "part", "label")
    return verified(_laid_out(texts, words).repartition("tile").sortWithinPartitions("tile"), threshold)


def _all_links(docs: DataFrame, blocks: DataFrame, words: int, threshold: tuple[int, int]) -> DataFrame:
    """Links enough to connect what is connected, of blocks (doc_id, component, n)."""
    of = bands(*threshold)
    edges = F.array(*(F.lit(int(e)) for e in of.edges[:400]))
    band = F.size(F.filter(edges, lambda e: e <= F.col("n"))) - 1
    blocks = stored(blocks.select("doc_id", "component", "n", band.alias("band"), F.col("doc_id").alias("label")), "blocks")
    small, large = _sized(blocks)
    whole = small.select("doc_id", F.array(F.xxhash64("component")).alias("tiles"), F.lit(0).cast("long").alias("part"), "label")
    if large.isEmpty():
        return _links(docs, whole, words, threshold)
    first = stored(_links(docs, whole.unionByName(_first_tiles(large)), words, threshold), "links")
    known = stored(components(first), "known").select(F.col("node").alias("doc_id"), F.col("component").alias("root"))
    labelled = large.drop("label").join(hinted(known), "doc_id", "left").withColumn("label", F.coalesce("root", "doc_id")).drop("root")
    rest = _rest_tiles(labelled)
    return first if rest is None else first.unionByName(_links(docs, rest, words, threshold))


def may_be_in(df: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose doc_id hashes to a slot that ``ids`` (doc_id) use, or with left_anti the rest.

    At most ``SLOTS`` numbers are broadcast, whatever the size of ``ids``; it spares the shuffle that
    follows most of the texts that it has no use for.
    """
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS)).cast("int")
    used = ids.select(slot.alias("slot")).distinct()
    held = df.select(F.struct("*").alias("row"), slot.alias("slot")).join(F.broadcast(used), "slot", how)
    return held.select(*(F.col("row").getField(c).alias(c) for c in df.columns))


def jaccard_components(docs: DataFrame, words: int = 5, threshold: tuple[int, int] = (4, 5), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles and component_id (the least linked doc_id)."""
    spark = docs.sparkSession
    docs = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    sets = stored(set_table(docs, words), "sets")
    mark = len(WRITTEN)
    blocks_ = stored(near(stored(own_keys(docs, words, threshold), "keys")), "near")
    remove_stored(spark, mark, but=WRITTEN[-1])
    of_set = sets.filter("n > 0").select("doc_id", "n").join(hinted(blocks_), F.col("doc_id") == F.col("node"))
    blocks = of_set.groupBy("doc_id", "component").agg(F.max("n").alias("n"))
    linked = stored(components(_all_links(docs, blocks, words, threshold)), "linked")
    remove_stored(spark, mark, but=WRITTEN[-1])
    known = sets.filter("doc_id IS NOT NULL AND n > 0").join(hinted(linked), F.col("doc_id") == F.col("node"), "left")
    # the least id of a component may be that of a copy which its task did not announce
    classes = stored(known.groupBy("n", "s1", "s2").agg(F.min("component").alias("label"), F.min("doc_id").alias("least")), "classes")
    least = stored(classes.filter("label IS NOT NULL").groupBy("label").agg(F.min("least").alias("component_id")), "least")
    classes = classes.join(hinted(least), "label", "left").select("n", "s1", "s2", F.coalesce("component_id", "least").alias("component_id"))
    filled, empty = sets.filter("n > 0"), sets.filter("n = 0")  # empty texts, however many, join nothing
    own = filled.join(classes, ["n", "s1", "s2"], "left").select("doc_id", "n", "component_id").unionByName(empty.select("doc_id", "n", F.lit(None).cast("long").alias("component_id")))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return own.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def keep_one(docs: DataFrame, words: int = 5, threshold: tuple[int, int] = (4, 5)) -> DataFrame:
    """``docs`` with the document of least id of each component; all columns are kept."""
    mark = len(WRITTEN)
    found = stored(jaccard_components(docs, words, threshold), "found")
    remove_stored(docs.sparkSession, mark, but=WRITTEN[-1])
    dropped = found.filter("component_id < doc_id").select("doc_id").distinct()
    sure = may_be_in(docs, dropped, "left_anti")
    return sure.unionByName(may_be_in(docs, dropped).join(dropped, "doc_id", "left_anti"))

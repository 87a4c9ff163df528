"""Operator 7: best-fit-decreasing packing of token ids into fixed windows.

Each document becomes its ids plus an end id. Overlong documents are first cut into full windows,
which are closed where they arise. What is left over, a row of numbers for each document, is
dealt into groups of about ``GROUP`` pieces, whatever the input's partitions, and each group is packed
by itself: longest first, into the open window with the least room that still suffices, found by a
segment tree indexed by remaining capacity. Texts are not shuffled.

Defined results: a null or empty text is its end id alone; the text of a special token is that token,
as the tokenizer has it; pieces of one length are placed in order of their ids; repeated rows are packed
once each; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from lectern.llm.common import chunks, stored, tidy
from lectern.llm.encoding import CachedEncoder, with_end

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_ARROW = pa.schema([(x.split()[0], pa.int64()) for x in SCHEMA.split(", ")])
#: Bytes of text that are encoded at once, and pieces that are remembered between them.
CHUNK, REMEMBERED = 8 << 20, 500_000
#: Pieces that are packed together; bounds a task's memory.
GROUP = 200_000


class RoomTree:
    """Segment tree over remaining capacity 0..size; answers the tightest open window."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]

    def _add(self, room: int, by: int) -> None:
        node = room + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def push(self, room: int, window: int) -> None:
        if room:
            self.open[room].append(window)
            self._add(room, 1)

    def pop(self, need: int) -> tuple[int, int] | None:
        """The window with the least room of at least ``need``, and that room."""
        node = need + self.leaves
        while not self.count[node]:
            while node & 1:  # a right child: nothing larger below this parent
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self.leaves:
            node = 2 * node if self.count[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._add(room, -1)
        return self.open[room].pop(), room


def best_fit_decreasing(lengths: list[int], size: int) -> list[tuple[int, int]]:
    """For each length (1..size) its window and offset there; windows count from 0."""
    tree, placed, windows = RoomTree(size), [(0, 0)] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        need = lengths[i]
        found = tree.pop(need)
        if found is None:
            window, room = windows, size
            windows += 1
        else:
            window, room = found
        placed[i] = (window, size - room)
        tree.push(room - need, window)
    return placed


def pieces(docs: DataFrame, tokenizer: str, size: int, end_id: int, spaced: bool, chunk: int = CHUNK, remembered: int = REMEMBERED) -> DataFrame:
    """All pieces of (doc_id, text): full windows with their place, the others without one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = CachedEncoder.loaded(tokenizer, spaced, remembered)
        window = TaskContext.get().partitionId() << 33  # even numbers; those of packed windows are odd
        for batch in batches:
            for a, b in chunks(batch.column(1), chunk):
                ids, offsets = with_end(*encoder.encode(batch.column(1).slice(a, b - a)), end_id)
                total = np.diff(offsets)
                count = -(-total // size)
                doc = np.repeat(np.arange(b - a), count)
                start = size * (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count))
                length = np.minimum(size, total[doc] - start)
                first = offsets[doc] + start
                raw = memoryview(ids).cast("B")
                sums = [zlib.crc32(raw[x:y]) for x, y in zip((4 * first).tolist(), (4 * (first + length)).tolist(), strict=True)]
                full = length == size
                sequence = window + 2 * (np.cumsum(full) - full)
                window += 2 * int(full.sum())
                placed = [pa.array(sequence, mask=~full), pa.array(np.zeros(len(doc), np.int64), mask=~full)]
                numbers = [start, length, np.array(sums, np.int64), total[doc]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a).take(pa.array(doc)), *map(pa.array, numbers), *placed], schema=_ARROW)

    return docs.mapInArrow(tidy(run, keeps=True), SCHEMA)


def packed(rest: DataFrame, size: int) -> DataFrame:
    """Places for pieces without one; each partition packs its own, ``GROUP`` at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        window, held, waiting = (TaskContext.get().partitionId() << 32), 0, []

        def flush() -> pa.RecordBatch:
            nonlocal window
            whole = pa.Table.from_batches(waiting).combine_chunks()
            lengths = whole.column("length").to_pylist()
            placed = np.array(best_fit_decreasing(lengths, size), np.int64).reshape(-1, 2)
            out = [*(whole.column(n).chunk(0) for n in _ARROW.names[:5]), pa.array(2 * (window + placed[:, 0]) + 1), pa.array(placed[:, 1])]
            window += int(placed[:, 0].max()) + 1
            waiting.clear()
            return pa.RecordBatch.from_arrays(out, schema=_ARROW)

        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                held += batch.num_rows
            if held >= GROUP:
                yield flush()
                held = 0
        if held:
            yield flush()

    return rest.mapInArrow(tidy(run), SCHEMA)


def pack(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 0, spaced: bool = True, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, remembered: int = REMEMBERED) -> DataFrame:
    """One row per piece: see ``SCHEMA``. ``tokenizer`` is the path of a ``tokenizers`` file.

    ``chunk`` and ``remembered`` bound a worker's memory; results do not depend on them.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    every = stored(pieces(rows, tokenizer, size, end_id, spaced, chunk, remembered), "pieces")
    rest = every.filter("sequence_id IS NULL")
    groups = max(1, -(-rest.count() // GROUP))
    dealt = rest.repartition(groups).sortWithinPartitions("length", "doc_id", "start", "ids_crc32")
    return every.filter("sequence_id IS NOT NULL").unionByName(packed(dealt, size))

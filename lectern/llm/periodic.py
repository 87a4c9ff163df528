"""Operator 11: runs of repeated words, by Karp-Miller-Rosenberg naming.

A run is a stretch of words with smallest period q and at least ``copies`` * q and ``shortest`` words that
no neighbouring word extends. Words get numbers; the name of a block of 2^k words is the number of the pair
of names of its halves, so equal names are equal blocks. Names stand only for blocks that occur twice in
their text: a block that holds one that does not cannot occur twice either, so in ordinary prose the levels
end after a few words. All texts of a slice share one flat array of words, and a text's words are its own, so
no block or run leaves its text.

A run of four periods p holds a multiple of 2p, and from there on p further words with their repetition. So for
each p the places 2p, 4p, ... of the flat array (for three copies p, 2p, ..., for five 3p, ...) are tested by one
comparison of names of the largest block within p words; those that pass are extended both ways, by comparing
names from the largest blocks down. A stretch with two periods is kept with the smaller one.

Memory: four bytes for each word of a slice and level; a text is one slice at least.

Defined results: null and empty texts, and those of white space, have no runs and collapse to nothing;
texts without an id are searched like others; repeated rows are searched each; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import chunks, tidy, utf8

SHORTEST, COPIES = 6, 4
#: Bytes of text that are searched at once, and candidates that are extended at once.
SLICE, TOGETHER = 4 << 20, 1 << 20
SCHEMA = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"
_RUN = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True

#: From an id and a number of words to where each word comes from; None: every word from its own place.
Revise = Callable[[int | None, int], np.ndarray | None]


def word_names(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word, equal for equal words, and each text's first word (one more for the end)."""
    blank = _BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([True], blank))[: len(data)]
    starts = np.flatnonzero(~blank & (before | edge[:-1]))
    letters = np.concatenate(([0], np.cumsum(~blank)))
    ends = np.concatenate((letters[starts], letters[-1:]))  # what is not blank, laid end to end
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[~blank]))])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64), np.searchsorted(starts, offsets)


def _named(pairs: np.ndarray, places: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Names by place, -1 for what occurs once and for the place after the last; and the named places."""
    names = np.full(n + 1, -1, np.int32)
    _, inverse, counts = np.unique(pairs, return_inverse=True, return_counts=True)
    again = counts[inverse] > 1
    names[places[again]] = inverse[again]
    return names, places[again]


def levels(words: np.ndarray, first: np.ndarray, longest: int) -> list[np.ndarray]:
    """Names of blocks of 1, 2, 4, ... words, as long as any block of at most ``longest`` words occurs twice."""
    n = len(words)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    names, places = _named(text * (int(words.max(initial=0)) + 1) + words, np.arange(n), n)
    found, size = [], 1
    while len(places):
        found.append(names)
        if 2 * size > longest:
            break
        second = names[np.minimum(places + size, n)]
        both = (second >= 0) & (text[np.minimum(places + size, n - 1)] == text[places])
        places, second = places[both], second[both]
        names, places = _named(names[places].astype(np.int64) << 32 | second, places, n)
        size *= 2
    return found


def extensions(names: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many words agree from places i and j on, and how many before them."""
    after, before = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
    for k in reversed(range(len(names))):
        size, own = 1 << k, names[k]
        n = len(own) - 1
        while True:  # the largest blocks may follow each other, others occur once at most
            at = own[np.minimum(i + after, n)]
            same = (at >= 0) & (at == own[np.minimum(j + after, n)])
            after += size * same
            a = i - before - size
            at = own[a]  # where a is below 0 this reads from the end, and counts for nothing
            back = (a >= 0) & (at >= 0) & (at == own[j - before - size])
            before += size * back
            if k < len(names) - 1 or not (same.any() or back.any()):
                break
    return after, before


def find_runs(words: np.ndarray, first: np.ndarray, shortest: int = SHORTEST, copies: int = COPIES) -> np.ndarray:
    """Rows (text, start in the text, length, period) of all runs, in order of text, start and period."""
    if copies < 3:
        raise ValueError("the grid finds runs of three copies or more")
    longest = int(np.diff(first).max(initial=0)) // copies
    names = levels(words, first, longest) if longest else []
    n, found, held = len(words), [], 0
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    known, until = np.zeros(n, np.int32), np.zeros(n, np.int32)  # the period of a run over each place, and the run's end

    def extend() -> None:
        i, p = (np.concatenate(x) for x in zip(*waiting, strict=True))
        waiting.clear()
        after, before = extensions(names, i, i + p)
        start, length = i - before, before + after + p
        keep = length >= np.maximum(shortest, copies * p)
        found.append(np.unique(np.stack((start, length, p), 1)[keep], axis=0))
        for s, l, q in found[-1].tolist():
            if not known[s] and not known[s + l - 1]:
                known[s : s + l], until[s : s + l] = q, s + l

    for p in range(1, longest + 1):
        k = p.bit_length() - 1
        if k >= len(names):
            break
        grid = np.arange(0, n - p, (copies - 2) * p)
        own = names[k][grid]
        grid = grid[(own >= 0) & (own == names[k][grid + p])]
        # inside a run, multiples of its period tell nothing new
        grid = grid[(known[grid] == 0) | (p % np.maximum(known[grid], 1) != 0) | (grid + p >= until[grid])]
        if len(grid):
            waiting.append((grid, np.full(len(grid), p)))
            held += len(grid)
        if held >= TOGETHER or held and p & (p + 1) == 0:  # one level of names is done
            extend()
            held = 0
    if waiting:
        extend()
    if not found:
        return np.zeros((0, 4), np.int64)
    runs = np.unique(np.concatenate(found), axis=0)  # by start, length and period
    smallest = np.ones(len(runs), bool)
    smallest[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[smallest]
    text = np.searchsorted(first, runs[:, 0], "right") - 1
    runs = np.column_stack((text, runs[:, 0] - first[text], runs[:, 1:]))
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def _moved(ids: list[int | None], first: np.ndarray, revise: Revise) -> dict[int, np.ndarray]:
    found = ((t, revise(ids[t], n)) for t, n in enumerate(np.diff(first).tolist()))
    return {t: source for t, source in found if source is not None}


def collapse(docs: DataFrame, shortest: int = SHORTEST, copies: int = COPIES, revise: Revise | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its runs, by start and period, and its words without the repetitions.

    Of each run the first period stays; the words that are kept are joined by one space. ``revise`` moves
    words before the search.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in chunks(batch.column(1), SLICE):
                data, offsets = utf8(batch.column(1).slice(a, b - a))
                ids = batch.column(0).slice(a, b - a)
                words, first = word_names(data, offsets)
                moved = _moved(ids.to_pylist(), first, revise) if revise else {}
                for t, source in moved.items():
                    words[first[t] : first[t + 1]] = words[first[t] + source]
                runs = find_runs(words, first, shortest, copies)
                yield pa.RecordBatch.from_arrays([ids, _lists(runs, b - a), _collapsed(data, offsets, first, runs, moved)], names=["doc_id", "runs", "collapsed"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(tidy(run), SCHEMA)


def _lists(runs: np.ndarray, texts: int) -> pa.Array:
    ends = np.searchsorted(runs[:, 0], np.arange(texts + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(runs[:, c])) for c in (1, 2, 3)], fields=list(_RUN)))


def _collapsed(data: np.ndarray, offsets: np.ndarray, first: np.ndarray, runs: np.ndarray, moved: dict[int, np.ndarray]) -> pa.Array:
    raw, spans = data.tobytes(), np.searchsorted(runs[:, 0], np.arange(len(offsets)))
    out = []
    for t, (x, y) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        own = raw[x:y].split()  # at the bytes of ``_BLANK``
        if t in moved:
            own = [own[i] for i in moved[t].tolist()]
        if spans[t] < spans[t + 1]:
            cover = np.zeros(len(own) + 1, np.int64)
            _, start, length, period = runs[spans[t] : spans[t + 1]].T
            np.add.at(cover, start + period, 1)
            np.add.at(cover, start + length, -1)
            own = [own[i] for i in np.flatnonzero(np.cumsum(cover)[:-1] == 0).tolist()]
        out.append(b" ".join(own))
    return pa.array(out, pa.binary()).cast(pa.string())


def recurring(doc_id: int | None, n: int) -> np.ndarray | None:
    """The revision of the registered query: of every tenth id, by its checksum, the end of the text recurs."""
    h = crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    source = np.arange(n)
    source[a:] = a + (source[a:] - a) % (1 + (n - a) // (3 + g % 8))
    return source


def digests(found: DataFrame) -> DataFrame:
    """Of ``collapse``: the number of runs, the longest one, and checksums of all runs and of the text."""
    runs: Column = F.col("runs")
    longest = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    # runs without any, as an array of nothing, have a null longest run
    lines = F.transform(runs, lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    best = found.withColumn("best", longest)
    return best.select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(F.lit(1000) * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

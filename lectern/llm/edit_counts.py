"""Operator 6: edit-aware token counts.

A document is kept as a row: its text, the lengths of its pre-tokens and the token count of each.
``trees`` makes such rows once. ``edited`` reads them again, in any later run, and applies edits: the
pre-tokens, in leaves of a few each, stand under a segment tree of lengths and token counts, whose sums
come from the kept numbers without splitting or encoding anything. An edit descends by length to the
leaf it touches, re-splits the text from two pre-tokens before the edit until the new boundaries meet
old ones again, encodes only the pre-tokens in between, and updates the sums above the changed leaves.
Where a boundary is met again the rest is unchanged, because the splitting pattern looks only ahead. What
comes out is a row of the same kind, to be kept for the next edits; rows without edits pass untouched.

Edits replace the code points ``start`` (inclusive) to ``stop`` (exclusive) by a text; positions are
those of the text as the earlier edits left it, and are clamped to it.

Defined results: a null text counts as empty; no edits leave the counts alone; the text of a special token
counts as ordinary text, so that an edit cannot make one; rows are treated one by one, so repeated rows
give repeated results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import shared_path, tidy
from lectern.llm.encoding import _VISIBLE, CachedEncoder

#: What is kept of a document; ``lengths`` and ``counts`` are packed whole numbers, one per pre-token.
TREE = "doc_id long, text string, lengths binary, counts binary, n_tokens long"
EDITED = f"{TREE}, n_before long, n_edits int, n_reencoded long"
EDITS = "array<struct<start:int,stop:int,text:string>>"
LEAF = 16
#: Code points after a boundary that must be known before it is trusted.
_AHEAD = 8
#: Rows of an Arrow batch that is yielded hold about so many characters.
_FLUSH = 4 << 20


def pack(numbers: np.ndarray) -> bytes:
    """Whole numbers in the least width that holds all of them, after a byte that names it."""
    most = int(numbers.max(initial=0))
    width = 1 if most < 1 << 8 else 2 if most < 1 << 16 else 4
    return bytes([width]) + numbers.astype(f"<u{width}").tobytes()


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


class PieceCounts(dict):
    """Number of ids of each pre-token; remembers a bounded number of them."""

    def __init__(self, encoder: CachedEncoder, limit: int = 200_000):
        self.merge, self.limit = encoder.tokenizer.model.tokenize, limit

    def __missing__(self, piece: str) -> int:
        found = len(self.merge(piece.encode().decode("latin-1").translate(_VISIBLE)))
        if len(self) < self.limit:
            self[piece] = found
        return found


class EditableCount:
    """One document's pre-tokens under a segment tree of (code points, tokens).

    A leaf's pieces are cut from the text only when an edit comes near it.
    """

    def __init__(self, text: str, lengths: np.ndarray, tokens: np.ndarray, pattern: regex.Pattern, counts: PieceCounts):
        self.pattern, self.counts, self.reencoded = pattern, counts, 0
        self.base, self.sizes, self.known = text, lengths, tokens
        self.at = np.concatenate(([0], np.cumsum(lengths)))
        n = max(1, -(-len(lengths) // LEAF))
        self.leaves: list[list[str] | None] = [None] * n
        self.size = 1 << (n - 1).bit_length()
        self.length, self.tokens = self._sums(lengths), self._sums(tokens)

    @classmethod
    def of(cls, text: str, pattern: regex.Pattern, counts: PieceCounts) -> "EditableCount":
        """From a text that is split and counted for the first time."""
        return cls(text, *first_counts(text, pattern, counts), pattern, counts)

    def _sums(self, numbers: np.ndarray) -> list[int]:
        level = np.zeros(self.size, np.int64)
        if len(numbers):
            level[: len(self.leaves)] = np.add.reduceat(numbers, np.arange(0, len(numbers), LEAF))
        levels = [level]
        while len(levels[-1]) > 1:
            levels.append(levels[-1].reshape(-1, 2).sum(axis=1))
        return [0, *np.concatenate(levels[::-1]).tolist()]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def _pieces(self, leaf: int) -> list[str]:
        found = self.leaves[leaf]
        if found is None:
            ends = self.at[leaf * LEAF : (leaf + 1) * LEAF + 1].tolist()
            found = self.leaves[leaf] = [self.base[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return found

    def state(self) -> tuple[str, np.ndarray, np.ndarray]:
        """(text, lengths, tokens) as they are now; stretches that no edit came near are copied whole."""
        texts, lengths, tokens, leaf = [], [], [], 0
        while leaf < len(self.leaves):
            until = leaf
            while until < len(self.leaves) and self.leaves[until] is None:
                until += 1
            if until > leaf:
                a, b = leaf * LEAF, min(until * LEAF, len(self.sizes))
                texts.append(self.base[self.at[a] : self.at[b]])
                lengths.append(self.sizes[a:b])
                tokens.append(self.known[a:b])
                leaf = until
            else:
                own = self.leaves[leaf]
                texts += own
                lengths.append(np.array([*map(len, own)], np.int64))
                tokens.append(np.array([*map(self.counts.__getitem__, own)], np.int64))
                leaf += 1
        return "".join(texts), np.concatenate([np.zeros(0, np.int64), *lengths]), np.concatenate([np.zeros(0, np.int64), *tokens])

    @property
    def text(self) -> str:
        return self.state()[0]

    def _leaf_at(self, position: int) -> tuple[int, int]:
        """The leaf that holds a position (the last one for the end), and where it begins."""
        node, before = 1, 0
        while node < self.size:
            node *= 2
            if position - before >= self.length[node] and self.length[node + 1]:
                before += self.length[node]
                node += 1
        return node - self.size, before

    def _put(self, leaf: int, pieces: list[str]) -> None:
        self.leaves[leaf] = pieces
        node = leaf + self.size
        self.length[node], self.tokens[node] = sum(map(len, pieces)), sum(map(self.counts.__getitem__, pieces))
        while node := node // 2:
            self.length[node] = self.length[2 * node] + self.length[2 * node + 1]
            self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def edit(self, start: int, stop: int, new: str) -> None:
        start = min(max(start, 0), self.length[1])
        stop = min(max(stop, start), self.length[1])
        first, begin = self._leaf_at(start)
        context = 0  # pre-tokens before the edit, of which the last two may change
        at = begin
        for piece in self._pieces(first):
            if at + len(piece) > start:
                break
            context, at = context + 1, at + len(piece)
        while context < 3 and first:
            first -= 1
            context += len(self._pieces(first))
            begin -= self.length[first + self.size]
        last, after = self._leaf_at(stop)
        after += self.length[last + self.size]
        while True:
            old = [p for leaf in range(first, last + 1) for p in self._pieces(leaf)]
            text = "".join(old)
            text = text[: start - begin] + new + text[stop - begin :]
            whole = after >= self.length[1]
            boundary = self._split(old, text, start - begin, stop - begin, new, whole)
            if boundary is not None:
                break
            more = min(2 * (last - first) + 2, len(self.leaves) - 1 - last)
            for leaf in range(last + 1, last + 1 + more):
                after += self.length[leaf + self.size]
            last += more
        pieces, kept = boundary
        self.reencoded += len(pieces)
        for leaf in range(last, first, -1):  # what is kept stays in the leaf it was in
            own = self._pieces(leaf)
            keep = min(len(own), kept)
            kept -= keep
            if keep < len(own):
                self._put(leaf, own[len(own) - keep :])
        own = self._pieces(first)
        self._put(first, pieces + own[len(own) - kept :])

    def _split(self, old: list[str], text: str, start: int, stop: int, new: str, whole: bool) -> tuple[list[str], int] | None:
        """New pre-tokens up to a boundary that ``old`` had too, and how many old ones follow it.

        None: the boundary may lie beyond ``text``.
        """
        shift, limit = len(new) - (stop - start), start + len(new)
        kept: dict[int, int] = {}
        at = 0
        for i, piece in enumerate(old):
            if at >= stop:
                kept[at + shift] = len(old) - i
            at += len(piece)
        pieces: list[str] = []
        for match in self.pattern.finditer(text):
            p = match.start()
            if p >= limit and p in kept and (whole or p + _AHEAD < len(text)):
                return pieces, kept[p]
            pieces.append(match[0])
        return (pieces, 0) if whole else None


def first_counts(text: str, pattern: regex.Pattern, counts: PieceCounts) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and token counts of the pre-tokens of a text."""
    pieces = pattern.findall(text)
    return np.fromiter(map(len, pieces), np.int64, len(pieces)), np.fromiter(map(counts.__getitem__, pieces), np.int64, len(pieces))


def revision(key: Column, text: Column) -> Column:
    """Three edits that depend on the id and the length: a cut, an insertion and a replacement."""
    n, h = F.coalesce(F.length(text), F.lit(0)), F.pmod(F.xxhash64(key), F.lit(97))
    at = lambda share: F.floor(n * (F.lit(share) + h / 1000)).cast("int")
    edit = lambda start, size, new: F.struct(start.alias("start"), (start + size).cast("int").alias("stop"), F.lit(new).alias("text"))
    return F.array(edit(at(0.2), 5, ""), edit(at(0.45), 0, " (as amended in 2024)"), edit(at(0.7), 7, "Revised:\n"))


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows), fields, strict=True)], names=[n for n, _ in fields])


def trees(docs: DataFrame, tokenizer: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``TREE``. ``tokenizer`` is a byte-level ``tokenizers`` file, ``pattern`` its
    splitting expression."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = regex.compile(pattern)
        counts = PieceCounts(CachedEncoder.loaded(tokenizer, True))
        rows, held = [], 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                body = text.as_py() or ""
                lengths, tokens = first_counts(body, split, counts)
                rows.append((key, body, pack(lengths), pack(tokens), int(tokens.sum())))
                held += len(body)
                if held >= _FLUSH:
                    yield _batch(rows, TREE)
                    rows, held = [], 0
        if rows:
            yield _batch(rows, TREE)

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(tidy(run, keeps=True), TREE)


def edited(kept: DataFrame, edits: Column, tokenizer: str, pattern: str) -> DataFrame:
    """Rows of ``trees`` after their edits, a column of the type ``EDITS``: ``EDITED``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = regex.compile(pattern)
        counts = PieceCounts(CachedEncoder.loaded(tokenizer, True))
        rows, held = [], 0
        for batch in batches:
            for key, text, lengths, tokens, before, changes in zip(*batch.columns, strict=True):
                document = EditableCount(text.as_py(), unpack(lengths.as_py()), unpack(tokens.as_py()), split, counts)
                for change in (changes := changes.as_py()):
                    document.edit(change["start"], change["stop"], change["text"] or "")
                body, sizes, known = document.state()
                rows.append((key.as_py(), body, pack(sizes), pack(known), document.total, before.as_py(), len(changes), document.reencoded))
                held += len(body)
                if held >= _FLUSH:
                    yield _batch(rows, EDITED)
                    rows, held = [], 0
        if rows:
            yield _batch(rows, EDITED)

    rows = kept.select("doc_id", "text", "lengths", "counts", "n_tokens", edits.cast(EDITS).alias("edits"))
    changed = F.coalesce(F.size("edits") > 0, F.lit(False))
    same = rows.filter(~changed).select("doc_id", "text", "lengths", "counts", "n_tokens", F.col("n_tokens").alias("n_before"), F.lit(0).alias("n_edits"), F.lit(0).cast("long").alias("n_reencoded"))
    return rows.filter(changed).mapInArrow(tidy(run, keeps=True), EDITED).unionByName(same)


def keep(found: DataFrame, name: str = "trees") -> DataFrame:
    """Rows of ``trees`` or ``edited`` written to the shared folder and read back."""
    path = shared_path(found.sparkSession, name)
    found.write.option("compression", "zstd").parquet(path)
    return found.sparkSession.read.schema(found.schema).parquet(path)


def _counted(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.col("n_before").alias("n_tokens"), "n_edits", F.col("n_tokens").alias("n_tokens_after"), "n_reencoded")


def count_edits(docs: DataFrame, edits: Callable[[Column, Column], Column], tokenizer: str, pattern: str) -> DataFrame:
    """Keep the trees of ``docs``, then edit them: doc_id, n_tokens, n_edits, n_tokens_after, n_reencoded.

    ``edits`` makes the edits from the id and the text.
    """
    kept = keep(trees(docs, tokenizer, pattern))
    return _counted(edited(kept, edits(F.col("doc_id"), F.col("text")), tokenizer, pattern))


def with_edits(kept: DataFrame, edits: DataFrame, tokenizer: str, pattern: str) -> DataFrame:
    """``edited`` for edits in a table (doc_id, seq, start, stop, text), applied in order of seq."""
    per = edits.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "start", "stop", "text"))), lambda e: F.struct(e["start"].cast("int").alias("start"), e["stop"].cast("int").alias("stop"), e["text"].alias("text"))).alias("edits_"))
    return edited(kept.join(per, "doc_id", "left"), F.col("edits_"), tokenizer, pattern)

"""Operator 12: byte-pair encoding and decoding, by batched merge rounds in numpy.

Symbols of many words lie in one flat array. In a round every pair of neighbours is looked up by binary
search among the sorted keys of the merges, each word takes its pair of lowest rank, and all places of that pair
are merged from the left at once; words without a known pair leave the array. Merging all places at once gives
what one at a time gives, because a merge never makes a pair that ranks before it: a merge that uses a symbol
comes after the one that makes it. (For a vocabulary in which that does not hold, one place is merged in a round.)

Which words there are: distinct pieces of a run of texts, cut where the tokenizer must cut as well
(``lectern.llm.encoding``), so a piece is merged once and its ids are laid end to end by one take.
Normalization and pre-tokenization are the file's own. The text of a special token is that token. Ids are decoded to
their tokens, joined by a space or as the file's byte-level decoder joins them.

A round goes over all words that are left, and a word of n symbols may take n rounds. Words of more than ``LONG``
symbols therefore have rounds of their own, from the lowest rank up, that touch only the places of that rank and
their neighbours. Memory: one slice of texts and ``remembered`` pieces.

Defined results: null and empty texts have no ids, and no ids decode to the empty text; null ids likewise;
ids that the vocabulary lacks are skipped; repeated rows are encoded each; an empty table gives no rows;
further columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import chunks, kept, tidy
from lectern.llm.encoding import _LETTERS, _TOGETHER, _VISIBLE, CachedEncoder

#: Bytes of text that are encoded at once, pieces that are remembered between them, ids that are decoded at once.
SLICE, REMEMBERED, IDS = 4 << 20, 500_000, 2 << 20
LONG = 1000
_NONE = np.iinfo(np.int64).max


class Merges:
    """The merges of a ``tokenizers`` file as arrays sorted by pair: keys, ranks and what a pair becomes."""

    def __init__(self, model: dict):
        if model.get("type", "BPE") != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges") or model.get("continuing_subword_prefix"):
            raise ValueError("only plain byte-pair merges are known")
        vocabulary, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ", 1)) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left, right = (np.array([vocabulary[p[side]] for p in pairs], np.int64) for side in (0, 1))
        made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        order = np.argsort(left << 32 | right)
        self.keys, self.ranks, self.made = (left << 32 | right)[order], order.astype(np.int64), made[order]
        used = np.full(max(vocabulary.values()) + 1, _NONE)
        np.minimum.at(used, np.concatenate((left, right)), np.tile(np.arange(len(pairs)), 2))
        self.in_order = bool((used[made] > np.arange(len(pairs))).all())
        shown = [chr(_VISIBLE.get(b, b)) for b in range(256)]
        #: The symbol of each character that stands for a byte, inside a word and at its end; -1: the file has none.
        self.inside, self.last = (np.full(512, -1, np.int64) for _ in range(2))
        for c in shown:
            self.inside[ord(c)], self.last[ord(c)] = vocabulary.get(c, -1), vocabulary.get(c + suffix, -1)

    def symbols(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all words, of characters that stand for bytes, and the word of each symbol."""
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        sizes = np.array([len(w) for w in words], np.int64)
        found, ends = self.inside[code], np.cumsum(sizes)[sizes > 0] - 1
        found[ends] = self.last[code[ends]]
        word = np.repeat(np.arange(len(words)), sizes)
        return found[found >= 0], word[found >= 0]

    def merged(self, symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same after all merges, in order of words."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        if self.in_order:
            sizes = np.bincount(word)
            for w in np.flatnonzero(sizes > LONG):
                own = self._long(symbol[word == w])
                done.append((own, np.full(len(own), w)))
            if done:
                short = sizes[word] <= LONG
                symbol, word = symbol[short], word[short]
        while len(symbol):
            pair = symbol[:-1] << 32 | symbol[1:]
            at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
            known = (word[:-1] == word[1:]) & (self.keys[at] == pair)
            rank = np.full(len(symbol), _NONE)
            rank[:-1][known] = self.ranks[at[known]]
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            least = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.append(first, len(word))))
            over = least == _NONE
            chosen = np.flatnonzero(~over & (rank == least))
            if len(chosen):
                chosen = self._apart(chosen, word)
                symbol[chosen] = self.made[at[chosen]]
            gone = np.zeros(len(symbol), bool)
            gone[chosen + 1] = True
            if over.any():
                done.append((symbol[over], word[over]))
            left = ~over & ~gone
            symbol, word = symbol[left], word[left]
        if not done:
            return symbol, word
        symbol, word = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(word, kind="stable")
        return symbol[order], word[order]

    def _long(self, symbol: np.ndarray) -> np.ndarray:
        """The same for one word, by rank: places wait for the rank of their pair."""
        n = len(symbol)
        after, before, live = np.arange(1, n + 1), np.arange(-1, n - 1), np.ones(n, bool)
        waiting: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def offer(places: np.ndarray) -> None:
            places = places[after[places] < n]
            pair = symbol[places] << 32 | symbol[after[places]]
            at = np.minimum(np.searchsorted(self.keys, pair), len(self.keys) - 1)
            known = self.keys[at] == pair
            places, at = places[known], at[known]
            order = np.argsort(at, kind="stable")
            starts = np.flatnonzero(np.diff(at[order], prepend=-1))
            for entry, own in zip(at[order][starts].tolist(), np.split(places[order], starts[1:]), strict=False):
                if entry not in waiting:
                    heapq.heappush(ranks, (int(self.ranks[entry]), entry))
                waiting.setdefault(entry, []).append(own)

        offer(np.arange(n))
        while ranks:
            _, entry = heapq.heappop(ranks)
            places = np.unique(np.concatenate(waiting.pop(entry)))
            places = places[live[places] & (after[places] < n)]
            places = places[symbol[places] << 32 | symbol[after[places]] == self.keys[entry]]
            if not len(places):
                continue
            number = np.arange(len(places))
            start = np.concatenate(([True], after[places[:-1]] != places[1:]))
            places = places[(number - np.maximum.accumulate(np.where(start, number, 0))) % 2 == 0]
            second = after[places]
            symbol[places], live[second] = self.made[entry], False
            after[places] = after[second]
            inner = after[places] < n
            before[after[places][inner]] = places[inner]
            offer(np.unique(np.concatenate((places, before[places][before[places] >= 0]))))
        return symbol[live]

    def _apart(self, chosen: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Places whose pairs share no symbol, from the left: of aaaa the first and the third."""
        if not self.in_order:
            return chosen[np.concatenate(([True], np.diff(word[chosen]) > 0))]
        number = np.arange(len(chosen))
        start = np.concatenate(([True], np.diff(chosen) > 1))
        return chosen[(number - np.maximum.accumulate(np.where(start, number, 0))) % 2 == 0]


class MergeEncoder(CachedEncoder):
    """``CachedEncoder`` whose pieces are merged here, not by the tokenizer."""

    def __init__(self, path: str, spaced: bool, limit: int = REMEMBERED):
        super().__init__(path, spaced, limit)
        self.merges = Merges(json.loads(Path(path).read_text(encoding="utf-8"))["model"])
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.at_special = re.compile("|".join(f"({re.escape(s)})" for s in self.special) or "($^)")

    @classmethod
    def loaded(cls, path: str, spaced: bool, limit: int = REMEMBERED) -> MergeEncoder:
        return kept((cls.__name__, path, spaced, limit), lambda: cls(path, spaced, limit))

    def _words(self, text: str) -> list[str]:
        """A text's pre-tokens, of characters that stand for bytes."""
        t = self.tokenizer
        text = t.normalizer.normalize_str(text) if t.normalizer else text
        return [w for w, _ in t.pre_tokenizer.pre_tokenize_str(text)] if text else []

    def _merged(self, words: list[str], ends: np.ndarray) -> list[np.ndarray]:
        """Ids of groups of words; ``ends`` tells where each group's end."""
        ids, word = self.merges.merged(*self.merges.symbols(words))
        return np.split(ids.astype(np.uint32), np.searchsorted(word, ends[:-1])) if len(ends) else []

    def _learned(self, new: pa.Array) -> list[bytes]:
        names = new.to_pylist()
        if self.spaced:
            return [x.tobytes() for x in self._whole(names)]
        found = [b""] * len(names)
        # pieces of letters are a word each, so they are normalized and mapped to bytes together
        alike = pc.match_substring_regex(new, _LETTERS).to_numpy(zero_copy_only=False)
        rest = np.flatnonzero(~alike).tolist()
        for a in range(0, int(alike.sum()), _TOGETHER):
            part = np.flatnonzero(alike)[a : a + _TOGETHER].tolist()
            words = self._words(" ".join([names[i] for i in part]))
            if len(words) != len(part):
                rest += part
                continue
            for i, ids in zip(part, self._merged(words, np.arange(1, len(part) + 1)), strict=True):
                found[i] = ids.tobytes()
        for i, ids in zip(rest, self._whole([names[i] for i in rest]), strict=True):
            found[i] = ids.tobytes()
        return found

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        words: list[str] = []
        ends, special = [], []
        for text in texts:
            for part in [p for p in self.at_special.split(text) if p]:
                if part in self.special:
                    special.append((len(words), self.special[part]))
                    words.append("")
                else:
                    words += self._words(part)
            ends.append(len(words))
        if not special:
            return self._merged(words, np.array(ends, np.int64))
        ids, word = self.merges.merged(*self.merges.symbols(words))
        places, own = np.array(special, np.int64).T
        at = np.searchsorted(word, places)
        ids, word = np.insert(ids, at, own), np.insert(word, at, places)
        return np.split(ids.astype(np.uint32), np.searchsorted(word, ends[:-1]))


def encode(docs: DataFrame, tokenizer: str, spaced: bool = False, id_col: str = "doc_id", text_col: str = "text", remembered: int = REMEMBERED) -> DataFrame:
    """(doc_id, ids): each row's ids by the ``tokenizers`` file at path ``tokenizer``.

    ``spaced``: the vocabulary keeps a leading space with the word; otherwise white space is dropped.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = MergeEncoder.loaded(tokenizer, spaced, remembered)
        for batch in batches:
            for a, b in chunks(batch.column(1), SLICE):
                ids, offsets = encoder.encode(batch.column(1).slice(a, b - a))
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], names=["doc_id", "ids"])

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(tidy(run, keeps=True), "doc_id long, ids array<int>")


class Decoder:
    """Texts of ids: the tokens joined by a space, or the bytes that a byte-level file's tokens stand for."""

    def __init__(self, path: str):
        file = json.loads(Path(path).read_text(encoding="utf-8"))
        kind = (file.get("decoder") or {}).get("type")
        if kind not in (None, "ByteLevel"):
            raise ValueError(f"the decoder {kind} is not known")
        self.joined = kind is None
        vocabulary = file["model"]["vocab"] | {t["content"]: t["id"] for t in file.get("added_tokens") or []}
        back = {chr(_VISIBLE.get(b, b)): b for b in range(256)}
        tokens: list[bytes | None] = [None] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            own = None if self.joined else [back.get(c) for c in token]
            tokens[i] = token.encode() if own is None or None in own else bytes(own)
        self.tokens = pa.array(tokens, pa.large_binary())

    def texts(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        known = (ids >= 0) & (ids < len(self.tokens))
        known[known] = self.tokens.is_valid().to_numpy(zero_copy_only=False)[ids[known]]
        offsets = np.concatenate(([0], np.cumsum(known)))[offsets]
        own = pa.LargeListArray.from_arrays(pa.array(offsets), self.tokens.take(pa.array(ids[known])))
        whole = pc.binary_join(own, pa.scalar(b" " if self.joined else b"", pa.large_binary()))
        if self.joined:
            return whole.cast(pa.large_string()).cast(pa.string())
        return pa.array([x.decode("utf-8", "replace") for x in whole.to_pylist()], pa.string())


def decode(encoded: DataFrame, tokenizer: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, ids, decoded): the text that each row's ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = kept((Decoder.__name__, tokenizer), lambda: Decoder(tokenizer))
        for batch in batches:
            lists = batch.column(1)
            counts = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends, a = np.cumsum(counts), 0
            while a < len(lists):
                b = max(a + 1, int(np.searchsorted(ends, ends[a] - counts[a] + IDS, "right")))
                ids = lists.slice(a, b - a).flatten().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
                texts = decoder.texts(ids, np.concatenate(([0], np.cumsum(counts[a:b]))))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists.slice(a, b - a), texts], names=["doc_id", "ids", "decoded"])
                a = b

    return encoded.select(encoded[id_col].cast("long").alias("doc_id"), encoded[ids_col].cast("array<int>").alias("ids")).mapInArrow(tidy(run, keeps=True), "doc_id long, ids array<int>, decoded string")


def digests(decoded: DataFrame) -> DataFrame:
    """Of ``decode``: the number of ids, and checksums of the ids and of the text."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select("doc_id", F.greatest(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))

"""Exact tokenizer ids of many texts at once, through their distinct pieces.

Arrow cuts a run of texts into pieces and encodes them as a dictionary; each distinct piece gets its
ids from a cache or from the tokenizer, and one take over the pieces lays all ids end to end. A cut
is only made where the tokenizer's own splitting must break as well; texts for which that is not
certain, and those that hold the text of a special token, go to the tokenizer whole.

Ids are those of ``Tokenizer.encode(text, add_special_tokens=False)`` for the file as it is, so the
text of a special token in a document is that token.
"""

from __future__ import annotations

import os
import re

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from lectern.llm.common import kept

#: Stands between pieces; a text that holds it is encoded whole.
_CUT = "\x01"
_SPACE = r"[\s\v\x{85}\p{Z}\x{1c}-\x{1f}]"
#: Of three white-space characters, or of two at the end, several may be one pre-token.
_RUN = f"{_SPACE}{{3}}|{_SPACE}{{2}}$"
#: A comma or full stop that does not follow a letter or digit may belong to a run of marks; where letters
#: are normalized, some become a letter with a mark, so only letters that never do are trusted.
_GLUED = {True: r"[^\pL\pN][.,]", False: r"[^0-9A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{17f}][.,]"}
#: Beyond these letters, lower-casing need not commute with the tokenizer's normalization.
_FAR = r"[^\x00-\x{12f}\x{131}-\x{17f}]"
#: Pieces that can be encoded side by side: a word with the space before it; letters without case rules.
_WITH_SPACE = r"^ [^\s\v\x{85}\p{Z}\x{1c}-\x{1f}]+$"
_LETTERS = r"^[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{12f}\x{131}-\x{17f}]+$"
#: How byte-level vocabularies write bytes: visible Latin-1 characters stand for themselves, the
#: others, in order, for the characters from 256 on.
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_VISIBLE = {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in _SHOWN)}
#: Pieces that go to the tokenizer in one call, and the longest piece that is remembered.
_TOGETHER, _LONGEST = 1000, 64


class CachedEncoder:
    """Ids of whole texts.

    ``spaced``: the vocabulary keeps a leading space with the word (byte-level BPE); otherwise white
    space is dropped. ``limit`` pieces and their ids are remembered between calls, as two Arrow arrays
    (about 30 bytes each); when there are more, the older half goes.
    """

    def __init__(self, path: str, spaced: bool, limit: int = 500_000):
        self.tokenizer = Tokenizer.from_file(path)
        self.spaced, self.limit = spaced, limit
        self.pieces = pa.array([], pa.large_string())
        self.ids = pa.array([], pa.large_binary())
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.divider = special[0] if special else None
        self.divider_id = self.tokenizer.token_to_id(special[0]) if special else -1
        odd = [f"(?i:{re.escape(s)})" for s in special] + ([_CUT, _RUN] if spaced else [])
        self.odd = "|".join(odd) or "$^"
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.sizes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():
            self.sizes[i] = len(token) if spaced else token.endswith("</w>")

    @classmethod
    def loaded(cls, path: str, spaced: bool, limit: int = 500_000) -> "CachedEncoder":
        """One encoder per worker process, kept over tasks."""
        return kept((path, spaced, limit), lambda: cls(path, spaced, limit))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids (u32) end to end, and where each text's begin (one more for the end); null: none."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = pc.match_substring_regex(texts, self.odd)
        pieces = self._cut(pc.if_else(whole, "", texts))
        coded = pieces.values.slice(pieces.offsets[0].as_py(), pieces.offsets[-1].as_py() - pieces.offsets[0].as_py()).dictionary_encode()
        found = self._places(coded.dictionary)
        taken = self.ids.take(pa.array(found[coded.indices.to_numpy(zero_copy_only=False)]))
        ends = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1, 8 * taken.offset) // 4
        data = taken.buffers()[2]
        ids = np.frombuffer(data, np.uint32)[: ends[-1]] if data and ends[-1] else np.zeros(0, np.uint32)
        places = pieces.offsets.to_numpy(zero_copy_only=False)
        offsets = ends[places - places[0]]
        odd = np.flatnonzero(whole.to_numpy(zero_copy_only=False))
        if not len(odd):
            return ids, offsets
        whole_ids = self._whole([texts[i].as_py() for i in odd.tolist()])
        parts, at = [], 0
        added = np.zeros(len(offsets), np.int64)
        for i, own in zip(odd.tolist(), whole_ids, strict=True):  # such a text has no ids yet
            parts += [ids[at : offsets[i]], own]
            at = offsets[i]
            added[i + 1] = len(own)
        return np.concatenate([*parts, ids[at:]]), offsets + np.cumsum(added)

    def _cut(self, texts: pa.Array) -> pa.Array:
        glued = pc.match_substring_regex(texts, _GLUED[self.spaced])
        if self.spaced:
            out = pc.replace_substring(texts, " ", f"{_CUT} ")
            out = pc.replace_substring(out, "\n", f"{_CUT}\n{_CUT}")
            between = _CUT
        else:
            out = pc.if_else(pc.match_substring_regex(texts, _FAR), texts, pc.ascii_lower(texts))
            out = pc.replace_substring(out, "\n", " ")
            between = " "
        if not pc.all(glued).as_py():
            marked = pc.replace_substring(pc.replace_substring(out, ",", f"{between},"), ".", f"{between}.")
            out = pc.if_else(glued, out, marked)
        return pc.split_pattern(out, between).cast(pa.large_list(pa.large_string()))

    def _places(self, dictionary: pa.Array) -> np.ndarray:
        """Where in ``self.ids`` each piece is found, after the unknown ones are learned."""
        self._trim()
        at = pc.index_in(dictionary, value_set=self.pieces)
        unknown = at.is_null().to_numpy(zero_copy_only=False)
        places = at.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        if unknown.any():
            places[unknown] = len(self.ids) + np.arange(int(unknown.sum()))
            new = dictionary.filter(pa.array(unknown))
            self.ids = pa.concat_arrays([self.ids, pa.array(self._learned(new), pa.large_binary())])
            self.pieces = pa.concat_arrays([self.pieces, new])
        return places

    def _trim(self) -> None:
        if len(self.pieces) > self.limit:
            self.pieces, self.ids = (pa.concat_arrays([x.slice(len(x) - self.limit // 2)]) for x in (self.pieces, self.ids))
        longest = pc.max(pc.binary_length(self.pieces)).as_py() or 0
        if longest > 4 * _LONGEST:
            short = pc.less_equal(pc.binary_length(self.pieces), _LONGEST)
            self.pieces, self.ids = self.pieces.filter(short), self.ids.filter(short)

    def _learned(self, new: pa.Array) -> list[bytes]:
        names, found = new.to_pylist(), [b""] * len(new)
        alike = pc.match_substring_regex(new, _WITH_SPACE if self.spaced else _LETTERS).to_numpy(zero_copy_only=False)
        for chosen, merged in ((np.flatnonzero(alike).tolist(), self._side_by_side), (np.flatnonzero(~alike).tolist(), self._divided)):
            for a in range(0, len(chosen), _TOGETHER):
                part = chosen[a : a + _TOGETHER]
                for i, ids in zip(part, merged([names[i] for i in part]), strict=True):
                    found[i] = ids
        return found

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _side_by_side(self, pieces: list[str]) -> list[bytes]:
        """Pieces of which none can run into the next, encoded as one text."""
        ids = self._whole([("" if self.spaced else " ").join(pieces)])[0]
        if self.spaced:  # byte-level tokens are as long as what they stand for
            want = np.cumsum([len(p.encode()) for p in pieces])
            ends = np.cumsum(self.sizes[ids])
            after = np.searchsorted(ends, want) + 1
            exact = len(ends) and after[-1] == len(ids) and (ends[after - 1] == want).all()
        else:  # letters are one word each, and its last token says so
            after = np.flatnonzero(self.sizes[ids]) + 1
            exact = len(after) == len(pieces)
        return self._sliced(ids, after, after) if exact else self._divided(pieces)

    def _divided(self, pieces: list[str]) -> list[bytes]:
        """Any pieces, encoded as one text with a special token after each."""
        if self.divider is None:
            return [x.tobytes() for x in self._whole(pieces)]
        ids = self._whole(["".join(f"{p}{self.divider}" for p in pieces)])[0]
        ends = np.flatnonzero(ids == self.divider_id)
        if len(ends) != len(pieces):
            return [x.tobytes() for x in self._whole(pieces)]
        return self._sliced(ids, ends, ends + 1)

    @staticmethod
    def _sliced(ids: np.ndarray, ends: np.ndarray, following: np.ndarray) -> list[bytes]:
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *(4 * following[:-1]).tolist()], (4 * ends).tolist(), strict=True)]


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each text."""
    return np.insert(ids, offsets[1:], np.uint32(end_id)), offsets + np.arange(len(offsets))

"""Operator 1: secret scan through a trigram inverted index.

Each rule's regular expression is parsed into a Boolean query over byte trigrams. Documents are
grouped into segments; a segment's index maps every trigram that the rules mention to the sorted
numbers of its documents. The queries are answered by intersecting and uniting postings, and only
the candidates are verified with the expression itself. A rule whose expression implies no trigram
is verified on every document.

Defined results: a null text counts as empty; an empty text has no spans; rows are scanned one by
one, so repeated rows give repeated results; an empty table gives no rows; other columns are
ignored. Offsets are code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from re import _constants as C
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lectern.llm.common import tidy, utf8

ALL, AND, OR, TRI = "all", "and", "or", "tri"
#: More alternatives than this for one stretch of an expression are not multiplied out.
WIDE = 64


@dataclass(frozen=True)
class Rule:
    """A kind of span. ``accept`` may reject a match; ``base`` rules count in the digest.

    ``verify``: an expression with the same accepted matches that is cheaper to run; None: ``pattern``.
    """

    kind: str
    pattern: str
    accept: Callable[[re.Match], bool] | None = None
    base: bool = False
    verify: str | None = None


def _long_value(match: re.Match) -> bool:
    return len(match[2]) >= 12


def _long_key(match: re.Match) -> bool:
    return len(match[0]) >= 18


RULES = (
    Rule("assign", r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", _long_value, base=True),
    Rule("access", r"AKIA[A-Z0-9]+", _long_key, base=True),
    # a run of 16 or more is a maximal run, as the one-or-more form would match it
    Rule("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 16, base=True, verify=r"[0-9a-f]{16,}"),
    Rule("private_key", r"-----BEGIN (?:[A-Z0-9]+ ){0,4}PRIVATE KEY(?: BLOCK)?-----"),
    Rule("github", r"(?:gh[pousr]_[A-Za-z0-9]{36}|github_pat_[A-Za-z0-9_]{82})(?![A-Za-z0-9_])"),
    Rule("slack", r"xox[abprs]-[0-9A-Za-z-]{20,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}(?![0-9A-Za-z_-])"),
    Rule("stripe", r"[sr]k_live_[0-9A-Za-z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{16,}"),
)


def _trigrams(texts: frozenset[str]) -> tuple:
    """At least one of the texts occurs; case of A-Z is folded, as in the index."""
    parts = []
    for text in texts:
        raw = re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode())
        if len(raw) < 3:
            return (ALL,)
        parts.append(_both([(TRI, raw[i : i + 3]) for i in range(len(raw) - 2)]))
    return _either(parts)


def _both(parts: list[tuple]) -> tuple:
    kept = tuple(dict.fromkeys(p for p in parts if p != (ALL,)))
    return (ALL,) if not kept else kept[0] if len(kept) == 1 else (AND, kept)


def _either(parts: list[tuple]) -> tuple:
    kept = tuple(dict.fromkeys(parts))
    return (ALL,) if not kept or (ALL,) in kept else kept[0] if len(kept) == 1 else (OR, kept)


def _derive(nodes, fold: bool) -> tuple[frozenset[str] | None, tuple]:
    """For a sequence: the finite set of texts that it matches (None: unknown), and its query."""
    query: list[tuple] = []
    run: frozenset[str] = frozenset([""])
    exact = True
    for op, arg in nodes:
        texts, inner = _derive_one(op, arg, fold)
        query.append(inner)
        if texts is not None and len(run) * len(texts) <= WIDE:
            run = frozenset(a + b for a in run for b in texts)
            continue
        query.append(_trigrams(run))
        exact, run = False, texts if texts is not None and len(texts) <= WIDE else frozenset([""])
    query.append(_trigrams(run) if not exact else (ALL,))
    return (run, _both(query)) if exact else (None, _both(query))


def _derive_one(op, arg, fold: bool) -> tuple[frozenset[str] | None, tuple]:
    if op is C.LITERAL:
        return frozenset([chr(arg)]), (ALL,)
    if op is C.IN:
        chars = set()
        for kind, x in arg:
            if kind is C.LITERAL:
                chars.add(chr(x))
            elif kind is C.RANGE and x[1] - x[0] < WIDE:
                chars.update(map(chr, range(x[0], x[1] + 1)))
            else:
                return None, (ALL,)
        return (frozenset(chars), (ALL,)) if len(chars) <= 8 else (None, (ALL,))
    if op is C.SUBPATTERN:
        return _derive(arg[3], fold)
    if op is C.BRANCH:
        found = [_derive(x, fold) for x in arg[1]]
        if all(texts is not None for texts, _ in found):
            return frozenset().union(*(texts for texts, _ in found)), (ALL,)
        return None, _either([_trigrams(texts) if texts is not None else q for texts, q in found])
    if op in (C.MAX_REPEAT, C.MIN_REPEAT):
        low, high, inner = arg
        texts, query = _derive(inner, fold)
        if (low, high) == (0, 1) and texts is not None:
            return texts | {""}, (ALL,)
        if low == high and texts is not None and low <= 4 and len(texts) ** low <= WIDE:
            out = frozenset([""])
            for _ in range(low):
                out = frozenset(a + b for a in out for b in texts)
            return out, (ALL,)
        return None, (ALL,) if not low else _trigrams(texts) if texts is not None else query
    if op in (C.ASSERT, C.ASSERT_NOT, C.AT):
        return frozenset([""]), (ALL,)
    return None, (ALL,)


def trigram_query(pattern: str) -> tuple:
    """The Boolean trigram query that every match of ``pattern`` fulfils; ("all",) if none."""
    texts, query = _derive(_parser.parse(pattern), False)
    return _trigrams(texts) if texts is not None else query


def vocabulary(query: tuple) -> set[bytes]:
    if query[0] == TRI:
        return {query[1]}
    return set().union(*map(vocabulary, query[1])) if query[0] in (AND, OR) else set()


class SegmentIndex:
    """Postings of one segment: for each trigram of ``wanted`` the sorted document numbers."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, wanted: list[bytes], marks: np.ndarray):
        self.documents = len(offsets) - 1
        self.postings: dict[bytes, np.ndarray] = {}
        if len(data) < 3:
            return
        low = data + ((data >= 65) & (data <= 90)) * np.uint8(32)
        code = low[:-2].astype(np.int32) << 16
        code |= low[1:-1].astype(np.int32) << 8
        code |= low[2:]
        at = np.flatnonzero(marks[code])
        which = marks[code[at]].astype(np.int64) - 1
        document = np.searchsorted(offsets, at, "right") - 1
        inside = at + 2 < offsets[document + 1]
        pairs = np.unique(which[inside] * self.documents + document[inside])
        edges = np.searchsorted(pairs, np.arange(len(wanted) + 1) * self.documents)
        for i, trigram in enumerate(wanted):
            self.postings[trigram] = pairs[edges[i] : edges[i + 1]] - i * self.documents

    def answer(self, query: tuple) -> np.ndarray:
        if query[0] == ALL:
            return np.arange(self.documents)
        if query[0] == TRI:
            return self.postings.get(query[1], np.zeros(0, np.int64))
        found = sorted((self.answer(q) for q in query[1]), key=len)
        out = found[0]
        for other in found[1:]:
            if query[0] == AND and not len(out):
                break
            out = np.intersect1d(out, other, assume_unique=True) if query[0] == AND else np.union1d(out, other)
        return out


def marks_for(wanted: list[bytes]) -> np.ndarray:
    marks = np.zeros(1 << 24, np.uint8 if len(wanted) < 255 else np.uint16)
    for i, t in enumerate(wanted):
        marks[t[0] << 16 | t[1] << 8 | t[2]] = i + 1
    return marks


def _segments(column: pa.Array, size: int) -> Iterator[pa.Array]:
    """Runs of rows of about ``size`` bytes; a longer text is a segment of its own."""
    _, offsets = utf8(column)
    start = 0
    while start < len(column):
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + size, "right")) - 1)
        yield column.slice(start, end - start)
        start = end


def scan_segment(texts: pa.Array, rules: tuple[Rule, ...], queries: list[tuple], wanted: list[bytes], marks: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """For each text its spans as (start, rule number, end), sorted."""
    data, offsets = utf8(texts)
    index = SegmentIndex(data, offsets, wanted, marks)
    spans: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
    for number, (rule, query) in enumerate(zip(rules, queries, strict=True)):
        finder = re.compile(rule.verify or rule.pattern).finditer
        for document in index.answer(query).tolist():
            for match in finder(texts[document].as_py() or ""):
                if rule.accept is None or rule.accept(match):
                    spans[document].append((match.start(), number, match.end()))
    for found in spans:
        found.sort()
    return spans


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text", segment_bytes: int = 4 << 20) -> DataFrame:
    """One row per document: its id, the number of spans of each base rule, ``base_sha256``, ``spans``, and
    the numbers of the other rules' spans."""
    names = [rule.kind for rule in rules]
    first, last = ([i for i, rule in enumerate(rules) if rule.base is base] for base in (True, False))
    order = ["doc_id", *(f"n_{names[i]}" for i in first), "base_sha256", "spans", *(f"n_{names[i]}" for i in last)]
    schema = ", ".join(f"{name} {'string' if name in ('base_sha256', 'spans') else 'long'}" for name in order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [trigram_query(rule.pattern) for rule in rules]
        wanted = sorted(set().union(*map(vocabulary, queries)))
        marks = marks_for(wanted)
        for batch in batches:
            spans: list[list[tuple[int, int, int]]] = []
            for texts in _segments(batch.column(1), segment_bytes):
                spans += scan_segment(texts, rules, queries, wanted, marks)
            counts = np.zeros((len(rules), len(spans)), np.int64)
            base, every = [], []
            for i, found in enumerate(spans):
                for _, number, _ in found:
                    counts[number, i] += 1
                named = [(rules[k].base, f"{names[k]}:{a}:{b}") for a, k, b in found]
                every.append(",".join(x for _, x in named))
                base.append(hashlib.sha256(",".join(x for own, x in named if own).encode()).hexdigest())
            columns = [batch.column(0), *(pa.array(counts[i]) for i in first), pa.array(base, pa.string()), pa.array(every, pa.string()), *(pa.array(counts[i]) for i in last)]
            yield pa.RecordBatch.from_arrays(columns, names=order)

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(tidy(run), schema)

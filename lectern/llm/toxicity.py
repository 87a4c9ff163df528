"""Operator 4: toxicity from subword bags averaged into a linear softmax.

A word is the bag of its character n-grams (and itself), hashed into buckets with one embedding
each. A window of consecutive words is the average of all their n-gram vectors; a linear softmax
on that average says how likely it is toxic. Vectors and softmax are trained jointly, in numpy, on
a bounded sample of labelled documents. Labels mark documents, not places: the first pass gives
every window its document's label; later passes keep, in toxic documents, the windows that the
model finds toxic, and the best one of each document. A document's score is that of its
highest window, mapped to a probability by a logistic fit on a part of the sample that was not
trained on; every window of the whole text takes part, and of a run without white space every n-gram,
because longer runs are cut into overlapping parts that count as words. An unseen misspelling shares
n-grams with the words that were seen.

The model is linear in the n-gram vectors, so a worker needs one number per bucket. Texts are scored
many at a time: a run of texts is cut into its distinct words, whose n-grams are hashed and summed once
in numpy, and nothing is remembered from one run to the next. Sums are of whole numbers, so a text has
the same score wherever it stands.

Defined results: null and empty texts have no window and score 0; repeated rows get equal scores; of
several labels of one id the highest counts; a word that repeats the one before it counts once; without
any labelled document every score is 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import chunks, stored, tidy
from lectern.llm.shingles import U, mix

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
THRESHOLD = 0.7
#: A run of characters longer than this is several words, of which neighbours share OVERLAP characters.
LONGEST, OVERLAP = 64, 4
_STRIP = ".,;:!?\"'()[]{}*#%$&|-_<>/\\"
_SIZES = (3, 4, 5)
_BASE = U(0x9E3779B97F4A7C15)
_POWERS = np.array([pow(int(_BASE), i, 1 << 64) for i in range(LONGEST + 3)], U)
#: Words whose n-grams are hashed at once.
_TOGETHER = 16_384
#: Weights are kept as whole numbers of this fraction.
_UNIT = float(1 << 32)


@dataclass(frozen=True)
class Settings:
    """``max_toxic`` and ``max_clean`` labelled documents of ``max_chars`` at most are trained on.

    An epoch sees all windows of toxic documents, ``clean_windows`` random ones of clean documents, and
    from the second on the ``hard_windows`` of those that look most toxic.
    """

    max_toxic: int = 1500
    max_clean: int = 3000
    max_chars: int = 40_000
    buckets: int = 1 << 18
    dim: int = 8
    window: int = 6
    epochs: int = 4
    batch: int = 512
    rate: float = 0.5
    clean_windows: int = 60_000
    hard_windows: int = 20_000
    seed: int = 7


def _unrepeated(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without words that repeat the one before them in their text: one alone could fill windows."""
    keep = np.ones(len(codes), bool)
    keep[1:] = codes[1:] != codes[:-1]
    keep[first[:-1][first[:-1] < first[1:]]] = True
    before = np.concatenate(([0], np.cumsum(keep)))
    return codes[keep], before[first]


def words(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct words, lower-cased and without marks around them; each text's words, as numbers of
    those, end to end; and where each text's begin (one more for the end)."""
    lists = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    flat = lists.flatten().dictionary_encode()
    codes = flat.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    first = lists.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    first = first - first[0]
    there = pc.not_equal(flat.dictionary, "").to_numpy(zero_copy_only=False)[codes] if len(codes) else np.zeros(0, bool)
    codes, first = _unrepeated(codes[there], np.concatenate(([0], np.cumsum(there)))[first])
    cores = pc.utf8_trim(flat.dictionary, _STRIP)
    long = np.flatnonzero(pc.greater(pc.utf8_length(cores), LONGEST).to_numpy(zero_copy_only=False)) if len(cores) else []
    names = cores.to_pylist()
    if len(long):
        numbers: dict[str, int] = {}
        table, many = np.arange(len(names)), np.ones(len(names), np.int64)
        parts = {i: [numbers.setdefault(p, len(names) + len(numbers)) for p in _parts(names[i])] for i in long.tolist()}
        for i, own in parts.items():
            many[i] = len(own)
            names[i] = ""  # no text has it any more
        begin = np.cumsum(many) - many
        table = np.repeat(table, many)
        for i, own in parts.items():
            table[begin[i] : begin[i] + len(own)] = own
        size = many[codes]
        before = np.concatenate(([0], np.cumsum(size)))
        codes = table[np.repeat(begin[codes] - before[:-1], size) + np.arange(before[-1])]
        names += numbers
        codes, first = _unrepeated(codes, before[first])
    return names, codes, first


def _parts(core: str) -> list[str]:
    """Consecutive parts of a run; neighbours share OVERLAP characters, so every n-gram lies in one."""
    return [core[i : i + LONGEST] for i in range(0, len(core) - OVERLAP, LONGEST - OVERLAP)]


def ngrams(names: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word and its n-grams end to end, and how many each word has.

    A word is marked at both ends; it and its runs of 3 to 5 characters are hashed.
    """
    if not names:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    marked = "".join([f"<{x}>" for x in names])
    text = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), np.uint32).astype(U) + U(1)
    sizes = np.fromiter(map(len, names), np.int64, len(names)) + 2
    ends = np.cumsum(sizes)
    place = np.arange(len(text)) - np.repeat(ends - sizes, sizes)
    left = np.repeat(sizes, sizes) - place
    shift = U(64 - buckets.bit_length() + 1)
    found, valid = np.zeros((len(text), len(_SIZES) + 1), np.int64), np.zeros((len(text), len(_SIZES) + 1), bool)
    whole = np.add.reduceat(text * _POWERS[place], ends - sizes)
    found[ends - sizes, 0], valid[ends - sizes, 0] = (mix(whole) >> shift).astype(np.int64), True
    run = text
    for n in range(2, max(_SIZES) + 1):
        run = run[:-1] * _BASE + text[n - 1 :] if len(text) >= n else run[:0]
        if n in _SIZES:
            found[: len(run), _SIZES.index(n) + 1] = mix(run + U(n)) >> shift
            valid[: len(run), _SIZES.index(n) + 1] = left[: len(run)] >= n
    return found[valid], 1 + sum(np.maximum(sizes - n + 1, 0) for n in _SIZES)


class Windows:
    """Windows of the sample as word numbers, and each word's bucket numbers once."""

    def __init__(self, texts: list[str], size: int, buckets: int):
        numbers: dict[str, int] = {}
        rows, owner = [np.zeros((0, size), np.int32)], [np.zeros(0, np.int32)]
        column = pa.array(texts, pa.large_string())
        for a, b in chunks(column):
            names, codes, first = words(column.slice(a, b - a))
            codes = np.array([numbers.setdefault(w, len(numbers)) for w in names], np.int32)[codes] if len(codes) else np.zeros(0, np.int32)
            n = np.diff(first)
            per = -(-n // size)
            begin = size * (np.cumsum(per) - per)
            padded = np.full(size * int(per.sum()), -1, np.int32)
            padded[np.repeat(begin - first[:-1], n) + np.arange(len(codes))] = codes
            rows.append(padded.reshape(-1, size))
            owner.append(np.repeat(np.arange(a, b, dtype=np.int32), per))
        self.rows, self.owner = np.concatenate(rows), np.concatenate(owner)
        self.flat, self.sizes = ngrams(list(numbers), buckets)
        self.flat = self.flat.astype(np.int32)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def grams(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the chosen windows end to end, and how many each has."""
        taken = self.rows[chosen]
        there = taken >= 0
        ids = taken[there]
        sizes = self.sizes[ids]
        before = np.cumsum(sizes) - sizes
        flat = self.flat[np.repeat(self.starts[ids] - before, sizes) + np.arange(int(sizes.sum()))]
        edges = np.cumsum(there.sum(axis=1)) - there.sum(axis=1)
        return flat, np.add.reduceat(sizes, edges)


@dataclass
class Model:
    """``weights``: a bucket's contribution to the logit of its window's average, in ``_UNIT``."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float
    window: int

    def logits(self, texts: pa.Array) -> np.ndarray:
        """Of each text's highest window; without words, that of certain cleanness."""
        names, codes, first = words(texts)
        out = np.full(len(texts), -np.inf)
        if not len(codes):
            return out
        sums, sizes = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
        for a in range(0, len(names), _TOGETHER):
            flat, own = ngrams(names[a : a + _TOGETHER], len(self.weights))
            sums[a : a + _TOGETHER], sizes[a : a + _TOGETHER] = np.add.reduceat(self.weights[flat], np.cumsum(own) - own), own
        total = np.concatenate(([0], np.cumsum(sums[codes])))
        count = np.concatenate(([0], np.cumsum(sizes[codes])))
        n = np.diff(first)
        start = np.arange(len(codes))
        end = np.minimum(start + self.window, np.repeat(first[1:], n))
        logits = self.bias + (total[end] - total[start]) / _UNIT / (count[end] - count[start])
        whole = end - start == self.window
        whole[first[:-1][n > 0]] = True  # a text of few words is one window
        logits[~whole] = -np.inf
        out[n > 0] = np.maximum.reduceat(logits, first[:-1][n > 0])
        return out

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros(len(texts))
        for a, b in chunks(texts, 4 << 20):
            logits = self.logits(texts.slice(a, b - a))
            out[a:b] = np.where(np.isfinite(logits), _sigmoid(self.slope * np.where(np.isfinite(logits), logits, 0.0) + self.shift), 0.0)
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def train(texts: list[str], toxic: list[int], settings: Settings = Settings()) -> Model:
    """A model of all texts. Its probabilities are fitted on logits that each half of the texts got from
    a model of the other half, so no text is judged by what learnt it.

    Deterministic for a given order of texts. Where a half lacks a class, the texts judge themselves.
    """
    found = [trained(part, texts, toxic, settings) for part in PARTS]
    return fitted(found[0][0], [logits for _, logits in found], toxic)


#: What is trained by itself: the model of all texts, and those of the texts at even and at odd places.
PARTS = (None, 0, 1)


def trained(part: int | None, texts: list[str], toxic: list[int], settings: Settings) -> tuple[Model, np.ndarray]:
    """The model of a part, and the logits of the texts that it judges (the others': NaN)."""
    halves = [[*range(i, len(texts), 2)] for i in (0, 1)]
    apart = all({toxic[i] for i in half} == {0, 1} for half in halves)
    learnt = halves[part] if part is not None and apart else [*range(len(texts))] if part is None else []
    judged = halves[1 - part] if part is not None and apart else [*range(len(texts))] if part is None and not apart else []
    model = embed([texts[i] for i in learnt], [toxic[i] for i in learnt], settings)
    logits = np.full(len(texts), np.nan)
    for i in judged:
        logits[i : i + 1] = model.logits(pa.array([texts[i]], pa.large_string()))
    return model, logits


def fitted(model: Model, logits: list[np.ndarray], toxic: list[int]) -> Model:
    """``model`` with probabilities fitted on the logits of all parts."""
    judged = np.full(len(toxic), -np.inf)
    for own in logits:
        judged = np.where(np.isnan(own), judged, own)
    known = np.isfinite(judged)
    if known.any():
        model.slope, model.shift = calibrate(judged[known], np.array(toxic, np.float64)[known])
    return model


def gradients(vectors: np.ndarray, matrix: np.ndarray, bias: np.ndarray, flat: np.ndarray, sizes: np.ndarray, labels: np.ndarray):
    """Of the mean cross-entropy of windows: ((buckets, their vectors' rows), matrix, bias)."""
    own = vectors.dtype
    hidden = np.add.reduceat(vectors[flat], np.cumsum(sizes) - sizes, axis=0) / sizes[:, None].astype(own)
    scores = hidden @ matrix + bias
    p = np.exp(scores - scores.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    p[np.arange(len(labels)), labels] -= 1.0
    p /= len(labels)
    g_hidden = (p @ matrix.T) / sizes[:, None].astype(own)
    by = np.argsort(flat, kind="stable")
    unique, first = np.unique(flat[by], return_index=True)
    return (unique, np.add.reduceat(np.repeat(g_hidden, sizes, axis=0)[by], first, axis=0)), hidden.T @ p, p.sum(axis=0)


def embed(texts: list[str], toxic: list[int], settings: Settings) -> Model:
    """Jointly trained embeddings and softmax; without calibration every score is nearly 0."""
    s, rng = settings, np.random.default_rng(settings.seed)
    windows = Windows(texts, s.window, s.buckets)
    labels = np.array(toxic, np.float64)
    owner = windows.owner
    marks = labels[owner] if len(owner) else np.zeros(0)
    positive, negative = np.flatnonzero(marks == 1), np.flatnonzero(marks == 0)
    vectors = rng.normal(0, 0.1, (s.buckets, s.dim)).astype(np.float32)
    matrix = rng.normal(0, 0.1, (s.dim, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    squares_v, squares_m, squares_b = np.full(s.buckets, 1e-6, np.float32), np.full((s.dim, 2), 1e-6, np.float32), np.full(2, 1e-6, np.float32)

    def projected() -> tuple[np.ndarray, float]:
        direction = matrix[:, 1] - matrix[:, 0]
        return (vectors @ direction).astype(np.float64), float(bias[1] - bias[0])

    def logits_of(numbers: np.ndarray, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(len(numbers))
        for a in range(0, len(numbers), 8192):
            flat, sizes = windows.grams(numbers[a : a + 8192])
            out[a : a + 8192] = np.add.reduceat(weights[flat], np.cumsum(sizes) - sizes) / sizes
        return out

    for epoch in range(s.epochs if len(positive) and len(negative) else 0):
        if epoch:  # which windows of the toxic documents are toxic themselves
            weights, offset = projected()
            logits, hard = logits_of(positive, weights) + offset, logits_of(negative, weights)
            best: dict[int, tuple[float, int]] = {}
            for k, x in zip(positive.tolist(), logits.tolist(), strict=True):
                i = int(owner[k])
                best[i] = max(best.get(i, (-np.inf, -1)), (x, k))
            marks[positive] = logits > 0
            marks[[k for _, k in best.values()]] = 1.0
        clean = rng.permutation(negative)[: s.clean_windows]
        if epoch:  # and the clean windows that look most toxic so far
            clean = np.union1d(clean, negative[np.argsort(hard, kind="stable")[-s.hard_windows :]])
        order = rng.permutation(np.concatenate((positive, clean)))
        for a in range(0, len(order), s.batch):
            chosen = order[a : a + s.batch]
            flat, sizes = windows.grams(chosen)
            (unique, g_vectors), g_matrix, g_bias = (x if isinstance(x, tuple) else 32.0 * x for x in gradients(vectors, matrix, bias, flat, sizes, marks[chosen].astype(np.int64)))
            g_vectors *= 32.0  # steps are scaled by their history, which begins small
            squares_v[unique] += (g_vectors**2).mean(axis=1)
            vectors[unique] -= s.rate * g_vectors / np.sqrt(squares_v[unique])[:, None]
            squares_m += g_matrix**2
            matrix -= 0.1 * s.rate * g_matrix / np.sqrt(squares_m)
            squares_b += g_bias**2
            bias -= 0.1 * s.rate * g_bias / np.sqrt(squares_b)
    weights, offset = projected()
    return Model(np.rint(weights * _UNIT).astype(np.int64), offset if len(labels) else 0.0, 0.0, -30.0, s.window)


def calibrate(logits: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """A slightly regularised logistic fit of labels on logits, by Newton's method."""
    centre, spread = float(logits.mean()), float(logits.std()) or 1.0
    x = np.stack(((logits - centre) / spread, np.ones_like(logits)), axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = _sigmoid(x @ w)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-2, 1e-3])
        step = np.linalg.solve(hessian, x.T @ (p - labels) + np.array([1e-2, 1e-3]) * w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / spread), float(w[1] - w[0] * centre / spread)


def fold(key: Column) -> Column:
    """crc32 of the id as text, modulo 3; rows where it is 1 are held out."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 3


def training_sample(docs: DataFrame, labels: DataFrame, settings: Settings) -> DataFrame:
    """A bounded number of labelled, not held out documents of each class: (key, toxic, text).

    The sample is chosen by hash among the ids of ``labels`` alone, so it is small before it
    meets the texts; the ids that are broadcast number ``max_toxic`` + ``max_clean`` at most. Of rows
    that repeat an id the least text is taken.
    """
    known = labels.select(labels["doc_id"].alias("key"), labels["toxic"].alias("toxic")).filter("key IS NOT NULL AND toxic IS NOT NULL")
    known = known.filter(fold(F.col("key")) != 1).groupBy("key").agg(F.max("toxic").alias("toxic"))
    chosen = None
    for value, most in ((0, settings.max_clean), (1, settings.max_toxic)):
        part = known.filter(F.col("toxic") == value).orderBy(F.xxhash64("key"), "key").limit(most)
        chosen = part if chosen is None else chosen.unionByName(part)
    ids = docs.sparkSession.createDataFrame([(r["key"], int(r["toxic"])) for r in chosen.collect()], "key long, toxic int")
    texts = docs.select(docs["doc_id"].alias("key"), docs["text"].alias("text")).filter(F.length("text") <= settings.max_chars)
    return texts.join(F.broadcast(ids), "key").groupBy("key", "toxic").agg(F.min("text").alias("text"))


_TRAINED = "part int, weights binary, bias double, logits binary, toxic binary"


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """``train`` on the sample, each part in a task of its own: all of them hold the sample, which is bounded."""
    sample = stored(training_sample(docs, labels, settings), "sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held).sort_by("key")
        part, texts, toxic = rows.column("part")[0].as_py(), rows.column("text").to_pylist(), rows.column("toxic").to_pylist()
        model, logits = trained(PARTS[part], texts, toxic, settings)
        whole = [model.weights.tobytes() if PARTS[part] is None else b"", logits.tobytes(), np.array(toxic, np.int64).tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array(whole[:1], pa.binary()), pa.array([model.bias]), pa.array(whole[1:2], pa.binary()), pa.array(whole[2:], pa.binary())], names=[x.split()[0] for x in _TRAINED.split(", ")])

    copies = sample.withColumn("part", F.explode(F.array(*map(F.lit, range(len(PARTS))))))
    found = {r["part"]: r for r in copies.repartitionById(len(PARTS), F.col("part")).mapInArrow(tidy(run), _TRAINED).collect()}
    if not found:
        return train([], [], settings)
    read = lambda i, name, kind: np.frombuffer(found[i][name], kind)
    model = Model(read(0, "weights", np.int64).copy(), found[0]["bias"], 0.0, -30.0, settings.window)
    return fitted(model, [read(i, "logits", np.float64) for i in range(len(PARTS))], read(0, "toxic", np.int64).tolist())


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``SCHEMA``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a number per bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.scores(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"]
            )

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"), (fold(docs["doc_id"]) == 1).alias("held_out"))
    return rows.mapInArrow(tidy(run), SCHEMA)


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), threshold: float = THRESHOLD) -> DataFrame:
    return score(docs, fit(docs, labels, settings), threshold)


def keep_clean(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those scored at or above ``threshold``; all columns are kept."""
    model, names = fit(docs, labels, settings), docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.scores(batch.column(names.index("text")))
            yield batch.filter(pa.array(scores < threshold))

    return docs.mapInArrow(tidy(run), docs.schema)

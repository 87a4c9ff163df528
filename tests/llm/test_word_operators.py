"""Periodic runs, byte-pair encoding and spelling variants, against plain Python and the tokenizer."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lectern.llm import bpe, periodic, registry, variants

BYTE, WORD = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
#: Further columns bear names that the operators use themselves.
SCHEMA = "doc_id long, text string, runs string, word string, n long, ids string, at long, best string, root string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "r", "w", 1, "i", 2, "b", "t") for i, t in rows], SCHEMA).repartition(parts)


AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \n\t\x0b "),
    (4, "a a a a a a b"),
    (4, "a a a a a a b"),
    (5, "x y x y x y x y z z z z z z"),
    (6, "a b c " * 500),
    (7, "same " * 2000),
    (None, "no id " * 9),
    (8, "wörter Wörter WÖRTER wÖrter abcdefgh abcdefgh abcdefgh abcdefg abcdefg"),
    (9, "<|endoftext|> <|ENDOFTEXT|> İstanbul ßσς don't 12345 语言"),
    (10, "u" * 20_000),
    (11, "\xa0 a\xa0a a\xa0a a\xa0a a\xa0a a\xa0a a\xa0a"),
]


# ------------------------------------------------------------------ periodic runs


def plain_runs(words, shortest=6, copies=4):
    found = {}
    for p in range(1, len(words) // copies + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            if j - i + p >= max(shortest, copies * p) and j > i:
                found.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted((s, n, p) for (s, n), p in found.items())


def plain_revised(doc_id, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def plain_digest(doc_id, text):
    words = plain_revised(doc_id, text)
    runs = plain_runs(words)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    longest = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return doc_id, len(runs), *longest, sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone))


STRETCH = st.builds(lambda unit, times, cut: (unit * times)[: cut or None], st.lists(st.sampled_from("abc"), min_size=1, max_size=6), st.integers(1, 9), st.integers(0, 30))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(STRETCH, max_size=8).map(lambda x: sum(x, [])), max_size=5))
def test_runs_are_those_of_a_plain_scan(texts):
    raw = [" ".join(t).encode() for t in texts]
    words, first = periodic.word_names(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64))
    assert periodic.find_runs(words, first).tolist() == [[i, *r] for i, t in enumerate(texts) for r in plain_runs(t)]


def test_runs_with_other_bounds():
    rng = random.Random(5)
    for _ in range(200):
        words = [rng.choice("ab") for _ in range(rng.randint(0, 60))]
        names, first = np.array([ord(w) for w in words], np.int64), np.array([0, len(words)])
        for shortest, copies in ((4, 3), (2, 5), (9, 3)):
            assert [tuple(r[1:]) for r in periodic.find_runs(names, first, shortest, copies).tolist()] == plain_runs(words, shortest, copies)


def test_periodic_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r) for r in registry.op11_periodic_runs(spark, sf_dir).collect()]
    assert sorted(got) == sorted(plain_digest(*r) for r in rows)
    assert any(r[1] for r in got)


def test_periodic_on_awkward_rows(spark):
    got = [tuple(r) for r in periodic.digests(periodic.collapse(frame(spark, AWKWARD), revise=periodic.recurring)).collect()]
    assert sorted(got, key=str) == sorted((plain_digest(*r) for r in AWKWARD), key=str)
    whole = {r["doc_id"]: r for r in periodic.collapse(frame(spark, AWKWARD)).collect()}
    assert whole[6]["collapsed"] == "a b c" and [tuple(r) for r in whole[6]["runs"]] == [(0, 1500, 3)]
    assert whole[7]["collapsed"] == "same" and whole[1]["runs"] == [] and whole[1]["collapsed"] == ""
    assert periodic.digests(periodic.collapse(frame(spark, []))).collect() == []


# ------------------------------------------------------------------ byte-pair encoding

PIECES = ["a", "Word", "İ,", "क़.", "ßσς", "ŉ.", "é", "É", "Σ", "J̌", "ﬁ", " ", "  ", "\n", "\n\n", "\t", ", ", ". ", "!,", "x́,", "3.14", "'s ", "don't ", "½", "-", "　", "\x1c", "\x01", "\xa0", "语", "$$$ ", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|> ", "aaaaaaa", "abcabcabc", "internationalisation "]


@pytest.mark.parametrize("path,spaced", [(BYTE, True), (WORD, False)])
@pytest.mark.parametrize("in_order", [True, False])
def test_ids_and_texts_are_the_tokenizers(path, spaced, in_order):
    own, want, decoder = bpe.MergeEncoder(path, spaced, limit=50), Tokenizer.from_file(path), bpe.Decoder(path)
    assert own.merges.in_order
    own.merges.in_order = in_order

    @settings(max_examples=500, deadline=None)
    @given(st.lists(st.lists(st.sampled_from(PIECES), max_size=25).map("".join), max_size=5))
    def check(texts):
        ids, offsets = own.encode(pa.array([*texts, None], pa.string()))
        lists = [want.encode(t, add_special_tokens=False).ids for t in [*texts, ""]]
        assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == lists
        assert decoder.texts(ids.astype(np.int64), offsets).to_pylist() == [want.decode(x, skip_special_tokens=False) for x in lists]

    check()


@pytest.mark.parametrize("path,spaced", [(BYTE, True), (WORD, False)])
def test_long_words(path, spaced):
    own, want, rng = bpe.MergeEncoder(path, spaced), Tokenizer.from_file(path), random.Random(2)
    for letters in ("a", "ab", "abcdefghijklmnopqrstuvwxyz"):
        text = " x ".join("".join(rng.choice(letters) for _ in range(n)) for n in (bpe.LONG, bpe.LONG + 1, 20_000))
        assert own.encode(pa.array([text]))[0].tolist() == want.encode(text, add_special_tokens=False).ids


def plain_tokens(doc_id, text):
    t = Tokenizer.from_file(WORD)
    ids = t.encode(text or "", add_special_tokens=False).ids
    return doc_id, len(ids), sha(" ".join(map(str, ids))), sha(t.decode(ids, skip_special_tokens=False))


def test_bpe_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    got = {r[0]: tuple(r) for r in registry.op12_bpe(spark, sf_dir).collect()}
    assert [got[r[0]] for r in rows] == [plain_tokens(*r) for r in rows]


def test_bpe_on_awkward_rows(spark):
    got = [tuple(r) for r in bpe.digests(bpe.decode(bpe.encode(frame(spark, AWKWARD), WORD), WORD)).collect()]
    assert sorted(got, key=str) == sorted((plain_tokens(*r) for r in AWKWARD), key=str)
    odd = spark.createDataFrame([(1, None), (2, []), (3, [None, 10**9, -5, 3306])], "doc_id long, ids array<int>")
    assert [r["decoded"] for r in bpe.decode(odd, WORD).orderBy("doc_id").collect()] == ["", "", "hello</w>"]
    assert bpe.digests(bpe.decode(bpe.encode(frame(spark, []), WORD), WORD)).collect() == []


# ------------------------------------------------------------------ spelling variants


def plain_variants(rows):
    n = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if c >= 2 and len(w) >= 7}
    near = collections.defaultdict(set)
    gaps = collections.defaultdict(set)
    for w in n:
        for i in range(len(w)):
            gaps[i, w[:i], w[i + 1 :]].add(w)
            if (shorter := w[:i] + w[i + 1 :]) in n:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in gaps.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best and n[best] >= 10 * n[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), c, len(near[w]), n.get(form.get(w))) for w, c in n.items()}


def listed(df):
    got = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("large", [512, 2])
def test_variants_query(spark, sf_dir, monkeypatch, large):
    monkeypatch.setattr(variants, "LARGE", large)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = listed(registry.op13_spelling_variants(spark, sf_dir))
    assert got == plain_variants(rows)
    assert any(r[1] for r in got)


@pytest.mark.parametrize("large", [512, 2])
def test_variants_of_a_small_alphabet(spark, monkeypatch, large):
    """Words of few letters share keys; repeated letters leave one remainder at several places."""
    monkeypatch.setattr(variants, "LARGE", large)
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abé") for _ in range(rng.randint(6, 9))) for _ in range(300)]
    rows = [(i, " ".join(rng.choice(vocabulary[: 1 + int(300 * rng.random() ** 3)]) for _ in range(60))) for i in range(200)] + AWKWARD
    got = listed(variants.variants(frame(spark, rows), variants.lost_letter))
    assert got == plain_variants(rows)


def test_forms_are_followed_to_the_last(spark):
    words = ["abcdefgh", "abcdefgx", "abcdefxx", "abcdexxx", "abcdxxx"]
    rows = [(None, " ".join([w] * n)) for w, n in zip(words, (2, 20, 200, 2000, 20_000), strict=True)]
    got = listed(variants.variants(frame(spark, rows)))
    assert got == plain_variants(rows)
    assert ("abcdefgh", "abcdefgx", "abcdxxx", 2, 1, 20) in got


def test_variants_without_words(spark):
    assert variants.variants(frame(spark, [(1, None), (2, "short words")])).collect() == []
    assert variants.variants(frame(spark, [])).collect() == []
    assert listed(variants.variants(frame(spark, [(1, "ABCDEFG abcdefg ABCDEFÉ")] * 2))) == {("abcdefg", None, "abcdefg", 4, 1, None), ("abcdefÉ", None, "abcdefÉ", 2, 1, None)}

"""Secret scan, packing, token files, edit-aware counts and their encoder, against plain Python."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lectern.llm import edit_counts, packing, secrets, token_files
from lectern.llm.common import chunks
from lectern.llm.encoding import CachedEncoder

BYTE, WORD = P.path("byte_bpe_50k.json"), P.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, tile long, rows string, score double, term string"

TEXTS = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "Some words, and more.\nNext line"),
    (4, "Some words, and more.\nNext line"),
    (5, "password = hunter2hunter2 TOKEN:'abcdefghijkl' token: short secret=\"0123456789abcdef0123\""),
    (6, "AKIAABCDEFGHIJKLMN AKIASHORT akiaabcdefghijklmn deadbeefdeadbeef deadbeef"),
    (7, "x" * 50_000 + " " + "word " * 20_000 + "ghp_" + "a1" * 18),
    (None, "no id, api_key=zzzzzzzzzzzzzzzz"),
    (8, "-----BEGIN RSA PRIVATE KEY----- é AKIA" + "Z" * 20),
    (9, "ſecret=abcdefghijklmnop toKen=abcdefghijklmnop <|endoftext|> <|startoftext|>"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", 1, "r", 0.5, "t") for i, t in TEXTS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# ------------------------------------------------------------------ encoder


def exact(path, special=True):
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = not special
    return lambda text: np.array(t.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


PIECES = ["a", "Word", "İ,", "क़.", "ßσς", "ŉ.", "é", "É", "İ", "Σ", "ß", "J̌", "ﬁ", " ", "  ", "\n", "\n\n", "\t", ", ", ". ", ".\n", "!,", "_,", "x́,", "3.14", "'s ", "don't ", "12", "½", "-", "　", "\x1c", "\x01", "\xa0", "语", "$$$ ", "x² ", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|> "]


def split(ids, offsets):
    return [ids[a:b].astype("<u4").tobytes() for a, b in zip(offsets[:-1], offsets[1:])]


@pytest.mark.parametrize("path,spaced", [(BYTE, True), (WORD, False)])
def test_cached_ids_are_exact(path, spaced):
    encoder, want = CachedEncoder(path, spaced, limit=50), exact(path)

    @settings(max_examples=1500, deadline=None)
    @given(st.lists(st.lists(st.sampled_from(PIECES), max_size=30).map("".join), max_size=6))
    def check(texts):
        assert split(*encoder.encode(pa.array([*texts, None], pa.string()).slice(0))) == [*map(want, texts), b""]
        assert split(*encoder.encode(pa.array(["cut off", *texts], pa.string()).slice(1))) == [*map(want, texts)]

    check()
    encoder.encode(pa.array(["last"]))
    assert len(encoder.pieces) == len(encoder.ids) <= 51


@pytest.mark.parametrize("path,spaced", [(BYTE, True), (WORD, False)])
def test_ids_of_the_documents_are_exact(spark, sf_dir, path, spaced):
    texts = [r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    encoder, want = CachedEncoder(path, spaced), exact(path)
    assert split(*encoder.encode(pa.array(texts))) == [*map(want, texts)]


def test_chunks_cover_all_rows():
    texts = pa.array(["a" * n if n is not None else None for n in (5, None, 0, 30, 3, 3, 3)])
    assert [*chunks(texts, 8)] == [(0, 3), (3, 4), (4, 6), (6, 7)] and [*chunks(texts.slice(0, 0))] == []


# ------------------------------------------------------------------ secrets

BASE = [
    ("assign", r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 12),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 16),
]


def base_spans(text):
    found = [(m.start(), k, m.end()) for k, (_, p, ok) in enumerate(BASE) for m in re.finditer(p, text or "") if ok(m)]
    return [(BASE[k][0], a, b) for a, k, b in sorted(found)]


def test_secret_scan(docs, none):
    found = secrets.scan(docs, segment_bytes=64)
    assert found.columns[:6] == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    got = found.collect()
    assert len(got) == len(TEXTS)
    want = defaultdict(list)
    for key, text in TEXTS:
        want[key].append(base_spans(text))
    for r in got:
        spans = want[r["doc_id"]][0]
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == name for k, _, _ in spans) for name, _, _ in BASE)
        kept = [x for x in r["spans"].split(",") if x.split(":")[0] in ("assign", "access", "hex")]
        assert kept == [f"{k}:{a}:{b}" for k, a, b in spans]
    by = {r["doc_id"]: r for r in got}
    assert by[7]["n_github"] == 1 and by[8]["n_private_key"] == 1
    assert secrets.scan(none).count() == 0


def test_trigram_queries():
    assert secrets.trigram_query("[0-9a-f]+") == ("all",)
    assert secrets.trigram_query("AKIA[A-Z0-9]+") == ("and", (("tri", b"aki"), ("tri", b"kia")))
    kinds = secrets.trigram_query(secrets.RULES[0].pattern)
    assert kinds[0] == "or" and any(("tri", b"sec") in parts[1] for parts in kinds[1])
    assert secrets.trigram_query("ab|abc") == ("all",)
    assert secrets.trigram_query("(?:abc|xbc)d?") == ("or", (("tri", b"abc"), ("tri", b"xbc"))) or secrets.vocabulary(secrets.trigram_query("(?:abc|xbc)d?")) <= {b"abc", b"bcd", b"xbc"}


@pytest.mark.parametrize("pattern", ["abc", "a[bc]d+e{2}f", "(foo|ba[rz])x?y", "x*abcd", "(?:ab){2}c", "abc(?=def)", "a.c", "^abc$", "(abc)?def", "é日a"])
def test_trigram_queries_lose_no_match(pattern):
    rng, query = random.Random(1), secrets.trigram_query(pattern)
    wanted = sorted(secrets.vocabulary(query))
    texts = ["".join(rng.choice("abcdefoxyzréX日 ") for _ in range(rng.randint(0, 60))) for _ in range(300)] + ["abc", "abddeef", "fooxy", "barxy", "bazy", "xabcd", "ababc", "abcdef", "def", "é日a"]
    data, offsets = secrets.utf8(pa.array(texts))
    found = set(secrets.SegmentIndex(data, offsets, wanted, secrets.marks_for(wanted)).answer(query).tolist())
    assert {i for i, t in enumerate(texts) if re.search(pattern, t)} <= found


# ------------------------------------------------------------------ packing


def test_packing(docs, none):
    want, got = exact(BYTE), packing.pack(docs, BYTE, size=64).collect()
    texts = defaultdict(list)
    for key, text in TEXTS:
        texts[key].append(want(text) + bytes(4))
    ids, windows, seen = {k: v[0] for k, v in texts.items()}, defaultdict(list), defaultdict(int)
    for r in got:
        part = ids[r["doc_id"]][4 * r["start"] : 4 * (r["start"] + r["length"])]
        assert 0 < r["length"] == len(part) // 4 and zlib.crc32(part) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]]) // 4
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
        seen[r["doc_id"]] += r["length"]
    assert seen == {k: len(v) * len(v[0]) // 4 for k, v in texts.items()}
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(none, BYTE).count() == 0


@pytest.mark.parametrize("partitions", [1, 40])
def test_little_padding_however_the_input_is_dealt(spark, sf_dir, partitions):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(partitions)
    got = packing.pack(docs, BYTE, size=256).select("sequence_id", "length").collect()
    windows = len({r["sequence_id"] for r in got})
    assert sum(r["length"] for r in got) >= 0.99 * 256 * windows


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_best_fit_decreasing_is_the_plain_one(lengths):
    rooms, want = [], [None] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [r for r in rooms if r >= lengths[i]]
        want[i] = min(fits) if fits else 40
        if fits:
            rooms.remove(min(fits))
        rooms.append(want[i] - lengths[i])
    got = packing.best_fit_decreasing(lengths, 40)
    assert [40 - offset for _, offset in got] == want


# ------------------------------------------------------------------ token files


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 2**16), st.integers(0, 2**32), st.integers(2**59, 2**64 - 1)), max_size=300), st.sampled_from([7, 64, 1024]))
def test_simple8b_round_trip(values, block):
    data = np.array(values, np.uint64)
    words, offsets = token_files.encode_words(data, block)
    assert token_files.decode_words(words).tolist() == values
    for i in range(len(offsets) - 1):
        assert token_files.decode_words(words[int(offsets[i]) : int(offsets[i + 1])]).tolist() == values[i * block : (i + 1) * block]


def test_stream_round_trip():
    sizes = np.array([0, 1, 5000, 3])
    keys, ids = pa.array([5, None, 7, -1]), np.concatenate([np.arange(n, dtype=np.uint32) for n in sizes])
    data = token_files.write_stream(keys, ids, sizes, block=512)
    back, flat, n = token_files.read_stream(data)
    assert back.to_pylist() == [5, None, 7, -1] and (flat == ids).all() and (n == sizes).all()
    assert token_files.read_block(data, 1).tolist() == [*range(511, 1023)]
    with pytest.raises(ValueError):
        token_files.read_stream(b"nope" + data[4:])


def test_token_files(docs, none):
    want, at, rows = exact(WORD), 0, []
    for key, text in sorted(TEXTS, key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = want(text) + (2).to_bytes(4, "little")
        rows.append((key, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    got = [tuple(r) for r in token_files.token_files(docs, WORD).collect()]
    assert sorted(got, key=lambda r: r[1]) == rows
    assert token_files.token_files(none, WORD).count() == 0


# ------------------------------------------------------------------ edit counts


def test_edits_equal_counting_again():
    encoder, want = CachedEncoder(BYTE, True), exact(BYTE, special=False)
    counts, pattern, rng = edit_counts.PieceCounts(encoder), regex.compile(P.PATTERN), random.Random(3)
    for _ in range(400):
        text = "".join(rng.choice(PIECES) for _ in range(rng.choice([0, 1, 5, 60, 400])))
        document = edit_counts.EditableCount.of(text, pattern, counts)
        for _ in range(4):
            a = rng.randint(0, len(text))
            b, new = min(len(text), a + rng.choice([0, 1, 3, 50])), "".join(rng.choice(PIECES) for _ in range(rng.choice([0, 1, 4])))
            document.edit(a, b, new)
            text = text[:a] + new + text[b:]
            assert document.text == text and document.total == len(want(text)) // 4
        state = document.state()  # kept and taken up again
        again = edit_counts.EditableCount(state[0], *(edit_counts.unpack(edit_counts.pack(x)) for x in state[1:]), pattern, counts)
        again.edit(len(text) // 2, len(text) // 2 + 2, "x y")
        text = text[: len(text) // 2] + "x y" + text[len(text) // 2 + 2 :]
        assert again.text == text and again.total == len(want(text)) // 4 == int(again.state()[2].sum())


def test_few_pieces_are_encoded_again():
    document = edit_counts.EditableCount.of("word " * 10_000, regex.compile(P.PATTERN), edit_counts.PieceCounts(CachedEncoder(BYTE, True)))
    document.edit(25_000, 25_003, "new")
    assert document.reencoded < 3 * edit_counts.LEAF


def test_count_edits(spark, docs, none):
    got = edit_counts.count_edits(docs, edit_counts.revision, BYTE, P.PATTERN).collect()
    want = exact(BYTE, special=False)
    before = {k: len(want(t)) // 4 for k, t in TEXTS}
    assert len(got) == len(TEXTS) and all(r["n_tokens"] == before[r["doc_id"]] for r in got)
    texts = {k: t or "" for k, t in TEXTS}
    edits = {r["doc_id"]: r["e"] for r in docs.select("doc_id", edit_counts.revision(docs["doc_id"], docs["text"]).alias("e")).collect()}
    for r in got:
        text = texts[r["doc_id"]]
        for e in edits[r["doc_id"]]:
            text = text[: e["start"]] + e["text"] + text[e["stop"] :]
        assert (r["n_edits"], r["n_tokens_after"]) == (3, len(want(text)) // 4)
    assert edit_counts.count_edits(none, edit_counts.revision, BYTE, P.PATTERN).count() == 0


def test_trees_are_kept_over_runs(spark, docs):
    want, table = exact(BYTE, special=False), "doc_id long, seq int, start int, stop int, text string"
    kept = edit_counts.keep(edit_counts.trees(docs, BYTE, P.PATTERN))
    first = spark.createDataFrame([(4, 1, 0, 4, "Many"), (4, 0, 5, 5, "new "), (2, 0, 9, 99, "text"), (77, 0, 0, 0, "x")], table)
    once = edit_counts.keep(edit_counts.with_edits(kept, first, BYTE, P.PATTERN))
    got = {r["doc_id"]: (r["text"], r["n_edits"], r["n_tokens"], r["n_reencoded"]) for r in once.collect()}
    many = "Many new words, and more.\nNext line"
    assert got[4][:3] == (many, 2, len(want(many)) // 4) and got[2][:3] == ("text", 1, len(want("text")) // 4) and got[6][1] == got[6][3] == 0
    second = spark.createDataFrame([(4, 0, len(many), len(many), " and its end"), (2, 0, 0, 4, "")], table)
    again = {r["doc_id"]: r for r in edit_counts.with_edits(once.select(*kept.columns), second, BYTE, P.PATTERN).collect()}
    assert again[4]["text"] == many + " and its end" and again[4]["n_tokens"] == len(want(many + " and its end")) // 4 and again[4]["n_before"] == got[4][2]
    assert again[2]["text"] == "" and again[2]["n_tokens"] == 0 and again[7]["n_reencoded"] == 0

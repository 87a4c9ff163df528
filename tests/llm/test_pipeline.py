"""The pipeline against plain Python, stage by stage and from end to end, on awkward rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from test_table_operators import brute, plain_lines, plain_logit
from tokenizers import Tokenizer

import corpus_pipeline as C
from lectern.llm import mixing, toxicity
from lectern.llm.common import WRITTEN, table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tiles string, label long, part string, p double, dropped_keys string"
#: Names that the stages use themselves.
CLASHING = ("n_lines", "n_dropped", "topic", "n_tokens", "probability", "sampled", "slot", "row", "host_key", "body", "score", "predicted", "component_id", "page", "u")
SCHEMA += "".join(f", {c} string" for c in CLASHING)
CLEAN = [f"{a}{b}" for a in ("ban", "cor", "del", "fim", "gol", "hup") for b in ("ane", "ust", "ipo", "erl", "omy")]
TOXIC = ["idiot", "moron", "worthless", "pathetic"]


def corpus():
    rng, rows, labels = random.Random(11), [], []
    for i in range(260):
        words, bad = rng.choices(CLEAN, k=rng.choice([8, 40, 150])), i % 5 == 0
        if bad:
            at = rng.randrange(len(words))
            words[at:at] = rng.sample(TOXIC, 3)
        rows.append((i, "menu of the site\n" * (i % 2) + " ".join(words) + rng.choice(["", " | x", "!!", "\nlicense"]), rng.choice(["en", "de"]), f"s{i % 3}"))
        labels.append((i, 1, int(bad)))
    for i in range(260, 300):  # copies and near copies of clean texts
        words = rows[(i * 7) % 260][1].split(" ") if (i * 7) % 5 else rows[(i * 7 + 1) % 260][1].split(" ")
        if i % 2 and len(words) > 30:
            words[5] = "other"
        rows.append((i, " ".join(words), "en", f"s{i % 3}"))
    rows += [(300, None, "en", "s0"), (301, "", None, None), (302, " \n\t ", "de", "s1"), (303, "so", "de", "s2"), (304, rows[1][1], "en", "s1"), (304, rows[1][1], "en", "s1"), (None, "a text without an id of its own", "en", "s2")]
    rows.append((305, " ".join(rng.choices(CLEAN, k=40_000)), "en", "s0"))
    rows.append((306, "-".join(rng.choices(CLEAN, k=500)) + " <|endoftext|> tail", "en", "s0"))
    return rows, labels


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, labels = corpus()
    at = tmp_path_factory.mktemp("tables")
    full = [(i, t, lang, src, len(t) if t is not None else None, "x", 1, "y", 0.5, "z", *(f"own {c}" for c in CLASHING)) for i, t, lang, src in rows]
    spark.createDataFrame(full, SCHEMA).repartition(5).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return str(at)


def listed(df):
    assert not df.columns[10:] or df.filter(" OR ".join(f"{c} IS NULL OR {c} <> 'own {c}'" for c in CLASHING)).isEmpty()
    return sorted(((r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in df.collect()), key=str)


def plain_mix(rows):
    """Rows (id, text, lang, source) that are drawn: plain raking in Python."""

    def topic(t):
        t = t or ""
        return "table" if " | " in t else "shouting" if "!!" in t else "symbols" if "###" in t or "%%%" in t else "licensed" if "icense" in t else "prose"

    cells = [(s or "", lang or "", topic(t), 0 if not t else sum(t.count(c) for c in " \n\t") + 1) for _, t, lang, s in rows]
    weights = Counter()
    for *cell, w in cells:
        weights[tuple(cell)] += w
    weights = {c: w for c, w in weights.items() if w}
    total = sum(weights.values())
    factor = dict.fromkeys(weights, 1.0)
    for _ in range(400):
        for axis, exponent in enumerate((0.75, 0.85, 0.9)):
            have, now = Counter(), Counter()
            for c, w in weights.items():
                have[c[axis]] += w
                now[c[axis]] += w * factor[c]
            norm = sum((v / total) ** exponent for v in have.values())
            for c in factor:
                factor[c] *= (have[c[axis]] / total) ** exponent / norm / now[c[axis]]
    top = max(factor.values())
    draw = lambda i: int(hashlib.md5(f"{'' if i is None else i}:mix".encode()).hexdigest()[:13], 16) / 2**52
    # a cell without weight has the product of its labels' factors, which plain raking does not give; none is drawn here
    return [r for r, c in zip(rows, cells, strict=True) if c[:3] in factor and draw(r[0]) < factor[c[:3]] / top], {c[:3] for c in cells} - set(factor)


def test_stages_equal_plain_python(spark, folder):
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    weight = lambda gram: model.weights[bucket(gram, len(model.weights))] / toxicity._UNIT

    def toxic(text):
        logit = plain_logit(text, weight, model.bias, model.window)
        return logit > -np.inf and 1 / (1 + np.exp(-(model.slope * logit + model.shift))) >= toxicity.THRESHOLD

    out = C.drop_toxic(spark, docs, folder)
    assert out.columns == docs.columns
    small = [r for r in listed(docs) if r[0] not in (305,)]  # the long one would take plain Python minutes
    want = [r for r in small if not toxic(r[1])]
    assert [r for r in listed(out) if r[0] != 305] == want and 150 < len(want) < 290

    out = C.drop_boilerplate(spark, docs, folder)
    rows = listed(docs)
    cleaned = plain_lines([(r[1], r[3]) for r in rows])
    assert out.columns == docs.columns
    assert listed(out) == sorted(((i, t, lang, s, len(t) if d else n) for (i, _, lang, s, n), (t, _, d) in zip(rows, cleaned, strict=True)), key=str)
    assert any(d for *_, d in cleaned)

    out = C.drop_near_copies(spark, docs, folder)
    found = brute([(i, t) for i, t, *_ in rows], 5, 4, 5)
    assert out.columns == docs.columns
    assert listed(out) == [r for r in rows if r[0] is None or found[r[0]][1] == r[0]]
    assert sum(found[i][1] != i for i in found) > 20

    out = C.mix_sources(spark, docs, folder)
    drawn, weightless = plain_mix([r[:4] for r in rows])
    assert out.columns == docs.columns
    got = [r[:4] for r in listed(out)]
    assert [r for r in got if r[1]] == [r for r in drawn if r[1]] and 50 < len(got) < len(rows) and len(weightless) <= 2


def bucket(gram, buckets):
    """One n-gram's bucket: a run as the operator hashes it, or ("word", w)."""
    if isinstance(gram, tuple):
        return int(toxicity.ngrams([gram[1]], buckets)[0][0])
    if gram not in _SEEN:
        # the marked word that has the gram: its buckets come in the order of their places
        core = gram.removeprefix("<").removesuffix(">")
        flat, _ = toxicity.ngrams([core], buckets)
        marked, places = f"<{core}>", [None]
        for i in range(len(marked)):
            places += [marked[i : i + n] for n in (3, 4, 5) if i + n <= len(marked)]
        _SEEN.update({p: int(b) for p, b in zip(places, flat, strict=True) if p})
    return _SEEN[gram]


_SEEN: dict = {}


def exact(text):
    return np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


TOKENIZER = Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def test_run_packs_what_the_stages_leave(spark, folder):
    at = table(spark, folder, "documents")
    for _, stage in C.STAGES[:-1]:
        at = stage(spark, at, folder)
    left = defaultdict(list)
    for r in at.select("doc_id", "text").collect():
        left[r["doc_id"]].append(exact(r["text"]))
    before = len(WRITTEN)
    got, windows = C.run(spark, folder).collect(), defaultdict(list)
    assert len(WRITTEN) == before + 1  # its result
    seen = Counter()
    for r in got:
        ids = left[r["doc_id"]][0]
        part = ids[r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and r["doc_tokens"] == len(ids) and zlib.crc32(part.tobytes()) == r["ids_crc32"]
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
        seen[r["doc_id"]] += r["length"]
    assert seen == {k: sum(map(len, v)) for k, v in left.items()}
    for pieces in windows.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 1024
    assert len(windows) <= -(-sum(seen.values()) // 1024) + 1


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = C.run(spark, str(tmp_path))
    assert out.count() == 0 and out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def test_mixing_of_repeated_rows_and_long_texts(spark):
    rows = [(1, "w " * 300_000, "en", "a"), (2, "w w", "de", "b"), (2, "w w", "de", "b"), (2, "w w", "de", "b"), (3, "w", "en", "b")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert len(got) == 5 and {r["n_tokens"] for r in got if r["doc_id"] == 1} == {300_001}
    assert len({(r["probability"], r["sampled"]) for r in got if r["doc_id"] == 2}) == 1

"""Joins, searches, toxicity, line dedup, mixing and the pipeline, against brute force."""

import math
import random
import time
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lectern.llm import components, jaccard, line_dedup, mixing, neighbours, ranking, registry, topk, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tiles string, part long, slot_ int, body string, row string, w long, s string, component long, n long, term long"
EXTRA = ("x", 1, 2, "b", "r", 3, "s", 4, 5, 6)


def documents(spark, rows):
    """rows: (doc_id, text, lang, source); the other columns have names that operators use themselves."""
    return spark.createDataFrame([(i, t, lang, src, len(t or ""), *EXTRA) for i, t, lang, src in rows], SCHEMA).repartition(3)


# ------------------------------------------------------------------ Jaccard


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)]) if w else frozenset()


def brute(rows, k, num, den):
    sets = {i: shingles(t, k) for i, t, *_ in rows if i is not None}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and both * den >= num * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def corpus(seed=0, groups=12, copies=14):
    rng, rows = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(400)]
    common = [rng.choice(vocabulary) for _ in range(60)]
    for g in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 4, 6, 9, 14, 25, 60, 200, 700]))]
        for _ in range(copies):
            words = list(base)
            for _ in range(int(len(words) * rng.choice([0, 0.005, 0.01, 0.02, 0.04, 0.1]) + rng.random())):
                at = rng.randrange(len(words))
                words[at : at + rng.choice([0, 1])] = [rng.choice(vocabulary)] * rng.choice([0, 1])
                words = words or ["w"]
            if rng.random() < 0.15:
                words += common
            rows.append((len(rows), " ".join(words).upper() if rng.random() < 0.1 else "\t".join(words), "en", "s"))
    return [*rows, (len(rows), None, "en", "s"), (len(rows) + 1, "", "en", "s"), (len(rows) + 2, " \n ", "en", "s"), (None, rows[0][1], "en", "s")]


@pytest.mark.parametrize("k,num,den", [(3, 9, 10), (5, 4, 5), (2, 1, 2)])
def test_jaccard_equals_brute_force(spark, k, num, den, monkeypatch):
    monkeypatch.setattr(jaccard, "PART_DOCS", 5)  # large blocks are cut into many tiles
    rows = corpus(seed=k)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(documents(spark, rows), k, (num, den)).collect()}
    want = brute(rows, k, num, den)
    assert got.pop(None)[1] is None
    assert got == want


def near_copies(n, seed=0, changes=(0, 2, 4, 8)):
    """A chain of families: copies of a base that differ from it in a few words, and from each other in more."""
    rng, rows = random.Random(seed), []
    base = [f"v{i}" for i in range(300)]
    for i in range(n):
        words = list(base)
        for _ in range(rng.choice(changes)):
            words[rng.randrange(300)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words), "en", "s"))
    return rows


@pytest.mark.parametrize("docs", [5, 16])
def test_large_groups_of_near_copies_equal_brute_force(spark, monkeypatch, docs):
    monkeypatch.setattr(jaccard, "PART_DOCS", docs)
    monkeypatch.setattr(jaccard, "CLASSES", 2)  # many are left to the second round
    rows = near_copies(220)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(documents(spark, rows), 3, (9, 10)).collect()}
    assert got == brute(rows, 3, 9, 10)


def test_thousands_of_near_copies_take_few_tiles(spark, monkeypatch):
    rows = near_copies(5000, seed=2, changes=(0, 1, 2, 4))
    laid = []
    links = jaccard._links
    monkeypatch.setattr(jaccard, "_links", lambda docs, tiles, *a: laid.append(tiles.selectExpr("sum(size(tiles))").first()[0] or 0) or links(docs, tiles, *a))
    got = jaccard.jaccard_components(documents(spark, rows), 5, (4, 5)).collect()
    assert len(got) == 5000 and sum(r["component_id"] == 0 for r in got) > 4900
    sets = {i: shingles(t, 5) for i, t, *_ in rows}
    for r in got[::100]:  # what is alone is linked with nobody
        if r["component_id"] == r["doc_id"] != 0:
            assert all(5 * len(sets[r["doc_id"]] & s) < 4 * len(sets[r["doc_id"]] | s) for i, s in sets.items() if i != r["doc_id"])
    assert 1 <= len(laid) <= 2 and sum(laid) < 4 * 5000


def test_jaccard_edges(spark):
    assert jaccard.jaccard_components(documents(spark, [])).count() == 0
    long = " ".join(f"w{i}" for i in range(30_000))
    same = [(1, "a b c d e f", "en", "s"), (1, "a b c d e f", "en", "s"), (2, "A b c d e  f", "en", "s"), (3, long, "en", "s"), (4, long + " tail", "en", "s")]
    got = sorted((r["doc_id"], r["component_id"]) for r in jaccard.jaccard_components(documents(spark, same), 5).collect())
    assert got == [(1, 1), (1, 1), (2, 1), (3, 3), (4, 3)]
    kept = jaccard.keep_one(documents(spark, same))
    assert kept.columns == SCHEMA_NAMES and sorted(r["doc_id"] for r in kept.collect()) == [1, 1, 3]


SCHEMA_NAMES = [x.split()[0] for x in SCHEMA.split(", ")]


def test_bands_hold_all_linked_sizes():
    for t in (Fraction(9, 10), Fraction(4, 5), Fraction(1, 2)):
        of = jaccard.Bands(t, 5000)
        for n in range(1, 3000):
            most = n * t.denominator // t.numerator
            a, b = of.of(np.array([n, most]))
            assert 0 <= b - a <= 1


@pytest.mark.parametrize("few", [0, 10**6])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr(components, "FEW", few)
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 560)]
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        up[max(x, y)] = min(x, y)
    linked = {x for e in edges if e[0] != e[1] for x in e}
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: root(x) for x in linked}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0


# ------------------------------------------------------------------ neighbours


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 1.0) for i, v in rows], "vec_id long, embedding array<float>, label int, id string, v double").repartition(3)


def test_neighbours(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(20, 24))
    data = np.concatenate([rng.normal(size=(1500, 24)), centres[rng.integers(0, 20, 1500)] + 0.2 * rng.normal(size=(1500, 24))]).astype(np.float32)
    data[100] = data[0]
    data[150:160] = data[50]
    bad = [(9001, None), (9050, [0.0] * 24), (9100, [float("nan")] * 24), (9002, [1.0, None] + [1.0] * 22), (9003, [float("inf")] * 24), (9004, [1.0, 2.0]), (None, [1.0] * 24)]
    df = vectors(spark, [(i, v.tolist()) for i, v in enumerate(data)] + bad)
    got = defaultdict(list)
    for r in neighbours.nearest(df, df.filter("vec_id % 50 = 0"), 5, neighbours.Settings(shard=700, block=25, bits=128)).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    x = data.astype(np.float64)
    norm = np.sqrt((x * x).sum(axis=1))
    assert set(got) == set(range(0, 3000, 50))
    hits = 0
    for q, found in got.items():
        found.sort()
        scores = (x * x[q]).sum(axis=1) / (norm * norm[q])
        best = [i for i in np.lexsort((np.arange(len(x)), -scores)).tolist() if i != q][:5]
        assert [r for r, _, _ in found] == [1, 2, 3, 4, 5] and all(abs(s - scores[i]) < 1e-12 for _, i, s in found)
        hits += len({i for _, i, _ in found} & set(best))
    assert hits >= 0.9 * 5 * len(got)
    assert [i for _, i, _ in got[50]] == [150, 151, 152, 153, 154] and got[0][0][1] == 100


def test_neighbours_edges(spark):
    few = vectors(spark, [(0, [1.0, 0.0]), (50, [1.0, 0.1]), (7, [-1.0, 0.0]), (7, [0.0, 1.0])])
    got = sorted((r["query_id"], r["rank"], r["vec_id"]) for r in neighbours.nearest(few, few.filter("vec_id % 50 = 0")).collect())
    assert got == [(0, 1, 50), (0, 2, 7), (50, 1, 0), (50, 2, 7)]
    none = few.filter("vec_id < 0")
    assert neighbours.nearest(none, none).count() == 0 and neighbours.nearest(few, none).count() == 0


def recall(spark, df, k=5, **settings):
    """Share of the true neighbours found, greatest error of a score, and share of the rows met."""
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    rows = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float64)
    norm, got, met = np.sqrt((x * x).sum(axis=1)), defaultdict(dict), {}
    for r in neighbours.nearest(df, df.filter("vec_id % 50 = 0"), k, neighbours.Settings(**settings)).collect():
        got[r["query_id"]][r["vec_id"]] = r["score"]
        met[r["query_id"]] = r["n_met"]
    hits = error = 0
    for at in np.flatnonzero(ids % 50 == 0).tolist():
        scores = x @ x[at] / (norm * norm[at])
        order = [i for i in np.lexsort((ids, -scores)).tolist() if i != at][:k]
        own = got[int(ids[at])]
        assert len(own) == min(k, len(ids) - 1)
        # an equal score is as good
        hits += sum(s >= scores[order[-1]] - 1e-12 for s in own.values())
        known = dict(zip(ids.tolist(), scores.tolist()))
        error = max([error, *(abs(known[i] - s) for i, s in own.items())])
    asked = len(got)
    return hits / (k * asked), error, sum(met.values()) / asked / len(ids)


def test_recall_on_the_table_as_registered(spark):
    found, error, share = recall(spark, spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet"))
    assert found >= 0.9 and error < 1e-12 and share < 0.4


def test_larger_tables_are_probed_in_a_small_part(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(400, 32))
    data = (centres[rng.integers(0, 400, 20_000)] + 0.35 * rng.normal(size=(20_000, 32))).astype(np.float32)
    found, error, share = recall(spark, vectors(spark, [(i, v.tolist()) for i, v in enumerate(data)]).select("vec_id", "embedding"))
    assert found >= 0.9 and error < 1e-12 and share < 0.3


@pytest.mark.parametrize("offset", [0.5, 1.0, 3.0])
def test_recall_of_vectors_with_a_common_offset(spark, offset):
    rng = np.random.default_rng(4)
    data = (rng.normal(size=(3000, 32)) + offset).astype(np.float32)
    found, error, _ = recall(spark, vectors(spark, [(i, v.tolist()) for i, v in enumerate(data)]).select("vec_id", "embedding"))
    assert found >= 0.9 and error < 1e-12


def test_components_of_any_size(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 8))
    rows = [(i, (v * 10.0 ** rng.choice([-300, -170, 0, 170, 300])).tolist()) for i, v in enumerate(base)] + [(100, [5e-324] * 8), (150, [1.7e308] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in neighbours.nearest(df, df.filter("vec_id % 50 = 0"), 5).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == {0, 100, 150} and all(-1 <= s <= 1 for found in got.values() for *_, s in found)
    assert min(got[100])[1] == 150 and abs(min(got[100])[2] - 1) < 1e-12
    x = base / np.sqrt((base * base).sum(axis=1))[:, None]
    want = np.argsort(-(x[1:] @ x[0]), kind="stable")[:5] + 1
    assert [i for _, i, _ in sorted(got[0])] == want.tolist() or {100, 150} & {i for _, i, _ in got[0]}


def test_every_code_within_the_radius_is_met():
    rng = np.random.default_rng(1)
    data = rng.normal(size=(800, 32))
    model = neighbours.learn(data, neighbours.Settings(bits=64))
    codes = model.codes(neighbours.unit(data))
    index, met = neighbours.MultiIndex(np.arange(800), data, codes), np.zeros(800, bool)
    away = neighbours.differing(codes, codes[3]).sum(axis=1)
    for radius in (0, 1, 2, 5, 8, 14, 21, 64):
        index.probe(codes[3], 0, radius, met)
        assert met[away <= radius].all()
    assert met.all() and not met.sum() < 800


def test_no_query_and_several_blocks(spark):
    rng = np.random.default_rng(6)
    df = vectors(spark, [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 4)))]).select("vec_id", "embedding")
    settings = neighbours.Settings(block=1, shard=37)
    assert neighbours.nearest(df, df.filter("vec_id < 0"), 2, settings).count() == 0
    got = neighbours.nearest(df, df.filter("vec_id % 100 = 0"), 2, settings)
    assert got.count() == 6 and neighbours.nearest(df, df, 500, neighbours.Settings()).count() == 300 * 299


# ------------------------------------------------------------------ top-k


@pytest.mark.parametrize("common", [1, 20, 512])
def test_topk_equals_brute_force(spark, monkeypatch, common):
    monkeypatch.setattr(topk, "COMMON", common)
    monkeypatch.setattr(ranking, "WIDER", 2)
    monkeypatch.setattr(topk, "SHARD_DOCS", 40)
    monkeypatch.setattr(topk, "BLOCK_DOCS", 4)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rng = random.Random(2)
    weights = [1 / (i + 1) for i in range(300)]
    rows = [(i, " ".join(f"t{x}" for x in rng.choices(range(300), weights, k=rng.choice([3, 20, 80]))), "en", "s") for i in range(300)]
    rows += [(300, None, "en", "s"), (350, "", "en", "s"), (None, "t1 t2", "en", "s"), (301, rows[0][1], "en", "s")]
    df = documents(spark, rows)
    got = defaultdict(list)
    for r in topk.search(df, df.filter("doc_id % 50 = 0"), k=5, terms=300).collect():
        got[r["query_id"]].append((r["rank"], r["doc_id"], r["score"]))
    tf = {i: Counter((t or "").split()) for i, t, *_ in rows if i is not None}
    length = {i: sum(c.values()) for i, c in tf.items()}
    n, mean = len(tf), sum(length.values()) / len(tf)
    df_ = Counter(w for c in tf.values() for w in c)
    for q in range(0, 351, 50):
        scores = {}
        for i, c in tf.items():
            s = sum(math.log(1 + (n - df_[w] + 0.5) / (df_[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * length[i] / mean)) for w in tf[q] if w in c)
            if s and i != q:
                scores[i] = round(s, 6)
        want = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:5]
        assert [(i, pytest.approx(s, abs=2e-6)) for _, i, s in sorted(got[q])] == want
    assert topk.search(documents(spark, []), documents(spark, [])).count() == 0


@pytest.mark.parametrize("common,batch", [(8, 100), (topk.COMMON, topk.BATCH_POSTINGS)])
def test_topk_scores_all_words_of_a_query(spark, monkeypatch, common, batch):
    monkeypatch.setattr(topk, "COMMON", common)
    monkeypatch.setattr(topk, "BATCH_POSTINGS", batch)
    monkeypatch.setattr(topk, "SHARD_DOCS", 90)
    monkeypatch.setattr(topk, "BLOCK_DOCS", 4)
    monkeypatch.setattr(topk, "QUERY_TERMS", 300)
    rng = random.Random(3)
    weights = [1 / (i + 1) for i in range(2000)]
    rows = [(i, " ".join(f"t{x}" for x in rng.choices(range(2000), weights, k=rng.choice([5, 60, 300]))), "en", "s") for i in range(300)]
    df = documents(spark, rows)
    got = defaultdict(list)
    for r in topk.search(df, df.filter("doc_id % 50 = 0")).collect():  # as registered
        got[r["query_id"]].append((r["rank"], r["doc_id"], r["score"]))
    tf = {i: Counter(t.split()) for i, t, *_ in rows}
    length = {i: sum(c.values()) for i, c in tf.items()}
    n, mean = len(tf), sum(length.values()) / len(tf)
    df_ = Counter(w for c in tf.values() for w in c)
    assert max(len(tf[q]) for q in range(0, 300, 50)) > 100
    for q in range(0, 300, 50):
        scores = {}
        for i, c in tf.items():
            s = sum(math.log(1 + (n - df_[w] + 0.5) / (df_[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * length[i] / mean)) for w in tf[q] if w in c)
            if s and i != q:
                scores[i] = round(s, 6)
        want = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:10]
        assert [(i, pytest.approx(s, abs=2e-6)) for _, i, s in sorted(got[q])] == want


def test_topk_of_an_id_repeated_often(spark):
    rows = [(0, "apple pear", "en", "s")] + [(1, "apple pear", "en", "s")] * 60 + [(i, "apple plum fig", "en", "s") for i in range(2, 14)] + [(20, "melon", "en", "s")] * 200
    df = documents(spark, rows).coalesce(1)
    got = sorted((r["rank"], r["doc_id"]) for r in topk.search(df, df.filter("doc_id = 0")).collect())
    assert got == [(i, i) for i in range(1, 11)]


def test_topk_of_very_long_texts_and_repeated_queries(spark):
    rng = random.Random(1)
    long = " ".join(f"w{rng.randrange(50_000)}" for _ in range(200_000))
    rows = [(0, long, "en", "s"), (1, long + " tail", "en", "s"), (2, "w1 w2", "en", "s"), (50, "w1 alpha", "en", "s"), (50, "w2 beta", "en", "s"), (3, "beta", "en", "s"), (4, "alpha", "en", "s")]
    df = documents(spark, rows)
    got = {(r["query_id"], r["rank"]): r["doc_id"] for r in topk.search(df, df.filter("doc_id % 50 = 0")).collect()}
    assert got[0, 1] == 1 and {got[50, 1], got[50, 2], got[50, 3]} == {2, 3, 4}  # both rows' words ask


def test_equal_texts_have_equal_scores_in_all_shards(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_DOCS", 7)
    monkeypatch.setattr(topk, "BLOCK_DOCS", 2)
    monkeypatch.setattr(topk, "COMMON", 5)
    rng = random.Random(7)
    text = " ".join(f"t{rng.randrange(40)}" for _ in range(100))
    rows = [(i, text if i % 3 == 0 else " ".join(f"t{rng.randrange(40)}" for _ in range(100)), "en", "s") for i in range(120)]
    df = documents(spark, rows)
    got = sorted((r["rank"], r["doc_id"], r["score"]) for r in topk.search(df, df.filter("doc_id = 0")).collect())
    assert [i for _, i, _ in got] == [3 * i for i in range(1, 11)] and len({s for *_, s in got}) == 1


# ------------------------------------------------------------------ toxicity


def test_toxicity(spark):
    rng = random.Random(5)
    clean, toxic = [f"{a}{b}" for a in ("ban", "cor", "del", "fim", "gol") for b in ("ane", "ust", "ipo", "erl", "omy")], ["idiot", "moron", "worthless", "pathetic"]
    rows, labels = [], []
    for i in range(900):
        words, bad = rng.choices(clean, k=rng.choice([5, 30, 200])), i % 4 == 0
        if bad:
            for _ in range(3):
                word = rng.choice(toxic)
                words[rng.randrange(len(words))] = word if rng.random() < 0.5 else word.replace("o", "oo", 1) if "o" in word else word + "s"
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, 1, int(bad)))
    rows += [(2000, None, "en", "s"), (2001, "", "en", "s"), (2002, "what an idiiot", "en", "s"), (None, "idiot", "en", "s"), (2003, clean[0] + " " + clean[1], "en", "s")]
    labels += [(None, 1, 1), (5, 1, None), (99999, 0, 1), (0, 1, 0)]
    df, known = documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    small = toxicity.Settings(buckets=1 << 14, max_toxic=150, max_clean=300)
    got = toxicity.toxicity(df, known, small).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 900]
    assert len(held) > 200 and sum(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in held) >= 0.97 * len(held)
    assert by[2002]["predicted"] == 1 and by[2003]["predicted"] == by[2000]["predicted"] == 0 and by[2000]["score"] == by[2001]["score"]
    kept = toxicity.keep_clean(df, known, small)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in got if not r["predicted"]}
    assert all(r["score"] < 1e-6 for r in toxicity.toxicity(df, known.filter("doc_id < 0"), small).collect())
    assert toxicity.toxicity(documents(spark, []), known, small).count() == 0


def plain_words(text):
    """Words as the operator defines them, one by one."""
    found = (text or "").lower().split()
    found = [w for before, w in zip([None, *found], found) if w != before]
    out = []
    for w in found:
        core = w.strip(toxicity._STRIP)
        out += [(w, core)] if len(core) <= 64 else [(None, core[i : i + 64]) for i in range(0, len(core) - 4, 60)]
    return [x[1] for before, x in zip([None, *out], out) if x != before]


def plain_logit(text, weights, bias, window):
    found = plain_words(text)
    if not found:
        return -math.inf
    bags = []
    for w in found:
        marked = f"<{w}>"
        bags.append([("word", w)] + [marked[i : i + n] for n in (3, 4, 5) for i in range(len(marked) - n + 1)])
    size = min(window, len(bags))
    means = [[g for bag in bags[i : i + size] for g in bag] for i in range(len(bags) - size + 1)]
    return max(bias + sum(map(weights, m)) / len(m) for m in means)


def test_toxicity_forward_pass_is_the_plain_one():
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["idiot", "Äpfel,", "x" * rng.choice([63, 64, 65, 130, 300]), "a-b", "--", "日本語", "a", "b", "c", "d"]) for _ in range(rng.choice([1, 3, 6, 7, 40]))) for _ in range(60)] + [None, "", " \n", "a a a"]
    buckets = 1 << 12
    weight = np.random.default_rng(1).integers(-(1 << 33), 1 << 33, buckets)
    model = toxicity.Model(weight, 0.25, 1.0, 0.0, 6)

    def value(gram):  # the whole word comes first among a word's buckets; a run of n is hashed alike in any word
        return weight[table[gram]] / toxicity._UNIT

    table = {}
    for text in texts:
        for w in plain_words(text):
            flat, sizes = toxicity.ngrams([w], buckets)
            marked, runs = f"<{w}>", [("word", w)]
            for i in range(len(marked)):
                runs += [marked[i : i + n] for n in (3, 4, 5) if i + n <= len(marked)]
            assert sizes.tolist() == [len(runs)] == [len(flat)]
            for gram, bucket in zip(runs, flat.tolist(), strict=True):
                assert table.setdefault(gram, bucket) == bucket
    got = model.logits(pa.array(texts))
    for text, x in zip(texts, got, strict=True):
        want = plain_logit(text, value, 0.25, 6)
        assert (x == want == -math.inf) or abs(x - want) < 1e-6
    again = model.logits(pa.array(["pad " * 50, *texts[::-1]]))[1:][::-1]
    assert (got == again).all()  # a text's score does not depend on where it stands


def test_toxicity_training_follows_the_gradient():
    rng = random.Random(4)
    texts = [" ".join(rng.choices(["ban", "cor", "del", "fim"], k=6)) if i % 2 else " ".join(rng.choices(["idiot", "moron", "ban"], k=6)) for i in range(40)]
    marks = [1 - i % 2 for i in range(40)]
    settings = toxicity.Settings(buckets=1 << 10, dim=3, epochs=1, batch=512, rate=1e-3)
    windows = toxicity.Windows(texts, 6, settings.buckets)
    flat, sizes = windows.grams(np.arange(len(windows.rows)))
    vectors, matrix, bias = (x.astype(np.float64) for x in (np.random.default_rng(0).normal(0, 0.1, (settings.buckets, 3)), np.random.default_rng(1).normal(0, 0.1, (3, 2)), np.zeros(2)))
    labels = np.array(marks)[windows.owner]

    def loss(v, m, b):
        hidden = np.add.reduceat(v[flat], np.cumsum(sizes) - sizes, axis=0) / sizes[:, None]
        scores = hidden @ m + b
        return -(scores - np.log(np.exp(scores).sum(axis=1, keepdims=True)))[np.arange(len(labels)), labels].mean()

    g_v, g_m, g_b = toxicity.gradients(vectors, matrix, bias, flat, sizes, labels)
    unique = np.unique(flat)
    for array, gradient, at in ((matrix, g_m, [(0, 0), (2, 1)]), (bias, g_b, [(0,), (1,)]), (vectors, None, [(int(unique[0]), 1), (int(unique[-1]), 2)])):
        for place in at:
            before, h = array[place], 1e-5
            array[place] = before + h
            up = loss(vectors, matrix, bias)
            array[place] = before - h
            down = loss(vectors, matrix, bias)
            array[place] = before
            own = gradient[place] if gradient is not None else g_v[1][np.searchsorted(g_v[0], place[0])][place[1]]
            assert abs((up - down) / (2 * h) - own) < 1e-6


def test_toxicity_reads_runs_without_spaces():
    rng = random.Random(8)
    for alphabet in ("abc-_.<", "毒物言葉文字、。"):
        run = "x" + "".join(rng.choices(alphabet, k=1000)) + "x"
        names, codes, first = toxicity.words(pa.array([run]))
        parts = [names[c] for c in codes.tolist()]
        assert first.tolist() == [0, len(parts)] and max(map(len, parts)) == 64
        want = {run[i : i + 5] for i in range(len(run) - 4)}
        assert want <= {p[i : i + 5] for p in parts for i in range(len(p) - 4)}
    names, codes, _ = toxicity.words(pa.array(["-" * 100 + " a a", "A,"]))
    assert [names[c] for c in codes.tolist()] == ["", "a", "a"]
    clean, toxic = ["banane", "coripo", "delust", "fimerl", "golomy"], ["idiot", "moron", "worthless", "pathetic"]
    labels = [i % 3 == 0 for i in range(300)]
    texts = ["-".join(rng.choices(clean, k=20) + bad * rng.choices(toxic, k=20)) for bad in labels]
    model = toxicity.train(texts, [int(x) for x in labels], toxicity.Settings(buckets=1 << 14))
    start = "-".join(clean * 3)
    assert len(start) > 64
    bad, good = model.scores(pa.array([f"{start}-{'-'.join(toxic * 20)}", f"{start}-{'-'.join(clean * 20)}"]))
    assert bad >= toxicity.THRESHOLD > good


def test_toxicity_of_very_long_and_repeated_texts(spark):
    rng = random.Random(2)
    clean = ["banane", "coripo", "delust", "fimerl", "golomy"]
    texts = [" ".join(rng.choices(clean, k=30) + (i % 3 == 0) * ["you", "worthless", "idiot", "moron"]) for i in range(300)]
    model = toxicity.train(texts, [int(i % 3 == 0) for i in range(300)], toxicity.Settings(buckets=1 << 14))
    long = " ".join(rng.choices(clean, k=400_000))
    rows = [(1, long), (2, long + " you worthless idiot moron"), (3, texts[0]), (3, texts[0]), (4, texts[0]), (5, None), (6, "")]
    got = toxicity.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), model).collect()
    by = {r["doc_id"]: r["score"] for r in got}
    assert len(got) == 7 and by[1] < toxicity.THRESHOLD <= by[2] and by[5] == by[6] == 0
    assert len({r["score"] for r in got if r["doc_id"] in (3, 4)}) == 1


# ------------------------------------------------------------------ line dedup and mixing


def plain_lines(rows, ratio=0.1, least=2):
    """rows of (text, host) to (text, lines, dropped), counted one by one."""
    pages, hits = Counter(h or "" for t, h in rows if t is not None), Counter()
    for t, h in rows:
        hits.update({(h or "", line) for line in (t.split("\n") if t is not None else []) if line.strip(" ")})
    out = []
    for t, h in rows:
        lines = t.split("\n") if t is not None else []
        kept = [x for x in lines if not (hits[h or "", x] >= least and hits[h or "", x] > ratio * pages[h or ""])]
        out.append(("\n".join(kept) if t is not None else None, len(lines), len(lines) - len(kept)))
    return out


@pytest.mark.parametrize("many", [256, 1])
def test_line_dedup(spark, monkeypatch, many):
    monkeypatch.setattr(line_dedup, "MANY", many)
    rows = [(i, f"menu\nown {i}\n\n{'sometimes' if i % 20 == 0 else 'else ' + str(i)}", "en", "a") for i in range(100)]
    rows += [(200 + i, f"menu\nline {i}", "en", "small") for i in range(5)] + [(210 + i, f"foot\nsecond\ntext {i}", "en", f"tiny{i // 2}") for i in range(4)]
    rows += [(220 + i, f"{'shared' if i < 2 else 'not'}\nbody {i}", "en", "nineteen") for i in range(19)]
    rows += [(300 + i, "copied\npage", "en", "a") for i in range(12)] + [(350, "alone", "en", "single"), (351, "twice\ntwice", "en", "single")]
    rows += [(400 + i, f"shared\n{i}", "en", None) for i in range(30)] + [(500, None, "en", "a"), (501, "", "en", "a"), (502, "menu", "en", "a")]
    rows += [(600, "menu\nagain", "en", "a")] * 3 + [(700, "menu\n" + "\n".join(f"{i % 7} words" for i in range(200_000)), "en", "a"), (701, "x" * 300_000, "en", "a")]
    df = documents(spark, rows)
    out = line_dedup.line_dedup(df)
    assert out.columns == [*df.columns, "n_lines", "n_dropped"]
    got = sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in out.collect()), key=str)
    want = plain_lines([(t, h) for _, t, _, h in rows])
    assert got == sorted(((i, *w) for (i, *_), w in zip(rows, want, strict=True)), key=str)
    by = {i: (t, n, d) for i, t, n, d in got}
    assert by[0] == ("own 0\n\nsometimes", 4, 1) and by[200] == ("line 0", 2, 1) and by[210] == ("text 0", 3, 2) and by[220] == ("body 0", 2, 1)
    assert by[350][0] == "alone" and by[351] == ("twice\ntwice", 2, 0) and by[400] == ("0", 2, 1) and by[500] == (None, 0, 0) and by[501] == ("", 1, 0) and by[502] == ("", 1, 1)
    assert line_dedup.line_dedup(documents(spark, [])).count() == 0


def test_line_dedup_of_long_pages(spark):
    """Work grows with the lines of a page, not with their square; names of the operator's columns are free."""
    page = "\n".join(f"line {i} of a mirrored page" for i in range(200_000))
    rows = [(1, page, "en", "a"), (2, page + "\nown", "en", "a"), (3, "line 7 of a mirrored page\n\nonly here", "en", "a"), (4, None, "en", "a"), (5, page, "en", "b")]
    df = documents(spark, rows).withColumn("n_lines", F.lit("own")).withColumn("page", F.lit("p")).withColumn("body", F.lit("b"))
    began = time.monotonic()
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_dropped"]) for r in line_dedup.line_dedup(df).collect()}
    assert time.monotonic() - began < 120
    assert got == {1: ("", 200_000, 200_000), 2: ("own", 200_001, 200_000), 3: ("\nonly here", 3, 1), 4: (None, 0, 0), 5: (page, 200_000, 0)}
    kept = line_dedup.cleaned(df).select("row.*")
    assert kept.columns == df.columns and {r["n_lines"] for r in kept.collect()} == {"own"}


def test_mixing_keeps_columns_of_its_own_names(spark):
    df = documents(spark, [(i, "w " * (i % 9), "en", "a") for i in range(40)]).withColumns({c: F.lit(f"own {c}") for c in ("topic", "sampled", "n_tokens", "row", "w", "a", "s")})
    assert mixing.drawn(df).select("row.*").columns == df.columns
    out = mixing.mix(df)
    assert out.columns == [*(c for c in df.columns if c not in ("topic", "sampled", "n_tokens")), "topic", "n_tokens", "probability", "sampled"]
    assert out.filter("row = 'own row' AND w = 'own w' AND a = 'own a' AND s = 'own s'").count() == 40


def test_mixing(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * rng.randint(1, 40)) + rng.choice(["", " | x", "!!"]), rng.choice(["en", "en", "de"]), rng.choice(["a", "a", "a", "b", None])) for i in range(3000)] + [(4000, None, "en", "a"), (4001, "", None, "b"), (None, "w w", "de", "b")]
    df = documents(spark, rows)
    out = mixing.mix(df, source={"a": 2, "b": 1, "": 1, "absent": 5}, lang=0.0, topics=1.0)
    assert out.columns == [*df.columns, "topic", "n_tokens", "probability", "sampled"]
    got = out.collect()
    assert len(got) == len(rows) and max(r["probability"] for r in got) == 1.0
    for name, column, want in (("source", lambda r: r["source"] or "", {"a": 0.5, "b": 0.25, "": 0.25}), ("lang", lambda r: r["lang"] or "", {"en": 0.5, "de": 0.5})):
        mass = Counter()
        for r in got:
            mass[column(r)] += r["n_tokens"] * r["probability"]
        total = sum(mass.values())
        assert {k: round(v / total, 3) for k, v in mass.items() if v} == want, name
    expected = sum(r["probability"] for r in got)
    assert abs(sum(r["sampled"] for r in got) - expected) < 5 * math.sqrt(expected)
    assert mixing.mix(documents(spark, [])).count() == 0


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_equals_sql(spark, sf_dir, same_as_sql, name):
    same_as_sql(registry.queries()[name](spark, sf_dir), registry.oracle_sql()[name])


# ------------------------------------------------------------------ registry and pipeline


def test_all_thirteen_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.queries()) == [*range(1, 14)]


def test_pipeline(spark, sf_dir):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    at, kept = docs, []
    for name, stage in P.STAGES:
        out = stage(spark, at, sf_dir).persist()
        if name != "packing":
            assert out.columns == docs.columns
        kept.append({r["doc_id"] for r in out.select("doc_id").collect()})
        before, at = at, out
        if name == "toxicity":
            scores = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity(before, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()}
            assert kept[-1] == {k for k, v in scores.items() if not v}
        if name == "jaccard_join":
            texts = [(r["doc_id"], r["text"]) for r in before.select("doc_id", "text").collect()]
            assert kept[-1] == {i for i, (_, c) in brute(texts, 5, 4, 5).items() if i == c}
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "jaccard_join", "mixing", "packing"]
    assert kept[1] == kept[0] and kept[2] <= kept[1] and kept[3] <= kept[2] and kept[4] == kept[3]


def _words_apart(rng, number, words, threshold, sizes):
    """Pairs of texts about as alike as the threshold, and like no other pair; with whether they are linked."""
    rows, linked = [], []
    for i in range(number):
        n = rng.choice(sizes) + words - 1
        own = [f"{i}x{j}" for j in range(n)]
        other, edits = list(own), rng.randint(1, 1 + n // 20)
        for _ in range(edits):
            at = rng.choice([0, rng.randrange(len(other)), len(other) - 1])
            kind = rng.random()
            if kind < 0.4:
                other[at] = f"{i}y{at}"
            elif kind < 0.7:
                other.insert(rng.choice([0, len(other)]), f"{i}z{len(other)}")
            elif len(other) > words:
                other.pop(rng.choice([0, -1]))
        sets = [{tuple(t[k : k + words]) for k in range(len(t) - words + 1)} for t in (own, other)]
        rows += [(2 * i, " ".join(own)), (2 * i + 1, " ".join(other))]
        linked.append(len(sets[0] & sets[1]) * threshold[1] >= threshold[0] * len(sets[0] | sets[1]))
    return rows, linked


@pytest.mark.parametrize("words,threshold", [(3, (9, 10)), (5, (4, 5)), (1, (19, 20))])
def test_no_link_of_isolated_pairs_is_lost(spark, words, threshold):
    """Each pair stands alone, so no other document can connect it."""
    rows, linked = _words_apart(random.Random(words), 4000, words, threshold, range(10, 101))
    assert 500 < sum(linked) < 4000
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(docs, words, threshold).collect()}
    assert [i for i, x in enumerate(linked) if (got[2 * i + 1] == 2 * i) != x] == []
    assert all(got[2 * i] == 2 * i for i in range(len(linked)))


def test_hot_keys_leave_a_task_once(spark, monkeypatch):
    """Very many short documents that share most cells, over many partitions."""
    rng = random.Random(3)
    rows = [(i, " ".join(["same words all over the place again and again until the end of it"] + [f"w{rng.randrange(40)}"])) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    results = []
    for same in (2, 10**9):
        monkeypatch.setattr(jaccard, "SAME", same)
        results.append(sorted(map(tuple, jaccard.jaccard_components(docs.repartition(6), 2, (4, 5)).collect())))
    assert results[0] == results[1]
    assert {r[2] for r in results[0]} == {0}


def test_training_on_executors_is_training(spark):
    rng = random.Random(12)
    clean, bad = [f"{a}{b}" for a in ("ban", "cor", "del", "fim") for b in ("ane", "ust", "ipo")], ["idiot", "moron", "worthless"]
    rows = [(i, " ".join(rng.choices(clean, k=30) + (rng.sample(bad, 2) if i % 4 == 0 else []))) for i in range(160)]
    docs = spark.createDataFrame([*rows, *rows[:20], (rows[8][0], "zz a later text of the same id"), (900, None), (None, "x")], "doc_id long, text string").withColumn("part", F.lit("own")).repartition(4)
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(160)] + [(None, 1, 1), (901, 1, 1)], "doc_id long, quality int, toxic int")
    settings = toxicity.Settings(buckets=1 << 12)
    sample = sorted((r["key"], r["text"], r["toxic"]) for r in toxicity.training_sample(docs, labels, settings).collect())
    assert len(sample) == len({k for k, *_ in sample}) and dict((k, t) for k, t, _ in sample).get(8, rows[8][1]) == rows[8][1]
    want, got = toxicity.train([t for _, t, _ in sample], [y for *_, y in sample], settings), toxicity.fit(docs, labels, settings)
    assert np.array_equal(want.weights, got.weights) and (want.bias, want.slope, want.shift) == (got.bias, got.slope, got.shift)
    for few in (labels.limit(0), labels.filter("toxic = 1"), labels.filter("doc_id IN (0, 1, 3)")):
        rest = sorted((r["key"], r["text"], r["toxic"]) for r in toxicity.training_sample(docs, few, settings).collect())
        want, got = toxicity.train([t for _, t, _ in rest], [y for *_, y in rest], settings), toxicity.fit(docs, few, settings)
        assert np.array_equal(want.weights, got.weights) and (want.bias, want.slope, want.shift) == (got.bias, got.slope, got.shift)

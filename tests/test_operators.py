"""Merges, migration, references, specifications, sources and streams on small tables."""

import json
import re

import pytest
from pyspark.sql import functions as F

from lectern import schemas
from lectern.functions import text as T
from lectern.functions.catalogue import books, catalogue
from lectern.functions.ids import make_id
from lectern.operators import load, merge, migrate, refs, spec
from lectern.operators.store import Conflict, Store
from lectern.plans import validation as V
from lectern.schemas import Library
from lectern.sources import config, files, rest


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, f"file://{tmp_path}/store")


def records(spark, *rows):
    return spark.createDataFrame(list(rows), "lang string, book_sort int, chapter_sort int, verse_sort int, content string, pos int")


def test_load_twice_changes_nothing(spark, store):
    first = records(spark, ("chinese", 1, 1, 1, "a", 0), (" ENGLISH ", 1, 1, 1, "b", 1), ("english", 1, 2, 3, " c　", 2), ("latin", 1, 1, 1, "x", 3), ("english", 1, 1, 0, "x", 4), ("english", 1, 1, 2, " ", 5), ("english", None, 1, 2, "y", 6))
    done = load.load(store, first)
    assert done["sections"]["insert"] == 2 and done["section_contents"]["insert"] == 3 and done["rejected"]["rows"] == 4
    again = load.load(store, first)
    assert all(not d["insert"] and not d.get("update") for name, d in again.items() if name != "rejected")
    changed = load.load(store, records(spark, ("english", 1, 1, 1, "new", 0), ("english", 1, 1, 1, "newer", 1)))
    assert changed["section_contents"] == {"insert": 0, "noop": 0, "update": 1}
    texts = {r["content"] for r in store.read("section_contents", schemas.SECTION_CONTENTS).collect()}
    assert texts == {"a", "newer", "c"}


def test_upsert_normalises_null_once(spark):
    schema = "section_id string, language string, title string, content string, sub_title string"
    old = spark.createDataFrame([("s", "english", "t", "c", None), ("u", "english", "t", "c", "")], schema)
    new = spark.createDataFrame([("s", "english", "t", "c", ""), ("u", "english", "t", "c", ""), ("v", "english", "t", "c", "")], schema)
    keys, compare = ["section_id", "language"], ["title", "content", "sub_title"]
    actions = merge.upsert_actions(old, new, keys, compare)
    assert {r["section_id"]: r["action"] for r in actions.collect()} == {"s": "update", "u": "noop", "v": "insert"}
    after = merge.upserted(old, actions, keys)
    assert after.count() == 3
    assert merge.counts(merge.upsert_actions(after, new, keys, compare)) == {"insert": 0, "noop": 3, "update": 0}


def test_byte_limits(spark):
    rows = spark.createDataFrame(
        [("s", 1, "english", "t", "節" * 21846, ""), ("s", 1, "english", "節" * 171, "c", ""), ("s", 1, "english", "t", "c", "x" * 1025), ("s", 1, "english", "節" * 170, "節" * 21845, "x" * 1024), (None, 1, "english", "t", "c", None), ("s", 1, None, "t", "c", None)],
        "section_id string, sort int, raw_language string, title string, content string, sub_title string",
    )
    found = sorted(str(r["reject_reason"]) for r in merge.checked(rows).collect())
    assert found == ["None", "content too long", "no id", "sub_title too long", "title too long", "unsupported language"]


def test_last_write(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, None)], "k string, pos int, v string")
    assert sorted(map(tuple, merge.last_write(rows, ["k"], "pos").collect()), key=str) == [("a", "y"), ("b", None)]


def test_migration_round_trip(spark, store):
    rows = records(spark, *[("english", b, c, v, "t", 0) for b in (1, 2) for c in (1, 2) for v in (1, 2)])
    load.load(store, rows, salt="old-")
    section = lambda b, c, v, salt: spark.range(1).select(make_id("section", *map(F.lit, (b, c, v)), salt=salt)).first()[0]
    refer = lambda column, *ids: spark.createDataFrame(list(enumerate(ids)), f"n int, {column} string").select(F.col("n").cast("string").alias("id"), column)
    references = {
        "general_bibles": refer("bible_id", section(1, 1, 1, "old-"), section(2, 2, 2, "old-"), "gone", None),
        "general_template_bibles": refer("bible_id", section(1, 2, 1, "old-")),
        "devotion_bibles": refer("bible_section_id", section(2, 1, 1, "old-")),
    }
    steps = migrate.Migration(store)
    assert steps.save(references) == {"general_bibles": 2, "general_template_bibles": 1, "devotion_bibles": 1}
    steps.truncate()
    assert steps.library().sections.count() == 0
    assert steps.save(references)["general_bibles"] == 2  # the first snapshot stays
    load.load(store, rows.filter("book_sort = 1 OR chapter_sort = 1"), salt="new-")
    moved = steps.restore(references)
    assert {r["id"]: r["bible_id"] for r in moved["general_bibles"].collect()} == {"0": section(1, 1, 1, "new-"), "1": section(2, 2, 2, "old-"), "2": "gone", "3": None}
    assert steps.verify(moved) == {"general_bibles": 3, "general_template_bibles": 0, "devotion_bibles": 0}
    assert not steps.clean_up(moved)
    assert steps.clean_up({k: moved[k] for k in ("devotion_bibles",)})
    assert store.current("orphan_refs_backup") is None


def test_resolve_refs(spark):
    rows = [
        (0, "MAT", 17, 21, "", "MRK.9.29"),
        (1, "MRK", 9, 29, "first", ""),
        (2, "MRK", 9, 29, "second", ""),
        (3, "MAT", 1, 1, "", "LUK.1.1"),
        (4, "MAT", 1, 2, "", "MRK.1.1"),
        (5, "MRK", 1, 1, " 　", ""),
        (6, "MAT", 1, 3, "", "MRK.1.2"),
        (7, "MRK", 1, 2, T.MERGED, ""),
        (8, "MAT", 1, 4, "", "MAT.17.21"),
        (9, "MAT", 1, 5, "kept", None),
    ]
    got = refs.resolve_refs(spark.createDataFrame(rows, "pos int, usfm string, chapter_sort int, verse_sort int, content string, cross_ref string"))
    content = {r["pos"]: r["content"] for r in got.collect()}
    assert [content[i] for i in (0, 1, 2, 3, 4, 6, 8, 9)] == ["second", "first", "second", "[See LUK.1.1]", "[See MRK.1.1]", "[See MRK.1.2]", "[See MAT.17.21]", "kept"]


def test_catalogue(spark):
    assert len(books()) == 66 and sum(b[4] for b in books()) == 1189
    starts = {r["book_sort"]: r["start"] for r in spec.global_starts(catalogue(spark)).collect()}
    assert (starts[1], starts[2], starts[66]) == (1, 51, 1168)
    assert starts == {r["book_sort"]: r["start"] for r in spec.starts_at_scale(catalogue(spark), width=7).collect()}
    work = spec.work_items(catalogue(spark).select("book_sort", "total_chapters"), [1, 1, 66, 99])
    assert work.count() == 2 * (50 + 22)


def spec_file(spark, tmp_path, name, chapters):
    (tmp_path / name).write_text(json.dumps({"title": "t", "version": "v", "books": [{"number": 1, "name_zh": "x", "total_chapters": len(c), "verses_per_chapter": c} for c in chapters]}, ensure_ascii=False))
    return files.read_spec(spark, f"file://{tmp_path}/{name}")


def test_spec(spark, tmp_path):
    one = spec_file(spark, tmp_path, "a.json", [{"10-[7]": 7, "01-[31]": 31, "02-[25]": 25}])
    found = spec.spec_rows(one)
    assert sorted((r["position"], r["verses"]) for r in found.collect()) == [(1, 31), (2, 25), (3, 7)]
    assert spec.verse_bound(found, F.lit(1), F.lit(2)).first()[0] == 25
    for chapter in (0, 4):
        with pytest.raises(Exception, match="out of range"):
            spec.verse_bound(found, F.lit(1), F.lit(chapter)).collect()
    for key in ("nodash", "XX-[31]"):
        with pytest.raises(Exception, match=re.escape(key)):
            spec.spec_rows(spec_file(spark, tmp_path, f"{key[:2]}.json", [{key: 31}])).collect()
    with pytest.raises(ValueError, match="different book counts"):
        spec.assert_same_books(one, spec_file(spark, tmp_path, "b.json", [{}, {}]))
    with pytest.raises(ValueError, match="no books"):
        spec.assert_same_books(spec_file(spark, tmp_path, "c.json", []), one)


def test_spec_writer(spark, tmp_path):
    counts = spark.createDataFrame([(1, 1, 31), (1, 2, 25), (2, 1, 22)], "book_sort int, chapter_sort int, verses int")
    made = spec.verses_map(counts).withColumns({"name": F.lit("n"), "testament": F.lit("OT")})
    files.write_spec(made, f"file://{tmp_path}/spec", "T", "V", T.ENGLISH)
    text = "\n".join(r["value"] for r in spark.read.option("wholetext", True).text(f"file://{tmp_path}/spec").collect())
    document = json.loads(text)
    assert document["summary"] == {"total_books": 2, "total_chapters": 3, "total_verses": 78}
    assert document["books"][0]["verses_per_chapter"] == {"01-[31]": 31, "02-[25]": 25}


def test_zip(spark):
    lists = lambda tag, n: spark.createDataFrame([(i, f"{tag}{i}") for i in range(n)], f"pos int, {tag}_title string")
    assert spec.zipped(lists("en", 3), lists("zh", 3)).count() == 3
    with pytest.raises(Exception, match="different length"):
        spec.zipped(lists("en", 3), lists("zh", 2)).collect()


def test_text_functions(spark):
    df = spark.createDataFrame([("　 a\t b\n",), ("\x1ca\x1f",), (None,)], "s string")
    got = [tuple(r) for r in df.select(T.trim_u(df["s"]), T.collapse(df["s"])).collect()]
    assert got[0] == ("a\t b", "a b") and got[2] == (None, None)
    one = spark.range(1)
    value = lambda c: one.select(c).first()[0]
    assert value(T.int_list(F.lit("1, 66,67,0,x,,5"))) == [1, 66, 5]
    assert value(T.language(F.lit(" Chinese　"))) == "chinese" and value(T.language(F.lit("latin"))) is None
    assert value(T.chapter_title(F.lit("chinese"), F.lit(3))) == "第 3 章" and value(T.section_title(F.lit("english"), F.lit(3))) == "verse 3"
    assert value(T.path_escape(F.lit("a b/c"))) == "a%20b%2Fc" and value(T.query_escape(F.lit("a b"))) == "a+b"
    assert value(T.spec_chapter(F.lit("119-[176]"))) == 119 and value(T.spec_chapter(F.lit("x"))) is None
    assert value(T.page_url("https://x/%d.html", F.lit(7))) == "https://x/7.html"
    assert value(T.minutes(F.lit(2378), F.lit(2.0))) == pytest.approx(19.8, abs=0.1)


def test_documents_round_trip(spark, tmp_path):
    schema = "language string, book_sort int, book_name string, usfm string, chapter_sort int, verse_sort int, sub_title string, content string, note string, cross_ref string"
    rows = [(lang, b, f"Book {b}", f"B{b}", c, v, "s" if v == 1 else "", f"text {v}", "", "") for lang in ("english", "chinese", "latin") for b in (2, 1) for c in (10, 9) for v in (2, 1, 3)]
    verses = spark.createDataFrame(rows, schema)
    for per_book, n in ((False, 3), (True, 6)):
        at = tmp_path / f"docs{n}"
        files.write_documents(files.nested(verses, per_book), f"file://{at}")
        documents = [json.loads(p.read_text()) for p in at.rglob("part-*")]
        assert len(documents) == n and "note" not in documents[0]["books"][0]["chapters"][0]["verses"][0]
        for d in documents:
            assert [b["book_sort"] for b in d["books"]] == ([1, 2] if not per_book else [d["books"][0]["book_sort"]])
            assert [c["chapter_sort"] for c in d["books"][0]["chapters"]] == [9, 10]
        back = files.read_documents(spark, f"file://{at}")
        assert sorted(map(tuple, files.document_totals(back).collect())) == [(lang, 2, 4, 12) for lang in ("chinese", "english", "latin")]
        assert sorted(map(tuple, files.flatten(back).drop("pos").collect())) == sorted(rows)


def test_documents_into_the_store(spark, store):
    schema = "language string, book_sort int, book_name string, usfm string, chapter_sort int, verse_sort int, sub_title string, content string, note string, cross_ref string"
    good = spark.createDataFrame([("english", 1, "Genesis", "GEN", 1, v, "", f"t{v}", "", "") for v in (1, 2)], schema)
    done = load.load_documents(store, files.nested(good))
    assert done["section_contents"]["insert"] == 2 and done["book_contents"]["insert"] == 1
    assert load.load_documents(store, files.nested(good))["section_contents"]["noop"] == 2
    bad = spark.createDataFrame([("latin", 1, "Genesis", "GEN", 1, 1, "", "t", "", "")], schema)
    with pytest.raises(ValueError, match="no verse written"):
        load.load_documents(store, files.nested(bad))
    empty = spark.createDataFrame([("english", [])], "language string, books array<struct<book_sort:int,book_name:string,book_usfm:string,chapters:array<struct<chapter_sort:int,verses:array<struct<verse_sort:int,sub_title:string,content:string,note:string,cross_ref:string>>>>>>")
    assert load.load_documents(store, empty)["section_contents"] == {"insert": 0, "noop": 0, "update": 0}


def test_get_or_create_keeps_whole_rows(spark):
    schema = "source_table string, source_id string, a int, b int"
    twice = spark.createDataFrame([("sA", "1", 9, 1), ("sA", "1", 1, 7), ("sB", "1", 2, 2)], schema)
    none = spark.createDataFrame([], schema)
    assert sorted(map(tuple, merge.get_or_create(none, twice, ["source_table", "source_id"]).collect())) == [("sA", "1", 1, 7), ("sB", "1", 2, 2)]


KV = "k int, v string"


def pairs(spark, *r):
    return spark.createDataFrame(list(r), KV)


def held(store, version=None):
    return {tuple(r) for r in store.read("t", KV, version).collect()}


def test_store_writes_what_changes(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s", age=0)
    go = lambda *r: store.merge("t", KV, pairs(spark, *r), ["k"], ["v"])
    written = lambda: sum(f.stat().st_size for f in tmp_path.glob("s/t/**/*.parquet"))
    assert go(*((i, f"a{i}") for i in range(50_000))) == {"insert": 50_000, "noop": 0, "update": 0}
    base = written()
    assert go((5, "b"), (6, "a6"), (50_000, "new")) == {"insert": 1, "noop": 1, "update": 1}
    assert base < written() < base + 5000  # a batch adds what it changes
    assert [(f.kind, f.rows) for f in store.current("t").folders] == [("insert", 50_000), ("insert", 1), ("update", 1)]
    assert go((5, "b")) == {"insert": 0, "noop": 1, "update": 0}
    assert store.current("t").number == 2 and len(list((tmp_path / "s/t").iterdir())) == 2  # nothing changed
    for i in range(3):
        go((5, f"c{i}"), (7, f"d{i}"))
    want = {(i, f"a{i}") for i in range(50_000) if i not in (5, 7)} | {(5, "c2"), (7, "d2"), (50_000, "new")}
    assert held(store) == want
    assert store.merge("t", KV, pairs(spark, (1, "x"), (-1, "b"), (-1, "a")), ["k"], []) == {"insert": 1, "noop": 0, "update": 0}
    assert held(store) == want | {(-1, "a")}
    store.truncate("t", KV)
    assert held(store) == set() and go((1, "a")) == {"insert": 1, "noop": 0, "update": 0} and held(store) == {(1, "a")}


def test_store_compacts_by_ratio_and_keeps_snapshots(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s", ratio=0.25)
    go = lambda *r: store.merge("t", KV, pairs(spark, *r), ["k"], ["v"])
    go(*((i, "a") for i in range(8)))
    go((0, "b"))
    snapshot = store.current("t")
    reader = store.read("t", KV)
    go((1, "b"))
    assert [f.kind for f in store.current("t").folders] == ["insert", "update", "update"]
    go((1, "c"))  # three updates of eight rows are more than a quarter
    assert [(f.kind, f.rows) for f in store.current("t").folders] == [("base", 8)]
    assert held(store) == {(i, "a") for i in range(2, 8)} | {(0, "b"), (1, "c")}
    assert {tuple(r) for r in reader.collect()} == held(store, snapshot) == {(i, "a") for i in range(1, 8)} | {(0, "b")}
    store.age, folders = 0, len(list((tmp_path / "s/t").iterdir()))
    store.vacuum("t")
    assert len(store._log("t")) == store.keep and len(list((tmp_path / "s/t").iterdir())) <= folders
    assert held(store) == {(i, "a") for i in range(2, 8)} | {(0, "b"), (1, "c")}
    for n in range(30):  # many small batches: folders stay few
        go((100 + n, "x"))
    assert len(store.current("t").folders) <= store.most and len(held(store)) == 38
    assert len(list((tmp_path / "s/t").iterdir())) <= store.most + 2


def test_store_writers_that_meet(spark, tmp_path, monkeypatch):
    store = Store(spark, f"file://{tmp_path}/s")
    store.merge("t", KV, pairs(spark, (1, "a")), ["k"], ["v"])
    first = store.current("t")
    store.merge("t", KV, pairs(spark, (2, "a")), ["k"], ["v"])
    with pytest.raises(Conflict):
        store._commit("t", first, ["k"], [])
    real, stale = store.current, [first]
    monkeypatch.setattr(store, "current", lambda name: stale.pop() if stale else real(name))
    assert store.merge("t", KV, pairs(spark, (1, "b"), (2, "b"), (3, "b")), ["k"], ["v"]) == {"insert": 1, "noop": 0, "update": 2}
    assert held(store) == {(1, "b"), (2, "b"), (3, "b")}
    assert not store.compact("t", KV, first) and held(store) == {(1, "b"), (2, "b"), (3, "b")}
    assert store.compact("t", KV) and [f.rows for f in store.current("t").folders] == [3]


def test_merge_does_not_shuffle_the_table_for_a_few_rows(spark, tmp_path, monkeypatch):
    store = Store(spark, f"file://{tmp_path}/s")
    big = spark.range(200_000).selectExpr("cast(id AS int) k", "repeat('x', 200) || id v")
    store.merge("t", KV, big, ["k"], ["v"])
    with store.once(pairs(spark, (1, "b"), (-1, "c"))) as few:
        there = store.read("t", KV).join(few.select("k"), "k", "left_semi")
        plan = there._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_records(spark, tmp_path):
    lines = ['{"passage_id":"GEN.1.1","lang":"english","book_sort":1,"chapter_sort":1,"verse_sort":1,"content":"a"}', "{broken", "", '{"lang":"english"}']
    (tmp_path / "r.jsonl").write_text("\n".join(lines))
    found = files.read_records(spark, f"file://{tmp_path}/r.jsonl").cache()
    assert files.good(found).count() == 1 and files.bad(found).count() == 3
    assert files.read_completed(spark, f"file://{tmp_path}/r.jsonl").count() == 1
    assert files.read_completed(spark, f"file://{tmp_path}/missing").count() == 0
    (tmp_path / "long.jsonl").write_text("x" * (files.MAX_LINE + 1))
    with pytest.raises(Exception, match="line too long"):
        files.read_records(spark, f"file://{tmp_path}/long.jsonl").collect()


def test_stream_resumes(spark, tmp_path):
    from lectern.streaming.ingest import deduplicated, ingest

    line = lambda v, text: json.dumps({"passage_id": f"GEN.1.{v}", "lang": "english", "bible_id": 1, "book_sort": 1, "chapter_sort": 1, "verse_sort": v, "content": text})
    folder, store, reports = tmp_path / "lines", Store(spark, f"file://{tmp_path}/s"), []
    folder.mkdir()
    go = lambda: ingest(spark, f"file://{folder}", store, f"file://{tmp_path}/c", report=lambda n, d: reports.append(d))
    (folder / "a.jsonl").write_text("\n".join([line(1, "a"), line(2, "b"), "broken"]))
    go()
    go()
    assert len(reports) == 1 and reports[0]["section_contents"]["insert"] == 2 and reports[0]["malformed"]["rows"] == 1
    (folder / "b.jsonl").write_text("\n".join([line(2, "b"), line(3, "c")]))
    go()
    assert reports[1]["section_contents"] == {"insert": 1, "noop": 1, "update": 0}
    (tmp_path / "c/metadata").write_text("broken")
    warnings = []
    ingest(spark, f"file://{folder}", store, f"file://{tmp_path}/c", report=lambda n, d: reports.append(d), warn=warnings.append)
    assert len(warnings) == 1 and reports[2]["section_contents"] == {"insert": 0, "noop": 3, "update": 0}
    for _ in range(2):
        deduplicated(spark, f"file://{folder}", f"file://{tmp_path}/out", f"file://{tmp_path}/c2")
    assert spark.read.parquet(f"file://{tmp_path}/out").count() == 3


def test_rest_decoding(spark):
    body = {"data": [{"id": "GEN", "title": "Genesis", "intro": {"any": [1]}, "chapters": [{"id": "1", "passage_id": "GEN.1", "title": "1", "verses": [{"id": "1", "passage_id": "GEN.1.1"}, {"id": "x", "passage_id": "GEN.1.x"}, {"id": "0", "passage_id": "GEN.1.0"}]}]}]}
    df = spark.createDataFrame([(json.dumps(body),)], "body string")
    assert [tuple(r) for r in rest.verse_work(rest.books(df)).collect()] == [(1, 1, 1, "GEN.1.1")]
    other = lambda x: spark.createDataFrame([(json.dumps(x),)], "body string")
    assert rest.passage(other({"id": "GEN.1.1", "content": "t", "reference": "r"})).first()["content"] == "t"
    assert rest.days(other({"data": [{"day": 1, "passage_id": "p"}, {"day": 2, "passage_id": "q"}]})).count() == 2
    assert rest.versions(other({"data": [{"id": 1, "books": ["GEN"]}]})).first()["books"] == ["GEN"]
    assert rest.version(other({"id": 1, "title": None})).first()["id"] == 1
    assert rest.book(other(body["data"][0])).first()["title"] == "Genesis"
    assert rest.chapter(other(body["data"][0]["chapters"][0])).first()["passage_id"] == "GEN.1"
    assert rest.verse(other({"id": "1", "passage_id": "GEN.1.1"})).first()["id"] == "1"
    assert rest.passage(spark.createDataFrame([("{broken",)], "body string")).first()["id"] is None


def test_fetch(spark):
    def get(url, headers, timeout):
        if "flaky" in url:
            raise OSError("down")
        return {"ok": (200, b"body"), "empty": (200, b" "), "none": (404, b""), "no": (403, b"x"), "busy": (429, b"slow")}[url]

    urls = spark.createDataFrame([(u,) for u in ("ok", "empty", "none", "no", "busy", "flaky")], "url string")
    found = rest.fetch(urls, per_second=1e6, retries=2, get=get, sleep=lambda s: None, partitions=2).cache()
    errors = {r["url"]: r["error"] for r in found.collect()}
    assert errors == {"ok": None, "empty": "empty body", "none": None, "no": "forbidden", "busy": "status 429: slow", "flaky": "down"}
    assert rest.fetched(found).count() == 1 and rest.failed(found).count() == 4
    assert rest.delay(3, 1.0, draw=lambda: 0.5) == 8.0 and rest.delay(30, 1.0) == 60.0


def test_fetch_keeps_the_rate(spark):
    draws = iter([0.0, 0.5, 1.0])
    assert [rest.pause(i, 2, 4, 2.0, draw=lambda: next(draws)) for i in (0, 1, 2, 3)] == [1.0, 1.5, 2.0, 2.5]


def test_unreadable_checkpoint_starts_afresh(spark, tmp_path):
    (tmp_path / "c.jsonl").write_bytes(b"x")
    warnings = []
    broken = f"file://{tmp_path}/c.jsonl/below"
    assert files.completed_or_fresh(spark, "nosuchscheme://x/y", warnings.append).count() == 0 and len(warnings) == 1
    assert files.completed_or_fresh(spark, broken, warnings.append).count() == 0


def test_catalogue_check(spark, tmp_path):
    with pytest.raises(ValueError, match="2 books, the catalogue 66"):
        spec.assert_catalogue(spec_file(spark, tmp_path, "two.json", [{}, {}]))


def test_config(tmp_path):
    (tmp_path / ".env").write_text('# c\nWORKERS=9\nexport BASE_URL="https://a.org/x"\nBOOKS=1,x,67,66\n')
    s = config.Settings.load({"REQUESTS_PER_SECOND": "bad", "VERSION_SUFFIX": "NIV", "WORKERS": "7"}, str(tmp_path / ".env"))
    assert (s.workers, s.per_second, s.books) == (7, 2.0, (1, 66))
    assert s.problems(("a.org",)) == []
    assert len(config.Settings(base_url="http://b.org", workers=0, per_second=21, timeout=4).problems(("a.org",))) == 6


def tiny(spark):
    """Two books: the second without an English title; gaps, a blank and a duplicate below."""
    make = spark.createDataFrame
    return Library(
        make([("b1", 1), ("b2", 2)], schemas.BOOKS),
        make([("t1", "b1", "chinese", "創世記"), ("t2", "b1", "english", "Genesis"), ("t3", "b2", "chinese", "出埃及記")], schemas.BOOK_CONTENTS),
        make([("c1", "b1", 1), ("c2", "b2", 1)], schemas.CHAPTERS),
        make([("k1", "c1", "chinese", "第 1 章"), ("k2", "c1", "english", "Chapter 1"), ("k3", "c2", "english", "Chapter 1")], schemas.CHAPTER_CONTENTS),
        make([("s1", "b1", "c1", 1), ("s2", "b1", "c1", 10), ("s3", "b2", "c2", 2)], schemas.SECTIONS),
        make([("x1", "s1", "chinese", "第1節", "太初", ""), ("x2", "s1", "english", "verse 1", "  ", None), ("x3", "s2", "english", "verse 10", "text", ""), ("x4", "s2", "english", "verse 10", "text", "")], schemas.SECTION_CONTENTS),
    )


def test_validation_on_gaps(spark):
    lib = tiny(spark)
    assert [tuple(r)[1:] for r in V.completeness_summary(lib).collect()] == [(2, 2, 1, 0, 1), (2, 1, 2, 1, 0), (3, 1, 3, 2, 0)]
    assert [r["book_sort"] for r in V.books_missing_content(lib, ordered=True).collect()] == [2]
    assert [tuple(r) for r in V.chapters_missing_content(lib).collect()] == [(2, "出埃及記", T.MISSING, 1, T.MISSING, "Chapter 1", "MISSING", "OK")]
    assert [(r["section_sort"], r["chinese_status"], r["english_status"]) for r in V.sections_missing_content(lib, ordered=True).collect()] == [(10, "MISSING", "OK"), (10, "MISSING", "OK"), (2, "MISSING", "MISSING")]
    assert V.expected_vs_actual_children(lib, catalogue(spark)).filter("book_sort = 1").first()["missing_chapters"] == 49
    assert [tuple(r)[-3:] for r in V.language_count_diff(lib).collect()] == [(1, 3, 2)]
    for name in ("創世記", "Genesis"):
        assert [(r["language"], r["verse_num"]) for r in V.bilingual_viewer(lib, name, 1, ordered=True).collect()] == [("chinese", 1), ("english", 1), ("english", 10), ("english", 10)]
    assert [(r["verse_num"], r["language"]) for r in V.missing_pairs(lib, "出埃及記", 1, ordered=True).collect()] == [(2, "chinese"), (2, "english")]
    assert [tuple(r) for r in V.language_totals(lib, ordered=True).collect()] == [("chinese", 1, 1, 1, 1), ("english", 3, 2, 1, 1)]
    assert [(r["verse_sort"], r["content_preview"]) for r in V.blank_content_guard(lib, ordered=True).collect()] == [(1, "  ")]
    keys = spark.createDataFrame([(1, 1, 1, "m", ""), (1, 1, 99, "m", "")], "book_sort int, chapter_sort int, verse_sort int, resolution_method string, cross_ref_source string")
    assert [(r["chinese_content"], r["english_status"], r["cross_ref_source"]) for r in V.spot_check_keys(lib, keys, ordered=True).collect()] == [("太初", T.EMPTY, None)]
    assert V.missing_pairs(lib, "nothing", 1).count() == 0

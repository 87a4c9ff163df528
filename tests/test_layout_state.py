"""Layouts by key and streams with expiring state."""

import json

from pyspark.sql import functions as F

from lectern.operators import layout
from lectern.operators.store import Store
from lectern.streaming import state


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def stored_side(text):
    """The part of a join's plan that reads the layout: its lines from the scan up to the join."""
    lines = text.splitlines()
    at = next(i for i, x in enumerate(lines) if "layout_" in x)
    depth = lambda x: len(x) - len(x.lstrip(" +-:"))
    side, deep = [], depth(lines[at])
    for x in reversed(lines[: at + 1]):
        if depth(x) < deep or not side:
            side.append(x)
            deep = depth(x)
        if "Join" in x:
            break
    return "\n".join(side)


def test_joins_leave_the_layout_where_it_lies(spark):
    done = layout.lay_out(spark.range(0, 900, 3).selectExpr("if(id % 2 = 0, 'en', 'zh') lang", "cast(id AS string) passage_id"), ["lang", "passage_id"])
    work = spark.range(1000).selectExpr("if(id % 2 = 0, 'en', 'zh') lang", "cast(id AS string) passage_id", "id")
    left = layout.remaining(work, done)
    side = stored_side(plan(left))
    assert "SortMergeJoin" in side and "Exchange" not in side
    assert sorted(r["id"] for r in left.collect()) == [i for i in range(1000) if i % 3 or i >= 900]
    done.drop()
    assert not spark.catalog.tableExists(done.name)


def test_references_move_without_shuffling_the_ids(spark):
    ids = layout.lay_out(spark.range(100).selectExpr("concat('old', id) old", "concat('new', id) new"), ["old"])
    refs = spark.range(150).selectExpr("id", "concat('old', id) ref", "'x' other").union(spark.createDataFrame([(500, None, "x")], "id long, ref string, other string"))
    moved = layout.rekeyed(refs, "ref", ids)
    assert moved.columns == refs.columns and "Exchange" not in stored_side(plan(moved))
    assert {r["id"]: r["ref"] for r in moved.collect()} == {i: f"{'new' if i < 100 else 'old'}{i}" for i in range(150)} | {500: None}
    found = layout.looked_up(ids, "old7", "old8")
    assert sorted(r["new"] for r in found.collect()) == ["new7", "new8"]
    scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert 2 <= scan.metrics().apply("numOutputRows").value() < 100  # the other buckets are not read
    ids.drop()


def line(passage, day, lang="en"):
    return json.dumps({"passage_id": passage, "lang": lang, "bible_id": 1, "book_sort": 1, "chapter_sort": 1, "verse_sort": 1, "content": "text", "crawled_at": f"2024-01-{day:02}T00:00:00Z"})


def test_state_expires(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    batches = iter("abcdefgh")

    def run(*lines):
        (folder / f"{next(batches)}.jsonl").write_text("\n".join(lines))
        state.once_within(spark, f"file://{folder}", f"file://{tmp_path}/out", f"file://{tmp_path}/c", "2 days")
        return sorted((r["lang"], r["passage_id"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())

    assert run(line("1", 1), line("1", 1), line("2", 1), line("1", 1, "zh")) == [("en", "1"), ("en", "2"), ("zh", "1")]
    assert run(line("2", 2), line("3", 2)) == [("en", "1"), ("en", "2"), ("en", "3"), ("zh", "1")]  # a restart remembers
    assert len(run(line("4", 20))) == 5
    assert len(run(line("4", 20))) == 5
    seen = run(line("1", 21), line("1", 21))  # forgotten long ago: passed on again, and then remembered
    assert seen.count(("en", "1")) == 2 and len(seen) == 6
    last = sorted((tmp_path / "c/state/0/0").glob("*.delta"))
    assert last  # what is older has left the state store
    rows = spark.read.format("statestore").load(f"file://{tmp_path}/c")
    assert {(r["key"]["lang"], r["key"]["passage_id"]) for r in rows.collect()} <= {("en", "4"), ("en", "1")}


def test_counters_go_on_after_a_restart(spark, tmp_path):
    folder, store = tmp_path / "lines", Store(spark, f"file://{tmp_path}/s")
    folder.mkdir()
    go = lambda: state.count_imports(spark, f"file://{folder}", store, f"file://{tmp_path}/c")
    held = lambda: sorted((str(r["day"]), r["lang"], r["records"], r["n_chars"]) for r in store.read("counters", state.COUNTERS).collect())
    (folder / "a.jsonl").write_text("\n".join([line("1", 1), line("2", 1), line("1", 2, "zh"), "broken"]))
    go()
    assert held() == [("2024-01-01", "en", 2, 8), ("2024-01-02", "zh", 1, 4)]
    (folder / "b.jsonl").write_text("\n".join([line("3", 1), line("2", 3, "zh")]))
    go()
    go()
    assert held() == [("2024-01-01", "en", 3, 12), ("2024-01-02", "zh", 1, 4), ("2024-01-03", "zh", 1, 4)]

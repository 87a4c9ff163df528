"""Every registered core query equals its SQL; the others are held against plain Python elsewhere."""

import pytest

from lectern import queries as Q
from lectern import registry

SQL = registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, sf_dir, same_as_sql, name):
    same_as_sql(registry.queries()[name](spark, sf_dir), SQL[name])


def test_every_query_has_sql():
    assert set(registry.queries()) == set(SQL)


def test_entry_point(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 2
    assert set(registry.queries()) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())


def test_parse_chapter_leaves_the_bound_to_the_parser(spark, tmp_path, monkeypatch):
    turns = [(1, 0, "a"), (1, 299, "bb"), (1, 300, "ccc"), (2, 999, "e")]
    spark.createDataFrame(turns, "conv_id long, turn int, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    parse, pages = Q.extract.chapters, []
    monkeypatch.setattr(Q.extract, "chapters", lambda df: pages.append(df) or parse(df))
    got = Q.parse_chapter(spark, str(tmp_path)).collect()
    html = {r["page_id"]: r["html"] for r in pages[0].collect()}
    assert "GEN.2.301" in html[1] and "GEN.3.1000" in html[2]
    assert {(r["page_id"], r["verse_sort"]) for r in got} == {(1, 1), (1, 300), (2, None)}
    assert [r["error"] for r in got if r["page_id"] == 2] == ["no verses found"]

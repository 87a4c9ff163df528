"""Plans that return no ids run over natural keys: the rows of the digests, without a digest in any shuffle."""

import re

import duckdb
import pytest
from conftest import rows

from lectern import queries as Q
from lectern import registry
from lectern.operators import migrate
from lectern.plans import validation as V
from lectern.plans.models import t_model
from lectern.schemas import Library

WITHOUT_IDS = [
    "sections_in_order",
    "sections_missing_content",
    "sql_sections_missing_content",
    "blank_content_guard",
    "sql_blank_content_guard",
    "language_count_diff",
    "language_totals",
    "sql_language_totals",
    "sql_language_count_diff",
    "completeness_summary",
    "sql_completeness_summary",
]


@pytest.mark.parametrize("name", WITHOUT_IDS)
def test_no_digest_is_shuffled(spark, sf_dir, name):
    plan = registry.queries()[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "md5" not in plan


@pytest.mark.parametrize("plan", [V.sections_missing_content, V.blank_content_guard, V.language_count_diff, V.language_totals, V.completeness_summary])
def test_natural_keys_give_the_rows_of_digests(spark, sf_dir, plan):
    assert rows(plan(t_model(spark, sf_dir, surrogate=False))) == rows(plan(t_model(spark, sf_dir)))


def _library(spark, salt, sections):
    one = lambda data, schema: spark.createDataFrame(data, schema)
    none = lambda schema: spark.createDataFrame([], schema)
    return Library(
        one([("b", 1)], "id string, sort int"),
        none("id string, book_id string, language string, title string"),
        one([("c", 1), ("d", 2)], "id string, sort int"),
        none("id string, chapter_id string, language string, title string"),
        one([(f"{salt}{c}{n}", "b", c, n) for c, n in sections], "id string, book_id string, chapter_id string, sort int"),
        none("id string, section_id string, language string, title string, content string, sub_title string"),
    )


def test_rekeyed_equals_backup_and_restored(spark):
    old = _library(spark, "old-", [("c", 1), ("c", 2), ("d", 1)])
    new = _library(spark, "new-", [("c", 1), ("d", 1), ("d", 2)])
    refs = [("1", "old-c1"), ("2", "old-c2"), ("3", "old-d1"), ("4", None), ("5", "gone"), ("6", "old-c1")]
    references = {name: spark.createDataFrame(refs, f"id string, {column} string") for name, column in migrate.SOURCES.items()}
    got = rows(migrate.rekeyed(old, new, references))
    assert got == rows(migrate.restored(new, references, migrate.backup(old, references)))
    want = [("1", "new-c1"), ("2", "old-c2"), ("3", "new-d1"), ("4", None), ("5", "gone"), ("6", "new-c1")]
    assert got[1] == sorted((i, str(r), name) for name in migrate.SOURCES for i, r in want)


def test_restore_rekey_moves_each_reference_once(spark, sf_dir):
    plan = Q.restore_rekey(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Join" in line and "source_id" in line]


@pytest.mark.parametrize("name", ["sql_blank_content_guard", "sql_language_totals", "sql_language_count_diff"])
def test_lines_meet_their_orders_without_another_shuffle(spark, sf_dir, name):
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        plan = registry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    lines = plan.splitlines()
    by_order = [line for line in lines if re.search(r"Exchange hashpartitioning\(o#\d+L, \d+\)", line)]
    assert len(by_order) == 2  # the lines once, and their orders
    assert not [line for line in lines if re.search(r"Exchange hashpartitioning\(o#\d+L, n#\d+, \d+\)", line)]


@pytest.mark.parametrize("table", ["books", "chapters"])
def test_a_natural_key_of_one_number_stays_a_number(spark, sf_dir, table):
    assert dict(getattr(t_model(spark, sf_dir, surrogate=False), table).dtypes)["id"] == "bigint"


@pytest.mark.parametrize("name", ["blank_content_guard", "language_totals", "language_count_diff"])
def test_repeated_and_ownerless_rows(spark, tmp_path, name):
    """Repeated lines and orders, lines without an order, orders without a customer, and missing keys, against SQL."""
    tables = {
        "customer": ([(0, "a"), (4, "b"), (6, "c"), (34, "d")], "c_custkey long, c_name string"),
        "orders": ([(48, 0), (48, 0), (49, 4), (11, 6), (13, 99), (143, 34), (50, None)], "o_orderkey long, o_custkey long"),
        "lineitem": ([(48, 2, "F")] * 40 + [(48, 2, "O"), (49, 1, "O"), (49, 3, "F"), (11, 5, "F"), (13, 1, "O"), (143, 7, "F"), (50, 1, "F"), (98, 2, "F"), (None, 2, "F")], "l_orderkey long, l_linenumber int, l_linestatus string"),
    }
    connection = duckdb.connect()
    for table, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).repartition(3).write.parquet(f"{tmp_path}/{table}.parquet")
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
    found = connection.sql(registry.oracle_sql()[name])
    for query in (name, f"sql_{name}"):
        names, got = rows(registry.queries()[query](spark, str(tmp_path)))
        picked = ", ".join(f'"{n}"' for n in names)
        assert got == sorted(tuple(map(str, r)) for r in connection.sql(f"SELECT {picked} FROM found").fetchall())
        assert got

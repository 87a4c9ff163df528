"""The tables in an embedded database."""

import pytest
from pyspark.sql import functions as F

from lectern.plans import validation as V
from lectern.plans.models import c_model, t_model
from lectern.sources.database import SPLIT, Database


def listed(df):
    return sorted(map(str, (tuple(r) for r in df.select(*sorted(df.columns)).collect())))


@pytest.fixture(scope="module")
def database(spark, sf_dir, tmp_path_factory):
    at = tmp_path_factory.mktemp("db")
    found = Database(f"jdbc:derby:directory:{at}/library;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver", partitions=3)
    for name, df in c_model(spark, sf_dir).tables().items():
        found.write(df, name)
    return found


def test_rows_are_those_of_the_tables(spark, sf_dir, database):
    lib, want = database.library(spark), c_model(spark, sf_dir)
    for name in SPLIT:
        assert listed(getattr(lib, name)) == listed(getattr(want, name)), name


def test_a_table_is_read_in_ranges(spark, database):
    chapters = database.read(spark, "chapters", "sort")
    assert chapters.rdd.getNumPartitions() == 3
    per = [r["n"] for r in chapters.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(per) == 3 and sum(per) == chapters.count()
    assert database.read(spark, "chapters").rdd.getNumPartitions() == 1


def test_filters_columns_and_aggregates_are_the_databases(spark, database):
    few = database.read(spark, "sections", "sort").filter("sort > 2 AND book_id IS NOT NULL").select("id")
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThan(SORT,2)" in plan.replace("sort", "SORT") and "content" not in plan
    few_rows = database.read(spark, "sections").filter("sort > 2").count()
    assert few_rows == sum(1 for r in database.read(spark, "sections").collect() if r["sort"] > 2)


def test_queries_run_over_the_database(spark, sf_dir, database):
    lib, want = database.library(spark), c_model(spark, sf_dir)
    for query in (V.completeness_summary, V.language_totals, V.sections_missing_content):
        assert listed(query(lib)) == listed(query(want))


def test_bounds_of_an_empty_table(spark, sf_dir, database):
    database.write(t_model(spark, sf_dir).books.limit(0), "no_books")
    assert database.bounds(spark, "no_books", "sort") is None and database.read(spark, "no_books", "sort").count() == 0

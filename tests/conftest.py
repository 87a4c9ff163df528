import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "3g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    return SF


def rows(df):
    """Rows as sorted tuples of text, columns by name."""
    names = sorted(df.columns)
    return names, sorted(tuple(map(str, r)) for r in df.select(*names).collect())


@pytest.fixture(scope="session")
def same_as_sql(spark, sf_dir):
    import duckdb

    connection = duckdb.connect()
    for name in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")

    def check(df, sql):
        names, got = rows(df)
        found = connection.sql(sql)
        assert names == sorted(found.columns)
        picked = ", ".join(f'"{n}"' for n in names)
        want = sorted(tuple(map(str, r)) for r in connection.sql(f"SELECT {picked} FROM ({sql})").fetchall())
        assert got == want

    return check

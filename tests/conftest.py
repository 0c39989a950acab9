"""A session for all tests, and a comparison of a query with its SQL."""

import math
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", "file://" + str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "null"
    if isinstance(value, float):
        return f"{value:.9g}"
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(plain, value)) + "]"
    return str(value)


def same_rows(df, sql, views):
    """Whether a result equals that of a SQL statement over the views (name -> DataFrame, Arrow table or path)."""
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name, view in views.items():
        if isinstance(view, str):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{view}'")
        else:
            con.register(name, view)
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    want = sorted(tuple(plain(r[names.index(c)]) for c in order) for r in cursor.fetchall())
    got = sorted(tuple(plain(r[c]) for c in order) for r in df.collect())
    assert got == want

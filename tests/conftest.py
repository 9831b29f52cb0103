import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def duck(sf):
    import duckdb

    con = duckdb.connect()
    for path in sorted(Path(sf).glob("*.parquet")):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def cell(x):
    import math

    if x is None or (isinstance(x, float) and math.isnan(x)):
        return "null"
    if isinstance(x, float):
        return f"{x:.9g}"
    if isinstance(x, (list, tuple)):
        return "[" + ",".join(map(cell, x)) + "]"
    return str(x)


def rows_of(rows, names):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted(tuple(cell(r[k]) for k in order) for r in rows)


@pytest.fixture(scope="session")
def same(spark, sf, duck):
    """Asserts that a query and its SQL give the same rows."""
    import __spark_entry__ as entry

    queries, oracle = entry.queries(), entry.oracle_sql()

    def check(name):
        df = queries[name](spark, sf)
        got = duck.sql(oracle[name])
        assert sorted(df.columns) == sorted(got.columns)
        assert rows_of([tuple(r) for r in df.collect()], df.columns) == rows_of(got.fetchall(), got.columns)

    return check

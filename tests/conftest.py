"""One Spark session for all tests, and the test tables."""

from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[1]))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
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
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.fixture(scope="session")
def same():
    """Compares a DataFrame with rows of SQL, by column name and without order."""
    import datetime

    def plain(v):
        if hasattr(v, "item"):
            v = v.item()
        if v != v:
            return None
        return v.isoformat() if isinstance(v, (datetime.date, datetime.datetime)) else v

    def compare(df, con, sql):
        cur = con.execute(sql)
        names = [d[0] for d in cur.description]
        assert sorted(names) == sorted(df.columns)
        order = sorted(names)
        want = sorted((tuple(plain(r[names.index(c)]) for c in order) for r in cur.fetchall()), key=repr)
        got = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr)
        assert got == want
        return len(got)

    return compare

"""A1 from an engine with a Python driver: months in parallel, filters pushed."""

from __future__ import annotations

import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from plumbline.sources.database import SalesReader
from plumbline.sources.sales import SALES, load_sales, sales_view


@pytest.fixture(scope="module")
def db(spark, sf, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("db") / "sales.db")
    con = sqlite3.connect(path)
    con.execute(f"CREATE TABLE sales ({', '.join(SALES.names)})")
    rows = [[None if v is None else str(v) if n in ("month", "list_price", "qty", "amt") else v for n, v in zip(SALES.names, r, strict=True)] for r in sales_view(spark, sf).collect()]
    rows.append([None, "ASIA", None, None, 1, "x", None, "y", None, "Ab", "", None, "1.5", "2.25"])
    con.executemany(f"INSERT INTO sales VALUES ({', '.join('?' * len(SALES.names))})", rows)
    con.commit()
    con.close()
    return {"driver": "sqlite3", "table": "sales", "connect": json.dumps({"database": path})}


def test_the_same_rows_as_from_files(spark, sf, db):
    got, want = load_sales(spark, db), sales_view(spark, sf)
    assert got.schema == want.schema
    held = got.where("month IS NOT NULL")
    assert held.exceptAll(want).count() == 0 and want.exceptAll(held).count() == 0
    odd = got.where("month IS NULL").collect()
    assert len(odd) == 1 and (odd[0]["platform"], odd[0]["item"], str(odd[0]["amt"])) == (None, None, "2.2500")


def test_months_are_partitions(spark, sf, db):
    months = sales_view(spark, sf).select("month").distinct().count()
    assert load_sales(spark, db).rdd.getNumPartitions() == months + 1


def test_filters_leave_months_unread(spark, sf, db):
    one = load_sales(spark, db).where("month = DATE'2001-06-01' AND country = 'ASIA' AND node > 10 AND amt > 100")
    assert one.rdd.getNumPartitions() == 1
    want = sales_view(spark, sf).where("month = DATE'2001-06-01' AND country = 'ASIA' AND node > 10 AND amt > 100")
    assert one.count() == want.count() > 0
    few = load_sales(spark, db).where(F.col("month").isin("2001-06-01", "2001-05-01") | F.col("month").isNull())
    assert few.count() == sales_view(spark, sf).where("month IN (DATE'2001-06-01', DATE'2001-05-01')").count() + 1
    assert load_sales(spark, db).where("month > DATE'2050-01-01'").count() == 0


def test_what_the_engine_is_given():
    from pyspark.sql.datasource import EqualTo, GreaterThan, IsNull, Not, StringStartsWith
    import datetime

    r = SalesReader(SALES, {"driver": "sqlite3", "table": "t"})
    filters = [EqualTo(("month",), datetime.date(2001, 6, 1)), EqualTo(("country",), "A"), GreaterThan(("amt",), 3), IsNull(("brand",)), StringStartsWith(("brand",), "x"), Not(IsNull(("node",)))]
    # text and money are looked at again by Spark, or by Spark alone
    assert list(r.pushFilters(filters)) == [filters[1], filters[2], filters[4], filters[5]]
    assert r.where == ["month = ?", "country = ?", "brand IS NULL"] and r.values == ["2001-06-01", "A"]

"""Every query of the monthly run against its SQL."""

from __future__ import annotations

import pytest

from plumbline.plans.monthly import QUERIES
from plumbline.plans.oracle import ORACLE


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, sf, duck, same, name):
    same(QUERIES[name](spark, sf), duck, ORACLE[name])


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    found = entry.entry(spark)
    assert found.count() > 0 and found.columns[-4:] == ["added", "lost", "matched", "change"]

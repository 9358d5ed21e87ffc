"""A whole monthly run: every view is landed and can be made again, a second run takes
its place, the source is read once, and a source that changes is an error."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from plumbline.operators import freeze
from plumbline.plans import monthly, run, views
from plumbline.sources.sales import SITE, current_push, load_sales, previous_push, sales_view

MONTH, BASE = "2001-06-01", "2001-05-01"


@pytest.fixture(scope="module")
def pushes(spark, sf, tmp_path_factory):
    """Two pushes as files, so that their reads can be told apart."""
    path = tmp_path_factory.mktemp("pushes")
    w = sales_view(spark, sf)
    current_push(w).write.parquet(f"{path}/sales")
    previous_push(w).write.parquet(f"{path}/last")
    return str(path)


def _told(spark, rows=()):
    return spark.createDataFrame(list(rows), "country string, platform string").selectExpr("*", "DATE'2001-01-01' AS from_month", "DATE'2001-12-01' AS to_month")


def _inputs(spark, path):
    now = load_sales(spark, f"{path}/sales").where(F.col("month") == F.lit(MONTH).cast("date"))
    items = now.select("item").distinct()
    return {
        "verdicts": items.selectExpr("item", "IF(item % 3 = 0, 'mismatch', 'match') AS verdict", "1L AS judged_at", "'random' AS reason"),
        "truth": now.where("item % 2 = 0").groupBy("month", *SITE, "item").agg(F.sum("amt").cast("decimal(24,4)").alias("true_amt")),
        "corrections": items.selectExpr("item", "'brand' AS field", "IF(item % 5 = 0, 'no such brand', 'x') AS wanted").where("item % 5 = 0"),
        "defects": spark.createDataFrame([(1, "ASIA", None, None, "amt", 1.0), (2, None, None, None, "qty", 1e9)], views.INPUTS["defects"]),
        "ledger": spark.sql("SELECT 1 AS id, DATE'2001-05-01' AS promised_by"),
        "words": spark.createDataFrame([("red",)], "word string"),
    }


@pytest.fixture(scope="module")
def whole(spark, pushes):
    path = f"{pushes}/run"
    out = run.monthly_run(load_sales(spark, f"{pushes}/sales"), load_sales(spark, f"{pushes}/last"), None, _told(spark), MONTH, BASE, path, "r1", _inputs(spark, pushes))
    return path, out


def test_every_view_lands_and_the_source_is_read_once(spark, pushes, whole):
    path, _ = whole
    assert {r["view"] for r in spark.read.parquet(f"{path}/catalog").select("view").collect()} == set(views.VIEWS)
    # plans that read rows of the push; the listing of its files is none
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    text = [runs.apply(i).physicalPlanDescription() for i in range(runs.size())]
    scans = [t for t in text if f"{pushes}/sales]" in t and "Scan parquet" in t and "run/inputs/now" in t]
    assert len(scans) == 1


def test_twelve_modules_by_site(spark, whole):
    path, out = whole
    rows = out.collect()
    sites = freeze.thaw(spark, "now", "r1", f"{path}/inputs").where(F.col("month") == F.lit(MONTH).cast("date")).select(*SITE).distinct().count()
    assert {r["module"] for r in rows} == set(views.MODULES) and len(rows) == 12 * sites
    by = {(r["module"], r["country"], r["platform"]): r for r in rows}
    # the known defect is of one country
    assert {r["status"] for k, r in by.items() if k[0] == "defects" and k[1] == "ASIA"} == {"fail"}
    assert {r["status"] for k, r in by.items() if k[0] == "defects" and k[1] != "ASIA"} == {"pass"}
    # corrections are lost at the items that they are about
    lost = freeze.thaw(spark, "now", "r1", f"{path}/inputs").where((F.col("month") == F.lit(MONTH).cast("date")) & (F.col("item") % 5 == 0)).select(*SITE).distinct().collect()
    assert {k[1:] for k, r in by.items() if k[0] == "carry" and r["flags"] > 0} >= {tuple(r) for r in lost}
    # estimates are the truth, so nothing is said against them
    assert {r["status"] for k, r in by.items() if k[0] == "own"} == {"pass"}
    assert all(0 <= r["share"] <= 1.000001 for r in rows if r["share"] is not None)


def test_a_flag_leads_to_its_items(spark, whole):
    path, _ = whole
    flags, drilled = (freeze.landed(spark, "r1", v, path) for v in ("flags", "drilled"))
    assert drilled.count() > 0 and drilled.select("key").distinct().join(flags, "key", "left_anti").count() == 0
    assert drilled.groupBy("key").agg(F.max("rank").alias("n")).agg(F.max("n")).first()[0] <= 20


@pytest.mark.parametrize("view", ["push_diff", "price_summary", "clustered", "screened", "acceptance"])
def test_a_view_is_made_again_from_its_record(spark, whole, view):
    path, _ = whole
    assert {r["side"]: r["rows"] for r in run.recompute(spark, "r1", view, path).collect()} == {"landed": 0, "recomputed": 0}


def test_a_landed_row_that_was_altered_is_told(spark, whole, tmp_path):
    path, _ = whole
    rows = freeze.landed(spark, "r1", "site_totals", path)
    other = rows.withColumn("items", F.col("items") + F.when((F.col("gid") == 0) & (F.col("country") == "ASIA") & (F.col("platform") == "BUILDING") & (F.col("month") == F.lit(MONTH).cast("date")), 1).otherwise(0))
    held = freeze.recorded(spark, "r1", "site_totals", path)
    other.write.parquet(f"{tmp_path}/rows")
    record = {k: x for k, x in held.items() if k != "plan"}
    freeze.land(spark.read.parquet(f"{tmp_path}/rows"), "r1", "site_totals", "altered", path, record)
    assert {r["side"]: r["rows"] for r in run.recompute(spark, "r1", "site_totals", path).collect()} == {"landed": 1, "recomputed": 1}
    with pytest.raises(KeyError):
        views.resolve("no_such_view")
    with pytest.raises(KeyError):
        run._tables(spark, "r1", path, ("now",))("then")


def test_a_run_done_again_and_without_inputs(spark, pushes, whole):
    path, _ = whole
    declared = _told(spark, [(None, None)])
    out = run.monthly_run(load_sales(spark, f"{pushes}/sales"), load_sales(spark, f"{pushes}/last"), None, declared, MONTH, BASE, path, "r2").collect()
    assert {r["status"] for r in out} <= {"explained", "pass", "not checked"}
    for module in ("own", "defects"):
        assert {r["status"] for r in out if r["module"] == module} == {"not checked"}
    for _ in range(2):
        run.land_views(spark, "r2", run.parameters(MONTH, BASE), path, ["level_break"])
    assert freeze.thaw(spark, "rules", "r2", f"{path}/inputs").count() == len(views.RULES)
    assert set(freeze.landed(spark, "r2", "outliers", path).columns) >= {"country", "platform", "l2"}
    with pytest.raises(KeyError):
        run.freeze_inputs(load_sales(spark, f"{pushes}/sales"), load_sales(spark, f"{pushes}/last"), None, declared, "r3", path, {"nothing": declared})


def test_a_source_that_changes_is_an_error_that_names_the_month(spark, pushes, tmp_path):
    load_sales(spark, f"{pushes}/sales").write.parquet(f"{tmp_path}/sales")
    sales, last = load_sales(spark, f"{tmp_path}/sales"), load_sales(spark, f"{pushes}/last")
    run.freeze_inputs(sales, last, None, _told(spark), "r", str(tmp_path))
    run._settle(sales, "r", str(tmp_path))
    more = load_sales(spark, f"{pushes}/sales").where("month = DATE'2000-03-01'").limit(1)
    more.write.mode("append").parquet(f"{tmp_path}/sales")
    with pytest.raises(RuntimeError, match="in 2000-03-01$"):
        run._settle(load_sales(spark, f"{tmp_path}/sales"), "r", str(tmp_path))
    mark = freeze.thaw(spark, "fingerprint", "r", f"{tmp_path}/inputs").first()
    plain = freeze.fingerprint(load_sales(spark, f"{pushes}/sales"), "month").first()
    assert (mark["rows"], mark["updated"], mark["checksum"]) == tuple(str(plain[c]) for c in ("rows", "updated", "checksum"))


def test_kept_bases_give_the_same(spark, sf):
    cold = monthly.QUERIES["C1_site_totals"](spark, sf)
    monthly.keep(spark, sf)
    try:
        kept = monthly.QUERIES["C1_site_totals"](spark, sf)
        assert cold.exceptAll(kept).count() == 0 and kept.count() == cold.count()
    finally:
        monthly.drop(spark, sf)
    assert not monthly._KEPT

"""One monthly run from the push to the acceptance table, all of it landed, and any
view of it made again."""

from __future__ import annotations

from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from graphlib import TopologicalSorter

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from ..operators import freeze
from ..sources.sales import base
from . import views as v

#: Views that are made at the same time.
SLOTS = 4


def _tables(spark: SparkSession, run_id: str, path: str, allowed: tuple[str, ...]) -> v.Tables:
    """The tables that a view may read: frozen inputs and landed views of its run."""

    def table(name: str) -> DataFrame:
        if name not in allowed:
            raise KeyError(f"the view doesn't say that it needs {name!r}")
        return freeze.landed(spark, run_id, name, path) if name in v.VIEWS else freeze.thaw(spark, name, run_id, f"{path}/inputs")

    return table


def graph(names: list[str] | None = None) -> dict[str, set[str]]:
    """Each view with the views that it needs, and theirs."""
    todo, out = list(names or v.VIEWS), {}
    while todo:
        name = todo.pop()
        if name not in out:
            out[name] = {n for n in v.resolve(name).needs if n in v.VIEWS}
            todo += out[name]
    return out


def make(spark: SparkSession, run_id: str, name: str, parameters: dict, path: str) -> DataFrame:
    """A view from the frozen inputs and the landed views of a run."""
    found = v.resolve(name)
    return found.make(_tables(spark, run_id, path, found.needs), parameters)


def land_views(spark: SparkSession, run_id: str, parameters: dict, path: str, names: list[str] | None = None, slots: int = SLOTS) -> None:
    """Land views, and first those that they need; views that don't wait for each other
    are submitted together."""
    order = TopologicalSorter(graph(names))
    order.prepare()

    def land(name: str) -> None:
        made = {"operator": name, "inputs": list(v.resolve(name).needs), "parameters": parameters}
        freeze.land(make(spark, run_id, name, parameters, path), run_id, name, f"{name}({parameters['month']}, {parameters['base_month']})", path, made)

    with ThreadPoolExecutor(slots) as pool:
        running: dict = {}
        while order.is_active():
            for name in order.get_ready():
                running[pool.submit(inheritable_thread_target(spark)(land), name)] = name
            for done in wait(running, return_when=FIRST_COMPLETED).done:
                done.result()
                order.done(running.pop(done))


def recompute(spark: SparkSession, run_id: str, view: str, path: str) -> DataFrame:
    """M5: makes a landed view again from its record in the catalog, and tells the rows
    that only one of both has, as (side, rows)."""
    record = freeze.recorded(spark, run_id, view, path)
    found = v.resolve(record["operator"])
    again = found.make(_tables(spark, run_id, path, tuple(record["inputs"])), record["parameters"])
    return freeze.recompute(freeze.landed(spark, run_id, view, path), again)


def _settle(sales: DataFrame, run_id: str, path: str) -> None:
    """An error if the source isn't what was read: its files are looked at, and only if
    they differ (or there are none) its rows are read again, to name the months."""
    spark = sales.sparkSession
    after = freeze.stamp(sales)
    if after is not None:
        before = freeze.thaw(spark, "stamp", run_id, f"{path}/inputs")
        if before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty():
            return
    frozen = freeze.month_checksums(freeze.thaw(spark, "now", run_id, f"{path}/inputs"))
    months = [str(r["month"]) for r in freeze.changed_months(frozen, freeze.month_checksums(sales)).orderBy("month").collect()]
    if months:
        raise RuntimeError(f"the source changed during the run, in {', '.join(months)}")


def parameters(month: str, base_month: str, leaf: str = "l2", edges: tuple[float, ...] = (1000.0, 2000.0, 3000.0, 5000.0), sample: int = 5, given: tuple[str, ...] = ()) -> dict:
    """A run's parameters as the catalog keeps them; ``given``: the inputs it has."""
    return {"month": month, "base_month": base_month, "leaf": leaf, "edges": list(edges), "sample": sample, "absent": sorted(set(v.INPUTS) - set(given))}


def freeze_inputs(sales: DataFrame, last_push: DataFrame, rules: DataFrame | None, declarations: DataFrame, run_id: str, path: str, inputs: dict[str, DataFrame] | None = None) -> None:
    """Store all that the views read. The source is read once: that pass builds the
    base and takes the fingerprint, whole and by month."""
    spark = sales.sparkSession
    given = inputs or {}
    if unknown := set(given) - set(v.INPUTS):
        raise KeyError(f"no inputs {sorted(unknown)}")
    # what the files are before any row is read
    if (before := freeze.stamp(sales)) is not None:
        freeze.freeze({"stamp": before}, run_id, f"{path}/inputs")
    rules = spark.createDataFrame(v.RULES, v.RULE_SCHEMA) if rules is None else rules
    watched, seen = freeze.observed(sales, "month")
    frozen = {"now": base(watched, checks=True), "then": base(last_push), "rules": rules, "declarations": declarations}
    frozen |= {name: given[name] if name in given else v.empty(spark, name) for name in v.INPUTS}
    freeze.freeze(frozen, run_id, f"{path}/inputs")
    mark = {k: str(x) for k, x in seen.get.items()}
    checks = freeze.month_checksums(freeze.thaw(spark, "now", run_id, f"{path}/inputs"))
    freeze.freeze({"month_checksums": checks, "fingerprint": spark.createDataFrame([mark], "rows string, updated string, checksum string")}, run_id, f"{path}/inputs")


def monthly_run(
    sales: DataFrame, last_push: DataFrame, rules: DataFrame | None, declarations: DataFrame, month: str, base_month: str, path: str, run_id: str,
    inputs: dict[str, DataFrame] | None = None, names: list[str] | None = None, **more,
) -> DataFrame:
    """Freeze the inputs, land every view and the flags, and return the acceptance of
    each of the twelve modules and each site.

    ``rules``: metric, low, high, rule, severity (none: ``views.RULES``).
    ``declarations``: country, platform (null: any), from_month, to_month. ``inputs``: see
    ``views.INPUTS``; ``names``: only these views and what they need; ``more``: see
    ``parameters``. A run that is done again with its id takes its own place. An error
    says if the source changed meanwhile, and in which months.
    """
    spark = sales.sparkSession
    freeze_inputs(sales, last_push, rules, declarations, run_id, path, inputs)
    land_views(spark, run_id, parameters(month, base_month, given=tuple(inputs or ()), **more), path, names)
    _settle(sales, run_id, path)
    last = "acceptance" if not names else names[-1]
    return freeze.landed(spark, run_id, last, path)

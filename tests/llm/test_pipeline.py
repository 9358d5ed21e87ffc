"""Each stage of the pipeline against plain code on its own input."""

from __future__ import annotations

import corpus_pipeline as pipeline
from plumbline.llm import common

from .test_neardup import _brute


def test_stages(spark, sf):
    assert [k for k, _ in pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "packing"]
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in pipeline.STAGES[:-1]:
        docs = common.materialise(stage(spark, docs, sf), f"test-{name}")
        assert docs.columns == columns
        seen.append({r["doc_id"]: r["text"] for r in docs.collect()})
    source = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    quality, lines, near, clean = seen
    assert all(source[d] == t for d, t in quality.items()) and len(quality) < len(source)
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    good = [d for d, r in labels.items() if r["quality"] == 1 and r["toxic"] == 0]
    assert sum(d in quality for d in good) >= 0.95 * len(good)
    # lines only go, in order, and a document goes only with its last line
    for d, t in quality.items():
        if d in lines:
            left = iter(t.split("\n"))
            assert all(x in left for x in lines[d].split("\n"))
    rows = sorted(lines.items())
    component = [c for _, c in _brute(rows, 5, 80)]
    assert set(near) == {d for (d, _), c in zip(rows, component, strict=True) if c == d}
    items = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert set(clean) <= set(near)
    for d, t in near.items():
        if any(i in t for i in items):
            assert d not in clean
    packed = pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r["doc_id"] for r in packed} == set(clean)


def test_stages_with_null_ids_and_clashing_columns(spark, sf):
    """Null ids and texts, repeated rows, and columns named like those of the operators."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(30)
    odd = docs.limit(3).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text", "lang", "source", "n_chars")
    empty = docs.limit(2).selectExpr("doc_id + 1000000 AS doc_id", "CAST(NULL AS STRING) AS text", "lang", "source", "n_chars")
    every = docs.unionByName(odd).unionByName(empty).unionByName(docs.limit(2))
    every = every.selectExpr("*", *(f"'{c}' AS `{c}`" for c in ("row", "length", "start", "label", "_kept", "h", "i", "value", "piece")))
    for name, stage in pipeline.STAGES[:-1]:
        left = common.materialise(stage(spark, every, sf), f"odd-{name}")
        assert left.columns == every.columns and left.exceptAll(every.select(left.columns)).where("text IS NOT NULL").join(every.select("doc_id"), "doc_id", "left_anti").where("doc_id IS NOT NULL").count() == 0
        assert left.select("row", "piece").distinct().collect() == [("row", "piece")]
        none = stage(spark, every.limit(0), sf)
        assert none.count() == 0 and none.columns == every.columns
    packed = pipeline.STAGES[-1][1](spark, every, sf).collect()
    assert len([r for r in packed if r["piece"] == 0]) == every.count() and sum(r["doc_id"] is None for r in packed if r["piece"] == 0) == 3


def test_run_is_the_stages(spark, sf):
    assert pipeline.run(spark, sf).count() > 0

"""Connected components, and brands over chains of aliases."""

from __future__ import annotations

import random

from plumbline.functions.components import components
from plumbline.operators import brand


def _brute(edges):
    up: dict = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            up[y] = x
    return {x: find(x) for x in up}


def test_components_of_any_shape(spark):
    rng = random.Random(3)
    chain = [f"c{i:03}" for i in range(200)]
    rng.shuffle(chain)
    star = [("hub", f"s{i}") for i in range(300)]
    loose = [(f"r{rng.randrange(80)}", f"r{rng.randrange(80)}") for _ in range(50)]
    edges = list(zip(chain, chain[1:], strict=False)) + star + loose + [("x", "x"), (None, "n"), ("n2", None), ("a", "b"), ("b", "a"), ("a", "b")]
    rng.shuffle(edges)
    got = components(spark.createDataFrame(edges, "p string, q string"), "p", "q").collect()
    assert {r["node"]: r["component"] for r in got} == _brute(edges) and len(got) == len(_brute(edges))
    assert components(spark.createDataFrame([], "p string, q string"), "p", "q").count() == 0


def test_a_chain_of_three_spellings_is_one_brand(spark):
    rows = [("ソニー(Sony)", "ソニー", 1), ("Sony/SONY Corp", "Sony", 2), ("SONY CORP", "ソニー", 3), ("Acme", "ソニー", 4), (None, "ソニー", 5), ("Acme", None, 6)]
    names = spark.createDataFrame(rows, "raw_brand string, brand string, n int").selectExpr("raw_brand", "brand", "CAST(n AS DECIMAL(20,4)) AS amt")
    assert ("SONY CORP", "ソニー") in {(r["raw_brand"], r["brand"]) for r in brand.swallowed(names).collect()}
    family = brand.families(names)
    assert {r["raw_brand"] for r in brand.swallowed_families(names, family).where("brand IS NOT NULL AND raw_brand IS NOT NULL").collect()} == {"Acme"}
    split = {(r["family"], r["standard"]): r["share"] for r in brand.split_families(names, family).collect()}
    assert {k[1] for k in split if k[0] == "sony"} == {"ソニー", "Sony"} and split["sony", "ソニー"] == round(4 / 6, 6)

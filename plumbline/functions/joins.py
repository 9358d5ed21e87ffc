"""Joins in which a null key is a key like any other."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equality join on ``keys``, null being equal to null; each key comes out once.

    Pushes come with labels missing: with a plain join their rows would be both
    added and removed. Spark still hashes on the keys.
    """
    # every column of the right side is named anew, so that both may come from one table
    other = right.select(*(F.col(f"`{c}`").alias(f"_right_{c}") for c in right.columns))
    same = reduce(and_, (left[f"`{k}`"].eqNullSafe(other[f"`_right_{k}`"]) for k in keys))
    both = left.join(other, same, how)
    if how in ("left_semi", "left_anti"):
        return both
    one = lambda k: F.coalesce(left[f"`{k}`"], other[f"`_right_{k}`"]).alias(k) if how == "full_outer" else left[f"`{k}`"]
    mine = [left[f"`{c}`"] for c in left.columns if c not in keys]
    theirs = [other[f"`_right_{c}`"].alias(c) for c in right.columns if c not in keys]
    return both.select(*(one(k) for k in keys), *mine, *theirs)

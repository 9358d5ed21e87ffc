"""Numbers that come out the same in any engine.

Money is summed as decimals; what leaves an operator is a double, rounded by
``floor(x * 10**n + 0.5)``, as engines differ in how they round ties.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(x: Column, places: int = 6) -> Column:
    """``x`` to a number of places, halves upwards."""
    unit = 10**places
    return F.floor(x.cast("double") * unit + 0.5) / unit


def ratio(a: Column, b: Column, places: int = 6) -> Column:
    """a / b as doubles, rounded; null if b is null or 0."""
    low = b.cast("double")
    return rounded(F.when(low != 0, a.cast("double") / low), places)


def total(name: str) -> Column:
    """Sum of a decimal column, as a double."""
    return F.sum(name).cast("double")


def median_of(values: Column) -> Column:
    """Median of an array of numbers without nulls; null for an empty one."""
    v, n = F.array_sort(values), F.size(values)
    low, high = F.floor((n + 1) / 2).cast("int"), F.floor((n + 2) / 2).cast("int")
    return F.when(n > 0, (F.element_at(v, F.greatest(low, F.lit(1))) + F.element_at(v, F.greatest(high, F.lit(1)))) / 2)

"""Column expressions over arrays that take few steps however long the array is."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once, however often and wherever `use` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _steps(size: Column) -> Column:
    """The powers of two below `size`, the least first."""
    return F.filter(F.lit([1 << k for k in range(31)]), lambda d: d < size)


def running(values: Column) -> Column:
    """The sums of an array's values up to each: every step adds to each sum the one so many places before it,
    and the next step looks twice as far, so n values take log n steps and no array grows."""
    far = lambda sums, d: F.transform(sums, lambda v, i: v + F.when(i >= d, F.get(sums, i - d)).otherwise(0))
    return let(values, lambda v: F.aggregate(_steps(F.size(v)), v, far))


def below(ordered: Column, limit: Column, equal: bool = False) -> Column:
    """How many values of an ascending array are less than `limit` (or equal to it), by halving."""
    less = lambda v: v <= limit if equal else v < limit
    further = lambda low, d: F.when((low + d <= F.size(ordered)) & less(F.get(ordered, low + d - 1)), low + d).otherwise(low)
    return F.aggregate(F.reverse(_steps(F.size(ordered) + 1)), F.lit(0), further)

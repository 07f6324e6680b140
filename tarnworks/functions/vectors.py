"""Small array arithmetic."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``."""
    return F.transform(F.array(value), body)[0]


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0.0), lambda s, x: s + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def minus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def times(a: Column, k: Column) -> Column:
    return F.transform(a, lambda x: x * k)


def exploded(array: Column) -> Column:
    """Explode for arrays that are costly to make; empty ones give a null row.

    The plain ``explode`` lets the optimizer derive a filter on the array's size, which
    makes the array twice.
    """
    return F.explode_outer(array)


def pos_exploded(array: Column) -> Column:
    """``exploded`` with positions."""
    return F.posexplode_outer(array)


def once(value: Column) -> Column:
    """A costly value as one generated row, so that filters on it stay above it. The optimizer moves
    filters below a plain column and makes the value again for each mention."""
    return F.explode_outer(F.array(value))

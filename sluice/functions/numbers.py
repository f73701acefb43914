"""Integer arithmetic as in the detectors: whole division, shares, scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def div(a: Column, b: Column) -> Column:
    """Whole quotient of whole non-negative numbers, exact over all of 64 bits; null where b is zero."""
    return F.when(b != 0, F.call_function("div", a.cast("long"), b.cast("long")))


def ratio(a: Column, b: Column) -> Column:
    """Quotient as a double; null where b is zero."""
    return F.when(b != 0, a.cast("double") / b)


def logistic(score: Column, scale: float = 2.0) -> Column:
    return 1 / (1 + F.exp(-score / scale))


def minute(seconds: Column) -> Column:
    return seconds - seconds % 60


def tumble(seconds: Column, width: int) -> Column:
    """Start of the window of so many seconds."""
    return seconds - seconds % width

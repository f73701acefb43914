"""Bits as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_all(flags: Column, wanted: int) -> Column:
    return flags.bitwiseAND(F.lit(wanted)) == wanted


def has_any(flags: Column, wanted: int) -> Column:
    return flags.bitwiseAND(F.lit(wanted)) != 0


def without(bitmap: Column, other: Column) -> Column:
    """The bits of bitmap that other doesn't have."""
    return bitmap.bitwiseAND(F.bitwise_not(other))


def is_single(bitmap: Column) -> Column:
    return F.bit_count(bitmap) == 1


def of_id(identity: Column) -> Column:
    """The bit of an id that counts from 1 (64 is the sign bit)."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), (identity - 1).cast("int"))


def ids(bitmap: Column) -> Column:
    """The ids of a bitmap's bits, from 1, in order."""
    return F.filter(F.sequence(F.lit(1), F.lit(64)), lambda i: F.getbit(bitmap, i - 1) == 1)


def saturated(value: Column, width: int) -> Column:
    """A counter of so many bits that stops at its highest value."""
    return F.least(value, F.lit((1 << width) - 1))

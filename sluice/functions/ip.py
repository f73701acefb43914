"""Addresses as Column expressions: text to number and back, masks, prefixes, families."""

from __future__ import annotations

import ipaddress

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

IPV4 = r"^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?:\.(?!$)|$)){4}$"


def is_ipv4(text: Column) -> Column:
    return F.coalesce(text.rlike(IPV4), F.lit(False))


def ipv4_number(text: Column) -> Column:
    """Dotted quad to unsigned number; null for anything else."""
    parts = F.transform(F.split(text, r"\."), lambda x: x.try_cast("long"))
    return F.when(is_ipv4(text), F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a * 256 + x))


def ipv4_text(number: Column) -> Column:
    return F.concat_ws(".", *(F.shiftright(number, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)))


def mask(number: Column, prefix: Column | int) -> Column:
    """The network of an address: its first `prefix` bits."""
    length = F.lit(prefix) if isinstance(prefix, int) else prefix
    return number - number % F.call_function("shiftleft", F.lit(1).cast("long"), (32 - length).cast("int"))


def prefix_ends(network: Column, prefix: Column) -> tuple[Column, Column]:
    """First and last address of a network."""
    first = mask(network, prefix)
    return first, first + F.pow(F.lit(2), 32 - prefix).cast("long") - 1


def hex_of_ipv4(number: Column) -> Column:
    """The address as 32 hexadecimal digits, where IPv4 has its place among IPv6 addresses (::ffff:0:0/96)."""
    return F.concat(F.lit("00000000000000000000ffff"), F.lower(F.lpad(F.hex(number), 8, "0")))


def hex_of_ipv6(packed: Column) -> Column:
    """An address of 16 bytes as 32 hexadecimal digits."""
    return F.lower(F.hex(packed))


def ipv6_halves(packed: Column) -> tuple[Column, Column]:
    """The first and the last 64 bits of an address of 16 bytes, as signed longs."""
    first, last = (F.conv(F.hex(F.substring(packed, start, 8)), 16, -10).cast("long") for start in (1, 9))
    return first, last


def mask6(halves: tuple[Column, Column], prefix: Column | int) -> tuple[Column, Column]:
    """The network of an address in halves: its first `prefix` bits."""

    def first_bits(half: Column, n: Column) -> Column:
        return F.when(n <= 0, F.lit(0).cast("long")).when(n >= 64, half).otherwise(half.bitwiseAND(F.call_function("shiftleft", F.lit(-1).cast("long"), (64 - n).cast("int"))))

    length = F.lit(prefix) if isinstance(prefix, int) else prefix
    return first_bits(halves[0], length), first_bits(halves[1], length - 64)


@F.pandas_udf(T.BinaryType())
def ipv6_bytes(text: pd.Series) -> pd.Series:
    """An IPv6 address in any of its spellings as 16 bytes; null for anything else."""

    def parsed(x: str | None) -> bytes | None:
        try:
            return ipaddress.IPv6Address(x).packed
        except ValueError:
            return None

    return text.map(parsed, na_action="ignore")


@F.pandas_udf(T.StringType())
def ipv6_exploded(text: pd.Series) -> pd.Series:
    """An IPv6 address with all its digits; null for anything else."""

    def long(x: str | None) -> str | None:
        try:
            return ipaddress.IPv6Address(x).exploded
        except ValueError:
            return None

    return text.map(long, na_action="ignore")

"""Lookups in ranges of addresses that overlap and nest: a sweep makes disjoint pieces, a sort by ranges finds the piece.

Addresses are hexadecimal texts of one width (ip.hex_of_ipv4, ip.hex_of_ipv6), so both families are one ordered space.
Of ranges that cover an address the narrowest counts, of equally narrow ones the least value. Nothing is broadcast but a
row for each partition.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.storage import cut

#: Stretches that the address space is cut into for the sweep, and about how many ends are looked at to cut it evenly.
STRETCHES, SAMPLE = 64, 20_000
DIGITS = 32


def stretches(ranges: DataFrame, most: int = STRETCHES) -> list[str]:
    """Where stretches begin: ends that cut a sample of the ranges evenly. It balances the work and changes no result."""
    n = ranges.count()
    share = min(1.0, SAMPLE / max(1, n))
    sample = sorted(r[0] for r in ranges.filter(F.pmod(F.xxhash64("low", "high"), F.lit(1 << 20)) < max(1, int(share * (1 << 20)))).select("low").distinct().collect())
    step = max(1, len(sample) // most)
    return sample[step::step][: most - 1]


def _sweep(bounds: list[str]):
    edges = [0, *(int(b, 16) for b in bounds), 1 << 4 * DIGITS]

    def swept(part: int, rows: Iterator[tuple[int, str, str, str]]) -> Iterator[tuple[str, str, str]]:
        start, end = edges[part], edges[part + 1]
        active: list[tuple[int, str, int]] = []  # width, value, last address
        at = start

        def until(stop: int) -> Iterator[tuple[str, str, str]]:
            nonlocal at
            while at < stop:
                while active and active[0][2] < at:
                    heapq.heappop(active)
                if not active:
                    at = stop
                    return
                width, value, last = active[0]
                to = min(last, stop - 1)
                yield f"{at:0{DIGITS}x}", f"{to:0{DIGITS}x}", value
                at = to + 1

        for _, low, high, value in rows:
            first, last = int(low, 16), int(high, 16)
            yield from until(max(first, start))
            heapq.heappush(active, (last - first, value, last))
        yield from until(end)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        out: list[tuple[str, str, str]] = []

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.string()) for i in range(3)], ["low", "high", "value"])

        for part, own in groupby(rows, itemgetter(0)):
            for piece in swept(part, own):
                out.append(piece)
                if len(out) == 4096:
                    yield packed()
                    out = []
        yield packed()

    return run


def pieces(ranges: DataFrame) -> DataFrame:
    """Disjoint low, high and value of ranges (low, high, value as texts); ranges that end before they begin count for nothing.

    A range goes to each stretch that it reaches into, and a stretch is swept from its beginning to its end with the
    ranges that are open there in a heap. A stretch with very many ranges is one task's work; its rows are streamed.
    """
    r = ranges.select("low", "high", "value").filter("low <= high and value is not null").distinct()
    bounds = stretches(r)
    known = F.array(*map(F.lit, bounds)) if bounds else F.array().cast("array<string>")

    def part(x: str) -> Column:
        return F.size(F.filter(known, lambda b: b <= F.col(x)))

    spread = r.select(F.explode(F.sequence(part("low"), part("high"))).alias("part"), "low", "high", "value")
    return spread.repartition("part").sortWithinPartitions("part", "low", "high", "value").mapInArrow(_sweep(bounds), "low string, high string, value string")


def located(rows: DataFrame, address: str, found: DataFrame, name: str = "value") -> DataFrame:
    """rows with `name`: the value of the piece that holds the address, or null.

    Pieces and rows are sorted together by ranges of the address; an address that very many rows have is parted too. A
    row's piece is the last one before it in its partition or, if there is none, the last one of an earlier partition.
    """
    own = F.struct(*(F.col(c) for c in rows.columns))
    ends = found.select(F.col("low").alias("__k"), F.lit(0).alias("__kind"), F.lit(0).cast("long").alias("__h"), F.struct("low", "high", "value").alias("__piece"), F.lit(None).cast(rows.select(own.alias("x")).schema["x"].dataType).alias("__row"))
    asked = rows.select(F.col(address).alias("__k"), F.lit(1).alias("__kind"), F.monotonically_increasing_id().alias("__h"), F.lit(None).cast("struct<low:string,high:string,value:string>").alias("__piece"), own.alias("__row"))
    keys = ["__k", "__kind", "__h"]
    laid = cut(ends.unionByName(asked).repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__part", F.spark_partition_id()))
    here = F.last("__piece", True).over(Window.partitionBy("__part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0))
    per_part = laid.groupBy(F.col("__part").alias("__p")).agg(F.max("__piece").alias("__last"))  # a row a partition
    before = per_part.select("__p", F.last("__last", True).over(Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)).alias("__before"))
    met = laid.withColumn("__piece", here).filter("__kind = 1").join(F.broadcast(before), F.col("__part") == F.col("__p"))
    piece = F.coalesce("__piece", "__before")
    return met.select("__row.*", F.when(F.col("__k") <= piece["high"], piece["value"]).alias(name))

"""Counts that start anew after each alert, without one task a key: look-ahead by buckets, then pointer doubling.

Counting distinct members from any row on reaches the threshold at one place; the next count starts behind it. So each
row points to one later row, and what a machine would do row by row is the path from the key's first row. Where the
pointers lead is worked out bucket by bucket (a bucket's rows, and of what comes after it the first `most` different
members: more can't matter); the path is found by doubling: with pointers of 1, 2, 4, ... steps each round doubles
the part that is known. A key with a third of all rows is many buckets' work, and rounds grow with the logarithm.
"""

from __future__ import annotations

from collections import Counter, deque
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.operators.keyed import run_keyed
from sluice.storage import cut

#: Places of a bucket.
WIDTH = 4096


class NextAlert:
    """For each row of a bucket the place at which counting from it reaches the threshold; rows go in order of place."""

    def __init__(self, most: int):
        self.most, self.window, self.met = most, deque(), Counter()

    def row(self, r: dict[str, Any]) -> list[dict[str, Any]]:
        self.window.append(r)
        self.met[r["member"]] += 1
        out = []
        while len(self.met) >= self.most and self.window[0]["own"]:
            first = self.window.popleft()
            out.append({**{k: v for k, v in first.items() if k not in ("member", "own", "bucket")}, "alert": r["place"]})
            self.met[first["member"]] -= 1
            if not self.met[first["member"]]:
                del self.met[first["member"]]
        return out

    def end(self) -> list[dict[str, Any]]:
        return []


def _first_members(a: Column, b: Column, most: int) -> Column:
    """The first `most` different members of two lists, one after the other."""
    return F.slice(F.concat(a, F.filter(b, lambda x: ~F.exists(a, lambda y: y["member"].eqNullSafe(x["member"])))), 1, most)


def look_ahead(rows: DataFrame, keys: list[str], most: int) -> DataFrame:
    """For each bucket (keys, bucket) the first `most` members, with their places, of the buckets after it."""
    at = [*keys, "bucket"]
    firsts = rows.groupBy(*at, "member").agg(F.min("place").alias("place")).groupBy(*at).agg(F.slice(F.array_sort(F.collect_list(F.struct("place", "member"))), 1, most).alias("ahead"))
    known, span = cut(firsts), 1
    while True:  # each round doubles the buckets that a list covers, as long as a list is short and goes on
        later = known.select(*keys, (F.col("bucket") - span).alias("bucket"), F.col("ahead").alias("later"))
        joined = known.join(later, at, "left")
        if joined.filter((F.size("ahead") < most) & F.col("later").isNotNull()).isEmpty():
            return known.withColumn("bucket", F.col("bucket") - 1)
        known = cut(joined.select(*at, F.when(F.col("later").isNull(), F.col("ahead")).otherwise(_first_members(F.col("ahead"), F.col("later"), most)).alias("ahead")))
        span *= 2


def restarts(rows: DataFrame, keys: list[str], most: int, width: int = WIDTH) -> DataFrame:
    """keys and place of the rows at which counting starts: a key's first, and each behind an alert.

    rows have keys (none null), place (whole, without gaps within a key) and member.
    """
    r = rows.select(*keys, F.col("place").cast("long").alias("place"), "member").withColumn("bucket", F.floor(F.col("place") / width))
    ahead = look_ahead(r, keys, most).select(*keys, "bucket", F.inline("ahead")).select(*keys, "bucket", "place", "member", F.lit(False).alias("own"))
    both = r.withColumn("own", F.lit(True)).unionByName(ahead)
    kind = ", ".join([*(f"{k} {t}" for k, t in r.select(*keys).dtypes), "place long", "alert long"])
    pointers = cut(run_keyed(both, [*keys, "bucket"], ["place"], lambda: NextAlert(most), kind).select(*keys, "place", (F.col("alert") + 1).alias("to")))
    reached = cut(r.groupBy(*keys).agg(F.min("place").alias("place")))
    # only rows that something points to can be on a path
    step = cut(pointers.join(reached.union(pointers.select(*keys, "to")).distinct(), [*keys, "place"], "left_semi"))
    n = reached.count()
    while True:
        more = reached.join(step, [*keys, "place"]).select(*keys, F.col("to").alias("place"))
        reached = cut(reached.union(more).distinct())
        now = reached.count()
        if now == n:
            return reached
        n = now
        farther = step.select(*keys, F.col("place").alias("to"), F.col("to").alias("next"))
        step = cut(step.join(farther, [*keys, "to"]).select(*keys, "place", F.col("next").alias("to")))


def after_gaps(rows: DataFrame, keys: list[str], time: str, idle: int, width: int = WIDTH) -> DataFrame:
    """rows (with place) and `gap`: whether the time is more than `idle` after that of the place before."""
    cut_up = rows.withColumn("__b", F.floor(F.col("place") / width))
    ends = cut_up.groupBy(*keys, "__b").agg(F.max_by(time, "place").alias("__end")).withColumn("__b", F.col("__b") + 1)
    before = F.lag(time).over(Window.partitionBy(*keys, "__b").orderBy("place"))
    met = cut_up.withColumn("__before", before).join(ends, [*keys, "__b"], "left")
    return met.withColumn("gap", F.coalesce(F.col(time) - F.coalesce("__before", "__end") > idle, F.lit(False))).drop("__b", "__before", "__end")

"""Names as trees: counts under every parent, the most used path from the top, and answers that lead on to others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.storage import cut


def levels(names: DataFrame, keys: list[str], name: str, least: int = 1) -> DataFrame:
    """keys, level (1: the last label), domain, parent and n: how many names end in the domain, if at least `least`.

    Names are counted once each before they are taken apart. A domain has no more names than its parent, so pruning by
    count loses no path.
    """
    counted = names.filter(F.col(name).isNotNull()).groupBy(*keys, F.col(name).alias("__name")).agg(F.count("*").alias("__n"))
    labels = counted.withColumn("__labels", F.split("__name", r"\."))
    parts = labels.select(*keys, "__n", "__labels", F.explode(F.sequence(F.lit(1), F.size("__labels"))).alias("level"))

    def last(n: int) -> Column:
        count = F.col("level") - n
        return F.array_join(F.slice("__labels", F.size("__labels") - count + 1, count), ".")

    domain, parent = last(0), F.when(F.col("level") > 1, last(1)).otherwise("")
    counts = parts.groupBy(*keys, "level", domain.alias("domain"), parent.alias("parent")).agg(F.sum("__n").alias("n"))
    return counts.filter(F.col("n") >= least)


def main_path(tree: DataFrame, keys: list[str], most_levels: int = 127) -> DataFrame:
    """keys, level, domain, n and share (parts in a thousand of its parent) of the most used child of each most used parent.

    Ties go to the first name. A step is a join with one row for each key; it ends where no child is left.
    """
    tops = cut(tree.groupBy(*keys, "parent").agg(F.min(F.struct((-F.col("n")).alias("less"), "domain", "level")).alias("top"), F.sum("n").alias("all")))
    tops = tops.select(*keys, "parent", F.col("top.domain").alias("domain"), F.col("top.level").alias("level"), (-F.col("top.less")).alias("n"), "all")
    at = cut(tops.filter("level = 1"))
    path = at
    for _ in range(most_levels):
        at = cut(tops.join(at.select(*keys, F.col("domain").alias("parent")), [*keys, "parent"]))
        if at.isEmpty():
            break
        path = path.union(at.select(*path.columns))
    return path.select(*keys, "level", "domain", "n", F.floor(F.col("n") * 1000 / F.col("all")).cast("long").alias("share"))


def reached(names: DataFrame, answers: DataFrame, most: int = 10) -> DataFrame:
    """start, name and steps: all names that answers lead to from the starting names, in `most` steps at most.

    answers has name and target. Semi-naive: a round joins only what the round before found new, so cycles end.
    """
    edges = cut(answers.select("name", "target").filter("name is not null and target is not null").distinct())
    new = cut(names.select(F.col("name").alias("start"), "name").filter("name is not null").distinct().withColumn("steps", F.lit(0)))
    seen = new
    for step in range(1, most + 1):
        further = new.join(edges, "name").select("start", F.col("target").alias("name")).distinct()
        new = cut(further.join(seen.select("start", "name"), ["start", "name"], "left_anti").withColumn("steps", F.lit(step)))
        if new.isEmpty():
            break
        seen = cut(seen.unionByName(new))
    return seen

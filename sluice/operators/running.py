"""Running sums that survive a hot key: the key's rows are cut into buckets of its order column."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_sum(df: DataFrame, keys: list[str], order: str, value: str, name: str, width: int = 1 << 20) -> DataFrame:
    """df with `name`: the sum of `value` over the key's rows up to this one, by `order` (unique within the key).

    A bucket holds `width` steps of the order column. Bucket totals are partial sums, their prefix sums a window over
    few rows, and each task sorts one bucket only; so a key with a third of all rows is many tasks' work.
    """
    cut = df.withColumn("__bucket", F.floor(F.col(order) / width))
    at = [*keys, "__bucket"]
    totals = cut.groupBy(*at).agg(F.sum(value).alias("__total"))
    before = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("__before", F.coalesce(F.sum("__total").over(before), F.lit(0))).drop("__total")
    within = Window.partitionBy(*at).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return cut.join(offsets, at).withColumn(name, F.col("__before") + F.sum(value).over(within)).drop("__bucket", "__before")

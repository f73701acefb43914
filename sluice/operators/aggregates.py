"""Aggregates of the detectors, each a grouped DataFrame: histograms, shares, moments, roll-ups, merged lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.bits import of_id
from sluice.functions.numbers import div


def histogram(df: DataFrame, keys: list[str], value: str, step: int, below: int | None = None) -> DataFrame:
    """keys, bin (its upper edge) and n; values of `below` or more are left out."""
    kept = df.filter(F.col(value) < below) if below else df
    return kept.groupBy(*keys, (F.floor(F.col(value) / step) * step + step).alias("bin")).agg(F.count("*").alias("n"))


def clipped_histogram(df: DataFrame, keys: list[str], size: str, step: int, bins: int) -> DataFrame:
    """keys, bin (from 0; the last holds all larger sizes) and n."""
    return df.groupBy(*keys, F.least(F.floor(F.col(size) / step), F.lit(bins - 1)).alias("bin")).agg(F.count("*").alias("n"))


def shares(hist: DataFrame, keys: list[str]) -> DataFrame:
    """A histogram with share: n by the sum of its key. The window runs over bins, which are few."""
    return hist.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*keys)))


def top_bins(hist: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The n fullest bins of each key; of equal ones the higher."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("n").desc(), F.col("bin").desc()))
    return hist.withColumn("rank", rank).filter(F.col("rank") <= n)


def weighted_mean(value: str = "bin", weight: str = "n") -> Column:
    """Whole mean of a histogram."""
    return div(F.sum(F.col(value) * F.col(weight)), F.sum(weight))


def moments(value: str) -> list[Column]:
    """n, mean and sample variance from sums."""
    x = F.col(value).cast("double")
    n = F.count(value)
    return [n.alias("n"), F.avg(x).alias("mean"), F.when(n > 1, (F.sum(x * x) - F.sum(x) * F.sum(x) / n) / (n - 1)).alias("variance")]


def upper_median_of_last(df: DataFrame, keys: list[str], order: str, value: str, last: int = 15) -> DataFrame:
    """keys and median: element [n/2] (from 0) of the sorted last values."""
    recent = df.withColumn("__back", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(order).desc()))).filter(F.col("__back") <= last)
    values = F.array_sort(F.collect_list(value))
    return recent.groupBy(*keys).agg(F.element_at(values, (F.floor(F.size(values) / 2) + 1).cast("int")).alias("median"))


def source_buckets(flows: DataFrame, buckets: int = 511) -> DataFrame:
    """dst_net, minute, sources: how many of the buckets src_net % buckets have a flow."""
    minute = F.col("t_last") - F.col("t_last") % 60
    return flows.select("dst_net", minute.alias("minute"), (F.col("src_net") % buckets).alias("bucket")).distinct().groupBy("dst_net", "minute").agg(F.count("*").alias("sources"))


def rolled_up(alerts: DataFrame, keys: list[str], member: str, count: str, width: int = 300) -> DataFrame:
    """Alerts in tumbling windows: keys, start, members (map of member to its sum), ts_first, ts_last."""
    start = F.col("ts_first") - F.col("ts_first") % width
    each = alerts.groupBy(*keys, start.alias("start"), member).agg(F.sum(count).alias("n"), F.min("ts_first").alias("ts_first"), F.max("ts_last").alias("ts_last"))
    members = F.map_from_entries(F.array_sort(F.collect_list(F.struct(member, "n"))))
    return each.groupBy(*keys, "start").agg(members.alias("members"), F.min("ts_first").alias("ts_first"), F.max("ts_last").alias("ts_last"))


def sample_addresses(alerts: DataFrame, keys: list[str], order: str, addresses: str, count: str) -> DataFrame:
    """keys, addresses of the first three alerts and of the last one (from the fourth on), the sum, times.

    Rows are reduced by 64 shares of each key first (the first three and the last of each, by a hash of the order
    column), so a key with very many alerts is many tasks' work.
    """
    one = F.struct(F.col(order).alias("o"), F.col(addresses).alias("a"))
    salt = F.pmod(F.xxhash64(order), F.lit(64)).alias("__salt")
    ranked = alerts.select("*", salt).withColumn("__i", F.row_number().over(Window.partitionBy(*keys, "__salt").orderBy(order)))
    part = ranked.groupBy(*keys, "__salt").agg(F.collect_list(F.when(F.col("__i") <= 3, one)).alias("first"), F.max_by(one, order).alias("last"), F.count("*").alias("rows"), F.sum(count).alias("n"), F.min("ts_first").alias("ts_first"), F.max("ts_last").alias("ts_last"))
    whole = part.groupBy(*keys).agg(F.slice(F.array_sort(F.flatten(F.collect_list("first"))), 1, 3).alias("first"), F.max_by("last", "last.o").alias("last"), F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.min("ts_first").alias("ts_first"), F.max("ts_last").alias("ts_last"))
    shown = F.when(F.col("rows") > 3, F.concat("first", F.array("last"))).otherwise(F.col("first"))
    return whole.select(*keys, F.flatten(F.transform(shown, lambda x: x["a"])).alias("addresses"), "n", "ts_first", "ts_last")


def merged_lists(entries: DataFrame, entity: str) -> DataFrame:
    """entity, bitmap (OR of the bits of list_id, from 1) and ports (list_id:port, sorted)."""
    return entries.groupBy(entity).agg(
        F.bit_or(of_id(F.col("list_id"))).alias("bitmap"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("port").isNotNull(), F.concat_ws(":", "list_id", "port")))), ",").alias("ports"),
    )


def domain_figures(names: DataFrame, key: str, name: str) -> DataFrame:
    """key, inserts, different, once (names that came once) and main_share (share of different names below the parent that has most)."""
    parent = F.regexp_replace(name, r"^[^.]*\.", "")
    each = names.groupBy(key, name).agg(F.count("*").alias("n"))
    by_parent = each.groupBy(key, parent.alias("parent")).agg(F.sum("n").alias("inserts"), F.count("*").alias("different"), F.sum((F.col("n") == 1).cast("long")).alias("once"))
    return by_parent.groupBy(key).agg(F.sum("inserts").alias("inserts"), F.sum("different").alias("different"), F.sum("once").alias("once"), (F.max("different") / F.sum("different")).alias("main_share"))


def prefixes_of(df: DataFrame, key: str, text: str, longest: int) -> DataFrame:
    """key, prefix and n: how many different texts of the key start with each prefix of at most `longest` characters."""
    lengths = F.sequence(F.lit(1), F.least(F.length(text), F.lit(longest)))
    each = df.filter(F.length(text) > 0).select(key, text).distinct()
    return each.select(key, F.explode(F.transform(lengths, lambda n: F.substring(F.col(text), F.lit(1), n))).alias("prefix")).groupBy(key, "prefix").agg(F.count("*").alias("n"))

"""Black lists: building them, matching flows, rolling matches up, feeding evidence back."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions import text
from sluice.functions.bits import ids
from sluice.operators.aggregates import merged_lists
from sluice.operators.keyed import run_keyed
from sluice.operators.lookups import bounded, exact_matches, is_bounded, port_allowed, prefix_matches, with_prefixes
from sluice.operators.running import running_sum

#: Ports above this are ephemeral and aren't told.
LAST_PORT = 49152
ADAPTIVE_ID = 999
IRC = (6660, 6670)


def build(lists: dict[int, DataFrame]) -> DataFrame:
    """One entry for each entity over all lists (columns entity and port): bitmap and ports."""
    every = None
    for number, entries in lists.items():
        part = entries.select("entity", "port", F.lit(number).alias("list_id"))
        every = part if every is None else every.union(part)
    if every is None:
        raise ValueError("no list")
    return merged_lists(every, "entity")


def changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows that only one of two lists has, with change: gone or new."""
    return old.subtract(new).withColumn("change", F.lit("gone")).unionByName(new.subtract(old).withColumn("change", F.lit("new")))


def changed(new: DataFrame, old: DataFrame) -> bool:
    """Whether two lists differ as sets."""
    return not (new.exceptAll(old).isEmpty() and old.exceptAll(new).isEmpty())


def _allowed(port: Column) -> Callable[[Column], Column]:
    return lambda x: port_allowed(x["bitmap"], x["ports"], port)


def match_ips(flows: DataFrame, entries: DataFrame) -> DataFrame:
    """Flows whose source or destination is listed, with src_bitmap and dst_bitmap; DNS traffic is left out.

    Both ends are looked up by themselves, all prefixes that hold an address count, and the bit of a list that names
    ports counts for these ports only.
    """
    kept = flows.filter((F.col("src_port") != 53) & (F.col("dst_port") != 53))
    listed = entries.filter("network is not null").select("network", "prefix", "bitmap", "ports")

    if is_bounded(listed):
        for end in ("src", "dst"):
            found = F.transform("__met", _allowed(F.col(f"{end}_port")))
            kept = with_prefixes(kept, f"{end}_ip", listed, ["bitmap", "ports"], "__met").withColumn(f"{end}_bitmap", F.aggregate(found, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))).drop("__met")
        return kept.filter((F.col("src_bitmap") != 0) | (F.col("dst_bitmap") != 0))

    def of(end: str, other: str) -> DataFrame:
        met = prefix_matches(kept.select("seq", f"{end}_ip", f"{end}_port"), f"{end}_ip", listed)
        bits = port_allowed(F.col("bitmap"), F.col("ports"), F.col(f"{end}_port"))
        return met.groupBy("seq").agg(F.bit_or(bits).alias(f"{end}_bitmap")).filter(F.col(f"{end}_bitmap") != 0)

    hits = of("src", "dst").join(of("dst", "src"), "seq", "full_outer")
    return kept.join(hits, "seq").withColumns({f"{e}_bitmap": F.coalesce(f"{e}_bitmap", F.lit(0).cast("long")) for e in ("src", "dst")})


def match_names(requests: DataFrame, host: str, entries: DataFrame) -> DataFrame:
    """Requests whose host name is listed (columns name and bitmap)."""
    return exact_matches(requests.withColumn("__key", text.host_name(F.col(host))), "__key", entries.select(text.host_name(F.col("name")).alias("name"), "bitmap"), "name").drop("__key")


def match_urls(requests: DataFrame, host: str, path: str, entries: DataFrame) -> DataFrame:
    """Requests whose URL is listed (columns name and bitmap)."""
    listed = entries.select(text.url_key(F.col("name"), F.lit("")).alias("name"), "bitmap")
    return exact_matches(requests.withColumn("__key", text.url_key(F.col(host), F.col(path))), "__key", listed, "name").drop("__key")


def single_bits(matches: DataFrame, column: str = "bitmap") -> DataFrame:
    """A row for each bit, with list_id."""
    return matches.withColumn("list_id", F.explode(ids(F.col(column))))


ROLLUP = ["entity", "protocol", "list_id", "start"]
SUMS = ("flows", "sent_packets", "sent_bytes", "received_packets", "received_bytes")


def _each(matches: DataFrame, width: int) -> DataFrame:
    """A row for each listed end of a match and each of its lists, with the window's start."""
    ends = []
    for end, other in (("src", "dst"), ("dst", "src")):
        ends.append(matches.filter(F.col(f"{end}_bitmap") != 0).select(F.col(f"{end}_ip").alias("entity"), F.col(f"{other}_ip").alias("target"), F.when(F.col(f"{end}_port") <= LAST_PORT, F.col(f"{end}_port")).alias("port"), "protocol", F.col(f"{end}_bitmap").alias("bitmap"), F.lit(end == "src").alias("sends"), "packets", "bytes", "t_first", "t_last"))
    return single_bits(ends[0].union(ends[1])).withColumn("start", F.col("t_first") - F.col("t_first") % width)


def _by_target(each: DataFrame) -> DataFrame:
    """Sums by target: a first aggregation that spreads an entity with many flows."""
    sides = (F.coalesce(F.sum(F.when(F.col("sends") == s, F.col(c))), F.lit(0)).alias(f"{n}_{c}") for s, n in ((True, "sent"), (False, "received")) for c in ("packets", "bytes"))
    return each.groupBy(*ROLLUP, "target").agg(F.collect_set("port").alias("ports"), F.count("*").alias("flows"), *sides, F.min("t_first").alias("ts_first"), F.max("t_last").alias("ts_last"))


def rolled_up(matches: DataFrame, width: int = 300) -> DataFrame:
    """By listed address, protocol, list and window: peers and ports as arrays, flows, packets, bytes of both ways.

    An entity's peers of one window are one row's array; rolled_up_counts() and rolled_up_parts() have no such limit.
    """
    by_target = _by_target(_each(matches, width))
    return by_target.groupBy(*ROLLUP).agg(F.array_sort(F.collect_list("target")).alias("targets"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("ports")))).alias("ports"), *(F.sum(c).cast("long").alias(c) for c in SUMS), F.min("ts_first").alias("ts_first"), F.max("ts_last").alias("ts_last"))


def rolled_up_counts(matches: DataFrame, width: int = 300) -> DataFrame:
    """The same with the numbers of different targets and ports in place of the arrays."""
    each = _each(matches, width)
    ports = each.groupBy(*ROLLUP, "port").agg(F.count("*").alias("n")).groupBy(*ROLLUP).agg(F.count("port").alias("ports"))
    sums = _by_target(each).groupBy(*ROLLUP).agg(F.count("*").alias("targets"), *(F.sum(c).cast("long").alias(c) for c in SUMS), F.min("ts_first").alias("ts_first"), F.max("ts_last").alias("ts_last"))
    return sums.join(ports, ROLLUP)


def rolled_up_parts(matches: DataFrame, most: int = 1000, width: int = 300) -> DataFrame:
    """keys, part (from 0), parts and targets, at most so many a row: targets are numbered by running sums, not in an array."""
    targets = _each(matches, width).select(*ROLLUP, "target").distinct().withColumn("__one", F.lit(1))
    placed = running_sum(targets, ROLLUP, "target", "__one", "__place").withColumn("part", F.floor((F.col("__place") - 1) / most).cast("int"))
    parts = targets.groupBy(*ROLLUP).agg(F.ceil(F.count("*") / most).cast("int").alias("parts"))
    return placed.groupBy(*ROLLUP, "part").agg(F.array_sort(F.collect_list("target")).alias("targets")).join(parts, ROLLUP)


def rolled_up_urls(matches: DataFrame, host: str, path: str, width: int = 300) -> DataFrame:
    """By listed URL, where it was asked for, protocol, list and window: flows, different sources, bytes and times.

    matches are requests with the columns of their flows and a bitmap. Sources are counted by a first aggregation, so
    a URL that very many ask for is many tasks' work.
    """
    url = text.url_key(F.col(host), F.col(path))
    each = single_bits(matches).withColumns({"url": url, "name": text.host_name(F.col(host)), "start": F.col("t_first") - F.col("t_first") % width})
    keys = ["name", "url", "dst_ip", "protocol", "list_id", "start"]
    by_source = each.groupBy(*keys, "src_ip").agg(F.count("*").alias("n"), F.sum("packets").alias("packets"), F.sum("bytes").alias("bytes"), F.min("t_first").alias("a"), F.max("t_last").alias("b"))
    return by_source.groupBy(*keys).agg(F.sum("n").alias("flows"), F.count("*").alias("sources"), F.sum("packets").alias("packets"), F.sum("bytes").alias("bytes"), F.min("a").alias("ts_first"), F.max("b").alias("ts_last"))


class Scenario:
    """Evidence of one botnet controller: clients are added; after `quiet` seconds without one it is told and ends."""

    def __init__(self, quiet: int = 600):
        self.quiet, self.entity, self.members, self.first, self.last = quiet, None, {}, 0, None

    def told(self) -> list[dict[str, Any]]:
        return [{"entity": self.entity, "adaptive": list(self.members), "ts_first": self.first, "ts_last": self.last}] if self.members else []

    def row(self, r: dict[str, Any]) -> list[dict[str, Any]]:
        out = []
        if self.last is not None and r["ts_last"] - self.last > self.quiet:
            out, self.members, self.last = self.told(), {}, None
        if not self.members:
            self.first = r["ts_first"]
        self.entity, self.last = r["entity"], max(self.last or 0, r["ts_last"])
        for t in r["targets"]:
            self.members.setdefault(t)
        return out

    def end(self) -> list[dict[str, Any]]:
        return self.told()


def scenarios(rolled: DataFrame, botnet_lists: list[int], quiet: int = 600) -> DataFrame:
    """Grouped evidence of entities on botnet lists; other events go to the reporter as they are (see reported)."""
    kept = rolled.filter(F.col("list_id").isin(*botnet_lists)).select("entity", "targets", "ts_first", "ts_last")
    return run_keyed(kept, ["entity"], ["ts_last", "ts_first"], lambda: Scenario(quiet), "entity long, adaptive array<long>, ts_first long, ts_last long")


def reported(rolled: DataFrame, botnet_lists: list[int]) -> DataFrame:
    return rolled.filter(~F.col("list_id").isin(*botnet_lists))


def adaptive_list(grouped: DataFrame) -> DataFrame:
    """The list that goes back into matching: every client of a scenario, once, by number."""
    return grouped.select(F.explode("adaptive").alias("number")).distinct().select("number", F.lit(32).alias("prefix"), F.lit(ADAPTIVE_ID).alias("list_id")).sort("number")


def evaluated(evidence: DataFrame, controllers: DataFrame, irc: tuple[int, int] = IRC) -> DataFrame:
    """By adaptive entity: distinct clients that talked to a known controller, to IRC ports, and to other controllers.

    evidence: scenario, entity (client), target, port, controller (the scenario's own).
    """
    known = bounded(controllers.select(F.col("entity").alias("__c")).distinct())
    e = evidence.join(known, evidence["target"] == known["__c"], "left")
    own = F.col("target") == F.col("controller")
    return e.groupBy("scenario").agg(F.count_distinct(F.when(own, F.col("entity"))).alias("own"), F.count_distinct(F.when(F.col("port").between(*irc), F.col("entity"))).alias("irc"), F.count_distinct(F.when(F.col("__c").isNotNull() & ~own, F.col("entity"))).alias("other"))


def merged_evidence(detection: DataFrame, adaptive: DataFrame, identity: str = "id", ids: str = "adaptive_ids") -> DataFrame:
    """detection with each adaptive event whose comma-parted ids name it (columns of adaptive, null without one)."""
    each = adaptive.withColumn("__id", F.explode(F.array_distinct(F.transform(F.split(ids, ","), lambda x: F.trim(x))))).drop(ids)
    return detection.join(each, detection[identity].cast("string") == each["__id"], "left").drop("__id")


def latest(lists: DataFrame, entity: str, at: str, now: int, ttl: int = 86400) -> DataFrame:
    """Entries that still hold: added at 0 (for good) or within ttl seconds."""
    newest = lists.withColumn("__r", F.row_number().over(Window.partitionBy(entity).orderBy(F.when(F.col(at) == 0, 0).otherwise(1), F.col(at).desc()))).filter("__r = 1").drop("__r")
    return newest.filter((F.col(at) == 0) | (F.lit(now) - F.col(at) <= ttl))

"""Cryptominer pools: suspects by (miner, pool, port), a score card, and a decision tree as a parameter."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.numbers import div
from sluice.operators.keyed import run_keyed
from sluice.operators.lookups import in_pool
from sluice.schema import ACK, PSH

THRESHOLD = 9
KEYS = ["src_ip", "dst_ip", "dst_port"]


def candidates(flows: DataFrame, black: DataFrame, white: DataFrame) -> DataFrame:
    """Flows to pools that aren't white-listed from ends that aren't black-listed, with listed (the pool is black-listed)."""
    open_ = in_pool(in_pool(flows, white, "dst_ip", "dst_port", "left_anti"), black, "src_ip", "src_port", "left_anti")
    hit = in_pool(open_, black, "dst_ip", "dst_port").select("seq", F.lit(True).alias("__l"))
    return open_.join(hit, "seq", "left").withColumn("listed", F.coalesce("__l", F.lit(False))).drop("__l")


def suspects(seen: DataFrame) -> DataFrame:
    """Counters of each suspect. A pair is one from its first flow to a listed pool, or of ACK or ACK and PSH alone, on."""
    flags = F.col("tcp_flags")
    opens = F.col("listed") | flags.isin(ACK, ACK | PSH)
    first = seen.filter(opens).groupBy(*KEYS).agg(F.min("seq").alias("__first"))
    return seen.join(first, KEYS).filter(F.col("seq") >= F.col("__first")).groupBy(*KEYS).agg(F.count_if(flags == ACK).alias("ack_flows"), F.count_if(flags == (ACK | PSH)).alias("ackpush_flows"), F.count_if(~flags.isin(ACK, ACK | PSH)).alias("other_flows"), F.count_if(F.col("src_port") > F.col("dst_port")).alias("req_flows"), F.sum("packets").alias("packets"), F.sum("bytes").alias("bytes"), F.min("t_first").alias("first_seen"), F.max("t_last").alias("last_seen"))


def score() -> Column:
    """Points of the score card."""
    flows = F.col("ack_flows") + F.col("ackpush_flows") + F.col("other_flows")
    active = F.col("last_seen") - F.col("first_seen")
    a_packet, a_flow = div(F.col("bytes"), F.col("packets")), div(F.col("packets"), flows)
    a_minute = F.when(active >= 5, div(F.col("packets") * 60, active))
    points = ((div((F.col("ack_flows") + F.col("ackpush_flows")) * 100, flows) >= 80, 2), ((a_packet > 50) & (a_packet < 130), 2), ((a_flow < 10) | (a_flow > 20), 1), (a_minute.between(8, 30), 2), (F.col("req_flows") * 10 > flows * 9, 3), (active >= 300, 3))
    out = F.lit(0)
    for holds, n in points:
        out += F.when(holds, n).otherwise(0)
    return out


def tree_column(tree: dict[str, Any] | int) -> Column:
    """A decision tree as one expression. A node: {"column", "most", "yes", "no"} (yes if column <= most), a leaf: a number."""
    if not isinstance(tree, dict):
        return F.lit(tree)
    return F.when(F.col(tree["column"]) <= tree["most"], tree_column(tree["yes"])).otherwise(tree_column(tree["no"]))


def miners(found: DataFrame, threshold: int = THRESHOLD, tree: dict[str, Any] | int = 1) -> DataFrame:
    """Suspects whose score reaches the threshold and whom the tree (a parameter) takes for miners."""
    return found.withColumn("score", score()).filter((F.col("score") >= threshold) & (tree_column(tree) == 1))


class Suspect:
    """Exports a suspect every `export` seconds and when it has been idle for `inactive` seconds."""

    def __init__(self, inactive: int = 60, export: int = 3600):
        self.inactive, self.export, self.r = inactive, export, None

    def row(self, r: dict[str, Any]) -> list[dict[str, Any]]:
        out = []
        if self.r and (r["t_last"] - self.r["last_seen"] > self.inactive or r["t_last"] - self.r["first_seen"] >= self.export):
            out, self.r = [self.r], None
        if not self.r:
            self.r = {k: r[k] for k in KEYS} | {"flows": 0, "packets": 0, "bytes": 0, "first_seen": r["t_first"], "last_seen": r["t_last"]}
        self.r["flows"] += 1
        self.r["packets"] += r["packets"]
        self.r["bytes"] += r["bytes"]
        self.r["last_seen"] = max(self.r["last_seen"], r["t_last"])
        return out

    def end(self) -> list[dict[str, Any]]:
        return [self.r] if self.r else []


def exports(seen: DataFrame, inactive: int = 60, export: int = 3600) -> DataFrame:
    return run_keyed(seen.select(*KEYS, "packets", "bytes", "t_first", "t_last", "seq"), KEYS, ["t_last", "seq"], lambda: Suspect(inactive, export), "src_ip long, dst_ip long, dst_port int, flows long, packets long, bytes long, first_seen long, last_seen long")

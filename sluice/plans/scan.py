"""Vertical scans (many ports of one host) and horizontal scans (one port of many hosts)."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.operators.filters import both_ipv4, single_syn, syn_probe
from sluice.operators.keyed import run_keyed
from sluice.operators.resets import WIDTH, after_gaps, restarts
from sluice.operators.running import running_sum
from sluice.storage import cut

PORTS, ADDRESSES, IDLE = 50, 50, 300
VERTICAL = "src_ip long, dst_ip long, port_cnt int, seq long, ts_first long, ts_last long"
HORIZONTAL = "src_ip long, dst_port int, addr_cnt int, seq long, samples array<long>, ts_first long, ts_last long, trailing boolean"


def probes(flows: DataFrame, packets: int = 4) -> DataFrame:
    return flows.filter(both_ipv4(F.col("src_ip"), F.col("dst_ip")) & syn_probe(packets))


def vertical_first(flows: DataFrame, ports: int = PORTS) -> DataFrame:
    """The first alert of each pair of hosts: a port counts while it has been met an odd number of times."""
    p = probes(flows).select("src_ip", "dst_ip", "src_port", "dst_port", "seq", "t_last")
    turns = running_sum(p.withColumn("one", F.lit(1)), ["src_ip", "dst_ip", "dst_port"], "seq", "one", "turn")
    steps = turns.withColumn("step", F.when(F.col("turn") % 2 == 1, 1).otherwise(-1))
    counted = running_sum(steps, ["src_ip", "dst_ip"], "seq", "step", "open_ports")
    hit = counted.filter(F.col("open_ports") >= ports).groupBy("src_ip", "dst_ip").agg(F.min(F.struct("seq", "open_ports", "src_port", "dst_port", "t_last")).alias("a"))
    return hit.select("src_ip", "dst_ip", F.col("a.seq").alias("seq"), F.col("a.open_ports").cast("long").alias("port_cnt"), F.col("a.src_port").alias("src_port"), F.col("a.dst_port").alias("dst_port"), F.col("a.t_last").alias("ts_last"))


def horizontal_first(flows: DataFrame, addresses: int = ADDRESSES) -> DataFrame:
    """The first alert of each source and port: different destinations reach the threshold.

    Only a destination's first flow can raise the count, so rows become one for each destination before anything is
    ordered.
    """
    kept = flows.filter(both_ipv4(F.col("src_ip"), F.col("dst_ip")) & single_syn())
    firsts = kept.groupBy("src_ip", "dst_port", "dst_ip").agg(F.min(F.struct("seq", "t_last")).alias("f"))
    steps = firsts.select("src_ip", "dst_port", "dst_ip", "f.*", F.lit(1).alias("step"))
    counted = running_sum(steps, ["src_ip", "dst_port"], "seq", "step", "addresses")
    hit = counted.filter(F.col("addresses") >= addresses).groupBy("src_ip", "dst_port").agg(F.min(F.struct("seq", "addresses", "dst_ip", "t_last")).alias("a"))
    return hit.select("src_ip", "dst_port", F.col("a.seq").alias("seq"), F.col("a.addresses").cast("long").alias("addr_cnt"), F.col("a.dst_ip").alias("dst_ip"), F.col("a.t_last").alias("ts_last"))


class Vertical:
    """All alerts of a pair of hosts: ports toggle, an alert or an idle gap starts anew."""

    def __init__(self, ports: int = PORTS, idle: int = IDLE):
        self.ports, self.idle, self.open, self.first, self.last = ports, idle, set(), 0, None

    def row(self, r: dict[str, Any]) -> list[dict[str, Any]]:
        if self.last is not None and r["t_last"] - self.last > self.idle:
            self.open = set()
        if not self.open:
            self.first, self.last = r["t_first"], r["t_last"]
        self.first, self.last = min(self.first, r["t_first"]), max(self.last, r["t_last"])
        self.open ^= {r["dst_port"]}
        if len(self.open) < self.ports:
            return []
        out = {"src_ip": r["src_ip"], "dst_ip": r["dst_ip"], "port_cnt": len(self.open), "seq": r["seq"], "ts_first": self.first, "ts_last": self.last}
        self.open = set()
        return [out]

    def end(self) -> list[dict[str, Any]]:
        return []


class Horizontal:
    """All alerts of a source and port: the set is cleared by an alert; what follows it is told after an idle gap."""

    def __init__(self, addresses: int = ADDRESSES, idle: int = IDLE):
        self.addresses, self.idle, self.met, self.alerted, self.first, self.last, self.seen = addresses, idle, {}, False, 0, None, None

    def told(self, trailing: bool) -> dict[str, Any]:
        r = self.seen
        return {"src_ip": r["src_ip"], "dst_port": r["dst_port"], "addr_cnt": len(self.met), "seq": r["seq"], "samples": list(self.met)[:4], "ts_first": self.first, "ts_last": self.last, "trailing": trailing}

    def row(self, r: dict[str, Any]) -> list[dict[str, Any]]:
        out = []
        if self.last is not None and r["t_last"] - self.last > self.idle:
            if self.alerted and self.met:
                out.append(self.told(True))
            self.met, self.alerted = {}, False
        if not self.met:
            self.first, self.last = r["t_first"], r["t_last"]
        self.first, self.last, self.seen = min(self.first, r["t_first"]), max(self.last, r["t_last"]), r
        self.met.setdefault(r["dst_ip"])
        if len(self.met) >= self.addresses:
            out.append(self.told(False))
            self.met, self.alerted = {}, True
        return out

    def end(self) -> list[dict[str, Any]]:
        return []


def vertical_all(flows: DataFrame, ports: int = PORTS, idle: int = IDLE) -> DataFrame:
    return run_keyed(probes(flows).select("src_ip", "dst_ip", "dst_port", "seq", "t_first", "t_last"), ["src_ip", "dst_ip"], ["seq"], lambda: Vertical(ports, idle), VERTICAL)


def horizontal_all(flows: DataFrame, addresses: int = ADDRESSES, idle: int = IDLE) -> DataFrame:
    kept = flows.filter(both_ipv4(F.col("src_ip"), F.col("dst_ip")) & single_syn()).select("src_ip", "dst_port", "dst_ip", "seq", "t_first", "t_last")
    return run_keyed(kept, ["src_ip", "dst_port"], ["seq"], lambda: Horizontal(addresses, idle), HORIZONTAL)


def horizontal_spread(flows: DataFrame, addresses: int = ADDRESSES, idle: int = IDLE, width: int = WIDTH) -> DataFrame:
    """As horizontal_all(), with the rows of one source and port spread over tasks.

    For flows whose ends don't go back within a source and port by seq: gaps then don't depend on where counting began,
    and cut each key's rows into sessions.
    """
    key = ["src_ip", "dst_port"]
    kept = flows.filter(both_ipv4(F.col("src_ip"), F.col("dst_ip")) & single_syn()).select(*key, "dst_ip", "seq", "t_first", "t_last")
    placed = cut(running_sum(kept.withColumn("one", F.lit(1)), key, "seq", "one", "place").drop("one"))
    gaps = after_gaps(placed, key, "t_last", idle, width).withColumn("gap", F.col("gap").cast("int"))
    rows = cut(running_sum(gaps, key, "place", "gap", "session", width).drop("gap"))
    started = restarts(rows.withColumnRenamed("dst_ip", "member"), [*key, "session"], addresses, width).withColumn("start", F.lit(1))
    parted = rows.join(started, [*key, "session", "place"], "left").withColumn("start", F.coalesce("start", F.lit(0)))
    parted = running_sum(parted, key, "place", "start", "part", width)
    by = [*key, "session", "part"]
    members = parted.groupBy(*by, "dst_ip").agg(F.min("place").alias("place"), F.min("t_first").alias("ts_first"), F.max("t_last").alias("ts_last"), F.max(F.struct("place", "seq")).alias("end"))
    # a part has `addresses` members at most
    parts = members.groupBy(*by).agg(F.count("*").alias("n"), F.slice(F.array_sort(F.collect_list(F.struct("place", "dst_ip"))), 1, 4).alias("met"), F.min("ts_first").alias("ts_first"), F.max("ts_last").alias("ts_last"), F.max("end").alias("end"))
    parts = cut(parts)
    last = parts.groupBy(*key).agg(F.max("session").alias("last"))
    first = parts.groupBy(*key, "session").agg(F.min("part").alias("first"))
    told = parts.join(last, key).join(first, [*key, "session"]).withColumn("trailing", F.col("n") < addresses)
    told = told.filter(~F.col("trailing") | ((F.col("part") > F.col("first")) & (F.col("session") < F.col("last"))))
    return told.select(*key, F.col("n").cast("int").alias("addr_cnt"), "end.seq", F.transform("met", lambda x: x["dst_ip"]).alias("samples"), "ts_first", "ts_last", "trailing")


def sessions(flows: DataFrame, keys: list[str], idle: int = IDLE) -> DataFrame:
    """keys, session (from 0), flows, ts_first and ts_last, cut by gaps of more than `idle` seconds between ends.

    Spark's session windows merge rows into sessions before anything is numbered, so only sessions are sorted by key.
    """
    window = F.session_window(F.timestamp_seconds("t_last"), f"{idle + 1} seconds")  # a gap of whole seconds ends one
    found = flows.groupBy(*keys, window.alias("__session")).agg(F.count("*").alias("flows"), F.min("t_first").alias("ts_first"), F.max("t_last").alias("ts_last"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("__session.start"))
    return found.withColumn("session", (place - 1).cast("long")).select(*keys, "session", "flows", "ts_first", "ts_last")

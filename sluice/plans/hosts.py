"""Per-host statistics in windows, and rules over them."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any, Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.bits import has_all, saturated
from sluice.operators.filters import portless_udp
from sluice.operators.keyed import run_keyed
from sluice.operators.projections import REQUEST, RESPONSE, direction, roles
from sluice.schema import ACK, FIN, PSH, RST, SYN, URG

WIDTH = 300
#: Counters of 16 bits; all others have 32.
NARROW = {f"{way}_{kind}_{what}" for way in ("in", "out") for kind, what in (("all", "rst"), ("req", "rst"), ("all", "psh"), ("req", "psh"), ("all", "fin"), ("all", "urg"), ("req", "ips"), ("all", "ips"))}


class Subprofile(Protocol):
    """A service's own counters and rules, beside the general ones."""

    name: str

    def counters(self) -> list[Column]: ...

    def rules(self) -> list[Column]: ...


def _counter(name: str, value: Column) -> Column:
    return saturated(F.coalesce(value, F.lit(0)), 16 if name in NARROW else 32).cast("long").alias(name)


def _general() -> list[Column]:
    out = []
    for way, mine in (("in", ~F.col("outgoing")), ("out", F.col("outgoing"))):
        kinds = {"all": mine, "req": mine & (F.col("direction") == REQUEST), "rsp": mine & (F.col("direction") == RESPONSE)}
        for kind, holds in kinds.items():
            out.append(_counter(f"{way}_{kind}_flows", F.count_if(holds)))
            out += [_counter(f"{way}_{kind}_{c}", F.sum(F.when(holds, F.col(c)))) for c in ("packets", "bytes")]
            flags = {"all": {"syn": SYN, "ack": ACK, "rst": RST, "psh": PSH, "fin": FIN, "urg": URG}, "req": {"syn": SYN, "ack": ACK, "rst": RST, "psh": PSH}, "rsp": {"syn": SYN, "ack": ACK}}[kind]
            out += [_counter(f"{way}_{kind}_{n}", F.count_if(holds & has_all(F.col("tcp_flags"), f))) for n, f in flags.items()]
        out.append(_counter(f"{way}_all_syn_packets", F.sum(F.when(mine & has_all(F.col("tcp_flags"), SYN), F.col("packets")))))
        # duplicates of a peer fall away in a first aggregation by peer (see profiles), so these are plain sums
    return out


@dataclass(frozen=True)
class Ssh:
    name: str = "ssh"

    def counters(self) -> list[Column]:
        ssh = (F.col("protocol") == 6) & ((F.col("dst_port") == 22) | (F.col("src_port") == 22))
        out = []
        for way, mine in (("in", ~F.col("outgoing")), ("out", F.col("outgoing"))):
            for kind, value in (("req", REQUEST), ("rsp", RESPONSE)):
                holds = ssh & mine & (F.col("direction") == value)
                out += [saturated(F.coalesce(F.sum(F.when(holds, F.col("packets"))), F.lit(0)), 16).alias(f"ssh_{way}_{kind}_packets"), saturated(F.count_if(holds & has_all(F.col("tcp_flags"), SYN)), 16).alias(f"ssh_{way}_{kind}_syn")]
        return out

    def rules(self) -> list[Column]:
        c = F.col
        victim = (
            (c("ssh_out_rsp_packets") >= 10 * c("ssh_out_rsp_syn")) & (c("ssh_out_rsp_packets") <= 25 * c("ssh_out_rsp_syn")) & (c("ssh_out_rsp_syn") > 30)
            & (c("ssh_in_req_packets") >= 5 * c("ssh_in_req_syn")) & (c("ssh_in_req_packets") <= 20 * c("ssh_in_req_syn")) & (c("ssh_in_req_syn") > 60)
            & (c("ssh_in_req_syn") > 3 * c("ssh_out_req_syn")) & (c("ssh_out_rsp_syn") > 20 * c("out_all_ips"))
        )
        attacker = (
            (c("ssh_out_req_packets") > 5 * c("ssh_out_req_syn")) & (c("ssh_out_req_packets") < 20 * c("ssh_out_req_syn")) & (c("ssh_out_req_syn") > 60)
            & (c("ssh_in_rsp_packets") > 10 * c("ssh_in_rsp_syn")) & (c("ssh_in_rsp_packets") < 25 * c("ssh_in_rsp_syn")) & (c("ssh_in_rsp_syn") > 30)
            & (c("ssh_in_req_syn") < 3 * c("ssh_out_req_syn"))
            & F.when(c("out_all_ips") < 5, c("ssh_out_req_syn") > 20 * c("out_all_ips")).otherwise(c("ssh_out_req_syn") > 10 * c("out_all_ips"))
        )
        return [_event(victim, "bruteforce", "victim", c("ssh_in_req_syn")), _event(attacker, "bruteforce", "attacker", c("ssh_out_req_syn"))]


@dataclass(frozen=True)
class Dns:
    name: str = "dns"
    threshold: int = 10000

    def counters(self) -> list[Column]:
        over = (F.col("src_port") == 53) & (F.col("direction") == RESPONSE) & (F.col("bytes") >= 1000 * F.col("packets"))
        return [F.count_if(over & F.col("outgoing")).alias("dns_out_over"), F.count_if(over & ~F.col("outgoing")).alias("dns_in_over")]

    def rules(self) -> list[Column]:
        return [_event(F.col("dns_out_over") > self.threshold, "dns_amplification", "misused server", F.col("dns_out_over")), _event(F.col("dns_in_over") > self.threshold, "dns_amplification", "victim", F.col("dns_in_over"))]


SUBPROFILES: tuple[Subprofile, ...] = (Ssh(), Dns())


def profiles(flows: DataFrame, width: int = WIDTH, subprofiles: tuple[Subprofile, ...] = SUBPROFILES) -> DataFrame:
    """host, start and all counters. Peers are counted exactly.

    Rows are summed by (host, start, peer) first: a host with a third of all flows is summed in many places, and the
    number of peers becomes a plain count.
    """
    d = flows.filter(~portless_udp()).withColumn("direction", direction(F.col("src_port"), F.col("dst_port")))
    ends = roles(d).withColumn("start", F.col("t_last") - F.col("t_last") % width)
    out_general = _general() + [x for s in subprofiles for x in s.counters()]
    by_peer = ends.groupBy("host", "start", "peer").agg(
        *out_general, F.max((~F.col("outgoing")).cast("int")).alias("p_in_all"), F.max((~F.col("outgoing") & (F.col("direction") == REQUEST)).cast("int")).alias("p_in_req"), F.max(F.col("outgoing").cast("int")).alias("p_out_all"), F.max((F.col("outgoing") & (F.col("direction") == REQUEST)).cast("int")).alias("p_out_req"), F.min("t_first").alias("ts_first"), F.max("t_last").alias("ts_last")
    )
    names = [c for c in by_peer.columns if c not in ("host", "start", "peer", "ts_first", "ts_last") and not c.startswith("p_")]
    width_of = {c: 16 if c in NARROW or c.startswith("ssh_") else 32 for c in names}
    return by_peer.groupBy("host", "start").agg(*(saturated(F.sum(c), width_of[c]).cast("long").alias(c) for c in names), *(saturated(F.sum(f"p_{k}"), 16).cast("long").alias(f"{k}_ips") for k in ("in_all", "in_req", "out_all", "out_req")), F.min("ts_first").alias("ts_first"), F.max("ts_last").alias("ts_last"))


def estimate(way: str, kind: str, what: str, share: float) -> Column:
    """A counter plus the given share of what has no direction, cut to a whole number."""
    req, rsp, every = (F.col(f"{way}_{k}_{what}") for k in ("req", "rsp", "all"))
    return ((req if kind == "req" else rsp) + (every - req - rsp) * share).cast("long")


def _event(holds: Column, kind: str, note: str, scale: Column) -> Column:
    return F.when(F.coalesce(holds, F.lit(False)), F.struct(F.lit(kind).alias("event"), F.lit(note).alias("note"), scale.cast("long").alias("scale")))


def general_rules(scan: int = 200, scan_ips: int = 200, syn_flood: int = 270_000, others: int = 1_000_000, syn_to_ack: float = 20, request_to_response: float = 5, most_packets: float = 2) -> list[Column]:
    c = F.col
    syn_out, ack_out, syn_back = estimate("out", "req", "syn", 0.8), estimate("out", "req", "ack", 0.8), estimate("in", "rsp", "syn", 0.2)
    scanning = (syn_out > scan) & (syn_out > syn_to_ack * ack_out) & (syn_out > request_to_response * syn_back) & (c("out_req_ips") >= scan_ips) & (c("out_req_syn") > (c("out_all_flows") / 3).cast("long")) & (c("out_all_syn") >= c("out_all_ack"))

    def dos(way: str, back: str, packets_ratio: float = most_packets, size: int = 100, answers: float = 0.8) -> Column:
        flows, packets, size_of = (estimate(way, "req", x, 0.8) for x in ("flows", "packets", "bytes"))
        tcp = (c(f"{way}_all_syn") > syn_flood) & (c(f"{way}_all_packets") < packets_ratio * c(f"{way}_all_flows")) & (c(f"{way}_all_syn") > 2 * c(f"{way}_all_ack"))
        other = (flows > others) & (packets < packets_ratio * flows)
        return (tcp | other) & (estimate(back, "rsp", "flows", 0.2) < answers * flows) & F.when(packets > 0, size_of / packets < size).otherwise(False)

    spoofed = F.when(c("in_all_flows") < 2 * c("in_all_ips"), "victim, probably spoofed").otherwise("victim")
    victim = F.when(dos("in", "out"), F.struct(F.lit("dos").alias("event"), spoofed.alias("note"), c("in_all_flows").alias("scale")))
    return [_event(scanning, "horizontal_scan", "horizontal SYN scan", c("out_all_syn") - c("out_all_ack")), victim, _event(dos("out", "in"), "dos", "attacker", c("out_all_flows"))]


def events(stats: DataFrame, rules: list[Column] | None = None) -> DataFrame:
    """host, start, event, note, scale, ts_first, ts_last of every rule that holds."""
    rules = rules if rules is not None else general_rules() + [r for s in SUBPROFILES for r in s.rules()]
    return stats.select("host", "start", "ts_first", "ts_last", F.explode(F.array_compact(F.array(*rules))).alias("e")).select("host", "start", "e.*", "ts_first", "ts_last")


class Timeouts:
    """Records of a host that end after `active` seconds or `inactive` seconds without a flow."""

    def __init__(self, active: int = 300, inactive: int = 30):
        self.active, self.inactive, self.r = active, inactive, None

    def row(self, r: dict[str, Any]) -> list[dict[str, Any]]:
        out = []
        if self.r and (r["t_last"] - self.r["ts_first"] >= self.active or r["t_last"] - self.r["ts_last"] >= self.inactive):
            out, self.r = [self.r], None
        if not self.r:
            self.r = {"host": r["host"], "flows": 0, "packets": 0, "bytes": 0, "ts_first": r["t_last"], "ts_last": r["t_last"]}
        for k in ("packets", "bytes"):
            self.r[k] += r[k]
        self.r["flows"] += 1
        self.r["ts_last"] = max(self.r["ts_last"], r["t_last"])
        return out

    def end(self) -> list[dict[str, Any]]:
        return [self.r] if self.r else []


def records(flows: DataFrame, active: int = 300, inactive: int = 30) -> DataFrame:
    return run_keyed(roles(flows).select("host", "t_last", "seq", "packets", "bytes"), ["host"], ["t_last", "seq"], lambda: Timeouts(active, inactive), "host long, flows long, packets long, bytes long, ts_first long, ts_last long")


def daily_log(found: DataFrame) -> DataFrame:
    """day and one line of text an event, its fields parted by semicolons."""
    at = F.timestamp_seconds("ts_first")
    return found.select(F.date_format(at, "yyyy-MM-dd").alias("day"), F.concat_ws(";", F.date_format(at, "yyyy-MM-dd HH:mm:ss"), F.date_format(F.timestamp_seconds("ts_last"), "yyyy-MM-dd HH:mm:ss"), "event", "host", "scale", "note").alias("line"))


def peer_halves(flows: DataFrame, peer: str | Column = "dst_ip", half: int = WIDTH // 2, precision: int = 12) -> DataFrame:
    """host, half (its start) and a sketch of the host's peers in it; a sketch has one size however many peers there are."""
    at = F.col("t_last") - F.col("t_last") % half
    return flows.groupBy(F.col("src_ip").alias("host"), at.alias("half")).agg(F.hll_sketch_agg(peer, precision).alias("peers"))


def peers(halves: DataFrame, half: int = WIDTH // 2) -> DataFrame:
    """host, start and about how many peers it had in the half window from start and the next; only sketches are shuffled."""
    each = halves.select("host", F.explode(F.array(F.col("half") - half, F.col("half"))).alias("start"), "peers")
    return each.groupBy("host", "start").agg(F.hll_sketch_estimate(F.hll_union_agg("peers")).alias("peers"))

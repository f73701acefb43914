"""Amplification: large answers of a server to a client that asked little."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.numbers import div
from sluice.operators.keyed import run_keyed
from sluice.operators.projections import by_service

BYTES_MAX = 5000


@dataclass(frozen=True)
class Limits:
    """The detector's defaults."""

    port: int = 53
    top: int = 5
    step: int = 2
    ratio: int = 10
    flows: int = 300
    share: float = 0.9
    rsp_packets: int = 2
    rsp_bytes: int = 2000
    query_bytes: int = 400
    window: int = 900
    slide: int = 600
    big_query_packets: int = 1000
    big_rsp_bytes: int = 100000


def pairs(flows: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Flows of the service in every window that holds them: server, client, start, is_query, packets, bytes."""
    w = F.window(F.timestamp_seconds("t_last"), f"{limits.window} seconds", f"{limits.slide} seconds")
    return by_service(flows, limits.port).select("server", "client", w["start"].cast("long").alias("start"), "is_query", "packets", "bytes", "t_first", "t_last")


def totals(flows: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Sums and maxima of each (server, client, start); no join of queries and answers is needed."""
    q = F.col("is_query")

    def both(name: str, column: str, f) -> list:
        return [f(F.when(q, F.col(column))).alias(f"q_{name}"), f(F.when(~q, F.col(column))).alias(f"r_{name}")]

    keys = ["server", "client", "start"]
    return pairs(flows, limits).groupBy(*keys).agg(
        F.count_if(q).alias("q_flows"), F.count_if(~q).alias("r_flows"), *both("packets", "packets", lambda x: F.coalesce(F.sum(x), F.lit(0))), *both("bytes", "bytes", lambda x: F.coalesce(F.sum(x), F.lit(0))), *both("max_packets", "packets", F.max), *both("max_bytes", "bytes", F.max), F.min("t_first").alias("ts_first"), F.max("t_last").alias("ts_last")
    )


#: Histograms that judge a pair: a name, whether of queries, and the column.
HISTOGRAMS = (("rb", False, "bytes"), ("rp", False, "packets"), ("qb", True, "bytes"))


def binned(flows: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """keys, kind ('all', or a name of HISTOGRAMS), bin and sums of the flows in it: one reading of the flows for all kinds.

    A flow counts for the whole and for the histograms of its way; tasks sum up what they have before it is shuffled.
    """
    keys = ["server", "client", "start"]
    edges = {c: F.floor(F.col(c) / limits.step) * limits.step + limits.step for c in ("bytes", "packets")}
    flow = F.struct(
        F.lit(1).cast("long").alias("n"), *(F.when(F.col("is_query") == way, x).alias(f"{tag}_{name}") for tag, way in (("q", True), ("r", False)) for name, x in (("flows", F.lit(1).cast("long")), ("packets", F.col("packets")), ("bytes", F.col("bytes")))), "t_first", "t_last",
        F.when(F.col("is_query"), F.col("packets")).alias("q_max_packets"), F.when(F.col("is_query"), F.col("bytes")).alias("q_max_bytes"), F.when(~F.col("is_query"), F.col("bytes")).alias("r_max_bytes"),
    )
    of = [F.when((F.col("is_query") == way) & ((F.col(c) < BYTES_MAX) if c == "bytes" else F.lit(True)), F.struct(F.lit(name).alias("kind"), edges[c].alias("bin"))) for name, way, c in HISTOGRAMS]
    each = pairs(flows, limits).select(*keys, flow.alias("f"), F.explode(F.array_compact(F.array(F.struct(F.lit("all").alias("kind"), F.lit(0).cast("long").alias("bin")), *of))).alias("at"))
    sums = [F.sum(f"f.{c}").alias(c) for c in ("n", "q_flows", "q_packets", "q_bytes", "r_flows", "r_packets", "r_bytes")]
    return each.groupBy(*keys, "at.kind", "at.bin").agg(*sums, *(F.max(f"f.{c}").alias(c) for c in ("q_max_packets", "q_max_bytes", "r_max_bytes")), F.min("f.t_first").alias("ts_first"), F.max("f.t_last").alias("ts_last"))


def judgements(flows: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """keys, the sums of both ways, and of each histogram the top bins' mean edge, flows and share of all flows."""
    keys = ["server", "client", "start"]
    own = Window.partitionBy(*keys, "kind")
    ranked = binned(flows, limits).withColumn("every", F.sum("n").over(own)).withColumn("rank", F.row_number().over(own.orderBy(F.desc("n"), F.desc("bin")))).filter(F.col("rank") <= limits.top)
    whole = F.col("kind") == "all"
    out = [F.coalesce(F.max(F.when(whole, F.col(c))), F.lit(0).cast("long")).alias(c) for c in ("q_flows", "q_packets", "q_bytes", "r_flows", "r_packets", "r_bytes")]
    out += [F.max(F.when(whole, F.col(c))).alias(c) for c in ("q_max_packets", "q_max_bytes", "r_max_bytes", "ts_first", "ts_last")]
    for tag, _, _ in HISTOGRAMS:
        n, edge = (F.when(F.col("kind") == tag, F.col(c)) for c in ("n", "bin"))
        out += [div(F.sum(edge), F.count(edge)).alias(f"{tag}_mean_bin"), div(F.sum(edge * n), F.sum(n)).alias(f"{tag}_mean"), F.sum(n).alias(f"{tag}_n"), F.sum(F.when(F.col("kind") == tag, F.col("n") / F.col("every"))).alias(f"{tag}_share")]
    return ranked.groupBy(*keys).agg(*out)


def amplified(flows: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """server, client, start, kind (big or complex), flows, packets and bytes of both ways."""
    keys = ["server", "client", "start"]
    t = judgements(flows, limits).filter((F.col("q_flows") > 0) & (F.col("r_flows") > 0) & F.col("rb_n").isNotNull() & F.col("rp_n").isNotNull() & F.col("qb_n").isNotNull())
    heavy = (F.col("q_packets") >= 30) & (div(F.col("r_packets"), F.col("q_packets")) >= 5)
    big = heavy & ((F.col("q_max_packets") > limits.big_query_packets) | (F.col("r_max_bytes") > limits.big_rsp_bytes)) & (div(F.col("r_max_bytes"), F.col("q_max_bytes")) > limits.ratio)
    complex_ = ~heavy & (F.col("rb_share") > limits.share) & (F.col("rb_n") > limits.flows) & (F.col("rp_mean") > limits.rsp_packets) & (F.col("rb_mean") > limits.rsp_bytes) & (F.col("qb_mean") < limits.query_bytes) & (div(F.col("rb_mean_bin"), F.col("qb_mean_bin")) > limits.ratio)
    kind = F.when(big, "big").when(complex_, "complex")
    return t.withColumn("kind", kind).filter(F.col("kind").isNotNull()).select(*keys, "kind", "q_flows", "q_packets", "q_bytes", "r_flows", "r_packets", "r_bytes", "ts_first", "ts_last")


def flow_log(flows: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Queries and answers of each pair in one order of time."""
    return by_service(flows, limits.port).select("server", "client", F.when(F.col("is_query"), "Q").otherwise("R").alias("way"), "t_first", "t_last", "packets", "bytes", "seq").sort("server", "client", "t_last", "seq")


class History:
    """The flows of one pair over the last window; when it is longer than that it is judged and its oldest part goes.

    A flow stands at its beginning. Flows of the same second, bytes and packets are held as one with a count, so a
    flood of like flows doesn't grow the state. A report tells what came since the last judgement.
    """

    def __init__(self, limits: Limits = Limits()):
        self.limits, self.first, self.steps = limits, None, {}
        self.told = {True: Counter(), False: Counter()}

    def row(self, r: dict[str, Any]) -> list[dict[str, Any]]:
        limits, now = self.limits, r["t_last"]
        self.first = r["t_first"] if self.first is None else self.first
        way = self.steps.setdefault(r["t_first"], {True: Counter(), False: Counter()})[r["is_query"]]
        way[r["bytes"], r["packets"]] += 1
        if now - self.first <= limits.window:
            return []
        out = self.judge(r)
        self.steps = {t: v for t, v in self.steps.items() if now - t <= limits.window - limits.slide}
        self.first = min(r["t_first"], *self.steps) if self.steps else None
        self.told = {w: sum((v[w] for v in self.steps.values()), Counter()) for w in (True, False)}
        return out

    def judge(self, r: dict[str, Any]) -> list[dict[str, Any]]:
        limits = self.limits
        both = {w: sum((s[w] for s in self.steps.values()), Counter()) for w in (True, False)}
        if not both[True] or not both[False]:
            return []

        def total(way: bool, i: int, of: dict[bool, Counter[tuple[int, int]]] = both) -> int:
            return sum(k[i] * n for k, n in of[way].items())

        def fresh(way: bool, i: int) -> int:
            return total(way, i) - total(way, i, self.told)

        def top(way: bool, i: int) -> tuple[float, int, int, int]:
            """Share and flows of the fullest bins, their mean edge, and the mean by flows."""
            bins: Counter[int] = Counter()
            for k, n in both[way].items():
                if i or k[0] < BYTES_MAX:
                    bins[k[i] // limits.step * limits.step + limits.step] += n
            best = sorted(bins.items(), key=lambda x: (-x[1], -x[0]))[: limits.top]
            n = sum(v for _, v in best)
            return (n / sum(bins.values()), n, sum(k for k, _ in best) // len(best), sum(k * v for k, v in best) // n) if best else (0.0, 0, 0, 0)

        kind = None
        if total(True, 1) >= 30 and total(False, 1) // total(True, 1) >= 5:
            largest = {w: max(k[0] for k in both[w]) for w in both}
            if (max(k[1] for k in both[True]) > limits.big_query_packets or largest[False] > limits.big_rsp_bytes) and largest[False] // max(1, largest[True]) > limits.ratio:
                kind = "big"
        else:
            rb, rp, qb = top(False, 0), top(False, 1), top(True, 0)
            if rb[0] > limits.share and rb[1] > limits.flows and rp[3] > limits.rsp_packets and rb[3] > limits.rsp_bytes and qb[3] < limits.query_bytes and qb[2] and rb[2] // qb[2] > limits.ratio:
                kind = "complex"
        flows = {w: both[w].total() - self.told[w].total() for w in both}
        figures = {"q_flows": flows[True], "q_packets": fresh(True, 1), "q_bytes": fresh(True, 0), "r_flows": flows[False], "r_packets": fresh(False, 1), "r_bytes": fresh(False, 0)}
        return [{"server": r["server"], "client": r["client"], "kind": kind, **figures, "ts_first": self.first, "ts_last": r["t_last"]}] if kind else []

    def end(self) -> list[dict[str, Any]]:
        return []


def sliding(flows: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Alerts of the sliding history of each pair, flow by flow, with what came since the pair's last judgement."""
    kept = by_service(flows, limits.port).select("server", "client", "is_query", "packets", "bytes", "t_first", "t_last", "seq")
    schema = "server long, client long, kind string, q_flows long, q_packets long, q_bytes long, r_flows long, r_packets long, r_bytes long, ts_first long, ts_last long"
    return run_keyed(kept, ["server", "client"], ["t_last", "seq", "is_query"], lambda: History(limits), schema)

"""Volumetric floods: bytes and source buckets of each destination on a grid of minutes, against their mean so far."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.numbers import div
from sluice.operators.aggregates import source_buckets
from sluice.operators.keyed import run_keyed
from sluice.operators.projections import networks

SLOTS, RATE, SOURCE_RATE, LEAST_BYTES = 7, 4, 4, 7_500_000
FLOOD = "dst_net long, started long, reported long, bytes long, ended boolean"


def attributed(flows: DataFrame) -> DataFrame:
    """dst_net, minute and the bytes of each flow's share in it: each minute gets bytes by its seconds of the flow.

    Whole division, except that the last minute gets what is left, so nothing is lost. Flows that end before they
    start are left out.
    """
    good = flows.filter(F.col("t_last") >= F.col("t_first"))
    first, last = F.col("t_first"), F.col("t_last")
    minutes = F.explode(F.sequence(first - first % 60, last - last % 60, F.lit(60)))
    each = good.select("dst_net", "bytes", "t_first", "t_last", minutes.alias("minute"))

    def until(edge: Column) -> Column:
        """Bytes up to the edge."""
        seconds = F.least(edge, F.col("t_last") + 1) - F.col("t_first")
        return F.when(seconds <= 0, 0).otherwise(div(F.col("bytes") * seconds, F.col("t_last") - F.col("t_first") + 1))

    part = until(F.col("minute") + 60) - until(F.col("minute"))
    return each.select("dst_net", "minute", part.alias("bytes")).groupBy("dst_net", "minute").agg(F.sum("bytes").alias("bytes"))


def grid(flows: DataFrame, src_prefix: int = 24, dst_prefix: int = 32) -> DataFrame:
    """dst_net, minute, bytes, sources for every minute between a destination's first and last."""
    nets = networks(flows, src_prefix, dst_prefix)
    volume, sources = attributed(nets), source_buckets(nets)
    both = volume.join(sources, ["dst_net", "minute"], "full_outer")
    ends = both.groupBy("dst_net").agg(F.min("minute").alias("a"), F.max("minute").alias("b"))
    span = ends.select("dst_net", F.explode(F.sequence("a", "b", F.lit(60))).alias("minute"))
    return span.join(both, ["dst_net", "minute"], "left").select("dst_net", "minute", F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"), F.coalesce("sources", F.lit(0)).cast("long").alias("sources"))


def floods(minutes: DataFrame, rate: int = RATE, source_rate: int = SOURCE_RATE, least_bytes: int = LEAST_BYTES, slots: int = SLOTS) -> DataFrame:
    """dst_net, started, mean_bytes, mean_sources: the next two minutes both exceed the mean of the minutes before.

    The mean goes over at most slots - 2 minutes that end at a minute, from the first one with traffic on.
    """
    w = Window.partitionBy("dst_net").orderBy("minute")
    back = w.rowsBetween(-(slots - 3), 0)
    history = F.collect_list(F.struct("bytes", "sources")).over(back)
    busy = F.aggregate(history, F.struct(F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("n")), lambda a, x: F.when((a["n"] == 0) & (x["bytes"] == 0), a).otherwise(F.struct((a["b"] + x["bytes"]).alias("b"), (a["s"] + x["sources"]).alias("s"), (a["n"] + 1).alias("n"))))
    seen = minutes.withColumn("__m", busy).withColumns({f"{c}{i}": F.lead(c, i).over(w) for c in ("bytes", "sources") for i in (1, 2)})
    seen = seen.withColumns({"mean_bytes": div(F.col("__m.b"), F.col("__m.n")), "mean_sources": div(F.col("__m.s"), F.col("__m.n"))})
    hit = (F.col("__m.n") > 0)
    for i in (1, 2):
        hit &= (F.col(f"bytes{i}") > F.col("mean_bytes") * rate) & (F.col(f"bytes{i}") > least_bytes) & (F.col(f"sources{i}") > F.col("mean_sources") * source_rate)
    return seen.filter(hit).select("dst_net", (F.col("minute") + 60).alias("started"), "mean_bytes", "mean_sources")


class Lifecycle:
    """A flood from its start to its end: a report every five minutes, and one when a minute falls back below."""

    def __init__(self, rate: int = RATE, source_rate: int = SOURCE_RATE, least_bytes: int = LEAST_BYTES, slots: int = SLOTS, every: int = 300):
        self.rate, self.source_rate, self.least, self.slots, self.every = rate, source_rate, least_bytes, slots, every
        self.past: list[dict[str, Any]] = []
        self.flood: dict[str, Any] | None = None

    def row(self, r: dict[str, Any]) -> list[dict[str, Any]]:
        out = []
        if self.flood:
            f = self.flood
            if r["bytes"] <= f["mean"] * self.rate:
                out.append(self.told(r["minute"], True))
                self.flood, self.past = None, [r]
                return out
            f["bytes"] += r["bytes"] - f["mean"]
            if r["minute"] + 60 - f["reported"] >= self.every:
                out.append(self.told(r["minute"] + 60, False))
                f["reported"] = r["minute"] + 60
            return out
        self.past = (self.past + [r])[-self.slots :]
        if len(self.past) >= 3:
            *before, a, b = self.past
            while before and not before[0]["bytes"]:
                before.pop(0)
            if before:
                mean, sources = (sum(x[k] for x in before) // len(before) for k in ("bytes", "sources"))
                if all(x["bytes"] > max(mean * self.rate, self.least) and x["sources"] > sources * self.source_rate for x in (a, b)):
                    self.flood = {"dst_net": r["dst_net"], "started": a["minute"], "reported": a["minute"], "mean": mean, "bytes": a["bytes"] + b["bytes"] - 2 * mean}
        return out

    def told(self, now: int, ended: bool) -> dict[str, Any]:
        return {"dst_net": self.flood["dst_net"], "started": self.flood["started"], "reported": now, "bytes": self.flood["bytes"], "ended": ended}

    def end(self) -> list[dict[str, Any]]:
        return [self.told(self.flood["reported"], True)] if self.flood else []


class Ring:
    """The last minutes of one destination as its flows come, each told to a Lifecycle when the ring has passed it.

    A flow's bytes go to its minutes by seconds, as in attributed(). A late flow still fills the minutes that the ring
    holds; what belongs to older ones is left out and counted in `late`. If time jumps by more than the ring, the
    input was interrupted: what is held is told and everything starts anew.
    """

    def __init__(self, lifecycle: Callable[[], Lifecycle], slots: int = SLOTS):
        self.fresh, self.slots, self.late = lifecycle, slots, 0
        self.reset()

    def reset(self) -> None:
        self.inner, self.held, self.newest, self.closed, self.dst = self.fresh(), {}, None, None, None

    def close(self, before: int) -> list[dict[str, Any]]:
        """Tells all minutes before the given one."""
        out = []
        if self.held or self.closed is not None:
            at = self.closed if self.closed is not None else min(self.held)
            for minute in range(at, before, 60):
                size, sources = self.held.pop(minute, (0, set()))
                out += self.inner.row({"dst_net": self.dst, "minute": minute, "bytes": size, "sources": len(sources)})
            self.closed = max(at, before)
        return out

    def row(self, r: dict[str, Any]) -> list[dict[str, Any]]:
        first, last, out = r["t_first"], r["t_last"], []
        if last < first:
            return []
        minute = last - last % 60
        if self.newest is not None and minute - self.newest > self.slots * 60:
            out = self.end()
            self.reset()
        self.dst, self.newest = r["dst_net"], minute if self.newest is None else max(self.newest, minute)
        out += self.close(self.newest - (self.slots - 1) * 60)
        for start in range(first - first % 60, minute + 1, 60):
            until = [r["bytes"] * max(0, min(edge, last + 1) - first) // (last - first + 1) for edge in (start, start + 60)]
            if self.closed is not None and start < self.closed:
                self.late += until[1] - until[0]
                continue
            size, sources = self.held.get(start, (0, set()))
            self.held[start] = (size + until[1] - until[0], sources | ({r["src_net"] % 511} if start == minute else set()))
        return out

    def end(self) -> list[dict[str, Any]]:
        return (self.close(self.newest + 60) if self.newest is not None else []) + self.inner.end()


def ring(flows: DataFrame, src_prefix: int = 24, dst_prefix: int = 32, slots: int = SLOTS, **settings: Any) -> DataFrame:
    """The lifecycle of floods from the flows themselves, in one pass, as a stream of them gives it."""
    nets = networks(flows, src_prefix, dst_prefix).select("dst_net", "src_net", "bytes", "t_first", "t_last", "seq")
    return run_keyed(nets, ["dst_net"], ["t_last", "seq"], lambda: Ring(lambda: Lifecycle(**settings), slots), FLOOD)


def lifecycle(minutes: DataFrame, rate: int = RATE, source_rate: int = SOURCE_RATE, least_bytes: int = LEAST_BYTES) -> DataFrame:
    return run_keyed(minutes, ["dst_net"], ["minute"], lambda: Lifecycle(rate, source_rate, least_bytes), FLOOD)

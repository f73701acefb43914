"""The state machines of sluice.operators.keyed, and windows, in Structured Streaming with event time."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from functools import partial
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType, _parse_datatype_string

from sluice.operators.keyed import Machine
from sluice.plans import flood


def with_event_time(flows: DataFrame, lateness: str = "420 seconds", column: str = "t_last") -> DataFrame:
    """flows with ts, its event time, and a watermark on it."""
    return flows.withColumn("ts", F.timestamp_seconds(column)).withWatermark("ts", lateness)


def run_stream(df: DataFrame, keys: list[str], order: list[str], machine: Callable[[], Machine], schema: str | StructType, idle: int | None = None) -> DataFrame:
    """What the machines of all keys emit, as rows arrive; within a micro-batch rows go by `order`.

    df has an event time `ts` with a watermark (with_event_time). If `idle` is given, a key without a row for so many
    seconds of event time is ended: what the machine's end() returns is emitted and its state goes.
    """
    kind = _parse_datatype_string(schema) if isinstance(schema, str) else schema
    names = kind.names

    def advance(key: tuple[Any, ...], parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        m = pickle.loads(state.get[0]) if state.exists else machine()
        out: list[dict[str, Any]] = []
        if state.hasTimedOut:
            out = m.end()
            state.remove()
        else:
            rows = pd.concat(list(parts)).sort_values(order, kind="stable")
            latest = rows["ts"].max()
            for row in rows.drop(columns="ts").astype(object).to_dict("records"):
                out += m.row(row)
            state.update((pickle.dumps(m),))
            if idle is not None:
                state.setTimeoutTimestamp(max(int(latest.timestamp() * 1000) + idle * 1000, state.getCurrentWatermarkMs() + 1))
        if out:
            yield pd.DataFrame(out, columns=names)

    timeout = GroupStateTimeout.EventTimeTimeout if idle is not None else GroupStateTimeout.NoTimeout
    return df.groupBy(*keys).applyInPandasWithState(advance, kind, "machine binary", "append", timeout)


def flood_ring_stream(nets: DataFrame, idle: int = 420, slots: int = flood.SLOTS, **settings: Any) -> DataFrame:
    """Floods of each destination as flows arrive (dst_net, src_net, bytes, t_first, t_last, seq, ts); late flows fill the ring.

    A destination without a flow for `idle` seconds of event time is told to its end and forgotten.
    """
    return run_stream(nets, ["dst_net"], ["t_last", "seq"], lambda: flood.Ring(partial(flood.Lifecycle, **settings), slots), flood.FLOOD, idle)


def rolled_up_stream(alerts: DataFrame, keys: list[str], count: str, width: str = "5 minutes") -> DataFrame:
    """Alerts (with event time ts) in tumbling windows: keys, start, alerts, sum, first and last time."""
    return alerts.groupBy(F.window("ts", width), *keys).agg(F.count("*").alias("alerts"), F.sum(count).alias("n"), F.min("ts").alias("ts_first"), F.max("ts").alias("ts_last")).select(F.col("window.start").alias("start"), *keys, "alerts", "n", "ts_first", "ts_last")


def host_counts_stream(flows: DataFrame, width: str = "5 minutes") -> DataFrame:
    """Flows, bytes and about how many peers of each source in tumbling windows (sketches keep the state small)."""
    return flows.groupBy(F.window("ts", width), "src_ip").agg(F.count("*").alias("flows"), F.sum("bytes").alias("bytes"), F.approx_count_distinct("dst_ip").alias("peers")).select(F.col("window.start").alias("start"), "src_ip", "flows", "bytes", "peers")


def peers_stream(flows: DataFrame, width: int = 300, precision: int = 12) -> DataFrame:
    """About how many peers each source had in windows of `width` seconds that begin each half width; the state is sketches."""
    at = F.window("ts", f"{width} seconds", f"{width // 2} seconds")
    return flows.groupBy(at, F.col("src_ip").alias("host")).agg(F.hll_sketch_agg("dst_ip", precision).alias("s")).select("host", F.col("window.start").cast("long").alias("start"), F.hll_sketch_estimate("s").alias("peers"))


def sessions_stream(flows: DataFrame, keys: list[str], gap: str = "300 seconds") -> DataFrame:
    """Sessions cut by idle gaps."""
    return flows.groupBy(F.session_window("ts", gap), *keys).agg(F.count("*").alias("flows"), F.sum("bytes").alias("bytes")).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("until"), *keys, "flows", "bytes")


def correlated_calls_stream(messages: DataFrame, lateness: str = "60 seconds") -> DataFrame:
    """OK answers with their INVITE (same call, swapped ends, within ten minutes), as a join of two streams."""
    m = messages.withColumn("ts", F.timestamp_seconds("t_last"))
    invite = m.filter("sip_msg_type = 'invite'").select(F.col("sip_call_id").alias("call"), F.col("src_ip").alias("caller"), F.col("dst_ip").alias("server"), F.col("ts").alias("invited")).withWatermark("invited", lateness)
    ok = m.filter("sip_msg_type = 'status' and sip_status_code = 200").select(F.col("sip_call_id").alias("call"), F.col("dst_ip").alias("caller"), F.col("src_ip").alias("server"), F.col("ts").alias("answered")).withWatermark("answered", lateness)
    return ok.join(invite, ["call", "caller", "server"]).filter("answered >= invited and answered <= invited + interval 10 minutes")


def match_with_fresh_lists(flows: DataFrame, read_list: Callable[[SparkSession], DataFrame], match: Callable[[DataFrame, DataFrame], DataFrame], path: str, checkpoint: str, feed_back: Callable[[DataFrame], None] | None = None):
    """Starts a query that matches each micro-batch against the list as it is then, and appends the matches as Parquet.

    feed_back gets the matches of a micro-batch and may write the next version of the list (adaptive lists).
    """

    def each(batch: DataFrame, number: int) -> None:
        found = match(batch, read_list(batch.sparkSession))
        found.write.mode("overwrite").parquet(f"{path}/batch={number}")  # a repeated micro-batch replaces itself
        if feed_back:
            feed_back(batch.sparkSession.read.parquet(f"{path}/batch={number}"))

    return flows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

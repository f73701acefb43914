"""Keyed state with native timers: records of hosts that end by age or by silence, without a further row.

The state is columns (a value, and a map of rows that wait for the watermark), so a micro-batch reads and writes what it
touches and never a whole pickled object. Rows wait until the watermark has passed them and are then taken in order of
time, so late rows within the watermark's delay change nothing; a record's end is a timer at the earlier of its two
deadlines. Needs the RocksDB state store (with_rocksdb).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

RECORD = "host long, flows long, packets long, bytes long, ts_first long, ts_last long"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def with_rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries that are started within keep their state in RocksDB."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


#: Seconds of a bucket of waiting rows.
BUCKET = 64


class HostRecords(StatefulProcessor):
    """Records of a host that end after `active` seconds or `inactive` seconds without a flow."""

    def __init__(self, active: int, inactive: int):
        self.active, self.inactive = active, inactive

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.record = handle.getValueState("record", "flows long, packets long, bytes long, first long, last long")
        self.waiting = handle.getMapState("waiting", "bucket long", "rows array<struct<t: long, seq: long, way: int, packets: long, bytes: long>>")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        buckets: dict[int, list[tuple]] = {}
        for r in rows:
            buckets.setdefault(r["t_last"] // BUCKET, []).append((r["t_last"], r["seq"], r["way"], r["packets"], r["bytes"]))
        for bucket, new in buckets.items():
            held = [tuple(x) for x in self.waiting.getValue((bucket,))[0]] if self.waiting.containsKey((bucket,)) else []
            self.waiting.updateValue((bucket,), (held + new,))
        if buckets:
            self.handle.registerTimer(min(x[0] for x in buckets[min(buckets)]) * 1000)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        """Takes all rows that the watermark has passed, in order, and ends the record if its time is over."""
        passed = timerValues.getCurrentWatermarkInMs() // 1000
        out, now = [], tuple(self.record.get()) if self.record.exists() else None

        def told() -> None:
            out.append(Row(host=key[0], flows=now[0], packets=now[1], bytes=now[2], ts_first=now[3], ts_last=now[4]))

        ready, later = [], []
        for (bucket,), (held,) in list(self.waiting.iterator()):
            due = [tuple(x) for x in held if x[0] <= passed]
            rest = [tuple(x) for x in held if x[0] > passed]
            ready += due
            later += [x[0] for x in rest]
            if due and rest:
                self.waiting.updateValue((bucket,), (rest,))
            elif due:
                self.waiting.removeKey((bucket,))
        for t, _, _, packets, size in sorted(ready):
            if now and (t - now[3] >= self.active or t - now[4] >= self.inactive):
                told()
                now = None
            now = (now[0] + 1, now[1] + packets, now[2] + size, now[3], max(now[4], t)) if now else (1, packets, size, t, t)
        times = [min(later)] if later else []
        if now:
            deadline = min(now[3] + self.active, now[4] + self.inactive)
            if deadline <= passed:
                told()
                self.record.clear()
            else:
                self.record.update(now)
                times.append(deadline)
        elif ready:
            self.record.clear()
        if times:
            self.handle.registerTimer(min(times) * 1000)
        return iter(out)

    def close(self) -> None:
        pass


def host_records(rows: DataFrame, active: int = 300, inactive: int = 30) -> DataFrame:
    """Records of a stream of (host, t_last, seq, way, packets, bytes, ts), ts being the watermarked event time."""
    return rows.groupBy("host").transformWithState(HostRecords(active, inactive), RECORD, "Append", "EventTime")


def run_parts(spark: SparkSession, parts: Iterable[DataFrame], folder: str, query: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What a query on a stream writes for parts that come one after another; it stops and starts again between them.

    Each part becomes files of the source; a run reads what is new, advances the watermark and ends. The state goes on
    from the checkpoint in the folder.
    """
    with with_rocksdb(spark):
        for at, part in enumerate(parts):
            part.write.parquet(f"{folder}/in/part={at}")
            rows = spark.readStream.schema(part.schema).parquet(f"{folder}/in/part=*")
            running = query(rows).writeStream.outputMode("append").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).format("parquet").start(f"{folder}/out")
            running.awaitTermination()
    return spark.read.parquet(f"{folder}/out")

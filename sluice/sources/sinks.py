"""Sinks: alerts as tables, JSON, logs, lists, documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions import ip


def write_alerts(alerts: DataFrame, path: str, partition: str | None = None) -> None:
    writer = alerts.write.mode("append")
    (writer.partitionBy(partition) if partition else writer).parquet(path)


def as_json(df: DataFrame) -> DataFrame:
    """value: each row as a JSON object."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def write_log(log: DataFrame, path: str) -> None:
    """Lines of text, a folder for each day."""
    log.select("day", "line").write.mode("append").partitionBy("day").text(path)


def detector_file(entries: DataFrame) -> DataFrame:
    """number and line (`address,bitmap[;list:port,port]`) of merged entries (number, bitmap, ports), by number."""
    ports = F.array_join(F.transform(F.array_sort(F.map_entries("ports")), lambda e: F.concat(e["key"].cast("string"), F.lit(":"), F.array_join(F.transform(F.array_sort(e["value"]), lambda x: x.cast("string")), ","))), ";")
    line = F.concat(ip.ipv4_text(F.col("number")), F.lit(","), F.col("bitmap").cast("string"), F.when(F.size("ports") > 0, F.concat(F.lit(";"), ports)).otherwise(""))
    return entries.select("number", line.alias("line")).sort("number")


def idea(category: str, node: str, identity: Column, detect: Column, src: Column | None = None, dst: Column | None = None, note: Column | None = None, count: Column | None = None) -> Column:
    """An alert as an IDEA document (JSON). Addresses are arrays of text; times are seconds."""
    parts = [F.lit("IDEA0").alias("Format"), identity.alias("ID"), F.array(F.lit(category)).alias("Category"), F.date_format(F.timestamp_seconds(detect), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("DetectTime")]
    for name, end in (("Source", src), ("Target", dst)):
        if end is not None:
            parts.append(F.array(F.struct(end.alias("IP4"))).alias(name))
    if note is not None:
        parts.append(note.alias("Note"))
    if count is not None:
        parts.append(count.alias("FlowCount"))
    parts.append(F.array(F.struct(F.lit(node).alias("Name"), F.array(F.lit("Flow"), F.lit("Statistical")).alias("Type"))).alias("Node"))
    return F.to_json(F.struct(*parts))


def misp_event(info: Column, attributes: Column, day: Column) -> Column:
    """An event with attributes (array of struct(type, category, value)) as a MISP document (JSON)."""
    return F.to_json(F.struct(F.struct(info.alias("info"), day.alias("date"), attributes.alias("Attribute")).alias("Event")))


def event_id(*parts: Column) -> Column:
    """A name for an event that is the same in every run."""
    return F.left(F.sha2(F.concat_ws(":", *(p.cast("string") for p in parts)), 256), F.lit(32))


def histogram_report(hist: DataFrame, step: int) -> DataFrame:
    """size_from, n and place (by n, then size) of a histogram's bins, which are few."""
    place = F.row_number().over(Window.orderBy(F.col("n").desc(), "bin"))
    return hist.select((F.col("bin") * step).cast("long").alias("size_from"), "n", place.cast("long").alias("place"))

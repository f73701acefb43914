"""Text sources of lists, rules and settings, read with Spark (any store that Spark reads)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions import ip
from sluice.operators.lookups import longest_prefix

IPV4_IN_TEXT = r"((?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9]))"
IPV6_IN_TEXT = r"((?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:)*[0-9A-Fa-f]{0,4}::(?:[0-9A-Fa-f]{1,4}:)*[0-9A-Fa-f]{0,4})"
URL_IN_TEXT = r"(?i)((?:https?://)?(?:[a-z0-9-]+\.)+[a-z]{2,}(?::[0-9]+)?(?:/\S*)?)"


def without_comments(text: DataFrame) -> DataFrame:
    """Lines (column value) without blank ones and comments (# or ;)."""
    return text.filter(~F.col("value").rlike(r"^\s*([#;].*)?$"))


def lines(spark: SparkSession, path: str) -> DataFrame:
    return without_comments(spark.read.text(path))


def ip_entries(text: DataFrame) -> DataFrame:
    """`address[/prefix],bitmap[;list:port,port...]`: text, network, prefix, bitmap and ports (map of list to ports).

    IPv4 lines have a network number, IPv6 lines a null one and their bytes in network6; other lines are skipped.
    """
    value = F.trim("value")
    head = F.split(value, ";", 2)
    first = F.split(head[0], ",", 2)
    address, prefix = F.split(first[0], "/", 2)[0], F.try_element_at(F.split(first[0], "/", 2), F.lit(2)).try_cast("int")
    groups = F.slice(F.split(value, ";"), 2, 1 << 20)
    ports = F.map_from_entries(F.transform(F.filter(groups, lambda g: F.instr(g, ":") > 0), lambda g: F.struct(F.split(g, ":")[0].try_cast("int"), F.transform(F.split(F.split(g, ":")[1], ","), lambda p: p.try_cast("int")))))
    out = text.select(address.alias("text"), prefix.alias("prefix"), F.try_element_at(first, F.lit(2)).try_cast("long").alias("bitmap"), ports.alias("ports"))
    out = out.filter("bitmap is not null").withColumn("network", ip.ipv4_number(F.col("text"))).withColumn("network6", F.when(F.col("network").isNull() & F.contains("text", F.lit(":")), ip.ipv6_bytes("text")))
    out = out.withColumn("prefix", F.coalesce("prefix", F.when(F.col("network").isNotNull(), 32).otherwise(128)))
    return out.filter((F.col("network").isNotNull() & F.col("prefix").between(0, 32)) | (F.col("network6").isNotNull() & F.col("prefix").between(0, 128)))


def name_entries(text: DataFrame) -> DataFrame:
    """`name\\bitmap`: name and bitmap; other lines are skipped."""
    parts = F.split("value", r"\\", 2)
    return text.select(parts[0].alias("name"), F.try_element_at(parts, F.lit(2)).try_cast("long").alias("bitmap")).filter("bitmap is not null and name <> ''")


def extracted(text: DataFrame, kind: str) -> DataFrame:
    """entity: the first IPv4 or IPv6 address or URL of each line that has one."""
    pattern = {"ipv4": IPV4_IN_TEXT, "ipv6": IPV6_IN_TEXT, "url": URL_IN_TEXT}[kind]
    return text.select(F.regexp_extract("value", pattern, 1).alias("entity")).filter("entity <> ''")


def csv_column(text: DataFrame, column: int, delimiter: str = ",") -> DataFrame:
    """entity: a column (from 1) of delimited lines, without quotes and spaces."""
    cell = F.try_element_at(F.split("value", re.escape(delimiter)), F.lit(column))
    return text.select(F.trim(F.regexp_replace(cell, '^\\s*"|"\\s*$', "")).alias("entity")).filter("entity is not null and entity <> ''")


def json_entries(documents: DataFrame, key: str, where: dict[str, str] | None = None, prefix: str = "", port: str | None = None) -> DataFrame:
    """entity and ports of JSON objects (column value) whose fields have the given values."""

    def field(name: str) -> Column:
        return F.get_json_object("value", f"$.{name}")

    kept = documents
    for name, value in (where or {}).items():
        kept = kept.filter(field(name) == value)
    entity = F.when(field(key).startswith(prefix), F.substring(field(key), len(prefix) + 1, 1 << 30)).otherwise(field(key)) if prefix else field(key)
    number = field(port).try_cast("int") if port else F.lit(None).cast("int")
    return kept.select(entity.alias("entity"), number.alias("port")).filter("entity is not null").groupBy("entity").agg(F.array_sort(F.collect_set("port")).alias("ports"))


def whitelist(text: DataFrame) -> DataFrame:
    """`[src|dst] address/prefix[/ports]` with ports as `a,b-c`: network, prefix, direction, port_from, port_to."""
    value = F.trim(F.regexp_replace("value", "#.*$", ""))
    direction = F.regexp_extract(value, r"^(src|dst)\s", 1)
    rest = F.split(F.regexp_replace(value, r"^(src|dst)\s+", ""), "/")
    ports = F.coalesce(F.try_element_at(rest, F.lit(3)), F.lit(""))
    out = text.select(ip.ipv4_number(rest[0]).alias("network"), F.coalesce(F.try_element_at(rest, F.lit(2)).try_cast("int"), F.lit(32)).alias("prefix"), F.when(direction == "", "all").otherwise(direction).alias("direction"), F.explode(F.split(ports, ",")).alias("range"))
    ends = F.split("range", "-")
    low = ends[0].try_cast("int")
    return out.filter("network is not null and prefix between 0 and 32").select("network", "prefix", "direction", low.alias("port_from"), F.coalesce(F.try_element_at(ends, F.lit(2)).try_cast("int"), low).alias("port_to"))


def pools(text: DataFrame) -> DataFrame:
    """`address[:port]`: pool_ip and pool_port (0: any)."""
    parts = F.split(F.trim("value"), ":")
    return text.select(ip.ipv4_number(parts[0]).alias("pool_ip"), F.coalesce(F.try_element_at(parts, F.lit(2)).try_cast("int"), F.lit(0)).alias("pool_port")).filter("pool_ip is not null")


def rules(text: DataFrame) -> DataFrame:
    """`pattern ** FIELD,FIELD`: pattern and fields."""
    parts = F.split("value", r" \*\* ", 2)
    return text.filter(F.contains("value", F.lit(" ** "))).select(parts[0].alias("pattern"), F.transform(F.split(parts[1], ","), lambda x: F.trim(x)).alias("fields"))


def any_word(words: list[str]) -> str:
    """A pattern that finds any of the words, the longest first."""
    return "(?:" + "|".join(re.escape(w) for w in sorted(set(words), key=lambda w: (-len(w), w))) + ")"


def settings(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    """Rows of an XML file."""
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def dns_dump(text: DataFrame) -> DataFrame:
    """Tab-parted dump of DNS packets: seq, t_last, src_ip, dst_ip, bytes, name, answer. Short lines are skipped."""
    p = F.split("value", "\t")
    return text.filter(F.size(p) >= 6).select(p[0].try_cast("long").alias("seq"), p[1].try_cast("double").cast("long").alias("t_last"), ip.ipv4_number(p[2]).alias("src_ip"), ip.ipv4_number(p[3]).alias("dst_ip"), p[4].try_cast("long").alias("bytes"), p[5].alias("name"), F.try_element_at(p, F.lit(7)).alias("answer"))


def tagged(inputs: dict[str, DataFrame]) -> DataFrame:
    """Several inputs as one, each row with its input's name."""
    out = None
    for name, df in inputs.items():
        part = df.withColumn("input", F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no input")
    return out


def countries(addresses: DataFrame, address: str, ranges: DataFrame) -> DataFrame:
    """addresses with country, from networks (network, prefix, country); the longest prefix counts."""
    each = addresses.select(address).distinct().withColumn("__id", F.col(address))
    found = longest_prefix(each, "__id", address, ranges, "country")
    return addresses.join(found, addresses[address] == found["__id"], "left").drop("__id")

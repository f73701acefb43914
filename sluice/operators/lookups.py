"""Lookups of addresses and names in lists: prefixes, ports, exact keys, white lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import bits, ip

#: Rows of a list up to which it may be broadcast; a longer one is joined by shuffle.
BROADCAST_ROWS = 1_000_000


def bounded(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most so many rows (they are counted first), else as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def is_bounded(df: DataFrame, most: int = BROADCAST_ROWS) -> bool:
    return df.limit(most + 1).count() <= most


def with_prefixes(df: DataFrame, address: str, prefixes: DataFrame, columns: list[str], out: str) -> DataFrame:
    """df with out: an array of struct(columns) of all prefixes (network, prefix, columns) that hold the address.

    The list must be bounded: it is broadcast, one equality join for each prefix length that it has (33 at most), so
    rows of df stay where they are.
    """
    lengths = sorted(r[0] for r in prefixes.select("prefix").distinct().filter("prefix between 0 and 32").collect())
    listed = prefixes.groupBy(F.col("prefix").cast("int").alias("__n"), ip.mask(F.col("network"), F.col("prefix")).alias("__net")).agg(F.collect_list(F.struct(*columns)).alias("__found"))
    kind = listed.schema["__found"].dataType
    df = df.withColumn(out, F.array().cast(kind))
    for n in lengths:
        one = F.broadcast(listed.filter(F.col("__n") == n).select("__net", "__found"))
        df = df.join(one, ip.mask(F.col(address), n) == F.col("__net"), "left").withColumn(out, F.when(F.col("__found").isNull(), F.col(out)).otherwise(F.concat(out, "__found"))).drop("__net", "__found")
    return df


def prefix_matches(df: DataFrame, address: str, prefixes: DataFrame) -> DataFrame:
    """Each row of df with every prefix (network, prefix and other columns) that holds its address.

    Each address is masked by the prefix lengths that the list has (at most 33), so the join is by equality and never
    by range.
    """
    lengths = [r[0] for r in prefixes.select("prefix").distinct().filter("prefix between 0 and 32").collect()]
    tried = F.explode(F.array(*(F.struct(F.lit(n).alias("__prefix"), ip.mask(F.col(address), n).alias("__network")) for n in sorted(lengths)))) if lengths else F.explode(F.array().cast("array<struct<__prefix:int,__network:bigint>>"))
    listed = bounded(prefixes.withColumn("__list_network", ip.mask(F.col("network"), F.col("prefix"))).drop("network"))
    each = df.withColumn("__try", tried).select("*", "__try.*").drop("__try")
    return each.join(listed, (each["__network"] == listed["__list_network"]) & (each["__prefix"] == listed["prefix"].cast("int"))).drop("__network", "__prefix", "__list_network")


def prefix_matches6(df: DataFrame, address: str, prefixes: DataFrame) -> DataFrame:
    """As prefix_matches() for IPv6 addresses of 16 bytes; prefixes have network6, prefix and other columns."""
    lengths = [r[0] for r in prefixes.select("prefix").distinct().filter("prefix between 0 and 128").collect()]  # 129 at most
    halves = ip.ipv6_halves(F.col(address))

    def one(n: int) -> Column:
        first, last = ip.mask6(halves, n)
        return F.struct(F.lit(n).alias("__prefix"), first.alias("__first"), last.alias("__last"))

    tried = F.explode(F.array(*map(one, sorted(lengths)))) if lengths else F.explode(F.array().cast("array<struct<__prefix:int,__first:bigint,__last:bigint>>"))
    first, last = ip.mask6(ip.ipv6_halves(F.col("network6")), F.col("prefix"))
    listed = bounded(prefixes.withColumns({"__list_first": first, "__list_last": last}).drop("network6"))
    each = df.withColumn("__try", tried).select("*", "__try.*").drop("__try")
    same = (each["__first"] == listed["__list_first"]) & (each["__last"] == listed["__list_last"]) & (each["__prefix"] == listed["prefix"].cast("int"))
    return each.join(listed, same).drop("__first", "__last", "__prefix", "__list_first", "__list_last")


def longest_prefix(df: DataFrame, key: str, address: str, prefixes: DataFrame, value: str) -> DataFrame:
    """key and the value of the longest prefix that holds the address."""
    return prefix_matches(df.select(key, address), address, prefixes).groupBy(key).agg(F.max_by(value, "prefix").alias(value))


def listed_ids(matches: DataFrame, key: list[str], port: str) -> DataFrame:
    """key and bitmap: OR of the list bits whose ports (column `port`, null for any) allow the flow's port.

    matches has a row for each matching prefix and list: list_id and port.
    """
    allowed = matches.filter(F.col("port").isNull() | (F.col("port") == F.col(port)))
    return allowed.groupBy(*key).agg(F.bit_or(bits.of_id(F.col("list_id"))).alias("bitmap"))


def port_allowed(bitmap: Column, ports: Column, port: Column) -> Column:
    """Bits that stay: those of lists that name no ports, or this one. ports: map of list id to array of ports."""
    wrong = F.aggregate(F.filter(F.map_entries(ports), lambda e: ~F.array_contains(e["value"], port)), F.lit(0).cast("long"), lambda a, e: a.bitwiseOR(bits.of_id(e["key"])))
    return bitmap.bitwiseAND(F.bitwise_not(F.coalesce(wrong, F.lit(0).cast("long"))))


def exact_matches(df: DataFrame, key: str, names: DataFrame, name: str) -> DataFrame:
    """Rows of df whose key is listed, with the list's columns."""
    listed = bounded(names)
    return df.join(listed, df[key] == listed[name])


def _within(port: Column) -> Callable[[Column], Column]:
    return lambda rule: rule["port_from"].isNull() | port.between(rule["port_from"], F.coalesce(rule["port_to"], rule["port_from"]))


def not_whitelisted(flows: DataFrame, rules: DataFrame, key: str = "seq") -> DataFrame:
    """Flows that no rule covers. Rules: network, prefix, direction (src, dst or all), port_from, port_to (null: any)."""

    if is_bounded(rules):
        for end in ("src", "dst"):
            own, port = rules.filter(F.col("direction").isin(end, "all")), F.col(f"{end}_port")
            covers = F.exists("__rules", _within(port))
            flows = with_prefixes(flows, f"{end}_ip", own, ["port_from", "port_to"], "__rules").filter(~F.coalesce(covers, F.lit(False))).drop("__rules")
        return flows

    def hits(end: str) -> DataFrame:
        own = rules.filter(F.col("direction").isin(end, "all"))
        port = F.col(f"{end}_port")
        met = prefix_matches(flows.select(key, f"{end}_ip", f"{end}_port"), f"{end}_ip", own)
        return met.filter(F.col("port_from").isNull() | port.between(F.col("port_from"), F.coalesce("port_to", "port_from"))).select(key)

    return flows.join(hits("src").union(hits("dst")).distinct(), key, "left_anti")


def in_pool(flows: DataFrame, pools: DataFrame, address: str, port: str, how: str = "left_semi") -> DataFrame:
    """Flows whose address and port are listed (pool_ip, pool_port; port 0 or null: any), or with left_anti those whose aren't."""
    listed = pools.select("pool_ip", F.coalesce("pool_port", F.lit(0)).alias("pool_port")).distinct()
    if is_bounded(listed):
        every = F.broadcast(listed.filter("pool_port = 0").select(F.col("pool_ip").alias("__any")))
        named = F.broadcast(listed.filter("pool_port <> 0").select(F.col("pool_ip").alias("__own"), F.col("pool_port").alias("__port")))
        marked = flows.join(every, flows[address] == every["__any"], "left").join(named, (flows[address] == named["__own"]) & (flows[port] == named["__port"]), "left")
        found = F.col("__any").isNotNull() | F.col("__own").isNotNull()
        return marked.filter(found if how == "left_semi" else ~found).drop("__any", "__own", "__port")
    tried = flows.withColumn("__port", F.explode(F.array(F.col(port), F.lit(0))))
    hit = tried.join(listed, (tried[address] == listed["pool_ip"]) & (tried["__port"] == listed["pool_port"]), "left_semi").select("seq").distinct()
    return flows.join(hit, "seq", how)


def dictionary(df: DataFrame, column: str) -> DataFrame:
    """value and code of every different string of a column; a code is the first 60 bits of its SHA-256, so it is the same in every run."""
    return df.select(F.col(column).alias("value")).filter("value is not null").distinct().withColumn("code", coded(F.col("value")))


def coded(value: Column) -> Column:
    return F.conv(F.left(F.sha2(value, 256), F.lit(15)), 16, 10).cast("long")


def correlate_calls(messages: DataFrame) -> DataFrame:
    """OK answers with the INVITE that they answer: same call and callee, swapped ends, earlier."""
    invite = messages.filter("sip_msg_type = 'invite'").select("call_id", "callee", F.col("src_ip").alias("caller_ip"), F.col("dst_ip").alias("server_ip"), F.col("seq").alias("invite_seq"))
    ok = messages.filter("sip_msg_type = 'status'").select("call_id", "callee", F.col("src_ip").alias("server_ip"), F.col("dst_ip").alias("caller_ip"), F.col("seq").alias("ok_seq"))
    return ok.join(invite, ["call_id", "callee", "caller_ip", "server_ip"]).filter("invite_seq < ok_seq").groupBy("call_id", "callee", "caller_ip", "server_ip", "ok_seq").agg(F.max("invite_seq").alias("invite_seq"))

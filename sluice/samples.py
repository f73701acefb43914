"""Inputs of the catalogue that the tables don't hold, made from them by integer arithmetic that any engine repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.schema import flows_of_events


def list_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed networks: network, prefix, list_id and port (null: any), from the nations."""
    n = F.col("n_nationkey")
    return spark.read.parquet(f"{sf_dir}/nation.parquet").select(
        (F.when(n % 2 == 0, F.lit(167772160) + n % 16).otherwise(F.lit(3232235520) + n % 8)).cast("long").alias("network"),
        (F.lit(32) - n % 3).cast("int").alias("prefix"),
        (n % 5 + 1).cast("int").alias("list_id"),
        F.when(n % 4 == 0, 80).when(n % 4 == 1, 22).cast("int").alias("port"),
    )


LISTS_SQL = """l as (select cast(case when n_nationkey % 2 = 0 then 167772160 + n_nationkey % 16 else 3232235520 + n_nationkey % 8 end as bigint) network,
  cast(32 - n_nationkey % 3 as int) prefix, cast(n_nationkey % 5 + 1 as int) list_id,
  cast(case n_nationkey % 4 when 0 then 80 when 1 then 22 end as int) port from nation)"""


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SIP messages from the events: invites, their answers, and answers to REGISTER."""
    e, u = F.col("event_id").cast("long"), F.col("user_id")
    status = e % 3 != 0
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(
        e.alias("seq"), (F.lit(1704067200) + e).alias("t_last"),
        F.when(status, F.lit(3232235520) + u % 4).otherwise(F.lit(167772160) + u % 16).cast("long").alias("src_ip"),
        F.when(status, F.lit(167772160) + u % 16).otherwise(F.lit(3232235520) + u % 4).cast("long").alias("dst_ip"),
        F.when(status, "status").otherwise("invite").alias("sip_msg_type"),
        F.when(e % 7 == 0, 200).otherwise(401).cast("int").alias("sip_status_code"),
        F.when(e % 3 == 1, "1 REGISTER").otherwise("1 INVITE").alias("sip_cseq"),
        F.concat(F.lit("sip:u"), (u % 20).cast("string"), F.lit("@a.example;tag=1")).alias("sip_calling_party"),
        F.concat(F.lit("sip:"), F.lpad((e * 37 % 1000).cast("string"), 4, "0"), F.lit("42077@b.example")).alias("sip_called_party"),
        F.concat(F.lit("c"), F.floor(e / 3).cast("string")).alias("sip_call_id"),
    )


MESSAGES_SQL = """m as (select cast(event_id as bigint) seq, cast(1704067200 + event_id as bigint) t_last,
  cast(case when event_id % 3 <> 0 then 3232235520 + user_id % 4 else 167772160 + user_id % 16 end as bigint) src_ip,
  cast(case when event_id % 3 <> 0 then 167772160 + user_id % 16 else 3232235520 + user_id % 4 end as bigint) dst_ip,
  case when event_id % 3 <> 0 then 'status' else 'invite' end sip_msg_type, case when event_id % 7 = 0 then 200 else 401 end sip_status_code,
  case when event_id % 3 = 1 then '1 REGISTER' else '1 INVITE' end sip_cseq, 'u' || cast(user_id % 20 as varchar) || '@a.example' as party,
  lpad(cast(event_id * 37 % 1000 as varchar), 4, '0') || '42077' as callee, 'c' || cast(event_id // 3 as varchar) as call_id from events)"""


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web requests from the pages: seq, http_method, host, path, url."""
    return spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.col("page_id").alias("seq"), F.lit("GET").alias("http_method"), F.regexp_extract("url", "^https?://([^/]*)", 1).alias("host"), F.regexp_replace("url", "^https?://[^/]*", "").alias("path"), "url")


REQUESTS_SQL = """r as (select page_id as seq, 'GET' as http_method, regexp_extract(url, '^https?://([^/]*)', 1) as host,
  regexp_replace(url, '^https?://[^/]*', '') as path, url from pages)"""


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DNS packets from the events: names of the client's queries, sizes."""
    e, u = F.col("event_id").cast("long"), F.col("user_id")
    name = F.concat(F.when(e % 4 < 3, e.cast("string")).otherwise("www"), F.lit(".x"), (u % 5).cast("string"), F.lit(".example"))
    return spark.read.parquet(f"{sf_dir}/events.parquet").select((F.lit(167772160) + u % 16).cast("long").alias("client"), (F.lit(1704067200) + e - e % 60).cast("long").alias("round"), (e % 3 != 0).alias("is_request"), (F.lit(40) + F.floor("value")).cast("long").alias("size"), name.alias("name"))


NAMES_SQL = """d as (select cast(167772160 + user_id % 16 as bigint) client, cast(1704067200 + event_id - event_id % 60 as bigint) round, event_id % 3 <> 0 as is_request,
  cast(40 + floor(value) as bigint) size, case when event_id % 4 < 3 then cast(event_id as varchar) else 'www' end || '.x' || cast(user_id % 5 as varchar) || '.example' as name from events)"""


def mails(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mail flows from the events: a flow's columns, smtp_status, sender, recipient."""
    f = flows_of_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
    s = F.col("seq")
    return f.withColumns({"dst_port": F.when(s % 2 == 0, 25).otherwise(F.col("dst_port")), "smtp_status": F.when(s % 3 == 0, F.lit(0x40000000) + F.when(s % 5 == 0, 0x100).otherwise(0)).otherwise(16).cast("long"), "sender": F.when(s % 4 > 0, F.concat(F.lit("s"), (s % 9).cast("string"))), "recipient": F.when(s % 7 > 0, F.lit("r"))})


def logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows of SSH, RDP and Telnet in both directions from the events, with the columns of a flow."""
    f = flows_of_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
    e = F.col("seq")
    port = F.when(e % 3 == 0, 22).when(e % 3 == 1, 3389).otherwise(23)
    asks = F.floor(e / 3) % 2 == 0
    return f.select(
        "seq", F.when(asks, F.col("src_ip")).otherwise(F.col("dst_ip")).alias("src_ip"), F.when(asks, F.col("dst_ip")).otherwise(F.col("src_ip")).alias("dst_ip"),
        F.when(asks, F.lit(40000) + e % 999).otherwise(port).cast("int").alias("src_port"), F.when(asks, port).otherwise(F.lit(40000) + e % 999).cast("int").alias("dst_port"),
        F.lit(6).alias("protocol"), (1 + e * 7 % 60).alias("packets"), (80 + e * 131 % 4000).alias("bytes"), F.when(e % 5 == 0, 27).when(e % 5 == 1, 30).otherwise(26).cast("int").alias("tcp_flags"), "t_first", "t_last",
    )


LOGINS_SQL = """g0 as (select cast(event_id as bigint) e, cast(167772160 + user_id % 16 as bigint) client, cast(3232235520 + (event_id // 3) % 8 as bigint) server, (event_id // 3) % 2 = 0 as asks,
  case event_id % 3 when 0 then 22 when 1 then 3389 else 23 end as port, cast(1 + event_id * 7 % 60 as bigint) packets, cast(80 + event_id * 131 % 4000 as bigint) bytes,
  case event_id % 5 when 0 then 27 when 1 then 30 else 26 end as tcp_flags, cast(1704067200 + event_id as bigint) t_last from events)"""

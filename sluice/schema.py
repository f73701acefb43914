"""Flow records: their columns, a guard for them, and a flow table made from the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: One row per flow. Addresses are unsigned 32-bit numbers in a long, times are seconds since 1970, seq is a total order.
FLOW = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("src_ip", T.LongType()),
        T.StructField("dst_ip", T.LongType()),
        T.StructField("src_port", T.IntegerType()),
        T.StructField("dst_port", T.IntegerType()),
        T.StructField("protocol", T.IntegerType()),
        T.StructField("packets", T.LongType()),
        T.StructField("bytes", T.LongType()),
        T.StructField("tcp_flags", T.IntegerType()),
        T.StructField("t_first", T.LongType()),
        T.StructField("t_last", T.LongType()),
    ]
)
FIN, SYN, RST, PSH, ACK, URG = 1, 2, 4, 8, 16, 32
TCP, UDP = 6, 17


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """df as it is; an error that names the columns that it lacks. Extra columns pass through."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def flows_of_events(events: DataFrame) -> DataFrame:
    """A deterministic flow table; integer arithmetic only, so any engine makes the same rows."""
    e = F.col("event_id").cast("long")
    fifth, flags = F.floor(e / 5) % 8, F.col("event_type")
    port = F.when(fifth == 0, 22).when(fifth == 1, 53).when(fifth == 2, 80).when(fifth == 3, 25).otherwise(1024 + F.floor(e / 24) % 512)
    return events.select(
        e.alias("seq"),
        (F.lit(167772160) + F.col("user_id") % 16).cast("long").alias("src_ip"),
        (F.lit(3232235520) + F.floor(e / 3) % 8).cast("long").alias("dst_ip"),
        (1024 + e * 7 % 40000).cast("int").alias("src_port"),
        port.cast("int").alias("dst_port"),
        F.when(e % 10 < 8, TCP).otherwise(UDP).cast("int").alias("protocol"),
        (1 + e % 5).cast("long").alias("packets"),
        (40 + F.floor("value")).cast("long").alias("bytes"),
        F.when(flags == "click", 2).when(flags == "view", 16).when(flags == "purchase", 24).when(flags == "signup", 18).otherwise(4).cast("int").alias("tcp_flags"),
        (1704067200 + e - e % 90).cast("long").alias("t_first"),
        (1704067200 + e).cast("long").alias("t_last"),
    )


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows_of_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


#: The flow table in SQL, for use as a common table expression named f.
FLOWS_SQL = """f as (select cast(event_id as bigint) seq, cast(167772160 + user_id % 16 as bigint) src_ip,
  cast(3232235520 + (event_id // 3) % 8 as bigint) dst_ip, cast(1024 + (event_id * 7) % 40000 as int) src_port,
  cast(case (event_id // 5) % 8 when 0 then 22 when 1 then 53 when 2 then 80 when 3 then 25 else 1024 + (event_id // 24) % 512 end as int) dst_port,
  cast(case when event_id % 10 < 8 then 6 else 17 end as int) protocol, cast(1 + event_id % 5 as bigint) packets,
  cast(40 + floor(value) as bigint) bytes,
  cast(case event_type when 'click' then 2 when 'view' then 16 when 'purchase' then 24 when 'signup' then 18 else 4 end as int) tcp_flags,
  cast(1704067200 + event_id - event_id % 90 as bigint) t_first, cast(1704067200 + event_id as bigint) t_last from events)"""

"""Projections: who is the server, which way a flow goes, networks, request parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import ip, text

REQUEST, RESPONSE, UNKNOWN = "request", "response", "unknown"


def by_service(flows: DataFrame, port: int) -> DataFrame:
    """Flows to or from a service port, with server, client and is_query."""
    query = F.col("dst_port") == port
    return flows.filter((F.col("dst_port") == port) | (F.col("src_port") == port)).select("*", query.alias("is_query"), F.when(query, F.col("dst_ip")).otherwise(F.col("src_ip")).alias("server"), F.when(query, F.col("src_ip")).otherwise(F.col("dst_ip")).alias("client"))


def direction(src_port: Column, dst_port: Column, low: int = 10000) -> Column:
    """From the ports: the lower one is the server's if it is below `low` and they differ."""
    known = ((src_port < low) | (dst_port < low)) & (src_port != dst_port)
    return F.when(known & (src_port < dst_port), RESPONSE).when(known, REQUEST).otherwise(UNKNOWN)


def networks(flows: DataFrame, src_prefix: int = 24, dst_prefix: int = 32) -> DataFrame:
    return flows.withColumns({"src_net": ip.mask(F.col("src_ip"), src_prefix), "dst_net": ip.mask(F.col("dst_ip"), dst_prefix)})


def http_parts(df: DataFrame, method: str, host: str, url: str) -> DataFrame:
    """df with path, query, arg_names, arg_values and request (method and URL)."""
    u = F.col(url)
    return df.withColumns({"path": F.try_parse_url(u, F.lit("PATH")), "query": F.try_parse_url(u, F.lit("QUERY")), "arg_names": text.query_names(u), "arg_values": text.query_values(u), "request": F.concat_ws(" ", F.col(method), F.coalesce(F.col(host), F.lit("")), u)})


def roles(flows: DataFrame) -> DataFrame:
    """Two rows a flow, one for each end: host, peer, outgoing."""
    ends = F.explode(F.array(F.struct(F.col("src_ip").alias("host"), F.col("dst_ip").alias("peer"), F.lit(True).alias("outgoing")), F.struct(F.col("dst_ip").alias("host"), F.col("src_ip").alias("peer"), F.lit(False).alias("outgoing"))))
    return flows.withColumn("end", ends).select("*", "end.*").drop("end")

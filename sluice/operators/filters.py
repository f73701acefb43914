"""Flow predicates, each a Column over a flow's columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.bits import has_all
from sluice.schema import ACK, RST, SYN, TCP, UDP

#: Fixed values: (packets, flags) of flows that look like a scan's.
SCAN_SHAPES = ((1, SYN), (2, SYN), (2, SYN | RST), (1, SYN | ACK), (1, RST | ACK), (3, SYN))
MAIL_PORTS = (25, 143, 465, 587, 993, 995)


def both_ipv4(src: Column, dst: Column) -> Column:
    return src.isNotNull() & dst.isNotNull() & src.between(0, 0xFFFFFFFF) & dst.between(0, 0xFFFFFFFF)


def syn_probe(most_packets: int) -> Column:
    """Small TCP flows with the SYN flag alone."""
    return (F.col("packets") <= most_packets) & (F.col("protocol") == TCP) & (F.col("tcp_flags") == SYN)


def single_syn() -> Column:
    return (F.col("packets") == 1) & (F.col("protocol") == TCP) & (F.col("tcp_flags") == SYN)


def to_service(port: int) -> Column:
    return F.col("dst_port") == port


def from_service(port: int) -> Column:
    return F.col("src_port") == port


def of_service(port: int, protocol: int = TCP) -> Column:
    return (F.col("protocol") == protocol) & (to_service(port) | from_service(port))


def portless_udp() -> Column:
    return (F.col("protocol") == UDP) & (F.col("src_port") == 0) & (F.col("dst_port") == 0)


def dns() -> Column:
    return (F.col("src_port") == 53) | (F.col("dst_port") == 53)


def sip_register_answer() -> Column:
    """Answers 200 or 401 to REGISTER between known ends."""
    return F.contains("sip_cseq", F.lit("REG")) & (F.col("sip_msg_type") == "status") & F.col("sip_status_code").isin(200, 401) & F.col("src_ip").isNotNull() & F.col("dst_ip").isNotNull()


def sip_invite_or_ok() -> Column:
    return (F.col("sip_msg_type") == "invite") | ((F.col("sip_msg_type") == "status") & (F.col("sip_status_code") == 200) & F.contains("sip_cseq", F.lit("INV")))


def plain_http_request() -> Column:
    return (F.col("dst_port") != 443) & (F.col("src_port") != 443) & F.col("http_method").isNotNull()


def mail(ports: tuple[int, ...] = MAIL_PORTS) -> Column:
    return F.col("src_port").isin(*ports) | F.col("dst_port").isin(*ports)


def scan_shaped() -> Column:
    return reduce(lambda a, b: a | b, ((F.col("packets") == p) & (F.col("tcp_flags") == f) for p, f in SCAN_SHAPES))


def ssh_ignored() -> Column:
    """One-packet flows of ACK alone and four-packet flows of SYN alone."""
    return ((F.col("packets") == 1) & (F.col("tcp_flags") == ACK)) | ((F.col("packets") == 4) & (F.col("tcp_flags") == SYN))


def signature(flags: int, packets: tuple[int, int], size: tuple[int, int]) -> Column:
    """All the given flags, and packets and bytes within bounds."""
    return has_all(F.col("tcp_flags"), flags) & F.col("packets").between(*packets) & F.col("bytes").between(*size)


def lasting(seconds: Column, least: int = 30, most: int = 7200) -> Column:
    return seconds.between(least, most)


def without_domains(df: DataFrame, column: str, excepted: DataFrame) -> DataFrame:
    """Rows whose name is neither an excepted domain (column `domain`) nor below one.

    Each name meets its own suffixes by equality; no pair of name and domain is tried that doesn't match.
    """
    labels = F.split(F.lower("__name"), r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    names = df.select(F.col(column).alias("__name")).distinct().withColumn("__suffix", F.explode(suffixes))
    hit = names.join(excepted.select(F.lower("domain").alias("__suffix")).distinct(), "__suffix").select("__name").distinct()
    return df.join(hit, df[column] == hit["__name"], "left_anti")

"""Mail senders: flows score points, hosts gather them over windows, and a logistic score names spammers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.numbers import logistic
from sluice.operators.filters import mail

WIDTH, SURE = 300, 0.9
SPAM_BIT = 0x40000000
#: Status bits of errors (codes 421 to 555, bits 8 to 23, and unknown codes).
ERROR_BITS = sum(1 << b for b in range(8, 24)) | 1 << 31


def flow_score() -> Column:
    """Points of a mail flow with smtp_status (bits), sender and recipient."""
    status = F.coalesce(F.col("smtp_status"), F.lit(0).cast("long"))
    known = F.col("sender").isNotNull() | F.col("recipient").isNotNull() | F.col("smtp_status").isNotNull()
    extra = F.when(status.bitwiseAND(F.lit(SPAM_BIT)) != 0, 5).otherwise(0) + F.when(F.coalesce("sender", F.lit("")) == "", 1).otherwise(0) + F.when(F.coalesce("recipient", F.lit("")) == "", 1).otherwise(0) + F.bit_count(status.bitwiseAND(F.lit(ERROR_BITS)))
    return F.when(known, extra).otherwise(0) - F.when(F.col("tcp_flags") > 2, 1).otherwise(0)


def entities(flows: DataFrame, width: int = WIDTH) -> DataFrame:
    """host, start, what it sent and received, different peers, mean score, first mail names."""
    f = flows.filter(mail()).withColumns({"score": flow_score(), "start": F.col("t_last") - F.col("t_last") % width})
    by_peer = f.groupBy(F.col("src_ip").alias("host"), "start", F.col("dst_ip").alias("peer")).agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"), F.sum("packets").alias("packets"), F.sum("score").alias("points"), F.array_sort(F.collect_set("sender")).alias("senders"))
    out = by_peer.groupBy("host", "start").agg(F.sum("n").alias("outgoing"), F.sum("bytes").alias("sent_bytes"), F.sum("packets").alias("sent_packets"), F.count("*").alias("peers"), F.sum("points").alias("points"), F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("senders")))), 1, 5).alias("senders"))
    into = f.groupBy(F.col("dst_ip").alias("host"), "start").agg(F.count("*").alias("incoming"), F.sum("bytes").alias("received_bytes"))
    both = out.join(into, ["host", "start"], "full_outer")
    return both.select("host", "start", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("outgoing", "incoming", "sent_bytes", "received_bytes", "sent_packets", "peers", "points")), "senders")


def entity_score() -> Column:
    c = F.col
    mean = F.when(c("outgoing") > 0, c("points") / c("outgoing")).otherwise(0.0)
    return mean + F.when((c("incoming") == 0) & (c("outgoing") > 0), F.ln("outgoing")).otherwise(0.0) + F.when(c("peers") > 10, 1).otherwise(-1) + F.when(c("outgoing") > 0, F.when(c("incoming") / c("outgoing") > 1.2, -1).otherwise(1)).otherwise(-1)


def spammers(found: DataFrame, sure: float = SURE) -> DataFrame:
    """Hosts whose confidence exceeds the threshold."""
    return found.withColumn("confidence", logistic(entity_score())).filter(F.col("confidence") > sure)

"""Backscatter of attacks with spoofed sources: features of each victim, a model's probability, scale."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions import ip

SURE = 0.99
FEATURES = ("tcp", "udp", "icmp", "dst_ips_share", "dst_ports_share", "src_ports_share", "subnets_share", "duration", "rate", "packets_share", "bytes_share")


def gated(victims: DataFrame, own: list[tuple[int, int]], least_flows: int = 30, least: int = 30, most: int = 7200) -> DataFrame:
    """IPv4 victims outside the own networks (network, prefix) that lasted long enough and had enough flows."""
    inside = F.lit(False)
    for network, prefix in own:
        inside |= ip.mask(F.col("src_ip"), prefix) == network
    return victims.filter(F.col("src_ip").isNotNull() & ~inside & (F.col("flows") >= least_flows) & (F.col("t_end") - F.col("t_start")).between(least, most))


def observed(flows: DataFrame, *more: str) -> DataFrame:
    """One row for each source and protocol (and further keys) with what a classifier needs."""
    return flows.groupBy("src_ip", "protocol", *more).agg(F.count("*").alias("flows"), F.sum("packets").alias("packets"), F.sum("bytes").alias("bytes"), F.count_distinct("dst_ip").alias("dst_ips"), F.count_distinct("dst_port").alias("dst_ports"), F.count_distinct("src_port").alias("src_ports"), F.count_distinct(ip.mask(F.col("dst_ip"), 24)).alias("subnets"), F.min("t_first").alias("t_start"), F.max("t_last").alias("t_end"))


def features(victims: DataFrame) -> DataFrame:
    """victims with FEATURES."""
    n = F.col("flows").cast("double")
    duration = F.greatest(F.col("t_end") - F.col("t_start"), F.lit(1)).cast("double")
    return victims.withColumns(
        {p: (F.col("protocol") == k).cast("double") for p, k in (("tcp", 6), ("udp", 17), ("icmp", 1))}
        | {f"{c}_share": F.col(c) / n for c in ("dst_ips", "dst_ports", "src_ports", "subnets", "packets", "bytes")}
        | {"duration": duration, "rate": n / duration}
    )


def classified(ready: DataFrame, probability: Callable[[pd.DataFrame], pd.Series], sure: float = SURE) -> DataFrame:
    """Rows whose probability exceeds the threshold. The model is a function of a pandas table of FEATURES."""

    @F.pandas_udf(T.DoubleType())
    def p(x: pd.DataFrame) -> pd.Series:
        return probability(x)

    return ready.withColumn("probability", p(F.struct(*FEATURES))).filter(F.col("probability") > sure)


def trained(labelled: DataFrame, seed: int = 7, rounds: int = 40) -> PipelineModel:
    """A scaler and a classifier over FEATURES, fitted on rows with a `label` (0 or 1).

    Gradient-boosted trees, grown by Spark from per-feature histograms, so the rows never leave their partitions.
    """
    stages = [VectorAssembler(inputCols=list(FEATURES), outputCol="raw", handleInvalid="skip"), StandardScaler(inputCol="raw", outputCol="scaled"), GBTClassifier(featuresCol="scaled", labelCol="label", seed=seed, maxIter=rounds, maxDepth=4)]
    return Pipeline(stages=stages).fit(labelled)


def judged(ready: DataFrame, model: PipelineModel) -> DataFrame:
    """Rows with the model's probability of label 1."""
    kept = ready.columns
    return model.transform(ready).select(*kept, vector_to_array("probability")[1].alias("probability"))


def whole_internet(count: Column, monitored: int) -> Column:
    """A count scaled from the monitored addresses to all."""
    return count * (2**32 / monitored)

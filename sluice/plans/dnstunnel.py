"""Tunnels in DNS: strange names and answers of each client in rounds of a minute."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import text
from sluice.operators.aggregates import clipped_histogram, domain_figures, moments
from sluice.operators.keyed import run_keyed

ROUND = 60
REQUEST_BINS, RESPONSE_BINS, STEP = 30, 150, 10
RECORD_KINDS = {2: "ns", 5: "cname", 15: "mx", 16: "txt"}
STATE = "client long, round long, state string, rounds long"


@dataclass(frozen=True)
class Limits:
    """The detector's defaults."""

    name_length: int = 100
    name_letters: int = 25
    name_digits: int = 15
    name_digit_share: float = 0.3
    answer_letters: int = 30
    count: int = 10_000
    request_mean: tuple[int, int] = (70, 100)
    request_variance: tuple[int, int] = (30, 150)
    response_mean: tuple[int, int] = (70, 600)
    response_variance: tuple[int, int] = (200, 50_000)
    inserts: int = 150
    share: float = 0.9
    main_share: float = 0.8
    close_inserts: int = 30
    close_share: float = 0.98
    close_length: int = 60
    answer_inserts: int = 50
    same_share: float = 0.005


def packets(flows: DataFrame) -> DataFrame:
    """client, round, is_request, size, name and answers by record kind. Requests go to port 53."""
    request = F.col("dst_port") == 53
    answers = {k: F.when(~request & (F.col("dns_qtype") == n), F.col("dns_rdata")) for n, k in RECORD_KINDS.items()}
    name = F.when(F.length("dns_name") >= 126, F.concat(F.regexp_replace(F.substring("dns_name", 1, 125), r"[^.]*$", ""), F.lit("*"))).otherwise(F.col("dns_name"))
    return flows.select(F.when(request, F.col("src_ip")).otherwise(F.col("dst_ip")).alias("client"), (F.col("t_last") - F.col("t_last") % ROUND).alias("round"), request.alias("is_request"), F.col("bytes").alias("size"), name.alias("name"), *(a.alias(k) for k, a in answers.items()))


def strange_name(name: Column, limits: Limits = Limits()) -> Column:
    digits, n = text.digit_count(name), F.length(name)
    return (n >= limits.name_length) & ((text.distinct_chars(name) > limits.name_letters) | ((digits / n > limits.name_digit_share) & (digits > limits.name_digits)))


def strange_answer(answer: Column, limits: Limits = Limits()) -> Column:
    return F.coalesce(text.distinct_chars(answer) > limits.answer_letters, F.lit(False))


def sizes(seen: DataFrame) -> DataFrame:
    """By client, round and way: n, mean and variance of sizes."""
    return seen.groupBy("client", "round", "is_request").agg(*moments("size"))


def histograms(seen: DataFrame) -> DataFrame:
    keys = ["client", "round", "is_request"]
    request = clipped_histogram(seen.filter("is_request"), keys, "size", STEP, REQUEST_BINS)
    return request.union(clipped_histogram(seen.filter("not is_request"), keys, "size", STEP, RESPONSE_BINS))


def letters_by_size(seen: DataFrame) -> DataFrame:
    """client, bin and the mean number of different characters of names."""
    return seen.filter("is_request").groupBy("client", F.least(F.floor(F.col("size") / STEP), F.lit(REQUEST_BINS - 1)).alias("bin")).agg(F.avg(text.distinct_chars(F.col("name"))).alias("letters"), F.count("*").alias("n"))


def fullest_bin(hist: DataFrame, keys: list[str]) -> DataFrame:
    """The fullest bin; of equal ones the first."""
    return hist.groupBy(*keys).agg(F.max_by("bin", F.struct("n", -F.col("bin"))).alias("bin"), F.max("n").alias("n"))


def other_anomalies(seen: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Rounds with very many packets of an unusual size."""

    def beyond(column: str, bounds: tuple[int, int]) -> Column:
        return ~F.col(column).between(*bounds)

    odd = F.when(F.col("is_request"), beyond("mean", limits.request_mean) | beyond("variance", limits.request_variance)).otherwise(beyond("mean", limits.response_mean) | beyond("variance", limits.response_variance))
    return sizes(seen).filter((F.col("n") > limits.count) & odd)


def tunnels(seen: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """client, round and kind (request or response) of confirmed tunnels, with the figures that confirm them."""
    ask = seen.filter(F.col("is_request") & strange_name(F.col("name"), limits)).select(F.struct("client", "round").alias("k"), "name")
    f = domain_figures(ask, "k", "name").join(ask.groupBy("k").agg(F.max(F.length("name")).alias("longest")), "k")
    once, different = F.col("once") / F.col("inserts"), F.col("different") / F.col("inserts")
    wide = (F.col("inserts") > limits.inserts) & (once > limits.share) & (different > limits.share) & (F.col("main_share") > limits.main_share)
    close = (F.col("inserts") > limits.close_inserts) & (once > limits.close_share) & (different > limits.close_share) & (F.col("longest") > limits.close_length)
    requests = f.filter(wide | close).select("k", F.lit("request").alias("kind"), "inserts", "different", "once")
    strings = seen.filter(~F.col("is_request")).select(F.struct("client", "round").alias("k"), F.explode(F.array_compact(F.array("name", *RECORD_KINDS.values()))).alias("name")).filter(strange_answer(F.col("name"), limits))
    g = domain_figures(strings, "k", "name")
    answers = g.filter((F.col("inserts") > limits.answer_inserts) & (once > limits.share) & (different > limits.share)).select("k", F.lit("response").alias("kind"), "inserts", "different", "once")
    return requests.union(answers).select("k.client", "k.round", "kind", "inserts", "different", "once")


class Rounds:
    """NEW, SUSPICION, ATTACK of a client over its rounds; after `calm` rounds without a sign it is NEW again."""

    def __init__(self, calm_suspicion: int = 3, calm_attack: int = 5):
        self.calm = {"SUSPICION": calm_suspicion, "ATTACK": calm_attack}
        self.state, self.rounds = "NEW", 0

    def row(self, r: dict[str, Any]) -> list[dict[str, Any]]:
        before = self.state
        if r["confirmed"]:
            self.state, self.rounds = "ATTACK", 0
        elif r["strange"] and self.state == "NEW":
            self.state, self.rounds = "SUSPICION", 0
        elif self.state != "NEW":
            self.rounds += 1
            if self.rounds > self.calm[self.state]:
                self.state, self.rounds = "NEW", 0
        return [{"client": r["client"], "round": r["round"], "state": self.state, "rounds": self.rounds}] if self.state != before else []

    def end(self) -> list[dict[str, Any]]:
        return []


def states(seen: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Changes of state; rounds without packets aren't rounds."""
    strange = F.count_if((F.col("is_request") & strange_name(F.col("name"), limits)) | (~F.col("is_request") & strange_answer(F.coalesce("txt", "cname", "mx", "ns", "name"), limits))) > 0
    confirmed = tunnels(seen, limits).select("client", "round", F.lit(True).alias("confirmed")).distinct()
    r = seen.groupBy("client", "round").agg(strange.alias("strange")).join(confirmed, ["client", "round"], "left").withColumn("confirmed", F.coalesce("confirmed", F.lit(False)))
    return run_keyed(r, ["client"], ["round"], Rounds, STATE)

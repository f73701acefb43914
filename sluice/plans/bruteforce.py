"""Password guessing over SSH, RDP and Telnet: flows that look alike, counted over a host's last flows."""

from __future__ import annotations

from collections import deque
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.operators.aggregates import upper_median_of_last
from sluice.operators.filters import scan_shaped, signature, ssh_ignored
from sluice.operators.keyed import run_keyed
from sluice.operators.running import running_sum
from sluice.schema import ACK, FIN, PSH, RST, SYN, TCP

LIST, BOTTOM, MATCHES, SHARE = 1000, 50, 30, 0.9
SAP = SYN | ACK | PSH
PORTS = {"ssh": 22, "rdp": 3389, "telnet": 23}
#: Fixed values: (flags, (least, most packets), (least, most bytes)) of each service's incoming and outgoing flows.
SIGNATURES = {
    "ssh": ([(SAP, (11, 30), (1000, 5000))], [(SAP, (11, 50), (1000, 11000))]),
    "rdp": (
        [(SAP | RST, (7, 11), (1500, 2000)), (SAP, (3, 3), (100, 200)), (SAP, (20, 100), (2200, 8001))],
        [(SAP, (7, 7), (1700, 2200)), (SAP, (2, 2), (81, 119)), (SAP, (30, 190), (3000, 180000))],
    ),
    "telnet": ([(SAP, (9, 50), (450, 3000))], [(SAP | FIN, (6, 1 << 31), (0, 1 << 31))]),
}
ALERT = "host long, seq long, state string, scale long, ts long, victims string"


def _any(signatures: list[tuple[int, tuple[int, int], tuple[int, int]]]) -> Column:
    out = F.lit(False)
    for s in signatures:
        out |= signature(*s)
    return out


def matched(flows: DataFrame, service: str) -> DataFrame:
    """Flows of the service with host (who asks), incoming (to the service) and hit (the signature holds).

    Flows shaped like a scan's are left out. Telnet answers must also lie below what the server's profile allows.
    """
    port = PORTS[service]
    incoming = F.col("dst_port") == port
    f = flows.filter((F.col("protocol") == TCP) & ((F.col("dst_port") == port) | (F.col("src_port") == port)) & ~scan_shaped())
    if service == "ssh":
        f = f.filter(~ssh_ignored())
    f = f.select("*", incoming.alias("incoming"), F.when(incoming, F.col("src_ip")).otherwise(F.col("dst_ip")).alias("host"), F.when(incoming, F.col("dst_ip")).otherwise(F.col("src_ip")).alias("victim"))
    to, back = SIGNATURES[service]
    f = f.withColumn("hit", F.when(F.col("incoming"), _any(to)).otherwise(_any(back)))
    if service == "telnet":
        server = server_profile(f)
        f = f.join(server, f["src_ip"] == server["server"], "left").withColumn("hit", F.col("hit") & (F.col("incoming") | F.coalesce((F.col("packets") <= F.col("most_packets")) & (F.col("bytes") <= F.col("most_bytes")), F.lit(False)))).drop("server", "most_packets", "most_bytes")
    return f


def server_profile(flows: DataFrame, last: int = 15) -> DataFrame:
    """server and the most packets and bytes of its answers: upper medians of the last ones, and a margin."""
    answers = flows.filter(~F.col("incoming")).filter(F.col("tcp_flags").bitwiseAND(F.lit(SAP | FIN)) == SAP | FIN).select(F.col("src_ip").alias("server"), "seq", "packets", "bytes")
    packets = upper_median_of_last(answers, ["server"], "seq", "packets", last).select("server", (F.col("median") + 5).alias("most_packets"))
    return packets.join(upper_median_of_last(answers, ["server"], "seq", "bytes", last).select("server", (F.col("median") + 500).alias("most_bytes")), "server")


def last_n(hits: DataFrame, n: int = LIST) -> DataFrame:
    """hits with, for each flow, the size of its host's list and the matches in it (lists of the last n of each way).

    Place and matches so far are running sums; what a list has lost are the matches up to the row n places before,
    which a join by place finds. So a host with very many flows is many tasks' work.
    """
    key = ["host", "incoming"]
    placed = running_sum(hits.withColumn("__one", F.lit(1)), key, "seq", "__one", "__place")
    placed = running_sum(placed.withColumn("__hit", F.col("hit").cast("long")), key, "seq", "__hit", "__so_far").drop("__one", "__hit")
    lost = placed.select(*key, (F.col("__place") + n).alias("__place"), F.col("__so_far").alias("__lost"))
    both = placed.join(lost, [*key, "__place"], "left")
    return both.withColumns({"list_size": F.least("__place", F.lit(n)).cast("long"), "list_matches": F.col("__so_far") - F.coalesce("__lost", F.lit(0))}).drop("__place", "__so_far", "__lost")


def needed(n_in: int, n_out: int, bottom: int = BOTTOM, matches: int = MATCHES) -> int:
    """Matches that make an attack: few flows, a fixed number; many, nine tenths of the longer list."""
    if n_in <= bottom or n_out <= bottom:
        return matches
    longer = max(n_in, n_out)
    return int(longer * SHARE) if longer < 100 else longer // 100 * 90


class Guessing:
    """NEW, then ATTACK reports every `every` seconds while enough flows match, then END.

    Reports name the victims: the servers of the matching flows of either list, each once and in order.
    """

    def __init__(self, every: int = 300, least_share: float = 20.0, least_events: int = 20, size: int = LIST, matches: int = MATCHES, bottom: int = BOTTOM):
        self.every, self.least_share, self.least_events, self.need = every, least_share, least_events, (bottom, matches)
        self.lists = {True: deque(maxlen=size), False: deque(maxlen=size)}
        self.hits = {True: 0, False: 0}
        self.since: dict[bool, list[int]] = {True: [0, 0], False: [0, 0]}
        self.reported: int | None = None
        self.seen: dict[str, Any] = {}

    def told(self, state: str, scale: int) -> dict[str, Any]:
        return {"host": self.seen["host"], "seq": self.seen["seq"], "state": state, "scale": scale, "ts": self.seen["t_last"], "victims": "I:" + self.named(True) + ";O:" + self.named(False)}

    def named(self, way: bool) -> str:
        return ",".join(map(str, sorted({v for hit, v in self.lists[way] if hit and v is not None})))

    def row(self, r: dict[str, Any]) -> list[dict[str, Any]]:
        self.seen, way = r, r["incoming"]
        line = self.lists[way]
        if len(line) == line.maxlen:
            self.hits[way] -= line[0][0]
        line.append((r["hit"], r.get("victim")))
        self.hits[way] += r["hit"]
        if self.reported is None:
            limit = needed(len(self.lists[True]), len(self.lists[False]), *self.need)
            if max(self.hits.values()) < limit:
                return []
            self.reported, self.since = r["t_last"], {True: [0, 0], False: [0, 0]}
            return [self.told("NEW", limit)]
        self.since[way][0] += 1
        self.since[way][1] += r["hit"]
        if r["t_last"] - self.reported < self.every:
            return []
        scale = max(m for _, m in self.since.values())
        share = max(100.0 * m / n if n else 0.0 for n, m in self.since.values())
        if share < self.least_share:
            self.reported = None
            return [self.told("REPORT_END" if scale >= self.least_events else "END", scale)]
        if scale < self.least_events:
            return []
        self.reported, self.since = r["t_last"], {True: [0, 0], False: [0, 0]}
        return [self.told("ATTACK", scale)]

    def end(self) -> list[dict[str, Any]]:
        return [self.told("END", max(m for _, m in self.since.values()))] if self.reported is not None else []


def attacks(flows: DataFrame, service: str, **settings: Any) -> DataFrame:
    hits = matched(flows, service).select("host", "seq", "incoming", "hit", "victim", "t_last")
    return run_keyed(hits, ["host"], ["seq"], lambda: Guessing(**settings), ALERT)

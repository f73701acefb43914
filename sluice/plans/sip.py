"""SIP password guessing: one client and user (BF), many clients of one user (DBF), many users from one client (SCAN)."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from heapq import heappop, heappush
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions import text
from sluice.operators.filters import sip_register_answer
from sluice.operators.keyed import run_keyed

ATTEMPTS, CLIENTS, USERS, OKS = 50, 5, 25, 5
IDLE, CHECK = 1800, 300
EVENT = "server long, kind string, client long, user string, attempts long, parties long, breach long, ts_first long, ts_last long"


def answers(messages: DataFrame) -> DataFrame:
    """Answers to REGISTER: server, client, user, ok, t_last, seq. The answer's source is the server."""
    user = F.concat_ws("@", text.sip_user(F.col("sip_calling_party")), text.sip_host(F.col("sip_calling_party")))
    return messages.filter(sip_register_answer()).select(F.col("src_ip").alias("server"), F.col("dst_ip").alias("client"), user.alias("user"), (F.col("sip_status_code") == 200).alias("ok"), "t_last", "seq")


def summary(messages: DataFrame) -> DataFrame:
    """server, user, clients, attempts and whole attempts a client, over all time."""
    a = answers(messages).filter(~F.col("ok")).groupBy("server", "user", "client").agg(F.count("*").alias("n"))
    return a.groupBy("server", "user").agg(F.count("*").alias("clients"), F.sum("n").alias("attempts"), F.floor(F.sum("n") / F.count("*")).alias("each"))


class Queue:
    """Parties by a time that is no later than their last message; each party has one entry that counts.

    A party that gets an earlier time leaves its old entry behind, which is thrown away when its turn comes. So entries
    are as many as parties and earlier times, and never grow with what is put back.
    """

    def __init__(self) -> None:
        self.heap: list[tuple[int, Any]] = []
        self.at: dict[Any, int] = {}

    def put(self, time: int, party: Any) -> None:
        if party not in self.at or time < self.at[party]:
            self.at[party] = time
            heappush(self.heap, (time, party))

    def before(self, time: int | None) -> Iterator[Any]:
        """Takes the parties whose time is before the given one (None: all)."""
        while self.heap and (time is None or self.heap[0][0] < time):
            at, party = heappop(self.heap)
            if self.at.get(party) == at:
                del self.at[party]
                yield party


class Server:
    """All clients and users of one server, by both; a check looks only at those that have been idle for long enough.

    Each client and each user has an entry in a queue by time, no later than its last message. At a check the entries
    that are over are taken: one whose party has been heard since goes back with the later time, the others are judged.
    Rows come by time, so that the pair of a party that was heard last is the last one of its dict.
    """

    def __init__(self, attempts: int = ATTEMPTS, clients: int = CLIENTS, users: int = USERS, idle: int = IDLE, check: int = CHECK):
        self.limits, self.idle, self.check = (attempts, clients, users), idle, check
        self.by_client: dict[int, OrderedDict[str, dict[str, Any]]] = {}
        self.by_user: dict[str, OrderedDict[int, dict[str, Any]]] = {}
        self.idle_clients, self.idle_users = Queue(), Queue()
        self.checked: int | None = None
        self.server = 0

    def row(self, r: dict[str, Any]) -> list[dict[str, Any]]:
        self.server, client, user, now = r["server"], r["client"], r["user"], r["t_last"]
        self.checked = now if self.checked is None else self.checked
        out = self.report(now) if now - self.checked >= self.check else []
        p = self.by_client.get(client, {}).get(user)
        if not r["ok"]:
            if p is None:
                p = {"n": 0, "oks": 0, "breach": None, "first": now}
                self.idle_users.put(now, user)
            p["n"] += 1
            self.hear(client, user, p, now)
        elif p and p["n"] < self.limits[0]:
            self.forget(client, user)  # a user who knows the password
        elif p:
            p["breach"] = p["breach"] or now
            p["oks"] += 1
            self.hear(client, user, p, now)
            if p["oks"] > OKS:
                self.forget(client, user)
        if client in self.by_client:
            self.idle_clients.put(now, client)
        return out

    def hear(self, client: int, user: str, p: dict[str, Any], now: int) -> None:
        """Makes the pair the one that was heard last, of its client and of its user."""
        p["last"] = now
        for parties, a, b in ((self.by_client, client, user), (self.by_user, user, client)):
            pairs = parties.setdefault(a, OrderedDict())
            pairs[b] = p
            pairs.move_to_end(b)

    def take(self, client: int, user: str) -> dict[str, Any]:
        for parties, a, b in ((self.by_client, client, user), (self.by_user, user, client)):
            p = parties[a].pop(b)
            if not parties[a]:
                del parties[a]
        return p

    def forget(self, client: int, user: str) -> None:
        """Takes a pair away; what is left of its client and user may have been idle for longer."""
        self.take(client, user)
        if user in self.by_user:
            self.idle_users.put(self.heard(self.by_user[user]), user)
        if client in self.by_client:
            self.idle_clients.put(self.heard(self.by_client[client]), client)

    @staticmethod
    def heard(pairs: OrderedDict[Any, dict[str, Any]]) -> int:
        return next(reversed(pairs.values()))["last"]

    def over(self, queue: Queue, parties: dict[Any, OrderedDict[Any, dict[str, Any]]], now: int | None) -> Iterator[Any]:
        """The parties that have been idle for long enough, each once."""
        time = None if now is None else now - self.idle
        for party in queue.before(time):
            if party in parties:
                last = self.heard(parties[party])
                if time is None or last < time:
                    yield party
                else:
                    queue.put(last, party)

    def report(self, now: int | None) -> list[dict[str, Any]]:
        self.checked, out = now, []
        attempts, clients, users = self.limits

        def told(kind: str, client: int | None, user: str | None, keys: list[tuple[int, str]]) -> None:
            ps = [self.take(*k) for k in keys]
            out.append({"server": self.server, "kind": kind, "client": client, "user": user, "attempts": sum(p["n"] for p in ps), "parties": len(ps), "breach": min((p["breach"] for p in ps if p["breach"]), default=None), "ts_first": min(p["first"] for p in ps), "ts_last": max(p["last"] for p in ps)})

        for client in self.over(self.idle_clients, self.by_client, now):
            # until it is heard again nothing more can come of one that has too few users
            if len(self.by_client[client]) >= users:
                told("SCAN", client, None, [(client, user) for user in self.by_client[client]])
        for user in self.over(self.idle_users, self.by_user, now):
            pairs = self.by_user[user]
            if len(pairs) >= clients and sum(p["n"] for p in pairs.values()) >= attempts:
                told("DBF", None, user, [(client, user) for client in pairs])
            else:
                for client, p in list(pairs.items()):
                    if p["n"] >= attempts:
                        told("BF", client, user, [(client, user)])
                    else:
                        self.take(client, user)
        return out

    def end(self) -> list[dict[str, Any]]:
        return self.report(None)


def attacks(messages: DataFrame, **settings: Any) -> DataFrame:
    return run_keyed(answers(messages), ["server"], ["t_last", "seq"], lambda: Server(**settings), EVENT)

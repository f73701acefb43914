"""Dial-plan guessing: a caller tries many numbers that share their ends; and calls to countries new to a caller."""

from __future__ import annotations

from heapq import heappop, heappush
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions import text
from sluice.operators.aggregates import prefixes_of
from sluice.operators.filters import sip_invite_or_ok
from sluice.operators.keyed import run_keyed
from sluice.operators.lookups import correlate_calls

LONGEST, STRINGS, COUNTRIES = 10, 10, 20
ALERT = "caller long, suffix string, strings long, tried long, ts_last long"


def calls(messages: DataFrame) -> DataFrame:
    """Invites to numbers: caller, callee, call_id, ok (answered by a 200 to the same call), t_last, seq."""
    m = messages.filter(sip_invite_or_ok()).withColumn("callee", F.substring_index(text.sip_identity(F.col("sip_called_party")), "@", 1)).withColumn("call_id", F.col("sip_call_id"))
    invites = m.filter((F.col("sip_msg_type") == "invite") & text.is_dialable(F.col("callee"))).select(F.col("src_ip").alias("caller"), "callee", "call_id", "t_last", "seq")
    answered = correlate_calls(m).select("call_id", "callee", F.col("caller_ip").alias("caller"), F.lit(True).alias("__ok")).distinct()
    return invites.join(answered, ["call_id", "callee", "caller"], "left").withColumn("ok", F.coalesce("__ok", F.lit(False))).drop("__ok")


def shared_ends(called: DataFrame, longest: int = LONGEST, strings: int = STRINGS) -> DataFrame:
    """caller, suffix and the different unanswered numbers that end with it, where there are more than `strings`.

    A number's ends are prefixes of it backwards: they are exploded and counted, so no tree is held. Of suffixes with
    the same count the longest is told.
    """
    tried = called.groupBy("caller", "callee").agg(F.max("ok").alias("ok")).filter(~F.col("ok")).select("caller", F.reverse("callee").alias("back"))
    found = prefixes_of(tried, "caller", "back", longest).filter(F.col("n") > strings)
    best = F.row_number().over(Window.partitionBy("caller", "n").orderBy(F.length("prefix").desc(), "prefix"))
    return found.withColumn("__r", best).filter("__r = 1").select("caller", F.reverse("prefix").alias("suffix"), F.col("n").alias("strings"))


class Ends:
    """Numbers by their last `longest` digits: how many end in each string, and which string has too many.

    A tree from the last digit backwards with a count at every node. Adding or taking away a number changes one path of
    `longest` nodes at most; a node whose count comes over the limit goes to a heap, where what has sunk again is thrown
    away when it comes up. Taking a node's whole subtree visits that subtree alone.
    """

    def __init__(self, longest: int = LONGEST, strings: int = STRINGS):
        self.longest, self.strings = longest, strings
        self.count: dict[str, int] = {}
        self.longer: dict[str, set[str]] = {}
        self.numbers: dict[str, set[str]] = {}  # by their longest end
        self.over: list[tuple[int, str]] = []

    def _path(self, number: str) -> list[str]:
        return [number[-n:] for n in range(1, min(self.longest, len(number)) + 1)]

    def add(self, number: str) -> None:
        path = self._path(number)
        for end, above in zip(path, [*path[1:], None], strict=True):
            self.count[end] = n = self.count.get(end, 0) + 1
            if n == self.strings + 1:
                heappush(self.over, (-len(end), end))
            if above is not None:
                self.longer.setdefault(end, set()).add(above)
        if path:
            self.numbers.setdefault(path[-1], set()).add(number)

    def take(self, number: str) -> None:
        path = self._path(number)
        for at in range(len(path) - 1, -1, -1):
            end = path[at]
            self.count[end] -= 1
            if not self.count[end]:
                del self.count[end]
                self.longer.pop(end, None)
                if at:
                    self.longer[path[at - 1]].discard(end)
        if path:
            own = self.numbers[path[-1]]
            own.discard(number)
            if not own:
                del self.numbers[path[-1]]

    def deepest(self) -> str | None:
        """The longest end that too many numbers share, of equally long ones the first."""
        while self.over:
            end = self.over[0][1]
            if self.count.get(end, 0) > self.strings:
                return end
            heappop(self.over)
        return None

    def below(self, end: str) -> list[str]:
        """All numbers with this end."""
        found, todo = [], [end]
        while todo:
            node = todo.pop()
            found += self.numbers.get(node, ())
            todo += self.longer.get(node, ())
        return found


class Caller:
    """Numbers that one caller tries; a check every `every` seconds, an alert forgets the numbers that it tells.

    Each row and each number told costs a path of the tree, whatever the caller has tried before.
    """

    def __init__(self, longest: int = LONGEST, strings: int = STRINGS, every: int = 60):
        self.every = every
        self.numbers: dict[str, bool] = {}
        self.ends = Ends(longest, strings)
        self.checked: int | None = None
        self.caller = 0
        self.last = 0

    def row(self, r: dict[str, Any]) -> list[dict[str, Any]]:
        self.caller, self.last = r["caller"], r["t_last"]
        self.checked = r["t_last"] if self.checked is None else self.checked
        out = self.check() if r["t_last"] - self.checked >= self.every else []
        number, before = r["callee"], self.numbers.get(r["callee"])
        self.numbers[number] = now = bool(before) or bool(r["ok"])
        if before is None and not now:
            self.ends.add(number)
        elif before is False and now:
            self.ends.take(number)
        return out

    def check(self) -> list[dict[str, Any]]:
        self.checked, out = self.last, []
        while (deepest := self.ends.deepest()) is not None:
            gone = self.ends.below(deepest)
            out.append({"caller": self.caller, "suffix": deepest, "strings": len(gone), "tried": len(self.numbers), "ts_last": self.last})
            for x in gone:
                self.ends.take(x)
                del self.numbers[x]
        return out

    def end(self) -> list[dict[str, Any]]:
        return self.check()


def guesses(called: DataFrame, **settings: Any) -> DataFrame:
    return run_keyed(called.select("caller", "callee", "ok", "t_last", "seq"), ["caller"], ["t_last", "seq"], lambda: Caller(**settings), ALERT)


def new_countries(located: DataFrame, learning_until: int, allowed: list[str], most: int = COUNTRIES) -> DataFrame:
    """First calls of a caller to a country that is neither allowed nor learnt (met before learning_until, the first `most`).

    located: caller, country, t_last, seq.
    """
    known = located.filter(F.col("country").isNotNull() & ~F.col("country").isin(*allowed)) if allowed else located.filter("country is not null")
    first = known.groupBy("caller", "country").agg(F.min(F.struct("t_last", "seq")).alias("f")).select("caller", "country", "f.*")
    rank = F.row_number().over(Window.partitionBy("caller").orderBy("t_last", "seq"))
    return first.withColumn("__r", rank).filter((F.col("t_last") >= learning_until) | (F.col("__r") > most)).drop("__r")

"""Resets by pointer doubling, ranges, trees, sketches, words, kept tables and timers against plain versions."""

import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice import catalogue
from sluice.operators import hierarchy, intervals, words
from sluice.plans import hosts, scan, sip, voip
from sluice.schema import FLOW
from sluice.storage import Snapshots
from sluice.streaming import stateful, timers


@pytest.mark.parametrize(("addresses", "width"), [(5, 32), (30, 16), (50, 4096), (1, 64)])
def test_resets_equal_the_machine_with_a_hot_key(spark, addresses, width):
    rnd, rows, t = random.Random(3), [], 0
    for i in range(2500):
        t += rnd.choice([0, 0, 1, 1, 5, 400] if i % 50 == 0 else [0, 1, 2])
        hot = rnd.random() < 0.7
        rows.append((i, 1 if hot else rnd.randint(2, 9), rnd.choice([7] * 20 + list(range(100, 140))), 1000, 80 if hot else rnd.choice([80, 81]), 6, 1, 40, 2, t, t))
    f = spark.createDataFrame(rows, FLOW)
    got, want = (sorted(map(str, df.collect())) for df in (scan.horizontal_spread(f, addresses, 300, width), scan.horizontal_all(f, addresses, 300)))
    assert got == want
    assert scan.horizontal_spread(f.limit(0), addresses, 300, width).isEmpty()


def test_ranges_equal_a_search_of_all(spark):
    rnd = random.Random(5)
    size = lambda: rnd.choice([0, 1, 10, 1000, 10**30])
    ranges = [(low := rnd.choice([rnd.randint(0, 5000), rnd.randint(0, 1 << 127)]), low + size(), f"v{rnd.randint(0, 9)}") for _ in range(400)] + [(0, (1 << 128) - 1, "all"), (9, 3, "backwards"), (40, 50, "same"), (40, 50, "same"), (40, 50, "other")]
    asked = [rnd.randint(0, 6000) for _ in range(600)] + [r[0] for r in ranges] + [min(r[1] + 1, (1 << 128) - 1) for r in ranges] + [42] * 900 + [(1 << 128) - 1]
    text = lambda n: f"{n:032x}"
    r = spark.createDataFrame([(text(a), text(b), v) for a, b, v in ranges], "low string, high string, value string")
    q = spark.createDataFrame([(i, text(a)) for i, a in enumerate(asked)], "i long, address string").repartition(5)
    found = intervals.pieces(r)
    bounds = sorted((x.low, x.high) for x in found.collect())
    assert all(a[1] < b[0] for a, b in zip(bounds, bounds[1:], strict=False))
    got = {x.i: x.owner for x in intervals.located(q, "address", found, "owner").collect()}
    want = {i: min(((b - a, v) for a, b, v in ranges if a <= x <= b))[1] for i, x in enumerate(asked)}
    assert got == want
    assert [x.owner for x in intervals.located(q.limit(3), "address", intervals.pieces(r.limit(0)), "owner").collect()] == [None] * 3


def test_addresses_without_a_range_have_none(spark):
    r = spark.createDataFrame([(f"{10:032x}", f"{20:032x}", "a"), (f"{30:032x}", f"{40:032x}", "b")], "low string, high string, value string")
    q = spark.createDataFrame([(n, f"{n:032x}") for n in (5, 10, 20, 21, 29, 30, 41)], "n long, address string")
    assert {x.n: x.value for x in intervals.located(q, "address", intervals.pieces(r)).collect()} == {5: None, 10: "a", 20: "a", 21: None, 29: None, 30: "b", 41: None}


def test_peer_sketches_are_near_and_of_one_size(spark):
    f = spark.range(60_000).select((F.col("id") % 2).alias("src_ip"), F.xxhash64("id").alias("dst_ip"), (1000 + F.col("id") % 300).alias("t_last"))
    halves = hosts.peer_halves(f)
    assert {r.n for r in halves.select(F.octet_length("peers").alias("n")).collect()} <= {r.n for r in hosts.peer_halves(f.limit(30_000)).select(F.octet_length("peers").alias("n")).collect()} | set(range(2000, 2400))
    exact = {}
    for r in f.groupBy("src_ip", (F.col("t_last") - F.col("t_last") % 150).alias("half")).agg(F.count_distinct("dst_ip").alias("n")).collect():
        for start in (r.half - 150, r.half):
            exact[r.src_ip, start] = exact.get((r.src_ip, start), 0) + r.n
    got = {(r.host, r.start): r.peers for r in hosts.peers(halves).collect()}
    assert got.keys() == exact.keys()
    assert max(abs(got[k] / n - 1) for k, n in exact.items()) < 0.05  # three times the error of 4,096 registers


def test_tree_and_path(spark):
    names = ["a.x.org"] * 3 + ["b.x.org"] * 5 + ["c.y.org"] * 7 + ["org"] * 2 + ["d.com"] * 9 + [None, "one.off"]
    df = spark.createDataFrame([(1, n) for n in names], "client long, name string")
    tree = {(r.level, r.domain): r.n for r in hierarchy.levels(df, ["client"], "name", 2).collect()}
    assert tree == {(1, "org"): 17, (1, "com"): 9, (2, "x.org"): 8, (2, "y.org"): 7, (3, "a.x.org"): 3, (3, "b.x.org"): 5, (3, "c.y.org"): 7, (2, "d.com"): 9}
    path = [(r.level, r.domain, r.n, r.share) for r in hierarchy.main_path(hierarchy.levels(df, ["client"], "name", 2), ["client"]).orderBy("level").collect()]
    assert path == [(1, "org", 17, 653), (2, "x.org", 8, 533), (3, "b.x.org", 5, 625)]


def test_answers_with_cycles_end(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "10.0.0.1"), ("d", "d"), ("d", None), (None, "a"), ("b", "c")]
    answers = spark.createDataFrame(edges, "name string, target string")
    start = spark.createDataFrame([("a",), ("d",), ("z",), (None,)], "name string")
    got = {(r.start, r.name, r.steps) for r in hierarchy.reached(start, answers).collect()}
    assert got == {("a", "a", 0), ("a", "b", 1), ("a", "c", 2), ("a", "10.0.0.1", 3), ("d", "d", 0), ("z", "z", 0)}
    assert {r.name for r in hierarchy.reached(start, answers, 1).filter("start = 'a'").collect()} == {"a", "b"}


def test_many_words_equal_a_plain_search(spark):
    rnd = random.Random(7)
    dictionary = list({"".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 8))) for _ in range(80_000)})
    texts = ["".join(rnd.choice("abcdefghx ") for _ in range(rnd.randint(0, 90))) for _ in range(60)] + [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "seq long, said string")
    got = {(r.seq, r.word): r.n for r in words.hits(df, "seq", "said", spark.createDataFrame([(w,) for w in [*dictionary, None, ""]], "word string")).collect()}
    known = set(dictionary)
    want = Counter((i, t[a:b]) for i, t in enumerate(texts) if t for a in range(len(t)) for b in range(a + 1, min(len(t), a + 8) + 1) if t[a:b] in known)
    assert len(dictionary) > 40_000 and got == want
    assert words.hits(df, "seq", "said", spark.createDataFrame([], "word string")).isEmpty()
    with pytest.raises(ValueError, match="over 10 words"):
        words.hits(df, "seq", "said", spark.createDataFrame([(w,) for w in dictionary[:20]], "word string"), most_words=10)


class PlainCaller:
    """Counts all ends of all numbers anew for each alert."""

    def __init__(self, longest, strings, every):
        self.longest, self.strings, self.every, self.numbers, self.checked, self.last = longest, strings, every, {}, None, 0

    def row(self, callee, ok, t):
        self.last = t
        self.checked = t if self.checked is None else self.checked
        out = self.check() if t - self.checked >= self.every else []
        self.numbers[callee] = self.numbers.get(callee, False) or ok
        return out

    def check(self):
        self.checked, out = self.last, []
        while True:
            ends = Counter(x[-n:] for x, ok in self.numbers.items() if not ok for n in range(1, min(self.longest, len(x)) + 1))
            over = [e for e, n in ends.items() if n > self.strings]
            if not over:
                return out
            deepest = min(over, key=lambda e: (-len(e), e))
            gone = [x for x, ok in self.numbers.items() if not ok and x.endswith(deepest)]
            out.append((deepest, len(gone), len(self.numbers), self.last))
            for x in gone:
                del self.numbers[x]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text("012", min_size=1, max_size=7), st.booleans(), st.integers(0, 3)), max_size=80), st.integers(1, 4), st.integers(1, 5))
def test_trie_of_ends_equals_counting_anew(calls, strings, longest):
    caller, plain, t = voip.Caller(longest, strings, 5), PlainCaller(longest, strings, 5), 0
    for number, ok, step in calls:
        t += step
        got = [(r["suffix"], r["strings"], r["tried"], r["ts_last"]) for r in caller.row({"caller": 1, "callee": number, "ok": ok, "t_last": t})]
        assert got == plain.row(number, ok, t)
    assert [(r["suffix"], r["strings"], r["tried"], r["ts_last"]) for r in caller.end()] == plain.check()
    left = Counter(x[-n:] for x, ok in caller.numbers.items() if not ok for n in range(1, min(longest, len(x)) + 1))
    assert caller.ends.count == left and sum(map(len, caller.ends.numbers.values())) == sum(not ok for ok in caller.numbers.values())


def test_two_runs_equal_one_and_a_died_run_changes_nothing(spark, tmp_path):
    rows = [(k, f"v{i}", i) for i, k in enumerate([3, 1, 2, 3, None, 5, 1, 6, None, 2])]
    df = spark.createDataFrame(rows, "k long, v string, at long")
    one, two = (Snapshots(spark, f"file://{tmp_path}/{n}") for n in ("one", "two"))
    one.upsert(df, ["k"], "at")
    two.upsert(df.filter("at >= 5"), ["k"], "at")  # the later half first: an older row changes nothing
    assert two.upsert(df.filter("at < 5"), ["k"], "at") == 2
    assert sorted(map(str, one.read().collect())) == sorted(map(str, two.read().collect()))
    before = sorted(map(str, two.read().collect()))
    name = two.write(df.limit(1))  # a run that dies before its marker
    assert sorted(map(str, Snapshots(spark, two.folder).read().collect())) == before and two.current()[0] == 2
    two.commit(name, 2)
    with pytest.raises(RuntimeError, match="another run"):
        two.commit(name, 2)
    assert two.read().count() == 1


def test_numbers_go_on_from_run_to_run(spark, tmp_path):
    kept = Snapshots(spark, f"file://{tmp_path}/n")
    assert kept.read() is None and kept.current() == (0, {})
    df = spark.createDataFrame([(k, i) for i, k in enumerate([30, 10, 20, 10, 40, 20, 50])], "k long, at long")
    kept.upsert(df.filter("at < 3"), ["k"], "at", "number")
    first = {r.k: r.number for r in kept.read().collect()}
    assert first == {30: 1, 10: 2, 20: 3}
    kept.upsert(df.filter("at >= 3"), ["k"], "at", "number")
    assert {r.k: (r.at, r.number) for r in kept.read().collect()} == {30: (0, 1), 10: (3, 2), 20: (5, 3), 40: (4, 4), 50: (6, 5)}
    kept.upsert(df.limit(0), ["k"], "at", "number")
    assert kept.current()[1]["last_number"] == 5 and kept.read().count() == 5


def test_records_end_by_timers_after_restarts(spark, tmp_path):
    rnd = random.Random(11)
    rows, t = [], 1_700_000_000
    for i in range(400):
        t += rnd.choice([0, 1, 3, 25, 40])
        rows.append((rnd.randint(1, 3), t, i, 1, rnd.randint(1, 5), 40))
    kind = "host long, t_last long, seq long, way int, packets long, bytes long"
    third = len(rows) // 3
    parts = [rows[: third - 5] + rows[third : third + 3], rows[third - 5 : third] + rows[third + 3 :], [(-1, t + 90_000, 0, 0, 0, 0)]]
    found = timers.run_parts(spark, [spark.createDataFrame(p, kind) for p in parts], f"file://{tmp_path}/s", lambda df: timers.host_records(stateful.with_event_time(df, "420 seconds")))
    want = []
    for host in (1, 2, 3):
        m = hosts.Timeouts()
        for r in sorted((r for r in rows if r[0] == host), key=lambda r: (r[1], r[2])):
            want += m.row({"host": r[0], "t_last": r[1], "packets": r[4], "bytes": r[5]})
        want += m.end()
    names = ("host", "flows", "packets", "bytes", "ts_first", "ts_last")
    assert sorted(tuple(r[n] for n in names) for r in found.filter("host > 0").collect()) == sorted(tuple(r[n] for n in names) for r in want)


def test_trained_classifier_knows_held_out_rows(spark, small):
    found = catalogue.queries()["backscatter_trained"](spark, small).collect()
    out = [r for r in found if r.held_out]
    most_frequent = max(sum(r.label == k for r in out) for k in (0, 1)) / len(out)
    assert len(out) > 60 and sum(r.label == r.predicted for r in out) / len(out) > most_frequent + 0.1


class PlainServer:
    """Walks all pairs at each check."""

    def __init__(self, attempts, clients, users, idle, check):
        self.limits, self.idle, self.check = (attempts, clients, users), idle, check
        self.pairs= {}
        self.checked = None
        self.server = 0

    def row(self, r):
        self.server, key, now = r["server"], (r["client"], r["user"]), r["t_last"]
        self.checked = now if self.checked is None else self.checked
        out = self.report(now) if now - self.checked >= self.check else []
        p = self.pairs.get(key)
        if not r["ok"]:
            p = self.pairs.setdefault(key, {"n": 0, "oks": 0, "breach": None, "first": now})
            p["n"] += 1
            p["last"] = now
        elif p and p["n"] < self.limits[0]:
            del self.pairs[key]  # a user who knows the password
        elif p:
            p["breach"] = p["breach"] or now
            p["oks"] += 1
            p["last"] = now
            if p["oks"] > sip.OKS:
                del self.pairs[key]
        return out

    def report(self, now):
        self.checked, out = now, []
        attempts, clients, users = self.limits
        due = lambda ps: now is None or all(now - p["last"] > self.idle for p in ps)

        def told(kind, client, user, keys):
            ps = [self.pairs.pop(k) for k in keys]
            out.append({"server": self.server, "kind": kind, "client": client, "user": user, "attempts": sum(p["n"] for p in ps), "parties": len(ps), "breach": min((p["breach"] for p in ps if p["breach"]), default=None), "ts_first": min(p["first"] for p in ps), "ts_last": max(p["last"] for p in ps)})

        by_client = {}
        for k in self.pairs:
            by_client.setdefault(k[0], []).append(k)
        for client, keys in by_client.items():
            if len(keys) >= users and due([self.pairs[k] for k in keys]):
                told("SCAN", client, None, keys)
        by_user = {}
        for k in self.pairs:
            by_user.setdefault(k[1], []).append(k)
        for user, keys in by_user.items():
            if not due([self.pairs[k] for k in keys]):
                continue
            if len(keys) >= clients and sum(self.pairs[k]["n"] for k in keys) >= attempts:
                told("DBF", None, user, keys)
            else:
                for k in keys:
                    if self.pairs[k]["n"] >= attempts:
                        told("BF", k[0], user, [k])
                    else:
                        del self.pairs[k]
        return out

    def end(self):
        return self.report(None)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from("abcd"), st.integers(0, 4).map(lambda x: x == 0), st.integers(0, 9)), max_size=120))
def test_queues_of_idle_parties_equal_walking_all(messages):
    limits, t = {"attempts": 3, "clients": 2, "users": 2, "idle": 12, "check": 7}, 0
    ours, plain, got, want = sip.Server(**limits), PlainServer(**limits), [], []
    for client, user, ok, step in messages:
        t += step
        r = {"server": 1, "client": client, "user": user, "ok": ok, "t_last": t}
        got += sorted(map(str, ours.row(r)))
        want += sorted(map(str, plain.row(r)))
        assert got == want
        assert {(c, u) for c, us in ours.by_client.items() for u in us} == set(plain.pairs)
    assert sorted(map(str, ours.end())) == sorted(map(str, plain.end()))


def test_queues_of_idle_parties_stay_as_small_as_the_parties():
    server = sip.Server(attempts=3, clients=2, users=2)
    for i in range(40000):  # four clients and five users that are never idle; every seventh answer is 200
        server.row({"server": 1, "client": i % 4, "user": "abcde"[i % 5], "ok": i % 7 == 0, "t_last": 12 * i})
    assert len(server.idle_clients.heap) < 400 and len(server.idle_users.heap) < 400

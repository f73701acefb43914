"""State machines against plain models, and edges of thresholds and gaps."""

from hypothesis import given
from hypothesis import strategies as st

from sluice.plans import amplification, bruteforce, dnstunnel, flood, hosts, miner, scan, sip, voip
from sluice.plans.blacklist import Scenario


def run(machine, rows):
    return [x for r in rows for x in machine.row(r)] + machine.end()


def probe(seq, port, t=None, dst=1):
    return {"src_ip": 9, "dst_ip": dst, "dst_port": port, "seq": seq, "t_first": t if t is not None else seq, "t_last": t if t is not None else seq}


def test_vertical_threshold_and_restart():
    assert not run(scan.Vertical(5), [probe(i, i) for i in range(4)])
    alerts = run(scan.Vertical(5), [probe(i, i) for i in range(10)])
    assert [(a["seq"], a["port_cnt"], a["ts_first"], a["ts_last"]) for a in alerts] == [(4, 5, 0, 4), (9, 5, 5, 9)]


def test_vertical_toggles():
    ports = [1, 2, 2, 3, 4, 5, 2]  # 2 opens, closes and opens
    assert [a["seq"] for a in run(scan.Vertical(5), [probe(i, p) for i, p in enumerate(ports)])] == [6]


def test_vertical_gap_of_300_holds_and_301_restarts():
    for gap, n in ((300, 1), (301, 0)):
        rows = [probe(0, 1, 0), probe(1, 2, 0), probe(2, 3, gap)]
        assert len(run(scan.Vertical(3), rows)) == n


@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 400)), max_size=60))
def test_vertical_model(steps):
    t, rows = 0, []
    for i, (port, gap) in enumerate(steps):
        t += gap
        rows.append(probe(i, port, t))
    found, ports, last = [], set(), None
    for r in rows:
        if last is not None and r["t_last"] - last > 300:
            ports = set()
        last = r["t_last"]
        ports = ports - {r["dst_port"]} if r["dst_port"] in ports else ports | {r["dst_port"]}
        if len(ports) == 3:
            found.append(r["seq"])
            ports = set()
    assert [a["seq"] for a in run(scan.Vertical(3), rows)] == found


def test_horizontal_keeps_and_trails():
    rows = [probe(i, 80, i, dst) for i, dst in enumerate([1, 2, 2, 3, 4, 5])] + [probe(9, 80, 400, 6)]
    alerts = run(scan.Horizontal(3), rows)
    assert [(a["seq"], a["addr_cnt"], a["trailing"]) for a in alerts] == [(3, 3, False), (5, 2, True)]
    assert alerts[0]["samples"] == [1, 2, 3]


def test_flood_lifecycle():
    minutes = [{"dst_net": 1, "minute": 60 * i, "bytes": b, "sources": s} for i, (b, s) in enumerate([(10, 1)] * 3 + [(100, 9)] * 8 + [(10, 1)])]
    told = run(flood.Lifecycle(4, 4, 50), minutes)
    assert [t["ended"] for t in told] == [False, True]
    assert all(t["started"] == 180 for t in told)
    assert run(flood.Lifecycle(4, 4, 100), minutes) == []


def test_needed_matches():
    assert bruteforce.needed(50, 2000) == 30
    assert bruteforce.needed(51, 60) == 54
    assert bruteforce.needed(51, 250) == 180


def guess(seq, hit, t=None, incoming=True):
    return {"host": 1, "seq": seq, "incoming": incoming, "hit": hit, "t_last": t if t is not None else seq}


def test_guessing_states():
    rows = [guess(i, True) for i in range(30)] + [guess(30 + i, True, 329 + i) for i in range(30)] + [guess(90 + i, False, 700 + i) for i in range(5)]
    assert [x["state"] for x in run(bruteforce.Guessing(), rows)][:2] == ["NEW", "ATTACK"]
    assert run(bruteforce.Guessing(), [guess(i, True) for i in range(29)]) == []


@given(st.lists(st.booleans(), max_size=80))
def test_last_flows_window(hits):
    g = bruteforce.Guessing(size=10, matches=6, every=10**9)
    first = next((i for i in range(len(hits)) if sum(hits[max(0, i - 9) : i + 1]) >= 6), None)
    alerts = [x for i, h in enumerate(hits) for x in g.row(guess(i, h))]
    assert [a["seq"] for a in alerts] == ([] if first is None else [first])


def call(user, client, ok, t):
    return {"server": 1, "client": client, "user": user, "ok": ok, "t_last": t, "seq": t}


def test_sip_kinds():
    bf = [call("u", 1, False, i) for i in range(50)]
    assert [(e["kind"], e["attempts"]) for e in run(sip.Server(), bf)] == [("BF", 50)]
    assert run(sip.Server(), bf[:49]) == []
    assert run(sip.Server(), [*bf[:49], call("u", 1, True, 60)]) == []
    breach = run(sip.Server(), [*bf, call("u", 1, True, 60)])
    assert breach[0]["breach"] == 60
    dbf = [call("u", i % 5, False, i) for i in range(60)]
    assert [e["kind"] for e in run(sip.Server(), dbf)] == ["DBF"]
    scanned = [call(f"u{i}", 1, False, i) for i in range(25)]
    assert [e["kind"] for e in run(sip.Server(), scanned)] == ["SCAN"]
    assert run(sip.Server(), scanned[:24]) == []


def test_sip_false_positive():
    rows = [call("u", 1, False, i) for i in range(50)] + [call("u", 1, True, 60 + i) for i in range(6)]
    assert run(sip.Server(), rows) == []


def dial(number, ok=False, t=0):
    return {"caller": 1, "callee": number, "ok": ok, "t_last": t, "seq": t}


def test_dial_plan():
    rows = [dial(f"{i:03d}420777", t=i) for i in range(11)]
    found = run(voip.Caller(longest=6), rows)
    assert [(f["suffix"], f["strings"]) for f in found] == [("420777", 11)]
    assert run(voip.Caller(longest=6), rows[:10]) == []
    assert run(voip.Caller(longest=6), [*rows[:10], dial("010420777", True, 10)]) == []


def test_dns_rounds():
    rows = [{"client": 1, "round": i, "strange": s, "confirmed": c} for i, (s, c) in enumerate([(False, False), (True, False), (True, True), *[(False, False)] * 6])]
    assert [x["state"] for x in run(dnstunnel.Rounds(), rows)] == ["SUSPICION", "ATTACK", "NEW"]


def test_record_timeouts():
    rows = [{"host": 1, "t_last": t, "packets": 1, "bytes": 10} for t in (0, 10, 39, 69, 98)]
    assert [(r["flows"], r["ts_first"], r["ts_last"]) for r in run(hosts.Timeouts(), rows)] == [(3, 0, 39), (2, 69, 98)]
    long = [{"host": 1, "t_last": t, "packets": 1, "bytes": 10} for t in range(0, 400, 20)]
    assert [r["flows"] for r in run(hosts.Timeouts(), long)] == [15, 5]


def test_suspect_exports():
    rows = [{"src_ip": 1, "dst_ip": 2, "dst_port": 3, "packets": 1, "bytes": 1, "t_first": t, "t_last": t} for t in (0, 60, 121, 130)]
    assert [r["flows"] for r in run(miner.Suspect(), rows)] == [2, 2]


def test_scenarios():
    rows = [{"entity": 1, "targets": [2, 3], "ts_first": 0, "ts_last": 10}, {"entity": 1, "targets": [3, 4], "ts_first": 20, "ts_last": 600}, {"entity": 1, "targets": [5], "ts_first": 1201, "ts_last": 1201}]
    assert [x["adaptive"] for x in run(Scenario(), rows)] == [[2, 3, 4], [5]]


def test_amplification_history():
    limits = amplification.Limits(top=2, step=10, ratio=5, flows=2, share=0.5, rsp_packets=0, rsp_bytes=100, query_bytes=100, window=100, slide=60)
    rows = [{"server": 1, "client": 2, "is_query": q, "packets": 1, "bytes": 40 if q else 900, "t_first": t, "t_last": t} for t in range(0, 220, 10) for q in (True, False)]
    told = run(amplification.History(limits), rows)
    assert told and {t["kind"] for t in told} == {"complex"} and told[0]["ts_last"] == 110
    # a report tells what came since the judgement before it; what is older than window - slide seconds is gone
    assert [(t["ts_first"], t["ts_last"], t["q_flows"], t["r_flows"]) for t in told][:2] == [(0, 110, 12, 11), (70, 180, 7, 7)]
    assert run(amplification.History(amplification.Limits(window=100, slide=60)), rows) == []


def flow(t, size, first=None, src=1):
    return {"dst_net": 9, "src_net": src, "bytes": size, "t_first": t if first is None else first, "t_last": t}


def test_flood_ring_takes_late_flows_and_jumps():
    class Seen:
        def __init__(self):
            self.rows = []

        def row(self, r):
            self.rows.append((r["minute"], r["bytes"], r["sources"]))
            return []

        def end(self):
            return [{"rows": self.rows}]

    ring = flood.Ring(Seen, slots=3)
    assert ring.row(flow(10, 100)) == [] and ring.row(flow(70, 120, 50, 2)) == []
    ring.row(flow(130, 5))
    ring.row(flow(20, 7, src=512))  # late, but its minute is held
    assert ring.inner.rows == []
    ring.row(flow(190, 1))  # the first minute leaves the ring
    assert ring.inner.rows == [(0, 100 + 57 + 7, 1)] and ring.late == 0  # 512 and 1 share a bucket
    ring.row(flow(30, 11))
    assert ring.late == 11
    told = ring.row(flow(190 + 4 * 60, 3))  # a jump beyond the ring starts anew
    assert told == [{"rows": [(0, 164, 1), (60, 63, 1), (120, 5, 1), (180, 1, 1)]}]
    assert ring.end() == [{"rows": [(420, 3, 1)]}]

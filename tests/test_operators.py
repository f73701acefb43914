"""Operators on small hand-made tables."""

import ipaddress
import random
import re

import pytest
from pyspark.sql import functions as F

from sluice.functions import bits, ip, text
from sluice.operators import aggregates, filters, lookups
from sluice.operators.running import running_sum
from sluice.plans import blacklist, flood, scan, smtp, web
from sluice.schema import FLOW, require_columns
from sluice.sources import lists, sinks

FLOW_DEFAULTS = {"seq": 0, "src_ip": 1, "dst_ip": 2, "src_port": 40000, "dst_port": 80, "protocol": 6, "packets": 1, "bytes": 60, "tcp_flags": 2, "t_first": 0, "t_last": 0}


def flows(spark, *rows):
    return spark.createDataFrame([tuple((FLOW_DEFAULTS | {"seq": i} | r)[c] for c in FLOW.names) for i, r in enumerate(rows)], FLOW)


def test_require_columns(spark):
    with pytest.raises(ValueError, match="nothing"):
        require_columns(spark.range(1), "nothing")


def test_addresses(spark):
    rows = [("1.2.3.4",), ("255.255.255.255",), ("1.2.3",), ("256.1.1.1",), ("01.2.3.4",), (None,), ("::1",)]
    got = spark.createDataFrame(rows, "a string").select(ip.ipv4_number(F.col("a")).alias("n"), ip.ipv4_text(ip.ipv4_number(F.col("a"))).alias("t"), ip.ipv6_exploded("a").alias("x")).collect()
    assert [r.n for r in got] == [0x01020304, 0xFFFFFFFF, None, None, None, None, None]
    assert got[1].t == "255.255.255.255"
    assert got[6].x == "0000:0000:0000:0000:0000:0000:0000:0001"


def test_masks(spark):
    got = spark.range(1).select(*(ip.mask(F.lit(0xC0A8017F), n).alias(f"m{n}") for n in (0, 8, 24, 31, 32))).first()
    assert list(got) == [0, 0xC0000000, 0xC0A80100, 0xC0A8017E, 0xC0A8017F]


def test_bits(spark):
    got = spark.createDataFrame([(5,), (0,), (-(1 << 63),)], "b long").select(bits.ids(F.col("b")).alias("i"), bits.is_single(F.col("b")).alias("s"), bits.saturated(F.lit(70000), 16).alias("w")).collect()
    assert [r.i for r in got] == [[1, 3], [], [64]]
    assert [r.s for r in got] == [False, False, True]
    assert got[0].w == 65535


def test_texts(spark):
    df = spark.createDataFrame([("WWW.a.com", "/x/"), ("wwww.a.com", "/"), ("www.www.a.com.", None)], "h string, p string")
    got = df.select(text.host_name(F.col("h")).alias("h"), text.url_key(F.col("h"), F.col("p")).alias("u")).collect()
    assert [tuple(r) for r in got] == [("a.com", "a.com/x"), ("wwww.a.com", "wwww.a.com"), ("www.a.com", "www.a.com.")]
    sip = spark.createDataFrame([("sips:bob@x.org;tag=1",), ("+420*1#",), ("abc",)], "s string").select(text.sip_user(F.col("s")).alias("u"), text.sip_host(F.col("s")).alias("h"), text.is_dialable(F.col("s")).alias("d")).collect()
    assert [tuple(r) for r in sip] == [("bob", "x.org", False), ("+420*1#", None, True), ("abc", None, False)]


def test_running_sum_over_buckets(spark):
    rows = [(k, i * 3, random.Random(i).randint(-5, 5)) for k in (1, 2) for i in range(50)]
    got = running_sum(spark.createDataFrame(rows, "k int, o long, v int"), ["k"], "o", "v", "s", width=17).collect()
    for r in got:
        assert r.s == sum(v for k, o, v in rows if k == r.k and o <= r.o)


def test_flow_minutes_keep_all_bytes(spark):
    f = flows(spark, *({"t_first": a, "t_last": b, "bytes": 1000} for a, b in ((0, 0), (30, 90), (59, 121), (0, 479), (100, 90))))
    got = {r.minute: r.bytes for r in flood.attributed(f.withColumn("dst_net", F.col("dst_ip"))).collect()}
    assert sum(got.values()) == 4000
    assert max(got) == 420


def test_source_buckets(spark):
    f = flows(spark, *({"src_ip": s, "t_last": 5} for s in (1, 512, 2, 3))).withColumns({"src_net": F.col("src_ip"), "dst_net": F.col("dst_ip")})
    assert aggregates.source_buckets(f).first().sources == 3


def test_ipv6_prefix_lookup(spark):
    networks = [("2001:db8::", 32, "a"), ("2001:db8:5::", 48, "b"), ("2001:db8:5::8", 125, "c"), ("::", 0, "d"), ("2001:db8:5::9", 128, "e"), ("8000::", 1, "f"), ("2001:db8:5::", 64, "g"), ("2001:db8:5:0:8000::", 65, "h")]
    addresses = ["2001:db8:5::9", "2001:DB8:0:0:0:0:0:1", "::1", "ffff::", "2001:db8:5::f", "2001:db8:5::10", "2001:db8:5:0:ffff::1", "2001:db9::"]
    prefixes = spark.createDataFrame(networks, "text string, prefix int, name string").select(ip.ipv6_bytes("text").alias("network6"), "prefix", "name")
    df = spark.createDataFrame([(a,) for a in addresses], "a string").withColumn("packed", ip.ipv6_bytes("a"))
    got = sorted((r.a, r.name) for r in lookups.prefix_matches6(df, "packed", prefixes).collect())
    assert got == sorted((a, n) for a in addresses for net, length, n in networks if ipaddress.IPv6Address(a) in ipaddress.IPv6Network((net, length)))
    assert lookups.prefix_matches6(df, "packed", prefixes.limit(0)).isEmpty()


def test_prefix_lookup_overlaps(spark):
    listed = spark.createDataFrame([(0x0A000000, 8, 1), (0x0A000100, 24, 2), (0, 0, 3)], "network long, prefix int, v int")
    df = spark.createDataFrame([(1, 0x0A000105), (2, 0x0A050505), (3, 0x0B000000)], "k int, a long")
    met = {(r.k, r.v) for r in lookups.prefix_matches(df, "a", listed).collect()}
    assert met == {(1, 1), (1, 2), (1, 3), (2, 1), (2, 3), (3, 3)}
    assert {r.k: r.v for r in lookups.longest_prefix(df, "k", "a", listed, "v").collect()} == {1: 2, 2: 1, 3: 3}
    assert lookups.prefix_matches(df, "a", listed.limit(0)).isEmpty()


def _white(rules, probe):
    """Plain model: does any rule cover the probe?"""
    src, dst, sport, dport = probe
    for net, prefix, direction, low, high in rules:
        for end, addr, port in (("src", src, sport), ("dst", dst, dport)):
            if direction in (end, "all") and addr >> (32 - prefix) == net >> (32 - prefix) and (low is None or low <= port <= (high or low)):
                return True
    return False


@pytest.mark.parametrize("direction", ["all", "src", "dst"])
@pytest.mark.parametrize("ports", [(None, None), (22, 22), (1000, 2000)])
def test_whitelist_groups(spark, direction, ports):
    rnd = random.Random(str((direction, ports)))
    hosts = [0x01010101, 0x01010102, 0x03030303, 0x03030304, 0xFFFFFFFF]
    rules = [(rnd.choice(hosts), rnd.choice([0, 8, 31, 32]) if i else 32, direction, *ports) for i in range(2)]
    probes = [(rnd.choice(hosts), rnd.choice(hosts), rnd.choice([21, 22, 1000, 1500, 2000, 2001]), rnd.choice([22, 999, 2000])) for _ in range(60)]
    f = flows(spark, *({"src_ip": a, "dst_ip": b, "src_port": p, "dst_port": q} for a, b, p, q in probes))
    table = spark.createDataFrame(rules, "network long, prefix int, direction string, port_from int, port_to int")
    left = {r.seq for r in lookups.not_whitelisted(f, table).collect()}
    assert left == {i for i, p in enumerate(probes) if not _white(rules, p)}


def test_pools(spark):
    pools = spark.createDataFrame([(2, 80), (3, 0)], "pool_ip long, pool_port int")
    f = flows(spark, {"dst_ip": 2}, {"dst_ip": 2, "dst_port": 81}, {"dst_ip": 3, "dst_port": 5})
    assert {r.seq for r in lookups.in_pool(f, pools, "dst_ip", "dst_port").collect()} == {0, 2}
    assert {r.seq for r in lookups.in_pool(f, pools, "dst_ip", "dst_port", "left_anti").collect()} == {1}


def test_ports_of_lists(spark):
    entries = spark.createDataFrame([(1, 32, 3, {2: [80]})], "network long, prefix int, bitmap long, ports map<int,array<int>>")
    f = flows(spark, {"src_port": 80}, {"src_port": 81}, {"src_ip": 7}, {"src_port": 53})
    got = {r.seq: (r.src_bitmap, r.dst_bitmap) for r in blacklist.match_ips(f, entries).collect()}
    assert got == {0: (3, 0), 1: (1, 0)}


def test_domain_exceptions(spark):
    names = spark.createDataFrame([("a.b.com",), ("b.com",), ("xb.com",), (None,)], "n string")
    kept = filters.without_domains(names, "n", spark.createDataFrame([("B.com",)], "domain string"))
    assert {r.n for r in kept.collect()} == {"xb.com", None}


def test_list_sources(spark, tmp_path):
    (tmp_path / "ip").write_text("# c\n1.2.3.4,5\n10.0.0.0/8,2;2:80,443;3:22\n::1/64,4\nbad,1\n1.2.3.4/40,1\n;x\n")
    got = {r.text: (r.network, r.prefix, r.bitmap, r.ports) for r in lists.ip_entries(lists.lines(spark, str(tmp_path / "ip"))).collect()}
    assert got == {"1.2.3.4": (0x01020304, 32, 5, {}), "10.0.0.0": (0x0A000000, 8, 2, {2: [80, 443], 3: [22]}), "::1": (None, 64, 4, {})}
    (tmp_path / "n").write_text("a.com/x\\3\nbad\n")
    assert [tuple(r) for r in lists.name_entries(lists.lines(spark, str(tmp_path / "n"))).collect()] == [("a.com/x", 3)]
    (tmp_path / "w").write_text("dst 192.30.252.128/30/22 #c\nsrc 1.1.1.1\n2.2.2.0/24/80,100-200\n")
    assert [tuple(r) for r in lists.whitelist(lists.lines(spark, str(tmp_path / "w"))).sort("network", "port_from").collect()] == [(0x01010101, 32, "src", None, None), (0x02020200, 24, "all", 80, 80), (0x02020200, 24, "all", 100, 200), (0xC01EFC80, 30, "dst", 22, 22)]
    (tmp_path / "p").write_text("1.1.1.1:3333\n2.2.2.2\n")
    assert {tuple(r) for r in lists.pools(lists.lines(spark, str(tmp_path / "p"))).collect()} == {(0x01010101, 3333), (0x02020202, 0)}
    (tmp_path / "r").write_text("<script ** URL, HOST\nplain\n")
    assert [(r.pattern, r.fields) for r in lists.rules(spark.read.text(str(tmp_path / "r"))).collect()] == [("<script", ["URL", "HOST"])]
    (tmp_path / "j").write_text('{"ip":"1.1.1.1","port":80,"kind":"a"}\n{"ip":"1.1.1.1","port":90,"kind":"a"}\n{"ip":"2.2.2.2","kind":"b"}\n')
    assert [tuple(r) for r in lists.json_entries(spark.read.text(str(tmp_path / "j")), "ip", {"kind": "a"}, port="port").collect()] == [("1.1.1.1", [80, 90])]
    (tmp_path / "x").write_text("see 10.1.1.1 and http://a.example/b\nno\n")
    found = spark.read.text(str(tmp_path / "x"))
    assert [r.entity for r in lists.extracted(found, "ipv4").collect()] == ["10.1.1.1"]
    (tmp_path / "s.xml").write_text("<lists><list><id>1</id><name>a</name></list><list><id>2</id><name>b</name></list></lists>")
    assert {tuple(r) for r in lists.settings(spark, str(tmp_path / "s.xml"), "list", "id int, name string").collect()} == {(1, "a"), (2, "b")}


def test_detector_file(spark):
    df = spark.createDataFrame([(0x0A000001, 6, {2: [443, 80]}), (1, 1, {})], "number long, bitmap long, ports map<int,array<int>>")
    assert [r.line for r in sinks.detector_file(df).collect()] == ["0.0.0.1,1", "10.0.0.1,6;2:80,443"]


def test_log_and_documents(spark, tmp_path):
    log = spark.createDataFrame([("2024-01-01", "a;b")], "day string, line string")
    sinks.write_log(log, str(tmp_path / "log"))
    assert spark.read.text(str(tmp_path / "log")).first().value == "a;b"
    doc = spark.range(1).select(sinks.misp_event(F.lit("x"), F.array(F.struct(F.lit("ip-src").alias("type"), F.lit("1.1.1.1").alias("value"))), F.lit("2024-01-01")).alias("d")).first().d
    assert doc == '{"Event":{"info":"x","date":"2024-01-01","Attribute":[{"type":"ip-src","value":"1.1.1.1"}]}}'


#: (src, dst, ports, first, last): alerts of one day in seconds, and what their roll-up must give.
ALERTS = [("1.8.9.39", "88.5.17.23", 400, 10, 20), ("1.8.9.39", "98.4.48.85", 400, 12, 30), ("1.8.9.39", "69.7.18.27", 2100, 5, 25), ("98.4.48.82", "1.8.9.39", 800, 3, 9), ("98.4.48.82", "1.8.9.39", 550, 2, 8)]


def test_alert_rollup(spark):
    df = spark.createDataFrame(ALERTS, "src string, dst string, port_cnt int, ts_first long, ts_last long")
    got = {r.src: (r.members, r.ts_first, r.ts_last) for r in aggregates.rolled_up(df, ["src"], "dst", "port_cnt", 86400).collect()}
    assert got == {"1.8.9.39": ({"88.5.17.23": 400, "98.4.48.85": 400, "69.7.18.27": 2100}, 5, 30), "98.4.48.82": ({"1.8.9.39": 1350}, 2, 9)}


def test_web_rules_agree_with_python(spark):
    rules = [("brace", r"\$\{[a-z]+\}|{{", ["q"]), ("count", r"a{2,3}b", ["q", "args"]), ("first", r"x", ["q"])]
    rows = [("${ab}", []), ("{{", ["aab"]), ("zz", ["aab", "ab"]), ("x", []), (None, None), ("ab", ["aaaab"])]
    df = spark.createDataFrame(rows, "q string, args array<string>")
    a = sorted(map(str, web.first_matches(df, rules).collect()))
    assert a == sorted(map(str, web.first_matches_python(df, rules).collect()))
    assert len(a) == 5 and re.search("brace", a[0] + a[1])


def test_mail_score(spark):
    df = flows(spark, {"dst_port": 25, "tcp_flags": 24}).withColumns({"smtp_status": F.lit(0x40000000 | 0x100).cast("long"), "sender": F.lit(None).cast("string"), "recipient": F.lit("r")})
    assert df.select(smtp.flow_score()).first()[0] == 5 + 1 + 1 - 1


def test_vertical_first_matches_machine(spark):
    rnd = random.Random(5)
    f = flows(spark, *({"src_ip": rnd.randint(1, 2), "dst_port": rnd.randint(1, 9), "t_last": i, "t_first": i} for i in range(300)))
    first = {(r.src_ip, r.dst_ip): r.seq for r in scan.vertical_first(f, 5).collect()}
    every = scan.vertical_all(f, 5).groupBy("src_ip", "dst_ip").agg(F.min("seq").alias("seq")).collect()
    assert first == {(r.src_ip, r.dst_ip): r.seq for r in every}


def test_ttl(spark):
    df = spark.createDataFrame([(1, 0), (2, 100), (3, 10), (3, 200)], "e int, at long")
    assert {r.e for r in blacklist.latest(df, "e", "at", 290, 100).collect()} == {1, 3}


def test_empty_flows(spark):
    f = flows(spark).limit(0)
    assert scan.vertical_all(f).isEmpty() and scan.horizontal_first(f).isEmpty() and flood.grid(f).isEmpty()

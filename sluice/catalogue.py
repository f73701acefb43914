"""All flow queries by name, with the SQL that DuckDB answers alike.

Thresholds suit the small flow table that is made from the events; every operator takes them as parameters.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import machines_sql, samples
from sluice.functions import bits, ip, text
from sluice.functions.numbers import div
from sluice.operators import aggregates, filters, lookups, projections
from sluice.operators.keyed import run_keyed
from sluice.plans import amplification, backscatter, blacklist, bruteforce, dnstunnel, flood, hosts, miner, scan, sip, smtp, voip, web
from sluice.schema import FLOWS_SQL, flows
from sluice.sources import lists, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def _joined(items: Column) -> Column:
    return F.array_join(F.transform(items, lambda x: x.cast("string")), ",")


# Scans

_PROBES = "p as (select * from f where packets <= 4 and protocol = 6 and tcp_flags = 2)"
_VERTICAL = f"""with {FLOWS_SQL}, {_PROBES},
s as (select *, case when row_number() over (partition by src_ip, dst_ip, dst_port order by seq) % 2 = 1 then 1 else -1 end as step from p),
c as (select *, sum(step) over (partition by src_ip, dst_ip order by seq rows unbounded preceding) as open_ports from s),
a as (select *, row_number() over (partition by src_ip, dst_ip order by seq) as k from c where open_ports >= 5)
select src_ip, dst_ip, seq, cast(open_ports as bigint) as port_cnt, src_port, dst_port, t_last as ts_last from a where k = 1"""
_HORIZONTAL = f"""with {FLOWS_SQL}, p as (select * from f where packets = 1 and protocol = 6 and tcp_flags = 2),
s as (select *, case when row_number() over (partition by src_ip, dst_port, dst_ip order by seq) = 1 then 1 else 0 end as step from p),
c as (select *, sum(step) over (partition by src_ip, dst_port order by seq rows unbounded preceding) as n from s),
a as (select *, row_number() over (partition by src_ip, dst_port order by seq) as k from c where n >= 3)
select src_ip, dst_port, seq, cast(n as bigint) as addr_cnt, dst_ip, t_last as ts_last from a where k = 1"""


@query(_VERTICAL)
def vertical_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.vertical_first(flows(spark, sf_dir), 5)


@query(_HORIZONTAL)
def horizontal_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.horizontal_first(flows(spark, sf_dir), 3)


@query(f"with recursive {FLOWS_SQL}, {_PROBES}, {machines_sql.vertical(5, 1500)}")
def vertical_scan_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.vertical_all(flows(spark, sf_dir), 5, 1500)


@query(f"with recursive {FLOWS_SQL}, p as (select * from f where packets = 1 and protocol = 6 and tcp_flags = 2), {machines_sql.horizontal(2, 1500)}")
def horizontal_scan_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.horizontal_all(flows(spark, sf_dir), 2, 1500).withColumn("samples", _joined(F.col("samples")))


@query(f"""with {_HORIZONTAL.removeprefix('with ').rpartition('select src_ip')[0]},
e as (select src_ip, ts_last - ts_last % 300 as start, dst_port, sum(addr_cnt) as n, min(ts_last) as a, max(ts_last) as b from (select src_ip, dst_port, cast(n as bigint) as addr_cnt, t_last as ts_last from a where k = 1) group by 1, 2, 3)
select src_ip, start, string_agg(dst_port || ':' || cast(n as bigint), ',' order by dst_port) as members, min(a) as ts_first, max(b) as ts_last from e group by 1, 2""")
def scan_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = horizontal_scan(spark, sf_dir).withColumn("ts_first", F.col("ts_last"))
    rolled = aggregates.rolled_up(alerts, ["src_ip"], "dst_port", "addr_cnt")
    members = F.array_join(F.transform(F.array_sort(F.map_entries("members")), lambda e: F.concat_ws(":", e["key"], e["value"])), ",")
    return rolled.select("src_ip", "start", members.alias("members"), "ts_first", "ts_last")


@query(f"""with {FLOWS_SQL}, g as (select *, case when t_last - lag(t_last) over (partition by src_ip, dst_ip order by t_last, seq) > 300 then 1 else 0 end as gap from f),
s as (select *, sum(gap) over (partition by src_ip, dst_ip order by t_last, seq rows unbounded preceding) as session from g)
select src_ip, dst_ip, cast(session as bigint) as session, count(*) as flows, min(t_first) as ts_first, max(t_last) as ts_last from s group by 1, 2, 3""")
def idle_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.sessions(flows(spark, sf_dir), ["src_ip", "dst_ip"]).withColumn("session", F.col("session").cast("long"))


@query(f"""with {FLOWS_SQL}, o as (select dst_ip, dst_port, src_ip, row_number() over (partition by dst_ip, dst_port order by seq) as k, count(*) over (partition by dst_ip, dst_port) as n, packets, t_first, t_last from f where protocol = 17)
select dst_ip, dst_port, string_agg(cast(src_ip as varchar), ',' order by k) filter (where k <= 3 or (k = n and n > 3)) as addresses, cast(sum(packets) as bigint) as n, min(t_first) as ts_first, max(t_last) as ts_last from o group by 1, 2""")
def sample_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = flows(spark, sf_dir).filter("protocol = 17").select("dst_ip", "dst_port", "seq", F.array("src_ip").alias("a"), "packets", F.col("t_first").alias("ts_first"), F.col("t_last").alias("ts_last"))
    return aggregates.sample_addresses(f, ["dst_ip", "dst_port"], "seq", "a", "packets").withColumn("addresses", _joined(F.col("addresses")))


# Filters and projections


@query(f"""with {FLOWS_SQL} select protocol, case when src_port < 10000 or dst_port < 10000 then case when src_port = dst_port then 'unknown' when src_port < dst_port then 'response' else 'request' end else 'unknown' end as direction,
count(*) as flows, count(*) filter (where (packets, tcp_flags) in ((1, 2), (2, 2), (2, 6), (1, 18), (1, 20), (3, 2))) as scan_shaped, count(*) filter (where src_port = 53 or dst_port = 53) as dns, count(*) filter (where src_port in (25,143,465,587,993,995) or dst_port in (25,143,465,587,993,995)) as mail,
count(*) filter (where tcp_flags & 24 = 24 and packets between 2 and 4 and bytes between 50 and 300) as signature, count(*) filter (where packets = 1 and tcp_flags = 16 or packets = 4 and tcp_flags = 2) as ssh_ignored from f group by 1, 2""")
def flow_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = flows(spark, sf_dir).filter(~filters.portless_udp()).withColumn("direction", projections.direction(F.col("src_port"), F.col("dst_port")))
    return f.groupBy("protocol", "direction").agg(F.count("*").alias("flows"), F.count_if(filters.scan_shaped()).alias("scan_shaped"), F.count_if(filters.dns()).alias("dns"), F.count_if(filters.mail()).alias("mail"), F.count_if(filters.signature(24, (2, 4), (50, 300))).alias("signature"), F.count_if(filters.ssh_ignored()).alias("ssh_ignored"))


@query(f"""with {FLOWS_SQL} select src_ip // 256 * 256 as src_net, concat_ws('.', src_ip // 16777216, src_ip // 65536 % 256, src_ip // 256 % 256, src_ip % 256) as address, dst_ip // 16 * 16 as dst_net, count(*) as flows, cast(bit_or(tcp_flags) as int) as flags, cast(least(sum(bytes), 65535) as bigint) as bytes from f group by 1, 2, 3""")
def networks(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = projections.networks(flows(spark, sf_dir), 24, 28).withColumn("address", ip.ipv4_text(F.col("src_ip")))
    return f.filter(filters.both_ipv4(ip.ipv4_number(F.col("address")), F.col("dst_ip"))).groupBy("src_net", "address", "dst_net").agg(F.count("*").alias("flows"), F.bit_or("tcp_flags").alias("flags"), bits.saturated(F.sum("bytes"), 16).alias("bytes"))


@query(f"""with {samples.REQUESTS_SQL} select seq, regexp_replace(regexp_replace(lower(host), '^www\\.', ''), '\\.$', '') as host_key, regexp_replace(regexp_replace(lower(host || path), '^www\\.', ''), '/$', '') as url_key,
cast(length(regexp_replace(url, '[^0-9]', '', 'g')) as int) as digits, cast(len(list_distinct(regexp_extract_all(url, '.'))) as int) as letters, case when contains(host, '.') then regexp_replace(host, '^[^.]*\\.', '') else host end as parent from r""")
def names_and_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = samples.requests(spark, sf_dir)
    return r.select("seq", text.host_name(F.col("host")).alias("host_key"), text.url_key(F.col("host"), F.col("path")).alias("url_key"), text.digit_count(F.col("url")).alias("digits"), text.distinct_chars(F.col("url")).alias("letters"), text.parent_domain(F.col("host")).alias("parent"))


@query(f"""with {samples.MESSAGES_SQL} select split_part(party, '@', 1) as sip_user, split_part(party, '@', 2) as sip_host, regexp_matches(callee, '^[0-9+*#:-]+$') as dialable, count(*) as n from m group by 1, 2, 3""")
def sip_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = samples.messages(spark, sf_dir)
    return m.groupBy(text.sip_user(F.col("sip_calling_party")).alias("sip_user"), text.sip_host(F.col("sip_calling_party")).alias("sip_host"), text.is_dialable(text.sip_identity(F.col("sip_called_party"))).alias("dialable")).agg(F.count("*").alias("n"))


# Floods

_GRID = f"""{FLOWS_SQL}, u as (select dst_ip as dst_net, bytes, t_first, t_last, unnest(generate_series(t_first - t_first % 60, t_last - t_last % 60, 60)) as minute from f where t_last >= t_first),
e as (select dst_net, minute, case when least(minute + 60, t_last + 1) - t_first <= 0 then 0 else bytes * (least(minute + 60, t_last + 1) - t_first) // (t_last - t_first + 1) end
  - case when least(minute, t_last + 1) - t_first <= 0 then 0 else bytes * (least(minute, t_last + 1) - t_first) // (t_last - t_first + 1) end as b from u),
v as (select dst_net, minute, sum(b) as bytes from e group by 1, 2),
k as (select dst_ip as dst_net, t_last - t_last % 60 as minute, count(distinct (src_ip // 4 * 4) % 511) as sources from f group by 1, 2),
j as (select coalesce(v.dst_net, k.dst_net) as dst_net, coalesce(v.minute, k.minute) as minute, bytes, sources from v full join k on v.dst_net = k.dst_net and v.minute = k.minute),
s as (select dst_net, unnest(generate_series(min(minute), max(minute), 60)) as minute from j group by 1),
g as (select s.dst_net, s.minute, cast(coalesce(bytes, 0) as bigint) as bytes, cast(coalesce(sources, 0) as bigint) as sources from s left join j on s.dst_net = j.dst_net and s.minute = j.minute)"""


@query(f"with {_GRID} select * from g")
def flood_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flood.grid(flows(spark, sf_dir), 30, 32)


@query(f"""with {_GRID}, h as (select *, lead(bytes, 1) over w as b1, lead(bytes, 2) over w as b2, lead(sources, 1) over w as s1, lead(sources, 2) over w as s2, list(bytes) over (w rows between 4 preceding and current row) as bs, list(sources) over (w rows between 4 preceding and current row) as ss from g window w as (partition by dst_net order by minute)),
q as (select *, list_position(list_transform(bs, lambda x: x > 0), true) as first from h),
t as (select *, cast(list_sum(bs[first:]) as bigint) // (len(bs) - first + 1) as mean_bytes, cast(list_sum(ss[first:]) as bigint) // (len(bs) - first + 1) as mean_sources from q where first > 0)
select dst_net, minute + 60 as started, mean_bytes, mean_sources from t where b1 > mean_bytes and b2 > mean_bytes and b1 > 100 and b2 > 100 and s1 > mean_sources and s2 > mean_sources""")
def floods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flood.floods(flood.grid(flows(spark, sf_dir), 30, 32), 1, 1, 100)


@query(f"with recursive {_GRID}, {machines_sql.lifecycle(1, 1, 100)}")
def flood_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flood.lifecycle(flood.grid(flows(spark, sf_dir), 30, 32), 1, 1, 100)


@query(ORACLES["flood_lifecycle"])
def flood_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flood.ring(flows(spark, sf_dir), 30, 32, rate=1, source_rate=1, least_bytes=100)


# Amplification

_LIMITS = amplification.Limits(top=3, step=50, ratio=0, flows=2, share=0.1, rsp_packets=0, rsp_bytes=10, query_bytes=100000, window=1000, slide=500, port=80)
_PAIRS = f"""{FLOWS_SQL}, w as (select *, case when dst_port = 80 then dst_ip else src_ip end as server, case when dst_port = 80 then src_ip else dst_ip end as client, dst_port = 80 as q from (select * from f union all select seq, dst_ip, src_ip, dst_port, src_port, protocol, packets, bytes * 2, tcp_flags, t_first, t_last from f where dst_port = 80) where dst_port = 80 or src_port = 80),
x as (select w.*, unnest([t_last - t_last % 500, t_last - t_last % 500 - 500]) as start from w)"""


def _both_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flows, and an answer of twice the bytes to each one of port 80."""
    f = flows(spark, sf_dir)
    back = f.filter("dst_port = 80").select("seq", F.col("dst_ip").alias("src_ip"), F.col("src_ip").alias("dst_ip"), F.col("dst_port").alias("src_port"), F.col("src_port").alias("dst_port"), "protocol", "packets", (F.col("bytes") * 2).alias("bytes"), "tcp_flags", "t_first", "t_last")
    return f.union(back)


@query(f"""with {_PAIRS} select server, client, start, count(*) filter (where q) as q_flows, count(*) filter (where not q) as r_flows, cast(coalesce(sum(packets) filter (where q), 0) as bigint) as q_packets, cast(coalesce(sum(packets) filter (where not q), 0) as bigint) as r_packets,
cast(coalesce(sum(bytes) filter (where q), 0) as bigint) as q_bytes, cast(coalesce(sum(bytes) filter (where not q), 0) as bigint) as r_bytes, max(packets) filter (where q) as q_max_packets, max(packets) filter (where not q) as r_max_packets, max(bytes) filter (where q) as q_max_bytes, max(bytes) filter (where not q) as r_max_bytes, min(t_first) as ts_first, max(t_last) as ts_last from x group by 1, 2, 3""")
def amplification_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return amplification.totals(_both_ways(spark, sf_dir), _LIMITS)


@query(f"""with {_PAIRS}, h as (select server, client, start, bytes // 50 * 50 + 50 as bin, count(*) as n from x where not q and bytes < 5000 group by 1, 2, 3, 4),
t as (select *, sum(n) over (partition by server, client, start) as every, row_number() over (partition by server, client, start order by n desc, bin desc) as k from h)
select server, client, start, cast(sum(bin) as bigint) // count(*) as mean_bin, cast(sum(bin * n) as bigint) // cast(sum(n) as bigint) as mean, cast(sum(n) as bigint) as n, cast(floor(sum(n) * 1000000 / max(every)) as bigint) as share_millionths from t where k <= 3 group by 1, 2, 3""")
def amplification_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["server", "client", "start"]
    hist = aggregates.histogram(amplification.pairs(_both_ways(spark, sf_dir), _LIMITS).filter("not is_query"), keys, "bytes", 50, 5000)
    every = hist.groupBy(*keys).agg(F.sum("n").alias("every"))
    best = aggregates.top_bins(hist, keys, 3).groupBy(*keys).agg(div(F.sum("bin"), F.count("*")).alias("mean_bin"), aggregates.weighted_mean().alias("mean"), F.sum("n").alias("n"))
    return best.join(every, keys).select(*keys, "mean_bin", "mean", "n", div(F.col("n") * 1000000, F.col("every")).alias("share_millionths"))


def _tops(way: str, column: str, most: str, tag: str, keys: str = "server, client, start", table: str = "x") -> str:
    return f"""h_{tag} as (select {keys}, {column} // 50 * 50 + 50 as bin, count(*) as n from {table} where {way}{most} group by all),
k_{tag} as (select *, sum(n) over (partition by {keys}) as every, row_number() over (partition by {keys} order by n desc, bin desc) as k from h_{tag}),
{tag} as (select {keys}, sum(bin) // count(*) as mean_bin, sum(bin * n) // sum(n) as mean, sum(n) as n, sum(n) * 1.0 / max(every) as share from k_{tag} where k <= 3 group by all)"""


@query(f"""with {_PAIRS}, t as (select server, client, start, count(*) filter (where q) as q_flows, count(*) filter (where not q) as r_flows, cast(coalesce(sum(packets) filter (where q), 0) as bigint) as q_packets, cast(coalesce(sum(packets) filter (where not q), 0) as bigint) as r_packets,
cast(coalesce(sum(bytes) filter (where q), 0) as bigint) as q_bytes, cast(coalesce(sum(bytes) filter (where not q), 0) as bigint) as r_bytes, max(packets) filter (where q) as q_most, max(bytes) filter (where q) as q_max, max(bytes) filter (where not q) as r_max, min(t_first) as ts_first, max(t_last) as ts_last from x group by 1, 2, 3),
{_tops('not q', 'bytes', ' and bytes < 5000', 'rb')}, {_tops('not q', 'packets', '', 'rp')}, {_tops('q', 'bytes', ' and bytes < 5000', 'qb')},
j as (select t.*, q_packets >= 30 and r_packets // q_packets >= 5 as heavy, rb.share as share, rb.n as n, rp.mean as rp_mean, rb.mean as rb_mean, qb.mean as qb_mean, rb.mean_bin as rb_bin, qb.mean_bin as qb_bin from t join rb using (server, client, start) join rp using (server, client, start) join qb using (server, client, start) where q_flows > 0 and r_flows > 0)
select server, client, start, case when heavy then 'big' else 'complex' end as kind, q_flows, q_packets, q_bytes, r_flows, r_packets, r_bytes, ts_first, ts_last from j
where case when heavy then (q_most > 1000 or r_max > 100000) and r_max // q_max > 0 else share > 0.1 and n > 2 and rp_mean > 0 and rb_mean > 10 and qb_mean < 100000 and rb_bin // qb_bin > 0 end""")
def amplified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return amplification.amplified(_both_ways(spark, sf_dir), _LIMITS)


@query(f"""with {FLOWS_SQL} select dst_port % 5 as k, count(*) as n, cast(floor(avg(bytes) * 1000) as bigint) as mean_thousandths, cast(floor(var_samp(bytes)) as bigint) as variance from f group by 1""")
def size_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = flows(spark, sf_dir).withColumn("k", F.col("dst_port") % 5).groupBy("k").agg(*aggregates.moments("bytes"))
    return m.select("k", "n", F.floor(F.col("mean") * 1000).alias("mean_thousandths"), F.floor("variance").alias("variance"))


# Hosts

_ROLES = f"""{FLOWS_SQL}, y as (select *, case when (src_port < 10000 or dst_port < 10000) and src_port <> dst_port then case when src_port < dst_port then 'rsp' else 'req' end else 'unk' end as dir from f),
z as (select src_ip as host, dst_ip as peer, true as o, * from y union all select dst_ip, src_ip, false, * from y)"""


@query(f"""with {_ROLES} select host, t_last - t_last % 3000 as start, count(*) filter (where not o) as in_all_flows, count(*) filter (where o and dir = 'req') as out_req_flows, cast(coalesce(sum(bytes) filter (where o and dir = 'rsp'), 0) as bigint) as out_rsp_bytes,
count(*) filter (where o and tcp_flags & 2 = 2) as out_all_syn, count(*) filter (where not o and dir = 'req' and tcp_flags & 16 = 16) as in_req_ack, least(count(*) filter (where not o and tcp_flags & 4 = 4), 65535) as in_all_rst, cast(coalesce(sum(packets) filter (where not o and tcp_flags & 2 = 2), 0) as bigint) as in_all_syn_packets,
count(distinct peer) filter (where o) as out_all_ips, count(distinct peer) filter (where not o and dir = 'req') as in_req_ips, min(t_first) as ts_first, max(t_last) as ts_last from z group by 1, 2""")
def host_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = hosts.profiles(flows(spark, sf_dir), 3000)
    return p.select("host", "start", "in_all_flows", "out_req_flows", "out_rsp_bytes", "out_all_syn", "in_req_ack", "in_all_rst", "in_all_syn_packets", "out_all_ips", "in_req_ips", "ts_first", "ts_last")


@query(f"""with {_ROLES}, s as (select host, t_last - t_last % 3000 as start, count(*) filter (where o and dir = 'req' and tcp_flags & 2 = 2) as q, count(*) filter (where o and dir = 'rsp' and tcp_flags & 2 = 2) as r, count(*) filter (where o and tcp_flags & 2 = 2) as a,
count(*) filter (where o and dir = 'req' and tcp_flags & 16 = 16) as aq, count(*) filter (where o and dir = 'rsp' and tcp_flags & 16 = 16) as ar, count(*) filter (where o and tcp_flags & 16 = 16) as aa, count(*) filter (where o) as flows, min(t_first) as ts_first, max(t_last) as ts_last from z group by 1, 2)
select host, start, 'syn_heavy' as event, 'more SYN than ACK' as note, a - aa as scale, ts_first, ts_last from s where floor(q + (a - q - r) * 0.8) > 5 and floor(q + (a - q - r) * 0.8) * 2 > floor(aq + (aa - aq - ar) * 0.8)""")
def host_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    syn, ack = hosts.estimate("out", "req", "syn", 0.8), hosts.estimate("out", "req", "ack", 0.8)
    rule = F.when((syn > 5) & (syn * 2 > ack), F.struct(F.lit("syn_heavy").alias("event"), F.lit("more SYN than ACK").alias("note"), (F.col("out_all_syn") - F.col("out_all_ack")).alias("scale")))
    return hosts.events(hosts.profiles(flows(spark, sf_dir), 3000), [rule])


def _host_columns() -> str:
    """The counters that the rules read, in SQL."""
    out, flag = [], {"syn": 2, "ack": 16}
    for way, mine in (("in", "not o"), ("out", "o")):
        for kind, holds in (("all", mine), ("req", f"{mine} and dir = 'req'"), ("rsp", f"{mine} and dir = 'rsp'")):
            out += [f"count(*) filter (where {holds}) as {way}_{kind}_flows", f"count(distinct peer) filter (where {holds}) as {way}_{kind}_ips"]
            out += [f"coalesce(sum({c}) filter (where {holds}), 0) as {way}_{kind}_{c}" for c in ("packets", "bytes")]
            out += [f"count(*) filter (where {holds} and tcp_flags & {f} = {f}) as {way}_{kind}_{n}" for n, f in flag.items()]
            ssh = f"{holds} and protocol = 6 and 22 in (src_port, dst_port)"
            out += [f"coalesce(sum(packets) filter (where {ssh}), 0) as ssh_{way}_{kind}_packets", f"count(*) filter (where {ssh} and tcp_flags & 2 = 2) as ssh_{way}_{kind}_syn"]
        out.append(f"count(*) filter (where {mine} and src_port = 53 and dir = 'rsp' and bytes >= 1000 * packets) as dns_{way}_over")
    return ", ".join(out)


def _estimate(way: str, kind: str, what: str, share: float) -> str:
    every, req, rsp = (f"{way}_{k}_{what}" for k in ("all", "req", "rsp"))
    return f"trunc({way}_{kind}_{what} + ({every} - {req} - {rsp}) * {share})"


def _dos(way: str, back: str) -> str:
    flows_, packets, size = (_estimate(way, "req", x, 0.8) for x in ("flows", "packets", "bytes"))
    tcp = f"{way}_all_syn > 5 and {way}_all_packets < 20 * {way}_all_flows and {way}_all_syn > 2 * {way}_all_ack"
    return f"(({tcp}) or ({flows_} > 5 and {packets} < 20 * {flows_})) and {_estimate(back, 'rsp', 'flows', 0.2)} < 0.8 * {flows_} and {packets} > 0 and {size} / {packets} < 100"


_SYN_OUT = _estimate("out", "req", "syn", 0.8)
_HOST_RULES = (
    ("horizontal_scan", "'horizontal SYN scan'", "out_all_syn - out_all_ack", f"{_SYN_OUT} > 5 and {_SYN_OUT} > {_estimate('out', 'req', 'ack', 0.8)} and {_SYN_OUT} > {_estimate('in', 'rsp', 'syn', 0.2)} and out_req_ips >= 2 and out_req_syn > out_all_flows // 3 and out_all_syn >= out_all_ack"),
    ("dos", "case when in_all_flows < 2 * in_all_ips then 'victim, probably spoofed' else 'victim' end", "in_all_flows", _dos("in", "out")),
    ("dos", "'attacker'", "out_all_flows", _dos("out", "in")),
    ("bruteforce", "'victim'", "ssh_in_req_syn", "ssh_out_rsp_packets between 10 * ssh_out_rsp_syn and 25 * ssh_out_rsp_syn and ssh_out_rsp_syn > 30 and ssh_in_req_packets between 5 * ssh_in_req_syn and 20 * ssh_in_req_syn and ssh_in_req_syn > 60 and ssh_in_req_syn > 3 * ssh_out_req_syn and ssh_out_rsp_syn > 20 * out_all_ips"),
    ("bruteforce", "'attacker'", "ssh_out_req_syn", "ssh_out_req_packets > 5 * ssh_out_req_syn and ssh_out_req_packets < 20 * ssh_out_req_syn and ssh_out_req_syn > 60 and ssh_in_rsp_packets > 10 * ssh_in_rsp_syn and ssh_in_rsp_packets < 25 * ssh_in_rsp_syn and ssh_in_rsp_syn > 30 and ssh_in_req_syn < 3 * ssh_out_req_syn and ssh_out_req_syn > case when out_all_ips < 5 then 20 else 10 end * out_all_ips"),
    ("dns_amplification", "'misused server'", "dns_out_over", "dns_out_over > 10000"),
    ("dns_amplification", "'victim'", "dns_in_over", "dns_in_over > 10000"),
)


@query(f"""with {_ROLES}, s as (select host, t_last - t_last % 3000 as start, {_host_columns()}, min(t_first) as ts_first, max(t_last) as ts_last from z group by 1, 2),
e as ({" union all ".join(f"select host, ts_first, ts_last, '{event}' as event, {note} as note, cast({scale} as bigint) as scale from s where {holds}" for event, note, scale, holds in _HOST_RULES)})
select strftime(make_timestamp(ts_first * 1000000), '%Y-%m-%d') as day, concat_ws(';', strftime(make_timestamp(ts_first * 1000000), '%Y-%m-%d %H:%M:%S'), strftime(make_timestamp(ts_last * 1000000), '%Y-%m-%d %H:%M:%S'), event, host, scale, note) as line from e""")
def host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = hosts.general_rules(5, 2, 5, 5, 1, 1, 20) + [r for s in hosts.SUBPROFILES for r in s.rules()]
    return hosts.daily_log(hosts.events(hosts.profiles(flows(spark, sf_dir), 3000), rules))


@query(f"with recursive {FLOWS_SQL}, h as (select src_ip as host, seq, t_last, packets, bytes from f union all select dst_ip, seq, t_last, packets, bytes from f), {machines_sql.timeouts(300, 30)}")
def host_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts.records(flows(spark, sf_dir))


# Password guessing

_SSH = f"""{FLOWS_SQL}, b as (select *, dst_port = 22 as incoming, case when dst_port = 22 then src_ip else dst_ip end as host, case when dst_port = 22 then dst_ip else src_ip end as victim, tcp_flags & 24 = 24 and packets between 1 and 4 as hit from f where protocol = 6 and (dst_port = 22 or src_port = 22)
  and (packets, tcp_flags) not in ((1, 2), (2, 2), (2, 6), (1, 18), (1, 20), (3, 2)) and not (packets = 1 and tcp_flags = 16) and not (packets = 4 and tcp_flags = 2))"""


def _ssh_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bruteforce.matched(flows(spark, sf_dir), "ssh").withColumn("hit", bits.has_all(F.col("tcp_flags"), 24) & F.col("packets").between(1, 4))


@query(f"""with {_SSH} select host, seq, incoming, hit, count(*) over w as list_size, cast(sum(case when hit then 1 else 0 end) over w as bigint) as list_matches from b window w as (partition by host, incoming order by seq rows between 19 preceding and current row)""")
def guessing_last_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bruteforce.last_n(_ssh_hits(spark, sf_dir), 20).select("host", "seq", "incoming", "hit", "list_size", "list_matches")


@query(f"with recursive {_SSH}, {machines_sql.guessing(600, 5.0, 2, 3)}")
def guessing_attacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = _ssh_hits(spark, sf_dir).select("host", "seq", "incoming", "hit", "victim", "t_last")
    return run_keyed(hits, ["host"], ["seq"], lambda: bruteforce.Guessing(every=600, least_share=5.0, least_events=2, matches=3), bruteforce.ALERT)


@query(f"""with {FLOWS_SQL}, r as (select dst_ip, bytes, row_number() over (partition by dst_ip order by seq desc) as back from f), o as (select dst_ip, bytes, row_number() over (partition by dst_ip order by bytes) as i, count(*) over (partition by dst_ip) as n from r where back <= 15)
select dst_ip, bytes as median from o where i = n // 2 + 1""")
def upper_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.upper_median_of_last(flows(spark, sf_dir), ["dst_ip"], "seq", "bytes")


#: The signatures over the sample's logins: flags, packets and bytes of each way.
_LOGIN_HITS = {
    "ssh": ("tcp_flags & 26 = 26 and packets between 11 and 30 and bytes between 1000 and 5000", "tcp_flags & 26 = 26 and packets between 11 and 50 and bytes between 1000 and 11000"),
    "rdp": (
        "(tcp_flags & 30 = 30 and packets between 7 and 11 and bytes between 1500 and 2000) or (tcp_flags & 26 = 26 and packets = 3 and bytes between 100 and 200) or (tcp_flags & 26 = 26 and packets between 20 and 100 and bytes between 2200 and 8001)",
        "(tcp_flags & 26 = 26 and packets = 7 and bytes between 1700 and 2200) or (tcp_flags & 26 = 26 and packets = 2 and bytes between 81 and 119) or (tcp_flags & 26 = 26 and packets between 30 and 190 and bytes between 3000 and 180000)",
    ),
    "telnet": ("tcp_flags & 26 = 26 and packets between 9 and 50 and bytes between 450 and 3000", "tcp_flags & 27 = 27 and packets >= 6 and packets <= most_packets and bytes <= most_bytes"),
}


def _logins_sql(service: str) -> str:
    to, back = _LOGIN_HITS[service]
    medians = ", ".join(f"(select max(v) from (select {c} as v, row_number() over (order by {c}) as i, count(*) over () as n from (select {c} from a0 where a0.server = x.server order by e desc limit 15)) where i = n // 2 + 1) + {more} as most_{c}" for c, more in (("packets", 5), ("bytes", 500)))
    return f"""{samples.LOGINS_SQL}, a0 as (select * from g0 where port = {bruteforce.PORTS[service]} and not asks and tcp_flags & 27 = 27),
pr as (select server, {medians} from (select distinct server from a0) x),
b as (select g0.client as host, g0.e as seq, asks as incoming, coalesce(case when asks then {to} else {back} end, false) as hit, g0.server as victim, t_last from g0 left join pr on g0.server = pr.server where port = {bruteforce.PORTS[service]})"""


def _logins(service: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return bruteforce.attacks(samples.logins(spark, sf_dir), service, every=900, least_share=4.0, least_events=2, matches=4, bottom=20)

    run.__name__ = f"{service}_guessing"
    return run


def _login_hits(service: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return bruteforce.matched(samples.logins(spark, sf_dir), service).select("host", "victim", "seq", "incoming", "hit")

    run.__name__ = f"{service}_signatures"
    return run


for _service in bruteforce.PORTS:
    query(f"with recursive {_logins_sql(_service)}, {machines_sql.guessing(900, 4.0, 2, 4, 20)}")(_logins(_service))
    query(f"with {_logins_sql(_service)} select host, victim, seq, incoming, hit from b")(_login_hits(_service))


# SIP and VoIP


@query(f"""with {samples.MESSAGES_SQL}, a as (select src_ip as server, party as user, dst_ip as client, count(*) as n from m where sip_msg_type = 'status' and sip_status_code = 401 and sip_cseq = '1 REGISTER' group by 1, 2, 3)
select server, "user", count(*) as clients, cast(sum(n) as bigint) as attempts, cast(sum(n) as bigint) // count(*) as each from a group by 1, 2""")
def sip_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sip.summary(samples.messages(spark, sf_dir))


@query(f"""with recursive {samples.MESSAGES_SQL}, a as (select src_ip as server, dst_ip as client, party as "user", sip_status_code = 200 as ok, t_last, seq from m where sip_msg_type = 'status' and sip_status_code in (200, 401) and sip_cseq = '1 REGISTER'), {machines_sql.sip_guessing(3, 2, 2)}""")
def sip_attacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sip.attacks(samples.messages(spark, sf_dir), attempts=3, clients=2, users=2)


_CALLS = f"""{samples.MESSAGES_SQL}, i as (select src_ip as caller, callee, call_id, t_last, seq, dst_ip as server from m where sip_msg_type = 'invite'),
k as (select distinct o.call_id, o.callee, o.dst_ip as caller, o.src_ip as server from m o join i on i.call_id = o.call_id and i.callee = o.callee and i.caller = o.dst_ip and i.server = o.src_ip and i.seq < o.seq where o.sip_msg_type = 'status' and o.sip_status_code = 200 and o.sip_cseq = '1 INVITE'),
c as (select i.*, exists (select 1 from k where k.call_id = i.call_id and k.callee = i.callee and k.caller = i.caller) as ok from i)"""


@query(f"""with {_CALLS}, n as (select caller, reverse(callee) as back from c group by caller, callee having not bool_or(ok)), p as (select caller, back, unnest(generate_series(1, least(length(back), 10))) as l from n),
g as (select caller, left(back, l) as prefix, count(*) as n from p group by 1, 2), r as (select *, row_number() over (partition by caller, n order by length(prefix) desc, prefix) as k from g where n > 10)
select caller, reverse(prefix) as suffix, n as strings from r where k = 1""")
def dialled_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voip.shared_ends(voip.calls(samples.messages(spark, sf_dir)))


@query(f"with recursive {_CALLS}, {machines_sql.dial_plan(600)}")
def dial_plan_guesses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return voip.guesses(voip.calls(samples.messages(spark, sf_dir)), every=600)


@query(f"""with {samples.MESSAGES_SQL}, l as (select src_ip as caller, 'n' || cast(seq % 7 as varchar) as country, t_last, seq from m where sip_msg_type = 'invite'), f as (select caller, country, min(seq) as seq, min(t_last) as t_last from l where country <> 'n0' group by 1, 2),
r as (select *, row_number() over (partition by caller order by t_last, seq) as k from f) select caller, country, t_last, seq from r where t_last >= 1704067260 or k > 3""")
def new_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = samples.messages(spark, sf_dir).filter("sip_msg_type = 'invite'")
    located = m.select(F.col("src_ip").alias("caller"), F.concat(F.lit("n"), (F.col("seq") % 7).cast("string")).alias("country"), "t_last", "seq")
    return voip.new_countries(located, 1704067260, ["n0"], 3)


# DNS

_DNS_KEYS = "client, round, is_request"


@query(f"with {samples.NAMES_SQL} select {_DNS_KEYS}, least(size // 10, case when is_request then 29 else 149 end) as bin, count(*) as n from d group by 1, 2, 3, 4")
def dns_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dnstunnel.histograms(samples.names(spark, sf_dir))


@query(f"""with {samples.NAMES_SQL}, e as (select client, name, count(*) as n from d group by 1, 2), p as (select client, regexp_replace(name, '^[^.]*\\.', '') as parent, sum(n) as i, count(*) as k, count(*) filter (where n = 1) as o from e group by 1, 2)
select client, cast(sum(i) as bigint) as inserts, cast(sum(k) as bigint) as different, cast(sum(o) as bigint) as once, cast(max(k) * 1000000 // cast(sum(k) as bigint) as bigint) as main_millionths from p group by 1""")
def dns_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = aggregates.domain_figures(samples.names(spark, sf_dir), "client", "name")
    return f.select("client", "inserts", "different", "once", F.floor(F.col("main_share") * 1000000 + 1e-6).alias("main_millionths"))


@query(f"""with {samples.NAMES_SQL}, h as (select client, least(size // 10, 29) as bin, len(list_distinct(string_split(name, ''))) as l from d where is_request)
select client, bin, cast(floor(cast(sum(l) as bigint) * 1000 // count(*)) as bigint) as letters_thousandths, count(*) as n from h group by 1, 2""")
def dns_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dnstunnel.letters_by_size(samples.names(spark, sf_dir)).select("client", "bin", F.floor(F.col("letters") * 1000 + 1e-6).alias("letters_thousandths"), "n")


def _figures(name: str, rows: str) -> str:
    """Figures of the names of each client and round: inserts, different, once, main_share and longest."""
    return f"""{name}_e as (select client, round, name, count(*) as n from ({rows}) group by 1, 2, 3),
{name}_p as (select client, round, regexp_replace(name, '^[^.]*\\.', '') as parent, sum(n) as inserts, count(*) as different, count(*) filter (where n = 1) as once, max(length(name)) as longest from {name}_e group by 1, 2, 3),
{name} as (select client, round, sum(inserts) as inserts, sum(different) as different, sum(once) as once, max(different) * 1.0 / sum(different) as main_share, max(longest) as longest from {name}_p group by 1, 2)"""


_LETTERS = "len(list_distinct(string_split(name, '')))"
_STRANGE = f"(length(name) >= 5 and ({_LETTERS} > 7 or (length(regexp_replace(name, '[^0-9]', '', 'g')) * 1.0 / length(name) > 0.3 and length(regexp_replace(name, '[^0-9]', '', 'g')) > 15)))"


@query(f"""with recursive {samples.NAMES_SQL}, {_figures("q", f"select * from d where is_request and {_STRANGE}")}, {_figures("a", f"select * from d where not is_request and {_LETTERS} > 8")},
t as (select client, round from q where (inserts > 1 and once * 1.0 / inserts > 0.5 and different * 1.0 / inserts > 0.5 and main_share > 0.2) or (inserts > 30 and once * 1.0 / inserts > 0.98 and different * 1.0 / inserts > 0.98 and longest > 60)
union select client, round from a where inserts > 1 and once * 1.0 / inserts > 0.5 and different * 1.0 / inserts > 0.5),
b as (select d.client, d.round, bool_or(case when is_request then {_STRANGE} else {_LETTERS} > 8 end) as strange, bool_or(t.client is not null) as confirmed from d left join t on d.client = t.client and d.round = t.round group by 1, 2), {machines_sql.rounds()}""")
def dns_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = dnstunnel.Limits(name_length=5, name_letters=7, answer_letters=8, inserts=1, share=0.5, main_share=0.2, answer_inserts=1)
    seen = samples.names(spark, sf_dir).withColumns({k: F.lit(None).cast("string") for k in dnstunnel.RECORD_KINDS.values()})
    return dnstunnel.states(seen, limits)


# Lists


@query(f"""with {samples.LISTS_SQL}, h as (select network, prefix, list_id, port from l), {FLOWS_SQL}, k as (select * from f where src_port <> 53 and dst_port <> 53),
s as (select k.seq, cast(bit_or(1::bigint << (list_id - 1)) as bigint) as bitmap from k join h on k.src_ip // (1::bigint << (32 - prefix)) = network // (1::bigint << (32 - prefix)) and (port is null or port = src_port) group by 1),
d as (select k.seq, cast(bit_or(1::bigint << (list_id - 1)) as bigint) as bitmap from k join h on k.dst_ip // (1::bigint << (32 - prefix)) = network // (1::bigint << (32 - prefix)) and (port is null or port = dst_port) group by 1)
select coalesce(s.seq, d.seq) as seq, coalesce(s.bitmap, 0) as src_bitmap, coalesce(d.bitmap, 0) as dst_bitmap from s full join d on s.seq = d.seq""")
def listed_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _listed(spark, sf_dir).select("seq", "src_bitmap", "dst_bitmap")


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = samples.list_entries(spark, sf_dir).select("network", "prefix", bits.of_id(F.col("list_id")).alias("bitmap"), F.when(F.col("port").isNotNull(), F.create_map(F.col("list_id"), F.array("port"))).otherwise(F.create_map().cast("map<int,array<int>>")).alias("ports"))
    return blacklist.match_ips(flows(spark, sf_dir), entries)


_ROLLED = f"""with {samples.LISTS_SQL}, {FLOWS_SQL}, k as (select * from f where src_port <> 53 and dst_port <> 53),
e as (select distinct k.seq, src_ip as entity, dst_ip as target, case when src_port <= 49152 then src_port end as p, protocol, list_id, true as sends, packets, bytes, t_first, t_last from k join l on k.src_ip // (1::bigint << (32 - prefix)) = network // (1::bigint << (32 - prefix)) and (port is null or port = src_port)
union all select distinct k.seq, dst_ip, src_ip, case when dst_port <= 49152 then dst_port end, protocol, list_id, false, packets, bytes, t_first, t_last from k join l on k.dst_ip // (1::bigint << (32 - prefix)) = network // (1::bigint << (32 - prefix)) and (port is null or port = dst_port))"""


@query(f"""{_ROLLED} select entity, protocol, cast(list_id as int) as list_id, t_first - t_first % 300 as start, count(*) as flows, count(distinct target) as targets, count(distinct p) as ports, cast(coalesce(sum(bytes) filter (where sends), 0) as bigint) as sent_bytes, cast(coalesce(sum(packets) filter (where not sends), 0) as bigint) as received_packets, min(t_first) as ts_first, max(t_last) as ts_last from e group by 1, 2, 3, 4""")
def listed_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = blacklist.rolled_up_counts(_listed(spark, sf_dir))
    return r.select("entity", "protocol", "list_id", "start", "flows", "targets", "ports", "sent_bytes", "received_packets", "ts_first", "ts_last")


@query(f"""{_ROLLED}, g as (select entity, protocol, list_id, t_first - t_first % 300 as start, target from e group by all), n as (select *, row_number() over (partition by entity, protocol, list_id, start order by target) - 1 as i, count(*) over (partition by entity, protocol, list_id, start) as c from g)
select entity, protocol, cast(list_id as int) as list_id, start, cast(i // 2 as int) as part, cast((max(c) + 1) // 2 as int) as parts, string_agg(cast(target as varchar), ',' order by target) as targets from n group by 1, 2, 3, 4, 5""")
def listed_rollup_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = blacklist.rolled_up_parts(_listed(spark, sf_dir), 2)
    return r.select("entity", "protocol", "list_id", "start", "part", "parts", _joined(F.col("targets")).alias("targets"))


@query(f"""{_ROLLED}, g as (select entity, protocol, list_id, t_first - t_first % 300 as start, min(t_first) as a, max(t_last) as b from e where list_id in (1, 2, 3) group by all),
m as (select *, case when b - lag(b) over (partition by entity order by b, a) > 600 then 1 else 0 end as cut from g), i as (select *, sum(cut) over (partition by entity order by b, a, protocol, list_id, start) as n from m),
t as (select distinct i.entity, i.n, e.target from i join e on e.entity = i.entity and e.protocol = i.protocol and e.list_id = i.list_id and e.t_first - e.t_first % 300 = i.start),
w as (select entity, n, arg_min(a, (b, a)) as ts_first, max(b) as ts_last from i group by 1, 2)
select w.entity, (select string_agg(target, ',' order by target) from t where t.entity = w.entity and t.n = w.n) as adaptive, ts_first, ts_last from w""")
def scenario_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = blacklist.scenarios(blacklist.rolled_up(_listed(spark, sf_dir)), [1, 2, 3])
    return found.withColumn("adaptive", _joined(F.array_sort("adaptive")))


@query(f"{_ROLLED} select distinct target as number, 32 as prefix, 999 as list_id from e where list_id in (1, 2, 3)")
def scenarios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blacklist.adaptive_list(blacklist.scenarios(blacklist.rolled_up(_listed(spark, sf_dir)), [1, 2, 3]))


@query(f"""with {samples.LISTS_SQL}, {FLOWS_SQL} select f.seq, f.src_ip, f.dst_ip from f where not exists (select 1 from l where list_id % 2 = 0 and f.src_ip // (1::bigint << (32 - prefix)) = network // (1::bigint << (32 - prefix)) and (port is null or src_port between port and port + 1000))
and not exists (select 1 from l where list_id % 3 = 0 and f.dst_ip // (1::bigint << (32 - prefix)) = network // (1::bigint << (32 - prefix)) and (port is null or dst_port between port and port + 1000))""")
def not_whitelisted(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("list_id")
    rules = samples.list_entries(spark, sf_dir).filter(n.isin(2, 3, 4)).select("network", "prefix", F.when(n == 3, "dst").otherwise("src").alias("direction"), F.col("port").alias("port_from"), (F.col("port") + 1000).alias("port_to"))
    return lookups.not_whitelisted(flows(spark, sf_dir), rules).select("seq", "src_ip", "dst_ip")


@query("""with e as (select cast(s_suppkey % 40 as bigint) as entity, cast(s_nationkey % 7 + 1 as int) as list_id, case when s_suppkey % 3 = 0 then cast(s_nationkey as int) end as port from supplier)
select entity, cast(bit_or(1::bigint << (list_id - 1)) as bigint) as bitmap, coalesce(string_agg(distinct list_id || ':' || port, ',' order by list_id || ':' || port), '') as ports, bit_count(bit_or(1::bigint << (list_id - 1))) = 1 as single from e group by 1""")
def merged_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet").select((F.col("s_suppkey") % 40).alias("entity"), (F.col("s_nationkey") % 7 + 1).alias("list_id"), F.when(F.col("s_suppkey") % 3 == 0, F.col("s_nationkey")).alias("port"))
    return aggregates.merged_lists(s, "entity").withColumn("single", bits.is_single(F.col("bitmap")))


@query("""with b as (select c_custkey, c_custkey * 2654435761 as bitmap from customer), i as (select c_custkey, bitmap, unnest(generate_series(1, 63)) as list_id from b) select c_custkey, list_id from i where (bitmap >> (list_id - 1)) & 1 = 1""")
def bitmap_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", (F.col("c_custkey") * F.lit(2654435761)).alias("bitmap"))
    return c.select("c_custkey", F.explode(bits.ids(F.col("bitmap"))).alias("list_id")).withColumn("list_id", F.col("list_id").cast("long"))


@query(f"""with {samples.REQUESTS_SQL}, l as (select regexp_replace(regexp_replace(lower(host || path), '^www\\.', ''), '/$', '') as k, cast(bit_or(1::bigint << (seq % 8)) as bigint) as bitmap from r where seq % 3 = 0 group by 1) select r.seq, l.bitmap from r join l on regexp_replace(regexp_replace(lower(r.host || r.path), '^www\\.', ''), '/$', '') = l.k""")
def listed_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = samples.requests(spark, sf_dir)
    entries = r.filter("seq % 3 = 0").groupBy(text.url_key(F.col("host"), F.col("path")).alias("name")).agg(F.bit_or(bits.of_id(F.col("seq") % 8 + 1)).alias("bitmap"))
    return blacklist.match_urls(r, "host", "path", entries).select("seq", "bitmap")


@query(f"""with {samples.REQUESTS_SQL}, l as (select distinct regexp_replace(lower(host), '^www\\.', '') as k from r where seq % 5 = 0) select r.seq, cast(4 as bigint) as bitmap from r join l on regexp_replace(lower(r.host), '^www\\.', '') = l.k""")
def listed_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = samples.requests(spark, sf_dir)
    return blacklist.match_names(r, "host", r.filter("seq % 5 = 0").select(F.col("host").alias("name"), F.lit(4).cast("long").alias("bitmap")).distinct()).select("seq", "bitmap")


# Miners, mail, web, backscatter

_SUSPECTS = f"""{FLOWS_SQL}, g as (select *, min(case when tcp_flags in (16, 24) then seq end) over (partition by src_ip, dst_ip, dst_port) as first from f),
u as (select src_ip, dst_ip, dst_port, count(*) filter (where tcp_flags = 16) as ack_flows, count(*) filter (where tcp_flags = 24) as ackpush_flows, count(*) filter (where tcp_flags not in (16, 24)) as other_flows, count(*) filter (where src_port > dst_port) as req_flows, cast(sum(packets) as bigint) as packets, cast(sum(bytes) as bigint) as bytes, min(t_first) as first_seen, max(t_last) as last_seen from g where seq >= first group by 1, 2, 3)"""


@query(f"""with {_SUSPECTS}, v as (select *, ack_flows + ackpush_flows + other_flows as flows, last_seen - first_seen as active from u)
select src_ip, dst_ip, dst_port, flows, case when (ack_flows + ackpush_flows) * 100 // flows >= 80 then 2 else 0 end + case when bytes // packets > 50 and bytes // packets < 130 then 2 else 0 end + case when packets // flows < 10 or packets // flows > 20 then 1 else 0 end
+ case when active >= 5 and packets * 60 // active between 8 and 30 then 2 else 0 end + case when req_flows * 10 > flows * 9 then 3 else 0 end + case when active >= 300 then 3 else 0 end as score from v""")
def miner_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = miner.suspects(flows(spark, sf_dir).withColumn("listed", F.lit(False)))
    return s.select(*miner.KEYS, (F.col("ack_flows") + F.col("ackpush_flows") + F.col("other_flows")).alias("flows"), miner.score().alias("score"))


@query(f"""with {samples.LISTS_SQL}, pools as (select distinct network as ip, coalesce(port, 0) as port from l), {_SUSPECTS.replace("min(case when tcp_flags in (16, 24) then seq end)", "min(case when listed or tcp_flags in (16, 24) then seq end)").replace("as first from f)", '''as first from (
  select f.*, exists (select 1 from pools b where b.ip % 4 = 1 + 1 and b.ip = f.dst_ip and b.port in (0, f.dst_port)) as listed from f
  where not exists (select 1 from pools w where w.ip % 4 = 1 and w.ip = f.dst_ip and w.port in (0, f.dst_port)) and not exists (select 1 from pools b where b.ip % 4 = 2 and b.ip = f.src_ip and b.port in (0, f.src_port))))''')},
v as (select *, ack_flows + ackpush_flows + other_flows as flows, last_seen - first_seen as active from u),
x as (select *, case when (ack_flows + ackpush_flows) * 100 // flows >= 80 then 2 else 0 end + case when bytes // packets > 50 and bytes // packets < 130 then 2 else 0 end + case when packets // flows < 10 or packets // flows > 20 then 1 else 0 end
+ case when active >= 5 and packets * 60 // active between 8 and 30 then 2 else 0 end + case when req_flows * 10 > flows * 9 then 3 else 0 end + case when active >= 300 then 3 else 0 end as score from v)
select src_ip, dst_ip, dst_port, ack_flows, ackpush_flows, other_flows, req_flows, packets, bytes, first_seen, last_seen, score from x where score >= 5 and packets > 2 and req_flows > 0""")
def miners(spark: SparkSession, sf_dir: str) -> DataFrame:
    pools = samples.list_entries(spark, sf_dir).select(F.col("network").alias("pool_ip"), F.coalesce("port", F.lit(0)).alias("pool_port"))
    white, black = pools.filter("pool_ip % 4 = 1"), pools.filter("pool_ip % 4 = 2")
    tree = {"column": "packets", "most": 2, "yes": 0, "no": {"column": "req_flows", "most": 0, "yes": 0, "no": 1}}
    return miner.miners(miner.suspects(miner.candidates(flows(spark, sf_dir), black, white)), 5, tree)


@query(f"with recursive {FLOWS_SQL}, {machines_sql.exports(60, 3600)}")
def miner_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return miner.exports(flows(spark, sf_dir))


@query(f"""with {FLOWS_SQL}, a as (select seq, src_ip, dst_ip, src_port, case when seq % 2 = 0 then 25 else dst_port end as dst_port, packets, bytes, tcp_flags, t_last - t_last % 3000 as start, case when seq % 3 = 0 then 5 + case when seq % 5 = 0 then 1 else 0 end else 0 end + case when seq % 4 = 0 then 1 else 0 end + case when seq % 7 = 0 then 1 else 0 end - case when tcp_flags > 2 then 1 else 0 end as score from f),
b as (select * from a where src_port in (25,143,465,587,993,995) or dst_port in (25,143,465,587,993,995)),
o as (select src_ip as host, start, count(*) as outgoing, sum(bytes) as sent_bytes, sum(packets) as sent_packets, count(distinct dst_ip) as peers, sum(score) as points from b group by 1, 2), i as (select dst_ip as host, start, count(*) as incoming, sum(bytes) as received_bytes from b group by 1, 2)
select coalesce(o.host, i.host) as host, coalesce(o.start, i.start) as start, coalesce(outgoing, 0) as outgoing, coalesce(incoming, 0) as incoming, cast(coalesce(sent_bytes, 0) as bigint) as sent_bytes, cast(coalesce(received_bytes, 0) as bigint) as received_bytes, cast(coalesce(sent_packets, 0) as bigint) as sent_packets, coalesce(peers, 0) as peers, cast(coalesce(points, 0) as bigint) as points from o full join i on o.host = i.host and o.start = i.start""")
def mail_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return smtp.entities(samples.mails(spark, sf_dir), 3000).drop("senders")


@query(f"""select host, start, outgoing, incoming, peers, points, cast(floor(confidence * 1000 + 1e-9) as bigint) as confidence_thousandths from (select *, 1 / (1 + exp(-(case when outgoing > 0 then points * 1.0 / outgoing else 0 end + case when incoming = 0 and outgoing > 0 then ln(outgoing) else 0 end + case when peers > 10 then 1 else -1 end
+ case when outgoing > 0 and incoming * 1.0 / outgoing <= 1.2 then 1 else -1 end) / 2.0)) as confidence from ({ORACLES["mail_hosts"]})) where confidence > 0.6""")
def spammers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = smtp.spammers(smtp.entities(samples.mails(spark, sf_dir), 3000), 0.6)
    return found.select("host", "start", "outgoing", "incoming", "peers", "points", F.floor(F.col("confidence") * 1000 + 1e-9).alias("confidence_thousandths"))


_RULES: list[web.Rule] = [("digits", r"[0-9]{3,}", ["path"]), ("letters", r"(?i)th|er", ["host", "path"]), ("any", r"^http", ["url"])]


@query(f"""with {samples.REQUESTS_SQL} select seq, case when regexp_matches(path, '[0-9]{{3,}}') then 'digits' when regexp_matches(host, '(?i)th|er') or regexp_matches(path, '(?i)th|er') then 'letters' else 'any' end as rule,
case when regexp_matches(path, '[0-9]{{3,}}') then 'path' when regexp_matches(host, '(?i)th|er') then 'host' when regexp_matches(path, '(?i)th|er') then 'path' else 'url' end as field from r where regexp_matches(path, '[0-9]{{3,}}') or regexp_matches(host, '(?i)th|er') or regexp_matches(path, '(?i)th|er') or regexp_matches(url, '^http')""")
def web_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.first_matches(samples.requests(spark, sf_dir), _RULES).select("seq", "rule", "field")


@query(f"""with {FLOWS_SQL}, v as (select src_ip, protocol, count(*) as flows, cast(sum(packets) as bigint) as packets, cast(sum(bytes) as bigint) as bytes, count(distinct dst_ip) as dst_ips, count(distinct dst_port) as dst_ports, count(distinct src_port) as src_ports, count(distinct dst_ip // 256) as subnets, min(t_first) as t_start, max(t_last) as t_end from f group by 1, 2)
select src_ip, protocol, flows, dst_ips, dst_ports, src_ports, subnets, cast(floor(dst_ports * 1000.0 / flows) as bigint) as ports_thousandths, greatest(t_end - t_start, 1) as duration from v where flows >= 30 and t_end - t_start between 30 and 720000 and src_ip // 2 * 2 <> 167772160""")
def backscatter_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = backscatter.features(backscatter.gated(backscatter.observed(flows(spark, sf_dir)), [(167772160, 31)], 30, 30, 720000))
    return f.select("src_ip", "protocol", "flows", "dst_ips", "dst_ports", "src_ports", "subnets", F.floor(F.col("dst_ports_share") * 1000 + 1e-9).alias("ports_thousandths"), F.col("duration").cast("long").alias("duration"))


@query(f"""with {FLOWS_SQL}, v as (select src_ip, protocol, count(*) as flows, count(distinct dst_port) as dst_ports, min(t_first) as t_start, max(t_last) as t_end from f group by 1, 2),
p as (select *, 1 / (1 + exp(-5 * (dst_ports * 1.0::double / flows - 0.2))) as probability from v where flows >= 30 and t_end - t_start between 30 and 720000)
select src_ip, protocol, flows, dst_ports, cast(floor(probability * 1000000) as bigint) as millionths from p where probability > 0.5""")
def backscatter_classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = backscatter.features(backscatter.gated(backscatter.observed(flows(spark, sf_dir)), [], 30, 30, 720000))
    found = backscatter.classified(f, lambda x: 1 / (1 + (-5 * (x["dst_ports_share"] - 0.2)).map(lambda v: 2.718281828459045**v)), 0.5)
    return found.select("src_ip", "protocol", "flows", "dst_ports", F.floor(F.col("probability") * 1000000).alias("millionths"))


#: Lines of a list with IPv6 networks, in several spellings.
_LINES6 = ["# networks", "2001:db8::/32,1", "2001:db8:3::/48,2", "2001:db8:5::10/124,4", "2001:0DB8:0005:0000::0011,8", "10.0.0.0/8,16", "2001:db8::/129,32", "no address,64"]


@query("""with e as (select event_id as seq, user_id % 16 as u, event_id % 65536 as low from events)
select seq, cast(1 | case when u = 3 then 2 else 0 end | case when u = 5 and low between 16 and 31 then 4 else 0 end | case when u = 5 and low = 17 then 8 else 0 end as bigint) as bitmap from e where u <> 7""")
def listed_ipv6(spark: SparkSession, sf_dir: str) -> DataFrame:
    u, low = F.col("user_id") % 16, F.col("event_id") % 65536
    address = F.concat(F.when(u == 7, "2001:db7:").otherwise("2001:db8:"), F.lower(F.hex(u)), F.lit("::"), F.hex(low))
    f = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("seq"), ip.ipv6_bytes(address).alias("address"))
    entries = lists.ip_entries(lists.without_comments(spark.createDataFrame([(x,) for x in _LINES6], "value string"))).filter("network6 is not null")
    return lookups.prefix_matches6(f, "address", entries.select("network6", "prefix", "bitmap")).groupBy("seq").agg(F.bit_or("bitmap").alias("bitmap"))


# Sources, sets and reports


@query(r"""with l as (select doc_id, unnest(string_split(text, chr(10))) as value from documents), e as (select regexp_extract(value, '((?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9]))', 1) as entity from l where not regexp_matches(value, '^\s*([#;].*)?$'))
select entity, count(*) as n from e where entity <> '' group by 1""")
def extracted_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.explode(F.split("text", "\n")).alias("value"))
    return lists.extracted(lists.without_comments(each), "ipv4").groupBy("entity").agg(F.count("*").alias("n"))


@query("""with d as (select user_id % 50 as ip, event_id % 900 as port, event_type as kind from events)
select 'x' || ip as entity, string_agg(distinct cast(port as varchar), ',' order by cast(port as varchar)) as ports from d where kind = 'error' group by 1""")
def json_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.to_json(F.struct(F.concat(F.lit("net-x"), (F.col("user_id") % 50).cast("string")).alias("ip"), (F.col("event_id") % 900).alias("port"), F.col("event_type").alias("kind"))).alias("value"))
    found = lists.json_entries(e, "ip", {"kind": "error"}, "net-", "port")
    return found.select("entity", F.array_join(F.array_sort(F.transform("ports", lambda p: p.cast("string"))), ",").alias("ports"))


@query(f"""with {FLOWS_SQL}, a as (select distinct src_ip, dst_port from f where seq % 2 = 0), b as (select distinct src_ip, dst_port from f where seq % 3 = 0)
select src_ip, dst_port, 'gone' as change from (select * from a except select * from b) union all select src_ip, dst_port, 'new' from (select * from b except select * from a)""")
def list_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = flows(spark, sf_dir).select("seq", "src_ip", "dst_port")
    old, new = (f.filter(F.col("seq") % n == 0).drop("seq").distinct() for n in (2, 3))
    return blacklist.changes(old, new)


@query(f"""with {samples.NAMES_SQL}, h as (select client, is_request, least(size // 10, case when is_request then 29 else 149 end) as bin, count(*) as n from d group by 1, 2, 3), r as (select *, row_number() over (partition by client, is_request order by n desc, bin) as k from h)
select client, is_request, bin, n from r where k = 1""")
def fullest_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = samples.names(spark, sf_dir).withColumn("round", F.lit(0))
    return dnstunnel.fullest_bin(dnstunnel.histograms(d), ["client", "is_request"])


@query(f"""with {samples.NAMES_SQL} select least(size // 10, 149) * 10 as size_from, count(*) as n, row_number() over (order by count(*) desc, least(size // 10, 149)) as place from d group by least(size // 10, 149)""")
def size_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.histogram_report(aggregates.clipped_histogram(samples.names(spark, sf_dir), [], "size", 10, 150), 10)


@query(f"""with {samples.REQUESTS_SQL} select seq, regexp_replace(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '^$', '/') as path, array_to_string(list_sort(list_distinct(regexp_extract_all(split_part(url, '#', 1), '[?&][^=&]*=([^&]*)', 1))), ',') as arg_values, array_to_string(list_sort(list_distinct(regexp_extract_all(split_part(url, '#', 1), '[?&]([^=&]*)=[^&]*', 1))), ',') as arg_names, http_method || ' ' || host || ' ' || url as request from r""")
def request_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = projections.http_parts(samples.requests(spark, sf_dir).drop("path"), "http_method", "host", "url")
    return p.select("seq", F.when(F.coalesce("path", F.lit("")) == "", "/").otherwise(F.col("path")).alias("path"), F.array_join("arg_values", ",").alias("arg_values"), F.array_join("arg_names", ",").alias("arg_names"), "request")


@query(f"""with {FLOWS_SQL}, {samples.LISTS_SQL}, m as (select f.seq, 'c' || list_id as country, row_number() over (partition by f.seq order by prefix desc, 'c' || list_id desc) as k from f join l on f.src_ip // (1::bigint << (32 - prefix)) = network // (1::bigint << (32 - prefix)))
select f.seq, m.country from f left join m on f.seq = m.seq and k = 1""")
def source_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = samples.list_entries(spark, sf_dir).groupBy("network", "prefix").agg(F.max(F.concat(F.lit("c"), F.col("list_id").cast("string"))).alias("country"))
    wide = ranges.withColumn("network", ip.mask(F.col("network"), F.col("prefix"))).groupBy("network", "prefix").agg(F.max("country").alias("country"))
    return lists.countries(flows(spark, sf_dir).select("seq", "src_ip"), "src_ip", wide).select("seq", "country")


@query(f"""with {FLOWS_SQL}, {samples.LISTS_SQL}, p as (select distinct network as pool_ip, coalesce(port, 0) as pool_port from l)
select seq, dst_ip, dst_port from f where exists (select 1 from p where pool_ip = dst_ip and pool_port in (0, dst_port)) and not exists (select 1 from p where pool_ip = src_ip and pool_port in (0, src_port))""")
def pool_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    pools = samples.list_entries(spark, sf_dir).select(F.col("network").alias("pool_ip"), F.coalesce("port", F.lit(0)).alias("pool_port"))
    return lookups.in_pool(lookups.in_pool(flows(spark, sf_dir), pools, "dst_ip", "dst_port"), pools, "src_ip", "src_port", "left_anti").select("seq", "dst_ip", "dst_port")


@query(f"""with {FLOWS_SQL}, e as (select dst_port % 7 as scenario, src_ip as entity, dst_ip as target, dst_port as port, 3232235520 as controller from f), c as (select 3232235521 as entity union all select 3232235520)
select scenario, count(distinct case when target = controller then entity end) as own, count(distinct case when port between 1100 and 1110 then entity end) as irc, count(distinct case when target <> controller and target in (select entity from c) then entity end) as other from e group by 1""")
def evidence_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = flows(spark, sf_dir).select((F.col("dst_port") % 7).alias("scenario"), F.col("src_ip").alias("entity"), F.col("dst_ip").alias("target"), F.col("dst_port").alias("port"), F.lit(3232235520).alias("controller"))
    return blacklist.evaluated(e, spark.createDataFrame([(3232235521,), (3232235520,)], "entity long"), (1100, 1110))


@query(f"""with {FLOWS_SQL}, a as (select src_ip as entity, case when seq % 11 = 0 then 0 else t_last end as added from f), r as (select *, row_number() over (partition by entity order by case when added = 0 then 0 else 1 end, added desc) as k from a)
select entity, added from r where k = 1 and (added = 0 or 1704070000 - added <= 86400)""")
def valid_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = flows(spark, sf_dir).select(F.col("src_ip").alias("entity"), F.when(F.col("seq") % 11 == 0, 0).otherwise(F.col("t_last")).alias("added"))
    return blacklist.latest(a, "entity", "added", 1704070000)


@query(f"""with {_PAIRS} select server, client, case when q then 'Q' else 'R' end as way, t_last, packets, bytes, seq from w""")
def pair_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return amplification.flow_log(_both_ways(spark, sf_dir), _LIMITS).drop("t_first")


_SIDES = ", ".join(f"count(*) filter (where {way}) as {p}_flows, " + ", ".join(f"coalesce(sum({c}) filter (where {way}), 0) as {p}_{c}" for c in ("packets", "bytes")) for p, way in (("q", "q"), ("r", "not q")))
_JUDGED = f"""t as (select id, {_SIDES}, max(packets) filter (where q) as q_most, max(bytes) filter (where q) as q_max, max(bytes) filter (where not q) as r_max from u group by id),
d as (select id, {_SIDES} from r group by id),
{_tops('not q', 'bytes', ' and bytes < 5000', 'rb', 'id', 'u')}, {_tops('not q', 'packets', '', 'rp', 'id', 'u')}, {_tops('q', 'bytes', ' and bytes < 5000', 'qb', 'id', 'u')},
v as (select t.*, q_packets >= 30 and r_packets // q_packets >= 5 as heavy, rb.share as share, rb.n as n, rp.mean as rp_mean, rb.mean as rb_mean, coalesce(qb.mean, 0) as qb_mean, rb.mean_bin as rb_bin, qb.mean_bin as qb_bin from t left join rb using (id) left join rp using (id) left join qb using (id) where q_flows > 0 and r_flows > 0)
select server, client, case when heavy then 'big' else 'complex' end as kind, {", ".join(f"cast(v.{c} - coalesce(d.{c}, 0) as bigint) as {c}" for c in ("q_flows", "q_packets", "q_bytes", "r_flows", "r_packets", "r_bytes"))}, ts_first, ts_last from v join j using (id) left join d using (id)
where case when heavy then (q_most > 1000 or r_max > 100000) and r_max // greatest(1, q_max) > 0 else share > 0.1 and n > 2 and rp_mean > 0 and rb_mean > 10 and qb_mean < 100000 and coalesce(rb_bin // qb_bin > 0, false) end"""


@query(f"with recursive {_PAIRS}, {machines_sql.sliding(1000, 500, _JUDGED)}")
def amplified_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return amplification.sliding(_both_ways(spark, sf_dir), _LIMITS)


# Sources


def _lines(spark: SparkSession, sf_dir: str, table: str, value: Column) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").select(value.alias("value"))


@query(f"""with {FLOWS_SQL}, {samples.NAMES_SQL}, u as (select 'flows' as input, bytes as size, protocol from f union all select 'names', size, null from d) select input, count(*) as n, cast(sum(size) as bigint) as bytes, count(protocol) as with_protocol from u group by 1""")
def tagged_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = lists.tagged({"flows": flows(spark, sf_dir).select(F.col("bytes").alias("size"), "protocol"), "names": samples.names(spark, sf_dir).select("size")})
    return both.groupBy("input").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), F.count("protocol").alias("with_protocol"))


@query(rf"""with l as (select unnest(string_split(text, chr(10))) as value from documents), e as (select regexp_extract(value, '{lists.URL_IN_TEXT}', 1) as entity from l) select entity, count(*) as n from e where entity <> '' group by 1""")
def extracted_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = _lines(spark, sf_dir, "documents", F.explode(F.split("text", "\n")))
    return lists.extracted(each, "url").groupBy("entity").agg(F.count("*").alias("n"))


@query(rf"""with l as (select 'host ' || case c_custkey % 3 when 0 then '2001:db8:0:0:0:0:0:' || c_custkey % 97 when 1 then '2001:db8::' || c_custkey % 97 || ':1' else 'none' end || ' up' as value from customer), e as (select regexp_extract(value, '{lists.IPV6_IN_TEXT}', 1) as entity from l) select entity, count(*) as n from e where entity <> '' group by 1""")
def extracted_ipv6(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    last = (k % 97).cast("string")
    line = F.concat(F.lit("host "), F.when(k % 3 == 0, F.concat(F.lit("2001:db8:0:0:0:0:0:"), last)).when(k % 3 == 1, F.concat(F.lit("2001:db8::"), last, F.lit(":1"))).otherwise("none"), F.lit(" up"))
    return lists.extracted(_lines(spark, sf_dir, "customer", line), "ipv6").groupBy("entity").agg(F.count("*").alias("n"))


@query(r"""select 's' || s_suppkey || '.example' as name, cast(s_suppkey % 7 as bigint) as bitmap from supplier where s_suppkey % 5 <> 0""")
def name_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    line = F.concat(F.lit("s"), k.cast("string"), F.lit(".example"), F.when(k % 5 == 0, "").otherwise(F.concat(F.lit("\\"), (k % 7).cast("string"))))
    return lists.name_entries(_lines(spark, sf_dir, "supplier", line))


@query("""select 'e' || c_custkey % 40 as entity, count(*) as n from customer where c_custkey % 6 <> 0 group by 1""")
def csv_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    cell = F.concat(F.lit("e"), (k % 40).cast("string"))
    line = F.when(k % 6 == 0, "x").otherwise(F.concat(F.lit("x;"), F.when(k % 2 == 0, F.concat(F.lit(' "'), cell, F.lit('" '))).otherwise(cell), F.lit(";y")))
    return lists.csv_column(_lines(spark, sf_dir, "customer", line), 2, ";").groupBy("entity").agg(F.count("*").alias("n"))


@query("""with n as (select n_nationkey as k, 167772160 + n_nationkey as network, case n_nationkey % 3 when 0 then 'src' when 1 then 'dst' else 'all' end as direction, cast(case when n_nationkey % 4 = 0 then 32 else 24 + n_nationkey % 8 end as int) as prefix from nation)
select cast(network as bigint) as network, prefix, direction, cast(case when k % 4 in (0, 1) then null when k % 4 = 2 then 22 else p end as int) as port_from, cast(case when k % 4 in (0, 1) then null when k % 4 = 2 then 22 else q end as int) as port_to from (select n.*, 80 as p, 90 as q from n union all select n.*, 443, 443 from n where k % 4 = 3)""")
def white_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    network = F.concat(F.lit("10.0.0."), k.cast("string"), F.when(k % 4 == 0, "").otherwise(F.concat(F.lit("/"), (24 + k % 8).cast("string"))), F.when(k % 4 == 2, "/22").when(k % 4 == 3, "/80-90,443").otherwise(""))
    return lists.whitelist(_lines(spark, sf_dir, "nation", F.concat(F.when(k % 3 == 0, "src ").when(k % 3 == 1, "dst ").otherwise(""), network, F.lit("  # remark"))))


@query("""select cast(167772160 + n_nationkey as bigint) as pool_ip, cast(case when n_nationkey % 2 = 0 then 3333 else 0 end as int) as pool_port from nation where n_nationkey % 5 <> 0""")
def pool_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    return lists.pools(_lines(spark, sf_dir, "nation", F.when(k % 5 == 0, "no address").otherwise(F.concat(F.lit("10.0.0."), k.cast("string"), F.when(k % 2 == 0, ":3333").otherwise("")))))


@query("""select '^p' || n_nationkey || '$' as pattern, 'HOST,URL' as fields from nation where n_nationkey % 3 <> 0""")
def rule_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey")
    line = F.concat(F.lit("^p"), k.cast("string"), F.lit("$"), F.when(k % 3 == 0, " * HOST").otherwise(" ** HOST, URL"))
    return lists.rules(_lines(spark, sf_dir, "nation", line)).withColumn("fields", _joined(F.col("fields")))


@query(f"""with {samples.REQUESTS_SQL} select seq, regexp_extract(lower(path), 'the|in|e', 0) as word from r where regexp_matches(lower(path), 'the|in|e')""")
def words_of_a_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    pattern = lists.any_word(["in", "e", "the"])
    return samples.requests(spark, sf_dir).select("seq", F.regexp_extract(F.lower("path"), f"({pattern})", 1).alias("word")).filter("word <> ''")


@query(f"""with {FLOWS_SQL} select seq, t_last, src_ip, dst_ip, bytes, 'n' || seq || '.example' as name, case when seq % 2 = 0 then 'a' || seq end as answer from f where seq % 7 <> 0""")
def dns_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, s = flows(spark, sf_dir), F.col("seq").cast("string")
    fields = [s, F.concat(F.col("t_last").cast("string"), F.lit(".25")), ip.ipv4_text(F.col("src_ip")), ip.ipv4_text(F.col("dst_ip")), F.col("bytes").cast("string"), F.concat(F.lit("n"), s, F.lit(".example"))]
    line = F.when(F.col("seq") % 7 == 0, "short\tline").otherwise(F.concat(F.concat_ws("\t", *fields), F.when(F.col("seq") % 2 == 0, F.concat(F.lit("\ta"), s)).otherwise("")))
    return lists.dns_dump(f.select(line.alias("value")))


@query(f"""with {FLOWS_SQL}, {samples.REQUESTS_SQL} select r.seq, dst_port from r join f on r.seq = f.seq where dst_port <> 443 and src_port <> 443 and (r.seq % 3 <> 0)""")
def plain_http(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = samples.requests(spark, sf_dir).select("seq", F.when(F.col("seq") % 3 != 0, F.col("http_method")).alias("http_method"))
    return flows(spark, sf_dir).join(r, "seq").filter(filters.plain_http_request()).select("seq", "dst_port")


@query(f"""with {samples.REQUESTS_SQL}, x as (select distinct lower(host) as domain from r where seq % 10 = 0) select seq, host from r where not exists (select 1 from x where lower(host) = domain or lower(host) like '%.' || domain)""")
def without_excepted_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = samples.requests(spark, sf_dir)
    excepted = r.filter("seq % 10 = 0").select(F.col("host").alias("domain"))
    return filters.without_domains(r.select("seq", "host"), "host", excepted)


@query(f"""with {samples.REQUESTS_SQL} select distinct host as value, ('0x' || left(sha256(host), 15))::bigint as code from r""")
def host_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.dictionary(samples.requests(spark, sf_dir), "host")


@query(f"""with {FLOWS_SQL}, d as (select seq as id, src_ip from f where seq % 50 = 0)
select d.id, d.src_ip, a.client, count(*) as n from d left join (select f.src_ip as client, x.id from f, lateral (select distinct unnest([seq - seq % 50, seq - seq % 100]) as id) x where seq % 9 = 0) a on d.id = a.id group by 1, 2, 3""")
def merged_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = flows(spark, sf_dir)
    s = F.col("seq")
    adaptive = f.filter(s % 9 == 0).select(F.col("src_ip").alias("client"), F.concat_ws(", ", (s - s % 50).cast("string"), (s - s % 100).cast("string")).alias("adaptive_ids"))
    return blacklist.merged_evidence(f.filter(s % 50 == 0).select(s.alias("id"), "src_ip"), adaptive).groupBy("id", "src_ip", "client").agg(F.count("*").alias("n"))


# Sinks


@query("""with e as (select distinct cast(167772160 + s_suppkey % 40 as bigint) as number, cast(s_nationkey % 7 + 1 as int) as list_id, cast(case when s_suppkey % 3 = 0 then s_nationkey end as int) as port from supplier),
b as (select number, cast(bit_or(1::bigint << (list_id - 1)) as bigint) as bitmap from e group by 1), p as (select number, list_id, list_id || ':' || string_agg(port::varchar, ',' order by port) as part from e where port is not null group by 1, 2),
q as (select number, string_agg(part, ';' order by list_id) as parts from p group by 1)
select number, concat_ws('.', number // 16777216, number // 65536 % 256, number // 256 % 256, number % 256) || ',' || bitmap || case when parts is null then '' else ';' || parts end as line from b left join q using (number)""")
def detector_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    e = spark.read.parquet(f"{sf_dir}/supplier.parquet").select((167772160 + s % 40).cast("long").alias("number"), (F.col("s_nationkey") % 7 + 1).cast("int").alias("list_id"), F.when(s % 3 == 0, F.col("s_nationkey")).cast("int").alias("port"))
    by_list = e.groupBy("number", "list_id").agg(F.array_sort(F.collect_set("port")).alias("ports"))
    maps = F.map_from_entries(F.filter(F.collect_list(F.struct("list_id", "ports")), lambda x: F.size(x["ports"]) > 0))
    return sinks.detector_file(by_list.groupBy("number").agg(F.bit_or(bits.of_id(F.col("list_id"))).alias("bitmap"), maps.alias("ports")))


@query(f"""with a as ({_VERTICAL}), t as (select *, concat_ws('.', src_ip // 16777216, src_ip // 65536 % 256, src_ip // 256 % 256, src_ip % 256) as src, strftime(make_timestamp(ts_last * 1000000), '%Y-%m-%d') as day from a)
select seq, '{{"Event":{{"info":"scan of ' || dst_ip || '","date":"' || day || '","Attribute":[{{"type":"ip-src","category":"Network activity","value":"' || src || '"}}]}}}}' as document from t""")
def misp_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = vertical_scan(spark, sf_dir)
    found = F.array(F.struct(F.lit("ip-src").alias("type"), F.lit("Network activity").alias("category"), ip.ipv4_text(F.col("src_ip")).alias("value")))
    return a.select("seq", sinks.misp_event(F.concat(F.lit("scan of "), F.col("dst_ip").cast("string")), found, F.date_format(F.timestamp_seconds("ts_last"), "yyyy-MM-dd")).alias("document"))


@query(_VERTICAL.replace("select src_ip, dst_ip, seq, cast(open_ports as bigint) as port_cnt, src_port, dst_port, t_last as ts_last from a", """select '{"src_ip":' || src_ip || ',"dst_ip":' || dst_ip || ',"port_cnt":' || cast(open_ports as bigint) || ',"ts_last":' || t_last || '}' as value from a"""))
def alerts_as_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.as_json(vertical_scan(spark, sf_dir).select("src_ip", "dst_ip", "port_cnt", "ts_last"))


@query(f"""with a as (select *, left(sha256(concat_ws(':', src_ip, dst_ip, seq)), 32) as id from ({_VERTICAL})),
t as (select *, concat_ws('.', src_ip // 16777216, src_ip // 65536 % 256, src_ip // 256 % 256, src_ip % 256) as src, concat_ws('.', dst_ip // 16777216, dst_ip // 65536 % 256, dst_ip // 256 % 256, dst_ip % 256) as dst, strftime(make_timestamp(ts_last * 1000000), '%Y-%m-%dT%H:%M:%SZ') as detected from a)
select id, '{{"Format":"IDEA0","ID":"' || id || '","Category":["Recon.Scanning"],"DetectTime":"' || detected || '","Source":[{{"IP4":["' || src || '"]}}],"Target":[{{"IP4":["' || dst || '"]}}],"FlowCount":' || port_cnt || ',"Node":[{{"Name":"sluice.vertical_scan","Type":["Flow","Statistical"]}}]}}' as document from t""")
def alerts_as_idea(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = vertical_scan(spark, sf_dir)
    identity = sinks.event_id(F.col("src_ip"), F.col("dst_ip"), F.col("seq"))
    return a.select(identity.alias("id"), sinks.idea("Recon.Scanning", "sluice.vertical_scan", identity, F.col("ts_last"), F.array(ip.ipv4_text(F.col("src_ip"))), F.array(ip.ipv4_text(F.col("dst_ip"))), count=F.col("port_cnt")).alias("document"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vertical_scan(spark, sf_dir)


from sluice import catalogue_state as _state  # noqa: E402, F401  its queries use what stands above

"""Flow queries on ranges, trees, sketches, words and kept tables, with the SQL that DuckDB answers alike."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import machines_sql, samples
from sluice.catalogue import _RULES, _VERTICAL, _joined, query, vertical_scan
from sluice.functions import bits, ip, text
from sluice.operators import hierarchy, intervals, projections, words
from sluice.plans import backscatter, blacklist, hosts, scan, smtp, web
from sluice.schema import FLOWS_SQL, flows
from sluice.sources import lists, sinks
from sluice.storage import Snapshots, shared_folder
from sluice.streaming import stateful, timers


@query(f"with recursive {FLOWS_SQL}, p as (select * from f where packets = 1 and protocol = 6 and tcp_flags = 2), {machines_sql.horizontal(2, 1500)}")
def horizontal_scan_resets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan.horizontal_spread(flows(spark, sf_dir), 2, 1500).withColumn("samples", _joined(F.col("samples")))


@query(f"""with {FLOWS_SQL}, h as (select src_ip as host, unnest([t_last - t_last % 150 - 150, t_last - t_last % 150]) as start, dst_ip from f)
select host, start, count(distinct dst_ip) as peers from h group by 1, 2""")
def peer_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts.peers(hosts.peer_halves(flows(spark, sf_dir)))


@query(f"""with {FLOWS_SQL}, k as (select src_ip, dst_ip, dst_port, max(seq) as seq, max(seq) filter (where seq % 2 = 0) as seq0, max(seq) filter (where seq % 2 = 1) as seq1 from f group by all),
a as (select *, row_number() over (order by seq0, src_ip, dst_ip, dst_port) as number from k where seq0 is not null),
b as (select *, (select count(*) from a) + row_number() over (order by seq1, src_ip, dst_ip, dst_port) as number from k where seq0 is null)
select k.src_ip, k.dst_ip, k.dst_port, k.seq, f.packets, f.t_last, k.number from (select * from a union all select * from b) k join f on f.seq = k.seq""")
def peers_over_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = Snapshots(spark, f"{shared_folder(spark)}/peers-{uuid.uuid4().hex}")
    f = flows(spark, sf_dir).select("src_ip", "dst_ip", "dst_port", "seq", "packets", "t_last")
    for half in (0, 1):
        kept.upsert(f.filter(F.col("seq") % 2 == half), ["src_ip", "dst_ip", "dst_port"], "seq", "number")
    return kept.read()


_RANGES_SQL = """r as (select distinct 167772160 + s_suppkey % 20 - 3 as low, 167772160 + s_suppkey % 20 - 3 + s_suppkey * 7 % 11 as high, 'n' || s_nationkey as value from supplier)"""


def _ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ranges that overlap and nest, from the suppliers."""
    k = F.col("s_suppkey")
    low = F.lit(167772160) + k % 20 - 3
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select(low.cast("long").alias("first"), (low + k * 7 % 11).cast("long").alias("last"), F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("value"))


@query(f"""with {FLOWS_SQL}, {_RANGES_SQL}, m as (select f.seq, value, row_number() over (partition by f.seq order by high - low, value) as k from f join r on src_ip between low and high)
select f.seq, f.src_ip, m.value as owner from f left join m on f.seq = m.seq and k = 1""")
def range_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _ranges(spark, sf_dir).select(ip.hex_of_ipv4(F.col("first")).alias("low"), ip.hex_of_ipv4(F.col("last")).alias("high"), "value")
    f = flows(spark, sf_dir).select("seq", "src_ip", ip.hex_of_ipv4(F.col("src_ip")).alias("address"))
    return intervals.located(f, "address", intervals.pieces(r), "owner").select("seq", "src_ip", "owner")


@query(f"""with {_RANGES_SQL}, e as (select event_id as seq, 167772160 + user_id % 16 as own, event_id % 3 = 0 as v6 from events),
m as (select seq, value, row_number() over (partition by seq order by high - low, value) as k from e join r on own between low and high where v6)
select e.seq, case when v6 then coalesce(m.value, 'site') end as owner from e left join m on e.seq = m.seq and k = 1""")
def range_owners_ipv6(spark: SparkSession, sf_dir: str) -> DataFrame:
    site = "20010db8"
    r = _ranges(spark, sf_dir)
    at = lambda n: F.concat(F.lit(site), F.lower(F.lpad(F.hex(n), 24, "0")))
    own = r.select(at(F.col("first")).alias("low"), at(F.col("last")).alias("high"), "value")
    whole = spark.range(1).select(F.lit(site.ljust(32, "0")).alias("low"), F.lit(site.ljust(32, "f")).alias("high"), F.lit("site").alias("value"))
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("seq"), F.when(F.col("event_id") % 3 == 0, at(F.lit(167772160) + F.col("user_id") % 16)).otherwise(ip.hex_of_ipv4(F.lit(167772160) + F.col("user_id") % 16)).alias("address"))
    return intervals.located(e, "address", intervals.pieces(own.union(whole)), "owner").select("seq", "owner")


_TREE_SQL = f"""{samples.NAMES_SQL}, c as (select client, name, string_split(name, '.') as labels from d),
t as (select client, unnest(generate_series(1, len(labels))) as level, labels from c), u as (select client, level, array_to_string(labels[len(labels) - level + 1:], '.') as domain, case when level > 1 then array_to_string(labels[len(labels) - level + 2:], '.') else '' end as parent from t),
n as (select client, level, domain, parent, count(*) as n from u group by all having count(*) >= 3),
k as (select *, row_number() over (partition by client, parent order by n desc, domain) as place, sum(n) over (partition by client, parent) as every from n)"""


@query(f"""with recursive {_TREE_SQL}, w as (select client, level, domain, n, every from k where level = 1 and place = 1 union all select k.client, k.level, k.domain, k.n, k.every from w join k on k.client = w.client and k.parent = w.domain and k.place = 1)
select client, cast(level as int) as level, domain, n, cast(n * 1000 // every as bigint) as share from w""")
def main_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.main_path(hierarchy.levels(samples.names(spark, sf_dir), ["client"], "name", 3), ["client"])


@query(f"with {_TREE_SQL.partition(f',{chr(10)}k as')[0]} select client, cast(level as int) as level, domain, parent, n from n")
def domain_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hierarchy.levels(samples.names(spark, sf_dir), ["client"], "name", 3)


@query("""with recursive e as (select distinct 'h' || (event_id % 211) as name, case when event_id % 11 = 0 then '10.0.0.' || (event_id % 200) else 'h' || ((event_id * 7 + 3) % 211) end as target from events),
s as (select distinct 'h' || (n_nationkey * 5) as start from nation), w as (select start, start as name, 0 as step from s union select w.start, e.target, step + 1 from w join e on e.name = w.name where step < 10)
select start, count(distinct name) as names, count(distinct name) filter (where regexp_matches(name, '^10\\.')) as addresses from w group by 1""")
def answers_followed(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    host = lambda n: F.concat(F.lit("h"), n.cast("string"))
    answers = spark.read.parquet(f"{sf_dir}/events.parquet").select(host(e % 211).alias("name"), F.when(e % 11 == 0, F.concat(F.lit("10.0.0."), (e % 200).cast("string"))).otherwise(host((e * 7 + 3) % 211)).alias("target"))
    start = spark.read.parquet(f"{sf_dir}/nation.parquet").select(host(F.col("n_nationkey") * 5).alias("name"))
    found = hierarchy.reached(start, answers, 10)
    return found.groupBy("start").agg(F.count("*").alias("names"), F.count_if(F.col("name").rlike(r"^10\.")).alias("addresses"))


@query("""with w as (select distinct regexp_extract(lower(url), '[a-z]+([a-z]{4})', 1) as word from pages union select distinct lower(n_name) from nation), k as (select word from w where word <> '')
select page_id as seq, word, cast(len(list_filter(generate_series(1, length(html) - length(word) + 1), lambda i: substr(lower(html), i, length(word)) = word)) as bigint) as n from pages, k where contains(lower(html), word)""")
def words_in_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select(F.col("page_id").alias("seq"), F.lower("html").alias("html"), "url")
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet").select(F.lower("n_name").alias("word"))
    return words.hits(pages, "seq", "html", pages.select(F.regexp_extract(F.lower("url"), "[a-z]+([a-z]{4})", 1).alias("word")).union(nations))


#: The stream's parts, its lateness, and how long after the last flow the row comes that moves the watermark past all.
_PARTS, _LATE, _LONG_AFTER = 2, 420, 86_400


@query(f"with recursive {FLOWS_SQL}, h as (select src_ip as host, seq, t_last, packets, bytes from f union all select dst_ip, seq, t_last, packets, bytes from f), {machines_sql.timeouts(300, 30)}")
def host_records_by_timers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flows as a stream in parts by time; of the last minutes of a part a fifth comes a part late; records end by timers."""
    folder = f"{shared_folder(spark)}/records-{uuid.uuid4().hex}"
    rows = projections.roles(flows(spark, sf_dir)).select("host", "t_last", "seq", F.col("outgoing").cast("int").alias("way"), "packets", "bytes")
    low, high = rows.agg(F.min("t_last"), F.max("t_last")).first()
    if low is None:
        return spark.createDataFrame([], timers.RECORD)
    width = -(-(high - low + 1) // _PARTS)
    late = ((F.col("seq") % 5 == 0) & ((F.col("t_last") - low) % width >= width - _LATE // 2)).cast("int")
    part = F.floor((F.col("t_last") - low) / width) + late
    mark = rows.limit(1).withColumns({"host": F.lit(-1).cast("long"), "t_last": F.lit(high + _LONG_AFTER).cast("long")})
    parts = [*(rows.filter(part == at) for at in range(_PARTS + 1)), mark]
    found = timers.run_parts(spark, parts, folder, lambda df: timers.host_records(stateful.with_event_time(df, f"{_LATE} seconds")))
    return found.filter("host >= 0")


@query()
def backscatter_trained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources by ten minutes, labelled by whether their packets are large; a fifth is held out. The model is saved and read back."""
    f = flows(spark, sf_dir).withColumn("start", F.col("t_last") - F.col("t_last") % 600)
    large = f.groupBy("src_ip", "protocol", "start").agg((F.sum("bytes") > 34 * F.sum("packets")).cast("int").alias("label"))
    ready = backscatter.features(backscatter.observed(f, "start")).join(large, ["src_ip", "protocol", "start"])
    ready = ready.withColumn("held_out", F.crc32(F.concat_ws(":", "src_ip", "protocol", "start")) % 5 == 0)
    folder = f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"
    backscatter.trained(ready.filter(~F.col("held_out"))).save(folder)
    found = backscatter.judged(ready, PipelineModel.load(folder))
    return found.select("src_ip", "protocol", "start", "label", "held_out", (F.col("probability") > 0.5).cast("int").alias("predicted"))


# Rows of what is written and read again


@query(_VERTICAL)
def alerts_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts appended in two runs to a table parted by the target, and read again."""
    path = f"{shared_folder(spark)}/alerts-{uuid.uuid4().hex}"
    a = vertical_scan(spark, sf_dir)
    for half in (0, 1):
        sinks.write_alerts(a.filter(F.col("seq") % 2 == half), path, "dst_ip")
    return spark.read.schema(a.schema).parquet(path).select(*a.columns)


@query("""select cast(s_suppkey as bigint) as id, s_name as name, s_nationkey * 10 as every, case when s_suppkey % 3 > 0 then 'list ' || s_suppkey % 4 end as list from supplier""")
def settings_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Settings as XML, as another program leaves them."""
    k = F.col("s_suppkey")
    path = f"{shared_folder(spark)}/settings-{uuid.uuid4().hex}"
    said = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(k.cast("long").alias("id"), F.col("s_name").alias("name"), (F.col("s_nationkey") * 10).alias("every"), F.when(k % 3 > 0, F.concat(F.lit("list "), (k % 4).cast("string"))).alias("list"))
    said.write.format("xml").option("rowTag", "module").option("rootTag", "settings").save(path)
    return lists.settings(spark, path, "module", "id long, name string, every int, list string")


@query(f"""with {FLOWS_SQL}, b as (select src_ip as host, t_last - t_last % 3000 as start, case when seq % 4 > 0 then 's' || seq % 9 end as sender from f where src_port in (25,143,465,587,993,995) or seq % 2 = 0 or dst_port in (25,143,465,587,993,995)),
d as (select host, start, sender, row_number() over (partition by host, start order by sender) as k from (select distinct host, start, sender from b where sender is not null))
select host, start, string_agg(sender, ',' order by sender) as senders from d where k <= 5 group by 1, 2""")
def mail_senders(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = smtp.entities(samples.mails(spark, sf_dir), 3000).filter(F.size("senders") > 0)
    return found.select("host", "start", F.array_join("senders", ",").alias("senders"))


@query(f"""with {samples.REQUESTS_SQL} select seq, case when regexp_matches(path, '[0-9]{{3,}}') then 'digits' else 'any' end as rule, case when regexp_matches(path, '[0-9]{{3,}}') then 'path' else 'url' end as field
from r where regexp_matches(path, '[0-9]{{3,}}') or regexp_matches(url, '^http')""")
def web_rules_enabled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return web.first_matches(samples.requests(spark, sf_dir), web.enabled(_RULES, {"letters", "unknown"})).select("seq", "rule", "field")


@query(f"""with {samples.REQUESTS_SQL}, {FLOWS_SQL}, u as (select seq as g, regexp_replace(regexp_replace(lower(host), '^www\\.', ''), '\\.$', '') as name, regexp_replace(regexp_replace(lower(host || path), '^www\\.', ''), '/$', '') as url from r),
x as (select u.name, u.url, f.*, unnest(case when length(u.url) % 3 = 0 then [length(u.url) % 8 + 1, 9] else [length(u.url) % 8 + 1] end) as list_id from f join u on f.seq = u.g where u.url in (select url from u where g % 2 = 0))
select name, url, dst_ip, protocol, cast(list_id as int) as list_id, t_first - t_first % 300 as start, count(*) as flows, count(distinct src_ip) as sources, cast(sum(packets) as bigint) as packets, cast(sum(bytes) as bigint) as bytes, min(t_first) as ts_first, max(t_last) as ts_last from x group by all""")
def listed_url_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flows and the pages of the same number as what they asked for; the URLs of every other page are listed."""
    asked = flows(spark, sf_dir).join(samples.requests(spark, sf_dir).select("seq", "host", "path"), "seq")
    name = text.url_key(F.col("host"), F.col("path"))
    bitmap = bits.of_id(F.length(name) % 8 + 1).bitwiseOR(F.when(F.length(name) % 3 == 0, bits.of_id(F.lit(9))).otherwise(F.lit(0).cast("long")))
    entries = samples.requests(spark, sf_dir).filter("seq % 2 = 0").select(name.alias("name"), bitmap.alias("bitmap")).distinct()
    return blacklist.rolled_up_urls(blacklist.match_urls(asked, "host", "path", entries), "host", "path")

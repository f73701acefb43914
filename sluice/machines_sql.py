"""SQL for DuckDB that answers as the state machines do: a recursive step from one row of a key to its next.

Each text expects the common table expressions named in its docstring before it, and ends with a select.
"""

from __future__ import annotations


def vertical(ports: int, idle: int) -> str:
    """p: probes. Ports toggle; an alert or an idle gap starts anew."""
    return f"""o as (select src_ip, dst_ip, dst_port, seq, t_first, t_last, row_number() over (partition by src_ip, dst_ip order by seq) as i from p),
s as (select src_ip, dst_ip, i, seq, [dst_port] as open, t_first as a, t_last as b, 0 as told from o where i = 1
union all select src_ip, dst_ip, i, seq, case when len(now) >= {ports} then [] else now end, a, b, case when len(now) >= {ports} then len(now) else 0 end from (
  select *, case when list_contains(prev, port) then list_filter(prev, lambda x: x <> port) else list_append(prev, port) end as now,
    case when len(prev) = 0 then t_first else least(a0, t_first) end as a, case when len(prev) = 0 then t_last else greatest(b0, t_last) end as b from (
      select o.src_ip, o.dst_ip, o.i, o.seq, o.dst_port as port, o.t_first, o.t_last, s.a as a0, s.b as b0, case when o.t_last - s.b > {idle} then [] else s.open end as prev
      from s join o on o.src_ip = s.src_ip and o.dst_ip = s.dst_ip and o.i = s.i + 1)))
select src_ip, dst_ip, cast(told as int) as port_cnt, seq, a as ts_first, b as ts_last from s where told > 0"""


def horizontal(addresses: int, idle: int) -> str:
    """p: single SYN flows. An alert clears the set; what follows one is told after an idle gap."""
    return f"""o as (select src_ip, dst_port, dst_ip, seq, t_first, t_last, row_number() over (partition by src_ip, dst_port order by seq) as i from p),
s as (select src_ip, dst_port, i, seq, [dst_ip] as met, [dst_ip] as full_set, t_first as a, t_last as b, false as alerted, false as told, false as tail, seq as seq0, [dst_ip] as met0, t_first as a0, t_last as b0 from o where i = 1
union all select src_ip, dst_port, i, seq, case when len(now) >= {addresses} then [] else now end, now, a, b, case when len(now) >= {addresses} then true else was end, len(now) >= {addresses}, tail, seq0, met0, a0, b0 from (
  select *, case when list_contains(prev, dst_ip) then prev else list_append(prev, dst_ip) end as now,
    case when len(prev) = 0 then t_first else least(a0, t_first) end as a, case when len(prev) = 0 then t_last else greatest(b0, t_last) end as b from (
      select o.src_ip, o.dst_port, o.dst_ip, o.i, o.seq, o.t_first, o.t_last, s.a as a0, s.b as b0, s.seq as seq0, s.met as met0, o.t_last - s.b > {idle} and s.alerted and len(s.met) > 0 as tail,
        case when o.t_last - s.b > {idle} then false else s.alerted end as was, case when o.t_last - s.b > {idle} then [] else s.met end as prev
      from s join o on o.src_ip = s.src_ip and o.dst_port = s.dst_port and o.i = s.i + 1)))
select src_ip, dst_port, cast(len(full_set) as int) as addr_cnt, seq, array_to_string(full_set[1:4], ',') as samples, a as ts_first, b as ts_last, false as "trailing" from s where told
union all select src_ip, dst_port, cast(len(met0) as int), seq0, array_to_string(met0[1:4], ','), a0, b0, true from s where tail"""


def timeouts(active: int, inactive: int) -> str:
    """h: host, seq, t_last, packets, bytes. Records end by age or by a gap."""
    return f"""o as (select *, row_number() over (partition by host order by t_last, seq) as i from h),
s as (select host, i, true as fresh, cast(1 as bigint) as flows, packets, bytes, t_last as a, t_last as b from o where i = 1
union all select host, i, fresh, case when fresh then 1 else flows + 1 end, case when fresh then packets else p0 + packets end, case when fresh then bytes else b0 + bytes end, case when fresh then t_last else a end, case when fresh then t_last else greatest(b, t_last) end from (
  select o.host, o.i, o.packets, o.bytes, o.t_last, s.flows, s.packets as p0, s.bytes as b0, s.a, s.b, o.t_last - s.a >= {active} or o.t_last - s.b >= {inactive} as fresh from s join o on o.host = s.host and o.i = s.i + 1)),
e as (select *, lead(fresh) over (partition by host order by i) as ends from s)
select host, flows, packets, bytes, a as ts_first, b as ts_last from e where coalesce(ends, true)"""


def exports(inactive: int, export: int) -> str:
    """f: flows. Suspects are told by age or when idle."""
    return f"""o as (select *, row_number() over (partition by src_ip, dst_ip, dst_port order by t_last, seq) as i from f),
s as (select src_ip, dst_ip, dst_port, i, true as fresh, cast(1 as bigint) as flows, packets, bytes, t_first as a, t_last as b from o where i = 1
union all select src_ip, dst_ip, dst_port, i, fresh, case when fresh then 1 else flows + 1 end, case when fresh then packets else p0 + packets end, case when fresh then bytes else b0 + bytes end, case when fresh then t_first else a end, case when fresh then t_last else greatest(b, t_last) end from (
  select o.src_ip, o.dst_ip, o.dst_port, o.i, o.packets, o.bytes, o.t_first, o.t_last, s.flows, s.packets as p0, s.bytes as b0, s.a, s.b, o.t_last - s.b > {inactive} or o.t_last - s.a >= {export} as fresh
  from s join o on o.src_ip = s.src_ip and o.dst_ip = s.dst_ip and o.dst_port = s.dst_port and o.i = s.i + 1)),
e as (select *, lead(fresh) over (partition by src_ip, dst_ip, dst_port order by i) as ends from s)
select src_ip, dst_ip, dst_port, flows, packets, bytes, a as first_seen, b as last_seen from e where coalesce(ends, true)"""


def guessing(every: int, least_share: float, least_events: int, matches: int, bottom: int = 50, size: int = 1000) -> str:
    """b: host, seq, incoming, hit, victim, t_last. NEW, ATTACK every so often, then END."""
    hits = "greatest(len(list_filter(l_in, lambda x: x.hit)), len(list_filter(l_out, lambda x: x.hit)))"
    longer = "greatest(len(l_in), len(l_out))"
    need = f"case when len(l_in) <= {bottom} or len(l_out) <= {bottom} then {matches} when {longer} < 100 then cast(floor({longer} * 0.9) as bigint) else {longer} // 100 * 90 end"
    names = {w: f"array_to_string(list_sort(list_distinct(list_transform(list_filter(l_{w}, lambda x: x.hit), lambda x: x.victim))), ',')" for w in ("in", "out")}
    victims = f"'I:' || {names['in']} || ';O:' || {names['out']} as victims"
    return f"""o as (select *, row_number() over (partition by host order by seq) as i from b),
z as (select host, 0 as i, cast([] as struct(hit boolean, victim bigint)[]) as l_in, cast([] as struct(hit boolean, victim bigint)[]) as l_out, cast(null as bigint) as reported, 0 as n_in, 0 as m_in, 0 as n_out, 0 as m_out, cast(0 as bigint) as seq, cast(0 as bigint) as t_last, cast(null as varchar) as state, cast(0 as bigint) as scale from (select distinct host from b)),
s as (select * from z
union all select host, i, l_in, l_out, case when state in ('NEW', 'ATTACK') then t_last when state is not null then null else reported end,
  case when state in ('NEW', 'ATTACK') then 0 else n_in end, case when state in ('NEW', 'ATTACK') then 0 else m_in end, case when state in ('NEW', 'ATTACK') then 0 else n_out end, case when state in ('NEW', 'ATTACK') then 0 else m_out end, seq, t_last, state, case when state = 'NEW' then need when state is not null then greatest(m_in, m_out) else 0 end from (
  select *, case when reported is null then case when {hits} >= need then 'NEW' end when t_last - reported < {every} then null
    when greatest(case when n_in > 0 then 100.0 * m_in / n_in else 0 end, case when n_out > 0 then 100.0 * m_out / n_out else 0 end) < {least_share} then case when greatest(m_in, m_out) >= {least_events} then 'REPORT_END' else 'END' end
    when greatest(m_in, m_out) >= {least_events} then 'ATTACK' end as state from (
    select *, {need} as need from (
      select o.host, o.i, o.seq, o.t_last, s.reported, case when o.incoming then list_append(case when len(s.l_in) >= {size} then s.l_in[2:] else s.l_in end, {{'hit': o.hit, 'victim': o.victim}}) else s.l_in end as l_in, case when o.incoming then s.l_out else list_append(case when len(s.l_out) >= {size} then s.l_out[2:] else s.l_out end, {{'hit': o.hit, 'victim': o.victim}}) end as l_out,
        s.n_in + case when s.reported is not null and o.incoming then 1 else 0 end as n_in, s.m_in + case when s.reported is not null and o.incoming and o.hit then 1 else 0 end as m_in,
        s.n_out + case when s.reported is not null and not o.incoming then 1 else 0 end as n_out, s.m_out + case when s.reported is not null and not o.incoming and o.hit then 1 else 0 end as m_out
      from s join o on o.host = s.host and o.i = s.i + 1))))
select host, seq, state, scale, t_last as ts, {victims} from s where state is not null
union all select host, seq, 'END', cast(greatest(m_in, m_out) as bigint), t_last, {victims} from (select *, row_number() over (partition by host order by i desc) as k from s) where k = 1 and reported is not null"""


def lifecycle(rate: int, source_rate: int, least_bytes: int, slots: int = 7, every: int = 300) -> str:
    """g: dst_net, minute, bytes, sources. A flood from its start to its end."""
    return f"""o as (select *, row_number() over (partition by dst_net order by minute) as i from g),
z as (select dst_net, cast(0 as bigint) as i, cast([] as struct(minute bigint, bytes bigint, sources bigint)[]) as past, cast(null as bigint) as started, cast(0 as bigint) as reported, cast(0 as bigint) as mean, cast(0 as bigint) as extra, cast(null as bigint) as told, false as ended, cast(0 as bigint) as told_bytes, cast(0 as bigint) as told_start from (select distinct dst_net from g)
union all select dst_net, i, case when ends then [here] when started0 is null then line else past0 end,
  case when ends then null when started0 is not null then started0 when begins then a.minute end,
  case when started0 is not null then case when reports then minute + 60 else reported0 end when begins then a.minute else 0 end,
  case when started0 is not null then mean0 else coalesce(m, 0) end,
  case when started0 is not null then extra0 + bytes - mean0 when begins then a.bytes + b.bytes - 2 * m else 0 end,
  case when ends then minute when reports then minute + 60 end, ends, case when ends then extra0 else extra0 + bytes - mean0 end, started0 from (
  select *, started0 is null and m is not null and a.bytes > greatest(m * {rate}, {least_bytes}) and b.bytes > greatest(m * {rate}, {least_bytes}) and a.sources > ms * {source_rate} and b.sources > ms * {source_rate} as begins,
    started0 is not null and bytes <= mean0 * {rate} as ends, started0 is not null and bytes > mean0 * {rate} and minute + 60 - reported0 >= {every} as reports from (
    select *, case when len(busy) > 0 then list_sum(list_transform(busy, lambda x: x.bytes)) // len(busy) end as m, case when len(busy) > 0 then list_sum(list_transform(busy, lambda x: x.sources)) // len(busy) end as ms from (
      select *, line[-2] as a, line[-1] as b, case when len(line) < 3 then [] else list_filter(line[:-3], lambda x: x.minute >= coalesce(list_min(list_transform(list_filter(line[:-3], lambda y: y.bytes <> 0), lambda y: y.minute)), 9223372036854775807)) end as busy from (
        select *, list_append(past0, here)[-{slots}:] as line from (
          select o.dst_net, o.i, o.minute, o.bytes, {{'minute': o.minute, 'bytes': o.bytes, 'sources': o.sources}} as here, z.past as past0, z.started as started0, z.reported as reported0, z.mean as mean0, z.extra as extra0
          from z join o on o.dst_net = z.dst_net and o.i = z.i + 1)))))),
last as (select *, row_number() over (partition by dst_net order by i desc) as k from z)
select dst_net, told_start as started, told as reported, told_bytes as bytes, ended from z where told is not null
union all select dst_net, started, reported, extra, true from last where k = 1 and started is not null"""


def sliding(window: int, slide: int, judged: str) -> str:
    """w: server, client, q, packets, bytes, t_first, t_last, seq. The history of each pair, judged when it is longer
    than the window; judged: a select over j (id, server, client, ts_first, ts_last), u (id and its flows) and r (id
    and the flows told before)."""
    item = "struct(t bigint, q boolean, bytes bigint, packets bigint)[]"
    return f"""o as (select server, client, q, cast(packets as bigint) as packets, cast(bytes as bigint) as bytes, t_first, t_last, row_number() over (partition by server, client order by t_last, seq, q) as i from w),
z as (select server, client, cast(0 as bigint) as i, cast([] as {item}) as line, cast([] as {item}) as kept, cast([] as {item}) as told, cast([] as {item}) as told0, cast(null as bigint) as first, cast(null as bigint) as first0, false as judged, cast(0 as bigint) as t_last from (select distinct server, client from o)
union all select server, client, i, line, case when judged then rest else line end, case when judged then rest else told0 end, told0, case when not judged then first0 when len(rest) > 0 then least(t_first, list_min(list_transform(rest, lambda x: x.t))) end, first0, judged, t_last from (
  select *, t_last - first0 > {window} as judged, list_filter(line, lambda x: t_last - x.t <= {window - slide}) as rest from (
    select o.server, o.client, o.i, o.t_first, o.t_last, list_append(z.kept, {{'t': o.t_first, 'q': o.q, 'bytes': o.bytes, 'packets': o.packets}}) as line, z.told as told0, coalesce(z.first, o.t_first) as first0
    from z join o on o.server = z.server and o.client = z.client and o.i = z.i + 1))),
j as (select row_number() over (order by server, client, i) as id, server, client, first0 as ts_first, t_last as ts_last, line, told0 from z where judged),
u as (select id, x.q as q, x.bytes as bytes, x.packets as packets from (select id, unnest(line) as x from j)),
r as (select id, x.q as q, x.bytes as bytes, x.packets as packets from (select id, unnest(told0) as x from j)),
{judged}"""


def rounds(calm_suspicion: int = 3, calm_attack: int = 5) -> str:
    """b: client, round, strange, confirmed. NEW, SUSPICION and ATTACK of each client."""
    return f"""o as (select *, row_number() over (partition by client order by round) as i from b),
z as (select client, cast(0 as bigint) as i, cast(0 as bigint) as round, 'NEW' as state, 'NEW' as before, cast(0 as bigint) as rounds from (select distinct client from b)
union all select client, i, round, case when confirmed then 'ATTACK' when strange and before = 'NEW' then 'SUSPICION' when before <> 'NEW' and n + 1 > case before when 'ATTACK' then {calm_attack} else {calm_suspicion} end then 'NEW' else before end, before,
  case when confirmed or (strange and before = 'NEW') or before = 'NEW' then 0 when n + 1 > case before when 'ATTACK' then {calm_attack} else {calm_suspicion} end then 0 else n + 1 end from (
  select o.client, o.i, o.round, o.strange, o.confirmed, z.state as before, z.rounds as n from z join o on o.client = z.client and o.i = z.i + 1))
select client, round, state, rounds from z where state <> before"""


def dial_plan(every: int, longest: int = 10, strings: int = 10) -> str:
    """c: caller, callee, ok, t_last, seq. Numbers a caller has tried; a check tells the longest end that too many share."""
    ends = f"flatten(list_transform(list_filter(nums, lambda x: not x.ok), lambda x: list_transform(generate_series(1, least({longest}, length(x.c))), lambda k: right(x.c, k::int))))"
    over = f"list_transform(list_filter(map_entries(list_aggregate({ends}, 'histogram')), lambda e: e.value > {strings}), lambda e: {{'less': -length(e.key), 'e': e.key}})"
    added = "case when list_contains(list_transform(nums, lambda x: x.c), callee) then list_transform(nums, lambda x: {'c': x.c, 'ok': x.ok or (x.c = callee and ok)}) else list_append(nums, {'c': callee, 'ok': ok}) end"
    gone = "list_filter(nums, lambda x: not x.ok and suffix(x.c, deepest))"
    return f"""o as (select caller, callee, ok, t_last, row_number() over (partition by caller order by t_last, seq) as i from c),
s as (select caller, 0::bigint as i, 0 as phase, cast([] as struct(c varchar, ok boolean)[]) as nums, t_last as checked, t_last as last, cast(null as varchar) as told, 0::bigint as strings, 0::bigint as tried from o where i = 1
union all select caller, case when deepest is null then i + 1 else i end, case when deepest is null then 0 else 1 end, case when deepest is null then {added} else list_filter(nums, lambda x: x.ok or not suffix(x.c, deepest)) end,
  case when checking then coalesce(t, last) else checked end, coalesce(t, last), deepest, case when deepest is null then 0 else len({gone}) end, len(nums) from (
    select *, case when checking then list_sort({over})[1].e end as deepest from (
      select s.caller, s.i, s.nums, s.checked, s.last, o.callee, o.ok, o.t_last as t, s.phase = 1 or o.caller is null or o.t_last - s.checked >= {every} as checking from s left join o on o.caller = s.caller and o.i = s.i + 1))
  where deepest is not null or t is not null)
select caller, told as suffix, strings, tried, last as ts_last from s where told is not null"""


def sip_guessing(attempts: int, clients: int, users: int, idle: int = 1800, check: int = 300, oks: int = 5) -> str:
    """a: server, client, user, ok, t_last, seq. Pairs of a server's clients and users; a check tells and forgets the idle ones."""
    own = "list_filter(pairs, lambda p: p.c = x)"
    due = "(final or len(list_filter({}, lambda p: now - p.last <= " + str(idle) + ")) = 0)"

    def event(kind: str, client: str, user: str, of: str) -> str:
        return f"""{{'kind': '{kind}', 'client': {client}, 'user': {user}, 'attempts': list_sum(list_transform({of}, lambda p: p.n))::bigint, 'parties': len({of})::bigint,
          'breach': list_min(list_transform({of}, lambda p: p.breach)), 'ts_first': list_min(list_transform({of}, lambda p: p.first)), 'ts_last': list_max(list_transform({of}, lambda p: p.last))}}"""

    of_user = "list_filter(left_over, lambda p: p.u = x)"
    many = f"(len({of_user}) >= {clients} and list_sum(list_transform({of_user}, lambda p: p.n)) >= {attempts})"
    none = "cast([] as struct(kind varchar, client bigint, \"user\" varchar, attempts bigint, parties bigint, breach bigint, ts_first bigint, ts_last bigint)[])"
    same = "p.c = client and p.u = \"user\""
    one = f"list_filter(kept, lambda p: {same})[1]"
    changed = f"""case when not ok and {one} is null then list_append(kept, {{'c': client, 'u': "user", 'n': 1::bigint, 'oks': 0, 'breach': null::bigint, 'first': now, 'last': now}})
      when not ok then list_transform(kept, lambda p: case when {same} then {{'c': p.c, 'u': p.u, 'n': p.n + 1, 'oks': p.oks, 'breach': p.breach, 'first': p.first, 'last': now}} else p end)
      when {one} is null then kept
      when {one}.n < {attempts} or {one}.oks + 1 > {oks} then list_filter(kept, lambda p: not ({same}))
      else list_transform(kept, lambda p: case when {same} then {{'c': p.c, 'u': p.u, 'n': p.n, 'oks': p.oks + 1, 'breach': coalesce(p.breach, now), 'first': p.first, 'last': now}} else p end) end"""
    return f"""o as (select server, client, "user", ok, t_last, row_number() over (partition by server order by t_last, seq) as i, count(*) over (partition by server) as n from a),
s as (select server, 0::bigint as i, n, cast([] as struct(c bigint, u varchar, n bigint, oks int, breach bigint, first bigint, last bigint)[]) as pairs, t_last as checked, {none} as told from o where i = 1
union all select server, i + 1, n, case when final then kept else {changed} end, case when reporting then now else checked end, list_concat(scans, others) from (
  select *, case when reporting then list_filter(left_over, lambda p: not list_contains(idle_users, p.u)) else left_over end as kept,
    case when reporting then list_concat(list_transform(list_filter(idle_users, lambda x: {many}), lambda x: {event('DBF', 'null::bigint', 'x', of_user)}),
      list_transform(list_filter(left_over, lambda q: list_contains(list_filter(idle_users, lambda x: not {many}), q.u) and q.n >= {attempts}), lambda q: {{'kind': 'BF', 'client': q.c, 'user': q.u, 'attempts': q.n, 'parties': 1::bigint, 'breach': q.breach, 'ts_first': q.first, 'ts_last': q.last}})) else {none} end as others from (
    select *, list_filter(list_distinct(list_transform(left_over, lambda p: p.u)), lambda x: {due.format(of_user)}) as idle_users from (
      select *, list_filter(pairs, lambda p: not list_contains(scanning, p.c)) as left_over, list_transform(scanning, lambda x: {event('SCAN', 'x', 'null::varchar', own)}) as scans from (
        select *, case when reporting then list_filter(list_distinct(list_transform(pairs, lambda p: p.c)), lambda x: len({own}) >= {users} and {due.format(own)}) else [] end as scanning from (
          select s.server, s.i, s.n, s.pairs, s.checked, o.client, o."user", o.ok, o.t_last as now, o.server is null as final, o.server is null or o.t_last - s.checked >= {check} as reporting
          from s left join o on o.server = s.server and o.i = s.i + 1 where s.i <= s.n))))))
select server, e.kind as kind, e.client as client, e."user" as "user", e.attempts as attempts, e.parties as parties, e.breach as breach, e.ts_first as ts_first, e.ts_last as ts_last from (select server, unnest(told) as e from s)"""

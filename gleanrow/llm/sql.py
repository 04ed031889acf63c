"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

import math

from . import codes, hashtree, hosts, mixing

OP1 = """
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
k as (select *, case when conv_id is null then row_number() over () end as alone from c),
n as (
  select *, row_number() over (partition by conv_id, alone order by turn nulls first, role, text) as i, count(*) over (partition by conv_id,
  alone) as n,
    length(regexp_replace(role, '([<\\[\\\\])', '\\1\\\\', 'g')) + length(regexp_replace(text, '([<\\[\\\\])', '\\1\\\\', 'g')) + 23 as size
  from k),
s as (select *, sum(size) over (partition by conv_id, alone order by i) as upto from n)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by i) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(upto) filter (role = 'assistant' or i = n) as bigint) as formatted_chars
from s group by conv_id, alone
"""

OP4 = """
with d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
b as (select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark),
k as (select item_id, w, least(13, len(w)) as n from b where len(w) > 0),
wins as (select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as win from (select item_id, w, n, unnest(range(1, len(w) - n +
  2)) as i from k)),
lens as (select distinct n from wins),
pos as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as win from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i
  from d, lens where len(w) >= n)),
hit as (select p.doc_id, p.i, p.n, x.item_id from pos p join wins x on p.win = x.win and p.n = x.n),
cov as (select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(i, i + n)) as j from (select distinct doc_id, i, n from
  hit)) group by doc_id),
its as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, cast(item_id as
  varchar) as item from hit) group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(c.n_hit, 0) as n_hit, coalesce(i.n_items, 0) as n_items,
  sha256(coalesce(i.items, '')) as items_sha256, coalesce(c.n_hit, 0) > 0 and 20 * coalesce(c.n_hit, 0) >= len(d.w) as contaminated
from d left join cov c on d.doc_id = c.doc_id left join its i on d.doc_id = i.doc_id
"""

#: The characters of [\\x20\\x09-\\x0D].
WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP3 = f"""
with l as (select r, doc_id, line, i, translate(trim(line, {WHITE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
  from (select r, doc_id, unnest(ls) as line, unnest(range(1, len(ls) + 1)) as i
    from (select row_number() over () as r, doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents))),
f as (select k, max(doc_id) as most from l where length(k) >= 40 group by k having count(distinct r) >= 5),
m as (select l.*, f.k is not null and l.doc_id is distinct from f.most as gone from l left join f on l.k = f.k)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped, sha256(coalesce(string_agg(line, chr(10) order by i) filter (not
  gone), '')) as kept_sha256
from m group by r, doc_id
"""

OP6 = """
with p as (select page_id, strlen(coalesce(html, '')) as n, sha256(coalesce(html, '')) as d from pages),
f as (select *, min(page_id) over (partition by d) as first from p)
select page_id, n as payload_bytes, d as payload_digest, case when n >= 100 and page_id <> first then 'revisit' else 'response' end as record_type,
  case when n >= 100 and page_id <> first then first end as refers_to
from f
"""


def _strength(groups: str) -> str:
    return f"""(select case when k < 2 or bad <= 0 or bad >= n then {hosts.STRONGEST}
      when n - nn / n <= k - 1 then {hosts.STRONGEST}
      when (bb - n * p * p) - (k - 1) * p * (1 - p) <= 0 then {hosts.STRONGEST}
      else least({hosts.STRONGEST}, greatest({hosts.WEAKEST}, 1 / (((bb - n * p * p) - (k - 1) * p * (1 - p)) / (p * (1 - p) * ((n - nn / n)
  - (k - 1)))) - 1)) end
    from (select *, bad / n as p from (select cast(count(*) as double) as k, cast(sum(n) as double) as n, cast(sum(bad) as double) as bad,
  cast(sum(n * n) as double) as nn, sum(cast(bad * bad as double) / n) as bb from {groups})))"""


def _rules() -> tuple[str, str]:
    rule = verdict = ""
    for kind, text in sorted(hosts.RULES, key=lambda r: -len(r[1])):
        name, slash, rest = text.partition("/")
        fits = f"(host = '{name}' or ends_with(host, '.{name}')) and starts_with(path, '{slash}{rest}')"
        rule, verdict = f"{rule} when {fits} then '{text}'", f"{verdict} when {fits} then '{kind}'"
    return f"case{rule} end", f"case{verdict} end"


def _sure() -> str:
    """Whether the beta(a, b) posterior is sure of a bad rate over MAX_BAD: hosts.below() in SQL."""
    mode, width = "ln(a / b)", "sqrt(1 / a + 1 / b)"
    low, high = f"greatest({mode} - {hosts.REACH} * {width}, -{hosts.FARTHEST})", f"least({mode} + {hosts.REACH} * {width}, {hosts.FARTHEST})"
    cut = math.log(hosts.MAX_BAD / (1 - hosts.MAX_BAD))
    height = lambda u: f"(a * ({u}) - (a + b) * ln(1 + exp({u})))"

    def area(start: str, end: str) -> str:
        step = f"(({end}) - ({start})) / {hosts.POINTS}"
        return f"list_sum(list_transform(range({hosts.POINTS}), lambda i: exp({height(f'({start}) + (i + 0.5) * {step}')} - {height(mode)}))) * {step}"

    left, right = area(low, f"{cut}"), area(f"{cut}", high)
    return f"case when {low} >= {cut} then true when {high} <= {cut} then false else {left} <= {1 - hosts.SURE} * ({left} + {right}) end"


def _op5() -> str:
    rule, verdict = _rules()
    bare = f"regexp_replace(host, '{hosts.HOST_CLUTTER}', '', 'g')"
    found = f"regexp_extract({bare}, '{hosts.DOMAIN}', 1)"
    address = f"regexp_matches({bare}, '{hosts.ADDRESS}')"
    domain = f"case when {address} or {found} = '' then {bare} else {found} end"
    suffix = f"case when {address} then '{hosts.ADDRESSES}' else regexp_extract({bare}, '{hosts.SUFFIX}', 1) end"
    sums = "sum(n) as n, sum(bad) as bad"
    return f"""
with u as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) end as rest from pages),
h as (select page_id, translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
  as host,
  coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path from u),
l as (select doc_id as page_id, case when quality = 0 or toxic = 1 then 1 else 0 end as bad from labels where quality is not null or toxic
  is not null),
hs as (select host, {domain} as domain, {suffix} as suffix, count(*) as n, sum(bad) as bad from h join l using (page_id) group by host),
ds as (select domain, suffix, {sums} from hs group by domain, suffix),
ss as (select suffix, {sums} from ds group by suffix),
al as (select coalesce(sum(bad), 0) + 1.0 as a, coalesce(sum(n) - sum(bad), 0) + 1.0 as b from ss),
m as (select (select a / (a + b) from al) as rate, {_strength('ss')} as ms, {_strength('ds')} as md, {_strength('hs')} as mh),
sp as (select suffix, bad + ms * rate as a, n - bad + ms * (1 - rate) as b from ss, m),
dp as (select domain, ds.bad + md * (a / (a + b)) as a, ds.n - ds.bad + md * (1 - a / (a + b)) as b from ds join sp using (suffix), m),
hp as (select host, hs.bad + mh * (a / (a + b)) as a, hs.n - hs.bad + mh * (1 - a / (a + b)) as b from hs join dp using (domain), m),
j as (select page_id, h.host, path, {rule} as rule, {verdict} as verdict, {domain} as domain, {suffix} as suffix from h)
select page_id, j.host, path, rule,
  coalesce(verdict, case when coalesce(x.bad, y.bad, z.bad, (select {_sure()} from (select cast(a as double) as a, cast(b as double) as b
  from al))) then 'block' else 'allow' end) as verdict
from j left join (select host, {_sure()} as bad from hp) x on j.host = x.host
  left join (select domain, {_sure()} as bad from dp) y on j.domain = y.domain
  left join (select suffix, {_sure()} as bad from sp) z on j.suffix = z.suffix
"""


def _op10() -> str:
    w = ", ".join(f"{float(x)}" for x in mixing.WEIGHTS)
    drawn = ", ".join(f"cast(('0x' || substr(md5(k || '|{h}'), {1 + 8 * j}, 8)) as ubigint) / {float(2**32)}" for h in range(mixing.HASHES) for j in range(mixing.DRAWS))
    return f"""
with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) as size, coalesce(cast(doc_id as
  varchar), 'null') as k from documents),
s as (select source, sum(size) as source_size from d group by source),
r as (select *, row_number() over (order by source nulls last) - 1 as r from s),
w as (select *, [{w}][r % {len(mixing.WEIGHTS)} + 1] as w, cast(source_size * {mixing.MAX_RATE} as double) as cap from r),
o as (select *, sum(source_size) over () * cast({mixing.SHARE} as double) - coalesce(sum(cap) over (order by cap / w, r rows between
  unbounded preceding and 1 preceding), 0) as lft, sum(w) over (order by cap / w, r rows between current row and unbounded following) as ws
  from w),
f as (select *, case when not cap * ws <= lft * w then lft / ws end as level from o),
t as (select source, source_size, coalesce(first_value(level ignore nulls) over (order by cap / w, r rows between unbounded preceding and
  current row) * w, cap) as target from f),
q as (select *, case when source_size > 0 then least({float(mixing.MAX_RATE)}, target / source_size) else 0 end as rate from t),
e as (select d.*, source_size, target, rate, unnest([{drawn}]) as draw, unnest(range({mixing.SEEDS})) as seed from d join q on d.source is
  not distinct from q.source),
g as (select source, seed, abs(sum(case when draw < rate - floor(rate) then size else 0 end) - any_value(target - floor(rate) *
  source_size)) as gap from e group by source, seed),
b as (select source, arg_min(seed, (gap, seed)) as seed from g group by source)
select doc_id, cast(size as bigint) as size, cast(source_size as bigint) as source_size, target, cast(size * (floor(rate) + case when draw <
  rate - floor(rate) then 1 else 0 end) as bigint) as taken
from e join b on e.source is not distinct from b.source and e.seed = b.seed
"""


def _race(tree: hashtree.Node) -> str:
    """The shard of key k, level by level: of each node's children the one with the least -ln(draw) / weight."""
    at = "0"
    for level in hashtree.by_level(tree):
        draw = lambda name: f"((cast('0x' || substr(md5(k || '|{name}'), 1, 13) as bigint) + 0.5) / {float(2**52)})"
        first = lambda own: f"list_sort([{', '.join(f'struct_pack(t := -ln({draw(name)}) / {weight}, child := {to})' for name, weight, to in own)}])[1].child"
        at = f"case {at} {' '.join(f'when {i} then {first(own)}' for i, own in enumerate(level))} end"
    return at


def _crc_table() -> str:
    # the table of CRC-32: eight halvings of each byte, with the polynomial where a bit falls out
    half = "case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end"
    rounds = f"select i, cast(i as bigint) v, 0 s from range(256) q(i) union all select i, {half}, s + 1 from r where s < 8"
    return f"with recursive r as ({rounds}) select list(v order by i) t from r where s = 8"


def _crc(text: str) -> str:
    """Unsigned CRC-32 of a text, with the table t."""
    return f"""xor(list_reduce(list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: cast('0x' || h as bigint)), lambda a, b: xor(a >> 8,
  t.t[(xor(a, b) & 255) + 1]), cast(4294967295 as bigint)), 4294967295)"""


def _op9(shards: int = 16) -> str:
    tree = hashtree.default_tree(shards)
    return f"""
with t as ({_crc_table()}),
d as (select doc_id, coalesce(text, '') as text, coalesce(cast(doc_id as varchar), 'null') as k from documents),
c as (select doc_id, k, cast(strlen(text) + 1 as bigint) as size,
  {_crc('text')} as text_crc32 from d, t),
s as (select *, 'key' as law, {_race(tree)} as shard, {_race(hashtree.add_shard(tree, shards))} as grown_shard from c),
e as (select *, cast('0x' || substr(md5(concat_ws('|', k, size, text_crc32, law, shard, grown_shard)), 1, 8) as bigint) % greatest(1,
  cast(ceil((select count(*) from documents) / {float(hashtree.CELL_ROWS * shards)}) as bigint)) as cell from s)
select doc_id, size, text_crc32, law, shard, row_number() over (partition by shard order by cell, doc_id nulls first, size, text_crc32) - 1
  as slot, grown_shard from e
"""


def _op11() -> str:
    """Every round compares all parts with all entries of their codebook."""
    far = "list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = ""
    for i in range(codes.ROUNDS + 1):
        steps += f""",
a{i} as materialized (select r, part, min(struct_pack(d := cast({far} as bigint), e := b.e)) as m from p join b{i} b using (part) group by r, part)"""
        if i < codes.ROUNDS:
            steps += f""",
b{i + 1} as materialized (select part, b.e, coalesce(x.x, b.x) as x from b{i} b left join (
  select part, e, list((s - ((s % n) + n) % n) // n order by j) as x from (
    select part, m.e as e, j, cast(sum(p.x[j]) as bigint) as s, count(*) as n from a{i} join p using (r, part), (select unnest(range(1, (select w from
      w) + 1)) as j) group by part, m.e, j) group by part, e) x using (part, e))"""
    last, parts = codes.ROUNDS, codes.PARTS
    return f"""
with f as (select vec_id, label, list_transform(embedding, lambda x: cast(floor(cast(x as double) * {codes.SCALE}) as bigint)) as v from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
w as (select len(v) as n, cast(ceil(len(v) / {float(parts)}) as bigint) as w from f order by vec_id nulls last, v limit 1),
k as materialized (select row_number() over (order by vec_id nulls last, v) - 1 as r, vec_id, label, list_concat(v, list_transform(range(w * {parts} - n),
  lambda i: cast(0 as bigint))) as v from f, w where len(v) = n),
p as materialized (select r, part, v[part * w + 1:(part + 1) * w] as x from k, w, (select unnest(range({parts})) as part)),
b0 as materialized (select part, r as e, x from p where r < {codes.ENTRIES}){steps},
t as (select r, string_agg(lpad(lower(to_hex(m.e)), 2, '0'), '' order by part) as code, cast(sum(m.d) as bigint) as error from a{last} group by r),
h as (select sha256(string_agg(array_to_string(x, ','), ',' order by part, e)) as codebooks_sha256 from b{last})
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256 from k join t using (r), h
"""


def _op13() -> str:
    """The shortest repair, from the last row to the first: w(q) is the best (cost, audit) from grammar state q on."""
    best = lambda *some: f"list_sort([{', '.join(some)}])[1]"
    way = lambda cost, label, q: f"struct_pack(c := w{q}.c + {cost}, a := '{label}' || w{q}.a)"

    def over(q: str, keeps: dict[str, str], written: str) -> str:
        """p(q), before inserts: Delete, Keep where the initial fits, Rerole to what is written here."""
        stays = "case when f in ('b', 'd') then 1000000 when f = 't' then 1 else 0 end"
        fits = [way(f"case when x = '{x}' then {stays} else 1000000 end", "K", to) for x, to in keeps.items()]
        return f"{best(way('3', 'D', q), *fits, way(f'2 + {stays}', 'R', written))} as p{q}"

    more = lambda q, some: f"struct_pack(c := p{q}.c + {2 * len(some)}, a := '{some}' || p{q}.a)"
    return f"""
with recursive t as ({_crc_table()}),
c as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
  {_crc("concat(coalesce(cast(conv_id as varchar), ' '), ':', coalesce(cast(turn as varchar), ' '))")} % 20 as k from conversations, t),
g as (select conv_id, row_number() over () as g from (select distinct conv_id from c)),
d as (select g, turn, case when k = 4 then 'user' else role end as role,
  case k when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
  unnest(range(case k when 0 then 0 when 3 then 2 else 1 end)) as copy from c join g on c.conv_id is not distinct from g.conv_id),
n as (select *, row_number() over (partition by g order by turn nulls first, role, text, copy) as i, substr(role, 1, 1) as x,
  rtrim(text, {WHITE}) as shown from d),
f as (select *, case when shown = '' then 'b' when row_number() over (partition by g, role, text order by i) > 1 then 'd'
    when right(shown, 1) not in ('.', '!', '?') then 't' else '' end as f,
  lag(x) over (partition by g order by i) || x not in ('su', 'ua', 'au') as broken from n),
m as (select g, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (f = 'b') as blank, count(*) filter (f = 'd')
  as duplicate, count(*) filter (f = 't') as truncated, count(*) filter (broken) as illegal, list(x order by i) as xs, list(f order by i) as fs
  from f group by g),
r as (
  select g, len(xs) as i, xs, fs, struct_pack(c := 0, a := '') as w0, struct_pack(c := 4, a := 'II') as ws, struct_pack(c := 2, a := 'I') as wu,
    struct_pack(c := 0, a := '') as wa from m
  union all
  select g, i - 1, xs, fs, {best("p0", more("u", "I"), more("a", "II"))}, {best("ps", more("u", "I"), more("a", "II"))},
    {best("pu", more("a", "I"), more("u", "II"))}, {best("pa", more("u", "I"), more("a", "II"))}
  from (select g, i, xs, fs, {over("0", {"s": "s", "u": "u"}, "u")}, {over("s", {"u": "u"}, "u")}, {over("u", {"a": "a"}, "a")},
    {over("a", {"u": "u"}, "u")} from (select *, xs[i] as x, fs[i] as f from r where i > 0))),
b as (select g, w0.c as cost, w0.a as audit from r where i = 0),
e as (select g, j, substr(audit, j, 1) as edit, j - len(replace(substr(audit, 1, j), 'I', '')) as inserts from (select *, unnest(range(1,
  len(audit) + 1)) as j from b)),
o as (select e.g, j, edit, f.role, f.text, f.x, row_number() over (partition by e.g order by j) as o from e left join f on e.g = f.g and
  e.edit <> 'I' and f.i = j - inserts where edit <> 'D'),
s as (select *, max(case when o = 1 and edit = 'K' and x = 's' then 1 else 0 end) over (partition by g) as led from o),
y as (select g, string_agg(case when edit = 'K' then role when (o - led) % 2 = 1 then 'user' else 'assistant' end || ':' || case when edit = 'I'
  then '' else text end, chr(10) order by j) as repaired from s group by g)
select conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
  coalesce(illegal, 0) as illegal, cast(coalesce(cost, 0) as bigint) as cost, coalesce(audit, '') as audit, sha256(coalesce(repaired, '')) as
  repaired_sha256
from g left join m using (g) left join b using (g) left join y using (g)
"""


#: op2 (XXH64), op7 and op8 (trained models) are beyond SQL: tests hold them against brute-force versions.
ORACLES = {"op1_chat_format": OP1, "op3_line_dedup": OP3, "op4_decontaminate": OP4, "op5_url_filter": _op5(), "op6_warc": OP6,
    "op9_shard": _op9(), "op10_mix": _op10(), "op11_vector_codes": _op11(), "op13_conversation_repair": _op13()}

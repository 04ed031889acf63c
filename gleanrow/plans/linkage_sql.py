"""DuckDB SQL of the linkage operators: name similarity, pair rules, and the greedy passes as recursions over ordered pairs."""

from __future__ import annotations

from ..functions import geo
from ..functions.options import Options
from .sql import _LEVEL, _STACK, ADDRESS, BLOCKS, L, OPS, TWINS, fused, hav

O = Options()


def similarity(a: str, b: str) -> str:
    """100 * 2 * LCS / (lengths) by one 127-bit row per letter: bit i is 0 where the sequence grows at a[i]."""
    full = f"((cast(1 as hugeint) << length({a})) - 1)"
    mask = f"coalesce(list_sum(list_transform(range(length({a})), lambda i: case when substr({a}, i + 1, 1) = c then cast(1 as hugeint) << i else cast(0 as hugeint) end)), 0)"
    masks = f"list_transform(list_filter(string_split({b}, ''), lambda c: c <> ''), lambda c: cast({mask} as hugeint))"
    row = f"list_reduce({masks}, lambda r, m: ((r + (r & m)) | (r - (r & m))) & {full}, {full})"
    return f"(200.0 * (length({a}) - bit_count({row})) / (length({a}) + length({b})))"


def _jaccard(a: str, b: str) -> str:
    return f"case when len({a}.sa) = 0 or len({b}.sa) = 0 then 1.0 else len(list_intersect({a}.sa, {b}.sa)) / len(list_distinct(list_concat({a}.sa, {b}.sa))) end"


def distinct_units(a: str, b: str) -> str:
    return f"({a}.platform = {b}.platform and (coalesce({a}.max_guests <> {b}.max_guests, false) or {_jaccard(a, b)} < {O.amenity_jaccard}))"


def rooms_match(a: str, b: str) -> str:
    same = [f"{a}.{c} = {b}.{c}" for c in ("bedrooms", "beds", "bathrooms")]
    return f"(coalesce({', '.join(same)}) is not null and {' and '.join(f'coalesce({x}, true)' for x in same)})"


#: Listings with amenities as a list (sa), and the blocks of the spatial joins.
_ROWS = ", s as (select *, lower(\"name\") nm, from_json(coalesce(amenities_json, '[]'), '[\"varchar\"]') sa from l)"
_CELLS = BLOCKS[len(L) :] + _ROWS.replace("from l)", "from c)")
_NEAR = "abs(a.bi - b.bi) <= 1 and abs(a.bj - b.bj) <= 1"
_D = hav("a", "b")

STRICT = f"{_CELLS}, t2 as (select a.id id_a, b.id id_b, {_D} d, {similarity('a.nm', 'b.nm')} similarity from s a join s b on a.id < b.id and {_NEAR} and {_D} <= {O.strict_distance_m} and not {distinct_units('a', 'b')})"
MATCHES = f"{_CELLS}, mt as (select * from (select a.id id_a, b.id id_b, {_D} d, {similarity('a.nm', 'b.nm')} similarity from s a join s b on a.platform = 'booking' and b.platform = 'airbnb' and {_NEAR} and {_D} < 100) where similarity >= {O.match_name})"

NAME_SIMILARITY = f"{L}{_CELLS} select a.id id_a, b.id id_b, {similarity('a.nm', 'b.nm')} similarity from s a join s b on a.id < b.id and {_NEAR} and {_D} <= {O.strict_distance_m}"
STRICT_PAIRS = f"{L}{STRICT} select id_a, id_b, round(d, 3) distance_m, similarity from t2 where similarity >= {O.strict_name}"
LINK_CLASSES = f"""{L}{STRICT}, lk as (select id_a, id_b from t2 where similarity >= {O.strict_name}),
 le as (select id_a id from lk union all select id_b from lk), lc as (select id, count(*) links from le group by id)
 select l.id, min(l.id) over (partition by platform, name, latitude, longitude, bedrooms, beds, bathrooms, max_guests, coalesce(amenities_json, '[]')) class_id,
  coalesce(links, 0) links from l left join lc using (id)"""
MATCHED_PAIRS = f"{L}{MATCHES} select id_a, id_b, round(d, 3) distance_m, similarity from mt"

ONE_TO_ONE = f"""{L.replace('with l', 'with recursive l', 1)}{MATCHES}, p as (select row_number() over (order by similarity desc, id_a,
  id_b) n, id_a, id_b from mt),
 w as (select cast(0 as bigint) n, cast([] as varchar[]) used, cast(null as varchar) a, cast(null as varchar) b
  union all select p.n, case when list_has_any(used, [id_a, id_b]) then used else list_concat(used, [id_a, id_b]) end, case when not
  list_has_any(used, [id_a, id_b]) then id_a end, case when not list_has_any(used, [id_a, id_b]) then id_b end
  from w join p on p.n = w.n + 1)
 select unnest([a, b]) id, 'xpg_' || substr(md5(least(a, b) || '|' || greatest(a, b)), 1, 16) group_id from w where a is not null"""

_SEQ = "(k * 2 + case when platform = 'booking' then 1 else 0 end)"
BATCH = f"""{L.replace('with l', 'with recursive l', 1)}{_CELLS}, q as (select *, {_SEQ} seq from s),
 nr as (select * from (select a.seq seq_a, b.seq seq_b, {similarity('a.nm', 'b.nm')} similarity from q a join q b on a.seq < b.seq and
  a.platform = b.platform and {_NEAR} and {_D} < {O.batch_distance_m}) where similarity >= {O.batch_name}),
 nb as (select seq, coalesce(list(seq_a) filter (seq_a is not null), []) before from q left join nr on seq_b = seq where seq in (select
  seq_a from nr union select seq_b from nr) group by seq),
 p as (select row_number() over (order by seq) n, seq, before from nb),
 w as (select cast(0 as bigint) n, cast([] as bigint[]) kept union all select p.n, case when list_has_any(kept, before) then kept else
  list_append(kept, seq) end from w join p on p.n = w.n + 1),
 last as (select kept from w order by n desc limit 1)
 select id, seq from q where seq not in (select seq from p) or list_contains((select kept from last), seq)"""

_KEYS = "flatten(list_transform(coalesce(ga.m, [a]), lambda x: list_transform(coalesce(gb.m, [b]), lambda y: least(x, y) || '|' || greatest(x, y))))"
#: OPS has the operators; TWINS' last expression the identity pairs.
GROUPS = f"""{OPS}{TWINS[TWINS.rindex(', tw as') :]}{STRICT},
 t1 as (select a.id id_a, b.id id_b, {similarity('a.nm', 'b.nm')} similarity, {rooms_match('a', 'b')} rooms from (select s.*, operator_id
  from s join op using (id)) a join (select s.*, operator_id from s join op using (id)) b
  on a.operator_id = b.operator_id and a.id < b.id and {_D} <= {O.relaxed_distance_m} and not {distinct_units('a', 'b')}),
 cand as (select 0 tier, cast(100 as double) similarity, id_a, id_b from tw union select 1, similarity, id_a, id_b from t1 where similarity
  >= {O.relaxed_name} or rooms union select 2, similarity, id_a, id_b from t2 where similarity >= {O.strict_name}),
 e as (select id_a a, id_b b from cand union select id_b, id_a from cand),
 reach as (select a, b from e union select r.a, e.b from reach r join e on r.b = e.a),
 cc as (select a id, least(a, min(b)) comp from reach group by a),
 bad as (select x.comp, list(a.id || '|' || b.id) filter (not near_relaxed) relaxed, list(a.id || '|' || b.id) filter (not near_strict) strict
  from (select x.comp, x.id ia, y.id ib from cc x join cc y on x.comp = y.comp and x.id < y.id) x join s a on a.id = ia join s b on b.id = ib,
  lateral (select not {distinct_units('a', 'b')} ok, {_D} d, {similarity('a.nm', 'b.nm')} sim),
  lateral (select ok and d <= {O.relaxed_distance_m} and (sim >= {O.relaxed_name} or {rooms_match('a', 'b')}) near_relaxed, ok and d <=
  {O.strict_distance_m} and sim >= {O.strict_name} near_strict) group by x.comp),
 p as (select comp, row_number() over (partition by comp order by tier, similarity desc, id_a, id_b) n, tier, id_a, id_b from cand join cc
  on cc.id = id_a),
 w as (select distinct cast(0 as bigint) n, comp, cast([] as struct(m varchar[], f boolean)[]) gs from p
  union all select n, comp, case
    when ga is null and gb is null then list_append(gs, {{'m': [a, b], 'f': tier < 2}})
    when ga is not null and gb is not null and ga.m = gb.m then gs
    when list_has_any({_KEYS}, coalesce(case when tier < 2 then relaxed else strict end, [])) then gs
    else list_append(list_filter(gs, lambda g: not list_has_any(g.m, [a, b])), {{'m': list_concat(coalesce(ga.m, [a]), coalesce(gb.m, [b])),
  'f': tier < 2 or coalesce(ga.f, false) or coalesce(gb.f, false)}}) end
  from (select p.n, p.comp, p.tier, p.id_a a, p.id_b b, w.gs, bad.relaxed, bad.strict, list_filter(w.gs, lambda g: list_contains(g.m,
  p.id_a))[1] ga, list_filter(w.gs, lambda g: list_contains(g.m, p.id_b))[1] gb
   from w join p on p.comp = w.comp and p.n = w.n + 1 left join bad on bad.comp = p.comp)),
 fin as (select comp, unnest(arg_max(gs, n)) g from w group by comp)
 select unnest(g.m) id, 'pg_' || substr(md5(array_to_string(list_sort(g.m), '|')), 1, 16) group_id, len(list_distinct(list_transform(g.m,
  lambda x: split_part(x, '_', 1)))) = 2 cross_platform, g.f by_identity from fin"""

_GROUP_ROWS = "select unnest(g.m) id, 'pg_'"
_AT = GROUPS.rindex(_GROUP_ROWS)
_SIGMA = f"""case when platform = 'booking' then case when street and stack_count < {O.stack_min} then {O.sigma_address} else {O.sigma_vague} end
  when radius_m is null then {O.sigma_fuzzed} when radius_m = 0 then {O.sigma_exact} else greatest({O.sigma_fuzzed}, radius_m * 0.7) end"""
_OWN = "case when platform = 'booking' then case when street then 'exact' else 'approximate' end when radius_m = 0 then 'exact' when radius_m is not null then 'approximate' end"
_SEQ_OF = "struct_pack(phase := {}, id := {}, rank := {})"
_SEEN = "union all select {}, r.platform, r.key, {}, {}, {} sigma_m, '{}', " + _SEQ_OF
#: Geocodes of addresses and an older snapshot, as q_curate_observed makes them.
GEOCODES = """, gc as (select lower(regexp_replace(address, '\\s+', ' ', 'g')) address_norm, min(latitude) + 0.001 glat, min(longitude) + 0.001 glng
  from ad where platform = 'booking' and address is not null group by 1)"""


def curate(observed: bool) -> str:
    """The whole plan: groups, observations, fused positions per group and per row, conflicts, offsets, labels.

    observed: with geocodes within the drift limit and an older snapshot's positions.
    """
    drift = hav("r", "gc").replace("gc.latitude", "gc.glat").replace("gc.longitude", "gc.glng")
    near = f"r join gc on r.platform = 'booking' and gc.address_norm = lower(regexp_replace(r.address, '\\s+', ' ', 'g')) and {drift} <= {O.max_drift_m}"
    geo_seen = _SEEN.format("gn.id", "glat", "glng", O.sigma_geocoded, "geocoded", 0, "gn.id", 1) + " from gn join r using (id)"
    history = f"case when r.platform = 'booking' then {O.history_sigma_a} else {O.history_sigma_b} end"
    old_seen = _SEEN.format("r.id", "latitude + 0.0005", "longitude", history, "scraped", 1, "r.id", 0) + " from r"
    return f"""{GROUPS[:_AT].rstrip()}, grp as ({GROUPS[_AT:]}){ADDRESS[len(L) :]}{_STACK}{GEOCODES},
 sl as (select *, coalesce(regexp_matches(address, '{_LEVEL}'), false) street from st),
 r as (select *, coalesce(group_id, id) key, {_SIGMA} sigma_m, {_OWN} own from sl left join grp using (id)),
 gn as (select r.id, glat, glng from {near if observed else "r join gc on false"}),
 o as (select id listing_id, platform, key, latitude, longitude, sigma_m, 'scraped' source, {_SEQ_OF.format(0, 'id', 0)} seq from r
  {geo_seen + " " + old_seen if observed else ""}),
 {fused('o', 'key', 'fk')}, {fused('o', 'listing_id', 'fl')},
 cf as (select a.key from o a join o b on a.key = b.key and a.platform = 'booking' and b.platform = 'airbnb' group by a.key having max({_D}) > {O.disagreement_m}),
 pa as (select group_id, coalesce(glat, latitude) latitude, coalesce(glng, longitude) longitude from r left join gn using (id) where cross_platform and platform = 'booking'),
 pb as (select group_id, latitude, longitude from r where cross_platform and platform = 'airbnb'),
 om as (select a.group_id, round(median({hav('b', 'a')}), 1) offset_m from pa a join pb b on a.group_id = b.group_id group by 1),
 ch as (select r.*, cf.key is not null or coalesce(radius_m = 0, false) alone, fk.fx kx, fk.fy ky, fk.s ks, fk.d kd, fk.src ksrc, fl.fx lx, fl.fy ly, fl.s ls, fl.d ld, fl.src lsrc
  from r left join cf on cf.key = r.key join fk on fk.g = r.key join fl on fl.g = r.id),
 fx as (select *, case when alone then lx else kx end x, case when alone then ly else ky end y, case when alone then ls else ks end s,
  case when alone then ld else kd end dom, case when alone then lsrc else ksrc end src from ch)
 select fx.id, operator_id, fx.group_id, case when cross_platform then fx.group_id end cross_group_id,
 round({geo.ANCHOR_LAT} + y / {geo.METRES_PER_DEGREE}, 6) latitude_best, round({geo.ANCHOR_LNG} + x / {geo.METRES_PER_DEGREE_LNG!r}, 6) longitude_best, round(s, 1) est_accuracy_m,
 case when not alone and dom <> fx.id then 'transferred_from_twin' when src = 'geocoded' then 'geocoded_address' else 'platform_coord' end location_source,
 case when s <= {O.exact_max_sigma} then 'exact' else 'approximate' end location_precision, case when cross_platform then offset_m end offset_m, own platform_precision
 from fx left join op on op.id = fx.id left join om on om.group_id = fx.group_id"""


SQL = {
    "q_curate": curate(False),
    "q_curate_observed": curate(True),
    "q_name_similarity": NAME_SIMILARITY,
    "q_strict_pairs": STRICT_PAIRS,
    "q_component_changes": OPS + """, size as (select root, count(*) n from comp group by root)
 select id node, root component from comp join size using (root) where n > 1""",
    "q_link_classes": LINK_CLASSES,
    "q_matched_pairs": MATCHED_PAIRS,
    "q_greedy_one_to_one": ONE_TO_ONE,
    "q_batch_dedup": BATCH,
    "q_property_groups": GROUPS,
}

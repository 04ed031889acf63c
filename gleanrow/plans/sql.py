"""DuckDB SQL of the catalogue's queries."""

from __future__ import annotations

from ..functions import geo, text
from ..functions.options import Options
from .views import LISTINGS, OBSERVATIONS, duck_view

O = Options()
_REG = "nullif(regexp_replace(regexp_replace(lower(registration), '[^a-z0-9]', '', 'g'), '^ro', ''), '')"
_DIG = "regexp_replace(phone, '\\D', '', 'g')"
_NAT = f"case when {_DIG} like '0040%' and length({_DIG}) >= 13 then substr({_DIG}, 5) when {_DIG} like '40%' and length({_DIG}) >= 11 then substr({_DIG}, 3) when {_DIG} like '0%' and length({_DIG}) >= 10 then substr({_DIG}, 2) else {_DIG} end"
_TEL = f"case when length({_NAT}) >= 9 then right({_NAT}, 9) end"
_MAIL = "case when regexp_full_match(lower(trim(email)), '[^@\\s]+@[^@\\s]+\\.[^@\\s]+') then lower(trim(email)) end"

L = f"with l as ({duck_view(LISTINGS)}), n as (select *, {_REG} reg, {_TEL} tel, {_MAIL} mail from l)"
KEYS = L + ", k as (select distinct id, platform, unnest([reg, tel, mail]) ikey from n), ks as (select * from k where ikey is not null)"
OPS = KEYS.replace("with l", "with recursive l", 1) + """,
 near as (select distinct x.id a, y.id b from ks x join ks y using (ikey)),
 walk as (select a, b from near union select w.a, n2.b from walk w join near n2 on w.b = n2.a),
 comp as (select a id, min(b) root from walk group by a),
 opk as (select root, 'op_' || substr(md5(string_agg(distinct ikey, '|' order by ikey)), 1, 16) operator_id from comp join ks using (id)
  group by root),
 op as (select id, operator_id from comp join opk using (root))"""
TWINS = KEYS + ", tw as (select ikey \"key\", max(id) filter (platform = 'booking') id_a, max(id) filter (platform = 'airbnb') id_b from ks group by ikey having count(*) filter (platform = 'booking') = 1 and count(*) filter (platform = 'airbnb') = 1)"
OBS = f"with o as ({duck_view(OBSERVATIONS)})"


def hav(a: str, b: str, lat: str = "latitude", lng: str = "longitude") -> str:
    p = f"sin(radians({b}.{lat} - {a}.{lat}) / 2) * sin(radians({b}.{lat} - {a}.{lat}) / 2) + cos(radians({a}.{lat})) * cos(radians({b}.{lat})) * sin(radians({b}.{lng} - {a}.{lng}) / 2) * sin(radians({b}.{lng} - {a}.{lng}) / 2)"
    return f"(2 * {geo.EARTH_RADIUS_M} * atan2(sqrt({p}), sqrt(1 - ({p}))))"


def _block(c: str) -> str:
    return f"cast(round(round_even({c}, 3) * 1000) as bigint)"


BLOCKS = L + f", c as (select *, {_block('latitude')} bi, {_block('longitude')} bj from l)"
PAIRS = BLOCKS + f""", pr as (select a.id id_a, b.id id_b, {hav('a', 'b')} d, a.platform pa, b.platform pb from c a join c b on a.id < b.id
  and abs(a.bi - b.bi) <= 1 and abs(a.bj - b.bj) <= 1)"""

FIXED_GROUPS = ", g as (select id, 'g' || cast(k % 450 as varchar) group_id, k % 13 = 0 by_identity from l)"

_X, _Y = f"((longitude - {geo.ANCHOR_LNG}) * {geo.METRES_PER_DEGREE_LNG!r})", f"((latitude - {geo.ANCHOR_LAT}) * {geo.METRES_PER_DEGREE})"
FUSED = OBS + f""", x as (select *, {_X} x, {_Y} y from o where sigma_m > 0),
 an as (select key, arg_min(x, (sigma_m, seq)) ax, arg_min(y, (sigma_m, seq)) ay from x group by key),
 kp as (select x.*, 1 / (sigma_m * sigma_m) w from x join an using (key) where sqrt((x - ax) * (x - ax) + (y - ay) * (y - ay)) <= {O.outlier_m}),
 fu as (select key, sum(w * x) / sum(w) fx, sum(w * y) / sum(w) fy, greatest(1 / sqrt(sum(w)), {O.min_sigma}) sigma, arg_min(listing_id,
  (sigma_m, seq)) dominant_id, arg_min(source, (sigma_m, seq)) dominant_source from kp group by key)"""

def fused(table: str, key: str, name: str) -> str:
    """Common table expressions of the fused position of every key of a table."""
    sums = "sum(w * x) / sum(w) fx, sum(w * y) / sum(w) fy"
    top = "arg_min(listing_id, (sigma_m, seq)) d, arg_min(source, (sigma_m, seq)) src"
    return f"""{name}_x as (select {key} g, listing_id, source, sigma_m, seq, (longitude - {geo.ANCHOR_LNG}) * {geo.METRES_PER_DEGREE_LNG!r}
  x, (latitude - {geo.ANCHOR_LAT}) * {geo.METRES_PER_DEGREE} y from {table} where sigma_m > 0),
 {name}_a as (select g, arg_min(x, (sigma_m, seq)) ax, arg_min(y, (sigma_m, seq)) ay from {name}_x group by g),
 {name}_k as (select *, 1 / (sigma_m * sigma_m) w from {name}_x join {name}_a using (g) where sqrt((x - ax) * (x - ax) + (y - ay) * (y -
  ay)) <= {O.outlier_m}),
 {name} as (select g, {sums}, greatest(1 / sqrt(sum(w)), {O.min_sigma}) s, {top} from {name}_k group by g)"""


_ADDR = "coalesce(json_extract_string(raw_json, '$.basicPropertyData.location.address'), json_extract_string(raw_json, '$.location.address'))"
_NOISE = text.ADDRESS_NOISE.replace("(?iU)", "(?i)")
_CLEAN1 = f"regexp_replace(regexp_replace(coalesce({_ADDR}, ''), '(\\d+)\\s*[-–]\\s*\\d+', '\\1', 'g'), '(?i)\\s*,?\\s*\\bnr\\b\\.?\\s*', ' ', 'g')"
_CLEAN2 = f"string_split_regex({_CLEAN1}, '{_NOISE}')[1]"
_STREET = f"trim(regexp_replace({_CLEAN2}, '(?i),\\s*(?:[a-z]{{1,3}}\\s*\\d+|\\d+\\s*[a-z])\\s*$', ''), ' ,.')"
ADDRESS = L + f", ad as (select *, case when {_STREET} <> '' then {_STREET} || ', Town' end address from l)"
_LEVEL = text.STREET_LEVEL.replace("(?iU)", "(?i)")
_STACK = ", st as (select *, count(*) over (partition by round_even(latitude, 6), round_even(longitude, 6)) stack_count from ad)"

_DAY = "select event_id, user_id, event_type, value, ts, props from events"
FEED = f"with e as ({_DAY})"

#: The hexagon (q, r) of each listing: a plane in metres, turned by the angle of the level, and the nearest of four centres.
HEX = """, xy as (select id, (longitude - 26.1) * 111195 * cos(radians(44.43)) x, (latitude - 44.43) * 111195 y, {level} * atan2(sqrt(3) / 2, 2.5) a,
  sqrt(3) * 1107710 / pow(7, {level} / 2.0) u from l where latitude is not null and longitude is not null),
tu as (select *, (x * cos(a) - y * sin(a)) / u gx, (x * sin(a) + y * cos(a)) / u gy from xy),
ax as (select *, gy / (sqrt(3) / 2) fr, gx - gy / sqrt(3) fq from tu),
ca as (select *, cast(floor(fq) as bigint) + unnest([0, 1, 0, 1]) q, cast(floor(fr) as bigint) + unnest([0, 0, 1, 1]) r from ax),
spot as (select id, arg_min(q, (q - fq) ** 2 + (q - fq) * (r - fr) + (r - fr) ** 2) q, arg_min(r, (q - fq) ** 2 + (q - fq) * (r - fr) + (r - fr) ** 2) r
  from ca group by id)"""

SQL = {
    "q_normalize_keys": L + " select id, reg, tel, mail from n",
    "q_operator_components": OPS + " select id, operator_id from op",
    "q_operator_summary": OPS + """ select coalesce(operator_id, registration, business_name, host_id) operator_key,
  coalesce(max(business_name), max(host_name)) operator_name, max(registration) registration_number,
 max(trade_register) trade_register, string_agg(distinct platform, ',' order by platform) platforms, count(*) listing_count, count(*) filter
  (business_type = 'Professional') professional_listings
 from l left join op using (id) where coalesce(operator_id, registration, business_name, host_id) is not null group by 1""",
    "q_top_operators": OPS + """ select operator_id operator_key, count(*) listing_count from op group by 1 order by 2 desc, 1 limit 5""",
    "q_haversine_block_join": PAIRS + f" select id_a, id_b, round(d, 3) distance_m from pr where d <= {O.strict_distance_m}",
    "q_cross_platform_pairs": PAIRS + " select case when pa = 'booking' then id_a else id_b end id_a, case when pa = 'booking' then id_b "
        "else id_a end id_b, round(d, 3) distance_m from pr where pa <> pb and d < 100",
    "q_singleton_identity": TWINS + ' select "key", id_a, id_b from tw',
    "q_room_and_amenity_veto": PAIRS + f""", j as (select id_a, id_b, a.platform = b.platform same, a.max_guests ga, b.max_guests gb,
  a.bedrooms ra, b.bedrooms rb, a.beds ba, b.beds bb, a.bathrooms ta, b.bathrooms tb,
 from_json(coalesce(a.amenities_json, '[]'), '["varchar"]') sa, from_json(coalesce(b.amenities_json, '[]'), '["varchar"]') sb from pr join l
  a on a.id = id_a join l b on b.id = id_b where d <= {O.strict_distance_m}),
 jc as (select *, case when len(sa) = 0 or len(sb) = 0 then 1.0 else len(list_intersect(sa, sb)) / len(list_distinct(list_concat(sa, sb)))
  end jac from j)
 select id_a, id_b, round(jac, 6) jaccard, same and (coalesce(ga <> gb, false) or jac < {O.amenity_jaccard}) distinct_units,
 coalesce(ra = rb, true) and coalesce(ba = bb, true) and coalesce(ta = tb, true) and coalesce(ra = rb, ba = bb, ta = tb) is not null
  rooms_match from jc""",
    "q_stack_count": L + " select id, count(*) over (partition by round_even(latitude, 6), round_even(longitude, 6)) stack_count from l",
    "q_fuse_positions": FUSED + f""" select key, round({geo.ANCHOR_LAT} + fy / {geo.METRES_PER_DEGREE}, 6) latitude, round({geo.ANCHOR_LNG}
  + fx / {geo.METRES_PER_DEGREE_LNG!r}, 6) longitude, round(sigma, 6) sigma_m, dominant_id, dominant_source,
 round(greatest(0.0, least(1.0, (150 - sigma) / 150)), 3) position_confidence, case when sigma <= {O.exact_max_sigma} then 'exact' else
  'approximate' end location_precision from fu""",
    "q_conflict_groups": OBS + f""", p as (select distinct key, platform, latitude, longitude from o), q as (select a.key,
  max({hav('a', 'b')}) m from p a join p b on a.key = b.key and a.platform = 'booking' and b.platform = 'airbnb' group by a.key)
 select key, round(m, 3) max_distance_m from q where m > {O.disagreement_m}""",
    "q_offset_median": L + f""", m as (select *, 'g' || cast(k as varchar) group_id from l), d as (select a.group_id, {hav('b', 'a')} d from
  m a join m b on a.group_id = b.group_id and a.platform = 'booking' and b.platform = 'airbnb'),
 h as (select group_id, median(d) d from d group by group_id) select id, round(d, 1) offset_m, 'scraped' offset_source from m join h using
  (group_id)""",
    "q_sigma_calibration": OBS + f""", d as (select b.sigma_m s, {hav('a', 'b')} d from o a join o b on a.key = b.key and a.platform =
  'booking' and b.platform = 'airbnb' and a.source = 'geocoded' and b.source = 'geocoded'),
 q as (select round_even(s, 1) sigma, count(*) n, median(d) m from d where d <= {O.disagreement_m} group by 1)
 select sigma, n, round(m, 1) measured_median_m, round(sqrt(sigma * sigma + {O.sigma_geocoded ** 2}), 1) predicted_m, round(m / sqrt(sigma *
  sigma + {O.sigma_geocoded ** 2}), 2) ratio,
 n >= {O.calibration_min_n} and (m / sqrt(sigma * sigma + {O.sigma_geocoded ** 2}) < {O.calibration_low} or m / sqrt(sigma * sigma +
  {O.sigma_geocoded ** 2}) > {O.calibration_high}) warned from q""",
    "q_dedup_metrics": TWINS.replace(", k as", FIXED_GROUPS + ", k as", 1) + """, j as (select group_id, id from g where not by_identity
  and id in (select id from ks)), s as (select group_id, count(*) n from j group by 1 having count(*) >= 2),
 m as (select group_id, max(c) c from (select group_id, ikey, count(*) c from j join ks using (id) group by 1, 2) group by 1), a as (select
  group_id, c = n agrees from s join m using (group_id)),
 r as (select count(*) identity_twins, count(*) filter (x.group_id = y.group_id) identity_twins_grouped from tw left join g x on x.id = id_a
  left join g y on y.id = id_b)
 select (select count(*) from a) comparable_groups, (select count(*) from a where agrees) agreeing_groups, (select
  coalesce(string_agg(group_id, ',' order by group_id), '') from a where not agrees) conflict_groups,
 round((select count(*) from a where agrees) / nullif((select count(*) from a), 0), 4) precision_proxy, identity_twins,
  identity_twins_grouped, round(identity_twins_grouped / nullif(identity_twins, 0), 4) recall_proxy from r""",
    "q_upsert_last_nonnull": """with e as (select user_id, event_id, event_type, case when event_id % 3 = 0 then null else round(value, 2)
  end price, case when event_id % 4 = 0 then null else props end props from events),
 old as (select user_id, arg_max(event_type, event_id) event_type, arg_max(price, event_id) filter (price is not null) price, arg_max(props,
  event_id) filter (props is not null) props from e where event_type in ('view', 'click') group by 1),
 new as (select user_id, arg_max(event_type, event_id) event_type, arg_max(price, event_id) filter (price is not null) price, arg_max(props,
  event_id) filter (props is not null) props from e where event_type not in ('view', 'click') group by 1)
 select coalesce(o.user_id, n.user_id) user_id, case when n.user_id is not null then n.event_type else o.event_type end event_type,
  coalesce(n.price, o.price) price, case when o.user_id is not null then o.props else n.props end props from old o full join new n on
  o.user_id = n.user_id""",
    "q_enrich_first_nonnull": """with o as (select o_orderkey id, case when o_orderkey % 3 = 0 then null when o_orderkey % 3 = 1 then
  'Unknown' else 'Private' end kind, case when o_orderkey % 4 = 0 then null else o_totalprice end price, o_orderpriority priority from orders),
 n as (select o_orderkey id, case when o_orderkey % 5 = 0 then 'Unknown' when o_orderkey % 5 = 1 then null else 'Professional' end kind,
  o_totalprice * 2 price, case when o_orderkey % 6 = 0 then null else 'new' end priority from orders where o_orderstatus = 'F')
 select o.id, coalesce(nullif(n.kind, 'Unknown'), o.kind, n.kind) kind, coalesce(o.price, n.price) price, coalesce(n.priority, o.priority)
  priority from o left join n using (id)""",
    "q_progress_summary": """select case when o_custkey % 2 = 0 then 'booking' else 'airbnb' end platform, o_orderstatus status, count(*)
  cells, cast(coalesce(sum(case when o_orderkey % 3 = 0 then null else o_custkey % 300 end), 0) as bigint) results from orders group by 1, 2""",
    "q_cell_transitions": """with p as (select o_custkey cell_id, case when o_orderkey % 4 = 0 then 'in_progress' when o_orderkey % 4 = 1
  then 'completed' when o_orderkey % 4 = 2 then 'failed' else 'needs_refinement' end status, o_orderkey t, o_custkey % 300 result_count from orders)
 select cell_id, arg_max(status, t) status, max(t) filter (status = 'in_progress') started_at, max(t) filter (status <> 'in_progress')
  completed_at, arg_max(result_count, t) filter (status <> 'in_progress') result_count from p group by 1""",
    "q_missing_filters": L + f""" select platform, count(*) filter (bedrooms is null or beds is null or bathrooms is null) missing_rooms,
  count(*) filter (beds is null and bathrooms is null and max_guests is null) missing_all_rooms, count(*) filter (price_per_night is null) missing_price,
 count(*) filter (business_type is null or business_type = 'Unknown' or (platform = 'booking' and business_type = 'Professional' and
  trade_register is null)) missing_business,
 count(*) filter (business_type is null or business_type = 'Unknown' or (platform = 'booking' and business_type = 'Professional' and
  trade_register is null) or (platform = 'airbnb' and (host_response_rate is null or host_join_date is null))) business_queue,
 count(*) filter (platform = 'airbnb' and url is not null and (radius_m is null or amenities_json is null)) page_queue from l group by
  platform""",
    "q_business_queue": L + " select id from l where platform = 'airbnb' and (business_type is null or business_type = 'Unknown' or "
        "host_response_rate is null or host_join_date is null) order by id limit 50",
    "q_union_targets": L + " select id, 'price' why from l where price_per_night is null union all select id, 'business' from l where "
        "(business_type is null or business_type = 'Unknown') and price_per_night is not null",
    "q_distinct_cells": L + " select distinct grid_cell_id from l where grid_cell_id is not null and grid_cell_id <> ''",
    "q_cells_with_listings": L + """, c as (select 'c' || cast(i as varchar) cell_id, p platform from range(150) r(i), (values ('booking'),
  ('airbnb')) v(p)) select cell_id, platform from c where exists (select 1 from l where grid_cell_id = cell_id and l.platform = c.platform)""",
    "q_distinct_properties": L + FIXED_GROUPS + " select count(distinct coalesce(group_id, id)) properties from l left join g using (id)",
    "q_counts": L + """ select platform, count(*) listings, count(*) filter (price_per_night is null) missing_price, count(*) filter
  (business_type is null or business_type = 'Unknown' or (platform = 'booking' and business_type = 'Professional' and trade_register is
  null)) missing_business from l group by 1""",
    "q_currency": L + f" select id, case when currency = 'RON' and price_per_night is not null then round(price_per_night / "
        f"{O.ron_per_eur}, 2) else price_per_night end price, case when currency = 'RON' and price_per_night is not null then 'EUR' else "
        f"currency end currency from l",
    "q_json_path": "select event_id, coalesce(cast(json_extract_string(props, '$.k') as int), -1) k, coalesce(json_extract_string(props, "
        "'$.missing'), 'none') missing from events",
    "q_map_projection": L + f" select id, latitude map_latitude, longitude map_longitude, 'platform_coord' map_source, 'approximate' "
        f"map_precision, {_ADDR} address_raw from l",
    "q_map_markers": L + """ select latitude, longitude, platform, case when business_type = 'Professional' then case platform when
  'booking' then 'darkblue' else 'darkred' end else case platform when 'booking' then 'blue' else 'red' end end colour, name || ' · ' ||
  platform tooltip from l where latitude <> 0 and longitude <> 0""",
    "q_html_title_meta": "select page_id, trim(regexp_extract(html, '(?s)<title>(.*?)</title>', 1)) title, regexp_extract(html, "
        "'<html[^>]*\\blang=\"([^\"]*)\"', 1) lang from pages",
    "q_html_strip": "select page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?i)<\\s*br\\s*/?>|</\\s*li\\s*>', chr(10), "
        "'g'), '<[^>]+>', ' ', 'g'), '[ \\t]+', ' ', 'g'), ' ' || chr(9) || chr(10) || chr(13)) stripped from pages",
    "q_html_escape": "select page_id, replace(replace(replace(replace(replace(url, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', "
        "'&quot;'), '''', '&#x27;') escaped from pages",
    "q_url_clean": "select page_id, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/$', '') clean from pages",
    "q_text_normalize": "select doc_id, md5(replace(replace(replace(replace(replace(replace(replace(replace(text, '—', '-'), '–', '-'), "
        "'‘', ''''), '’', ''''), '“', '\"'), '”', '\"'), '…', '...'), '`', '''')) plain_md5 from documents",
    "q_pii_keys": """with e as (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9._+-]+@[A-Za-z0-9-]+\\.[A-Za-z0-9.-]+')) email from documents),
 t as (select doc_id, unnest(regexp_extract_all(text, '\\+?\\d[\\d .()-]{7,18}\\d')) phone from documents) """
    + f"select distinct doc_id, 'mail' kind, {_MAIL} value from e where {_MAIL} is not null union all select distinct doc_id, 'tel', "
        f"{_TEL} from t where {_TEL} is not null",
    "q_exact_dup_groups": "select min(doc_id) first_id, count(*) copies from documents where text is not null group by md5(text) "
        "having count(*) > 1",
    "q_address_clean": ADDRESS + " select id, address, lower(regexp_replace(address, '\\s+', ' ', 'g')) address_key from ad where "
        "platform = 'booking'",
    "q_precision_class": ADDRESS + _STACK + f""", sl as (select *, coalesce(regexp_matches(address, '{_LEVEL}'), false) street from st)
 select id, case when platform = 'booking' then case when street and stack_count < 3 then {O.sigma_address} else {O.sigma_vague} end when
  radius_m is null then {O.sigma_fuzzed} when radius_m = 0 then {O.sigma_exact} else greatest({O.sigma_fuzzed}, radius_m * 0.7) end sigma_m,
 case when platform = 'booking' then case when street then 'exact' else 'approximate' end when radius_m = 0 then 'exact' when radius_m is
  not null then 'approximate' end platform_precision from sl""",
    "q_geocode_lookup": ADDRESS + """, ca as (select lower(regexp_replace(address, '\\s+', ' ', 'g')) address_norm, max(k) k from ad where
  address is not null group by 1 having max(k) % 5 <> 4),
 cs as (select address_norm, case k % 5 when 0 then 'ok' when 1 then 'not_found' else 'failed' end status, cast(case when k % 5 = 3 then 5
  else 1 end as int) attempts from ca)
 select id, case when status is null then 'miss' when status = 'ok' then 'hit' when status = 'not_found' then 'negative' when attempts >= 5
  then 'exhausted' else 'miss' end outcome from ad left join cs on lower(regexp_replace(address, '\\s+', ' ', 'g')) = address_norm where
  address is not null""",
    "q_grid_cells": L + """, b as (select min(latitude) s, max(latitude) + 0.001 n, min(longitude) w, max(longitude) + 0.001 e from l),
d as (select *, cast(ceil(round((n - s) / 0.025, 9)) as bigint) rows, cast(ceil(round((e - w) / 0.025, 9)) as bigint) cols from b),
c as (select s, w, r, unnest(range(cols)) c from (select *, unnest(range(rows)) r from d)),
h as (select cast(floor((latitude - s) / 0.025) as bigint) r, cast(floor((longitude - w) / 0.025) as bigint) c, count(*) n from l, b group by 1, 2)
select '7/' || r || '/' || c cell_id, round(s + r * 0.025 + 0.025 / 2, 6) center_lat, round(w + c * 0.025 + 0.025 / 2, 6) center_lng,
 round(s + r * 0.025 + 0.025, 6) ne_lat, round(w + c * 0.025, 6) sw_lng, coalesce(n, 0) listings from c left join h using (r, c)""",
    "q_grid_refine": L.replace("with l", "with recursive l", 1) + """, v as (
  select cast(7 as int) as level, cast(floor((latitude - 44.33) / (0.025 / pow(2.0, 0))) as bigint) as r, cast(floor((longitude - 25.92) /
  (0.025 / pow(2.0, 0))) as bigint) as c, latitude, longitude, count(*) over (partition by floor((latitude - 44.33) / (0.025 / pow(2.0,
  0))), floor((longitude - 25.92) / (0.025 / pow(2.0, 0)))) as n from l
  union all
  select level + 1, cast(floor((latitude - 44.33) / (0.025 / pow(2.0, level + 1 - 7))) as bigint), cast(floor((longitude - 25.92) / (0.025 /
  pow(2.0, level + 1 - 7))) as bigint), latitude, longitude,
    count(*) over (partition by floor((latitude - 44.33) / (0.025 / pow(2.0, level + 1 - 7))), floor((longitude - 25.92) / (0.025 / pow(2.0,
  level + 1 - 7)))) from v where n >= 20 * 0.9 and level < 10)
 select level, r as "row", c as col, count(*) result_count from v group by 1, 2, 3""",
    # the nearest of the four centres around a point, by distance; cells above by division
    "q_hex_refine": L + HEX.format(level=10) + """, n10 as (select q, r, count(*) n from spot group by 1, 2),
""" + ",\n".join(f"n{v} as (select cast(floor((3 * q + r + 3) / 7.0) as bigint) q, cast(floor((2 * r - q + 3) / 7.0) as bigint) r, sum(n) n from n{v + 1} "
        "group by 1, 2)" for v in (9, 8, 7, 6)) + """,
u as (""" + " union all ".join(f"select {v} as lv, c.q, c.r, c.n, p.q pq, p.r pr, p.n pn from n{v} c join n{v - 1} p on p.q = floor((3 * c.q + c.r + 3) / 7.0) "
        "and p.r = floor((2 * c.r - c.q + 3) / 7.0)" for v in (7, 8, 9, 10)) + """)
select cast(lv as int) as level, lv || '/' || q || '/' || r cell_id, (lv - 1) || '/' || pq || '/' || pr parent_id, cast(n as bigint) result_count
 from u where lv = 7 or pn >= 20 * 0.9""",
    # hexagons and box: parted by the axis of a side, or they meet
    "q_hex_cells": L + HEX.format(level=7) + """, h as (select q, r, count(*) listings from spot group by 1, 2),
b as (select min(y) s, max(y) n, min(x) w, max(x) e, cast(ceil(1.8 * max(sqrt(x * x + y * y)) / any_value(u)) + 2 as bigint) m, any_value(u) u, any_value(a) a from xy),
c as (select *, u * (q + r / 2) gx, u * r * sqrt(3) / 2 gy from (select *, unnest(range(-m, m + 1)) r from (select *, unnest(range(-m, m + 1)) q from b))),
d as (select *, gx * cos(a) + gy * sin(a) x, gy * cos(a) - gx * sin(a) y from c),
g as (select *, unnest([0.0, 0.5, k, k + 1 / 3.0, k + 2 / 3.0]) t from (select *, -a / pi() k from d)),
o as (select *, abs((x - (w + e) / 2) * cos(t * pi()) + (y - (s + n) / 2) * sin(t * pi())) apart, abs(cos(t * pi())) * (e - w) / 2 + abs(sin(t * pi())) * (n - s) / 2
  + list_max([u / sqrt(3) * cos(t * pi() + a - (j + 0.5) * pi() / 3) for j in range(6)]) near from g),
f as (select q, r, any_value(x) x, any_value(y) y from o group by q, r having bool_and(apart <= near))
select '7/' || q || '/' || r cell_id, '6/' || cast(floor((3 * q + r + 3) / 7.0) as bigint) || '/' || cast(floor((2 * r - q + 3) / 7.0) as bigint) parent_id,
 round(44.43 + y / 111195, 6) center_lat, round(26.1 + x / (111195 * cos(radians(44.43))), 6) center_lng, coalesce(listings, 0) listings from f left join h using (q, r)""",
    "q_history": L + " select id listing_id, latitude, longitude, cast(case when platform = 'booking' then 60 else 100 end as double) "
        "sigma_m, platform from l where latitude is not null",
    "q_zoom": L + " select id, case when radius_m > 0 then greatest(1, least(20, cast(round_even(log2(360.0 / (radius_m / 100000)), 0) as "
        "int))) else 15 end zoom from l where radius_m is not null",
    "q_stable_ids": "select o_orderkey id, 'xpg_' || substr(md5(case when cast(o_orderkey as varchar) < cast(o_custkey as varchar) then "
        "cast(o_orderkey as varchar) || '|' || cast(o_custkey as varchar) else cast(o_custkey as varchar) || '|' || cast(o_orderkey as "
        "varchar) end), 1, 16) gid from orders",
}

"""Listing-like and observation-like views of the star-schema tables, in SQL that Spark and DuckDB share."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

LISTINGS = """
select concat(platform, '_', cast(k as {S})) id, platform, cast(k as {S}) platform_id, concat(lower(p_name), ' ', lower(p_type)) name,
 case when k % 40 = 0 then cast(44.42 as double) else cast(44.40 as double) + cast((k * 7919) % 400 as double) / 10000
   + case when platform = 'booking' then cast(0.0003 as double) else cast(0 as double) end end latitude,
 case when k % 40 = 0 then cast(26.10 as double) else cast(26.06 as double) + cast((k * 104729) % 500 as double) / 10000 end longitude,
 case when k % 3 = 0 then null else concat('RO ', cast(1000000 + k % 700 as {S})) end registration,
 case when k % 5 = 0 then null when platform = 'booking' then concat('+40 721 ', lpad(cast(k % 90000 as {S}), 6, '0')) else concat('0721',
  lpad(cast(k % 90000 as {S}), 6, '0')) end phone,
 case when k % 11 = 0 then concat(' Host', cast(k % 300 as {S}), '@Example.COM ') when k % 11 = 1 then 'not-an-email' end email,
 case when k % 7 = 0 then null else cast(k % 4 as int) end bedrooms,
 case when k % 6 = 0 then null else cast(1 + k % 3 as int) end beds,
 case when k % 8 = 0 then null else cast(1 + k % 2 as double) / 2 end bathrooms,
 case when platform = 'booking' then null else cast(2 + k % 6 as int) end max_guests,
 case when platform = 'booking' then null when k % 4 = 0 then '["wifi","tv","pool","sauna"]' when k % 4 = 1 then '["wifi","tv","kitchen"]'
  when k % 4 = 2 then '["wifi","tv","kitchen","iron"]' end amenities_json,
 case when platform = 'airbnb' then null when k % 4 = 0 then '{"location":{"city":"Town"}}'
   when k % 4 = 1 then concat('{"basicPropertyData":{"location":{"address":"Strada Lunga nr. ', cast(k % 90 as {S}), '-', cast(k % 90 + 4 as
  {S}), ', bloc A2, ap. 3","city":"Town"}}}')
   when k % 4 = 2 then concat('{"location":{"address":"', cast(1 + k % 50 as {S}), ' Old Square, B', cast(k % 9 as {S}), '","city":"Town"}}')
   else '{"location":{"address":"Near the park","city":"Town"}}' end raw_json,
 case when platform = 'booking' or k % 3 = 2 then null when k % 3 = 0 then cast(0 as double) else cast(152 as double) end radius_m,
 case k % 5 when 0 then null when 1 then 'Unknown' when 2 then 'Private' else 'Professional' end business_type,
 case when k % 4 = 1 then concat('Firm ', cast(k % 200 as {S})) end business_name,
 case when k % 10 = 3 then 'ONRC' end trade_register,
 case when platform = 'airbnb' then concat('h', cast(k % 400 as {S})) end host_id,
 case when platform = 'airbnb' then concat('Host ', cast(k % 400 as {S})) end host_name,
 case when platform = 'airbnb' and k % 2 = 0 then 'Response rate: 100%' end host_response_rate,
 case when platform = 'airbnb' and k % 3 <> 1 then '4 years hosting' end host_join_date,
 case when k % 9 = 0 then null else bal / 10 end price_per_night, case when k % 2 = 0 then 'RON' else 'EUR' end currency,
 concat('c', cast(k % 97 as {S})) grid_cell_id, concat('https://x/', cast(k as {S})) url, k
from (select platform, k, bal, k % (select count(*) from part) pk from (
  select 'airbnb' platform, c_custkey k, abs(c_acctbal) bal from customer union all select 'booking', s_suppkey, abs(s_acctbal) from
  supplier) b) q join part on p_partkey = pk
"""

OBSERVATIONS = """
select event_id, concat('u', cast(user_id as {S})) listing_id, case when user_id % 2 = 0 then 'booking' else 'airbnb' end platform,
  concat('g', cast(user_id % 45 as {S})) key,
 cast(44.4325 as double) + cast(user_id % 45 as double) / 1000 + (cast(event_id % 21 as double) - 10) / 10000 + case when event_id % 97 = 0
  then cast(0.05 as double) else cast(0 as double) end latitude,
 cast(26.10 as double) + cast(user_id % 45 as double) / 1000 + (cast((event_id * 31) % 21 as double) - 10) / 10000 longitude,
 cast(case event_type when 'signup' then 15 when 'purchase' then 25 when 'click' then 50 when 'view' then 100 else 150 end as double) sigma_m,
 case when event_id % 3 = 0 then 'geocoded' else 'scraped' end source, event_id seq
from events
"""


def tables_of(sql: str) -> list[str]:
    return sorted(set(re.findall(r"\b(customer|supplier|part|events|orders|pages|documents)\b", sql)))


def spark_view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A view's SQL over the tables of a folder, without registering names in the session."""
    names = tables_of(sql)
    body = sql.replace("{S}", "string").replace("{Y}", "binary").replace("{", "{{").replace("}", "}}")
    for n in names:
        body = re.sub(rf"\b(from|join)\s+{n}\b", rf"\1 {{{n}}}", body)
    tables = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}
    if "part" in tables:  # a row for each listing or more, in a file that Spark takes for small
        tables["part"] = tables["part"].hint("merge")
    return spark.sql(body, **tables)


def duck_view(sql: str) -> str:
    return sql.replace("{S}", "varchar").replace("{Y}", "blob")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_view(spark, sf_dir, LISTINGS)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark_view(spark, sf_dir, OBSERVATIONS)

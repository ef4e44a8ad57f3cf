"""DuckDB SQL that recomputes each deterministic query from the driver's views.

The shared CTEs rebuild the review fixture (raw -> parsed -> clean) exactly as
``revue.sources.fixtures`` and ``revue.operators.clean`` do.
"""

from __future__ import annotations

RAW = """raw as (
 select concat('U', cast(o_custkey as varchar)) as user_id, concat('P', cast(l_partkey as varchar)) as product_id,
  p_name as title, c_name as user_name,
  case when l_partkey % 11 = 0 then 'unknown' when l_partkey % 11 = 1 then '' when l_partkey % 11 = 2 then null
       when l_partkey % 11 = 3 then concat('$', cast(p_retailprice as varchar)) when l_partkey % 11 = 4 then '1.2.3'
       else cast(p_retailprice as varchar) end as raw_price,
  case when l_orderkey % 101 = 0 then 'bad'
       when l_orderkey % 103 = 0 then concat(cast(1 + (o_custkey + 2 * l_partkey) % 5 as varchar), '/0')
       when l_linenumber = 7 then concat(cast(1 + (o_custkey + 2 * l_partkey) % [5, 3, 7][l_orderkey % 3 + 1] as varchar),
                                         '/', cast([5, 3, 7][l_orderkey % 3 + 1] as varchar))
       else concat(cast(1 + (o_custkey + 2 * l_partkey) % 5 as varchar), '.0') end as raw_rating,
  case when l_linenumber = 6 then 'n/a' else concat(cast(cast(l_quantity as int) as varchar), '/50') end as helpfulness,
  cast(epoch(l_shipdate) as bigint) as review_time,
  concat(l_returnflag, l_linestatus) as review_summary, o_orderpriority as review_text
 from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
  join customer on o_custkey = c_custkey)"""

PARSED = """parsed as (
 select user_id, product_id, title, user_name, review_time, review_summary, review_text,
  case when raw_price is null or raw_price in ('', 'unknown') then null
       when regexp_full_match(regexp_replace(raw_price, '[^0-9.]', '', 'g'), '[0-9.]+')
       then try_cast(regexp_replace(raw_price, '[^0-9.]', '', 'g') as double) end as price,
  case when raw_rating like '%/%' then case when split_part(raw_rating, '/', 2) = '0' then null
        else try_cast(split_part(raw_rating, '/', 1) as double) / nullif(try_cast(split_part(raw_rating, '/', 2) as double), 0) end
       when regexp_full_match(raw_rating, '[0-9.]+') then cast(try_cast(raw_rating as float) as double) end as rating,
  case when regexp_full_match(helpfulness, '[0-9]+/[0-9]+') then try_cast(split_part(helpfulness, '/', 1) as int) end as helpful_votes,
  raw_price, raw_rating, helpfulness
 from raw)"""


def clean_cte(min_user: int = 5, min_product: int = 10, name: str = "clean") -> str:
    return f"""{name} as (
 select d.user_id, d.product_id, d.title, d.user_name, d.review_time, d.review_summary, d.review_text,
  coalesce(d.price, m.med) as price, d.rating, d.helpful_votes
 from (select * from parsed where user_id is not null and product_id is not null and rating is not null) d
 cross join (select coalesce(quantile_disc(price, 0.5), 0.0) as med from parsed
             where rating is not null and user_id is not null and product_id is not null and price is not null) m
 where d.user_id in (select user_id from parsed where rating is not null and product_id is not null
                     group by 1 having count(*) >= {min_user})
   and d.product_id in (select product_id from parsed where rating is not null and user_id is not null
                        group by 1 having count(*) >= {min_product}))"""


def with_clean(body: str, min_user: int = 5, min_product: int = 10) -> str:
    return f"with {RAW},\n{PARSED},\n{clean_cte(min_user, min_product)}\n{body}"


def with_parsed(body: str) -> str:
    return f"with {RAW},\n{PARSED}\n{body}"


DATE = "case when {t} is null or {t} = 0 then 'N/A' else strftime(make_timestamp(cast({t} as bigint) * 1000000), '%d/%m/%Y') end"


def date_expr(t: str) -> str:
    return DATE.format(t=t)

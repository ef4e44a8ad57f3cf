"""Registered queries of the training-data operators and their DuckDB SQL.

Each query applies its operator with production parameters to its whole table and
derives the columns of its contract from what the operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revue.conf import scratch_path
from revue.llm import (
    decontaminate,
    langid,
    main_text,
    mixing,
    near_dedup,
    phrases,
    sharding,
    spelling,
    token_counts,
    token_ids,
    toxicity,
    url_filter,
)
from revue.llm import exact_dedup as dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ------------------------------------------------------------------ 1 token counts

@query("op1_trie_token_counts")
def op1_trie_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


# ------------------------------------------------------------------ 2 exact dedup

@query("op2_exact_dedup", r"""
with d as (
  select doc_id, length(coalesce(text, '')) as n_chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm from documents),
b as (
  select doc_id, sha256(norm) as text_sha256,
         first_value(doc_id) over (partition by norm order by n_chars desc, doc_id) as keep_id,
         count(*) over (partition by norm) as group_size from d)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from b
""")
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_dedup(table(spark, sf_dir, "documents"))


# ------------------------------------------------------------------ 3 sharding

SHARDS = 16

#: crc32 of a text's UTF-8 bytes, in SQL: a 256-entry table built by rule, then one step a byte.
CRC_SQL = """
crc_table as (
  select list(c order by i) as steps from (
    select i, list_reduce(list_prepend(i, range(8)),
      lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end) as c
    from range(256) r(i)))"""


@query("op3_stratified_shards", f"""
with {CRC_SQL},
d as (
  select doc_id, source, coalesce(text, '') as t, octet_length(encode(coalesce(text, ''))) + 1 as size,
         md5(coalesce(doc_id::varchar, '') || ':shard') as key,
         substr(md5(coalesce(source, '') || ':shard'), 1, 3) as ph from documents),
crc as (
  select doc_id, t, xor(list_reduce(
      list_prepend(4294967295::bigint, list_transform(regexp_extract_all(hex(encode(t)), '..'),
        lambda x: ((instr('0123456789ABCDEF', x[1]) - 1) * 16 + instr('0123456789ABCDEF', x[2]) - 1)::bigint)),
      lambda c, b: xor(c >> 8, crc_table.steps[(xor(c, b) & 255) + 1])), 4294967295::bigint) as text_crc32
  from d, crc_table),
f as (
  select doc_id, source, size, key,
         (row_number() over (partition by source order by key, doc_id)
          - ((instr('0123456789abcdef', ph[1]) - 1) * 256 + (instr('0123456789abcdef', ph[2]) - 1) * 16
             + (instr('0123456789abcdef', ph[3]) - 1) + 0.5::double) / 4096.0::double)
         / count(*) over (partition by source) as frac from d),
p as (
  select *, row_number() over (order by frac, source nulls last, key, doc_id) - 1 as pos,
         count(*) over () as total from f)
select doc_id, size::bigint as size, text_crc32, 'rows' as law, (pos * {SHARDS} // total)::int as shard,
       pos - ((pos * {SHARDS} // total) * total + {SHARDS - 1}) // {SHARDS} as slot, null::int as grown_shard
from p join crc using (doc_id)
""")
def op3_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law ``rows``: shard counts differ by one at most; so there is no grown shard."""
    return (sharding.interleave(table(spark, sf_dir, "documents"), SHARDS)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))


# ------------------------------------------------------------------ 4 near-dedup

@query("op4_order_minhash")
def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, sf_dir, "documents"))


# ------------------------------------------------------------------ 5 language ID

def id_remainder(folds: int):
    """crc32 of the document id as text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds


def language_model(docs: DataFrame) -> langid.LanguageModel:
    return langid.fit(docs.where(id_remainder(4) != 2))


@query("op5_centroid_language")
def op5_centroid_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return (langid.identify(docs, language_model(docs)).withColumn("held_out", id_remainder(4) == 2)
            .select("doc_id", "held_out", "lang_pred", "score", "rejected"))


# ------------------------------------------------------------------ 6 token ids

@query("op6_ranked_token_files")
def op6_ranked_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_ids.write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_ids.digests(spark, path).withColumnRenamed("id", "doc_id")


# ------------------------------------------------------------------ 7 mixing

MIX_CYCLE, MIX_SHARE, MIX_EPOCHS = [5.0, 2.0, 1.0], 1.5, 2.0


@query("op7_water_filling_mix", r"""
with d as (
  select doc_id, source, md5(coalesce(doc_id::varchar, '') || ':mix') as key,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents),
s as (
  select source, sum(size)::bigint as source_size,
         case (row_number() over (order by source nulls last) - 1) % 3
              when 0 then 5.0::double when 1 then 2.0::double else 1.0::double end as weight
  from d group by source),
r as (select *, source_size * 2.0::double as cap, source_size * 2.0::double / weight as ratio,
             row_number() over (order by source nulls last) as nth from s),
l as (
  select a.nth, ((select sum(source_size) from s) * 1.5::double
                 - coalesce(sum(b.cap) filter (where b.ratio < a.ratio), 0))
                / sum(b.weight) filter (where b.ratio >= a.ratio) as level
  from r a, r b group by a.nth),
w as (select min_by(level, ratio) as water from r join l using (nth) where ratio > level),
g as (select source, source_size, least(cap, coalesce(weight * water, cap)) as target from r, w),
c as (
  select d.*, source_size, target, coalesce(sum(size) over (partition by d.source order by key, doc_id
                rows between unbounded preceding and 1 preceding), 0)::bigint as before
  from d join g on d.source is not distinct from g.source),
x as (select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as whole from c)
select doc_id, size, source_size, target,
       ((whole + (target - whole * source_size > 0 and 2 * before + size <= 2 * (target - whole * source_size))::int)
        * size)::bigint as taken from x
""")
def op7_water_filling_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.mix(table(spark, sf_dir, "documents"), MIX_CYCLE, MIX_SHARE, MIX_EPOCHS)
            .select("doc_id", "size", "source_size", "target", "taken"))


# ------------------------------------------------------------------ 8 toxicity

@query("op8_weak_supervision_toxicity")
def op8_weak_supervision_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(id_remainder(5) != 0))
    return (toxicity.score(docs, model).withColumn("held_out", id_remainder(5) == 0)
            .select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


# ------------------------------------------------------------------ 9 URL filter

#: First day and number of days of the crawl that gives each page a fetch date.
CRAWL_START, CRAWL_DAYS = "2024-01-01", 366


def captures_of(pages: DataFrame) -> DataFrame:
    """Pages with a fetch date, which the tables lack: a rule of the page id."""
    day = F.pmod(F.col("page_id") * 7919, F.lit(CRAWL_DAYS)).cast("int")
    return pages.select("page_id", "url", F.date_add(F.lit(CRAWL_START).cast("date"), day).alias("fetched_on"))


def list_events_of(pages: DataFrame) -> DataFrame:
    """Dated list events, which the tables lack: a rule of the digits of md5(entry).

    Entries are the hosts of the pages, their parent domains and host/first path
    segment. One in four is listed: added on a day by its digits, removed 40 to 295 days later if its
    third digit is below c, added again 30 days after if it is below 4. Entries
    with a fourth digit below 3 are exceptions (``allow``).
    """
    hosts = pages.select(url_filter.host_of(F.col("url")).alias("host"), url_filter.path_of(F.col("url")).alias("path"))
    parent = F.when(F.size(F.split("host", r"\.")) > 2, F.regexp_replace("host", r"^[^.]+\.", ""))
    entries = (hosts.where(F.col("host").isNotNull())
               .select(F.explode(F.array(F.col("host"), parent, F.concat_ws("/", "host", F.element_at(F.split("path", "/"), 1))))
                       .alias("entry"))
               .where(F.col("entry").isNotNull()).distinct()
               .withColumn("m", F.md5(F.col("entry").cast("binary"))).where(F.substring("m", 1, 1) < "4"))
    number = lambda at: F.conv(F.substring("m", at, 2), 16, 10).cast("int")
    added = F.date_add(F.lit(CRAWL_START).cast("date"), number(5))
    removed = F.date_add(added, 40 + number(7))
    third = F.substring("m", 3, 1)
    event = lambda action, day: F.struct(F.lit(action).alias("action"), day.alias("event_date"))
    events = F.array(event("add", added), F.when(third < "c", event("remove", removed)),
                     F.when(third < "4", event("add", F.date_add(removed, 30))))
    category = F.when(F.substring("m", 4, 1) < "3", "allow").when(F.substring("m", 4, 1) < "a", "spam").otherwise("adult")
    return (entries.select("entry", category.alias("category"), F.explode(events).alias("e"))
            .where(F.col("e").isNotNull()).select("entry", "category", "e.action", "e.event_date"))


@query("op9_temporal_url_filter", r"""
with p as (
  select page_id, url, date '2024-01-01' + ((page_id * 7919) % 366)::int as fetched_on,
         nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') as host,
         lower(regexp_replace(regexp_extract(url, '^[^/?#]*//[^/?#]*([^?#]*)', 1), '^/+|/+$', '', 'g')) as path
  from pages),
e as (
  select distinct entry, md5(entry) as m from (
    select host as entry from p union all
    select regexp_replace(host, '^[^.]+\.', '') from p where len(string_split(host, '.')) > 2 union all
    select host || '/' || string_split(path, '/')[1] from p) where entry is not null and md5(entry) < '4'),
n as (
  select entry, m, case when m[4] < '3' then 'allow' when m[4] < 'a' then 'spam' else 'adult' end as category,
         date '2024-01-01' + ((instr('0123456789abcdef', m[5]) - 1) * 16 + instr('0123456789abcdef', m[6]) - 1)::int as added,
         (40 + (instr('0123456789abcdef', m[7]) - 1) * 16 + instr('0123456789abcdef', m[8]) - 1)::int as days from e),
spans as (
  select entry, category, added as valid_from, case when m[3] < 'c' then added + days end as valid_to from n
  union all select entry, category, added + days + 30, null from n where m[3] < '4'),
hits as (
  select page_id, entry, category, valid_from,
         row_number() over (partition by page_id order by length(entry) desc, entry desc,
                            category <> 'allow', valid_from desc, category) as nth
  from p join spans on fetched_on >= valid_from and (valid_to is null or fetched_on < valid_to)
   and (host = entry or ends_with(host, '.' || entry) or starts_with(host || '/' || path || '/', entry || '/')))
select page_id, url, fetched_on::varchar as fetched_on, host, entry, category, valid_from::varchar as valid_from,
       case when coalesce(category, 'allow') = 'allow' then 'allow' else 'block' end as decision
from p left join (select * from hits where nth = 1) using (page_id)
""")
def op9_temporal_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    out = url_filter.url_filter(captures_of(pages), list_events_of(pages))
    return out.withColumns({c: F.col(c).cast("string") for c in ("fetched_on", "valid_from")})


# ------------------------------------------------------------------ 10 decontamination

@query("op10_simhash_decontamination")
def op10_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# ------------------------------------------------------------------ 11 spelling variants

@query("op11_spelling_variants", rf"""
with recursive {CRC_SQL},
runs as (
  select doc_id, run, count(*) as c from (
    select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from documents)
  where length(run) >= 7 group by all),
crc as (
  select run, c, xor(list_reduce(
      list_prepend(4294967295::bigint,
        list_transform(regexp_extract_all(hex(encode(coalesce(doc_id::varchar, '') || ':' || run)), '..'),
        lambda x: ((instr('0123456789ABCDEF', x[1]) - 1) * 16 + instr('0123456789ABCDEF', x[2]) - 1)::bigint)),
      lambda c, b: xor(c >> 8, crc_table.steps[(xor(c, b) & 255) + 1])), 4294967295::bigint) as h
  from runs, crc_table),
v as (
  select word, sum(c)::bigint as n from (
    select c, case when h % 31 = 0 then substr(run, 1, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2)
              else run end as word from crc)
  where length(word) >= 7 group by word having sum(c) >= 2),
cut as (select word, n, i, substr(word, 1, i - 1) as head, substr(word, i + 1) as tail
        from (select word, n, unnest(range(1, length(word) + 1)) as i from v)),
one as (select distinct a.word as longer, a.n as longer_n, b.word as shorter, b.n as shorter_n
        from cut a join v b on a.head || a.tail = b.word),
near as (
  select longer as word, shorter as near, shorter_n as near_n from one
  union all select shorter, longer, longer_n from one
  union all select a.word, b.word, b.n from cut a join cut b on a.i = b.i and a.head = b.head and a.tail = b.tail and a.word <> b.word),
best as (
  select word, count(*) as n_near, arg_min(near, (-near_n, near)) as near, max(near_n) as near_n from near group by word),
forms as (
  select v.word, n, coalesce(n_near, 0)::bigint as n_near, case when near_n >= 10 * n then near end as form,
         case when near_n >= 10 * n then near_n end as form_n from v left join best using (word)),
hops as (
  select word, word as root from forms
  union all select h.word, f.form from hops h join forms f on h.root = f.word where f.form is not null)
select f.word, f.form, h.root, f.n, f.n_near, f.form_n::bigint as form_n
from hops h join forms f on h.word = f.word join forms g on h.root = g.word where g.form is null
""")
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_groups(table(spark, sf_dir, "documents"))


# ------------------------------------------------------------------ 12 main text

@query("op12_main_text", r"""
with a as (
  select page_id, url, regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '<br>', ' ', 'g') as h from pages),
b as (
  select page_id, url, string_split(regexp_replace(regexp_replace(h, '</?(?:p|h1)>', chr(1), 'g'), '<[^>]*>', '', 'g'), chr(1)) as parts from a),
c as (
  select page_id, url, array_to_string(list_filter(list_transform(parts, lambda x: trim(regexp_replace(
           replace(replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&amp;', '&'),
           '[\x09-\x0D\x1C-\x20\x{85}\x{A0}]+', ' ', 'g'))), lambda x: x <> ''), chr(10)) as text from b)
select page_id, url, text, length(text)::bigint as n_chars from c
""")
def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SQL knows the one template of the tables; the operator does not."""
    pages = table(spark, sf_dir, "pages")
    return main_text.extract(pages, main_text.fit(pages), ["page_id", "url"])


# ------------------------------------------------------------------ 13 collocations

@query("op13_phrase_collocations", r"""
with p as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from (
    select coalesce(lang, 'und') as lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[.,;:!?\x0A-\x0D]')) as piece from documents)),
one as (select lang, w, count(*) as f from (select lang, unnest(ws) as w from p) group by all),
total as (select lang, sum(f)::bigint as n from one group by lang),
two as (
  select lang, ws[i] as x, ws[i + 1] as y, count(*) as f
  from (select lang, ws, unnest(range(1, len(ws))) as i from p) group by all having count(*) >= 10),
three as (
  select lang, ws[i] as x, ws[i + 1] as y, ws[i + 2] as z, count(*) as f
  from (select lang, ws, unnest(range(1, len(ws) - 1)) as i from p) group by all having count(*) >= 10),
cuts as (
  select two.lang, x || ' ' || y as phrase, two.f as a, u.f as l, v.f as r, 1 as k
  from two join one u on two.lang = u.lang and x = u.w join one v on two.lang = v.lang and y = v.w
  where not exists (select 1 from three t where t.lang = two.lang and 100 * t.f >= 50 * two.f
                    and ((t.x = two.x and t.y = two.y) or (t.y = two.x and t.z = two.y)))
  union all
  select t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, u.f, v.f, 1
  from three t join one u on t.lang = u.lang and t.x = u.w join two v on t.lang = v.lang and t.y = v.x and t.z = v.y
  union all
  select t.lang, t.x || ' ' || t.y || ' ' || t.z, t.f, u.f, v.f, 2
  from three t join two u on t.lang = u.lang and t.x = u.x and t.y = u.y join one v on t.lang = v.lang and t.z = v.w),
scored as (select *, ((a::hugeint * a * 1000000) // (l::hugeint * r))::bigint as score from cuts),
low as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from low join total using (lang) qualify rank <= 2000
""")
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))

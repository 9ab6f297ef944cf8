"""One query an operator, over whole tables, with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factline.llm import decontaminate, html_extract, jaccard_join, language_id, packing, quality, substring_dedup, token_counts, token_files, url_filters
from factline.llm._common import shared_dir

#: The end-of-document id that no text can give in op10's vocabulary.
END_OF_TEXT = 50256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", F.crc32(F.col("doc_id").cast("string")) % 3 == 1)
    models = language_id.train(docs.filter("not held_out").select("doc_id", "text", "lang"))
    out = language_id.identify(docs.select("doc_id", "text"), models)
    return out.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("held_out"), "lang_pred", "score", "rejected")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["n_words"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated")
    )


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` has no fetch time: a page counts as fetched on a day of 2024 given by its id."""
    return table(spark, sf_dir, "pages").select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 37 % 360).cast("int")).alias("fetched"))


def list_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated list entries, derived from ``pages``: every seventh page adds its host for a while, every
    fifth removes it, every eleventh adds the first path segment below its host."""
    pages = table(spark, sf_dir, "pages").select("page_id", url_filters.normal(F.col("url")).alias("at")).filter("at is not null")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 53 % 330).cast("int"))
    host, up = F.split_part("at", F.lit("/"), F.lit(1)), F.substring_index(F.split_part("at", F.lit("/"), F.lit(1)), ".", -3)
    add = pages.filter("page_id % 7 = 0").select(F.when(F.col("page_id") % 2 == 0, "host").otherwise("domain").alias("kind"), F.when(F.col("page_id") % 2 == 0, host).otherwise(up).alias("pattern"), day.alias("day"), F.lit("add").alias("action"))
    drop = pages.filter("page_id % 5 = 0").select(F.when(F.col("page_id") % 2 == 0, "host").otherwise("domain").alias("kind"), F.when(F.col("page_id") % 2 == 0, host).otherwise(up).alias("pattern"), day.alias("day"), F.lit("remove").alias("action"))
    deep = pages.filter("page_id % 11 = 0").select(F.lit("prefix").alias("kind"), F.substring_index("at", "/", 2).alias("pattern"), day.alias("day"), F.lit("add").alias("action"))
    return add.unionByName(drop).unionByName(deep)


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.filter_urls(captures(spark, sf_dir), list_entries(spark, sf_dir))


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_text(table(spark, sf_dir, "pages"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=4096, end_id=1)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), k=4, threshold=(85, 100))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=13).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/corpus-{uuid.uuid4().hex}"
    token_files.encode_corpus(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path, end_id=0)
    return token_files.read_token_file(spark, path, with_ids=False)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens of every document, found in the flat files alone; ordinals name the documents."""
    path = f"{shared_dir(spark)}/flat-{uuid.uuid4().hex}"
    dtype = token_counts.tokenize_flat(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), END_OF_TEXT, path)
    flat = spark.read.schema("file long, block long, data binary, docs array<long>").parquet(path)
    counts = token_counts.count_tokens(flat.filter("data is not null"), END_OF_TEXT, dtype)
    return counts.join(token_counts.document_order(flat), "ordinal").select("doc_id", "ordinal", "start", "n_tokens")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    each = (op1_language_id, op2_decontaminate, op3_url_filters, op4_html_extract, op5_best_fit_packing, op6_quality_rules, op7_jaccard_join, op8_substring_dedup, op9_token_files, op10_token_counts)
    return {f.__name__: f for f in each}


_OP3 = """
with captures as (
  select page_id, url, date '2024-01-01' + cast(page_id * 37 % 360 as integer) as fetched,
    lower(regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)', 1)) as host,
    regexp_replace(regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//[^/?#]*([^?#]*)', 1), '/+$', '') as path
  from pages),
placed as (select *, case when length(host) > 0 then regexp_replace(host, '\\.+$', '') || path end as loc from captures),
named as (select page_id, date '2024-01-01' + cast(page_id * 53 % 330 as integer) as day, loc, split_part(loc, '/', 1) as h,
    array_to_string(string_split(split_part(loc, '/', 1), '.')[-3:], '.') as up from placed where loc is not null),
entries as (
  select case when page_id % 2 = 0 then 'host' else 'domain' end as kind, case when page_id % 2 = 0 then h else up end as pattern, day, true as adds from named where page_id % 7 = 0
  union all
  select case when page_id % 2 = 0 then 'host' else 'domain' end, case when page_id % 2 = 0 then h else up end, day, false from named where page_id % 5 = 0
  union all
  select 'prefix', array_to_string(string_split(loc, '/')[1:2], '/'), day, true from named where page_id % 11 = 0),
daily as (select kind, pattern, day, bool_and(adds) as adds from entries group by all),
changes as (select *, lag(adds) over (partition by kind, pattern order by day) as was from daily),
spans as (select kind, pattern, day as valid_from, adds, lead(day) over (partition by kind, pattern order by day) as valid_to from changes where adds <> coalesce(was, false)),
hits as (
  select p.page_id, s.kind, s.pattern, s.valid_from from placed p join spans s on s.adds and s.valid_from <= p.fetched and (s.valid_to is null or s.valid_to > p.fetched)
   and ((s.kind = 'host' and split_part(p.loc, '/', 1) = s.pattern)
     or (s.kind = 'domain' and (split_part(p.loc, '/', 1) = s.pattern or ends_with(split_part(p.loc, '/', 1), '.' || s.pattern)))
     or (s.kind = 'prefix' and (p.loc = s.pattern or starts_with(p.loc, s.pattern || '/'))))),
firsts as (select page_id, count(*) as n, min({'kind': kind, 'pattern': pattern, 'since': valid_from}) as f from hits group by page_id)
select p.page_id, p.url, p.fetched, f.page_id is not null as blocked, coalesce(f.n, 0) as n_entries, f.f.kind || ':' || f.f.pattern as reason, f.f.since as listed_since
from placed p left join firsts f using (page_id)
"""

_OP6 = """
with base as (
  select doc_id, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
  from documents),
windows as (select doc_id, i, array_to_string(words[i : i + 4], ' ') as w from (select doc_id, words, unnest(range(1, len(words) - 3)) as i from base)),
twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, w) as n from windows) where n > 1),
covered as (select doc_id, count(distinct i + k) as n from twice, range(0, 5) as r(k) group by doc_id),
measured as (
  select b.doc_id, lang, source, cast(len(words) as bigint) as n_words, cast(length(array_to_string(words, '')) as bigint) as word_chars,
    cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(lines) as bigint) as n_lines, cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines, cast(coalesce(c.n, 0) as bigint) as n_repeat_words
  from base b left join covered c using (doc_id)),
m as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
    1000 * word_chars // greatest(n_words, 1) as word_length, 1000 * n_symbols // greatest(n_words, 1) as symbols_per_word, 1000 * n_dup_lines // greatest(n_lines, 1) as repeated_lines
  from measured),
long as (
  select lang, source, 'word_length' as measure, word_length as v from m where not base_failed
  union all select lang, source, 'symbols_per_word', symbols_per_word from m where not base_failed
  union all select lang, source, 'repeated_lines', repeated_lines from m where not base_failed),
cells as (select lang, source, measure, (v >> greatest(length(bin(v)) - 9, 0)) << greatest(length(bin(v)) - 9, 0) as cell from long),
levels as (
  select 1 as level, lang, source, measure, cell, count(*) as n from cells group by all
  union all select 2, lang, '', measure, cell, count(*) from cells group by lang, measure, cell
  union all select 3, '', '', measure, cell, count(*) from cells group by measure, cell),
ranked as (select *, sum(n) over (partition by level, lang, source, measure order by cell) as upto, sum(n) over (partition by level, lang, source, measure) as total from levels),
q as (select level, lang, source, measure, max(total) as n, min(case when upto * 4 >= total then cell end) as q25, min(case when upto * 4 >= total * 3 then cell end) as q75 from ranked group by all),
picked as (
  select a.lang, a.source, a.measure, case when a.n >= 50 then a.q25 when b.n >= 50 then b.q25 else c.q25 end as q25, case when a.n >= 50 then a.q75 when b.n >= 50 then b.q75 else c.q75 end as q75
  from q a join q b on a.level = 1 and b.level = 2 and a.lang = b.lang and a.measure = b.measure join q c on c.level = 3 and c.measure = a.measure),
limits as (
  select lang, source,
    max(case when measure = 'word_length' then q25 - 5 * greatest(q75 - q25, 150) end) as lo_length, max(case when measure = 'word_length' then q75 + 5 * greatest(q75 - q25, 150) end) as hi_length,
    max(case when measure = 'symbols_per_word' then q75 + 5 * greatest(q75 - q25, 40) end) as hi_symbols, max(case when measure = 'repeated_lines' then q75 + 5 * greatest(q75 - q25, 60) end) as hi_lines
  from picked group by all)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not coalesce(word_length > hi_length or word_length < lo_length or symbols_per_word > hi_symbols or repeated_lines > hi_lines, false) as kept
from m left join limits using (lang, source)
"""

_OP2 = """
with d as (select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') as w from documents where doc_id is not null),
b as (select item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') as w from benchmark where item_id is not null),
windows as (select distinct item_id, least(len(w), 10) as n, array_to_string(w[i : i + 9], ' ') as s from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from b where len(w) > 0)),
lengths as (select distinct n from windows),
places as (select doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') as s from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, lengths)),
found as (select doc_id, i, n, item_id from places join windows using (n, s)),
hits as (select doc_id, count(distinct i + k) as n_hit from (select distinct doc_id, i, unnest(range(0, n)) as k from found) group by doc_id),
items as (select doc_id, count(*) as n, string_agg(item, ',' order by item) as ids from (select distinct doc_id, cast(item_id as varchar) as item from found) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hits using (doc_id) left join items using (doc_id)
"""

_OP8 = """
with d as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from documents),
windows as (select doc_id, i, array_to_string(w[i : i + 12], ' ') as s from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from d)),
late as (select doc_id, i from (select doc_id, i, min(doc_id) over (partition by s) as first from windows) where first < doc_id),
gone as (select distinct doc_id, unnest(range(i, i + 13)) as p from late),
words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from d),
kept as (select doc_id, string_agg(word, ' ' order by p) as text, count(*) as n from words anti join gone using (doc_id, p) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, len(w) - coalesce(n, 0) as n_removed, sha256(coalesce(text, '')) as kept_sha256
from d left join kept using (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL where SQL can say it and stays quick on whole tables; the others are tested by brute force."""
    return {"op2_decontaminate": _OP2, "op3_url_filters": _OP3, "op6_quality_rules": _OP6, "op8_substring_dedup": _OP8}

"""One query per operator over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from variantry.llm import language, licenses, lm, quality, toxicity, urls
from variantry.llm.audit import filter_interactions
from variantry.llm.bpe import round_trip
from variantry.llm.exact import duplicate_groups
from variantry.llm.jaccard import jaccard_components
from variantry.llm.mix import mixed_sizes
from variantry.llm.search import search
from variantry.llm.simhash import near_duplicates
from variantry.llm.words import id_remainder


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# The rules on urls (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: Names of sites whose pages are listed for blocking.
LISTED_SITES = ("spam-farm", "adult-x", "free-bets")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of the listed sites are the list; their canonical forms also catch other addresses of the same pages."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    labels = F.split(urls.host_of(F.col("url")), r"\.")
    listed = pages.select("url").where(F.arrays_overlap(labels, F.array(*map(F.lit, LISTED_SITES))))
    return urls.judge(pages, spark.createDataFrame(URL_RULES, urls.RULE), listed)


def _held_out(parts: int, remainder: int) -> Column:
    return id_remainder(F.col("doc_id"), parts) == remainder


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = _held_out(4, 2)
    model = language.fit(docs.where(~held_out))
    return language.identify(docs, model).withColumn("held_out", held_out)


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = _held_out(10, 0)
    model, rare = lm.fit(docs.where(~held_out), mass=False)
    return lm.score(docs, model, rare, training=~held_out).withColumn("held_out", held_out)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    held_out = _held_out(5, 0)
    model = toxicity.fit(docs, labels.where(~held_out))
    return toxicity.classify(docs, model).withColumn("held_out", held_out)


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's best licence, how many of its lines name one, and all matches."""
    lines = F.filter("matches", lambda match: match["unit"] == "line")
    return licenses.scan(documents(spark, sf_dir)).select("doc_id", "license", "dice", F.size(lines).alias("license_lines"), "matches")


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_sizes(documents(spark, sf_dir))


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(documents(spark, sf_dir))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_interactions(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": op1_url_filters,
    "op2_language_id": op2_language_id,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_toxicity": op5_toxicity,
    "op6_license_scans": op6_license_scans,
    "op7_mix_sources": op7_mix_sources,
    "op8_bpe_round_trip": op8_bpe_round_trip,
    "op9_quality_rules": op9_quality_rules,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_filter_audit": op11_filter_audit,
    "op12_ranked_search": op12_ranked_search,
    "op13_jaccard_join": op13_jaccard_join,
}

ORACLES: dict[str, str] = {
    "op1_url_filters": r"""
with parts as (
  select page_id, lower(coalesce(regexp_extract(url, '://([^/?#]*)', 1), '')) as host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
rules(rule_host, rule_path, verdict) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
fitting as (
  select page_id, host, path, rule_host || rule_path as rule, verdict
  from parts left join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
  qualify row_number() over (partition by page_id order by length(rule) desc nulls last) = 1)
select page_id, host, path, rule,
  coalesce(verdict, case when regexp_matches(host, '(^|[.])(spam-farm|adult-x|free-bets)([.]|$)') then 'block' else 'allow' end)
    as verdict
from fitting
""",
    "op7_mix_sources": r"""
with sized as (
  select doc_id, source, length(regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]+', 'x', 'g'))
      - length(regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]+', '', 'g')) as size,
    md5(concat(coalesce(doc_id::varchar, ''), ':', coalesce(text, ''))) as digest
  from documents),
sources as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as turn from sized group by source),
weighted as (select *, (turn - 1) % 3 + 1 as weight from sources),
levels as (
  select *, (sum(source_size) over () - 3 * coalesce(sum(source_size) over earlier, 0))::double
      / (sum(weight) over () - coalesce(sum(weight) over earlier, 0))::double as level
  from weighted
  window earlier as (order by source_size::double / weight::double, turn rows between unbounded preceding and 1 preceding)),
targets as (select source, source_size, least((3 * source_size)::double, weight * max(level) over ()) as target from levels),
placed as (
  select doc_id, size, source_size, target, case when source_size > 0 then target / source_size else 0 end as rate,
    (row_number() over (partition by s.source
      order by length(size::varchar) * 100 + substr(size::varchar, 1, 2)::int, substr(digest, 1, 2), size, digest))::double as place,
    ('0x' || substr(md5(concat('20:', coalesce(s.source, ''))), 1, 8))::bigint::double / 4294967296 as shift
  from sized s join targets t on s.source is not distinct from t.source)
select doc_id, size, source_size, target,
  (size * (floor(place * rate + shift) - floor((place - 1) * rate + shift)))::bigint as taken
from placed
""",
    "op10_exact_dedup": r"""
with texts as (
  select doc_id, length(coalesce(text, '')) as n_chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm
  from documents)
select doc_id, first_value(doc_id) over best as keep_id, count(*) over (partition by norm) as group_size,
  doc_id = first_value(doc_id) over best as kept, sha256(norm) as text_sha256
from texts
window best as (partition by norm order by n_chars desc, doc_id rows between unbounded preceding and unbounded following)
""",
    "op11_filter_audit": r"""
with texts as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text,
    [word for word in string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') if word <> ''] as words
  from documents),
labelled as (
  select doc_id, coalesce(bool_or(quality = 1), false) as good, coalesce(bool_or(toxic = 1), false) as toxic from labels group by doc_id),
failed as (
  select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic, concat(
    case when len(words) < 200 then 'A' else '' end,
    case when 100 * len(list_distinct(words)) < 50 * len(words) then 'B' else '' end,
    case when 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) then 'C' else '' end,
    case when regexp_matches(text, '[#$%&*|]') then 'D' else '' end,
    case when min(t.doc_id) over (partition by text) < t.doc_id then 'E' else '' end) as mask
  from texts t left join labelled l on t.doc_id = l.doc_id),
weighed as (
  select part, mask, count(*) as documents, count_if(good) as good, count_if(toxic) as toxic from failed group by part, mask),
letters(letter) as (values ('A'), ('B'), ('C'), ('D'), ('E')),
orders as (
  select concat(a.letter, b.letter, c.letter, d.letter, e.letter) as filter_order
  from letters a join letters b on b.letter <> a.letter join letters c on c.letter not in (a.letter, b.letter)
  join letters d on d.letter not in (a.letter, b.letter, c.letter)
  join letters e on e.letter not in (a.letter, b.letter, c.letter, d.letter)),
ranked as (
  select *, coalesce(list_min([strpos(filter_order, letter) for letter in string_split(mask, '') if letter <> '']), 6) as removal
  from weighed, orders),
steps as (select filter_order, unnest(range(1, 6))::int as step from orders),
counted as (
  select part, r.filter_order, step, substr(r.filter_order, step, 1) as letter,
    sum(case when removal > step then documents else 0 end)::bigint as kept,
    sum(case when removal = step then documents else 0 end)::bigint as removed,
    sum(case when removal < step and contains(mask, substr(r.filter_order, step, 1)) then documents else 0 end)::bigint as redundant,
    sum(case when mask = substr(r.filter_order, step, 1) then documents else 0 end)::bigint as unique_fails,
    sum(case when removal = step then good else 0 end)::bigint as good_lost,
    sum(case when removal = step then toxic else 0 end)::bigint as toxic_lost
  from ranked r join steps s on r.filter_order = s.filter_order group by all)
select * exclude (letter), (sum(removed) over (partition by part, letter))::bigint as shapley from counted
""",
    "op12_ranked_search": r"""
with words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents),
sizes as (
  select count(*)::bigint as n_docs, sum(len(terms))::bigint as n_terms from words where len(terms) > 0),
found as (
  select doc_id, term, count(*)::bigint as tf, any_value(n)::bigint as n
  from (select doc_id, len(terms) as n, unnest(terms) as term from words) group by doc_id, term),
frequencies as (select term, count(*)::bigint as df from found group by term),
asked as (
  select distinct item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from benchmark),
scored as (
  select item_id, doc_id, sum(floor(1000 * ln((2 * n_docs + 2)::double / (2 * df + 1)::double))::bigint
    * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))))::bigint as score
  from asked join found using (term) join frequencies using (term), sizes group by item_id, doc_id)
select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score
from scored where score > 0 qualify rank <= 10
""",
    "op13_jaccard_join": r"""
with recursive texts as (
  select doc_id, [word for word in string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') if word <> ''] as words
  from documents),
sets as (
  select doc_id, unnest(list_distinct(case when len(words) between 1 and 4 then [array_to_string(words, ' ')]
    else [array_to_string(words[i:i + 4], ' ') for i in range(1, len(words) - 3)] end)) as shingle
  from texts),
sizes as (select doc_id, count(*)::bigint as n from sets group by doc_id),
pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as shared
  from sets a join sets b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id),
links as (
  select a, b from pairs join sizes x on a = x.doc_id join sizes y on b = y.doc_id where 100 * shared >= 80 * (x.n + y.n - shared)),
reached(doc_id, other) as (
  select doc_id, doc_id from texts union select r.doc_id, l.b from reached r join links l on r.other = l.a)
select r.doc_id, coalesce(any_value(n), 0)::bigint as n_shingles, min(other) as component_id
from reached r left join sizes s on r.doc_id = s.doc_id group by r.doc_id
""",
}

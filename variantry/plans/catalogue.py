"""Every operator as a query over the driver's tables, with the SQL it must agree with."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variantry.config import PipelineConfig, Rule
from variantry.functions.predicates import apply_rules, condition
from variantry.functions.schema import (
    coerce_types,
    drop_columns,
    fixed_types,
    priority_order,
    rename_columns,
    with_provenance,
    with_source_dataset,
)
from variantry.functions.text import col, double_text_sql, tokens
from variantry.names import COLLAPSE_KEYS, DATASET_INDEX, ROW_COUNT, ROW_ORDER, SITE_KEYS, UNIQUE_KEYS
from variantry.operators import report, validate
from variantry.operators.cohort import (
    below_cutoff,
    cohort,
    family_frequencies,
    frequency_conflicts,
    row_counts,
    union_aligned,
    with_family_columns,
)
from variantry.operators.collapse import collapse
from variantry.operators.membership import (
    IN_GENES,
    mark_criteria,
    mark_listed,
    match_any,
    match_genes,
    match_regions,
    match_rsids,
)
from variantry.plans.driver_tables import FAMILIES, REGIONS_SQL, VARIANTS_SQL, regions, table, variants
from variantry.plans.pipeline import combine, filter_and_collapse
from variantry.session import scratch_path
from variantry.sinks import as_text, export_tsv, write_dataset
from variantry.sources.lists import read_genes, read_genes_and_rsids, read_regions, rsids_of
from variantry.sources.tables import number_datasets, read_dataset, read_datasets, read_delimited
from variantry.sources.vcf import flatten_vcf, parse_header

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

MAX_AF = "ANN['MAX_AF']"
DEPTH = "INFO['DP']"
SAOBS = "FORMAT['SAOBS']"
AF = "FORMAT['AF']"
SYMBOL = "ANN['SYMBOL']"
IMPACT = "ANN['IMPACT']"
TEXT_AF = "INFO['TEXT_AF']"
CELLS = [DEPTH, MAX_AF, IMPACT, SYMBOL, "family", AF]
GENES = ["Brand#3", "Brand#12", "PROMO"]


def q(name: str) -> str:
    return f'"{name}"'


def listed(names: list[str]) -> str:
    return ", ".join(q(name) for name in names)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL it is checked by."""
    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = f"with {VARIANTS_SQL}, {REGIONS_SQL} {sql}"
        return run

    return register


# --- predicates -----------------------------------------------------------------


def register_rule(name: str, rule: Rule, test: str) -> None:
    shown = ["SAMPLE", "POS", rule.column]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return apply_rules(variants(spark, sf_dir), [rule]).select(*[col(column) for column in shown])

    QUERIES[name] = run
    ORACLES[name] = f"with {VARIANTS_SQL} select {listed(shown)} from variants where {test}"


register_rule("filter_eq", Rule(DEPTH, "==", 7), f"{q(DEPTH)} = 7")
register_rule("filter_ne", Rule(DEPTH, "!=", 7), f"{q(DEPTH)} is distinct from 7")
register_rule("filter_lt", Rule(DEPTH, "<", 12), f"{q(DEPTH)} < 12")
register_rule("filter_le", Rule(DEPTH, "<=", 12), f"{q(DEPTH)} <= 12")
register_rule("filter_gt", Rule(DEPTH, ">", 12), f"{q(DEPTH)} > 12")
register_rule("filter_ge", Rule(DEPTH, ">=", 12), f"{q(DEPTH)} >= 12")
register_rule("filter_in", Rule(SAOBS, "in", ["2", "5"]), f"{q(SAOBS)} in ('2', '5')")
register_rule("filter_not_in", Rule(SAOBS, "not_in", ["2", "5"]), f"coalesce({q(SAOBS)} not in ('2', '5'), true)")
register_rule("filter_contains", Rule(SAOBS, "contains", "[1-3]"), f"regexp_matches({q(SAOBS)}, '[1-3]')")
register_rule(
    "filter_not_contains", Rule(SAOBS, "not_contains", "[1-3]"), f"coalesce(not regexp_matches({q(SAOBS)}, '[1-3]'), true)"
)
register_rule("filter_freq_keep_null", Rule(MAX_AF, "<=", 0.05), f"({q(MAX_AF)} <= 0.05 or {q(MAX_AF)} is null)")
register_rule(
    "filter_freq_text", Rule(TEXT_AF, ">", 0.04),
    f"(try_cast({q(TEXT_AF)} as double) > 0.04 or {q(TEXT_AF)} is null or {q(TEXT_AF)} in ('', '.', 'NA', 'NULL', 'null'))",
)
register_rule(
    "filter_freq_not_equal", Rule(TEXT_AF, "!=", 0.05),
    f"(try_cast({q(TEXT_AF)} as double) is distinct from 0.05 or {q(TEXT_AF)} is null)",
)


@query(
    f"""select SAMPLE, POS, {listed([MAX_AF, IMPACT, DEPTH])} from variants
    where ({q(MAX_AF)} <= 0.05 or {q(MAX_AF)} is null) and {q(IMPACT)} in ('HIGH', 'MODERATE')
      and {q(DEPTH)} >= 5 and coalesce(not regexp_matches({q(SAOBS)}, '6'), true)"""
)
def filter_conjunction(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = PipelineConfig(
        {"FILTERS": {MAX_AF: "<=:0.05", IMPACT.lower(): {"operator": "in", "value": ["HIGH", "MODERATE"]}, DEPTH: ">=:5", SAOBS: "not_contains:6"}}
    )
    kept = apply_rules(variants(spark, sf_dir), config.rules)
    return kept.select("SAMPLE", "POS", *[col(name) for name in (MAX_AF, IMPACT, DEPTH)])


# --- lists and regions ------------------------------------------------------------

GENE_SQL = (
    f"exists (select 1 from (select unnest(string_split_regex({q(SYMBOL)}, '[;,|&]')) as token) "
    f"where trim(token) in ({', '.join(repr(gene) for gene in GENES)}))"
)
REGION_SQL = "exists (select 1 from regions where r_chrom = CHROM and POS between r_start and r_end)"
RSID_SQL = (
    'exists (select 1 from (select unnest(string_split_regex("ID", \'[;,|&]\')) as token) '
    "where trim(token) in (select concat('rs', o_custkey) from orders where o_orderpriority = '1-URGENT'))"
)


def urgent_rsids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list that grows with the data: an rsID per customer with an urgent order."""
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    return urgent.selectExpr("concat('rs', o_custkey) as rsid").distinct()


@query(f"select SAMPLE, POS, {q(SYMBOL)} from variants where {GENE_SQL}")
def gene_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match_genes(variants(spark, sf_dir), GENES).select("SAMPLE", "POS", col(SYMBOL))


@query('select SAMPLE, POS, "ID" from variants where ' + RSID_SQL)
def rsid_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match_rsids(variants(spark, sf_dir), urgent_rsids(spark, sf_dir)).select("SAMPLE", "POS", "ID")


@query('select SAMPLE, POS, "ID" from variants where ' + RSID_SQL)
def rsid_semi_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As `rsid_semi`, by the join that lists too long for a filter take."""
    kept = match_rsids(variants(spark, sf_dir), urgent_rsids(spark, sf_dir))
    return kept.select("SAMPLE", "POS", "ID")


@query("""select distinct rsid from (
    select trim(case when c_mktsegment = 'BUILDING' then concat('15:', c_custkey)
      else concat('  rs', c_custkey % 700, case when c_nationkey = 3 then '*' else ' ' end) end) as rsid from customer)
    where starts_with(rsid, 'rs')""")
def rsid_normalisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "customer").selectExpr(
        "case when c_mktsegment = 'BUILDING' then concat('15:', c_custkey) "
        "else concat('  rs', c_custkey % 700, case when c_nationkey = 3 then '*' else ' ' end) end as rsid"
    )
    return rsids_of(raw, "rsid")


@query(f"select SAMPLE, CHROM, POS from variants where {REGION_SQL}")
def region_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return match_regions(variants(spark, sf_dir), regions(spark, sf_dir)).select("SAMPLE", "CHROM", "POS")


@query(
    """select SAMPLE, CHROM, POS from variants where exists (select 1 from orders
    where o_custkey % 22 = POS % 22 and POS between o_custkey and o_custkey + o_totalprice / 20000)"""
)
def region_semi_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many overlapping regions of different lengths, one per order."""
    spans = table(spark, sf_dir, "orders").selectExpr(
        "concat('', o_custkey % 22 + 1) as chrom", "o_custkey as start",
        "cast(floor(o_custkey + o_totalprice / 20000) as bigint) as end",
    )
    return match_regions(variants(spark, sf_dir), spans).select("SAMPLE", "CHROM", "POS")


@query(f'select SAMPLE, CHROM, POS, "ID", {q(SYMBOL)} from variants where {REGION_SQL} or {GENE_SQL} or {RSID_SQL}')
def criteria_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = match_any(variants(spark, sf_dir), GENES, urgent_rsids(spark, sf_dir), regions(spark, sf_dir))
    return kept.select("SAMPLE", "CHROM", "POS", "ID", col(SYMBOL))


@query(
    f"""select count(*) as n_rows, count(*) filter (where {REGION_SQL}) as n_in_region,
    count(*) filter (where {GENE_SQL}) as n_in_genes, count(*) filter (where {REGION_SQL} or {GENE_SQL}) as n_any from variants"""
)
def criteria_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked, flags = mark_criteria(variants(spark, sf_dir), genes=GENES, regions=regions(spark, sf_dir))
    return report.criteria_counts(marked, flags)


@query(
    f"""select count(*) as n_original, count(*) filter (where {GENE_SQL}) as n_kept,
    count(*) filter (where not {GENE_SQL}) as n_removed,
    round(count(*) filter (where not {GENE_SQL}) * 100.0 / count(*), 6) as pct_removed from variants"""
)
def gene_filter_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = mark_listed(variants(spark, sf_dir), SYMBOL, GENES, IN_GENES)
    return report.kept_report(marked, F.col(IN_GENES)).withColumn("pct_removed", F.round("pct_removed", 6))


@query(
    f"""select token, count(*) as n_rows from (
    select trim(unnest(string_split_regex({q(SYMBOL)}, '[;,|&]'))) as token from variants) where token <> '' group by token"""
)
def symbol_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = variants(spark, sf_dir).select(F.explode(tokens(col(SYMBOL))).alias("token"))
    return entries.groupBy("token").agg(F.count(F.lit(1)).alias("n_rows"))


# --- collapse -----------------------------------------------------------------------


def sorted_cell(name: str, separator: str = ";") -> str:
    text = f"cast({q(name)} as varchar)"
    return f"string_agg(distinct {text}, '{separator}' order by {text}) as {q(name)}"


def first_cells(keys: list[str], names: list[str], source: str) -> str:
    """Joined distinct values in order of first appearance, one subquery per column."""
    on = " and ".join(f"groups.{q(key)} = {{side}}.{q(key)}" for key in keys)
    parts, joins = [], []
    for i, name in enumerate(names):
        side = f"c{i}"
        joins.append(
            f"left join (select {listed(keys)}, string_agg(v, ';' order by o) as v from "
            f"(select {listed(keys)}, cast({q(name)} as varchar) as v, min(_row_order) as o from {source} "
            f"where {q(name)} is not null group by all) group by {listed(keys)}) as {side} on {on.format(side=side)}"
        )
        parts.append(f"{side}.v as {q(name)}")
    shown = ", ".join(f"groups.{q(key)}" for key in keys)
    return f"select {shown}, {', '.join(parts)} from (select distinct {listed(keys)} from {source}) as groups {' '.join(joins)}"


def with_cells(df: DataFrame, keys: list[str], cells: list[str] = CELLS, order: bool = False) -> DataFrame:
    extra = [ROW_ORDER] if order else []
    return df.select(*[col(name) for name in [*keys, *cells, *extra]])


KEYS_GIVEN = " and ".join(f"{q(key)} is not null" for key in COLLAPSE_KEYS)


@query(
    f"select {listed(COLLAPSE_KEYS)}, {', '.join(sorted_cell(name) for name in CELLS)} "
    f"from variants where {KEYS_GIVEN} group by {listed(COLLAPSE_KEYS)}"
)
def collapse_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse(with_cells(variants(spark, sf_dir), COLLAPSE_KEYS), order="sorted")


@query(
    f", keyed as (select * from variants where {KEYS_GIVEN}) " + first_cells(COLLAPSE_KEYS, CELLS, "keyed")
)
def collapse_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse(with_cells(variants(spark, sf_dir), COLLAPSE_KEYS, order=True))


@query(first_cells(SITE_KEYS, [DEPTH, MAX_AF, "SAMPLE", "family"], "variants"))
def collapse_sites_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collapse to coordinates only, where cells join many values."""
    rows = with_cells(variants(spark, sf_dir), SITE_KEYS, [DEPTH, MAX_AF, "SAMPLE", "family"], order=True)
    return collapse(rows, SITE_KEYS)


@query(
    f"select {listed(COLLAPSE_KEYS)}, {', '.join(sorted_cell(name) for name in CELLS)} "
    f"from variants group by {listed(COLLAPSE_KEYS)}"
)
def collapse_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse(with_cells(variants(spark, sf_dir), COLLAPSE_KEYS), order="sorted", drop_null_keys=False)


@query(
    f"""select {listed(COLLAPSE_KEYS)}, {sorted_cell(MAX_AF)}, {sorted_cell(IMPACT)}, 'cohort_a' as "SOURCE_DATASET"
    from variants where {KEYS_GIVEN} and ({q(MAX_AF)} <= 0.05 or {q(MAX_AF)} is null) and {GENE_SQL}
    group by {listed(COLLAPSE_KEYS)}"""
)
def filter_and_collapse_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genes, rules, column drops and collapse as one plan."""
    unwanted = [TEXT_AF, DEPTH, AF, SYMBOL, "family", "ID"]
    config = PipelineConfig({"FILTERS": {MAX_AF: "<=:0.05"}, "COLUMN_MANAGEMENT": {"drop_columns": unwanted}})
    rows = variants(spark, sf_dir).drop(DATASET_INDEX)
    return filter_and_collapse(rows, config, GENES, "cohort_a", order="sorted").result


# --- cohort ---------------------------------------------------------------------------


def list_text(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({name: F.when(F.size(col(name)) > 0, F.array_join(col(name), ";")) for name in names})


def family_columns_sql(prefix: str = "AF_") -> str:
    return ", ".join(
        f"min_by({q(AF)}, _row_order) filter (where family = '{name}') as {q(prefix + name)}" for name in FAMILIES
    )


@query(
    f"""select {listed(SITE_KEYS)}, {', '.join(sorted_cell(name) for name in (MAX_AF, IMPACT, SYMBOL, DEPTH, TEXT_AF, 'family', 'SAMPLE'))},
    {family_columns_sql()}, count(*) as "ROW_COUNT" from variants group by {listed(SITE_KEYS)}"""
)
def cohort_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = variants(spark, sf_dir).drop(DATASET_INDEX)
    gathered = cohort(rows, families=FAMILIES, order="sorted")
    return list_text(gathered, [MAX_AF, IMPACT, SYMBOL, DEPTH, TEXT_AF, "family", "SAMPLE"])


ALL_CELLS = ["SAMPLE", "ID", DEPTH, TEXT_AF, SAOBS, MAX_AF, IMPACT, SYMBOL, "family"]


@query(
    f"""select {listed(SITE_KEYS)}, {', '.join(sorted_cell(name) for name in ALL_CELLS)},
    {family_columns_sql()}, count(*) as "ROW_COUNT" from variants group by {listed(SITE_KEYS)}"""
)
def cohort_all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = variants(spark, sf_dir).drop(DATASET_INDEX)
    return list_text(cohort(rows, columns="all", families=FAMILIES, order="sorted"), ALL_CELLS)


@query(
    f", ordered as (select *, row_number() over (partition by {listed(SITE_KEYS)} order by _dataset_index, _row_order) as rn from variants), "
    f"kept as (select * exclude (_row_order), rn as _row_order from ordered) "
    + first_cells(SITE_KEYS, [DEPTH, "SAMPLE", "family"], "kept")
)
def cohort_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values in order of datasets and rows."""
    rows = variants(spark, sf_dir).select(*SITE_KEYS, col(DEPTH), "SAMPLE", "family", DATASET_INDEX, ROW_ORDER)
    return list_text(cohort(rows), [DEPTH, "SAMPLE", "family"]).drop(ROW_COUNT)


@query(f"select {listed(SITE_KEYS)}, {family_columns_sql()} from variants group by {listed(SITE_KEYS)}")
def family_af_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return family_frequencies(variants(spark, sf_dir), FAMILIES)


@query(
    f"select {listed(SITE_KEYS)}, "
    + ", ".join(
        f"min_by({q(DEPTH)}, _row_order) filter (where SAMPLE = '{name}' and {q(DEPTH)} is not null) as {q('depth_' + name)}"
        for name in ("S0", "S1", "S2", "S3")
    )
    + f" from variants group by {listed(SITE_KEYS)}"
)
def sample_depth_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column per family member."""
    samples = ["S0", "S1", "S2", "S3"]
    return family_frequencies(variants(spark, sf_dir), samples, value=DEPTH, by="SAMPLE", prefix="depth_")


@query(f'select {listed(SITE_KEYS)}, count(*) as "ROW_COUNT" from variants group by {listed(SITE_KEYS)}')
def row_count_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort(variants(spark, sf_dir), row_count_only=True)


@query(f'select {listed(SITE_KEYS)}, count(*) as "ROW_COUNT" from variants group by {listed(SITE_KEYS)} having count(*) < 5')
def row_count_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cohort(variants(spark, sf_dir), row_count_only=True, cutoff=5)


@query(
    f"""select {listed(SITE_KEYS)}, {', '.join(sorted_cell(name) for name in (MAX_AF, IMPACT, SYMBOL, DEPTH, TEXT_AF, 'family', 'SAMPLE'))},
    {family_columns_sql()}, count(*) as "ROW_COUNT" from variants group by {listed(SITE_KEYS)} having count(*) < 5"""
)
def cohort_below_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = variants(spark, sf_dir).drop(DATASET_INDEX)
    gathered = cohort(rows, families=FAMILIES, cutoff=5, order="sorted")
    return list_text(gathered, [MAX_AF, IMPACT, SYMBOL, DEPTH, TEXT_AF, "family", "SAMPLE"])


@query(
    f"""select SAMPLE, {listed(SITE_KEYS)} from variants
    where (CHROM, POS, "REF", "ALT") in (select ({listed(SITE_KEYS)}) from variants group by {listed(SITE_KEYS)} having count(*) < 5)"""
)
def rows_below_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return below_cutoff(variants(spark, sf_dir), 5).select("SAMPLE", *SITE_KEYS)


@query(f"select distinct {listed(SITE_KEYS)} from variants")
def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(spark, sf_dir).select(*SITE_KEYS).dropDuplicates(SITE_KEYS)


@query(
    """, counts as (select CHROM, POS, "REF", "ALT", count(*) as n from variants group by all)
    select count(*) as n_variants, count(*) filter (where n < 5) as n_retained,
    round(count(*) filter (where n < 5) * 100.0 / count(*), 6) as pct_retained from counts"""
)
def cohort_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = report.cohort_totals(row_counts(variants(spark, sf_dir)), 5)
    return totals.withColumn("pct_retained", F.round("pct_retained", 6))


@query(
    """select 'customer' as origin, c_name as name, c_acctbal as balance, c_mktsegment as segment, null as nation from customer
    union all select 'supplier', s_name, s_acctbal, null, s_nationkey from supplier"""
)
def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of different widths and types united by column name."""
    customers = table(spark, sf_dir, "customer").selectExpr(
        "'customer' as origin", "c_name as name", "c_acctbal as balance", "c_mktsegment as segment"
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_nationkey as nation", "s_name as name", "cast(s_acctbal as double) as balance", "'supplier' as origin"
    )
    return union_aligned([customers, suppliers])


# --- validation -------------------------------------------------------------------------

COLLAPSED_SQL = f", collapsed as (select distinct {listed(COLLAPSE_KEYS)} from variants where {KEYS_GIVEN})"
DUPLICATES_SQL = (
    f"{COLLAPSED_SQL}, duplicates as (select {listed(UNIQUE_KEYS)}, count(*) as n_rows from collapsed "
    f"group by {listed(UNIQUE_KEYS)} having count(*) > 1)"
)


def same_key(left: str, right: str) -> str:
    return " and ".join(f"{left}.{q(key)} = {right}.{q(key)}" for key in UNIQUE_KEYS)


@query(f"{DUPLICATES_SQL} select {listed(UNIQUE_KEYS)}, n_rows from duplicates")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.duplicate_keys(validate.group_rows(variants(spark, sf_dir), COLLAPSE_KEYS), UNIQUE_KEYS)


@query(f"{DUPLICATES_SQL} select {listed(UNIQUE_KEYS)}, n_rows from duplicates order by {listed(UNIQUE_KEYS)} limit 10")
def duplicate_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = validate.group_rows(variants(spark, sf_dir), COLLAPSE_KEYS)
    return validate.preview(validate.duplicate_keys(groups, UNIQUE_KEYS))


def quarantined(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = with_cells(variants(spark, sf_dir), COLLAPSE_KEYS, [IMPACT, DEPTH])
    return validate.quarantine(collapse(rows, order="sorted"), rows, COLLAPSE_KEYS)


@query(
    f"{DUPLICATES_SQL} select distinct {listed([*COLLAPSE_KEYS, IMPACT, DEPTH])} from variants v "
    f"where exists (select 1 from duplicates d where {same_key('d', 'v')})"
)
def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantined(spark, sf_dir)[1]


@query(
    f"{DUPLICATES_SQL} select {listed(COLLAPSE_KEYS)}, {sorted_cell(IMPACT)}, {sorted_cell(DEPTH)} from variants v "
    f"where {KEYS_GIVEN} and not exists (select 1 from duplicates d where {same_key('d', 'v')}) group by {listed(COLLAPSE_KEYS)}"
)
def clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantined(spark, sf_dir)[0]


@query(
    f"""select _dataset_index as dataset, {listed(SITE_KEYS)}, count(*) as n_rows from variants
    group by all having count(*) > 1"""
)
def dataset_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.dataset_duplicates(variants(spark, sf_dir)).withColumnRenamed(DATASET_INDEX, "dataset")


@query("""select _dataset_index as dataset, min(family) as family, max(family) as last_family from variants group by 1""")
def dataset_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.dataset_families(variants(spark, sf_dir)).withColumnRenamed(DATASET_INDEX, "dataset")


@query(
    f"""select {listed(SITE_KEYS)}, family, count(distinct {q(AF)}) as n_values from variants
    group by all having count(distinct {q(AF)}) > 1"""
)
def af_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency_conflicts(variants(spark, sf_dir))


@query("select family, cast(null as double) as \"AF_F98\", cast(null as double) as \"AF_F99\" from variants")
def missing_family_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_family_columns(variants(spark, sf_dir).select("family"), ["F99", "F98"])


# --- reports --------------------------------------------------------------------------


@query(
    f"""select cast({q(MAX_AF)} as varchar) as value, count(*) as n_rows from variants where {q(MAX_AF)} is not null
    group by 1 order by n_rows desc, value limit 10"""
)
def value_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.value_profile(variants(spark, sf_dir), MAX_AF)


@query(
    " union all ".join(
        f"select '{name.replace(chr(39), chr(39) * 2)}' as column_name, count(*) filter (where {q(name)} is null "
        f"or cast({q(name)} as varchar) in ('', '.', 'NA', 'NULL', 'null')) as n_missing from variants"
        for name in (MAX_AF, SAOBS, TEXT_AF)
    )
)
def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.null_profile(variants(spark, sf_dir), [MAX_AF, SAOBS, TEXT_AF])


TEXT_MISSING = f"({q(TEXT_AF)} is null or {q(TEXT_AF)} in ('', '.', 'NA', 'NULL', 'null'))"
TEXT_NUMBER = f"try_cast({q(TEXT_AF)} as double)"


@query(
    f"""select 'INFO[''TEXT_AF'']' as column_name, '<=:0.05' as rule, count(*) as n_rows,
      count(*) filter (where {TEXT_MISSING}) as n_missing, count(*) filter (where not {TEXT_MISSING}) as n_valid,
      count({TEXT_NUMBER}) as n_numeric, count(*) filter (where {TEXT_NUMBER} <= 0.05) as n_matching,
      count(*) filter (where {TEXT_NUMBER} <= 0.05 or {TEXT_MISSING}) as n_kept,
      count(*) filter (where {TEXT_NUMBER} <= 0.05 or {TEXT_MISSING}) as n_remaining,
      count(*) filter (where {TEXT_MISSING}) as n_missing_preserved from variants
    union all
    select 'INFO[''DP'']', '>:12', count(*), count(*) filter (where {q(DEPTH)} is null), count({q(DEPTH)}), count({q(DEPTH)}),
      count(*) filter (where {q(DEPTH)} > 12), count(*) filter (where {q(DEPTH)} > 12),
      count(*) filter (where {q(DEPTH)} > 12 and ({TEXT_NUMBER} <= 0.05 or {TEXT_MISSING})), 0 from variants"""
)
def filter_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.filter_diagnostics(variants(spark, sf_dir), [Rule(TEXT_AF, "<=", 0.05), Rule(DEPTH, ">", 12)])


@query(
    f"""select n_original, n_filtered, n_collapsed, round((n_original - n_collapsed) * 100.0 / n_original, 6) as pct_reduction from
    (select (select count(*) from variants) as n_original,
      (select count(*) from variants where {q(MAX_AF)} <= 0.05 or {q(MAX_AF)} is null) as n_filtered,
      (select count(*) from (select distinct {listed(COLLAPSE_KEYS)} from variants
        where ({q(MAX_AF)} <= 0.05 or {q(MAX_AF)} is null) and {KEYS_GIVEN})) as n_collapsed)"""
)
def stage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_cells(variants(spark, sf_dir), COLLAPSE_KEYS, [MAX_AF, IMPACT])
    kept = apply_rules(rows, [Rule(MAX_AF, "<=", 0.05)])
    summary = report.stage_summary(rows, kept, collapse(kept, order="sorted"))
    return summary.withColumn("pct_reduction", F.round("pct_reduction", 6))


@query("select distinct family from variants order by family")
def families(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.families(variants(spark, sf_dir))


@query(f"select count(*) filter (where {q(SAOBS)} = '3') as n_equal, count(*) filter (where {q(SAOBS)} is distinct from '3') as n_other from variants")
def complementary_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`==` and `!=` split all rows between them, null cells included."""
    rows = variants(spark, sf_dir)
    equal = condition(rows, SAOBS, Rule(SAOBS, "==", "3"), False)
    other = condition(rows, SAOBS, Rule(SAOBS, "!=", "3"), False)
    return rows.agg(F.count_if(equal).alias("n_equal"), F.count_if(other).alias("n_other"))


# --- columns ------------------------------------------------------------------------------


@query(
    f"""select family, POS, {listed([DEPTH, 'SAMPLE'])} from variants"""
)
def priority_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = variants(spark, sf_dir).select("SAMPLE", "POS", col(DEPTH), "family")
    return priority_order(rows, ["family", "absent", "POS"])


@query(f"select * exclude ({listed([MAX_AF, IMPACT, SYMBOL, '_dataset_index', '_row_order'])}) from variants")
def dropped_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_columns(variants(spark, sf_dir), [MAX_AF, IMPACT, SYMBOL, "absent", DATASET_INDEX, ROW_ORDER])


@query(f'select POS as "position", {q(DEPTH)} as "depth" from variants')
def renamed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = variants(spark, sf_dir).select("POS", col(DEPTH))
    return rename_columns(rows, {"POS": "position", DEPTH: "depth", "absent": "unused"})


@query(
    """select event_id, coalesce(try_cast(trunc(try_cast(t as double)) as bigint), 0) as as_int, try_cast(t as double) as as_float,
    coalesce(lower(t) = 'true', false) as as_bool, t as as_text from (
      select event_id, case event_type when 'click' then cast(value as varchar) when 'view' then '.' when 'error' then 'True'
        when 'purchase' then 'NA' else props end as t from events)"""
)
def coerced_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    cell = (
        "case event_type when 'click' then cast(value as string) when 'view' then '.' when 'error' then 'True' "
        "when 'purchase' then 'NA' else props end"
    )
    rows = table(spark, sf_dir, "events").selectExpr(
        "event_id", f"{cell} as as_int", f"{cell} as as_float", f"{cell} as as_bool", f"{cell} as as_text"
    )
    return coerce_types(rows, {"as_int": "int64", "as_float": "float64", "as_bool": "bool", "as_text": "string"})


@query("select 'events' as family, 'events.parquet' as filename, event_id from events")
def provenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_provenance(table(spark, sf_dir, "events")).select("family", "filename", "event_id")


@query("""select event_id, 'events' as "SOURCE_DATASET" from events""")
def source_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_source_dataset(table(spark, sf_dir, "events").select("event_id"), "events")


@query("select l_orderkey, cast(l_quantity / 1048576 as varchar) as small, cast(l_quantity * 33554432 as varchar) as large from lineitem")
def rendered_doubles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        f"{double_text_sql('(l_quantity / 1048576)')} as small",
        f"{double_text_sql('(l_quantity * 33554432)')} as large",
    )


# --- sources and sinks -------------------------------------------------------------------

STORED = ["SAMPLE", *SITE_KEYS, "ID", DEPTH, SAOBS, MAX_AF, "family"]
STORED_SQL = f"select SAMPLE, {listed(SITE_KEYS)}, nullif(\"ID\", '.') as \"ID\", {listed([DEPTH, SAOBS, MAX_AF, 'family'])} from variants"


@query(STORED_SQL)
def tsv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export as TSV, read the files back as text and type them."""
    path = scratch_path(spark, "tsv")
    export_tsv(variants(spark, sf_dir).select(*[col(name) for name in STORED]), path, null_value="")
    read = read_delimited(spark, path).drop(ROW_ORDER)
    typed = coerce_types(read, {"POS": "int64", MAX_AF: "float64"})
    return typed.withColumns({DEPTH: col(DEPTH).try_cast("bigint"), "ID": F.nullif(F.col("ID"), F.lit("."))})


@query(STORED_SQL.replace("nullif(\"ID\", '.')", '"ID"'))
def dataset_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store partitioned by family and read back in the recorded column order."""
    path = scratch_path(spark, "dataset")
    write_dataset(variants(spark, sf_dir).select(*[col(name) for name in STORED]), path, partition_by=["family"])
    return read_dataset(spark, path)


STORED_COHORT_SQL = f"""select {listed(SITE_KEYS)}, string_agg(distinct family, ';' order by family) as family, count(*) as "ROW_COUNT",
    {', '.join(f"max(af) filter (where family = '{name}') as {q('AF_' + name)}" for name in ('A', 'N', 'R'))}
    from (select CHROM, POS, case "REF" when 'A' then 'A' when 'N' then 'N' else 'R' end as family, 'x' as "REF", "ALT",
      max({q(AF)}) as af from variants group by all) group by {listed(SITE_KEYS)}"""


def stored_families(spark: SparkSession, sf_dir: str, named: bool = True) -> list[str]:
    """One dataset per value of REF, which is its family."""
    paths = []
    for name in [row[0] for row in variants(spark, sf_dir).select("REF").distinct().orderBy("REF").collect()]:
        rows = variants(spark, sf_dir).where(F.col("REF") == name)
        family = [F.lit(name).alias("family")] if named else []
        dataset = rows.groupBy("CHROM", "POS", F.lit("x").alias("REF"), "ALT").agg(F.max(col(AF)).alias(AF), *family)
        path = scratch_path(spark, f"family_{name}")
        write_dataset(dataset, path)
        paths.append(path)
    return paths


@query(STORED_COHORT_SQL)
def cohort_of_stored_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store one dataset per family, read them all, check them and combine them."""
    df, names = read_datasets(spark, stored_families(spark, sf_dir))
    return list_text(combine(df, names), ["family"])


@query(
    """select d.family as "SOURCE_DATASET", d.n as dataset, count(*) as n_rows from variants v join
    (select family, row_number() over (order by family) - 1 as n from (select distinct family from variants)) d
    on v.family = d.family group by all"""
)
def numbered_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = variants(spark, sf_dir).select(F.col("family").alias("SOURCE_DATASET"), "POS")
    numbered, _ = number_datasets(rows)
    return numbered.groupBy("SOURCE_DATASET", F.col(DATASET_INDEX).alias("dataset")).agg(F.count(F.lit(1)).alias("n_rows"))


VCF_HEADER = [
    '##INFO=<ID=DP,Number=1,Type=Integer,Description="Depth">',
    '##INFO=<ID=LATE,Number=0,Type=Flag,Description="Shipped late">',
    '##INFO=<ID=TAX,Number=.,Type=String,Description="Tax">',
    '##INFO=<ID=END,Number=1,Type=Integer,Description="End">',
    '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
    '##FORMAT=<ID=AD,Number=.,Type=Integer,Description="Depths">',
    "##INFO=<ID=ANN,Number=.,Type=String,Description=\"Functional annotations: 'Allele | Gene_Name | AA.pos / AA.length | ERRORS / WARNINGS / INFO'\">",
    "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tLEFT\tRIGHT",
]


@query(
    """select case s when 0 then 'LEFT' else 'RIGHT' end as "SAMPLE", concat('chr', l_partkey % 22 + 1) as "CHROM", l_partkey as "POS",
      l_returnflag as "REF", l_linestatus as "ALT", l_quantity as "QUAL",
      case when l_linenumber > 5 then '[''q10'', ''s50'']' else '[''PASS'']' end as "FILTER",
      case when l_linenumber = 1 then null else concat('rs', l_suppkey) end as "ID",
      case when l_linenumber = 2 then null else l_linenumber end as "INFO['DP']", l_linenumber = 3 as "INFO['LATE']",
      concat('(''', l_linenumber, ''', ''b'')') as "INFO['TAX']", l_partkey as "INFO['END']",
      case s when 0 then '(0, 1)' else '(None, None)' end as "FORMAT['GT']",
      concat('(', l_linenumber + s, ', ', l_suppkey, ')') as "FORMAT['AD']",
      l_linestatus as "ANN['Allele']", case a when 0 then p_brand else p_type end as "ANN['Gene_Name']",
      case a when 0 then concat('(start: ', p_size, ', end: ', p_size * 2 + 9, ', length: ', p_size + 9, ')') end as "ANN['AA.pos / AA.length']",
      case a when 0 then '[]' else '[''W1'', ''W2'']' end as "ANN['ERRORS / WARNINGS / INFO']"
    from lineitem join part on l_partkey = p_partkey, (values (0), (1)) samples(s), (values (0), (1)) annotations(a)"""
)
def vcf_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VCF text with two samples and two annotations per record, as a long table."""
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    ).selectExpr(
        """concat_ws('\t', concat('chr', l_partkey % 22 + 1), l_partkey,
          case when l_linenumber = 1 then '.' else concat('rs', l_suppkey) end,
          l_returnflag, l_linestatus, l_quantity, case when l_linenumber > 5 then 'q10;s50' else 'PASS' end,
          concat(case when l_linenumber = 2 then '' else concat('DP=', l_linenumber, ';') end,
            case when l_linenumber = 3 then 'LATE;' else '' end, 'TAX=', l_linenumber, ',b;ANN=',
            l_linestatus, '|', p_brand, '|', p_size, '/', p_size + 9, '|,', l_linestatus, '|', p_type, '||W1&W2'),
          'GT:AD', concat('0/1:', l_linenumber, ',', l_suppkey), concat('./.:', l_linenumber + 1, ',', l_suppkey)) as value"""
    )
    return flatten_vcf(lines, parse_header(VCF_HEADER)).drop(ROW_ORDER)


@query(
    f"""select SAMPLE, POS, cast({q(MAX_AF)} as varchar) as {q(MAX_AF)},
    case when {q(MAX_AF)} > 0.05 then 'True' when {q(MAX_AF)} <= 0.05 then 'False' end as common from variants"""
)
def exported_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = variants(spark, sf_dir).select("SAMPLE", "POS", col(MAX_AF), (col(MAX_AF) > 0.05).alias("common"))
    return as_text(rows).withColumn("POS", F.col("POS").cast("bigint"))


# --- files that a user brings, written from the tables and read again ---------------------------


def written(df: DataFrame, label: str, header: bool = True, separator: str = "\t") -> str:
    """A table as delimited text files in the scratch folder."""
    path = scratch_path(df.sparkSession, label)
    df.write.csv(path, sep=separator, header=header)
    return path


@query("select distinct p_brand as symbol from part where p_size > 10")
def gene_list_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    brands = table(spark, sf_dir, "part").where("p_size > 10")
    return read_genes(spark, written(brands.selectExpr("p_brand as `Gene Symbol`", "p_type as Description"), "genes"))


@query(
    """select 'gene' as kind, p_brand as entry from part group by p_brand
    union all select distinct 'rsid', concat('rs', p_partkey % 50) from part where p_partkey % 3 > 0"""
)
def flexible_list_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols and rsIDs under any accepted header; entries that are no rsID are left out."""
    rows = table(spark, sf_dir, "part").selectExpr(
        "p_brand as Gene_Symbol", "if(p_partkey % 3 > 0, concat(' rs', p_partkey % 50, ' '), concat('15:', p_partkey)) as rsID_paper"
    )
    genes, rsids = read_genes_and_rsids(spark, written(rows, "lists"))
    return genes.selectExpr("'gene' as kind", "symbol as entry").union(rsids.selectExpr("'rsid'", "rsid"))


@query("select cast(n_nationkey as varchar) as chrom, n_nationkey * 50 as start, n_nationkey * 50 + 20 as \"end\" from nation")
def bed_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "nation").selectExpr(
        "concat('chr', n_nationkey)", "n_nationkey * 50", "n_nationkey * 50 + 20", "n_name"
    )
    return read_regions(spark, written(rows, "bed", header=False))


@query(f"select SAMPLE, POS, {q(MAX_AF)} from variants where not coalesce(contains(cast({q(SYMBOL)} as varchar), 'zzz'), false)")
def gene_column_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the symbol column, a gene list keeps all rows."""
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", UserWarning)
        return match_genes(variants(spark, sf_dir).select("SAMPLE", "POS", col(MAX_AF)), GENES)


@query(f"select CHROM, POS, {sorted_cell('SAMPLE')} from variants group by CHROM, POS")
def key_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With some key columns missing, the others group the rows."""
    rows = variants(spark, sf_dir).select("CHROM", "POS", "SAMPLE").withColumnRenamed("SAMPLE", "held")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", UserWarning)
        return collapse(rows, order="sorted").withColumnRenamed("held", "SAMPLE")


@query(
    """select origin, value from (select 'customer' as origin, cast(c_acctbal / 1000000 as varchar) as value from customer
    union all select 'nation', case when n_nationkey = 1 then '0.5;0.25' else 'none' end from nation
    union all select 'supplier', case when s_acctbal > 0 then 'True' else 'False' end from supplier)"""
)
def cohort_mixed_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column as double, text and boolean in three tables: every value in the notation of exports."""
    customers = table(spark, sf_dir, "customer").selectExpr("'customer' as origin", "c_acctbal / 1000000 as value")
    nations = table(spark, sf_dir, "nation").selectExpr("'nation' as origin", "if(n_nationkey = 1, '0.5;0.25', 'none') as value")
    suppliers = table(spark, sf_dir, "supplier").selectExpr("'supplier' as origin", "s_acctbal > 0 as value")
    return union_aligned([customers, nations, suppliers])


@query(
    f"""select l_orderkey, l_partkey as "POS", l_quantity as "QUAL", 'kept as text' as "NOTE",
      case when l_linenumber = 1 then null else l_linenumber end as depth from lineitem"""
)
def ingest_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """POS and QUAL of a table of texts are numbers without being declared."""
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "cast(l_partkey as string) as POS", "cast(l_quantity as string) as QUAL", "'kept as text' as NOTE",
        "if(l_linenumber = 1, null, l_linenumber) as depth",
    )
    return fixed_types(rows, {})


@query(
    """select concat('chr', l_suppkey % 5) as "CHROM", l_partkey as "POS", 'A' as "REF", alt as "ALT", cast(null as double) as "QUAL",
      '[]' as "FILTER", cast(null as varchar) as "ID", cast(null as varchar) as "SAMPLE",
      case alt when 'T' then concat('(', l_linenumber, ',)') else concat('(', l_linenumber + 1, ',)') end as "INFO['AC']",
      alt as "ANN['Allele']", concat('gene', l_suppkey, alt) as "ANN['Gene_Name']"
    from lineitem, (values ('T'), ('G')) alleles(alt)"""
)
def vcf_multi_allelic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two alleles per record: each row has its own annotation and its own value."""
    header = parse_header([
        '##INFO=<ID=AC,Number=A,Type=Integer,Description="Allele count">',
        "##INFO=<ID=ANN,Number=.,Type=String,Description=\"Functional annotations: 'Allele | Gene_Name'\">",
        "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO",
    ])
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        """concat_ws('\t', concat('chr', l_suppkey % 5), l_partkey, '.', 'A', 'T,G', '.', '.',
          concat('AC=', l_linenumber, ',', l_linenumber + 1, ';ANN=G|gene', l_suppkey, 'G,T|gene', l_suppkey, 'T')) as value"""
    )
    return flatten_vcf(lines, header).drop(ROW_ORDER)


# --- everything in one plan ------------------------------------------------------------------

RARE_SQL = f"({q(MAX_AF)} <= 0.05 or {q(MAX_AF)} is null)"


@query(
    f""", narrowed as (select * from variants where {RARE_SQL} and ({GENE_SQL} or {REGION_SQL})),
    collapsed as (select {listed(COLLAPSE_KEYS)}, family, {sorted_cell(AF)} from narrowed where {KEYS_GIVEN}
      group by {listed(COLLAPSE_KEYS)}, family)
    select {listed(SITE_KEYS)}, string_agg(distinct family, ';' order by family) as family,
      string_agg(distinct SAMPLE, ';' order by SAMPLE) as "SAMPLE", count(*) as "ROW_COUNT",
      {', '.join(f"min_by({q(AF)}, (SAMPLE, {q(SAOBS)})) filter (where family = '{name}') as {q('AF_' + name)}" for name in FAMILIES)}
    from collapsed group by {listed(SITE_KEYS)}"""
)
def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rare variants in listed genes or regions, collapsed, then combined over families."""
    rare = apply_rules(variants(spark, sf_dir), [Rule(MAX_AF, "<=", 0.05)])
    narrowed = match_any(rare, genes=GENES, regions=regions(spark, sf_dir))
    keys = [*COLLAPSE_KEYS, "family"]
    collapsed = collapse(with_cells(narrowed, keys, [AF]), keys, order="sorted")
    combined = cohort(collapsed, families=FAMILIES, order="sorted", rank=["SAMPLE", SAOBS])
    return list_text(combined, ["family", "SAMPLE"])



"""What the jobs record about themselves, as queries: a job runs over the driver's tables, and its record is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variantry.config import PipelineConfig
from variantry.names import COLLAPSE_KEYS, SITE_KEYS, UNIQUE_KEYS
from variantry.plans.catalogue import (
    DEPTH,
    GENE_SQL,
    GENES,
    IMPACT,
    KEYS_GIVEN,
    REGION_SQL,
    RSID_SQL,
    SYMBOL,
    TEXT_AF,
    listed,
    q,
    query,
    same_key,
    stored_families,
    urgent_rsids,
    with_cells,
    written,
)
from variantry.plans.driver_tables import regions, variants
from variantry.plans.pipeline import run_cohort, run_collapse, run_narrow
from variantry.session import scratch_path
from variantry.sinks import write_dataset
from variantry.sources.tables import read_sidecar

MISSING = f"({q(TEXT_AF)} is null or {q(TEXT_AF)} in ('', '.', 'NA', 'NULL', 'null'))"
NUMBER = f"try_cast({q(TEXT_AF)} as double)"
RARE = f"coalesce({NUMBER} <= 0.05 or {MISSING}, false)"
DEEP = f"coalesce({q(DEPTH)} > 12, false)"
WITH_GENES_SQL = f", named as (select * from variants where {GENE_SQL})"


def collapse_record(spark: SparkSession, sf_dir: str) -> dict:
    """The record of a collapse with a gene list, a rule that keeps missing frequencies and one that does not."""
    dataset, output, errors = (scratch_path(spark, label) for label in ("typed", "collapsed", "errors"))
    cells = [IMPACT, SYMBOL, TEXT_AF, DEPTH]
    write_dataset(with_cells(variants(spark, sf_dir), COLLAPSE_KEYS, cells, order=True), dataset)
    config = PipelineConfig({"FILTERS": {TEXT_AF: "<=:0.05", DEPTH: ">:12"}})
    run_collapse(spark, dataset, config, output, genes=GENES, remove_validation_errors=True, quarantine_path=errors)
    return read_sidecar(spark, output)


@query(
    f"""{WITH_GENES_SQL} select 'INFO[''TEXT_AF'']' as column_name, '<=:0.05' as rule, count(*) as n_rows, count_if({MISSING}) as n_missing,
      count_if(not {MISSING}) as n_valid, count({NUMBER}) as n_numeric, count_if({NUMBER} <= 0.05) as n_matching,
      count_if({RARE}) as n_kept, count_if({RARE}) as n_remaining, count_if({MISSING}) as n_missing_preserved from named
    union all select 'INFO[''DP'']', '>:12', count(*), count_if({q(DEPTH)} is null), count({q(DEPTH)}), count({q(DEPTH)}),
      count_if({DEEP}), count_if({DEEP}), count_if({DEEP} and {RARE}), 0 from named"""
)
def collapse_rule_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per rule, of the rows that the gene list left."""
    counts = ("n_rows", "n_missing", "n_valid", "n_numeric", "n_matching", "n_kept", "n_remaining", "n_missing_preserved")
    rules = collapse_record(spark, sf_dir)["reports"]["rules"]
    rows = [(rule["column_name"], rule["rule"], *[rule[name] for name in counts]) for rule in rules]
    return spark.createDataFrame(rows, "column_name string, rule string, " + ", ".join(f"{name} long" for name in counts))


@query(
    f"""{WITH_GENES_SQL}, cells as (select 'INFO[''TEXT_AF'']' as column_name, {q(TEXT_AF)} as value from named
      union all select 'INFO[''DP'']', cast({q(DEPTH)} as varchar) from named),
    counts as (select column_name, value, count(*) as n_rows from cells where value is not null group by all)
    select * from (select column_name, row_number() over (partition by column_name order by n_rows desc, value) as rank, value, n_rows
      from counts) where rank <= 10"""
)
def collapse_value_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most frequent values of each column that a rule tests."""
    values = collapse_record(spark, sf_dir)["reports"]["values"]
    rows = [(entry["column_name"], entry["rank"], entry["value"], entry["n_rows"]) for entry in values]
    return spark.createDataFrame(rows, "column_name string, rank int, value string, n_rows long")


@query(
    f"""{WITH_GENES_SQL}, kept as (select * from named where {RARE} and {DEEP}),
    groups as (select distinct {listed(COLLAPSE_KEYS)} from kept where {KEYS_GIVEN}),
    duplicates as (select {listed(UNIQUE_KEYS)} from groups group by all having count(*) > 1),
    clean as (select count(*) as n from groups g where not exists (select 1 from duplicates d where {same_key('d', 'g')}))
    select (select count(*) from variants) as original, (select count(*) from named) as with_genes,
      round(100.0 - (select count(*) from named) * 100.0 / (select count(*) from variants), 6) as pct_without_genes,
      (select count(*) from kept) as filtered, n as collapsed,
      round(100.0 - n * 100.0 / (select count(*) from variants), 6) as pct_reduction from clean"""
)
def collapse_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows before, after the gene list, after the rules and at the end, with the shares removed."""
    record = collapse_record(spark, sf_dir)
    genes, whole = record["reports"]["genes"], record["reports"]["reduction"]
    row = (
        genes["n_original"], genes["n_kept"], round(genes["pct_removed"], 6), record["filtered_rows"], record["final_rows"],
        round(whole["pct_removed"], 6),
    )
    return spark.createDataFrame(
        [row], "original long, with_genes long, pct_without_genes double, filtered long, collapsed long, pct_reduction double"
    )


@query(
    """, datasets as (select distinct CHROM, POS, "REF", "ALT" from variants),
    counts as (select CHROM, POS, "ALT", count(*) as n from datasets group by all),
    below as (select * from counts where n < 3)
    select 'before' as label, count(*) as n_variants from counts union all select 'below 3', count(*) from below
    union all select concat('of ', n, ' rows'), count(*) from below group by n"""
)
def cohort_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants before and after a cutoff, and how many combine how many rows."""
    output = scratch_path(spark, "cohort")
    run_cohort(spark, stored_families(spark, sf_dir), output, cutoff=3)
    record = read_sidecar(spark, output)
    cut = record["cutoff"]
    rows = [("before", cut["n_variants"]), (f"below {cut['below']}", cut["n_retained"])]
    rows += [(f"of {n} rows", count) for n, count in record["variants_by_row_count"].items()]
    return spark.createDataFrame(rows, "label string, n_variants long")


PLACE_SQL = "concat(CHROM, ':', POS, ':', \"REF\", ':', \"ALT\")"
CRITERIA_SQL = {"in_region": REGION_SQL, "in_genes": GENE_SQL, "in_rsids": RSID_SQL}


@query(
    ", tested as (select *, " + ", ".join(f"{test} as {name}" for name, test in CRITERIA_SQL.items()) + " from variants) "
    + " union all ".join(
        f"""select '{name}' as criterion, count_if({name}) as n_rows, min({PLACE_SQL}) filter (where {name}) as first_kept,
        max({PLACE_SQL}) filter (where {name}) as last_kept, min({PLACE_SQL}) filter (where not {name}) as first_left_out,
        max({PLACE_SQL}) filter (where not {name}) as last_left_out from tested"""
        for name in CRITERIA_SQL
    )
    + " union all select 'any', count(*), null, null, null, null from tested where in_region or in_genes or in_rsids"
    + " union all select 'all', count(*), null, null, null, null from tested"
)
def narrow_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that meet each criterion of the narrowing job, and examples of rows that do and that do not."""
    dataset, output = scratch_path(spark, "wide"), scratch_path(spark, "narrow")
    write_dataset(with_cells(variants(spark, sf_dir), ["SAMPLE", *SITE_KEYS, "ID"], [SYMBOL]), dataset)
    names = spark.createDataFrame([(name,) for name in GENES], "Symbol string").withColumn("RSID", F.lit(None).cast("string"))
    ids = urgent_rsids(spark, sf_dir).select(F.lit(None).cast("string").alias("Symbol"), F.col("rsid").alias("RSID"))
    spans = regions(spark, sf_dir).selectExpr("concat('chr', chrom)", "start", "`end`")
    config = PipelineConfig({"ADDITIONAL_ZARR_FILTERING": {
        "GENE_FILTER": written(names.unionByName(ids), "genes"), "BED_FILE": written(spans, "bed", header=False),
    }})
    run_narrow(spark, dataset, config, output)
    counts = read_sidecar(spark, output)["reports"]["criteria"]
    ends = ("first_kept", "last_kept", "first_left_out", "last_left_out")
    rows = [(name, counts[f"n_{name}"], *[counts[f"{end}_{name}"] for end in ends]) for name in CRITERIA_SQL]
    rows += [("any", counts["n_any"], None, None, None, None), ("all", counts["n_rows"], None, None, None, None)]
    return spark.createDataFrame(rows, "criterion string, n_rows long, " + ", ".join(f"{end} string" for end in ends))

"""The four jobs a user runs: ingest, collapse, cohort and narrow."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variantry.config import PipelineConfig
from variantry.functions.predicates import apply_rules, present_rules
from variantry.functions.schema import coerce_types, drop_columns, fixed_types, rename_columns, resolve, with_provenance
from variantry.names import COLLAPSE_KEYS, ROW_COUNT, ROW_ORDER, SITE_KEYS, SOURCE_DATASET
from variantry.operators import report
from variantry.operators.cohort import check_cutoff, cohort, row_counts, union_aligned
from variantry.operators.collapse import available_keys, collapse
from variantry.operators.gather import with_row_order
from variantry.operators.membership import Listing, criteria, keep_any, match_genes
from variantry.operators.validate import (
    group_rows,
    quarantine,
    require_dataset_uniqueness,
    require_families,
    require_unique,
    uniqueness_keys,
)
from variantry.sinks import export_tsv, value_types, write_dataset, write_sidecar
from variantry.sources.files import base_name, stem
from variantry.sources.lists import read_genes_and_rsids, read_regions
from variantry.sources.tables import (
    check_inputs,
    number_datasets,
    read_dataset,
    read_datasets,
    read_delimited,
    read_sidecar,
)
from variantry.sources.vcf import read_vcf


TEXT_FILES, VCF_FILES = (".tsv",), (".vcf", ".vcf.gz", ".vcf.bgz")


def ingest(
    spark: SparkSession,
    inputs: list[str],
    output: str,
    dtypes: dict[str, str] | None = None,
    renames: dict[str, str] | None = None,
) -> dict:
    """Type annotation TSV and VCF files and store them as one dataset, partitioned by family.

    Every row has the family and name of its file. Files of one kind with the same header share one scan. Columns that a
    file lacks are null in its rows; a column that has numbers in one kind of file and text in another is text.
    """
    check_inputs(spark, inputs, TEXT_FILES + VCF_FILES)
    texts, calls = ([path for path in inputs if path.endswith(kinds)] for kinds in (TEXT_FILES, VCF_FILES))
    tables = [read_delimited(spark, texts, provenance=True)] if texts else []
    tables += [read_vcf(spark, calls, provenance=True)] if calls else []
    # The row order is no text and must stay as it is.
    declared = {name: kind for name, kind in (dtypes or {}).items() if name != ROW_ORDER}
    typed = [fixed_types(coerce_types(rename_columns(table, renames or {}), declared), declared) for table in tables]
    return write_dataset(union_aligned(typed), output, {"source_files": inputs}, partition_by=["family"])


def ingest_table(df: DataFrame, path: str, output: str, dtypes: dict[str, str] | None = None) -> dict:
    """Store one table, such as a flattened VCF, under the family its path names."""
    typed = coerce_types(df, {name: kind for name, kind in (dtypes or {}).items() if name != ROW_ORDER})
    named = with_provenance(typed, base_name(path).split(".")[0], base_name(path))
    return write_dataset(named, output, {"source_files": [path], "family": base_name(path).split(".")[0]})


@dataclass(frozen=True)
class Collapsed:
    """The stages of a collapse, all lazy."""

    filtered: DataFrame
    result: DataFrame
    group_keys: list[str]


def filter_and_collapse(
    df: DataFrame,
    config: PipelineConfig,
    genes: Listing | None = None,
    source: str | None = None,
    order: str = "first",
) -> Collapsed:
    """Genes, then rules, then column drops, then one row per sample and variant.

    Rows of several files collapse side by side: a `filename` column, if there is one,
    joins the keys and names the source dataset.
    """
    # Numbered while still in the scan: after a shuffle, rows that are computed again
    # for a lost executor could get other numbers.
    df = with_row_order(df) if order == "first" else df
    rows = apply_rules(match_genes(df, genes), config.rules)
    rows = drop_columns(rows, config.drop_columns)
    keys = available_keys(rows, COLLAPSE_KEYS)
    named_by = None if source is None else F.lit(source)
    if "filename" in rows.columns:
        keys = [*keys, "filename"]
        if source is None:
            named_by = F.regexp_replace("filename", r"\.[^.]*$", "")
    return Collapsed(rows, collapse(rows, keys, named_by, order=order), keys)


def run_collapse(
    spark: SparkSession,
    dataset: str,
    config: PipelineConfig,
    output: str | None = None,
    genes: Listing | None = None,
    remove_validation_errors: bool = False,
    quarantine_path: str | None = None,
    tsv: str | None = None,
) -> str:
    """Filter and collapse a stored dataset, check its keys and store the result."""
    output = output or f"{dataset.rstrip('/').rsplit('/', 1)[0]}/{stem(dataset)}_filtered_pivoted"
    df = read_dataset(spark, dataset)
    source = None if "filename" in df.columns else stem(dataset)
    stages = filter_and_collapse(df, config, genes, source)
    clean = stages.result
    keys = uniqueness_keys(clean, stages.group_keys)
    if remove_validation_errors:
        clean, bad = quarantine(stages.result, stages.filtered, stages.group_keys)
        export_tsv(bad, quarantine_path or f"logs/validation_errors_{stem(dataset)}.tsv")
    elif keys:
        # Key columns alone decide this, so it costs little and fails before any output.
        require_unique(group_rows(stages.filtered, stages.group_keys), keys)
    final = write_dataset(clean, output)["final_shape"][0]
    written = spark.read.parquet(output)
    if remove_validation_errors and keys:
        require_unique(written, keys)
    filtering = filter_report(df, config, genes)
    record = {
        "processing_type": "filtered_and_pivoted",
        "original_file": dataset,
        "original_rows": filtering["genes"]["n_original"],
        "filtered_rows": filtering["filtered_rows"],
        "final_rows": final,
        "reports": {**filtering, "reduction": _removed(filtering["genes"]["n_original"], final)},
        "filters_applied": [f"{rule.column} {rule.operator}:{rule.value}" for rule in config.rules],
        "columns_kept": clean.columns,
        "value_types": value_types(written, {field.name: field.dataType for field in df.schema}),
    }
    _amend(spark, output, record)
    if tsv:
        export_tsv(read_dataset(spark, output), tsv, sort_by=stages.group_keys)
    return output


def _removed(before: int, after: int) -> dict:
    """What `report.kept_report` says, from counts that are known."""
    share = (before - after) * 100.0 / before if before else 0.0
    return {"n_original": before, "n_kept": after, "n_removed": before - after, "pct_removed": share}


def filter_report(df: DataFrame, config: PipelineConfig, genes: Listing | None = None) -> dict:
    """What genes and rules do to a stored table: rows before and after genes, counts and frequent values per rule.

    All rules are counted in one pass over the columns that they and the genes name; the rows of the table itself are
    counted from its files. Values are those after the genes and before the rules.
    """
    rows, rules = match_genes(df, genes), present_rules(df, config.rules)
    original = df.count()
    entries = [row.asDict() for row in report.filter_diagnostics(rows, rules).collect()] if rules else []
    if entries:
        left, filtered = entries[0]["n_rows"], entries[-1]["n_remaining"]
    else:
        left = filtered = original if rows is df else rows.count()
    names = list(dict.fromkeys(resolve(df, rule.column) for rule in rules))
    values = report.value_profiles(rows, names).orderBy("column_name", "rank").collect() if names else []
    return {
        "genes": _removed(original, left),
        "rules": entries,
        "filtered_rows": filtered,
        "values": [row.asDict() for row in values],
    }


def _amend(spark: SparkSession, path: str, record: dict) -> None:
    write_sidecar(spark, path, {**read_sidecar(spark, path), **record})


def combine(
    df: DataFrame,
    names: list[str],
    genes: Listing | None = None,
    columns: str = "default",
    row_count_only: bool = False,
    cutoff: int | None = None,
    check: bool = True,
) -> DataFrame:
    """Check numbered datasets and combine them into one row per variant."""
    check_cutoff(cutoff, len(names))
    if check:
        require_dataset_uniqueness(df, names)
    rows = match_genes(with_row_order(df), genes)
    families = require_families(rows, names)
    return cohort(rows, columns, row_count_only, cutoff, families, unique=check)


def _by_row_count(variants: DataFrame) -> DataFrame:
    """How many variants combine how many rows: at most one row per number of datasets."""
    return variants.groupBy(ROW_COUNT).agg(F.count(F.lit(1)).alias("n_variants")).orderBy(ROW_COUNT)


def run_cohort(
    spark: SparkSession,
    datasets: list[str],
    output: str,
    genes: Listing | None = None,
    columns: str = "default",
    row_count_only: bool = False,
    cutoff: int | None = None,
    tsv: str | None = None,
) -> str:
    """Combine collapsed datasets and store the cohort.

    A single dataset may hold the collapsed rows of many files; each file then counts as
    a dataset.
    """
    if len(datasets) == 1 and SOURCE_DATASET in read_dataset(spark, datasets[0]).columns:
        df, names = number_datasets(read_dataset(spark, datasets[0]))
    else:
        df, names = read_datasets(spark, datasets)
    result = combine(df, names, genes, columns, row_count_only, cutoff)
    total = write_dataset(result, output, cluster_by=["CHROM", "POS"])["final_shape"][0]
    record = {
        "processing_type": "cross_file_aggregated",
        "pivot_columns": SITE_KEYS,
        "total_variants": total,
        "source_datasets": len(names),
        "variants_by_row_count": {row[0]: row[1] for row in _by_row_count(spark.read.parquet(output)).collect()},
    }
    if cutoff is not None:
        # Only the key columns are read for what the cutoff left out.
        counts = row_counts(match_genes(df, genes), SITE_KEYS)
        record["cutoff"] = {"below": cutoff, **report.cohort_totals(counts, cutoff).first().asDict()}
    _amend(spark, output, record)
    if tsv:
        export_tsv(read_dataset(spark, output), tsv, sort_by=SITE_KEYS)
    return output


def run_narrow(
    spark: SparkSession,
    dataset: str,
    config: PipelineConfig,
    output: str | None = None,
    tsv: str | None = None,
) -> str:
    """Keep the rows with a listed gene or rsID or in a listed region, and store them."""
    output = output or f"{config.output_dir or 'data/additional_filtering'}/{stem(dataset)}_add_filter"
    genes = rsids = regions = None
    if config.gene_filter:
        genes, rsids = read_genes_and_rsids(spark, config.gene_filter)
    if config.bed_file:
        regions = read_regions(spark, config.bed_file)
    if genes is None and rsids is None and regions is None:
        warnings.warn("no genes, rsIDs or regions configured, all rows are kept", stacklevel=2)
    df = read_dataset(spark, dataset)
    marked, flags = criteria(df, genes, rsids, regions)
    seen = report.CriteriaReport(marked, list(flags), [key for key in SITE_KEYS if key in df.columns]) if flags else None
    kept = drop_columns(keep_any(marked if seen is None else seen.rows, flags), config.narrow_drop_columns)
    before, after = df.count(), write_dataset(kept, output)["final_shape"][0]
    _amend(
        spark, output,
        {
            "processing_type": "gene_filtered",
            "original_file": dataset,
            "original_rows": before,
            "filtered_rows": after,
            "reports": {**_removed(before, after), "criteria": {} if seen is None else seen.result(before, after)},
            "gene_filter_count": 0 if genes is None else genes.count(),
            "rsid_filter_count": 0 if rsids is None else rsids.count(),
            "bed_region_count": 0 if regions is None else regions.count(),
        },
    )
    if tsv:
        export_tsv(read_dataset(spark, output), tsv, first=config.column_order_start)
    return output


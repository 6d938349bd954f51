"""Jobs and files as queries: tables are written from the driver's tables, go through a job, and are read again."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variantry.config import PipelineConfig
from variantry.functions.text import col
from variantry.names import COLLAPSE_KEYS, ROW_ORDER, SITE_KEYS, SOURCE_DATASET, UNIQUE_KEYS
from variantry.operators import report, validate
from variantry.operators.collapse import collapse
from variantry.plans.catalogue import (
    AF,
    COLLAPSED_SQL,
    DEPTH,
    DUPLICATES_SQL,
    IMPACT,
    KEYS_GIVEN,
    MAX_AF,
    RARE_SQL,
    REGION_SQL,
    SAOBS,
    STORED_COHORT_SQL,
    SYMBOL,
    TEXT_AF,
    first_cells,
    list_text,
    listed,
    q,
    query,
    same_key,
    sorted_cell,
    stored_families,
    with_cells,
    written,
)
from variantry.plans.driver_tables import FAMILIES, regions, table, variants
from variantry.plans.pipeline import run_cohort, run_collapse, run_narrow
from variantry.session import scratch_path
from variantry.sinks import as_text, value_types, write_dataset
from variantry.sources.tables import read_dataset, read_datasets, read_delimited, read_path_list
from variantry.sources.vcf import read_vcf

# --- the jobs --------------------------------------------------------------------------

RARE_CLEAN_SQL = f""", kept as (select * from variants where {RARE_SQL}),
    collapsed as (select distinct {listed(COLLAPSE_KEYS)} from kept where {KEYS_GIVEN}),
    duplicates as (select {listed(UNIQUE_KEYS)} from collapsed group by {listed(UNIQUE_KEYS)} having count(*) > 1),
    clean as (select * from kept v where {KEYS_GIVEN} and not exists (select 1 from duplicates d where {same_key('d', 'v')}))"""


def collapsed_by_job(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Where the collapse job stored its result, and the rows it set aside."""
    dataset, output, errors = (scratch_path(spark, label) for label in ("typed", "collapsed", "errors"))
    write_dataset(with_cells(variants(spark, sf_dir), COLLAPSE_KEYS, [IMPACT, SYMBOL, MAX_AF], order=True), dataset)
    config = PipelineConfig({"FILTERS": {MAX_AF: "<=:0.05"}, "COLUMN_MANAGEMENT": {"drop_columns": [MAX_AF]}})
    run_collapse(spark, dataset, config, output, remove_validation_errors=True, quarantine_path=errors)
    return output, errors


@query(RARE_CLEAN_SQL + " " + first_cells(COLLAPSE_KEYS, [IMPACT, SYMBOL], "clean"))
def collapse_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_dataset(spark, collapsed_by_job(spark, sf_dir)[0]).drop(SOURCE_DATASET, ROW_ORDER)


@query(
    f"""{RARE_CLEAN_SQL} select distinct {listed([key for key in COLLAPSE_KEYS if key != SAOBS])},
    coalesce({q(SAOBS)}, '.') as {q(SAOBS)}, {listed([IMPACT, SYMBOL])} from kept v
    where exists (select 1 from duplicates d where {same_key('d', 'v')})"""
)
def quarantine_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text file of the rows that the collapse job set aside."""
    rows = read_delimited(spark, collapsed_by_job(spark, sf_dir)[1]).drop(ROW_ORDER)
    return rows.withColumn("POS", F.col("POS").cast("bigint"))


@query(STORED_COHORT_SQL)
def cohort_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    output = scratch_path(spark, "cohort")
    run_cohort(spark, stored_families(spark, sf_dir), output)
    return list_text(read_dataset(spark, output), ["family"])


@query(
    f"""select SAMPLE, CHROM, POS, {listed([SYMBOL])} from variants where {REGION_SQL} or list_has_any(
    string_split({q(SYMBOL)}, ';'), (select list(p_brand) from part where p_brand like 'Brand#1%' and p_size < 10))"""
)
def narrow_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gene list and a BED file, either of which keeps a row."""
    dataset, output = scratch_path(spark, "wide"), scratch_path(spark, "narrow")
    write_dataset(with_cells(variants(spark, sf_dir), ["SAMPLE", "CHROM", "POS"], [SYMBOL, IMPACT]), dataset)
    brands = table(spark, sf_dir, "part").where("p_brand like 'Brand#1%' and p_size < 10").selectExpr("p_brand as Symbol")
    spans = regions(spark, sf_dir).selectExpr("concat('chr', chrom)", "start", "`end`")
    config = PipelineConfig({"ADDITIONAL_ZARR_FILTERING": {
        "GENE_FILTER": written(brands, "genes"), "BED_FILE": written(spans, "bed", header=False), "DROP_COLUMNS": [IMPACT],
    }})
    run_narrow(spark, dataset, config, output)
    return read_dataset(spark, output)


# --- VCF files -------------------------------------------------------------------------

FILE_HEADER = [
    '##INFO=<ID=DP,Number=1,Type=Integer,Description="Depth">',
    '##INFO=<ID=AF,Number=1,Type=Float,Description="Frequency">',
    '##INFO=<ID=LST,Number=.,Type=Integer,Description="A list">',
    "##INFO=<ID=ANN,Number=.,Type=String,Description=\"Functional annotations: 'Allele | Gene_Name'\">",
    '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
]


@query(
    """select concat('F', s_nationkey, side) as "SAMPLE", concat('chr', l_partkey % 22 + 1) as "CHROM", l_partkey as "POS", 'A' as "REF",
      'T' as "ALT", l_quantity as "QUAL", '[]' as "FILTER", cast(null as varchar) as "ID", l_linenumber as "INFO['DP']",
      cast(cast(l_tax as float) as double) as "INFO['AF']", concat('(', l_suppkey, ',)') as "INFO['LST']",
      case side when '_L' then '(0, 1)' else '(1, 1)' end as "FORMAT['GT']", 'T' as "ANN['Allele']", concat('g', l_suppkey) as "ANN['Gene_Name']"
    from lineitem join supplier on l_suppkey = s_suppkey, (values ('_L'), ('_R')) sides(side)"""
)
def vcf_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file per nation, each with samples of its own, written as text and read in one scan."""
    families = table(spark, sf_dir, "nation").selectExpr("concat('F', n_nationkey) as family")
    columns = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT"
    fixed = families.select("family", F.posexplode(F.array(*[F.lit(line) for line in FILE_HEADER])).alias("place", "value"))
    named = families.select(
        "family", F.lit(len(FILE_HEADER)).alias("place"),
        F.concat(F.lit(columns + "\t"), "family", F.lit("_L\t"), "family", F.lit("_R")).alias("value"),
    )
    records = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    ).selectExpr(
        "concat('F', s_nationkey) as family", f"{len(FILE_HEADER) + 1} as place",
        """concat_ws('\t', concat('chr', l_partkey % 22 + 1), l_partkey, '.', 'A', 'T', l_quantity, '.',
          concat('DP=', l_linenumber, ';AF=', l_tax, ';LST=', l_suppkey, ';ANN=T|g', l_suppkey), 'GT', '0/1', '1/1') as value""",
    )
    path = scratch_path(spark, "vcf")
    lines = fixed.union(named).union(records).repartition("family").sortWithinPartitions("family", "place")
    lines.drop("place").write.partitionBy("family").text(path)
    return read_vcf(spark, [f"{path}/family={name}" for name in FAMILIES]).drop(ROW_ORDER)


# --- lists of datasets -----------------------------------------------------------------

FAMILY_ROWS_SQL = (
    "select {family} as family, count(*) as n_rows from (select distinct CHROM, POS, \"REF\", \"ALT\" from variants) group by all"
)
BY_REF_SQL = FAMILY_ROWS_SQL.format(family='"REF"')


def family_rows(df: DataFrame) -> DataFrame:
    return df.groupBy("family").agg(F.count(F.lit(1)).alias("n_rows"))


@query(BY_REF_SQL)
def list_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths in a text file, with a comment, an empty line and a path that is not there."""
    lines = ["# datasets", "", *stored_families(spark, sf_dir), scratch_path(spark, "absent")]
    path = scratch_path(spark, "list")
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(path)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", UserWarning)
        return family_rows(read_datasets(spark, read_path_list(spark, path))[0])


@query(BY_REF_SQL)
def bad_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths without a readable dataset are left out with a warning."""
    text = written(table(spark, sf_dir, "nation"), "text")
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", UserWarning)
        paths = [text, *stored_families(spark, sf_dir), scratch_path(spark, "absent")]
        return family_rows(read_datasets(spark, paths)[0])


@query(FAMILY_ROWS_SQL.format(family="case \"REF\" when 'A' then '1' when 'N' then '2' else '3' end"))
def default_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Datasets without a family are named by their position."""
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", UserWarning)
        return family_rows(read_datasets(spark, stored_families(spark, sf_dir, named=False))[0])


# --- checks and exports ----------------------------------------------------------------


@query(
    f"{DUPLICATES_SQL} select {listed(COLLAPSE_KEYS)}, {sorted_cell(IMPACT)}, {sorted_cell(DEPTH)} from variants v "
    f"where {KEYS_GIVEN} and exists (select 1 from duplicates d where {same_key('d', 'v')}) group by {listed(COLLAPSE_KEYS)}"
)
def duplicated_collapsed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    collapsed = collapse(with_cells(variants(spark, sf_dir), COLLAPSE_KEYS, [IMPACT, DEPTH]), order="sorted")
    return validate.rows_of(collapsed, validate.duplicate_keys(collapsed, UNIQUE_KEYS), UNIQUE_KEYS)


SHOWN_SQL = ", ' ', ".join(f"'{key}=', {q(key)}" for key in UNIQUE_KEYS)


@query(
    f"""{COLLAPSED_SQL}, counts as (select {listed(UNIQUE_KEYS)}, count(*) as n from collapsed group by {listed(UNIQUE_KEYS)}),
    shown as (select *, row_number() over (order by {listed(UNIQUE_KEYS)}) as place from counts where n > 1)
    select 0 as position, concat(count_if(n > 1), ' keys have several rows: expected ', count(*), ' rows, found ', sum(n)) as line from counts
    union all select place, concat('  - ', {SHOWN_SQL}, ' (', n, ' rows)') from shown where place <= {validate.PREVIEW}
    union all select {validate.PREVIEW} + 1, concat('  ... and ', max(place) - {validate.PREVIEW}, ' more') from shown having max(place) > {validate.PREVIEW}"""
)
def strict_error_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the error that ends a job whose keys are not unique."""
    lines: list[str] = []
    try:
        validate.require_unique(validate.group_rows(variants(spark, sf_dir), COLLAPSE_KEYS), UNIQUE_KEYS)
    except validate.ValidationError as error:
        lines = str(error).split("\n")
    return spark.createDataFrame(list(enumerate(lines)), "position int, line string")


@query(
    f"select {q(IMPACT)} = 'HIGH' as high, least(count(*), 3) as n_rows from variants group by all"
)
def criteria_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which rows serve as examples is left open, how many is not."""
    marked = variants(spark, sf_dir).select("SAMPLE", "POS", (col(IMPACT) == "HIGH").alias("high"))
    return report.examples(marked, "high").groupBy("high").agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    f"""select CHROM, cast(POS as varchar) as "POS", case count(distinct SAMPLE) when 1 then min(SAMPLE)
    else concat('[''', string_agg(distinct SAMPLE, ''', ''' order by SAMPLE), ''']') end as samples
    from variants group by CHROM, POS"""
)
def array_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists in brackets, a list of one value as the value."""
    sites = variants(spark, sf_dir).groupBy("CHROM", "POS").agg(F.sort_array(F.collect_set("SAMPLE")).alias("samples"))
    return as_text(sites, "brackets")


@query(
    " union all ".join(
        f"select '{name.replace(chr(39), chr(39) * 2)}' as name, 'double' as kind from variants "
        f"having count_if({q(name)} is not null and try_cast({q(name)} as double) is null) = 0"
        for name in (AF, TEXT_AF)
    )
)
def stored_value_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which text columns hold nothing but numbers and get that type back when read."""
    path = scratch_path(spark, "texts")
    rows = variants(spark, sf_dir).select(*SITE_KEYS, col(AF), col(TEXT_AF))
    rows.select(*SITE_KEYS, col(AF).cast("string").alias(AF), col(TEXT_AF)).write.parquet(path)
    numbers = {name: rows.schema[AF].dataType for name in (AF, TEXT_AF)}
    return spark.createDataFrame(list(value_types(spark.read.parquet(path), numbers).items()), "name string, kind string")

"""Files of many kinds and lists of partitioned datasets as queries: written from the driver's tables and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from variantry.config import ConfigError, PipelineConfig
from variantry.functions.predicates import apply_rules
from variantry.functions.schema import coerce_types, drop_columns, rename_columns
from variantry.functions.text import col
from variantry.names import DATASET_INDEX, ROW_ORDER, SITE_KEYS, SOURCE_DATASET
from variantry.operators.membership import match_regions
from variantry.plans.catalogue import AF, IMPACT, MAX_AF, REGION_SQL, SYMBOL, q, query
from variantry.plans.driver_tables import regions, table, variants
from variantry.plans.pipeline import ingest
from variantry.session import scratch_path
from variantry.sinks import export_tsv, write_dataset
from variantry.sources.lists import read_dtypes, read_renames
from variantry.sources.tables import read_dataset, read_datasets, read_delimited

# --- lists of partitioned datasets -----------------------------------------------------

#: A folder name has to escape some of these characters.
ODD_FAMILY = "nullif(concat(family, '/+ é%='), 'F3/+ é%=')"


@query(
    f"""select cast(substr(SAMPLE, 2) as int) as dataset, {ODD_FAMILY} as family, count(*) as n_rows, cast(sum(POS) as bigint) as places,
    max({q(AF)}) as top from variants group by all"""
)
def partitioned_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dataset per sample, each in folders by family, as one table."""
    paths = []
    for i in range(4):
        rows = variants(spark, sf_dir).where(F.col("SAMPLE") == f"S{i}")
        path = scratch_path(spark, f"sample_{i}")
        write_dataset(rows.select("CHROM", "POS", "REF", "ALT", col(AF), F.expr(ODD_FAMILY).alias("family"),
                                  F.lit(f"S{i}").alias("SOURCE_DATASET")), path, partition_by=["family"])
        paths.append(path)
    df, _ = read_datasets(spark, paths)
    return df.groupBy(F.col(DATASET_INDEX).alias("dataset"), "family").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("POS").alias("places"), F.max(col(AF)).alias("top")
    )


# --- files of both kinds in one job ----------------------------------------------------

HEADER = [
    '##INFO=<ID=DP,Number=1,Type=Integer,Description="Depth">',
    "##INFO=<ID=ANN,Number=.,Type=String,Description=\"Functional annotations: 'Allele | Gene_Name'\">",
    '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
]
LINES_OF_REGION = (
    "lineitem join supplier on l_suppkey = s_suppkey join nation on s_nationkey = n_nationkey where n_regionkey {test}"
)


@query(
    f"""select concat('R', n_regionkey) as family, concat('R', n_regionkey, '.lines.vcf') as filename,
      concat('R', n_regionkey, side) as "SAMPLE", concat('chr', l_partkey % 22 + 1) as "CHROM", l_partkey as "POS", 'A' as "REF",
      'T' as "ALT", l_quantity as "QUAL", '[]' as "FILTER", cast(null as varchar) as "ID", l_linenumber as "INFO['DP']",
      case side when '_L' then '(0, 1)' else '(1, 1)' end as "FORMAT['GT']", 'T' as "ANN['Allele']",
      concat('g', l_suppkey) as "ANN['Gene_Name']"
    from (select * from {LINES_OF_REGION.format(test='< 3')}), (values ('_L'), ('_R')) sides(side)
    union all select concat('R', n_regionkey), concat('R', n_regionkey, '.lines.tsv'), concat('R', n_regionkey, '_S'),
      concat('chr', l_partkey % 22 + 1), l_partkey, 'A', 'T', null, null, null, l_linenumber, null, null, concat('g', l_suppkey)
    from {LINES_OF_REGION.format(test='>= 3')}"""
)
def batch_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """VCF files with samples of their own and TSV files through one job; each row knows its family and file."""
    lines = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    lines = lines.join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    folder, inputs = scratch_path(spark, "inputs"), []
    for region in range(5):
        rows = lines.where(F.col("n_regionkey") == region)
        kind = "vcf" if region < 3 else "tsv"
        inputs.append(f"{folder}/R{region}.lines.{kind}")
        if kind == "vcf":
            columns = f"#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tR{region}_L\tR{region}_R"
            head = spark.createDataFrame([("\n".join([*HEADER, columns]),)], "value string")
            records = rows.selectExpr(
                """concat_ws('\t', concat('chr', l_partkey % 22 + 1), l_partkey, '.', 'A', 'T', l_quantity, '.',
                  concat('DP=', l_linenumber, ';ANN=T|g', l_suppkey), 'GT', '0/1', '1/1') as value"""
            )
            head.coalesce(1).union(records).write.text(inputs[-1])
        else:
            rows.selectExpr(
                f"'R{region}_S' as SAMPLE", "concat('chr', l_partkey % 22 + 1) as CHROM", "l_partkey as POS", "'A' as REF", "'T' as ALT",
                "l_linenumber as `INFO['DP']`", "concat('g', l_suppkey) as `ANN['Gene_Name']`",
            ).write.csv(inputs[-1], sep="\t", header=True)
    output = scratch_path(spark, "ingested")
    ingest(spark, inputs, output, {"POS": "int64", "INFO['DP']": "int64"})
    return read_dataset(spark, output).drop(ROW_ORDER)


# --- files that a user brings ----------------------------------------------------------


def text_file(spark: SparkSession, label: str, lines: list[str]) -> str:
    path = scratch_path(spark, label)
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)
    return path


@query(
    """select l_orderkey, cast(l_quantity as bigint) as "QTY", l_tax as tax, l_returnflag = 'A' as flagged, l_linestatus as status
    from lineitem"""
)
def dtype_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types from a file, for columns that were read as text."""
    lines = ["column_name,dtype", "l_orderkey,int64", "QTY,int64", "tax,float64", "flagged,bool", "absent,int64", "status,"]
    rows = table(spark, sf_dir, "lineitem").selectExpr(
        "cast(l_orderkey as string) as l_orderkey", "cast(l_quantity as string) as QTY", "cast(l_tax as string) as tax",
        "if(l_returnflag = 'A', 'True', 'no') as flagged", "l_linestatus as status",
    )
    return coerce_types(rows, read_dtypes(text_file(spark, "dtypes", lines)))


@query('select c_custkey as "key", c_name as "Full name", c_nationkey from customer')
def rename_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New names from a file; names of columns that are not there are ignored."""
    path = text_file(spark, "renames", ["c_custkey,key", "c_name,Full name", "absent,x", "c_nationkey", "a,b,c"])
    return rename_columns(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey"), read_renames(path))


@query(
    f"""select SAMPLE, POS, {q(MAX_AF)}, {q(IMPACT)} from variants
    where ({q(MAX_AF)} <= 0.05 or {q(MAX_AF)} is null) and {q(IMPACT)} <> 'LOW'"""
)
def yaml_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and dropped columns from a YAML file."""
    lines = ["FILTERS:", f'  "{MAX_AF}": "<=:0.05"', f'  "{IMPACT}":', "    operator: '!='", "    value: LOW",
             "COLUMN_MANAGEMENT:", "  drop_columns: CHROM, absent"]
    config = PipelineConfig.from_yaml(text_file(spark, "config", lines))
    rows = variants(spark, sf_dir).select("SAMPLE", "CHROM", "POS", col(MAX_AF), col(IMPACT))
    return drop_columns(apply_rules(rows, config.rules), config.drop_columns)


@query("select r_name as name, concat('unknown operator ''', r_name, ''' for column ''depth''') as message from region")
def unknown_operator(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the rules of a YAML file say that name no operator."""
    names = [row[0] for row in table(spark, sf_dir, "region").select("r_name").collect()]
    found = []
    for name in names:
        config = PipelineConfig.from_yaml(text_file(spark, "rules", ["FILTERS:", f"  depth: '{name}:1'"]))
        try:
            found.append((name, str(config.rules)))
        except ConfigError as error:
            found.append((name, str(error)))
    return spark.createDataFrame(found, "name string, message string")


# --- regions over a dataset in order of position -----------------------------------------


@query(f"select CHROM, POS, \"REF\", \"ALT\", count(*) as n_rows from variants where {REGION_SQL} group by all")
def region_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions over a stored table that is laid out by chromosome and position: what lies apart from them is not read."""
    path = scratch_path(spark, "clustered")
    counts = variants(spark, sf_dir).groupBy(*SITE_KEYS).agg(F.count(F.lit(1)).alias("n_rows"))
    write_dataset(counts, path, cluster_by=["CHROM", "POS"])
    return match_regions(read_dataset(spark, path), regions(spark, sf_dir))


# --- order of exports ------------------------------------------------------------------


@query(
    """select CHROM, POS, "REF", "ALT", row_number() over (order by CHROM, POS, "REF", "ALT") as position
    from (select distinct CHROM, POS, "REF", "ALT" from variants)"""
)
def ordered_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a sorted export: files by name, then lines, give the order of the keys over all files."""
    path = scratch_path(spark, "sorted")
    export_tsv(variants(spark, sf_dir).select(*SITE_KEYS).distinct(), path, sort_by=SITE_KEYS)
    rows = spark.read.schema("CHROM string, POS bigint, REF string, ALT string").csv(path, sep="\t", header=True).select(
        "*", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    before = rows.groupBy("file").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("file").alias("file_of"), (F.sum("n").over(Window.orderBy("file")) - F.col("n")).alias("before")
    )
    placed = rows.withColumn("place", F.row_number().over(Window.partitionBy("file").orderBy("block", "line")))
    joined = placed.join(before, F.col("file") == F.col("file_of"))
    return joined.select(*SITE_KEYS, (F.col("before") + F.col("place")).alias("position"))


COLUMNS = ["SAMPLE", SYMBOL, "ALT", IMPACT, "CHROM", "FILENAME", "POS", "REF", "family"]


@query(
    "select position, name, n_rows from (values "
    + ", ".join(f"({i}, '{name.replace(chr(39), chr(39) * 2)}')" for i, name in enumerate(COLUMNS))
    + ") names(position, name), (select count(*) as n_rows from variants)"
)
def column_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header of an export: the columns asked for, then the others by name, the source dataset under its exported name."""
    path = scratch_path(spark, "columns")
    rows = variants(spark, sf_dir).select(*SITE_KEYS, "SAMPLE", "family", col(SYMBOL), col(IMPACT), F.lit("x").alias(SOURCE_DATASET))
    export_tsv(rows, path, first=["SAMPLE", SYMBOL, "absent"])
    read = read_delimited(spark, path)
    names = [name for name in read.columns if name != ROW_ORDER]
    entries = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(name).alias("name")) for i, name in enumerate(names)])
    counted = read.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.explode(entries).alias("entry"))
    return counted.select("entry.position", "entry.name", "n_rows")

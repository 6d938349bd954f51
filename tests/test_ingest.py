"""Many files in one job, and lists of partitioned datasets."""

import gzip
import time
import warnings

import pytest
from pyspark.sql import functions as F

from variantry.config import ConfigError, PipelineConfig
from variantry.functions.text import col
from variantry.names import DATASET_INDEX, ROW_ORDER
from variantry.plans.pipeline import ingest
from variantry.sinks import write_dataset
from variantry.sources.lists import read_dtypes, read_renames
from variantry.sources.tables import read_dataset, read_datasets, read_delimited
from variantry.sources.vcf import Field, flatten_vcf, header_lines, info_struct, info_value, parse_header, read_vcf

HEADER = [
    '##INFO=<ID=DP,Number=1,Type=Integer,Description="Depth">',
    '##INFO=<ID=FLAG,Number=0,Type=Flag,Description="A flag">',
    '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
]


def vcf(path, samples, records, zipped=False):
    columns = ["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *samples]
    lines = [*HEADER, "\t".join(columns)]
    lines += ["\t".join([chrom, str(pos), ".", "A", "T", "7", "PASS", info, "GT", *["0/1"] * len(samples)]) for chrom, pos, info in records]
    with gzip.open(path, "wt") if zipped else open(path, "w") as handle:
        handle.write("\n".join(lines) + "\n")
    return str(path)


def jobs_run(spark, group, action):
    spark.sparkContext.setJobGroup(group, group)
    result = action()
    ids = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return result, len(ids)


def test_batch_of_files(spark, tmp_path):
    files = [vcf(tmp_path / f"fam{i}.calls é+%.vcf", [f"s{i}a", f"s{i}b"], [("chr1", 10 * i + k, f"DP={k};FLAG") for k in range(3)]) for i in range(5)]
    files.append(vcf(tmp_path / "zip.calls.vcf.gz", ["z"], [("chr2", 5, "DP=9")], zipped=True))
    text = tmp_path / "tab.rows.tsv"
    text.write_text("SAMPLE\tCHROM\tPOS\tINFO['DP']\n t\tchr3\t7\t.\n")
    ingest(spark, [*files, str(text)], str(tmp_path / "out"), {"INFO['DP']": "int64"})
    rows = read_dataset(spark, str(tmp_path / "out"))
    got = {(r["family"], r["filename"], r["SAMPLE"], r["POS"], r["INFO['DP']"]) for r in rows.collect()}
    expected = {(f"fam{i}", f"fam{i}.calls é+%.vcf", f"s{i}{s}", 10 * i + k, k) for i in range(5) for k in range(3) for s in "ab"}
    assert got == expected | {("zip", "zip.calls.vcf.gz", "z", 5, 9), ("tab", "tab.rows.tsv", " t", 7, 0)}
    order = rows.where("family = 'fam3'").orderBy(ROW_ORDER).select("POS", "SAMPLE").collect()
    assert [tuple(r) for r in order] == [(30 + k, f"s3{s}") for k in range(3) for s in "ab"]


def test_headers_need_no_job(spark, tmp_path, plan_of):
    files = [vcf(tmp_path / f"f{i}.vcf", [f"s{i}"], [("1", i, "DP=1")]) for i in range(40)]
    df, jobs = jobs_run(spark, "headers", lambda: read_vcf(spark, files, provenance=True))
    # Spark lists many paths in one job; there is none per file.
    assert jobs <= 1 and plan_of(df).count("FileScan text") == 1
    assert {(r["family"], r["SAMPLE"], r["POS"]) for r in df.collect()} == {(f"f{i}", f"s{i}", i) for i in range(40)}
    long = tmp_path / "long.vcf"
    long.write_text("".join(f"##contig=<ID=c{i},{'x' * 90}>\n" for i in range(9_000)) + "#CHROM\tPOS\n")
    assert len(header_lines(spark, str(long))) == 9_001
    for name, content in (("none.vcf", "##a\nchr1\t5\n"), ("ended.vcf", "##a\n"), ("empty.vcf", "")):
        (tmp_path / name).write_text(content)
        with pytest.raises(ValueError, match="no #CHROM line"):
            header_lines(spark, str(tmp_path / name))


def test_wrong_inputs(spark, tmp_path):
    (tmp_path / "a.bed").write_text("x")
    with pytest.raises(ValueError, match="a.bed.*not found.*b.vcf"):
        ingest(spark, [str(tmp_path / "a.bed"), str(tmp_path / "b.vcf")], str(tmp_path / "out"))


def test_list_of_partitioned_datasets(spark, tmp_path, plan_of):
    paths = []
    for i in range(50):
        name = None if i == 7 else f"{i:03d}/ +é%="
        path = str(tmp_path / f"a=b {i}%20")
        df = spark.createDataFrame([(i, name, "x")] * 2, "v int, family string, SOURCE_DATASET string")
        df.coalesce(1).write.partitionBy("family").parquet(path) if i % 2 else write_dataset(df.coalesce(1), path, partition_by=["family"])
        paths.append(path)
    df, names = read_datasets(spark, paths)
    # Datasets of others name no column order, so these have a schema of their own.
    assert names == paths and plan_of(df).count("FileScan parquet") <= 2
    got = {(r[DATASET_INDEX], r["v"], r["family"], r["n"]) for r in df.groupBy(DATASET_INDEX, "v", "family").agg(F.count("*").alias("n")).collect()}
    assert got == {(i, i, None if i == 7 else f"{i:03d}/ +é%=", 2) for i in range(50)}
    recorded, jobs = jobs_run(spark, "schemas", lambda: read_datasets(spark, paths[::2])[0])
    assert jobs <= 1 and plan_of(recorded).count("FileScan parquet") == 1
    assert read_dataset(spark, paths[1]).first()["family"] == "001/ +é%="


def test_partitioned_and_plain_datasets_together(spark, tmp_path):
    rows = spark.createDataFrame([(1, "F1", "s")], "v int, family string, SOURCE_DATASET string")
    write_dataset(rows, str(tmp_path / "folders"), partition_by=["family"])
    write_dataset(rows.withColumn("family", F.lit("F2")), str(tmp_path / "plain"))
    (tmp_path / "nothing").mkdir()
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", UserWarning)
        df, names = read_datasets(spark, [str(tmp_path / name) for name in ("folders", "nothing", "plain")])
    assert len(names) == 2
    assert sorted((r[DATASET_INDEX], r["family"]) for r in df.collect()) == [(0, "F1"), (1, "F2")]


def test_info_entries(spark):
    fields = [Field("A", "1", "String"), Field("a b", "1", "String"), Field("FLAG", "0", "Flag"), Field("N", ".", "Integer")]
    texts = ['A=1;A=2;FLAG', 'A="q\\u0041\\";N=1,2', "A=x=y;FLAG=3", ".", "", "AA=1;XFLAG;N=", "a b=z\x01;A=", "A"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    values = [f"{info_value(f)} as v{n}" for n, f in enumerate(fields)]
    got = rows.selectExpr("i", f"{info_struct('t', [f.name for f in fields])} as _info").selectExpr(
        "i", "array('T') as _alts", "0 as _alt", "_info").selectExpr("i", *values).orderBy("i").collect()
    assert [tuple(r)[1:] for r in got] == [
        ("1", None, True, None), ('"q\\u0041\\"', None, False, "(1, 2)"), ("x=y", None, True, None), (None, None, False, None),
        (None, None, False, None), (None, None, False, None), (None, "z\x01", False, None), (None, None, False, None),
    ]


def test_info_cost_follows_the_entries(spark):
    """Four times the entries and fields may take about four times as long, not sixteen."""

    def seconds(count):
        header = parse_header([f'##INFO=<ID=F{i},Number=1,Type=String,Description="x">' for i in range(count)] + ["#CHROM\tPOS"])
        entries = ", ".join(f"concat('F{i}=', id + {i})" for i in range(count))
        lines = spark.range(0, 6_000, 1, 2).selectExpr(f"concat_ws('\t', 'c', id, '.', 'A', 'T', '.', '.', concat_ws(';', {entries})) as value")
        lines = spark.createDataFrame(lines.toPandas()).repartition(2)
        table = flatten_vcf(lines, header).select(F.hash(*[col(f"INFO['F{i}']") for i in range(count)]))
        times = []
        for _ in range(3):
            started = time.perf_counter()
            table.write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        return min(times)

    assert seconds(200) < 10 * seconds(50)


def test_files_that_users_bring(spark, tmp_path):
    (tmp_path / "d.csv").write_text("column_name,dtype\nA,int64\n,x\nB,\n")
    (tmp_path / "r.csv").write_text("A,B\nC\n")
    (tmp_path / "c.yaml").write_text("FILTERS:\n  A: '~:1'\n")
    assert read_dtypes(str(tmp_path / "d.csv")) == {"A": "int64"}
    assert read_renames(str(tmp_path / "r.csv")) == {"A": "B"}
    with pytest.raises(ConfigError, match="unknown operator"):
        PipelineConfig.from_yaml(str(tmp_path / "c.yaml")).rules  # noqa: B018


def test_headers_of_text_files(spark, tmp_path):
    (tmp_path / "empty.tsv").write_text("")
    with pytest.raises(ValueError, match="empty"):
        read_delimited(spark, str(tmp_path / "empty.tsv"))
    (tmp_path / "f.x.tsv").write_text("A\tB\n1\t2")
    row = read_delimited(spark, str(tmp_path / "f.x.tsv"), provenance=True).first()
    assert (row["family"], row["filename"], row["A"], row["B"]) == ("f", "f.x.tsv", "1", "2")

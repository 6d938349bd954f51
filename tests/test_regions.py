"""Regions over data that are laid out by position."""

import pytest
from pyspark.sql import functions as F

from variantry.operators.membership import match_regions, region_bounds
from variantry.sinks import write_dataset
from variantry.sources.tables import read_dataset, read_sidecar

REGION = "chrom string, start bigint, end bigint"


def sites(spark, count=40_000):
    return spark.range(count).selectExpr("concat('chr', id % 4 + 1) as CHROM", "id div 4 * 10 as POS", "uuid() as pad")


def rows_read(df):
    """Rows that the scan of a plan gave, from its metrics."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    found, waiting = [], [plan]
    while waiting:
        node = waiting.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            waiting.append(node.executedPlan())
            continue
        if hasattr(node, "plan") and "QueryStage" in node.getClass().getSimpleName():
            waiting.append(node.plan())
            continue
        if name.startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return sum(found)


@pytest.fixture
def clustered(spark, tmp_path):
    path = str(tmp_path / "clustered")
    write_dataset(sites(spark), path, cluster_by=["CHROM", "POS"])
    return path


def test_layout_is_recorded_and_kept(spark, clustered):
    assert read_sidecar(spark, clustered)["cluster_by"] == ["CHROM", "POS"]
    rows = read_dataset(spark, clustered).select(
        "CHROM", "POS", F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("line")
    ).collect()
    files = {}
    for row in sorted(rows, key=lambda r: (r["file"], r["line"])):
        files.setdefault(row["file"], []).append((row["CHROM"], row["POS"]))
    ranges = sorted((places[0], places[-1]) for places in files.values())
    assert all(places == sorted(places) for places in files.values())
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:], strict=False))


def test_filter_reaches_the_scan(spark, clustered, plan_of):
    regions = spark.createDataFrame([("2", 500, 700), ("2", 650, 900), ("3", 99_000, 99_010)], REGION)
    found = match_regions(read_dataset(spark, clustered), regions)
    got = {(r["CHROM"], r["POS"]) for r in found.collect()}
    assert got == {("chr2", p) for p in range(500, 901, 10)} | {("chr3", p) for p in (99_000, 99_010)}
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    pushed = plan_of(match_regions(read_dataset(spark, clustered), regions)).split("PushedFilters: ")[1].split("\n")[0]
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(POS,500)" in pushed and "LessThanOrEqual(POS,99010)" in pushed


def test_fewer_rows_are_read(spark, tmp_path):
    path = str(tmp_path / "small_groups")
    rows = sites(spark).repartitionByRange(16, "CHROM", "POS").sortWithinPartitions("CHROM", "POS")
    rows.write.option("parquet.block.size", 1 << 16).parquet(path)
    regions = spark.createDataFrame([("1", 10, 50)], REGION)
    df = read_dataset(spark, path)
    assert rows_read(df.where(region_bounds(df, regions))) < 40_000 / 2


@pytest.mark.parametrize("kind", ["bigint", "string", "double"])
def test_all_kinds_of_positions(spark, kind):
    df = sites(spark, 400).withColumn("POS", F.col("POS").cast(kind))
    regions = spark.createDataFrame([("1", 100, 200), ("x", 5, 1), ("4", -5, 1 << 40)], REGION)
    got = sorted((r["CHROM"], int(float(r["POS"]))) for r in match_regions(df, regions).collect())
    assert got == sorted([("chr1", p) for p in range(100, 201, 10)] + [("chr4", p) for p in range(0, 1000, 10)])
    assert match_regions(df, regions.limit(0)).count() == 0
    many = spark.createDataFrame([(str(i), 100, 200) for i in range(400)], REGION)
    assert match_regions(df, many).count() == 44

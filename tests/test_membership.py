import random

import pytest
from pyspark.sql import functions as F

from variantry.names import SYMBOL
from variantry.operators import membership
from variantry.operators.membership import mark_criteria, mark_regions, match_any, match_genes, match_regions, region_bins


def genes_table(spark):
    symbols = ["A2M", "BRCA1;TP53", "UNKNOWN", "A2M;OTHER", "NOTFOUND", None, "", ".", "a2m", " TP53 &X", "TP53X"]
    return spark.createDataFrame([(i, s) for i, s in enumerate(symbols, 1)], f"id int, `{SYMBOL}` string")


def test_genes(spark):
    df = genes_table(spark)
    wanted = ["A2M", "BRCA1", "TP53", "."]
    frame = spark.createDataFrame([(w,) for w in wanted], "symbol string")
    for genes in (wanted, frame):
        kept = match_genes(df, genes)
        assert sorted(r.id for r in kept.collect()) == [1, 2, 4, 10]
        assert kept.columns == df.columns


def test_genes_edge_cases(spark):
    df = genes_table(spark)
    assert match_genes(df, None) is df
    assert match_genes(df, []).count() == 0
    with pytest.warns(UserWarning):
        assert match_genes(df.select("id"), ["A2M"]).count() == 11
    # Rows that are equal are all kept, whatever way the list is matched.
    twice = df.union(df)
    table = spark.createDataFrame([("A2M",)], "symbol string")
    assert match_genes(twice, table).count() == match_genes(twice, ["A2M"]).count() == 4


REGIONS = [("1", 100, 200), ("1", 500, 600), ("2", 1000, 1100), ("3", 2000, 2500)]


def regions_of(spark, rows):
    return spark.createDataFrame(rows, "chrom string, start long, end long")


def test_regions(spark):
    rows = [
        ("1", "50"), ("1", "150"), ("1", "300"), ("1", "550"), ("2", "1050"), ("2", "900"), ("3", "2200"), ("3", "1500"),
        ("4", "100"), ("chr1", "100"), ("CHR1", "200"), ("1", "99"), ("1", "201"), ("1", "150.0"), ("1", "x"), (None, "150"),
        ("1", None), ("chr1", " 150 "),
    ]
    df = spark.createDataFrame(rows, "CHROM string, POS string")
    kept = {(r.CHROM, r.POS) for r in match_regions(df, regions_of(spark, REGIONS)).collect()}
    assert kept == {
        ("1", "150"), ("1", "550"), ("2", "1050"), ("3", "2200"), ("chr1", "100"), ("CHR1", "200"), ("chr1", " 150 ")
    }


def test_regions_against_brute_force(spark):
    rng = random.Random(7)
    width = 1 << membership.BIN_BITS
    regions = []
    for _ in range(120):
        start = rng.randrange(-5, 20 * width)
        length = rng.choice([0, 1, 5, width - 1, width, width + 1, 7 * width])
        regions.append((rng.choice("123"), start, start + length))
    regions += [("1", 50, 40), ("2", width, 2 * width - 1), ("2", width, 2 * width)]
    edges = [p + d for _, s, e in regions for p in (s, e) for d in (-1, 0, 1)]
    points = [(chrom, p) for chrom in "1234" for p in edges + [rng.randrange(30 * width) for _ in range(300)]]
    df = spark.createDataFrame([(i, c, p) for i, (c, p) in enumerate(points)], "i int, CHROM string, POS long")
    marked = mark_regions(df, regions_of(spark, regions), "hit")
    found = {r.i: r.hit for r in marked.collect()}
    assert len(found) == len(points)
    for i, (chrom, p) in enumerate(points):
        assert found[i] == any(c == chrom and s <= p <= e for c, s, e in regions)


def test_bins_stay_small(spark):
    """Thousands of overlapping regions leave one span per start and bin."""
    many = spark.range(5000).selectExpr("'1' as chrom", "id % 3 as start", "id * 100 as end")
    bins = region_bins(many).select(F.size("_spans").alias("n"), "_bin").collect()
    assert max(r.n for r in bins) <= 3
    assert len(bins) == (4999 * 100 >> membership.BIN_BITS) + 1


def combined_table(spark):
    rows = [
        ("1", 150, "BRCA1"), ("1", 350, "TP53"), ("1", 500, "BRCA2"), ("2", 500, "TP53"), ("3", 500, "BRCA1"),
        ("1", 120, "OTHER1"), ("2", 200, "OTHER2"), ("3", 1500, "OTHER4"), ("2", 900, "OTHER3"), ("4", 200, "OTHER5"),
    ]
    return spark.createDataFrame([(*r, "rs1") for r in rows], f"CHROM string, POS long, `{SYMBOL}` string, ID string")


SET = [("1", 100, 200), ("1", 300, 400), ("2", 150, 250), ("3", 1000, 2000)]


def test_any_criterion(spark):
    df = combined_table(spark)
    regions = regions_of(spark, SET)
    genes = ["BRCA1", "BRCA2", "TP53"]
    kept = match_any(df, genes, None, regions)
    assert kept.columns == df.columns
    assert {(r.CHROM, r.POS) for r in df.exceptAll(kept).collect()} == {("2", 900), ("4", 200)}
    marked, flags = mark_criteria(df, genes, None, regions)
    counts = marked.groupBy(*flags).count().collect()
    assert {(r[0], r[1]): r[2] for r in counts} == {(True, True): 2, (True, False): 3, (False, True): 3, (False, False): 2}


def test_criteria_left_out(spark):
    df = combined_table(spark)
    regions = regions_of(spark, SET)
    assert match_any(df) is df
    assert match_any(df, genes=[]).count() == 10
    assert match_any(df.drop(SYMBOL), genes=["BRCA1"]).count() == 10
    assert match_any(df.drop("POS"), genes=["TP53"], regions=regions).count() == 2
    assert match_any(df, rsids=["rs1"]).count() == 10
    assert match_any(df, genes=["TP53"], rsids=["rs2"], regions=regions.limit(0)).count() == 2


def test_no_row_meets_every_region(spark, plan_of):
    plan = plan_of(match_regions(combined_table(spark), regions_of(spark, SET)))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("kept", [("CHROM", "POS", "ID"), ("ID",)])
def test_cells_that_most_rows_share(spark, kept):
    """None is lost or doubled, with or without columns that name a site; rows that cannot match are spread."""
    cell = "case when id % 3 = 0 then 'rs1, rs2' when id % 3 = 1 then '.' else concat('rs', id) end as ID"
    df = spark.range(3000).selectExpr("'1' as CHROM", "id as POS", cell).select(*kept)
    listed = spark.createDataFrame([("rs2",), ("rs2",), ("rs5",), (None,)], "id string")
    found = membership.match_rsids(df, listed)
    assert found.columns == list(kept) and found.count() == 1002
    assert {r["ID"]: r["count"] for r in found.groupBy("ID").count().collect()} == {"rs1, rs2": 1000, "rs2": 1, "rs5": 1}
    marked = membership.mark_listed(df, "ID", listed, "_hit")
    assert {r["_hit"]: r["count"] for r in marked.groupBy("_hit").count().collect()} == {True: 1002, False: 1998}
    if "POS" in kept:
        places = df.where("ID = '.'").select(F.pmod(membership._apart(df, "ID"), F.lit(membership.SPREAD)).alias("place"))
        assert places.distinct().count() > 800


def test_rows_that_cannot_match_are_not_joined(spark, plan_of):
    df = spark.range(10).selectExpr("id as POS", "concat('rs', id) as ID")
    plan = plan_of(membership.match_rsids(df, spark.createDataFrame([("rs2",)], "id string")))
    assert "LeftSemi" in plan and "LeftOuter" not in plan and "Cartesian" not in plan


@pytest.fixture
def plain_joins(spark):
    """Joins that move both sides, with as many tasks as there are partitions."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_rows_that_cannot_match_are_spread(spark, plain_joins):
    """No task of the join that finds the listed cells gets all rows without an entry."""
    cells = F.expr("case id % 4 when 0 then '.' when 1 then '' when 2 then null else concat('rs', id) end")
    df = spark.range(4000).select(F.col("id").alias("POS"), F.lit("chr1").alias("CHROM"), cells.alias("ID"))
    marked, _ = mark_criteria(df, rsids=spark.createDataFrame([("rs3",), ("rs7",), (".",)], "rsid string"))
    assert sorted(row["POS"] for row in marked.where("_in_rsids").collect()) == [3, 7]
    tasks = [row["count"] for row in marked.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(tasks) == 4000 and max(tasks) < 1500

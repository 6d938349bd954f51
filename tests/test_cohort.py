import random

import pytest
from pyspark.sql import functions as F

from variantry.names import DATASET_INDEX, ROW_COUNT, ROW_ORDER
from variantry.operators import gather
from variantry.operators.cohort import below_cutoff, check_cutoff, cohort, family_frequencies, frequency_conflicts, row_counts
from variantry.plans.pipeline import combine
from variantry.sinks import write_dataset
from variantry.sources.tables import number_datasets, read_datasets

SITE = ["CHROM", "POS", "REF", "ALT"]
AF = "FORMAT['AF']"


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Families 1 and 2 with different columns, and a dataset without a family."""
    root = tmp_path_factory.mktemp("cohort")
    one = spark.createDataFrame(
        [("1", 10, "A", "C", "s1", 0.1, "HIGH", 7, "1", "x"), ("1", 20, "A", "C", "s1", 0.2, "LOW", 8, "1", "x"), (None, 30, "A", "C", "s1", 0.2, "LOW", 8, "1", "x")],
        f"CHROM string, POS long, REF string, ALT string, SAMPLE string, `{AF}` double, `ANN['IMPACT']` string, "
        "`INFO['DP']` long, family string, extra string",
    )
    two = spark.createDataFrame(
        [("1", 10, "A", "C", "s2", 0.3, "LOW", "2"), ("1", 40, "A", "C", "s2", None, "LOW", "2")],
        f"CHROM string, POS int, REF string, ALT string, SAMPLE string, `{AF}` double, `ANN['IMPACT']` string, family string",
    )
    three = spark.createDataFrame(
        [("1", 10, "A", "C", "s3", 0.4, "HIGH"), ("1", 20, "A", "C", "s3", 0.5, None)],
        f"CHROM string, POS long, REF string, ALT string, SAMPLE string, `{AF}` double, `ANN['IMPACT']` string",
    )
    paths = []
    for name, df in (("one", one), ("two", two), ("three", three)):
        paths.append(str(root / name))
        write_dataset(df, paths[-1])
    return paths


def by_pos(df):
    return {r.POS: r.asDict() for r in df.collect()}


def test_default(spark, stored):
    df, names = read_datasets(spark, stored)
    assert names == stored
    result = combine(df, names)
    assert result.columns == [
        *SITE, "ANN['IMPACT']", "INFO['DP']", "AF_1", "AF_2", "AF_3", "family", "SAMPLE", ROW_COUNT
    ]
    found = by_pos(result)
    assert sorted(found) == [10, 20, 40]
    assert found[10]["ANN['IMPACT']"] == ["HIGH", "LOW"] and found[10]["family"] == ["1", "2", "3"]
    assert (found[10]["AF_1"], found[10]["AF_2"], found[10]["AF_3"], found[10][ROW_COUNT]) == (0.1, 0.3, 0.4, 3)
    assert found[20]["ANN['IMPACT']"] == ["LOW"] and found[20]["INFO['DP']"] == ["8"]
    assert (found[20]["AF_1"], found[20]["AF_2"], found[20]["AF_3"], found[20][ROW_COUNT]) == (0.2, None, 0.5, 2)
    assert (found[40]["AF_2"], found[40]["INFO['DP']"], found[40][ROW_COUNT]) == (None, [], 1)
    assert sum(r[ROW_COUNT] for r in found.values()) == df.dropna(subset=SITE).count()


def test_order_of_datasets(spark, stored):
    df, names = read_datasets(spark, [stored[1], stored[0], stored[2]])
    found = by_pos(combine(df, names))
    assert found[10]["SAMPLE"] == ["s2", "s1", "s3"] and found[10]["AF_1"] == 0.1
    # The dataset without a family takes its position as the name, which clashes here.
    with pytest.raises(ValueError, match="family '1'"):
        combine(*read_datasets(spark, [stored[2], stored[1], stored[0]]))


def test_all_columns_and_counts(spark, stored):
    df, names = read_datasets(spark, stored)
    every = combine(df, names, columns="all")
    assert set(every.columns) == {
        *SITE, "SAMPLE", "AF_1", "AF_2", "AF_3", "ANN['IMPACT']", "INFO['DP']", "family", "extra", ROW_COUNT
    }
    assert by_pos(every)[10]["extra"] == ["x"]
    counts = {r.POS: r[ROW_COUNT] for r in combine(df, names, row_count_only=True).collect()}
    assert counts == {10: 3, 20: 2, 40: 1}
    assert {r.POS for r in combine(df, names, cutoff=3).collect()} == {20, 40}
    assert {r.POS for r in combine(df, names, row_count_only=True, cutoff=2).collect()} == {40}
    for bad in (1, 4):
        with pytest.raises(ValueError):
            combine(df, names, cutoff=bad)
    check_cutoff(None, 1)
    with pytest.raises(ValueError):
        cohort(df, columns="some")


def test_equal_schemas_share_a_scan(spark, tmp_path, plan_of):
    paths = []
    for i in range(6):
        df = spark.createDataFrame([("1", 5, "A", "C", f"f{i}", i / 10)], f"CHROM string, POS long, REF string, ALT string, family string, `{AF}` double")
        paths.append(str(tmp_path / f"d {i}"))
        write_dataset(df, paths[-1])
    df, names = read_datasets(spark, paths)
    assert plan_of(df).count("FileScan") == 1
    assert {r[DATASET_INDEX]: r.family for r in df.collect()} == {i: f"f{i}" for i in range(6)}
    row = combine(df, names).first()
    assert row["family"] == [f"f{i}" for i in range(6)] and row["AF_f3"] == 0.3


def test_existing_frequencies_keep_the_first(spark):
    df = spark.createDataFrame(
        [("1", 1, "A", "C", None, 2, 1), ("1", 1, "A", "C", 0.7, 3, 2), ("1", 1, "A", "C", 0.9, 1, 3)],
        f"CHROM string, POS long, REF string, ALT string, AF_x double, {DATASET_INDEX} int, {ROW_ORDER} long",
    )
    assert cohort(df).first()["AF_x"] == 0.9
    assert cohort(df.where(f"{DATASET_INDEX} > 1")).first()["AF_x"] == 0.7


def test_conflicts(spark):
    rows = [("1", 1, "A", "C", "f", 0.1), ("1", 1, "A", "C", "f", 0.2), ("1", 1, "A", "C", "g", 0.2), ("1", 2, "A", "C", "f", None)]
    df = spark.createDataFrame(rows, f"CHROM string, POS long, REF string, ALT string, family string, `{AF}` double").coalesce(1)
    assert [(r.POS, r.family, r.n_values) for r in frequency_conflicts(df).collect()] == [(1, "f", 2)]
    pivoted = by_pos(family_frequencies(df, ["f", "g", "h"]))
    assert (pivoted[1]["AF_f"], pivoted[1]["AF_g"], pivoted[1]["AF_h"]) == (0.1, 0.2, None)
    assert pivoted[2]["AF_f"] is None


def test_hot_variant_against_brute_force(spark, monkeypatch):
    """A third of the rows are one variant, spread over many datasets and rows."""
    monkeypatch.setattr(gather, "BLOCK_BITS", 2)
    monkeypatch.setattr(gather, "RANGE_BITS", 3)
    monkeypatch.setattr(gather, "DATASET_BITS", 2)
    rng = random.Random(5)
    rows = []
    for i in range(3000):
        pos = 0 if rng.random() < 0.34 else rng.randrange(1, 100)
        dataset = rng.randrange(20)
        rows.append(("1", pos, "A", "C", rng.choice([None, "u", "v", "w", "x"]), round(rng.random(), 3), f"f{dataset}", dataset, i))
    df = spark.createDataFrame(
        rows, f"CHROM string, POS long, REF string, ALT string, `INFO['v']` string, `{AF}` double, family string, {DATASET_INDEX} int, {ROW_ORDER} long"
    ).repartition(5)
    families = [f"f{i}" for i in range(20)]
    found = by_pos(cohort(df, families=families))
    expected = {}
    for row in sorted(rows, key=lambda r: (r[7], r[8])):
        entry = expected.setdefault(row[1], {"values": [], "afs": {}, "n": 0})
        entry["n"] += 1
        if row[4] is not None and row[4] not in entry["values"]:
            entry["values"].append(row[4])
        entry["afs"].setdefault(row[6], row[5])
    assert set(found) == set(expected)
    for pos, entry in expected.items():
        assert found[pos]["INFO['v']"] == entry["values"] and found[pos][ROW_COUNT] == entry["n"]
        assert {f: found[pos][f"AF_{f}"] for f in families} == {f: entry["afs"].get(f) for f in families}
    rare = by_pos(cohort(df, families=families, cutoff=20))
    assert rare == {pos: row for pos, row in found.items() if row[ROW_COUNT] < 20} and 0 < len(rare) < len(found)


def test_cutoff_reads_keys_only(spark, tmp_path, plan_of):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("'1' as CHROM", "id % 4 as POS", "'A' as REF", "'C' as ALT", "id as wide").write.parquet(path)
    df = spark.read.parquet(path)
    kept = below_cutoff(df, 3)
    assert {r.POS for r in kept.collect()} == {2, 3} and kept.count() == 4
    schemas = [part.split(">")[0] for part in plan_of(below_cutoff(df, 3)).split("ReadSchema: ")[1:]]
    assert ["wide" in schema for schema in schemas].count(True) == 1
    # The counts that three tests use are made once.
    run = below_cutoff(df, 3)
    run.collect()
    assert plan_of(run).count("ReusedExchange") >= 2
    assert row_counts(df).agg(F.sum(ROW_COUNT)).first()[0] == 10


def test_datasets_in_one_table(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), ("b", 3)], "SOURCE_DATASET string, v int")
    numbered, names = number_datasets(df)
    assert names == ["a", "b"]
    assert {(r.v, r[DATASET_INDEX]) for r in numbered.collect()} == {(1, 1), (2, 0), (3, 1)}


@pytest.mark.parametrize("share", [1 / (1 << 16), 1.0, 0.0])
@pytest.mark.parametrize("order", ["first", "sorted"])
def test_a_variant_with_a_third_of_all_rows_is_left_out_before_its_rows_move(spark, tmp_path, plan_of, monkeypatch, share, order):
    monkeypatch.setattr("variantry.operators.cohort.HOT_SHARE", share)
    rng = random.Random(9)
    places = [7] * 500 + [rng.randrange(100, 600) for _ in range(1000)] + [None, None]
    rows = [("1", pos, "A", "C", f"s{i % 40}", f"f{i % 3}", "LOW" if i % 2 else "HIGH") for i, pos in enumerate(places)]
    path = str(tmp_path / "rows")
    spark.createDataFrame(rows, "CHROM string, POS long, REF string, ALT string, SAMPLE string, family string, `ANN['IMPACT']` string").write.parquet(path)
    df = spark.read.parquet(path)
    result = {r.POS: r for r in cohort(df, order=order, cutoff=3).collect()}
    expected = {pos for pos in places if pos is not None and places.count(pos) < 3}
    assert set(result) == expected and 7 not in result
    for pos, row in result.items():
        own = [r for r in rows if r[1] == pos]
        assert row[ROW_COUNT] == len(own)
        assert sorted(row.SAMPLE) == sorted({r[4] for r in own}) and sorted(row["ANN['IMPACT']"]) == sorted({r[6] for r in own})
    plan = plan_of(cohort(df, order=order, cutoff=3))
    assert "LeftAnti" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert cohort(df.limit(0), order=order, cutoff=3).collect() == []


def families_of_sites(spark):
    """Sites with several rows per family, families that are not asked for or missing, and equal frequencies in other rows."""
    rng = random.Random(9)
    rows = [
        ("1", rng.randrange(12), "A", "C", rng.choice(["s1", "s2", None]), rng.choice([0.1, 0.25, None]), rng.choice(["1", "2", "x", None]), i)
        for i in range(400)
    ]
    return spark.createDataFrame(rows, f"CHROM string, POS long, REF string, ALT string, SAMPLE string, `{AF}` double, family string, {ROW_ORDER} long"), rows


@pytest.mark.parametrize("wide", [64, 1])
def test_sorted_cohort_of_many_and_few_families(spark, monkeypatch, wide):
    from variantry.operators import cohort as module

    monkeypatch.setattr(module, "WIDE", wide)
    df, rows = families_of_sites(spark)
    found = by_pos(cohort(df, families=["1", "2", "absent"], order="sorted"))
    assert sorted(found) == sorted({row[1] for row in rows})
    for pos, row in found.items():
        own = [given for given in rows if given[1] == pos]
        assert row["SAMPLE"] == sorted({given[4] for given in own if given[4]}) and row[ROW_COUNT] == len(own)
        for family in ("1", "2"):
            assert row[f"AF_{family}"] == next((given[5] for given in own if given[6] == family and given[5] is not None), None)
        assert row["AF_absent"] is None


def test_sorted_cohort_moves_rows_once(spark):
    df, _ = families_of_sites(spark)
    plan = cohort(df, families=["1", "2"], order="sorted")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1

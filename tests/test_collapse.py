import random

import pytest

from variantry.names import ROW_ORDER, SOURCE_DATASET
from variantry.operators import gather
from variantry.operators.collapse import collapse
from variantry.operators.gather import gather_distinct

KEYS = ["SAMPLE", "CHROM", "POS", "REF", "ALT", "FORMAT['SAOBS']"]
SCHEMA = (
    "SAMPLE string, n long, CHROM string, POS long, REF string, ALT string, `FORMAT['SAOBS']` string, same string, "
    "`none` string, `ANN['x.y']` string, d double, flag boolean"
)


def rows(spark):
    return spark.createDataFrame(
        [
            ("s", 5, "1", 10, "A", "C", "o", "k", None, "b", 0.00001, True),
            ("s", None, "1", 10, "A", "C", "o", "k", None, "a", None, None),
            ("s", 4, "1", 10, "A", "C", "o", "k", None, "b", 2.0, False),
            ("s", 4, "1", 10, "A", "C", None, "lost", None, "b", 2.0, False),
            ("s", 9, "1", 11, "A", "C", "o", "k", None, "None", 3.0, None),
            ("s", 9, "1", 12, "A", "C", "o", "k", None, "None", 3.0, None),
            ("s", 9, "1", 12, "A", "C", "o", "k", None, "z", 3.0, None),
        ],
        SCHEMA,
    ).coalesce(1)


def test_cells(spark):
    result = collapse(rows(spark), source="fam1")
    assert result.columns == [*rows(spark).columns, SOURCE_DATASET]
    found = {r.POS: r for r in result.collect()}
    assert sorted(found) == [10, 11, 12]
    first = found[10]
    assert (first["n"], first["same"], first["none"], first["ANN['x.y']"]) == ("5;4", "k", None, "b;a")
    assert (first["d"], first["flag"], first[SOURCE_DATASET]) == ("1e-05;2.0", "True;False", "fam1")
    # A lone text "None" is a value; among several it is left out.
    assert found[11]["ANN['x.y']"] == "None" and found[12]["ANN['x.y']"] == "z"
    assert found[11]["n"] == "9"


def test_sorted_and_null_keys(spark):
    result = {r.POS: r for r in collapse(rows(spark), order="sorted").collect()}
    assert result[10]["ANN['x.y']"] == "a;b" and result[10]["n"] == "4;5"
    kept = collapse(rows(spark), drop_null_keys=False)
    assert kept.count() == 4 and kept.where("same = 'lost'").count() == 1
    with pytest.raises(ValueError):
        collapse(rows(spark), order="random")


def test_idempotent(spark):
    once = collapse(rows(spark))
    twice = collapse(once)
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))


def test_missing_keys(spark):
    df = rows(spark)
    with pytest.warns(UserWarning):
        partial = collapse(df.drop("FORMAT['SAOBS']", "SAMPLE"))
    assert {r.POS: r.same for r in partial.collect()} == {10: "k;lost", 11: "k", 12: "k"}
    with pytest.warns(UserWarning):
        nothing = collapse(df.select("same", "d"), source="x")
    assert nothing.count() == 7 and nothing.columns == ["same", "d", SOURCE_DATASET]
    with pytest.warns(UserWarning):
        assert collapse(df.select("CHROM", "POS")).count() == 7


def brute_force(records, order):
    groups = {}
    for key, value, rank in sorted(records, key=lambda r: r[2]):
        groups.setdefault(key, [])
        if value is not None and value not in groups[key]:
            groups[key].append(value)
    return {key: sorted(values) if order == "sorted" else values for key, values in groups.items()}


@pytest.mark.parametrize("order", ["first", "sorted"])
def test_hot_key_against_brute_force(spark, monkeypatch, order):
    """A third of the rows share a key, and blocks are so small that every step merges."""
    monkeypatch.setattr(gather, "BLOCK_BITS", 3)
    monkeypatch.setattr(gather, "RANGE_BITS", 4)
    rng = random.Random(3)
    records = [
        ("hot" if rng.random() < 0.34 else f"k{rng.randrange(300)}", rng.choice([None, *"abcdefghij"]), i)
        for i in range(6000)
    ]
    rng.shuffle(records)
    df = spark.createDataFrame(records, f"k string, v string, {ROW_ORDER} long").repartition(7)
    result = gather_distinct(df, ["k"], ["v"], order=order).collect()
    assert {r.k: r.v for r in result} == brute_force(records, order)
    assert sum(r[gather.GROUP_ROWS] for r in result) == 6000


def test_row_order_of_a_scan(spark, tmp_path):
    """Without a given order, the order of the file counts."""
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id % 7 as k", "cast(999 - id as string) as v").coalesce(1).write.parquet(path)
    rows = gather_distinct(spark.read.parquet(path), ["k"], ["v"]).collect()
    for row in rows:
        assert row.v == [str(999 - i) for i in range(row.k, 1000, 7)]


def test_repeated_values_are_dropped_before_the_shuffle(spark, plan_of):
    df = spark.range(100).selectExpr("id % 2 as k", "'same' as v")
    plan = plan_of(gather_distinct(df, ["k"], ["v"], order="sorted"))
    assert "partial_collect_set" in plan and plan.count("Exchange") == 1


def test_two_shuffles_gather_values_in_order(spark, plan_of):
    """Blocks and ranges are combined where the rows of a range are."""
    df = spark.range(100).selectExpr("id % 2 as k", "cast(id as string) as v", f"id as {ROW_ORDER}")
    assert plan_of(gather_distinct(df, ["k"], ["v"])).count("Exchange") == 2


def test_unneeded_columns_are_not_read(spark, tmp_path, plan_of):
    path = str(tmp_path / "wide")
    rows(spark).write.parquet(path)
    wide = spark.read.parquet(path).select("CHROM", "POS", "REF", "ALT", "same")
    plan = plan_of(collapse(wide, ["CHROM", "POS", "REF", "ALT"], order="sorted"))
    schema = plan.split("ReadSchema: ")[1].split(">")[0]
    assert "flag" not in schema and "same" in schema

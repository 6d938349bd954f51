import pytest

from variantry.names import DATASET_INDEX, UNIQUE_KEYS
from variantry.operators.collapse import collapse
from variantry.operators.validate import (
    ValidationError,
    duplicate_keys,
    group_rows,
    preview,
    quarantine,
    require_dataset_uniqueness,
    require_families,
    require_unique,
    uniqueness_keys,
)

KEYS = [*UNIQUE_KEYS, "FORMAT['SAOBS']"]


def source(spark):
    return spark.createDataFrame(
        [
            ("s", "1", 10, "A", "C", "o1", "x"),
            ("s", "1", 10, "A", "C", "o2", "y"),
            ("s", "1", 10, "A", "C", "o2", "y"),
            ("s", "1", 10, "A", "C", None, "z"),
            ("s", "1", 11, "A", "C", "o1", "x"),
            ("t", "1", 10, "A", "C", "o1", "x"),
            ("t", "1", None, "A", "C", "o1", "x"),
            ("t", "1", None, "A", "C", "o2", "x"),
        ],
        "SAMPLE string, CHROM string, POS long, REF string, ALT string, `FORMAT['SAOBS']` string, v string",
    )


def test_duplicates(spark):
    duplicates = duplicate_keys(group_rows(source(spark), KEYS), UNIQUE_KEYS)
    assert [tuple(r) for r in duplicates.collect()] == [("s", "1", 10, "A", "C", 2)]
    collapsed = collapse(source(spark), KEYS)
    assert duplicates.exceptAll(duplicate_keys(collapsed, UNIQUE_KEYS)).count() == 0
    assert preview(duplicates).count() == 1


def test_quarantine(spark):
    collapsed = collapse(source(spark), KEYS)
    clean, bad = quarantine(collapsed, source(spark), KEYS)
    assert sorted((r.SAMPLE, r.POS) for r in clean.collect()) == [("s", 11), ("t", 10)]
    # Every distinct source row of the key, also the one the collapse had dropped.
    assert sorted((r["FORMAT['SAOBS']"] or "", r.v) for r in bad.collect()) == [("", "z"), ("o1", "x"), ("o2", "y")]
    assert clean.columns == collapsed.columns and bad.columns == source(spark).columns
    require_unique(clean, UNIQUE_KEYS)
    kept = {tuple(r) for r in clean.select(*UNIQUE_KEYS).collect()}
    gone = {tuple(r) for r in bad.select(*UNIQUE_KEYS).collect()}
    every = {tuple(r) for r in source(spark).select(*UNIQUE_KEYS).dropna().collect()}
    assert kept | gone == every and not kept & gone


def test_nothing_to_quarantine(spark):
    rows = source(spark).where("POS = 11")
    clean, bad = quarantine(collapse(rows, KEYS), rows, KEYS)
    assert clean.count() == 1 and bad.isEmpty() and bad.columns == rows.columns


def test_strict(spark):
    with pytest.raises(ValidationError) as error:
        require_unique(collapse(source(spark), KEYS), UNIQUE_KEYS)
    assert "POS=10" in str(error.value) and "(2 rows)" in str(error.value)
    assert "expected 3 rows, found 4" in str(error.value)
    many = spark.range(40).selectExpr("'s' as SAMPLE", "'1' as CHROM", "id div 2 as POS", "'A' as REF", "'C' as ALT")
    with pytest.raises(ValidationError) as error:
        require_unique(many, UNIQUE_KEYS)
    assert str(error.value).count("  - ") == 10 and "... and 10 more" in str(error.value)
    with pytest.warns(UserWarning):
        assert uniqueness_keys(many.drop("POS", "REF")) == []
    assert uniqueness_keys(many.drop("SAMPLE")) == ["CHROM", "POS", "REF", "ALT"]


def numbered(spark, rows):
    return spark.createDataFrame(rows, f"CHROM string, POS long, REF string, ALT string, family string, {DATASET_INDEX} int")


def test_datasets(spark):
    good = numbered(spark, [("1", 1, "A", "C", "f1", 0), ("1", 1, "A", "C", "f2", 1), ("1", 2, "A", "C", None, 1)])
    require_dataset_uniqueness(good, ["a", "b"])
    assert require_families(good, ["a", "b"]) == ["f1", "f2"]
    repeated = numbered(spark, [("1", 1, "A", "C", "f1", 0), ("1", 1, "A", "C", "f2", 1), ("1", 1, "A", "C", "f2", 1)])
    with pytest.raises(ValidationError, match="b: 1"):
        require_dataset_uniqueness(repeated, ["a", "b"])
    shared = numbered(spark, [("1", 1, "A", "C", "f1", 0), ("1", 1, "A", "C", "f1", 1)])
    with pytest.raises(ValidationError, match="both a and b"):
        require_families(shared, ["a", "b"])
    mixed = numbered(spark, [("1", 1, "A", "C", "f1", 0), ("1", 2, "A", "C", "f2", 0)])
    with pytest.raises(ValidationError, match="exactly one family"):
        require_families(mixed, ["a"])
    unnamed = numbered(spark, [("1", 1, "A", "C", None, 0)])
    with pytest.raises(ValidationError):
        require_families(unnamed, ["a"])

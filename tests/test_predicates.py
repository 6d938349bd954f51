import pytest

from variantry.config import ConfigError, PipelineConfig, Rule, parse_rules, parse_value
from variantry.functions.predicates import apply_rules, is_frequency, predicate

ROWS = [
    (1, 1.0, "alpha", "0.1"),
    (2, 2.0, "beta", "0.3"),
    (3, None, None, None),
    (4, float("nan"), "", ""),
    (5, 3.0, "a+b", "."),
    (6, 2.0, "Beta", "NA"),
    (7, -1.0, "gamma", "zz"),
    (8, 0.5, "alpha", "nan"),
    (9, 1e9, "delta", "1e-3"),
]
AF = "ANN['MAX_AF']"


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, f"id long, num double, txt string, `{AF}` string")


def kept(table, *rules):
    return sorted(row.id for row in apply_rules(table, list(rules)).collect())


@pytest.mark.parametrize(
    ("rule", "expected"),
    [
        (Rule("num", "==", 2), [2, 6]),
        (Rule("num", "!=", 2), [1, 3, 4, 5, 7, 8, 9]),
        (Rule("num", "<", 1), [7, 8]),
        (Rule("num", "<=", 1), [1, 7, 8]),
        # NaN is missing, not the largest number.
        (Rule("num", ">", 2), [5, 9]),
        (Rule("num", ">=", 2), [2, 5, 6, 9]),
        (Rule("num", "in", [1, 3]), [1, 5]),
        (Rule("num", "in", 2), [2, 6]),
        (Rule("num", "not_in", [1, 2, 3]), [3, 4, 7, 8, 9]),
        (Rule("txt", "==", "alpha"), [1, 8]),
        (Rule("txt", "!=", "alpha"), [2, 3, 4, 5, 6, 7, 9]),
        (Rule("txt", "contains", "^b|ta$"), [2, 6, 9]),
        (Rule("txt", "contains", "a+b"), []),
        (Rule("txt", "contains", r"a\+b"), [5]),
        (Rule("txt", "not_contains", "a"), [3, 4]),
        (Rule("num", "contains", "2"), [2, 6]),
        # Frequencies: rows without a value stay, text that is no number does not.
        (Rule(AF, "<=", 0.2), [1, 3, 4, 5, 6, 9]),
        (Rule(AF, ">", 0.2), [2, 3, 4, 5, 6]),
        (Rule(AF, "==", 0.1), [1, 3, 4, 5, 6]),
        (Rule(AF, "!=", 0.1), [2, 3, 4, 5, 6, 7, 8, 9]),
        (Rule(AF, "in", [0.3]), [2, 3, 4, 5, 6]),
        (Rule(AF, "not_in", [0.3]), [1, 3, 4, 5, 6, 7, 8, 9]),
        (Rule(AF, "contains", "z"), [3, 4, 5, 6, 7]),
    ],
)
def test_truth_table(table, rule, expected):
    assert kept(table, rule) == expected


def test_conjunction_and_missing_columns(table):
    assert kept(table, Rule("num", ">=", 1), Rule("txt", "contains", "a")) == [1, 2, 5, 6, 9]
    with pytest.warns(UserWarning):
        assert kept(table, Rule("absent", "==", 1)) == list(range(1, 10))


def test_case_insensitive_column(table):
    assert kept(table, Rule("NUM", "==", 2)) == [2, 6]
    with pytest.raises(ConfigError):
        predicate(Rule("absent", "==", 1), table)


def test_frequency_names():
    assert is_frequency(AF) and is_frequency("FORMAT['AFD']") and is_frequency("pop_FREQ")
    assert not is_frequency("POS")


def test_number_rule_on_text_column(spark):
    df = spark.createDataFrame([("5",), ("50",), ("x",), (None,)], "depth string")
    assert [row.depth for row in apply_rules(df, [Rule("depth", ">=", 10)]).collect()] == ["50"]


def test_parse_value():
    assert parse_value("3") == 3 and isinstance(parse_value("3"), int)
    assert parse_value("-0.5") == -0.5
    assert parse_value("1e-5") == 1e-5
    assert parse_value("TRUE") is True
    assert parse_value("HIGH") == "HIGH"
    for malformed in ("1-2", "1.2.3"):
        with pytest.raises(ConfigError):
            parse_value(malformed)


def test_parse_rules():
    with pytest.warns(UserWarning):
        rules = parse_rules({"A": "<=:0.2", "B": "no colon", "C": "==:a:b", "D": {"operator": "in", "value": ["x", "y"]}})
    assert rules == [Rule("A", "<=", 0.2), Rule("C", "==", "a:b"), Rule("D", "in", ["x", "y"])]
    with pytest.raises(ConfigError):
        parse_rules({"A": "~:1"})
    with pytest.raises(ConfigError):
        Rule("A", "<", [1, 2])


def test_config(tmp_path):
    path = tmp_path / "config.yaml"
    path.write_text(
        "FILTERS:\n  \"ANN['MAX_AF']\": \"<=:0.2\"\n"
        "COLUMN_MANAGEMENT:\n  drop_columns: [a, ' b ', a, '']\n"
        "DROP_COLUMNS:\n  columns: b, c\n"
        "ADDITIONAL_ZARR_FILTERING:\n  OUTPUT_DIR: out\n  BED_FILE: regions.bed\n  DROP_COLUMNS: []\n  COLUMN_ORDER_START: POS, CHROM\n"
    )
    config = PipelineConfig.from_yaml(str(path))
    assert config.rules == [Rule(AF, "<=", 0.2)]
    assert config.drop_columns == ["a", "b", "c"]
    assert config.narrow_drop_columns == []
    assert config.column_order_start == ["POS", "CHROM"]
    assert (config.output_dir, config.bed_file, config.gene_filter) == ("out", "regions.bed", None)
    assert config.get(["absent", "key"], "fallback") == "fallback"
    assert config.get(["FILTERS", AF, "deeper"], 1) == 1


def test_rules_reach_the_reader(spark, tmp_path, plan_of):
    """On a stored table rules are bare comparisons; NaN still counts as no value."""
    rows = [(1, 0.1, "a", True), (2, 0.3, "b", False), (3, None, None, None), (4, float("nan"), "a", True)]
    spark.createDataFrame(rows, f"id long, `{AF}` double, txt string, flag boolean").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    cases = [
        (Rule("txt", "==", "a"), {1, 4}, "EqualTo(txt,a)"), (Rule("id", "in", [1, 3]), {1, 3}, "In(id, [1,3])"),
        (Rule("id", "<", 3), {1, 2}, "LessThan(id,3)"), (Rule(AF, "<=", 0.2), {1, 3, 4}, "LessThanOrEqual("),
        (Rule(AF, ">", 0.2), {2, 3, 4}, "GreaterThan("), (Rule("txt", "!=", "a"), {2, 3}, "Not(EqualTo(txt,a))"),
        (Rule("flag", "==", True), {1, 4}, "EqualTo(flag,true)"), (Rule("id", "not_in", [1, 2]), {3, 4}, "Not(In(id, [1,2]))"),
    ]
    for rule, kept, pushed in cases:
        found = apply_rules(df, [rule])
        assert {r.id for r in found.collect()} == kept, rule
        assert pushed in plan_of(found).split("PushedFilters:")[1], rule

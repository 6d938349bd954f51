"""What jobs record about themselves."""

import pytest

from variantry.config import PipelineConfig
from variantry.operators import report
from variantry.plans.pipeline import filter_report, run_cohort, run_narrow
from variantry.sinks import write_dataset
from variantry.sources.tables import read_dataset, read_sidecar

COLUMNS = "CHROM string, POS long, REF string, ALT string, `ANN['SYMBOL']` string, ID string, `ANN['MAX_AF']` string"
ROWS = [
    ("chr1", 10, "A", "C", "G1", "rs1", "0.1"), ("chr1", 20, "A", "C", "G2;G1", ".", "."), ("chr2", 30, "A", "C", "G3", "rs3", "0.9"),
    ("chr2", 40, "A", "C", None, None, None), ("chr2", 40, "A", "C", "G1", "rs9", "x"),
]


@pytest.fixture
def stored(spark, tmp_path):
    def write(rows):
        path = str(tmp_path / f"stored_{len(rows)}")
        write_dataset(spark.createDataFrame(rows, COLUMNS), path)
        return path

    return write


def narrow_config(tmp_path, genes="G1", rsids="rs3"):
    (tmp_path / "genes.tsv").write_text(f"Symbol\tRSID\n{genes}\t\n\t{rsids}\n")
    (tmp_path / "regions.bed").write_text("chr1\t15\t25\n")
    return PipelineConfig(
        {"ADDITIONAL_ZARR_FILTERING": {"GENE_FILTER": str(tmp_path / "genes.tsv"), "BED_FILE": str(tmp_path / "regions.bed")}}
    )


def test_rules_and_genes(spark, stored):
    df = read_dataset(spark, stored(ROWS))
    config = PipelineConfig({"FILTERS": {"ann['max_af']": "<=:0.5", "POS": ">:10"}})
    found = filter_report(df, config, ["G1"])
    assert found["genes"] == {"n_original": 5, "n_kept": 3, "n_removed": 2, "pct_removed": 40.0}
    assert [(r["column_name"], r["n_rows"], r["n_missing"], r["n_numeric"], r["n_kept"], r["n_remaining"]) for r in found["rules"]] == [
        ("ANN['MAX_AF']", 3, 1, 1, 2, 2), ("POS", 3, 0, 3, 2, 1)
    ]
    assert found["filtered_rows"] == 1
    # Equally frequent values stand in their own order.
    assert [(v["column_name"], v["rank"], v["value"], v["n_rows"]) for v in found["values"]] == [
        ("ANN['MAX_AF']", 1, ".", 1), ("ANN['MAX_AF']", 2, "0.1", 1), ("ANN['MAX_AF']", 3, "x", 1),
        ("POS", 1, "10", 1), ("POS", 2, "20", 1), ("POS", 3, "40", 1),
    ]


@pytest.mark.filterwarnings("ignore::UserWarning")
def test_no_rules_no_rows(spark, stored):
    df = read_dataset(spark, stored(ROWS))
    plain = filter_report(df, PipelineConfig({}))
    assert (plain["genes"]["n_kept"], plain["filtered_rows"], plain["rules"], plain["values"]) == (5, 5, [], [])
    assert filter_report(df, PipelineConfig({"FILTERS": {"absent": ">:1"}}), ["G3"])["filtered_rows"] == 1
    empty = filter_report(read_dataset(spark, stored([])), PipelineConfig({"FILTERS": {"POS": ">:10"}}), ["G1"])
    assert (empty["genes"]["pct_removed"], empty["rules"][0]["n_rows"], empty["filtered_rows"]) == (0.0, 0, 0)


def test_value_profiles_agree_with_single_ones(spark):
    df = spark.range(500).selectExpr("id % 7 as a", "if(id % 3 = 0, null, concat('v', id % 40)) as `b.c`")
    together = report.value_profiles(df, ["a", "b.c"], 5).orderBy("column_name", "rank").collect()
    for name in ("a", "b.c"):
        alone = report.value_profile(df, name, 5).collect()
        assert [(r["value"], r["n_rows"]) for r in together if r["column_name"] == name] == [tuple(r) for r in alone]


def test_criteria_of_a_narrowing(spark, stored, tmp_path):
    out = run_narrow(spark, stored(ROWS), narrow_config(tmp_path), str(tmp_path / "out"))
    about = read_sidecar(spark, out)
    seen = about["reports"]
    assert (seen["n_original"], seen["n_kept"], seen["n_removed"], seen["pct_removed"]) == (5, 4, 1, 20.0)
    counts = seen["criteria"]
    assert [counts[f"n_in_{name}"] for name in ("region", "genes", "rsids")] == [1, 3, 1]
    assert (counts["n_any"], counts["n_rows"]) == (4, 5)
    assert (counts["first_kept_in_region"], counts["last_left_out_in_region"]) == ("chr1:20:A:C", "chr2:40:A:C")


@pytest.mark.filterwarnings("ignore::UserWarning")
def test_narrowing_without_rows_or_criteria(spark, stored, tmp_path):
    out = run_narrow(spark, stored([]), narrow_config(tmp_path), str(tmp_path / "out"))
    counts = read_sidecar(spark, out)["reports"]["criteria"]
    assert (counts["n_rows"], counts["n_any"], counts["first_kept_in_genes"]) == (0, 0, None)
    bare = run_narrow(spark, stored(ROWS), PipelineConfig({}), str(tmp_path / "bare"))
    assert read_sidecar(spark, bare)["reports"]["criteria"] == {} and read_dataset(spark, bare).count() == 5


def test_counts_that_disagree_with_the_files_are_taken_again(spark):
    marked = spark.createDataFrame(ROWS, COLUMNS).selectExpr("CHROM", "POS", "POS > 20 as _hit")
    watched = report.CriteriaReport(marked, ["_hit"], ["CHROM", "POS"])
    # As after a stage that ran twice: more rows were seen than there are.
    twice = report.CriteriaReport(marked.unionByName(marked), ["_hit"], ["CHROM", "POS"])
    twice.rows.collect()
    assert twice.result(10, 6)["n_rows"] == 10
    watched.seen = twice.seen
    counts = watched.result(5, 3)
    assert (counts["n_rows"], counts["n_hit"], counts["n_any"], counts["last_left_out_hit"]) == (5, 3, 3, "chr1:20")


@pytest.mark.filterwarnings("ignore::UserWarning")
def test_cutoff_of_a_cohort(spark, tmp_path):
    sites = [[("1", 1), ("1", 2), ("1", 3)], [("1", 1), ("1", 2)], [("1", 1)]]
    paths = []
    for i, rows in enumerate(sites):
        df = spark.createDataFrame([(*row, "A", "C", f"F{i}") for row in rows], "CHROM string, POS long, REF string, ALT string, family string")
        paths.append(str(tmp_path / f"d{i}"))
        write_dataset(df, paths[-1])
    about = read_sidecar(spark, run_cohort(spark, paths, str(tmp_path / "cohort"), cutoff=3))
    assert about["variants_by_row_count"] == {"1": 1, "2": 1} and about["source_datasets"] == 3
    cut = about["cutoff"]
    assert (cut["below"], cut["n_variants"], cut["n_retained"], round(cut["pct_retained"], 3)) == (3, 3, 2, 66.667)
    assert "cutoff" not in read_sidecar(spark, run_cohort(spark, paths, str(tmp_path / "all")))

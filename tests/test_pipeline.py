import csv
import glob

import pytest
from pyspark.sql import functions as F

from variantry.config import PipelineConfig, Rule
from variantry.operators import report
from variantry.operators.collapse import collapse
from variantry.operators.membership import mark_criteria
from variantry.operators.validate import ValidationError
from variantry.plans.pipeline import filter_and_collapse, ingest, ingest_table, run_cohort, run_collapse, run_narrow
from variantry.session import scratch_path
from variantry.sources.tables import read_dataset, read_sidecar

HEADER = ["SAMPLE", "CHROM", "POS", "REF", "ALT", "FORMAT['SAOBS']", "FORMAT['AF']", "ANN['MAX_AF']", "ANN['SYMBOL']", "ANN['Feature']", "ID"]
FAM1 = [
    ["s1", "chr1", "100", "A", "C", "o", "0.5", "0.1", "G1", "t1", "."],
    ["s1", "chr1", "100", "A", "C", "o", "0.5", "0.1", "G2", "t2", "."],
    ["s1", "chr1", "200", "A", "C", "o", "0.5", "0.9", "G1", "t1", "rs1"],
    ["s1", "chr1", "300", "A", "C", "o", "1.0", ".", "G3", "t3", "rs2;rs3"],
    ["s1", "chr1", "400", "A", "C", "", "1.0", "", "G3", "t3", "rs2"],
]
FAM2 = [
    ["s2", "chr1", "100", "A", "C", "p", "0.25", "0.1", "G1", "t1", "."],
    ["s2", "chr2", "500", "A", "C", "p", "0.25", "0.2", "G9", "t1", "rs9"],
]
DUPLICATED = [*FAM2, ["s2", "chr2", "500", "A", "C", "q", "0.75", "0.2", "G9", "t1", "rs9"]]
DTYPES = {"POS": "int64", "FORMAT['AF']": "float64", "ANN['MAX_AF']": "float64"}
CONFIG = PipelineConfig({"FILTERS": {"ANN['MAX_AF']": "<=:0.2"}, "COLUMN_MANAGEMENT": {"drop_columns": ["ANN['Feature']"]}})


def tsv(path, rows):
    path.write_text("\n".join("\t".join(row) for row in [HEADER, *rows]) + "\n")
    return str(path)


def exported(path):
    rows = []
    for part in sorted(glob.glob(f"{path}/part-*")):
        with open(part, newline="") as handle:
            rows += list(csv.DictReader(handle, delimiter="\t"))
    return rows


def test_from_tsv_to_narrowed_cohort(spark, tmp_path):
    collapsed = []
    for name, rows in (("fam1", FAM1), ("fam2", FAM2)):
        typed = str(tmp_path / f"{name}.typed")
        record = ingest(spark, [tsv(tmp_path / f"{name}.x.tsv", rows)], typed, DTYPES)
        assert record["final_shape"] == [len(rows), len(HEADER) + 2]
        stored = read_dataset(spark, typed)
        assert stored.columns[:3] == ["family", "filename", "SAMPLE"]
        collapsed.append(run_collapse(spark, typed, CONFIG, tsv=str(tmp_path / f"{name}.out.tsv")))
    assert collapsed[0] == str(tmp_path / "fam1_filtered_pivoted")
    one = read_dataset(spark, collapsed[0])
    assert {(r.POS, r["ANN['SYMBOL']"], r["ANN['MAX_AF']"], r["FORMAT['AF']"]) for r in one.collect()} == {
        (100, "G1;G2", 0.1, 0.5), (300, "G3", None, 1.0)
    }
    assert "ANN['Feature']" not in one.columns and one.columns[-1] == "SOURCE_DATASET"
    about = read_sidecar(spark, collapsed[0])
    assert (about["original_rows"], about["filtered_rows"], about["final_rows"]) == (5, 4, 2)
    assert about["value_types"] == {"FORMAT['AF']": "double", "ANN['MAX_AF']": "double"}
    lines = exported(tmp_path / "fam1.out.tsv")
    assert [(r["POS"], r["FILENAME"], r["filename"], r["ANN['MAX_AF']"]) for r in lines] == [
        ("100", "fam1.x", "fam1.x.tsv", "0.1"), ("300", "fam1.x", "fam1.x.tsv", ".")
    ]

    joint = run_cohort(spark, collapsed, str(tmp_path / "cohort"), columns="all", tsv=str(tmp_path / "cohort.tsv"))
    rows = {(r.CHROM, r.POS): r for r in read_dataset(spark, joint).collect()}
    assert set(rows) == {("chr1", 100), ("chr1", 300), ("chr2", 500)}
    shared = rows["chr1", 100]
    assert (shared["AF_fam1"], shared["AF_fam2"], shared["ROW_COUNT"]) == (0.5, 0.25, 2)
    # A joined cell is one value here, as in the collapsed dataset.
    assert shared["ANN['SYMBOL']"] == ["G1;G2", "G1"] and shared["family"] == ["fam1", "fam2"]
    assert read_sidecar(spark, joint)["total_variants"] == 3
    assert [r["ROW_COUNT"] for r in exported(tmp_path / "cohort.tsv")] == ["2", "1", "1"]

    (tmp_path / "genes.tsv").write_text("Symbol\tRSID\nG9\t\n\trs3\n")
    (tmp_path / "regions.bed").write_text("chr1\t90\t100\n")
    narrow = PipelineConfig(
        {"ADDITIONAL_ZARR_FILTERING": {"OUTPUT_DIR": str(tmp_path / "narrow"), "BED_FILE": str(tmp_path / "regions.bed"),
                                      "DROP_COLUMNS": ["ID"], "COLUMN_ORDER_START": ["ALT", "CHROM"]}}
    )
    kept = run_narrow(spark, collapsed[1], narrow, tsv=str(tmp_path / "narrow.tsv"))
    assert kept == str(tmp_path / "narrow" / "fam2_filtered_pivoted_add_filter")
    found = read_dataset(spark, kept)
    assert [r.POS for r in found.collect()] == [100] and "ID" not in found.columns
    assert list(exported(tmp_path / "narrow.tsv")[0])[:3] == ["ALT", "CHROM", "ANN['MAX_AF']"]
    narrow.raw["ADDITIONAL_ZARR_FILTERING"]["GENE_FILTER"] = str(tmp_path / "genes.tsv")
    both = run_narrow(spark, collapsed[1], narrow, str(tmp_path / "narrow2"))
    assert sorted(r.POS for r in read_dataset(spark, both).collect()) == [100, 500]
    about = read_sidecar(spark, both)
    assert (about["original_rows"], about["filtered_rows"], about["gene_filter_count"], about["rsid_filter_count"]) == (2, 2, 1, 1)


def test_many_files_collapse_side_by_side(spark, tmp_path):
    typed = str(tmp_path / "typed")
    files = [tsv(tmp_path / "fam1.x.tsv", FAM1), tsv(tmp_path / "fam2.x.tsv", FAM2), tsv(tmp_path / "fam3.x.tsv", FAM2)]
    ingest(spark, files, typed, DTYPES)
    stages = filter_and_collapse(read_dataset(spark, typed), CONFIG)
    found = {(r.filename, r.POS, r.SOURCE_DATASET) for r in stages.result.collect()}
    assert found == {
        ("fam1.x.tsv", 100, "fam1.x"), ("fam1.x.tsv", 300, "fam1.x"), ("fam2.x.tsv", 100, "fam2.x"),
        ("fam2.x.tsv", 500, "fam2.x"), ("fam3.x.tsv", 100, "fam3.x"), ("fam3.x.tsv", 500, "fam3.x"),
    }
    together = run_collapse(spark, typed, CONFIG, str(tmp_path / "out"))
    joint = read_dataset(spark, run_cohort(spark, [together], str(tmp_path / "cohort"), cutoff=3))
    assert {(r.CHROM, r.POS, r["AF_fam2"], r["AF_fam3"], r["ROW_COUNT"]) for r in joint.collect()} == {
        ("chr1", 300, None, None, 1), ("chr2", 500, 0.25, 0.25, 2)
    }


def test_duplicates_stop_or_are_set_aside(spark, tmp_path):
    typed = str(tmp_path / "typed")
    ingest(spark, [tsv(tmp_path / "fam2.x.tsv", DUPLICATED)], typed, DTYPES)
    with pytest.raises(ValidationError, match="POS=500"):
        run_collapse(spark, typed, CONFIG)
    assert not glob.glob(str(tmp_path / "typed_filtered_pivoted"))
    out = run_collapse(spark, typed, CONFIG, remove_validation_errors=True, quarantine_path=str(tmp_path / "bad.tsv"))
    assert [r.POS for r in read_dataset(spark, out).collect()] == [100]
    assert sorted(r["FORMAT['SAOBS']"] for r in exported(tmp_path / "bad.tsv")) == ["p", "q"]


def test_bad_inputs(spark, tmp_path):
    good = tsv(tmp_path / "fam1.x.tsv", FAM1)
    with pytest.raises(ValueError, match="none.tsv"):
        ingest(spark, [good, str(tmp_path / "none.tsv")], str(tmp_path / "o"))
    with pytest.raises(ValueError, match="x.csv"):
        ingest(spark, [good, str(tmp_path / "x.csv")], str(tmp_path / "o"))
    assert not glob.glob(str(tmp_path / "o"))


def test_one_table(spark, tmp_path):
    df = spark.createDataFrame([("s", "7")], "SAMPLE string, POS string")
    ingest_table(df, "/data/fam7.calls.vcf", str(tmp_path / "d"), {"POS": "int64"})
    assert tuple(read_dataset(spark, str(tmp_path / "d")).first()) == ("fam7", "fam7.calls.vcf", "s", 7)


def test_reports(spark):
    df = spark.createDataFrame([(1, "0.1", "a"), (2, ".", "b"), (3, None, "a"), (4, "x", None), (5, "0.3", "c")], "id int, AF string, t string")
    rows = report.filter_diagnostics(df, [Rule("AF", "<=", 0.2), Rule("t", "!=", "a")]).collect()
    assert tuple(rows[0])[2:] == (5, 2, 3, 2, 1, 3, 3, 2)
    assert tuple(rows[1])[2:] == (5, 1, 4, 0, 3, 3, 1, 0)
    assert [tuple(r) for r in report.value_profile(df, "t", 2).collect()] == [("a", 2), ("b", 1)]
    assert [tuple(r) for r in report.null_profile(df, ["AF", "t"]).collect()] == [("AF", 2), ("t", 1)]
    empty = report.kept_report(df.limit(0), F.lit(True)).first()
    assert tuple(empty) == (0, 0, 0, 0.0)
    kept = report.kept_report(df, F.col("id") > 1).first()
    assert tuple(kept) == (5, 4, 1, 20.0)
    sites = spark.createDataFrame([("1", i) for i in range(10)], "CHROM string, POS long")
    marked, flags = mark_criteria(sites, regions=spark.createDataFrame([("1", 0, 4)], "chrom string, start long, end long"))
    shown = report.examples(marked, flags[0]).collect()
    assert [r[flags[0]] for r in shown] == [True] * 3 + [False] * 3
    summary = report.stage_summary(sites, sites.where("POS > 1"), collapse(sites.withColumn("v", F.lit("x")), ["CHROM"])).first()
    assert tuple(summary) == (10, 8, 1, 90.0)


def test_scratch_is_the_folder_the_session_names(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(f"{root}/x-") and a != b


def test_command_line(spark, tmp_path):
    from variantry.__main__ import main

    (tmp_path / "config.yaml").write_text("FILTERS:\n  \"ANN['MAX_AF']\": \"<=:0.2\"\n")
    (tmp_path / "dtypes.csv").write_text("column_name,dtype\nPOS,int64\nFORMAT['AF'],float64\n")
    (tmp_path / "genes.tsv").write_text("Gene Symbol\nG1\n")
    listed = []
    for name, rows in (("fam1", FAM1), ("fam2", FAM2)):
        typed, out = str(tmp_path / name), str(tmp_path / f"{name}.collapsed")
        main(["ingest", tsv(tmp_path / f"{name}.x.tsv", rows), "--output", typed, "--dtypes", str(tmp_path / "dtypes.csv")])
        main(["collapse", typed, "--config", str(tmp_path / "config.yaml"), "--output", out, "--genes", str(tmp_path / "genes.tsv")])
        listed.append(out)
    (tmp_path / "list.txt").write_text("# datasets\n" + "\n".join(listed) + "\n")
    main(["cohort", "--file-list", str(tmp_path / "list.txt"), "--output", str(tmp_path / "c"), "--row-count-only"])
    assert [tuple(r) for r in read_dataset(spark, str(tmp_path / "c")).collect()] == [("chr1", 100, "A", "C", 2)]
    main(["cohort", "--datasets", *listed, "--output", str(tmp_path / "c2"), "--row-count-cutoff", "2"])
    assert read_dataset(spark, str(tmp_path / "c2")).count() == 0
    main(["narrow", listed[0], "--config", str(tmp_path / "config.yaml"), "--output", str(tmp_path / "n")])
    assert read_dataset(spark, str(tmp_path / "n")).count() == 1

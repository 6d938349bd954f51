"""Command line: `spark-submit` this module, or run it with `python -m variantry`."""

from __future__ import annotations

import argparse

from variantry.config import PipelineConfig
from variantry.plans.pipeline import ingest, ingest_table, run_cohort, run_collapse, run_narrow
from variantry.session import build_session
from variantry.sinks import export_tsv
from variantry.sources.lists import read_dtypes, read_genes, read_renames
from variantry.sources.tables import read_path_list
from variantry.sources.vcf import read_vcf


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="variantry")
    jobs = top.add_subparsers(dest="job", required=True)

    flatten = jobs.add_parser("flatten", help="VCF text to a typed dataset")
    flatten.add_argument("vcf")
    flatten.add_argument("output")
    flatten.add_argument("--dtypes")
    flatten.add_argument("--tsv")

    load = jobs.add_parser("ingest", help="annotation TSV and VCF files to one typed dataset, with the family of each file")
    load.add_argument("inputs", nargs="+")
    load.add_argument("--output", required=True)
    load.add_argument("--dtypes")
    load.add_argument("--renames")

    collapse = jobs.add_parser("collapse", help="filter a dataset and reduce it to one row per sample and variant")
    collapse.add_argument("dataset")
    collapse.add_argument("--config", required=True)
    collapse.add_argument("--output")
    collapse.add_argument("--genes")
    collapse.add_argument("--tsv")
    collapse.add_argument("--remove-validation-errors", action="store_true")
    collapse.add_argument("--quarantine")

    cohort = jobs.add_parser("cohort", help="combine collapsed datasets into one row per variant")
    source = cohort.add_mutually_exclusive_group(required=True)
    source.add_argument("--datasets", nargs="+")
    source.add_argument("--file-list")
    cohort.add_argument("--output", required=True)
    cohort.add_argument("--genes")
    cohort.add_argument("--tsv")
    cohort.add_argument("--keep-all-columns", action="store_true")
    cohort.add_argument("--row-count-only", action="store_true")
    cohort.add_argument("--row-count-cutoff", type=int)

    narrow = jobs.add_parser("narrow", help="keep listed genes, rsIDs and regions")
    narrow.add_argument("dataset")
    narrow.add_argument("--config", required=True)
    narrow.add_argument("--output")
    narrow.add_argument("--tsv")
    return top


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = build_session(f"variantry {args.job}")
    genes = read_genes(spark, args.genes) if getattr(args, "genes", None) else None
    if args.job == "flatten":
        table = read_vcf(spark, args.vcf)
        ingest_table(table, args.vcf, args.output, read_dtypes(args.dtypes) if args.dtypes else None)
        if args.tsv:
            export_tsv(table, args.tsv, null_value="")
    elif args.job == "ingest":
        ingest(
            spark, args.inputs, args.output,
            read_dtypes(args.dtypes) if args.dtypes else None,
            read_renames(args.renames) if args.renames else None,
        )
    elif args.job == "collapse":
        run_collapse(
            spark, args.dataset, PipelineConfig.from_yaml(args.config), args.output, genes,
            args.remove_validation_errors, args.quarantine, args.tsv,
        )
    elif args.job == "cohort":
        datasets = args.datasets or read_path_list(spark, args.file_list)
        run_cohort(
            spark, datasets, args.output, genes, "all" if args.keep_all_columns else "default",
            args.row_count_only, args.row_count_cutoff, args.tsv,
        )
    else:
        run_narrow(spark, args.dataset, PipelineConfig.from_yaml(args.config), args.output, args.tsv)


if __name__ == "__main__":
    main()

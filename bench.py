"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Every query runs once to
warm up and then BENCH_RUNS times; the fastest run counts.

The given lineitem table is one small file, which one task reads. Before anything is timed it is
written once as FILES files, as tables of a size worth distributing are stored; rows are the same.
"""

from __future__ import annotations

import json
import os
import time

from variantry.plans.catalogue import QUERIES
from variantry.session import build_session, scratch_path

FILES = 32
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

HEADLINE = [
    "filter_freq_keep_null",
    "filter_conjunction",
    "gene_semi",
    "rsid_semi_joined",
    "region_semi",
    "criteria_or",
    "collapse_joined",
    "collapse_first_seen",
    "filter_and_collapse_job",
    "duplicate_keys",
    "quarantine_rows",
    "row_count_only",
    "row_count_cutoff",
    "family_af_pivot",
    "cohort_default",
    "cohort_all_columns",
    "cohort_below_cutoff",
    "vcf_flatten",
    "flagship",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    tables = scratch_path(spark, "bench")
    for name in TABLES:
        table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        (table.repartition(FILES) if name == "lineitem" else table).write.parquet(f"{tables}/{name}.parquet")
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, tables).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(min(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "input_rows": rows,
                "input_files": FILES,
                "rows_per_sec": {name: round(rows / value) for name, value in seconds.items()},
            }
        )
    )


if __name__ == "__main__":
    main()

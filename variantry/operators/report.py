"""Counts that describe what a step did, each in one pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from variantry.config import Rule
from variantry.functions.predicates import condition, is_frequency, predicate, present_rules
from variantry.functions.schema import resolve
from variantry.functions.text import as_number, col, is_missing
from variantry.names import ROW_COUNT


def percentage(part: Column, whole: Column) -> Column:
    """Part of whole in percent; 0 of nothing is 0."""
    return F.when(whole > 0, part * 100.0 / whole).otherwise(0.0)


def value_profile(df: DataFrame, name: str, top: int = 10) -> DataFrame:
    """The most frequent values of a column; equally frequent ones in value order."""
    counts = df.where(col(name).isNotNull()).groupBy(col(name).cast("string").alias("value"))
    return counts.agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.desc("n_rows"), "value").limit(top)


def value_profiles(df: DataFrame, names: list[str], top: int = 10) -> DataFrame:
    """`value_profile` of several columns in one pass: `(column_name, rank, value, n_rows)`.

    Counts are combined before the shuffle, and only the first `top` of each column leave a task for the last step.
    """
    cells = [F.struct(F.lit(name).alias("column_name"), col(name).cast("string").alias("value")) for name in names]
    counts = df.select(F.inline(F.array(*cells))).dropna().groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n_rows"))
    order = Window.partitionBy("column_name").orderBy(F.desc("n_rows"), "value")
    ranked = counts.select("column_name", F.row_number().over(order).alias("rank"), "value", "n_rows")
    return ranked.where(F.col("rank") <= top)


def null_profile(df: DataFrame, names: list[str]) -> DataFrame:
    """How many cells of each column are null or marked as missing."""
    counts = [F.count_if(is_missing(col(name))).alias(str(i)) for i, name in enumerate(names)]
    entries = F.array(
        *[F.struct(F.lit(name).alias("column_name"), F.col(str(i)).alias("n_missing")) for i, name in enumerate(names)]
    )
    return df.agg(*counts).select(F.inline(entries))


def filter_diagnostics(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per rule: rows in all, missing, not missing, numeric, passing its comparison, kept,
    and kept by all rules up to it, with how many of those lack a value."""
    rules = present_rules(df, rules)
    measures, entries, passed = [], [], F.lit(True)
    for i, rule in enumerate(rules):
        name = resolve(df, rule.column)
        missing = is_missing(col(name))
        kept = predicate(rule, df)
        passed = passed & kept
        counted = {
            "n_missing": missing,
            "n_valid": ~missing,
            "n_numeric": as_number(df, name).isNotNull(),
            "n_matching": condition(df, name, rule, is_frequency(name)),
            "n_kept": kept,
            "n_remaining": passed,
            "n_missing_preserved": passed & missing,
        }
        measures += [F.count_if(test).alias(f"{label}_{i}") for label, test in counted.items()]
        entries.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(f"{rule.operator}:{rule.value}").alias("rule"),
                F.col("n_rows").alias("n_rows"),
                *[F.col(f"{label}_{i}").alias(label) for label in counted],
            )
        )
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *measures).select(F.inline(F.array(*entries)))


def kept_report(df: DataFrame, kept: Column) -> DataFrame:
    """Original, kept and removed rows, and the removed share."""
    counted = df.agg(F.count(F.lit(1)).alias("n_original"), F.count_if(kept).alias("n_kept"))
    removed = F.col("n_original") - F.col("n_kept")
    return counted.select(
        "n_original", "n_kept", removed.alias("n_removed"), percentage(removed, F.col("n_original")).alias("pct_removed")
    )


def _criteria_measures(flags: list[str]) -> list[Column]:
    any_of = reduce(lambda a, b: a | b, [F.col(flag) for flag in flags])
    return [
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(flag)).alias(f"n{flag}") for flag in flags],
        F.count_if(any_of).alias("n_any"),
    ]


def _criteria_examples(flags: list[str], shown: list[str]) -> list[Column]:
    """The first and last rows, as text, that meet each criterion and that do not."""
    text = F.concat_ws(":", *[col(name).cast("string") for name in shown])
    tests = [(f"kept{flag}", F.col(flag)) for flag in flags] + [(f"left_out{flag}", ~F.col(flag)) for flag in flags]
    ends = (("first", F.min), ("last", F.max))
    return [pick(F.when(test, text)).alias(f"{end}_{name}") for name, test in tests for end, pick in ends]


def criteria_counts(marked: DataFrame, flags: list[str]) -> DataFrame:
    """Rows in all, rows meeting each criterion, rows meeting any."""
    return marked.agg(*_criteria_measures(flags))


class CriteriaReport:
    """Counts and examples of criteria, gathered while their rows are written.

    `rows` are the marked rows, to be written instead of them. `result` must be called after that, with the row counts that
    the files show. A stage that runs again for a lost executor may be counted twice; then the counts do not agree with the
    files, and the rows are counted once more by a query of their own.
    """

    def __init__(self, marked: DataFrame, flags: list[str], shown: list[str]):
        self.measures = [*_criteria_measures(flags), *_criteria_examples(flags, shown)]
        self.marked, self.seen = marked, Observation()
        self.rows = marked.observe(self.seen, *self.measures)

    def result(self, rows_before: int, rows_after: int) -> dict:
        seen = self.seen.get
        if (seen.get("n_rows"), seen.get("n_any")) == (rows_before, rows_after):
            return seen
        return self.marked.agg(*self.measures).first().asDict()


def stage_summary(original: DataFrame, filtered: DataFrame, collapsed: DataFrame) -> DataFrame:
    """Rows before, after the rules and after the collapse, and the total reduction."""
    stages = {"n_original": original, "n_filtered": filtered, "n_collapsed": collapsed}
    counts = [
        frame.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("stage"), "n") for name, frame in stages.items()
    ]
    joined = reduce(DataFrame.unionByName, counts).agg(
        *[F.max(F.when(F.col("stage") == name, F.col("n"))).alias(name) for name in stages]
    )
    removed = F.col("n_original") - F.col("n_collapsed")
    return joined.withColumn("pct_reduction", percentage(removed, F.col("n_original")))


def cohort_totals(counts: DataFrame, cutoff: int) -> DataFrame:
    """Variants in all, variants below the cutoff, and their share."""
    totals = counts.agg(
        F.count(F.lit(1)).alias("n_variants"), F.count_if(F.col(ROW_COUNT) < cutoff).alias("n_retained")
    )
    return totals.withColumn("pct_retained", percentage(F.col("n_retained"), F.col("n_variants")))


def examples(marked: DataFrame, flag: str, count: int = 3) -> DataFrame:
    """A few rows that meet a criterion and a few that do not."""
    kept = marked.where(F.col(flag)).limit(count)
    return kept.unionByName(marked.where(~F.col(flag)).limit(count))


def families(df: DataFrame) -> DataFrame:
    """The families present, sorted."""
    return df.select("family").distinct().orderBy("family")

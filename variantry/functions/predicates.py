"""Configured rules as null-aware Spark predicates."""

from __future__ import annotations

import operator
import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from variantry.config import ORDERING, ConfigError, Rule
from variantry.functions.schema import resolve
from variantry.functions.text import as_number, as_truth, col, is_missing

_COMPARE = {"<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}


def is_frequency(name: str) -> bool:
    """Whether a column holds frequencies, where no value means a novel variant."""
    return "AF" in name.upper() or "freq" in name.lower()


def _comparable(df: DataFrame, name: str, rule: Rule, frequency: bool) -> Column:
    """The column in the type of the rule's values."""
    values = rule.values
    if any(isinstance(value, bool) for value in values):
        return as_truth(df, name)
    if frequency or all(isinstance(value, (int, float)) for value in values):
        return as_number(df, name)
    return col(name).cast("string")


def _literals(rule: Rule, frequency: bool) -> list:
    """The values a cell can equal; a text never equals a frequency."""
    values = rule.values
    if frequency:
        values = [value for value in values if isinstance(value, (int, float))]
    elif not all(isinstance(value, (int, float)) for value in values):
        values = [str(value) for value in values]
    return values


def condition(df: DataFrame, name: str, rule: Rule, frequency: bool) -> Column:
    """The bare comparison: true or false, never null.

    A null cell fails every test but the negative ones, which it passes.
    """
    no = F.lit(False)
    if rule.operator in ("contains", "not_contains"):
        found = F.coalesce(col(name).cast("string").rlike(str(rule.value)), no)
        return found if rule.operator == "contains" else ~found
    x = _comparable(df, name, rule, frequency)
    if rule.operator in ORDERING:
        if frequency and not isinstance(rule.value, (int, float)):
            raise ConfigError(f"cannot order frequencies in {name!r} by {rule.value!r}")
        return F.coalesce(_COMPARE[rule.operator](x, F.lit(rule.value)), no)
    values = _literals(rule, frequency)
    member = F.coalesce(x.isin(*values), no) if values else no
    return member if rule.operator in ("==", "in") else ~member


def predicate(rule: Rule, df: DataFrame, frequency: bool | None = None) -> Column:
    """A rule as a predicate on `df`; frequency columns also keep rows without a value."""
    name = resolve(df, rule.column)
    if name is None:
        raise ConfigError(f"column {rule.column!r} is not in the data")
    frequency = is_frequency(name) if frequency is None else frequency
    test = condition(df, name, rule, frequency)
    return test | is_missing(col(name)) if frequency else test


def _native(df: DataFrame, name: str, rule: Rule) -> bool:
    """Whether the stored type of a column compares with the rule's values as it is."""
    kind, values = df.schema[name].dataType, rule.values
    if any(isinstance(value, bool) for value in values):
        return isinstance(kind, T.BooleanType) and all(isinstance(value, bool) for value in values)
    if all(isinstance(value, (int, float)) for value in values):
        return isinstance(kind, T.NumericType)
    return isinstance(kind, T.StringType) and all(isinstance(value, str) for value in values)


def row_filter(rule: Rule, df: DataFrame, frequency: bool | None = None) -> Column:
    """`predicate` as a filter: the same rows, in a form that reaches the reader of a stored table.

    Null counts as false in a filter, so a column of the rule's own type is compared bare.
    NaN, which Spark ranks above all numbers and which means no value, is told apart by that.
    """
    name = resolve(df, rule.column)
    if name is None or rule.operator in ("contains", "not_contains") or not _native(df, name, rule):
        return predicate(rule, df, frequency)
    frequency = is_frequency(name) if frequency is None else frequency
    kind = df.schema[name].dataType
    if frequency and not isinstance(kind, T.NumericType):
        return predicate(rule, df, frequency)
    x, floating = col(name), isinstance(kind, (T.DoubleType, T.FloatType))
    above_all = x > F.lit(float("inf"))
    if rule.operator in ORDERING:
        test = _COMPARE[rule.operator](x, F.lit(rule.value))
        if floating and rule.operator in (">", ">=") and not frequency:
            test = test & ~F.isnan(x)
    else:
        equal = x == F.lit(rule.values[0]) if len(rule.values) == 1 else x.isin(*rule.values)
        test = equal if rule.operator in ("==", "in") else x.isNull() | ~equal
    if frequency:
        test = test | x.isNull()
        return test | above_all if floating else test
    return test


def present_rules(df: DataFrame, rules: list[Rule]) -> list[Rule]:
    """The rules whose column exists; the others are reported and skipped."""
    kept = []
    for rule in rules:
        if resolve(df, rule.column) is None:
            warnings.warn(f"column {rule.column!r} not found, its rule is skipped", stacklevel=2)
        else:
            kept.append(rule)
    return kept


def apply_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Keep the rows that pass every rule, in one filter."""
    tests = [row_filter(rule, df) for rule in present_rules(df, rules)]
    return df.where(reduce(operator.and_, tests)) if tests else df

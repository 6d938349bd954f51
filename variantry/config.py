"""Pipeline configuration: a YAML file turned into rules and column lists."""

from __future__ import annotations

import re
import warnings
from dataclasses import dataclass, field
from typing import Any

import yaml

from variantry.sources.files import whole_text

# The operators a rule may use.
ORDERING = ("<", "<=", ">", ">=")
OPERATORS = ("==", "!=", *ORDERING, "in", "not_in", "contains", "not_contains")


class ConfigError(ValueError):
    """The configuration cannot be turned into a plan."""


@dataclass(frozen=True)
class Rule:
    """One condition on one column."""

    column: str
    operator: str
    value: Any

    def __post_init__(self):
        if self.operator not in OPERATORS:
            raise ConfigError(f"unknown operator {self.operator!r} for column {self.column!r}")
        several = isinstance(self.value, (list, tuple))
        if several and self.operator not in ("in", "not_in"):
            raise ConfigError(f"operator {self.operator!r} takes one value, column {self.column!r}")

    @property
    def values(self) -> list:
        return list(self.value) if isinstance(self.value, (list, tuple)) else [self.value]


def parse_value(text: str) -> Any:
    """Digits become numbers, true/false become booleans, the rest stays text."""
    stripped = text.strip()
    if re.fullmatch(r"[+-]?\d+", stripped):
        return int(stripped)
    if re.fullmatch(r"[+-]?(\d+\.\d*|\.\d+|\d+)([eE][+-]?\d+)?", stripped):
        return float(stripped)
    if re.fullmatch(r"[\d.\-]*\d[\d.\-]*", stripped):
        raise ConfigError(f"malformed number {text!r}")
    if stripped.lower() in ("true", "false"):
        return stripped.lower() == "true"
    return text


def parse_rules(filters: dict[str, Any] | None) -> list[Rule]:
    """Rules from `{column: "operator:value"}` or `{column: {operator, value}}`."""
    rules = []
    for column, definition in (filters or {}).items():
        if isinstance(definition, dict):
            rules.append(Rule(column, definition["operator"], definition["value"]))
            continue
        operator, colon, value = str(definition).partition(":")
        if not colon:
            warnings.warn(f"rule {definition!r} for {column!r} has no ':' and is ignored", stacklevel=2)
            continue
        rules.append(Rule(column, operator, parse_value(value)))
    return rules


def column_list(value: Any) -> list[str]:
    """A YAML list or a comma-separated text as trimmed names without repeats."""
    if not value:
        return []
    parts = value.split(",") if isinstance(value, str) else value
    names = (str(part).strip() for part in parts)
    return list(dict.fromkeys(name for name in names if name))


@dataclass(frozen=True)
class PipelineConfig:
    """Read access to the parts of the configuration that shape results."""

    raw: dict = field(default_factory=dict)

    @classmethod
    def from_yaml(cls, path: str) -> PipelineConfig:
        return cls(yaml.safe_load(whole_text(path)) or {})

    def get(self, key_path: list[str], fallback: Any = None) -> Any:
        """The value under nested keys, or the fallback if any key is missing."""
        value: Any = self.raw
        for key in key_path:
            try:
                value = value[key]
            except (KeyError, TypeError, IndexError):
                return fallback
        return value

    @property
    def rules(self) -> list[Rule]:
        return parse_rules(self.get(["FILTERS"]))

    @property
    def drop_columns(self) -> list[str]:
        """Columns to drop before collapsing, from either of the two places."""
        names = column_list(self.get(["COLUMN_MANAGEMENT", "drop_columns"]))
        names += column_list(self.get(["DROP_COLUMNS", "columns"]))
        return list(dict.fromkeys(names))

    @property
    def narrow_drop_columns(self) -> list[str]:
        return column_list(self.get(["ADDITIONAL_ZARR_FILTERING", "DROP_COLUMNS"]))

    @property
    def column_order_start(self) -> list[str]:
        return column_list(self.get(["ADDITIONAL_ZARR_FILTERING", "COLUMN_ORDER_START"]))

    @property
    def output_dir(self) -> str | None:
        return self.get(["ADDITIONAL_ZARR_FILTERING", "OUTPUT_DIR"])

    @property
    def gene_filter(self) -> str | None:
        return self.get(["ADDITIONAL_ZARR_FILTERING", "GENE_FILTER"])

    @property
    def bed_file(self) -> str | None:
        return self.get(["ADDITIONAL_ZARR_FILTERING", "BED_FILE"])

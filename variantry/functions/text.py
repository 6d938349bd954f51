"""Column expressions for cells: names, missing marks, tokens and text forms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from variantry.names import MISSING_MARKS

# Fixed value: the characters that separate several entries in one cell.
CELL_DELIMITERS = "[;,|&]"
WHITESPACE = " \t\n\r\f\x0b"


def quoted(name: str) -> str:
    """A column name as SQL; it may hold quotes, dots and brackets."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """A column by its exact name."""
    return F.col(quoted(name))


# A cast that fails costs an exception per cell, so texts are matched first. The
# patterns also keep out "1.5f" and "2d", which Java reads as numbers.
NUMBER = r"^\s*[-+]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][-+]?[0-9]+)?\s*$|^\s*[-+]?([iI]nf|[iI]nfinity)\s*$"
WHOLE_NUMBER = r"^\s*[-+]?[0-9]{1,19}\s*$"
TRUE_TEXTS = ("t", "true", "y", "yes", "1")
FALSE_TEXTS = ("f", "false", "n", "no", "0")


def as_number(df: DataFrame, name: str) -> Column:
    """A column as a double; whatever is not a number, NaN included, becomes null."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return F.when(col(name).rlike(NUMBER), col(name)).try_cast("double")
    value = col(name).try_cast("double")
    return F.when(~F.isnan(value), value) if isinstance(kind, (T.DoubleType, T.FloatType)) else value


def as_whole_number(df: DataFrame, name: str) -> Column:
    """A column as a whole number; null where a text is anything else."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.when(col(name).rlike(WHOLE_NUMBER), col(name)).try_cast("bigint")
    return col(name).try_cast("bigint")


def as_truth(df: DataFrame, name: str) -> Column:
    """A column as a boolean; null where a text means neither."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.BooleanType):
        return col(name)
    if isinstance(kind, T.NumericType):
        return as_number(df, name) != 0
    text = F.lower(F.trim(col(name).cast("string")))
    return F.when(text.isin(*TRUE_TEXTS), True).when(text.isin(*FALSE_TEXTS), False)


def is_missing(value: Column) -> Column:
    """Null, NaN, or one of the marks for "no value"; never null itself."""
    text = value.cast("string")
    return text.isNull() | text.isin(*MISSING_MARKS, "NaN")


def tokens(cell: Column) -> Column:
    """The non-empty trimmed entries of a cell; no entries if the cell is missing."""
    parts = F.transform(F.split(cell, CELL_DELIMITERS), lambda part: F.trim(part, F.lit(WHITESPACE)))
    return F.when(cell.isin("", "."), F.array().cast("array<string>")).otherwise(
        F.filter(parts, lambda part: part != "")
    )


# Python's notation of a double out of Java's, which has an exponent from 1e7 on and
# below 1e-3 where Python has one from 1e16 on and below 1e-4. Expressions are SQL
# texts: on a wide table, building them call by call would take longer than the job.
_DOUBLE_TEXT = """
case
  when {java} = 'Infinity' then 'inf'
  when {java} = '-Infinity' then '-inf'
  when {java} = 'NaN' then null
  when {power} = -4 then concat({sign}, '0.000', {digits})
  when {power} between 7 and 15 and length({digits}) <= {power} + 1
    then concat({sign}, rpad({digits}, {power} + 1, '0'), '.0')
  when {power} between 7 and 15
    then concat({sign}, substring({digits}, 1, {power} + 1), '.', substring({digits}, {power} + 2))
  else concat({sign}, {lead}, if({rest} = '', '', concat('.', {rest})), if({power} < 0, 'e-', 'e+'),
    lpad(abs({power}), greatest(2, length(abs({power}))), '0'))
end"""


def double_text_sql(value: str) -> str:
    """Most doubles have Java's text. The rules for the others stand in a function, as a method that holds them is too long to be compiled."""
    plain = f"{value} = 0 or abs({value}) >= 0.001 and abs({value}) < 10000000"
    return f"if({plain}, cast({value} as string), get(transform(array(cast({value} as string)), _java -> {_odd_double_text('_java')}), 0))"


def _odd_double_text(java: str) -> str:
    lead = f"regexp_extract({java}, '^-?([0-9])[.]', 1)"
    rest = f"regexp_replace(regexp_extract({java}, '[.]([0-9]+)E', 1), '^0$', '')"
    return _DOUBLE_TEXT.format(
        java=java,
        lead=lead,
        rest=rest,
        digits=f"concat({lead}, {rest})",
        sign=f"if(startswith({java}, '-'), '-', '')",
        power=f"try_cast(regexp_extract({java}, 'E(-?[0-9]+)$', 1) as int)",
    )


def text_sql(value: str, data_type: T.DataType, separator: str = ";") -> str:
    """SQL for the text a value has in an export: `True`, `0.2`, `a;b`."""
    if isinstance(data_type, T.StringType):
        return value
    if isinstance(data_type, T.BooleanType):
        return f"case when {value} then 'True' when not {value} then 'False' end"
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return double_text_sql(f"cast({value} as double)")
    if isinstance(data_type, T.ArrayType):
        parts = f"transform({value}, item -> {text_sql('item', data_type.elementType)})"
        return f'case when size({value}) > 0 then array_join({parts}, "{separator}") end'
    return f"cast({value} as string)"


def text_of(name: str, data_type: T.DataType) -> Column:
    """A column as the text it has in an export."""
    return F.expr(text_sql(quoted(name), data_type))

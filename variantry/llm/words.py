"""Expressions on texts that several operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that part words, and a word.
SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def text_of(text: Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(text, F.lit(""))


def without_spaces(text: Column) -> Column:
    return F.translate(text_of(text), SPACES, "")


def word_count(text: Column) -> Column:
    return F.regexp_count(text_of(text), F.lit(WORD)).cast("long")


def id_remainder(doc_id: Column, parts: int) -> Column:
    """CRC-32 of the id as text modulo `parts`; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts

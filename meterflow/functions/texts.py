"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Every character from NUL to the space: what counts as padding around ids and timestamps.
PADDING = "".join(chr(code) for code in range(0x21))


def control_trim(text: Column) -> Column:
    """Strip control characters and spaces at both ends (plain ``trim`` strips spaces only)."""
    return F.btrim(text, F.lit(PADDING))


def is_blank(text: Column) -> Column:
    return text.isNull() | (control_trim(text) == "")


def blank_to_null(text: Column) -> Column:
    trimmed = control_trim(text)
    return F.when(trimmed != "", trimmed)


def same_text(text: Column, literal: str) -> Column:
    """Case-insensitive equality with a constant."""
    return F.lower(text) == literal.lower()

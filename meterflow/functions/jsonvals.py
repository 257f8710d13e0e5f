"""Coercions of values taken from a JSON document."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_integer(text: Column, kind: str = "int") -> Column:
    """Whole part of a number in text form; 0 when present but not numeric."""
    found = F.coalesce(text.try_cast(kind), text.try_cast("double").try_cast(kind))
    return F.when(text.isNotNull(), F.coalesce(found, F.lit(0).cast(kind)))


def as_double(node: Column) -> Column:
    """A JSON number or numeric text as double; 0 when present but not numeric."""
    present = node.isNotNull() & ~F.is_variant_null(node)
    return F.when(present, F.coalesce(F.try_variant_get(node, "$", "double"), F.lit(0.0)))


def strict_number(node: Column) -> Column:
    """The value only when the JSON node is a number, not numeric text."""
    kind = F.schema_of_variant(node)
    is_number = kind.startswith("DECIMAL") | kind.isin("BIGINT", "DOUBLE", "FLOAT")
    return F.when(is_number, F.try_variant_get(node, "$", "double"))

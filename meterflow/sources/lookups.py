"""CSV readers of the two lookup tables.

Both add ``ordinal``, the read order, which decides among duplicate keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterflow.functions import blank_to_null
from meterflow.schemas import EVENT_CATALOGUE, NETWORK_HIERARCHY

BYTE_ORDER_MARK = "﻿"


def _read_order() -> F.Column:
    """File, then position of the split in the file, then row of the split."""
    return F.struct("_metadata.file_path", "_metadata.file_block_start",
                    F.monotonically_increasing_id().alias("row"))


def read_by_name(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Columns found by header name, trimmed, blanks as null, bad cells as null."""
    raw = spark.read.option("header", True).csv(path)
    names = {name.lstrip(BYTE_ORDER_MARK).strip(): name for name in raw.columns}
    pairs = [part.split(None, 1) for part in ddl.split(", ")]
    missing = [name for name, _ in pairs if name not in names]
    return raw.select(
        _read_order().alias("ordinal"),
        *[(F.lit(None) if name in missing else blank_to_null(F.col(f"`{names[name]}`")))
          .try_cast(kind).alias(name) for name, kind in pairs])


def read_by_position(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Columns by position without header; cells that do not fit the type become null."""
    rows = spark.read.schema(ddl).option("mode", "PERMISSIVE").csv(path)
    return rows.select(_read_order().alias("ordinal"), "*")


def event_catalogue(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    reader = read_by_name if header else read_by_position
    return reader(spark, path, EVENT_CATALOGUE)


def network_hierarchy(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    reader = read_by_name if header else read_by_position
    return reader(spark, path, NETWORK_HIERARCHY)

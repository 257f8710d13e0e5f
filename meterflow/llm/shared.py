"""Reading texts in Arrow batches and keeping intermediate tables in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from meterflow.session import scratch_path

# Document number of a null doc_id: null sorts behind every other document.
NO_ID = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Spark removes the shuffle files of a query as soon as it ends, not when the driver's garbage happens to be collected.
REMOVED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that end in here leave no shuffle files; for writes, whose rows are not asked for again."""
    before = spark.conf.get(REMOVED)
    spark.conf.set(REMOVED, "true")
    try:
        yield
    finally:
        spark.conf.set(REMOVED, before)


def staged(rows: DataFrame, label: str) -> DataFrame:
    """Write rows as Parquet to the folder all executors share and read them back.

    Cuts the lineage, so a lost executor costs a read and not a recomputation. Shuffle files of the write go with it.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, label)
    with shuffles_removed(spark):
        rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def text_bytes(column: str = "text") -> Column:
    """UTF-8 bytes of a text, null as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def named(names: Iterable[str]) -> list[Column]:
    """Columns by their very names, which may hold dots."""
    return [F.col(f"`{name}`") for name in names]


def document_number(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def with_key(docs: DataFrame) -> DataFrame:
    """``_doc`` and ``_digest``: together the identity of a document.

    Repeated rows (same id, same text) are one document and get one result each.
    """
    return docs.withColumns({
        "_doc": document_number(),
        "_digest": F.xxhash64(F.coalesce(F.col("text"), F.lit("")))})


# Texts of a batch that are worked on at once: what a function makes of them is handed on before the next.
PART_BYTES = 4 << 20


def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in stretches of rows of bounded text size, one row at least."""
    begin = size = 0
    for row, length in enumerate(pc.binary_length(batch.column("_text")).to_pylist()):
        if row > begin and size + length > PART_BYTES:
            yield batch.slice(begin, row - begin)
            begin, size = row, 0
        size += length
    yield batch.slice(begin)


def map_texts(
    rows: DataFrame, keep: list[str], schema: str,
    of_batch: Callable[[list[bytes]], Iterable[tuple]], text: str = "text",
) -> DataFrame:
    """One output row per input row: the kept columns and what ``of_batch`` says of its text.

    ``of_batch`` gets the UTF-8 texts of an Arrow batch and yields one tuple per text.
    """
    given = rows.select(*keep, text_bytes(text).alias("_text"))
    kept = StructType([given.schema[name] for name in keep])
    made = _parse_datatype_string(schema)
    whole = StructType(kept.fields + made.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(made)
        for batch in chain.from_iterable(map(parts, batches)):
            columns = list(zip(*of_batch(batch.column("_text").to_pylist())))
            arrays = [pa.array(values, field.type) for values, field in zip(columns, arrow)] \
                if columns else [pa.array([], field.type) for field in arrow]
            yield pa.RecordBatch.from_arrays(
                [batch.column(name) for name in keep] + arrays, names=whole.names)

    return given.mapInArrow(run, whole)


def explode_texts(
    rows: DataFrame, keep: list[str], schema: str,
    of_batch: Callable[[list[bytes]], tuple], text: str = "text",
) -> DataFrame:
    """Any number of output rows per input row.

    ``of_batch`` gets the UTF-8 texts of an Arrow batch and returns ``(owner, *columns)``: numpy or
    Arrow arrays of equal length, ``owner`` holding the place of each row's text in the batch.
    """
    given = rows.select(*keep, text_bytes(text).alias("_text"))
    kept = StructType([given.schema[name] for name in keep])
    made = _parse_datatype_string(schema)
    whole = StructType(kept.fields + made.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(made)
        for batch in chain.from_iterable(map(parts, batches)):
            owner, *columns = of_batch(batch.column("_text").to_pylist())
            places = pa.array(owner, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(name).take(places) for name in keep]
                + [values if isinstance(values, pa.Array) else pa.array(values, field.type)
                   for values, field in zip(columns, arrow)],
                names=whole.names)

    return given.mapInArrow(run, whole)

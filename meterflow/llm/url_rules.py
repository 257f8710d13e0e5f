"""Allow and block rules for addresses by a sort-merge sweep over reversed-host keys.

The canonical key of a host and a path is the host's labels in reverse, ``#``, and the path:
``org.example#/en/1``. A rule's key is a prefix of exactly the keys it covers, so each rule is an
interval of the key order and intervals are nested or disjoint. A rule also covers subdomains,
whose labels would stand between its host and its path; an address is therefore asked once for
each of its host's suffixes that is no longer than the longest rule host.

Rules and asked keys are range partitioned and sorted together. A sweep over each partition keeps
the open rules on a stack; the rules that are open where a partition starts are found from the
partitions' first keys.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterflow.llm.shared import staged
from meterflow.operators.skew import materialise

SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"
HIT = "host string, path string, rule string, verdict string, reach int"


def host_of(url: str = "url") -> Column:
    return F.translate(
        F.coalesce(F.regexp_extract(url, SPLIT, 1), F.lit("")), ascii_uppercase, ascii_lowercase)


def path_of(url: str = "url") -> Column:
    return F.coalesce(F.regexp_extract(url, SPLIT, 2), F.lit(""))


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules written as ``host/path`` with their verdicts, as a table."""
    return spark.createDataFrame(
        [(rule.partition("/")[0], "/" + rule.partition("/")[2], verdict)
         for rule, verdict in rules], "host string, path string, verdict string")


def _reversed(host: str = "host") -> Column:
    return F.reverse(F.split(host, r"\."))


def _starts(rules: DataFrame) -> DataFrame:
    """One row per distinct rule; of contradicting verdicts ``block`` holds."""
    host = F.translate("host", ascii_uppercase, ascii_lowercase)
    return (
        rules.where("host is not null and path is not null and verdict is not null")
        .select(host.alias("host"), "path", "verdict")
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
        .withColumns({
            "key": F.concat(F.array_join(_reversed(), "."), F.lit("#"), "path"),
            "rule": F.concat("host", "path")}))


def _points(asked: DataFrame, depth: int) -> DataFrame:
    labels = asked.withColumn("_labels", _reversed())
    return labels.select("host", "path", F.explode(F.transform(
        F.sequence(F.lit(1), F.least(F.size("_labels"), F.lit(depth))),
        lambda n: F.concat(
            F.array_join(F.slice("_labels", F.lit(1), n), "."), F.lit("#"), F.col("path")),
    )).alias("key"))


def _first_keys(placed: DataFrame) -> list[tuple[str, int]]:
    """First key and number of every partition that has rows, in key order."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("key")[0].as_py()]),
                     pa.array([TaskContext.get().partitionId()], pa.int32())], ["key", "part"])
                return

    # One row per partition.
    return sorted((row.key, row.part) for row in
                  placed.select("key").mapInArrow(first, "key string, part int").collect())


def _open_rules(starts: DataFrame, firsts: list[tuple[str, int]]) -> dict[int, list[tuple]]:
    """By partition, the rules that cover its first key: at most as many as rules nest."""
    keys = [key for key, _ in firsts]

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for row in batch.to_pylist():
                at = bisect_left(keys, row["key"])
                while at < len(keys) and keys[at].startswith(row["key"]):
                    found.append(row | {"part": firsts[at][1]})
                    at += 1
            yield pa.RecordBatch.from_pylist(found, pa.schema([
                ("key", pa.string()), ("rule", pa.string()), ("verdict", pa.string()),
                ("part", pa.int32())]))

    opened: dict[int, list[tuple]] = {}
    for row in starts.select("key", "rule", "verdict").mapInArrow(
            reach, "key string, rule string, verdict string, part int").collect():
        opened.setdefault(row.part, []).append((row.key, row.rule, row.verdict))
    return {part: sorted(rules) for part, rules in opened.items()}


def _sweep(placed: DataFrame, opened: dict[int, list[tuple]]) -> DataFrame:
    names = [field.split()[0] for field in HIT.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack = list(opened.get(TaskContext.get().partitionId(), ()))
        for batch in batches:
            found = []
            for key, host, path, rule, verdict in zip(
                    *(batch.column(n).to_pylist() for n in ("key", "host", "path", "rule", "verdict"))):
                while stack and not key.startswith(stack[-1][0]):
                    stack.pop()
                if rule is not None:
                    stack.append((key, rule, verdict))
                elif stack:
                    found.append((host, path, stack[-1][1], stack[-1][2], len(stack[-1][1])))
            columns = list(zip(*found)) if found else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.string()) for c in columns[:4]]
                + [pa.array(columns[4], pa.int32())], names)

    return placed.mapInArrow(run, HIT)


def matches(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """The longest fitting rule of each distinct ``host`` and ``path``; those without one are absent.

    Of fitting rules of equal length the one with the longer host wins.
    """
    spark = addresses.sparkSession
    starts = staged(_starts(rules), "rules")
    depth = starts.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0
    asked = addresses.select("host", "path").where("host != ''").distinct()
    both = _points(asked, depth).select(
        "key", F.lit(1).alias("kind"), "host", "path",
        F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"),
    ).union(starts.select("key", F.lit(0).alias("kind"), "host", "path", "rule", "verdict"))
    # A key that many hosts share may span partitions: host and path are part of the order.
    order = ["key", "kind", "host", "path"]
    placed = materialise(
        both.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
        .sortWithinPartitions(*order))
    hits = _sweep(placed, _open_rules(starts, _first_keys(placed)))
    longest = F.struct("reach", F.length(F.substring_index("rule", "/", 1)), "rule")
    return hits.groupBy("host", "path").agg(
        F.max_by("rule", longest).alias("rule"), F.max_by("verdict", longest).alias("verdict"))


def judge(
    pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow",
) -> DataFrame:
    """``host``, ``path``, ``rule`` and ``verdict`` beside the columns of the pages.

    Addresses that are null or have no ``://`` have an empty host and path; they, and all that no
    rule fits, get a null rule and the default verdict. Columns of the pages with one of the
    four names are replaced. Repeated rows stay.
    """
    made = ["host", "path", "rule", "verdict"]
    kept = [name for name in pages.columns if name not in made]
    marked = pages.withColumns({"_host": host_of(url), "_path": path_of(url)}).select(
        *kept, F.col("_host").alias("host"), F.col("_path").alias("path"))
    found = staged(matches(marked, rules), "matched")
    return marked.join(found, ["host", "path"], "left").select(
        *kept, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))

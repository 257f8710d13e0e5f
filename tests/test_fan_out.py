"""Joins to lookups whose keys repeat."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterflow.operators import enrich
from meterflow.operators.skew import join_repeated


def test_blank_ids_are_paired_in_many_tasks(spark, monkeypatch):
    """Blank ids match blank ids; a lookup too large to broadcast must not pair them in one task."""
    monkeypatch.setattr(enrich, "fits_broadcast", lambda *_: False, raising=False)
    monkeypatch.setattr(enrich, "broadcast_if_small", lambda rows, *_: rows)
    events = spark.range(400).select(
        F.col("id").alias("seq"), F.lit(1).alias("evnt_id"),
        F.expr("case when id % 4 = 0 then '  ' when id % 4 = 1 then null else concat('m', id % 9) end").alias("msn"))
    catalogue = spark.range(1).select(
        F.lit(1).alias("event_id"), *[F.lit("x").alias(name) for name in enrich.SQL_CATALOGUE_COLUMNS])
    hierarchy = spark.range(100).select(
        F.expr("case when id < 90 then '' else concat('M', id - 90) end").alias("msn_normalized"),
        *[F.concat(F.lit(name), "id").alias(name) for name in enrich.HIERARCHY_COLUMNS])
    for key, value in (("autoBroadcastJoinThreshold", "-1"), ("adaptive.enabled", "false")):
        spark.conf.set(f"spark.sql.{key}", value)
    try:
        got = enrich.enrich_sql(events, catalogue, hierarchy)
        assert got.count() == 100 * 90 + 300
        assert got.where("seq % 4 = 0").distinct().count() == 9000
        assert got.where("seq % 4 = 0").select(F.spark_partition_id().alias("task")).distinct().count() > 2
        names = got.where("seq % 4 > 1").select("seq", "dtr_name").distinct().collect()
        assert {(r["seq"], r["dtr_name"]) for r in names} == {
            (n, f"dtr_name{90 + n % 9}") for n in range(400) if n % 4 > 1}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_join_repeated_equals_a_left_join(spark):
    rows = spark.range(60).select("id", F.expr("nullif(id % 7, 6)").cast("string").alias("k"))
    lookup = spark.range(40).select(F.col("id").alias("v"), F.expr("nullif(id % 5 * (id % 2), 3)").cast("string").alias("l"))
    got = join_repeated(rows, lookup, "k", "l", F.col("id"), repeats=3, slices=4)
    want = rows.join(lookup, F.col("k") == F.col("l"), "left").drop("k")
    assert sorted(map(str, got.select("id", "v", "l").collect())) == sorted(map(str, want.select("id", "v", "l").collect()))


def test_tasks_of_a_repeated_key_stay_apart(spark):
    """Adaptive execution put the slices together again, as they read little; what they give is much."""
    rows = spark.range(4000).select("id", F.expr("if(id % 4 = 3, null, if(id % 4 = 2, 'rare', ''))").alias("k"))
    lookup = spark.range(102).select(F.col("id").alias("v"), F.expr("if(id < 100, '', concat('rare', nullif(id, 100)))").alias("l"))
    rare = lookup.withColumn("l", F.when(F.col("v") == 101, "rare").otherwise(F.col("l")))
    got = join_repeated(rows, rare, "k", "l", F.col("id"), slices=64)
    assert got.columns == ["id", "v", "l"] and got.count() == 2000 * 100 + 2000
    assert got.where("l = ''").select(F.spark_partition_id().alias("task")).distinct().count() > 30
    kinds = got.groupBy(F.expr("id % 4").alias("kind"), "l").agg(F.count_distinct("v").alias("n"), F.count("*").alias("all")).collect()
    assert {tuple(row) for row in kinds} == {(0, "", 100, 100_000), (1, "", 100, 100_000), (2, "rare", 1, 1000), (3, None, 0, 1000)}

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from meterflow.functions import (
    control_trim, dt_bucket_us, event_us, haversine_km, iso_local, linear_decay, micros_text,
    minutes_between, path_normaliser, round_half_up, seconds_text,
)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("text, micros", [
    ("2024-01-01 10:00:00", 1704103200000000),
    ("2024-01-01 10:00:00.5", 1704103200500000),
    ("2024-01-01 10:00:00.123456789", 1704103200123456),
    ("2024-01-01 10:00:00.", 1704103200000000),
    ("2024-02-30 10:00:00", None),
    ("2024-01-01T10:00:00", None),
    ("2024-01-01", None),
    ("", None),
])
def test_event_time(spark, text, micros):
    assert one(spark, event_us(F.lit(text))) == micros


@pytest.mark.parametrize("text, iso", [
    ("2024-01-01 10:02:00", "2024-01-01T10:02"),
    ("2024-01-01 10:02:05", "2024-01-01T10:02:05"),
    ("2024-01-01 10:02:00.5", "2024-01-01T10:02:00.500"),
    ("2024-01-01 10:02:00.000007", "2024-01-01T10:02:00.000007"),
])
def test_iso_time_is_as_short_as_possible(spark, text, iso):
    assert one(spark, iso_local(event_us(F.lit(text)))) == iso


def test_time_texts(spark):
    us = F.lit(1704103200900000)
    assert one(spark, seconds_text(us)) == "2024-01-01 10:00:00"
    assert one(spark, micros_text(us, "T")) == "2024-01-01T10:00:00.900000"
    assert one(spark, minutes_between(F.lit(0), F.lit(500999))) == 500 / 60000
    assert one(spark, dt_bucket_us(F.lit("202401011000"))) == 1704103200000000


def test_trim_strips_tabs(spark):
    assert one(spark, control_trim(F.lit("\t a b \n"))) == "a b"


def test_numbers(spark):
    assert one(spark, round_half_up(F.lit(0.00005))) == 0.0001
    assert one(spark, round_half_up(F.lit(-0.00005))) == 0.0
    degree = one(spark, haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)))
    assert abs(degree - 6371.0088 * math.pi / 180) < 1e-9
    assert one(spark, linear_decay(F.lit(5.0), 20)) == 0.75
    assert one(spark, linear_decay(F.lit(25.0), 20)) == 0.0
    assert path_normaliser(1) == 0 and path_normaliser(2) == 1
    assert abs(path_normaliser(256) - 10.244770920) < 1e-8

"""Numeric helpers."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

EARTH_RADIUS_KM = 6371.0088
EULER_GAMMA = 0.5772156649015329


def round_half_up(value: Column, digits: int = 4) -> Column:
    """Round with ties towards plus infinity."""
    scale = float(10 ** digits)
    return F.floor(value * scale + 0.5) / F.lit(scale)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon)
    return 2 * EARTH_RADIUS_KM * F.atan2(F.sqrt(chord), F.sqrt(1 - chord))


def linear_decay(value: Column, zero_at: float) -> Column:
    """1 at zero, falling to 0 at ``zero_at`` and beyond; null stays null."""
    return F.when(value >= zero_at, F.lit(0.0)).otherwise(1.0 - value / F.lit(float(zero_at)))


def path_normaliser(n: int) -> float:
    """Mean path length of an unsuccessful search among ``n`` points (Liu, Ting, Zhou 2008)."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n

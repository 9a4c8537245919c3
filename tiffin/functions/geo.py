"""Coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0088  # fixed value: mean Earth radius


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + (F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
                                   * half_lon * half_lon)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(F.lit(1.0), chord)))


def jitter(lat: Column, lon: Column, u_lat: Column, u_lon: Column,
           span: float) -> tuple[Column, Column]:
    """A point near a centre; longitude is stretched so that the spread is round on the ground."""
    return (lat + (u_lat - 0.5) * span,
            lon + (u_lon - 0.5) * span / F.cos(F.radians(lat)))

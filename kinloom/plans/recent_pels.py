"""Pseudonymous ids seen lately in one country."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def recent_pels(
    sightings: DataFrame, *, country: str, as_of: Column, days: int = 90
) -> DataFrame:
    """Distinct ``pel`` of ``country, ts, pel`` rows of the last ``days`` days."""
    recent = (F.col("ts") >= as_of - F.expr(f"interval {int(days)} days")) & (F.col("ts") <= as_of)
    return sightings.where((F.col("country") == country) & recent).select("pel").distinct()

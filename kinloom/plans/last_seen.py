"""Ids seen lately, kept as a table of last sightings that is brought forward a day at a time.

The table has one row per country and id, in the folder of the day it was last seen. A
day's sightings are merged by maximum, and rows that no later extract can ask for leave:
its size is that of the ids seen in the period, not of their sightings. An extract reads
the folders of its days.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SEEN = "country string, pel string, ts timestamp_ntz, day date"


def merge_sightings(seen: DataFrame | None, sightings: DataFrame, *, as_of: Column, days: int = 90) -> DataFrame:
    """``country, pel, ts``: the last sighting of each id not older than ``days`` before ``as_of``.

    Rows with a null country, id or time are left out, as are sightings after ``as_of``.
    Maxima are combined before the shuffle, so an id with very many sightings is no hot spot.
    """
    new = sightings.select("country", "pel", F.col("ts").cast("timestamp_ntz").alias("ts"))
    both = new if seen is None else seen.select("country", "pel", "ts").unionByName(new)
    return both.where(_within(as_of, days)).groupBy("country", "pel").agg(F.max("ts").alias("ts")).where("country IS NOT NULL AND pel IS NOT NULL")


def _within(as_of: Column, days: int) -> Column:
    end = as_of.cast("timestamp_ntz")
    return (F.col("ts") >= end - F.make_dt_interval(F.lit(days))) & (F.col("ts") <= end)


def save_seen(seen: DataFrame, root: str) -> str:
    """Write the table by day to a new folder under ``root``; returns its path."""
    path = f"{root.rstrip('/')}/seen-{uuid.uuid4().hex}"
    placed = seen.select("country", "pel", "ts", F.to_date("ts").alias("day"))
    placed.hint("rebalance", "day").sortWithinPartitions("day", "country", "pel").write.partitionBy("day").parquet(path)
    return path


def open_seen(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEEN).parquet(path)


def seen_lately(seen: DataFrame, *, country: str, as_of: Column, days: int = 90) -> DataFrame:
    """``pel`` of the ids of a country last seen within ``days`` before ``as_of``; only those days' folders are read.

    ``as_of`` must not lie before the last merge: of an id seen since, older sightings are gone.
    """
    first_day = F.to_date(as_of.cast("timestamp_ntz") - F.make_dt_interval(F.lit(days)))
    lately = seen.where((F.col("day") >= first_day) & (F.col("country") == country) & _within(as_of, days))
    return lately.select("pel")

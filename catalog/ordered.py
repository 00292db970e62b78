"""Queries that sort keys within ranges, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from catalog.oracles import ORACLES as OTHERS
from catalog.queries import feed, match_cells
from kinloom.plans.match_table import match_lookup


def match_lookup_by_range(spark: SparkSession, sf: str) -> DataFrame:
    """The last row under each prefix, by its predecessor among the sorted keys."""
    return match_lookup(feed(spark, sf, "request_lines"), match_cells(spark, sf), search="range")


def match_lookup_by_range_blank_matches_all(spark: SparkSession, sf: str) -> DataFrame:
    return match_lookup(feed(spark, sf, "request_lines"), match_cells(spark, sf), search="range", blank_matches_all=True)


QUERIES = {f.__name__: f for f in (match_lookup_by_range, match_lookup_by_range_blank_matches_all)}
ORACLES = {
    "match_lookup_by_range": OTHERS["match_lookup_latest"],
    "match_lookup_by_range_blank_matches_all": OTHERS["match_lookup_blank_matches_all"],
}

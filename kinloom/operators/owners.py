"""Who owns a hash that several person records carry."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinloom.fixed import CLINK_RANK_SUFFIX


class Merged(NamedTuple):
    ranks: DataFrame
    changed: DataFrame


def owner_ranks(rows: DataFrame) -> DataFrame:
    """``hash, clink, hash_type`` -> ``hash, rank``: the state from which owners are read.

    The rank is the person key's trailing 16 characters, the key and the type; its minimum
    owns the hash. Minima of minima are minima, so states of loads merge in any order. The
    minimum is combined before the shuffle: a hash in a large share of the records is no
    hot spot.
    """
    rank = F.struct(F.right(F.col("clink"), F.lit(CLINK_RANK_SUFFIX)).alias("suffix"), "clink", "hash_type")
    return rows.groupBy("hash").agg(F.min(rank).alias("rank"))


def owners_of(ranks: DataFrame) -> DataFrame:
    """``hash, clink, hash_type`` of a state."""
    return ranks.select("hash", "rank.clink", "rank.hash_type")


def merge_ranks(*states: DataFrame) -> DataFrame:
    """One state of several: a state and what was added to it since, read together."""
    out = states[0]
    for other in states[1:]:
        out = out.unionByName(other)
    return out.groupBy("hash").agg(F.min("rank").alias("rank"))


def merge_load(ranks: DataFrame, rows: DataFrame) -> Merged:
    """Bring a load's rows into the state of all loads before.

    ``ranks`` of the result is the new state. ``changed`` holds only the hashes whose owner
    the load changes, with ``hash, rank, before`` (null for a new hash): what a table of
    owners must be updated with, and all that has to be added to the stored state. Both
    sides of the join are unique by hash. Records that are gone cannot be taken back from a
    minimum; build the state anew for that.
    """
    joined = ranks.withColumnRenamed("rank", "before").join(owner_ranks(rows), "hash", "full_outer")
    wins = F.col("rank").isNotNull() & (F.col("before").isNull() | (F.col("rank") < F.col("before")))
    return Merged(
        joined.select("hash", F.least("rank", "before").alias("rank")),
        joined.where(wins).select("hash", "rank", F.col("before.clink").alias("before")),
    )


def owner_per_hash(rows: DataFrame) -> DataFrame:
    """``hash, clink, hash_type`` -> one row per hash.

    The person key with the smallest trailing 16 characters wins; ties go to the
    smaller key, then the smaller type.
    """
    return owners_of(owner_ranks(rows))

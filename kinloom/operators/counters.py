"""Counters of loads that add up: exact numbers of records and sketches of distinct hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kinloom.functions.hashes import hash_fault

SUCCESS = "success"
#: 2**14 registers of the sketch: a relative standard error of 0.8 %.
REGISTERS_LOG2 = 14
STANDARD_ERROR = 1.04 / 2 ** (REGISTERS_LOG2 / 2)


def load_counters(rows: DataFrame, load: str | Column) -> DataFrame:
    """``load, reason, n, hashes``: of one load's ``hash`` column, by the fault of a hash.

    ``n`` counts rows and ``hashes`` is a HyperLogLog sketch of the different hashes, some
    kilobytes whatever their number. Both are combined before they are shuffled. Stored
    next to the load, they need not be counted again.
    """
    # The sketch passes over empty strings; a blank hash is one of the different ones.
    marked = F.concat(F.lit("#"), F.col("hash"))
    reason = F.coalesce(hash_fault(F.col("hash")), F.lit(SUCCESS))
    return (
        rows.where(F.col("hash").isNotNull())
        .groupBy(reason.alias("reason"))
        .agg(F.count("*").alias("n"), F.hll_sketch_agg(marked, F.lit(REGISTERS_LOG2)).alias("hashes"))
        .select((F.lit(load) if isinstance(load, str) else load).alias("load"), "reason", "n", "hashes")
    )


def merged_counters(counters: DataFrame) -> DataFrame:
    """``reason, n, distinct_hashes`` over all loads: sums, and the estimate of the united sketches.

    A hash that comes in several loads counts once. The estimate's standard error is
    ``STANDARD_ERROR``.
    """
    united = F.hll_union_agg("hashes")
    return counters.groupBy("reason").agg(
        F.sum("n").alias("n"), F.hll_sketch_estimate(united).alias("distinct_hashes")
    )


def observed(observation: Observation, df: DataFrame) -> DataFrame:
    """``counter, n`` of an observation on a DataFrame of the same session that has been run."""
    found = F.array(*[F.struct(F.lit(k).alias("counter"), F.lit(v).cast("long").alias("n")) for k, v in observation.get.items()])
    return df.sparkSession.range(1).select(F.inline(found))

"""Prefix lookup: the last row of a sorted table whose key starts with a prefix."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Keys looked at for each part when the parts' bounds are chosen.
SAMPLED_PER_PART = 64


def last_row_by_prefix(
    cells: DataFrame, prefixes: DataFrame, columns: dict[str, Column], *, search: str = "lengths"
) -> DataFrame:
    """``prefix, row_key`` and the given columns of the last row under each prefix asked for.

    ``prefixes`` has one string column; ``columns`` maps names to conditions on
    ``family`` and ``qualifier``. Two steps:

    1. A prefix match is an equality on the key cut to the prefix length. Row keys
       alone are read and cut to the distinct lengths that were asked for (a scalar
       subquery, without those above the longest key), and the greatest key of each
       prefix is kept. That is combined before the shuffle, so a prefix that covers a
       third of the table is no hot spot. Prefixes nobody asked for end here. With
       ``search="range"`` the keys are sorted once instead (``last_key_by_range``), which
       pays when many lengths are asked for.
    2. The cells of the keys found are fetched and reduced to the newest per column.
    """
    (name,) = prefixes.columns
    asked = prefixes.where(F.col(name).isNotNull()).select(F.col(name).alias("prefix")).distinct()
    last = {"lengths": last_key_by_length, "range": last_key_by_range}[search](cells, asked)
    newest = {n: F.max(F.when(here, F.struct("ts_micros", "value"))) for n, here in columns.items()}
    rows = (
        cells.join(last.select("row_key").distinct(), "row_key", "left_semi")
        .groupBy("row_key")
        .agg(*[c.alias(n) for n, c in newest.items()])
        .select("row_key", *[F.col(f"{n}.value").alias(n) for n in columns])
    )
    return last.join(rows, "row_key").select("prefix", "row_key", *columns)


def last_key_by_length(cells: DataFrame, asked: DataFrame) -> DataFrame:
    """``prefix, row_key``: keys cut to each length asked for, and the greatest of each cut."""
    longest = cells.agg(F.max(F.length("row_key"))).scalar()
    lengths = asked.where(F.length("prefix") <= longest).agg(F.collect_set(F.length("prefix"))).scalar()
    cut = cells.select("row_key", F.explode(lengths).alias("n")).where(F.col("n") <= F.length("row_key"))
    return (
        cut.groupBy(F.substring(F.col("row_key"), F.lit(1), F.col("n")).alias("prefix"))
        .agg(F.max("row_key").alias("row_key"))
        .join(asked, "prefix", "left_semi")
    )


def last_key_by_range(cells: DataFrame, asked: DataFrame, parts: int | None = None) -> DataFrame:
    """``prefix, row_key``: for each prefix its predecessor among all keys, if it starts with the prefix.

    The upper end of a prefix is its bytes and FF, which no UTF-8 text holds: all keys with
    the prefix lie before it and all later keys behind. Keys and upper ends are dealt into
    ranges by one shuffle, each key once however many lengths are asked for, and sorted
    there. The last key before an end is the answer; where a range has none, it is the
    last key of the ranges before, of which one row each is carried on. A row with very
    many cells may fill several ranges: cells of one key are dealt by a hash.

    Bounds come from ``SAMPLED_PER_PART`` random cells a part, a fixed number that does not
    grow with the table.
    """
    spark = cells.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt_by = F.xxhash64("family", "qualifier")
    keys = cells.select(
        F.col("row_key").cast("binary").alias("k"), dealt_by.alias("tie"), "row_key", F.lit(None).cast("string").alias("prefix")
    )
    picked = keys.select("k", "tie").orderBy(F.rand(7)).limit(SAMPLED_PER_PART * parts).collect()
    sample = sorted((bytes(r["k"]), r["tie"]) for r in picked if r["k"] is not None)
    bounds = [sample[len(sample) * i // parts] for i in range(1, parts)] if sample else []
    end = F.concat(F.col("prefix").cast("binary"), F.unhex(F.lit("FF")))
    ends = asked.select(end.alias("k"), F.lit(0).cast("long").alias("tie"), F.lit(None).cast("string").alias("row_key"), "prefix")
    both = keys.where(F.col("row_key").isNotNull()).unionByName(ends)
    dealt = both.withColumn("part", _part(F.col("k"), F.col("tie"), bounds)).repartitionById(parts, F.col("part"))
    here = Window.partitionBy("part").orderBy("k")
    found = dealt.withColumn("row_key", F.last("row_key", ignorenulls=True).over(here)).where(F.col("prefix").isNotNull())
    ends_of = dealt.groupBy("part").agg(F.max("row_key").alias("last"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    carried = ends_of.select("part", F.max("last").over(before).alias("carried"))
    answer = F.coalesce("row_key", "carried")
    return (
        found.join(carried, "part")
        .select("prefix", answer.alias("row_key"))
        .where(F.col("row_key").startswith(F.col("prefix")))
    )


def _part(key: Column, tie: Column, bounds: list[tuple[bytes, int]]) -> Column:
    """Number of bounds at or below a row: first among every so many of them, then among those between."""
    if not bounds:
        return F.lit(0)

    def literal(some: list[tuple[bytes, int]]) -> Column:
        return F.array(*[F.struct(F.lit(bytearray(k)).alias("k"), F.lit(t).alias("tie")) for k, t in some])

    def below(some: Column) -> Column:
        return F.size(F.filter(some, lambda b: b <= F.struct(key.alias("k"), tie.alias("tie"))))

    step = math.isqrt(len(bounds)) or 1
    coarse = below(literal(bounds[step - 1 :: step]))
    rows = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    fine = F.array(*[literal(r) for r in rows], F.slice(literal(bounds[:1]), 1, 0))
    return (coarse * step + below(F.get(fine, coarse))).cast("int")

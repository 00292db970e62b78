"""Joins on a key of which one value may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SALT = "__salt"


def salted_join(
    rows: DataFrame, keys: DataFrame, key: str, *, spread_by: Column, how: str, salts: int = 32, partitions: int | None = None
) -> DataFrame:
    """``rows`` joined with ``keys`` on ``key``: inner, left, semi or anti.

    ``keys`` is the smaller side. It is repeated once per salt, and each row
    takes the salt of ``spread_by``, so the rows of one key go to ``salts``
    partitions. Adaptive execution splits those further: it does so only where
    both inputs of a join come straight from a shuffle that nothing above relies
    on. A join with the result of an aggregation by the same key is not like
    that, one with a salt is. It may also broadcast a key list it has measured.

    ``partitions`` fixes the number of tasks, for joins that make far more rows than they
    read: adaptive execution would put small inputs together in one.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(how)
    if salts < 1 or salts & (salts - 1):
        raise ValueError("salts must be a power of two")
    last = F.lit(salts - 1).cast("bigint")
    salted = keys.withColumn(_SALT, F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    # A bit mask is never NULL, so no join type adds a filter below the shuffle
    # and joins of the same rows share it.
    spread = rows.withColumn(_SALT, F.xxhash64(spread_by).bitwiseAND(last))
    if partitions:
        spread, salted = (side.repartition(partitions, key, _SALT) for side in (spread, salted))
    return spread.join(salted, [key, _SALT], how).drop(_SALT)


def heavy_keys(rows: DataFrame, key: str, *, share: float = 0.001, tracked: int = 20_000) -> Column:
    """The values of ``key`` in more than about ``share`` of ``rows``, as a scalar subquery.

    An approximate top-k sketch finds them in one pass over the key column, combined before
    anything moves. With ``tracked`` counters its counts are off by a few parts in
    ``tracked`` of the rows, well below ``share``; there are at most ``1 / share`` values.
    """
    if not 4 / tracked <= share <= 1:
        raise ValueError("a share must be more than what the sketch can tell apart")
    k = min(int(1 / share), 1024)
    found = F.expr(f"approx_top_k(`{key}`, {k}, {tracked})")
    # Null keys are counted as rows, too.
    frequent = F.filter(found, lambda x: x["count"] > share * F.count(F.lit(1)))
    return rows.agg(F.transform(frequent, lambda x: x["item"])).scalar()


def sketched_join(
    rows: DataFrame, keys: DataFrame, key: str, *, spread_by: Column, how: str, salts: int = 32, share: float = 0.001
) -> DataFrame:
    """``salted_join`` in which only the keys of many rows are salted.

    ``keys`` gets ``salts`` copies of each heavy key and one of any other. ``rows`` is read
    once more for the sketch, its key column alone, so it should be a table and not a parse.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(how)
    if salts < 1 or salts & (salts - 1):
        raise ValueError("salts must be a power of two")
    heavy = heavy_keys(rows, key, share=share)
    last = F.lit(salts - 1).cast("bigint")
    zero = F.lit(0).cast("bigint")

    def is_heavy() -> Column:
        return F.coalesce(F.array_contains(heavy, F.col(key)), F.lit(False))

    copies = F.when(is_heavy(), F.sequence(zero, last)).otherwise(F.array(zero))
    salt = F.when(is_heavy(), F.xxhash64(spread_by).bitwiseAND(last)).otherwise(zero)
    return rows.withColumn(_SALT, salt).join(keys.withColumn(_SALT, F.explode(copies)), [key, _SALT], how).drop(_SALT)

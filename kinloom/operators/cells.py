"""Cell tables: ``row_key, family, qualifier, ts_micros, value``.

A table holds one row per address ``(row_key, family, qualifier)``. Of several
writes to one address the highest timestamp wins, then the greatest value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinloom.operators.skew import salted_join

ADDRESS = ["row_key", "family", "qualifier"]
CELL = [*ADDRESS, "ts_micros", "value"]


def load_time() -> Column:
    """Microseconds at the start of the query; the same for every row."""
    return F.unix_micros(F.current_timestamp())


def to_cells(
    df: DataFrame,
    *,
    row_key: Column,
    family: str | Column,
    columns: dict[str, Column],
    ts_micros: int | Column = 0,
    null_as_blank: bool = False,
) -> DataFrame:
    """One cell per entry of ``columns`` (qualifier -> value).

    A NULL value writes no cell, or a blank one with ``null_as_blank``.
    """
    values = {q: F.coalesce(v, F.lit("")) if null_as_blank else v for q, v in columns.items()}
    cells = F.array(
        *[F.struct(F.lit(q).alias("qualifier"), v.alias("value")) for q, v in values.items()]
    )
    out = df.select(
        row_key.alias("row_key"),
        (F.lit(family) if isinstance(family, str) else family).alias("family"),
        F.lit(ts_micros).cast("bigint").alias("ts_micros"),
        F.inline(cells),
    ).select(CELL)
    return out if null_as_blank else out.where(F.col("value").isNotNull())


def link_cells(
    df: DataFrame,
    *,
    row_key: Column,
    family: str | Column,
    qualifier: Column,
    ts_micros: int | Column,
    value: Column | None = None,
) -> DataFrame:
    """Set-valued cells: the member is the qualifier, the value is blank by default."""
    return df.select(
        row_key.alias("row_key"),
        (F.lit(family) if isinstance(family, str) else family).alias("family"),
        qualifier.alias("qualifier"),
        F.lit(ts_micros).cast("bigint").alias("ts_micros"),
        (F.lit("") if value is None else value).alias("value"),
    )


def latest(cells: DataFrame) -> DataFrame:
    """One cell per address: highest timestamp, then greatest value.

    Combines before the shuffle, so an address written very often reaches its
    reducer as one row per task.
    """
    winner = F.max(F.struct("ts_micros", "value"))
    return (
        cells.groupBy(*ADDRESS)
        .agg(winner.alias("winner"))
        .select(*ADDRESS, "winner.ts_micros", "winner.value")
    )


def latest_links(cells: DataFrame) -> DataFrame:
    """``latest`` for cells whose value is fixed by their address (see ``link_cells``).

    Only the timestamp is aggregated, so this is a hash aggregation without a sort.
    """
    return (
        cells.groupBy(*ADDRESS, "value").agg(F.max("ts_micros").alias("ts_micros")).select(CELL)
    )


def apply_mutations(
    current: DataFrame | None,
    puts: DataFrame,
    delete_keys: DataFrame | None = None,
    *,
    links: bool = False,
    unique: bool = False,
) -> DataFrame:
    """Delete whole rows from ``current``, then upsert ``puts``.

    ``current`` holds one row per address. It is hashed by the full address, so
    that one row key with very many cells spreads over the cluster; a table
    bucketed by address is not moved at all. Puts are reduced to one per address
    first, so both sides of the join are unique and no key can be hot. ``links``
    says that every value is fixed by its address, ``unique`` that ``puts`` has one row
    per address as it is.
    """
    new = puts.select(CELL) if unique else latest_links(puts) if links else latest(puts)
    if current is None:
        return new
    if delete_keys is not None:
        current = salted_join(
            current,
            delete_keys.select("row_key"),
            "row_key",
            spread_by=F.col("qualifier"),
            how="left_anti",
        )
    old = current.select(*ADDRESS, F.struct("ts_micros", "value").alias("old"))
    new = new.select(*ADDRESS, F.struct("ts_micros", "value").alias("new"))
    # greatest() skips the side that is absent.
    return (
        old.join(new, ADDRESS, "full_outer")
        .select(*ADDRESS, F.greatest("old", "new").alias("winner"))
        .select(*ADDRESS, "winner.ts_micros", "winner.value")
    )


def replace_rows(current: DataFrame, puts: DataFrame, delete_keys: DataFrame) -> DataFrame:
    """``apply_mutations`` with deletes, for tables whose rows hold a few cells each.

    Such a table can be hashed by row key alone. The anti-join, the union and the
    upsert then share that partitioning, and the table is shuffled once.
    """
    kept = current.select(CELL).join(delete_keys.select("row_key"), "row_key", "left_anti")
    return latest(kept.unionByName(latest(puts).repartition("row_key")))


def scan_prefix(cells: DataFrame, prefix: str) -> DataFrame:
    """Row keys that start with ``prefix``, without their values."""
    return cells.where(F.col("row_key").startswith(prefix)).select("row_key").distinct()


def latest_value(family: str, qualifier: str) -> Column:
    """Aggregate: the latest value of one column of a row, NULL if absent."""
    here = (F.col("family") == family) & (F.col("qualifier") == qualifier)
    return F.max(F.when(here, F.struct("ts_micros", "value")))["value"]


def pivot_rows(cells: DataFrame, family: str, qualifiers: list[str]) -> DataFrame:
    """One row per row key with a column per qualifier."""
    return cells.groupBy("row_key").agg(
        *[latest_value(family, q).alias(q) for q in qualifiers]
    )

"""Two-way link tables: key -> values and value -> keys."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kinloom.operators.cells import apply_mutations, link_cells, load_time
from kinloom.operators.parse import parse_one_to_many


class TwoWay(NamedTuple):
    forward: DataFrame
    reverse: DataFrame
    rejects: DataFrame


def load_two_way(
    lines: DataFrame,
    forward: DataFrame | None,
    reverse: DataFrame | None,
    *,
    family: str,
    delimiter: str = "|",
    load_ts: int | Column | None = None,
    observation: Observation | None = None,
    once: bool = False,
) -> TwoWay:
    """Load ``key | value | value ...`` lines into two mirrored tables.

    The linked value is the qualifier of a blank cell, so a row is a set. Tables
    are hashed by the full cell address, and a value linked to very many keys
    spreads over the cluster. With ``once`` the lines are parsed by one job, whose rows
    feed both tables (see ``operators.parse.divide``).
    """
    parsed = parse_one_to_many(lines, delimiter=delimiter, observation=observation, once=once)
    ts = load_time() if load_ts is None else load_ts

    def links(row_key: str, qualifier: str) -> DataFrame:
        return link_cells(
            parsed.rows,
            row_key=F.col(row_key),
            family=family,
            qualifier=F.col(qualifier),
            ts_micros=ts,
        )

    return TwoWay(
        apply_mutations(forward, links("key", "value_"), links=True),
        apply_mutations(reverse, links("value_", "key"), links=True),
        parsed.rejects,
    )

"""Person records -> mapping of hashed identifiers to pseudonymous ids, and its load."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from kinloom.fixed import PEL_QUALIFIER
from kinloom.functions.identity import HashArlFn, PelFn
from kinloom.operators.cells import apply_mutations, to_cells
from kinloom.operators.owners import owner_per_hash
from kinloom.operators.parse import (
    hash_faults,
    parse_arl_pel,
    parse_identity_records,
    valid_hashes,
)
from kinloom.sources.sinks import join_fields


class Mapping(NamedTuple):
    mapping: DataFrame
    rejects: DataFrame


class Loaded(NamedTuple):
    table: DataFrame
    rejects: DataFrame


def build_arl_pel_mapping(
    lines: DataFrame,
    *,
    pel_fn: PelFn,
    arl_fn: HashArlFn,
    clink: int = 0,
    md5: int = 2,
    sha1: int = 1,
    sha256: int = 3,
    delimiter: str = "|",
    observation: Observation | None = None,
    once: bool = False,
) -> Mapping:
    """``arl`` (hex), ``pel`` per distinct valid hash.

    Hashes are checked before the grouping: the check depends on the hash only,
    and a blank hash shared by many records never reaches the shuffle. The
    rejects are short lines and, once per distinct hash, undecodable hashes.
    """
    records = parse_identity_records(
        lines,
        clink=clink,
        md5=md5,
        sha1=sha1,
        sha256=sha256,
        delimiter=delimiter,
        observation=observation,
        once=once,
    )
    owners = owner_per_hash(valid_hashes(records.rows))
    mapping = owners.select(
        F.lower(F.hex(arl_fn(F.col("hash"), F.col("hash_type")))).alias("arl"),
        pel_fn(F.col("clink")).alias("pel"),
    )
    return Mapping(mapping, records.rejects.unionByName(hash_faults(records.rows)))


def mapping_lines(mapping: DataFrame) -> DataFrame:
    """``arl|pel`` lines."""
    return mapping.select(join_fields("|", F.col("arl"), F.col("pel")).alias("value"))


def load_arl_pel(
    lines: DataFrame,
    table: DataFrame | None,
    *,
    family: str,
    observation: Observation | None = None,
    once: bool = False,
) -> Loaded:
    """Upsert ``arl|pel`` lines, keyed by the decoded hash, at timestamp 0."""
    parsed = parse_arl_pel(lines, observation=observation, once=once)
    puts = to_cells(
        parsed.rows,
        row_key=F.col("arl"),
        family=family,
        columns={PEL_QUALIFIER: F.col("pel")},
    )
    return Loaded(apply_mutations(table, puts), parsed.rejects)

"""The match table (pseudonymous id -> e-mail hashes): two loaders and the lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kinloom.fixed import HASH_FAMILY, HASH_LENGTHS
from kinloom.functions.hashes import hashes_by_length
from kinloom.functions.identity import PelFn
from kinloom.functions.text import is_blank
from kinloom.operators.cells import apply_mutations, to_cells
from kinloom.operators.lookup import last_row_by_prefix
from kinloom.operators.parse import (
    Parsed,
    parse_columns,
    parse_hashes_by_length,
    parse_pairs,
)
from kinloom.operators.skew import salted_join, sketched_join
from kinloom.plans.hash_mapping import Loaded
from kinloom.sources.sinks import join_fields

HASH_COLUMNS = list(HASH_LENGTHS)


def hash_cells(rows: DataFrame, *, family: str = HASH_FAMILY) -> DataFrame:
    """``pel, md5, sha1, sha256`` -> three cells per row; a missing hash is blank."""
    return to_cells(
        rows,
        row_key=F.col("pel"),
        family=family,
        columns={name: F.col(name) for name in HASH_COLUMNS},
        null_as_blank=True,
    )


def load_match_table_join(
    provider_lines: DataFrame,
    kb_lines: DataFrame,
    table: DataFrame | None,
    *,
    provider_sha256: int,
    kb_clink: int,
    kb_md5: int,
    kb_sha1: int,
    kb_sha256: int,
    pel_fn: PelFn,
    family: str = HASH_FAMILY,
    delimiter: str = "|",
    quoted: bool = True,
    salts: int = 8,
) -> Loaded:
    """Load the knowledge-base records whose sha256 the provider also lists.

    A match only decides whether a record is loaded, so this is a semi-join
    against the distinct provider hashes: repeated hashes do not multiply rows.
    One hash may be carried by a large share of the records. Those that are, a sketch
    of the records' hashes finds, and only they are salted; the records are parsed by one
    job that writes them by sink, so the sketch reads one column.
    """
    provider = parse_columns(
        provider_lines,
        {"sha256": provider_sha256},
        required=("sha256",),
        delimiter=delimiter,
        quoted=quoted,
    )
    kb = parse_columns(
        kb_lines,
        {"clink": kb_clink, "md5": kb_md5, "sha1": kb_sha1, "sha256": kb_sha256},
        required=("sha256", "clink"),
        delimiter=delimiter,
        quoted=quoted,
        once=True,
    )
    matched = sketched_join(
        kb.rows,
        provider.rows.distinct(),
        "sha256",
        spread_by=F.col("clink"),
        how="left_semi",
        salts=salts,
    )
    rows = matched.select(pel_fn(F.col("clink")).alias("pel"), *HASH_COLUMNS)
    return Loaded(
        apply_mutations(table, hash_cells(rows, family=family)),
        provider.rejects.unionByName(kb.rejects),
    )


def load_match_table_by_length(
    lines: DataFrame,
    table: DataFrame | None,
    *,
    pel_fn: PelFn,
    family: str = HASH_FAMILY,
    delimiter: str = "|",
    quoted: bool = True,
    observation: Observation | None = None,
    once: bool = False,
) -> Loaded:
    """Load records whose hashes come in any order, classified by length."""
    parsed = parse_hashes_by_length(
        lines, delimiter=delimiter, quoted=quoted, observation=observation, once=once
    )
    rows = parsed.rows.select(pel_fn(F.col("key")).alias("pel"), *HASH_COLUMNS).where(
        ~is_blank(F.col("pel"))
    )
    return Loaded(apply_mutations(table, hash_cells(rows, family=family)), parsed.rejects)


def parse_requests(
    lines: DataFrame, *, delimiter: str = ",", observation: Observation | None = None
) -> Parsed:
    """Two-field lines -> ``cookie, pel``."""
    parsed = parse_pairs(lines, delimiter=delimiter, observation=observation)
    return Parsed(
        parsed.rows.select(F.col("key").alias("cookie"), F.col("value_").alias("pel")),
        parsed.rejects,
    )


def match_lookup(lines: DataFrame, table: DataFrame, *, delimiter: str = ",", **options) -> DataFrame:
    """``cookie,pel`` lines -> ``cookie, md5, sha1, sha256`` (see ``match_requests``)."""
    return match_requests(parse_requests(lines, delimiter=delimiter).rows, table, **options)


def match_requests(
    requests: DataFrame,
    table: DataFrame,
    *,
    family: str = HASH_FAMILY,
    blank_matches_all: bool = False,
    salts: int = 8,
    search: str = "lengths",
) -> DataFrame:
    """``cookie, pel`` rows -> ``cookie, md5, sha1, sha256``.

    The row with the greatest key that starts with the given id supplies all
    three hashes. Hashes filed under the wrong name are put right by length.
    Every request yields one row, with blanks where nothing was found. A blank
    id finds nothing unless ``blank_matches_all``. ``search`` says how the greatest key
    is found (see ``operators.lookup``).
    """
    asked = F.col("pel") if blank_matches_all else F.when(F.col("pel") != "", F.col("pel"))
    requests = requests.select("cookie", asked.alias("prefix"))
    prefixes = requests.select("prefix").where(F.col("prefix").isNotNull())

    def filed_as(name: str) -> Column:
        return (F.col("family") == family) & (F.col("qualifier") == name)

    found = last_row_by_prefix(table, prefixes, {name: filed_as(name) for name in HASH_COLUMNS}, search=search)
    filed = F.array(*[F.col(name) for name in HASH_COLUMNS])
    repaired = found.select("prefix", *[hashed.alias(name) for name, hashed in hashes_by_length(filed).items()])
    # One id, or no id, may be asked for by a large share of the requests.
    return salted_join(
        requests, repaired, "prefix", spread_by=F.col("cookie"), how="left", salts=salts
    ).select("cookie", *[F.coalesce(name, F.lit("")).alias(name) for name in HASH_COLUMNS])


def match_lines(matches: DataFrame) -> DataFrame:
    """``cookie|md5|sha1|sha256`` lines."""
    return matches.select(
        join_fields("|", F.col("cookie"), *[F.col(n) for n in HASH_COLUMNS]).alias("value")
    )

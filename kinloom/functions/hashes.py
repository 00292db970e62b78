"""Checks and choices on hex hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinloom.fixed import HASH_LENGTHS


def first_of_length(values: Column, length: int) -> Column:
    """First value of an array with the given length, else NULL."""
    return F.get(F.filter(values, lambda v: F.length(v) == length), F.lit(0))


def hashes_by_length(values: Column) -> dict[str, Column]:
    """md5, sha1 and sha256 of an array of hashes in any order."""
    return {kind: first_of_length(values, n) for kind, n in HASH_LENGTHS.items()}


def hash_fault(text: Column) -> Column:
    """Why a string cannot be decoded as hex, or NULL if it can."""
    return F.when(F.length(text) % 2 != 0, F.lit("odd_length")).when(
        ~text.rlike("\\A[0-9a-fA-F]+\\z"), F.lit("bad_chars")
    )

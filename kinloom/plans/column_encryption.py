"""Delimited files: translate the id column, encrypt every other field."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from kinloom.fixed import ENCRYPTED_HEADER
from kinloom.functions.identity import (
    Cipher,
    PelFn,
    Secret,
    as_column,
    encrypt_field,
    is_clink,
    is_pel,
    same_pel,
)
from kinloom.functions.text import is_blank, split_all
from kinloom.operators.parse import Parsed, divide

HEADER_COLUMNS = ENCRYPTED_HEADER.split(",")


def encrypt_fields(
    lines: DataFrame,
    *,
    key: Secret,
    pel_fn: PelFn,
    cipher: Cipher = encrypt_field,
    translate_clink: bool = True,
    delimiter: str = ",",
    observation: Observation | None = None,
) -> Parsed:
    """Rows of one array column ``fields``, as wide as the line was.

    Field 0 is a person key to be translated, or a pseudonymous id passed
    through; a line with neither is rejected. Blank fields stay blank.
    """
    translate = pel_fn if translate_clink else same_pel
    valid = is_clink if translate_clink else is_pel
    fields = F.col("fields")
    first = F.get(fields, F.lit(0))
    rest = F.transform(
        F.slice(fields, F.lit(2), F.size(fields) - 1),
        lambda x: F.when(is_blank(x), F.lit("")).otherwise(cipher(x, F.col("key"))),
    )
    faults = {"invalid_id": ~valid(first)}
    # The key is a column first: it may be a subquery, which a lambda cannot hold.
    split = split_all(F.col("value"), delimiter).alias("fields")
    return divide(
        lines.select("value", split, as_column(key).alias("key")),
        faults,
        [F.concat(F.array(translate(first)), rest).alias("fields")],
        observation,
    )


def encrypted_lines(rows: DataFrame, *, delimiter: str = ",") -> DataFrame:
    """Lines with the width they came with."""
    return rows.select(F.array_join("fields", delimiter).alias("value"))


def encrypt_columns(
    lines: DataFrame,
    *,
    key: Secret,
    pel_fn: PelFn,
    cipher: Cipher = encrypt_field,
    translate_clink: bool = True,
    observation: Observation | None = None,
) -> Parsed:
    """The fourteen named columns; short lines are filled with blanks.

    Fields beyond the named ones are in the array column ``surplus``.
    """
    encrypted = encrypt_fields(
        lines,
        key=key,
        pel_fn=pel_fn,
        cipher=cipher,
        translate_clink=translate_clink,
        observation=observation,
    )
    columns = [
        F.coalesce(F.get("fields", F.lit(i)), F.lit("")).alias(name)
        for i, name in enumerate(HEADER_COLUMNS)
    ]
    named = len(HEADER_COLUMNS)
    surplus = F.when(F.size("fields") > named, F.slice("fields", named + 1, F.size("fields")))
    columns.append(F.coalesce(surplus, F.array().cast("array<string>")).alias("surplus"))
    return Parsed(encrypted.rows.select(*columns), encrypted.rejects)

"""Identifier predicates, translation and field encryption.

The production translators are secret; jobs take any function of Columns. The
salted ones here are deterministic stand-ins. A salt or key is a string or a
Column, so it can also come from a table (see ``secret``) and stay out of plans.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinloom.fixed import CLINK_LENGTH, CLINK_PREFIXES, PEL_PREFIXES

PelFn = Callable[[Column], Column]
HashArlFn = Callable[[Column, Column], Column]
Cipher = Callable[[Column, Column], Column]
AccountArlFn = Callable[[Column, Column], Column]
Secret = str | Column


def as_column(value: Secret) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _starts_with_any(text: Column, prefixes: tuple[str, ...]) -> Column:
    return reduce(Column.__or__, [text.startswith(p) for p in prefixes])


def is_pel(text: Column) -> Column:
    return _starts_with_any(text, PEL_PREFIXES)


def is_clink(text: Column) -> Column:
    return (F.length(text) == CLINK_LENGTH) & _starts_with_any(text, CLINK_PREFIXES)


def secret(secrets: DataFrame, name: str) -> Column:
    """One value of a ``(name, value)`` table, read once and sent to every task.

    The job fails unless the table has exactly one value of that name.
    """
    fault = F.raise_error(F.lit(f"there must be one secret named {name!r}")).cast("string")
    once = (F.count("*") == 1) & (F.count("value") == 1)
    return secrets.where(F.col("name") == name).agg(F.when(once, F.max("value")).otherwise(fault)).scalar()


def salted_pel(salt: Secret) -> PelFn:
    """Person key -> pseudonymous id."""

    def translate(clink: Column) -> Column:
        digest = F.sha2(F.concat(as_column(salt), F.lit("|pel|"), clink), 256)
        return F.concat(F.lit("Xi"), F.substring(digest, 1, 32))

    return translate


def salted_hash_arl(salt: Secret) -> HashArlFn:
    """(hash, hash type) -> binary row key. The hash is case-insensitive hex."""

    def translate(hashed: Column, kind: Column) -> Column:
        return F.unhex(
            F.sha2(F.concat(as_column(salt), F.lit("|"), kind, F.lit("|"), F.lower(hashed)), 256)
        )

    return translate


def salted_account_arl(salt: Secret) -> AccountArlFn:
    """(account number, customer id) -> binary row key."""

    def translate(ana: Column, cid: Column) -> Column:
        return F.unhex(
            F.sha2(
                F.concat(as_column(salt), F.lit("|cid|"), ana.cast("string"), F.lit("#"), cid), 256
            )
        )

    return translate


def same_pel(clink: Column) -> Column:
    """The person key itself, for checks against known results."""
    return clink


def decoded_hash_arl(hashed: Column, kind: Column) -> Column:
    """The decoded hash itself, for checks against known results."""
    return F.unhex(hashed)


def encrypt_field(text: Column, key: Secret) -> Column:
    """Deterministic AES-CBC as base64: equal inputs give equal outputs.

    The initial vector is derived from key and text. The key has 16, 24 or 32
    bytes.
    """
    iv = F.unhex(F.substring(F.sha2(F.concat(as_column(key), text), 256), 1, 32))
    return F.base64(F.aes_encrypt(text, as_column(key), F.lit("CBC"), F.lit("PKCS"), iv))


def decrypt_field(text: Column, key: Secret) -> Column:
    """Inverse of ``encrypt_field``; NULL where the text cannot be decrypted."""
    return F.try_aes_decrypt(
        F.try_to_binary(text, F.lit("base64")), as_column(key), F.lit("CBC"), F.lit("PKCS")
    ).cast("string")

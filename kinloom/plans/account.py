"""Customer accounts: incremental load and full refresh.

Two tables are kept. ``diff`` is keyed by ``<account>#<customer id>`` and tells
which keys an account has; ``arl`` is keyed by the salted hash of the same pair.
Both hold the pseudonymous id in one cell per row.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kinloom.fixed import PEL_FAMILY, PEL_QUALIFIER, PREFERRED_PEL_KEY, ROW_KEY_SEPARATOR
from kinloom.functions.identity import AccountArlFn
from kinloom.operators.cells import (
    CELL,
    apply_mutations,
    latest,
    load_time,
    replace_rows,
    to_cells,
)
from kinloom.operators.parse import parse_account_lines
from kinloom.sources.lines import infer_delimiter


class AccountTables(NamedTuple):
    diff: DataFrame
    arl: DataFrame
    rejects: DataFrame


def _check_account(ana: int) -> None:
    if isinstance(ana, bool) or not isinstance(ana, int):
        raise ValueError(f"account must be an integer, got {ana!r}")


def _puts(rows: DataFrame, row_key: Column, ts_micros: int | Column) -> DataFrame:
    return to_cells(
        rows,
        row_key=row_key,
        family=PEL_FAMILY,
        columns={PEL_QUALIFIER: F.col("pel")},
        ts_micros=ts_micros,
    )


def _row_key(ana: Column) -> Column:
    return F.concat_ws(ROW_KEY_SEPARATOR, ana, F.col("cid"))


def account_load_incremental(
    lines: DataFrame,
    diff: DataFrame | None,
    arl: DataFrame | None,
    *,
    ana: int,
    cid_key: str,
    arl_fn: AccountArlFn,
    preferred_pel_key: str = PREFERRED_PEL_KEY,
    delimiter: str | None = None,
    load_ts: int | Column | None = None,
    strict: bool = False,
    observation: Observation | None = None,
) -> AccountTables:
    """Upsert one account's lines into both tables."""
    _check_account(ana)
    parsed = parse_account_lines(
        lines,
        cid_key=cid_key,
        preferred_pel_key=preferred_pel_key,
        delimiter=delimiter,
        strict=strict,
        observation=observation,
    )
    ts = load_time() if load_ts is None else load_ts
    account = F.lit(ana)
    return AccountTables(
        apply_mutations(diff, _puts(parsed.rows, _row_key(account.cast("string")), ts)),
        apply_mutations(arl, _puts(parsed.rows, arl_fn(account, F.col("cid")), ts)),
        parsed.rejects,
    )


def account_keys(diff: DataFrame, ana: int, *, match: str = "exact") -> DataFrame:
    """``ana, cid`` of an account's row keys; the customer id may contain ``#``.

    Keys without an account number are left out.
    """
    key = F.col("row_key")
    return (
        diff.where(key.startswith(account_prefix(ana, match)))
        .where(key.contains(ROW_KEY_SEPARATOR))
        .select(
            F.substring_index(key, ROW_KEY_SEPARATOR, 1).try_cast("int").alias("ana"),
            F.get(F.split(key, ROW_KEY_SEPARATOR, 2), F.lit(1)).alias("cid"),
        )
        .where(F.col("ana").isNotNull() & (F.col("cid") != ""))
    )


def account_prefix(ana: int, match: str = "exact") -> str:
    """``exact`` ends the account number with ``#``; ``prefix`` does not, so
    account 12 then also covers 123."""
    if match not in ("exact", "prefix"):
        raise ValueError(f"match must be 'exact' or 'prefix', got {match!r}")
    return f"{ana}{ROW_KEY_SEPARATOR}" if match == "exact" else str(ana)


def account_refresh_full(
    lines: DataFrame,
    diff: DataFrame | None,
    arl: DataFrame | None,
    *,
    ana: int,
    cid_key: str,
    arl_fn: AccountArlFn,
    preferred_pel_key: str = PREFERRED_PEL_KEY,
    delimiter: str | None = None,
    load_ts: int | Column | None = None,
    match: str = "exact",
    strict: bool = False,
    observation: Observation | None = None,
) -> AccountTables:
    """Replace everything an account has in both tables by its new lines.

    The old rows are removed and the new ones added in one plan, so there is no
    moment at which a reader sees the account empty or half loaded once the
    result is published as a snapshot.
    """
    _check_account(ana)
    prefix = account_prefix(ana, match)
    if delimiter is None:
        # Lines read with the wrong one are all rejected, which would empty the account.
        delimiter = infer_delimiter(lines, agreed=True)
    parsed = parse_account_lines(
        lines,
        cid_key=cid_key,
        preferred_pel_key=preferred_pel_key,
        delimiter=delimiter,
        strict=strict,
        observation=observation,
    )
    ts = load_time() if load_ts is None else load_ts
    account = F.lit(ana)
    new_diff = latest(_puts(parsed.rows, _row_key(account.cast("string")), ts))
    new_arl = _puts(parsed.rows, arl_fn(account, F.col("cid")), ts)
    if diff is None:
        return AccountTables(new_diff, apply_mutations(arl, new_arl), parsed.rejects)
    # The prefix covers every new key too, so the kept rows and the new ones are
    # disjoint and the table itself is filtered without a shuffle.
    kept = diff.where(~F.col("row_key").startswith(prefix))
    stale = account_keys(diff, ana, match=match).select(
        arl_fn(F.col("ana"), F.col("cid")).alias("row_key")
    )
    return AccountTables(
        kept.select(CELL).unionByName(new_diff),
        latest(new_arl) if arl is None else replace_rows(arl, new_arl, stale),
        parsed.rejects,
    )

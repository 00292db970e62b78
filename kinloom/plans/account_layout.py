"""Account tables in one folder per account, so that refreshing an account costs what it holds.

``<root>/diff`` and ``<root>/arl`` hold the two tables of ``plans.account`` partitioned by
``ana``. A refresh reads the folders of its account alone and replaces only those: files
of other accounts are neither read nor written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinloom.fixed import ROW_KEY_SEPARATOR
from kinloom.functions.identity import AccountArlFn
from kinloom.operators.cells import CELL
from kinloom.plans.account import account_refresh_full
from kinloom.session import staged

# Rows whose key names no account.
NO_ACCOUNT = -1


def account_of(row_key: Column) -> Column:
    """The account number a key of ``diff`` starts with."""
    number = F.substring_index(row_key, ROW_KEY_SEPARATOR, 1).try_cast("int")
    return F.coalesce(F.when(row_key.contains(ROW_KEY_SEPARATOR), number), F.lit(NO_ACCOUNT))


def _write(cells: DataFrame, path: str) -> None:
    # A very large account is split over several tasks and files.
    (
        cells.hint("rebalance", "ana")
        .sortWithinPartitions("ana", "row_key")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("ana")
        .parquet(path)
    )


def save_accounts(diff: DataFrame, arl: DataFrame, root: str, *, arl_fn: AccountArlFn) -> None:
    """Write both tables by account. The account of a hashed key is that of the ``diff`` key it was made of."""
    placed = diff.select(CELL).withColumn("ana", account_of(F.col("row_key")))
    _write(placed, f"{root}/diff")
    cid = F.get(F.split("row_key", ROW_KEY_SEPARATOR, 2), F.lit(1))
    keys = placed.where(F.col("ana") != NO_ACCOUNT).select(arl_fn(F.col("ana"), cid).alias("row_key"), "ana").distinct()
    hashed = arl.select(CELL).join(keys, "row_key", "left")
    _write(hashed.withColumn("ana", F.coalesce("ana", F.lit(NO_ACCOUNT))), f"{root}/arl")


def open_accounts(spark: SparkSession, root: str, table: str, ana: int | None = None) -> DataFrame:
    """Cells of ``diff`` or ``arl``; with ``ana`` those of one account, whose folder alone is read.

    Hashed rows that no key of ``diff`` names have a folder of their own. If a later load
    brings such a row again, it is in two folders: ``operators.cells.latest`` merges them.
    """
    key = {"diff": "string", "arl": "binary"}[table]
    schema = f"row_key {key}, family string, qualifier string, ts_micros bigint, value string, ana int"
    cells = spark.read.schema(schema).parquet(f"{root}/{table}")
    return (cells if ana is None else cells.where(F.col("ana") == ana)).select(CELL)


def refresh_account(lines: DataFrame, root: str, *, ana: int, arl_fn: AccountArlFn, **options) -> DataFrame:
    """Replace what account ``ana`` has in both tables by ``lines``; returns the rejected lines.

    Options are those of ``account_refresh_full``, which works on the account's rows alone;
    ``match`` is always exact, for an account is a folder. The new rows are complete in the
    shared folder before the first old file goes. Other accounts may be refreshed at the
    same time, the same one may not.
    """
    if options.get("match", "exact") != "exact":
        raise ValueError("a folder holds exactly one account")
    spark = lines.sparkSession
    diff, arl = (open_accounts(spark, root, name, ana) for name in ("diff", "arl"))
    done = account_refresh_full(lines, diff, arl, ana=ana, arl_fn=arl_fn, **options)
    new = [(name, staged(cells.select(CELL), f"account-{name}")) for name, cells in (("diff", done.diff), ("arl", done.arl))]
    for name, cells in new:
        if cells.isEmpty():  # dynamic overwriting leaves folders alone for which there are no rows
            cells.write.mode("overwrite").parquet(f"{root}/{name}/ana={ana}")
        else:
            _write(cells.withColumn("ana", F.lit(ana)), f"{root}/{name}")
    return done.rejects

"""Versioned cell tables on a shared file system.

``<root>/data/<version>-<id>`` holds the Parquet files of one version,
``<root>/log`` one small JSON file per published version, named by its number. A
reader follows the log, so a version becomes visible at once and only after it is
complete; a job that dies half-way leaves the previous version in place.

A version is either the whole table or an addition: the cells written by one
load. A load of a small batch into a large table adds its cells instead of
writing the table anew, and publishes the whole table once in a while.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinloom.operators.cells import ADDRESS, CELL, latest

_LOG_SCHEMA = "version bigint, path string, whole boolean"


def _log(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(_LOG_SCHEMA).json(f"{root}/log").where("version is not null")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def current_version(spark: SparkSession, root: str) -> int:
    """Newest published version, 0 if there is none."""
    log = _log(spark, root)
    return 0 if log is None else log.agg(F.max("version")).first()[0] or 0


def open_snapshot(
    spark: SparkSession, root: str, version: int | None = None, *, merged: bool = True
) -> DataFrame:
    """Read a published version, the newest by default.

    Additions are merged to one cell per address. ``merged=False`` skips that
    for readers that reduce cells themselves: prefix scans, ``pivot_rows``, the
    prefix lookup and ``linked_hashes`` give the same result on unmerged cells.
    """
    log = _log(spark, root)
    entries = []
    if log is not None:
        log = log.where(F.col("version") <= (version or F.col("version")))
        last = log.agg(F.max(F.when(F.col("whole"), F.col("version")))).first()[0] or 0
        # One row for the last whole version and each addition since.
        entries = sorted(log.where(F.col("version") >= last).collect(), key=lambda e: e["version"])
    if not entries or (version and entries[-1]["version"] != version):
        raise ValueError(f"no such snapshot under {root}")
    paths = [f"{root}/{entry['path']}" for entry in entries]
    cells = spark.read.parquet(*paths)
    return latest(cells) if merged and len(paths) > 1 else cells


def publish_snapshot(cells: DataFrame, root: str, *, by_key: bool = False, after: int | None = None) -> int:
    """Write ``cells`` as the whole table, then log it as the next version.

    By default the partitioning of the plan is written as it is. ``by_key`` adds
    a range shuffle by the full cell address and sorts, so that a prefix scan
    prunes files and row groups by their key statistics; the full address also
    splits a row that holds very many cells. It pays for tables that are scanned
    by prefix. ``after`` is the version ``cells`` were made from: if another one
    has been published since, this fails and that one stays.
    """
    return _publish(cells, root, by_key, after, whole=True)


def append_snapshot(puts: DataFrame, root: str, *, by_key: bool = False) -> int:
    """Log ``puts`` as an addition to the table; the work is that of the batch."""
    return _publish(puts, root, by_key, None, whole=False)


def _publish(cells: DataFrame, root: str, by_key: bool, after: int | None, whole: bool) -> int:
    spark = cells.sparkSession
    version = (current_version(spark, root) if after is None else after) + 1
    path = f"data/{version}-{uuid.uuid4().hex}"
    cells = cells.select(CELL)
    if by_key:
        cells = cells.repartitionByRange(*ADDRESS).sortWithinPartitions(*ADDRESS)
    cells.write.parquet(f"{root}/{path}")
    _claim(spark, root, version, {"version": version, "path": path, "whole": whole})
    return version


def _claim(spark: SparkSession, root: str, version: int, entry: dict) -> None:
    """Make the log entry of a version, unless it has one: the moment it is published.

    The file system creates a file for one writer only, so of two jobs that publish
    the same version one fails and readers never see its data.
    """
    jvm = spark.sparkContext._jvm
    file = jvm.org.apache.hadoop.fs.Path(f"{root}/log/{version:020d}.json")
    files = file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        out = files.create(file, False)
    except Py4JJavaError as error:
        raise RuntimeError(f"version {version} of {root} has been published by another job; run this one again") from error
    out.write(bytearray(json.dumps(entry).encode() + b"\n"))
    out.close()


def save_bucketed(cells: DataFrame, table: str, buckets: int, *, path: str | None = None) -> None:
    """Save as a catalog table bucketed by cell address.

    Upserts into such a table shuffle only the new cells (see
    ``operators.cells.apply_mutations``).
    """
    # One task per bucket, so that the table has one file per bucket.
    writer = (
        cells.repartition(buckets, *ADDRESS)
        .write.mode("errorifexists")
        .format("parquet")
        .bucketBy(buckets, *ADDRESS)
        .sortBy(*ADDRESS)
    )
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)

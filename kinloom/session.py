"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Runtime re-planning: coalesce small shuffle partitions, split skewed join
    # partitions, switch to a broadcast join once a side is measured to be small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Timestamps in files are UTC.
    "spark.sql.session.timeZone": "UTC",
}


def session(app: str, *, shuffle_partitions: int | None = None, **settings: str) -> SparkSession:
    """A session with the settings the jobs are planned for.

    The master and memory come from spark-submit. ``shuffle_partitions`` is the
    number before AQE coalescing; on a large cluster set it to a few times the
    number of cores.
    """
    builder = SparkSession.builder.appName(app)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


#: For each ``passing`` that is open the folders named since.
_PASSING: list[list[str]] = []


def scratch_dir(spark: SparkSession, label: str, lasting: bool = False) -> str:
    """A new folder under ``spark.checkpoint.dir``, which every executor can reach.

    The setting is required: a machine's own folder is no place for tables. The folder goes
    with the ``passing`` it is named in, a ``lasting`` one with the next around that, if any.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    path = f"{root.rstrip('/')}/kinloom/{label}-{uuid.uuid4().hex}"
    if len(_PASSING) > lasting:
        _PASSING[-1 - lasting].append(path)
    return path


#: Whether Spark removes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries run here leave no shuffle files, which else stay until the driver collects its garbage.

    Only for a query that is run once, such as one that writes a table: what is read
    afterwards is that table.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Folders of ``scratch_dir`` are removed at the end: only for work whose results are in lasting ones by then."""
    _PASSING.append([])
    try:
        yield
    finally:
        for path in _PASSING.pop():
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def staged(df: DataFrame, label: str, codec: str | None = None, lasting: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: what follows starts from there."""
    path = scratch_dir(df.sparkSession, label, lasting)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)

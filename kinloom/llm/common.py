"""Tables as the operators read them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def partitions(df: DataFrame) -> int:
    """Number of shuffle partitions of the session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id, text`` and the columns named; a null text is empty. Other columns are ignored."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more
    )

"""From raw documents to packed training sequences, one written table after another."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from kinloom.llm.common import documents
from kinloom.llm.crf_quality import accepted, train
from kinloom.llm.line_dedup import without_repeats
from kinloom.llm.mixing import sample
from kinloom.llm.packing import best_fit_packing, token_pieces
from kinloom.llm.shingle_join import keep_one_alike
from kinloom.session import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier rejects go."""
    return accepted(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier line repeats go; documents stay."""
    return without_repeats(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles with a similarity of 0.8 or more link, SimHash first."""
    return keep_one_alike(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn so that sources, languages and topics meet their target weights."""
    return sample(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, each with its sequence and its place there."""
    return best_fit_packing(token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("near-dedup", near_duplicates),
    ("mixing", mixing),
    ("best-fit packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; every other one is written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: A trained model cannot be put in SQL; the stages are tested one by one.
ORACLE_SQL = None

"""One registered query for each operator, with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinloom.llm import kd_topk, lattice_dedup, line_dedup, mixing, periodic_runs, secret_scan, suffix_dedup
from kinloom.llm.alignment import align
from kinloom.llm.common import documents
from kinloom.llm.crf_quality import quality_scores, train
from kinloom.llm.kd_topk import top_k
from kinloom.llm.lattice_dedup import near_duplicates
from kinloom.llm.packing import best_fit_packing, token_pieces
from kinloom.llm.sharding import place_documents
from kinloom.llm.simhash import simhash_groups
from kinloom.llm.suffix_dedup import remove_repeats
from kinloom.llm.token_files import read_tokens, write_tokens

VOCABULARY = "word_bpe_49k.json"
SHARDS = {f"shard-{i:03d}": 1 for i in range(256)}


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(documents(spark, sf_dir))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(documents(spark, sf_dir))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(documents(spark, sf_dir))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return place_documents(documents(spark, sf_dir), SHARDS)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    chain = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_scores(docs, chain)


def op7_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan_secrets(documents(spark, sf_dir)))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(token_pieces(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY)))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_tokens(write_tokens(documents(spark, sf_dir), public_tokenizers.path(VOCABULARY), 1))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.periodic_runs(periodic_runs.planted(documents(spark, sf_dir))))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabularies = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    found = align(documents(spark, sf_dir), *vocabularies)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return found.withColumn("groups_sha256", digest).drop("groups")


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_mixing": op2_mixing,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_sharding": op5_sharding,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_exact_top_k": op7_exact_top_k,
    "op8_secret_scan": op8_secret_scan,
    "op9_embedding_near_dedup": op9_embedding_near_dedup,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_token_files": op11_token_files,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_alignment": op13_alignment,
}

ORACLES: dict[str, str] = {
    "op1_suffix_dedup": suffix_dedup.oracle(),
    "op7_exact_top_k": kd_topk.oracle(),
    "op9_embedding_near_dedup": lattice_dedup.oracle(),
    "op2_mixing": mixing.oracle(),
    "op4_line_dedup": line_dedup.oracle(),
    "op8_secret_scan": secret_scan.oracle(),
}

from conftest import tuples
from pyspark.sql import functions as F

from kinloom.functions.identity import same_pel
from kinloom.plans.match_table import load_match_table_by_length, load_match_table_join

M, S1, S2 = "a" * 32, "b" * 40, "c" * 64
POSITIONS = dict(provider_sha256=0, kb_clink=0, kb_md5=1, kb_sha1=2, kb_sha256=3, pel_fn=same_pel)


def test_only_records_the_provider_lists_are_loaded(lines):
    provider = lines([S2, S2, "", "|x"])
    kb = lines([f"p1|{M}|{S1}|{S2}", f"p2|{M}|{S1}|{'d' * 64}", f"|{M}|{S1}|{S2}", f'"p3"||{S1}|"{S2}"'])
    loaded = load_match_table_join(provider, kb, None, **POSITIONS)
    assert tuples(loaded.table.select("row_key", "qualifier", "value")) == sorted(
        [("p1", "md5", M), ("p1", "sha1", S1), ("p1", "sha256", S2)]
        + [("p3", "md5", ""), ("p3", "sha1", S1), ("p3", "sha256", S2)]
    )
    assert loaded.rejects.count() == 3


def test_absent_hash_columns_are_blank(lines):
    loaded = load_match_table_join(
        lines([S2]), lines([f"p|{S2}"]), None, **{**POSITIONS, "kb_md5": 5, "kb_sha1": 6, "kb_sha256": 1}
    )
    assert [r["value"] for r in loaded.table.orderBy("qualifier").collect()] == ["", "", S2]


def test_by_length_drops_blank_ids_and_fills_blanks(lines):
    loaded = load_match_table_by_length(lines([f"p|{S1}", f" |{M}", "p2"]), None, pel_fn=same_pel)
    assert tuples(loaded.table.select("row_key", "qualifier", "value")) == [
        ("p", "md5", ""), ("p", "sha1", S1), ("p", "sha256", ""),
    ]
    assert loaded.rejects.count() == 1


def test_later_loads_overwrite_at_equal_time_by_greatest_value(lines):
    first = load_match_table_by_length(lines([f"p|{'1' * 32}"]), None, pel_fn=same_pel).table
    second = load_match_table_by_length(lines([f"p|{'2' * 32}"]), first, pel_fn=same_pel).table
    assert second.where(F.col("qualifier") == "md5").select("value").first()[0] == "2" * 32
    assert second.count() == 3


def test_hot_hash_is_split_by_adaptive_execution(spark, setting):
    """A third of the records carries one hash; its partition of the semi-join is split."""
    setting(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20kb",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="10kb",
        spark__sql__shuffle__partitions="16",
    )
    shared = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).cast("string")
    own = F.col("id").cast("string")
    kb = spark.range(0, 30_000, numPartitions=8).select(
        F.concat_ws("|", F.concat(F.lit("p"), own), F.md5(own), F.sha1(own), F.sha2(shared, 256)).alias("value")
    )
    provider = spark.range(0, 30_000, numPartitions=8).select(F.sha2(F.col("id").cast("string"), 256).alias("value"))
    table = load_match_table_join(provider, kb, None, salts=2, **POSITIONS).table
    assert table.select("row_key").distinct().count() == 30_000
    table.collect()
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan

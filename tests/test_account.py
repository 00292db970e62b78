import pytest
from conftest import tuples
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinloom.functions.identity import salted_account_arl
from kinloom.plans.account import account_keys, account_load_incremental, account_refresh_full

ARL = salted_account_arl("s")
OPTIONS = dict(cid_key="CID", delimiter=",", arl_fn=ARL, load_ts=9)
SCHEMA = "row_key string, family string, qualifier string, ts_micros bigint, value string"


def tables(spark, *rows):
    """Both tables for (ana, cid, pel) rows written at time 1."""
    df = spark.createDataFrame(rows, "ana int, cid string, pel string")
    common = [F.lit("pel").alias("family"), F.lit("pel").alias("qualifier"), F.lit(1).cast("bigint").alias("ts_micros"), F.col("pel").alias("value")]
    diff = df.select(F.concat_ws("#", F.col("ana").cast("string"), "cid").alias("row_key"), *common)
    return diff, df.select(ARL(F.col("ana"), F.col("cid")).alias("row_key"), *common)


def by_key(df):
    return {r["row_key"]: r["value"] for r in df.collect()}


def arl_of(spark, *rows):
    """Expected row keys of the hashed table."""
    return by_key(tables(spark, *rows)[1])


START = [(1, "a", "XY1"), (12, "a", "XY2"), (12, "b#c", "XY3"), (123, "a", "XY4")]


def test_incremental_upserts_only_what_comes_in(spark, lines):
    diff, arl = tables(spark, *START)
    loaded = account_load_incremental(lines(["CID=a,P=XYnew", "CID=n,P=Xi1"]), diff, arl, ana=12, **OPTIONS)
    assert by_key(loaded.diff) == {
        "1#a": "XY1", "12#a": "XYnew", "12#b#c": "XY3", "123#a": "XY4", "12#n": "Xi1",
    }
    want = [(1, "a", "XY1"), (12, "a", "XYnew"), (12, "b#c", "XY3"), (123, "a", "XY4"), (12, "n", "Xi1")]
    assert by_key(loaded.arl) == arl_of(spark, *want)


def test_incremental_is_idempotent_and_starts_from_nothing(spark, lines):
    data = lines(["CID=a,P=XY1", "CID=a,P=XY2", "bad"])
    once = account_load_incremental(data, None, None, ana=7, **OPTIONS)
    twice = account_load_incremental(data, once.diff, once.arl, ana=7, **OPTIONS)
    assert tuples(once.diff) == [("7#a", "pel", "pel", 9, "XY2")] == tuples(twice.diff)
    assert tuples(once.arl) == tuples(twice.arl)
    assert once.rejects.count() == 1


def test_refresh_replaces_one_account_and_no_other(spark, lines):
    diff, arl = tables(spark, *START)
    loaded = account_refresh_full(lines(["CID=a,P=XYnew", "CID=n,P=Xi1"]), diff, arl, ana=12, **OPTIONS)
    want = [(1, "a", "XY1"), (12, "a", "XYnew"), (12, "n", "Xi1"), (123, "a", "XY4")]
    assert by_key(loaded.diff) == {"1#a": "XY1", "12#a": "XYnew", "12#n": "Xi1", "123#a": "XY4"}
    # The customer id with a '#' is gone from the hashed table, too.
    assert by_key(loaded.arl) == arl_of(spark, *want)


def test_refresh_deletes_all_families_of_a_row(spark, lines):
    diff, arl = tables(spark, *START)
    arl = arl.unionByName(arl.withColumn("family", F.lit("uk")))
    loaded = account_refresh_full(lines(["CID=a,P=XYnew"]), diff, arl, ana=12, **OPTIONS)
    assert loaded.arl.where("family = 'uk'").count() == 2
    assert loaded.arl.where("family = 'pel'").count() == 3


def test_prefix_match_also_covers_longer_account_numbers(spark, lines):
    diff, arl = tables(spark, *START)
    loaded = account_refresh_full(
        lines(["CID=a,P=XYnew"]), diff, arl, ana=12, match="prefix", **OPTIONS
    )
    assert by_key(loaded.diff) == {"1#a": "XY1", "12#a": "XYnew"}
    assert by_key(loaded.arl) == arl_of(spark, (1, "a", "XY1"), (12, "a", "XYnew"))


def test_refresh_with_an_empty_file_clears_the_account(spark, lines):
    diff, arl = tables(spark, *START)
    loaded = account_refresh_full(lines([]), diff, arl, ana=12, **OPTIONS)
    assert sorted(by_key(loaded.diff)) == ["1#a", "123#a"]
    assert loaded.arl.count() == 2


def test_refresh_starts_from_nothing(spark, lines):
    data = lines(["CID=a,P=XY1"])
    loaded = account_refresh_full(data, None, None, ana=12, **OPTIONS)
    assert tuples(loaded.diff) == [("12#a", "pel", "pel", 9, "XY1")]
    assert by_key(loaded.arl) == arl_of(spark, (12, "a", "XY1"))
    kept = account_refresh_full(data, None, tables(spark, (1, "b", "XY2"))[1], ana=12, **OPTIONS)
    assert by_key(kept.arl) == arl_of(spark, (1, "b", "XY2"), (12, "a", "XY1"))


def test_keys_without_an_account_or_customer_are_left_out(spark):
    rows = [(k, "pel", "pel", 1, "v") for k in ("12", "12#", "12#a#b", "12x#a", "12#c")]
    keys = account_keys(spark.createDataFrame(rows, SCHEMA), 12, match="prefix")
    assert tuples(keys) == [(12, "a#b"), (12, "c")]


def test_options_are_checked_when_the_job_is_built(spark, lines):
    diff, arl = tables(spark, *START)
    with pytest.raises(ValueError, match="account must be an integer"):
        account_load_incremental(lines([]), diff, arl, ana="12", **OPTIONS)
    with pytest.raises(ValueError, match="match must be"):
        account_refresh_full(lines([]), diff, arl, ana=12, match="like", **OPTIONS)


CIDS = st.sampled_from(["a", "b", "a#", "#a", "a#b", "1"])
ROWS = st.lists(st.tuples(st.sampled_from([1, 12, 123]), CIDS, st.sampled_from(["XY1", "XY2"])), max_size=12)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(ROWS, st.dictionaries(CIDS, st.sampled_from(["XY8", "Xi9"]), max_size=4), st.sampled_from(["exact", "prefix"]))
def test_refresh_against_brute_force(spark, lines, rows, new, match):
    old = {(ana, cid): pel for ana, cid, pel in rows}
    diff, arl = tables(spark, *[(a, c, p) for (a, c), p in old.items()])
    loaded = account_refresh_full(
        lines([f"CID={c},P={p}" for c, p in new.items()]), diff, arl, ana=12, match=match, **OPTIONS
    )
    gone = (12,) if match == "exact" else (12, 123)
    want = {k: p for k, p in old.items() if k[0] not in gone}
    want.update({(12, c): p for c, p in new.items()})
    assert by_key(loaded.diff) == {f"{a}#{c}": p for (a, c), p in want.items()}
    assert by_key(loaded.arl) == arl_of(spark, *[(a, c, p) for (a, c), p in want.items()])

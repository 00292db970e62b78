"""State that is brought forward from load to load: owners, counters, last sightings."""

import random
from datetime import datetime, timedelta

import pytest
from conftest import tuples

from kinloom.operators.counters import STANDARD_ERROR, load_counters, merged_counters, observed
from kinloom.operators.owners import merge_load, merge_ranks, owner_per_hash, owner_ranks, owners_of
from kinloom.operators.parse import parse_one_to_many
from kinloom.plans.last_seen import merge_sightings, open_seen, save_seen, seen_lately
from kinloom.plans.recent_pels import recent_pels
from pyspark.sql import Observation
from pyspark.sql import functions as F

CLAIMS = "hash string, clink string, hash_type string"


def claims(rng, n):
    return [(f"h{rng.randint(0, 30)}", f"{rng.choice('ab')}{rng.randint(0, 99):020d}", rng.choice(["MD5", "SHA1"])) for _ in range(n)]


def test_owners_over_loads(spark):
    rng = random.Random(5)
    loads = [spark.createDataFrame(claims(rng, n), CLAIMS) for n in (60, 1, 40)]
    ranks, rows, deltas = owner_ranks(loads[0]), loads[0], []
    for load in loads[1:]:
        before = {r.hash: r for r in owner_per_hash(rows).collect()}
        rows = rows.unionByName(load)
        after = {r.hash: r for r in owner_per_hash(rows).collect()}
        merged = merge_load(ranks, load)
        assert tuples(owners_of(merged.ranks)) == tuples(owner_per_hash(rows))
        # Changes are what differs, and no more.
        want = sorted((h, r.clink, r.hash_type, before[h].clink if h in before else "-") for h, r in after.items() if before.get(h) != r)
        got = merged.changed.select("hash", "rank.clink", "rank.hash_type", F.coalesce("before", F.lit("-")))
        assert tuples(got) == want
        deltas.append(merged.changed.select("hash", "rank"))
        ranks = merged.ranks
    stored = merge_ranks(owner_ranks(loads[0]), *deltas)
    assert tuples(owners_of(stored)) == tuples(owner_per_hash(rows))
    assert merge_load(ranks, loads[1]).changed.count() == 0  # the same load again
    assert tuples(owners_of(merge_load(ranks.limit(0), loads[1]).ranks)) == tuples(owner_per_hash(loads[1]))


def test_sketches_of_loads_add_up(spark):
    """Half of the second load's hashes were in the first; a third of all rows has one hash."""
    def rows(a, b):
        own = F.sha2(F.col("id").cast("string"), 256)
        return spark.range(a, b).select(F.when(F.col("id") % 3 == 0, "00").otherwise(own).alias("hash"))

    bad = spark.createDataFrame([("abc",), ("zz",), ("zz",), ("",), (None,)], "hash string")
    stored = load_counters(rows(0, 60_000), "a").unionByName(load_counters(rows(30_000, 90_000).unionByName(bad), "b"))
    got = {r.reason: (r.n, r.distinct_hashes) for r in merged_counters(stored).collect()}
    n, estimate = got.pop("success")
    assert n == 120_000 and abs(estimate - 60_001) <= 4 * STANDARD_ERROR * 60_001
    assert got == {"odd_length": (1, 1), "bad_chars": (3, 2)}
    alone = {r.load: r.n for r in stored.groupBy("load").agg(F.sum("n").alias("n")).collect()}
    assert alone == {"a": 60_000, "b": 60_004}
    assert max(len(r.hashes) for r in stored.collect()) < 20_000
    assert merged_counters(load_counters(bad.limit(0), "c")).count() == 0


def test_observation_as_rows(spark, lines):
    seen = Observation("links")
    parsed = parse_one_to_many(lines(["a|b", "a", ""]), observation=seen)
    parsed.rows.collect()
    assert tuples(observed(seen, parsed.rows)) == [("lines", 3), ("no_value", 2)]


NOW = datetime(2024, 5, 1, 12)


@pytest.mark.parametrize("cuts", [(0,), (5, 0), (200, 120, 91, 90, 30, 1, 0)])
def test_last_seen_equals_the_full_computation(spark, tmp_path, cuts):
    rng = random.Random(len(cuts))
    rows = [(rng.choice(["1", "3", None]), f"p{rng.randint(0, 40)}" if rng.random() > 0.02 else None, NOW - timedelta(hours=rng.randint(0, 24 * 300))) for _ in range(600)]
    rows += [("3", "edge", NOW - timedelta(days=90)), ("3", "old", NOW - timedelta(days=90, seconds=1)), ("3", "none", None)]
    sightings = spark.createDataFrame(rows, "country string, pel string, ts timestamp_ntz")
    seen, before = None, datetime(1900, 1, 1)
    for back in cuts:
        end = NOW - timedelta(days=back)
        some = [r for r in rows if r[2] and before < r[2] <= end]
        part = spark.createDataFrame(some, "country string, pel string, ts timestamp_ntz")
        path = save_seen(merge_sightings(seen, part, as_of=F.lit(str(end))), str(tmp_path))
        seen, before = open_seen(spark, path), end
    as_of = F.lit(str(NOW)).cast("timestamp_ntz")
    want = recent_pels(sightings.where("pel IS NOT NULL"), country="3", as_of=as_of)
    got = seen_lately(seen, country="3", as_of=as_of)
    assert tuples(got) == tuples(want) and ("edge",) in tuples(got)
    # One row an id, and none that no extract can ask for.
    assert seen.count() == seen.select("country", "pel").distinct().count()
    assert seen.where(F.col("ts") < F.lit(str(NOW - timedelta(days=90))).cast("timestamp_ntz")).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan

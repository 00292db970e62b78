"""Prefix lookup by predecessors in sorted ranges."""

import random

import pytest
from check import compare, connect
from conftest import tuples
from test_lookup import SCHEMA, brute_force, hashed

from catalog.ordered import ORACLES, QUERIES
from kinloom.operators.lookup import last_key_by_range
from kinloom.plans.match_table import match_lookup

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, oracle, name):
    assert compare(spark, oracle, SF, name) == ""


def test_plan_moves_each_key_once(spark, setting):
    """Keys are not copied per length, windows are by range, and nothing is broadcast or paired."""
    setting(spark__sql__autoBroadcastJoinThreshold="-1")
    assert set(QUERIES) == set(ORACLES)
    plan = QUERIES["match_lookup_by_range"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "NestedLoop", "Python", "Pandas", "BroadcastExchange"):
        assert operator not in plan, operator
    cells = spark.createDataFrame([("Xa1", "hashes", "md5", 0, "x")], SCHEMA)
    found = last_key_by_range(cells, spark.createDataFrame([("Xa",)], "prefix string"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_ID") + plan.count("ShufflePartitionIdPassThrough") + plan.count("shufflepartitionid") >= 1, plan
    assert "Generate" not in plan


@pytest.mark.parametrize("parts", [1, 2, 7, 40])
def test_many_lengths_and_prefixes_over_several_ranges(spark, parts):
    """40 lengths; one prefix covers all keys, one a third of them, and one row holds very many cells."""
    rng = random.Random(parts)
    keys = ["".join(rng.choice("abX") for _ in range(rng.randint(1, 45))) for _ in range(900)]
    keys += ["b" * n for n in range(1, 46)] + ["é" * 3, "é\U0010ffff", "z"]
    cells = [(k, "hashes", "md5", 0, "v") for k in keys] + [("hot", "hashes", f"q{i}", 0, "v") for i in range(2000)]
    prefixes = {k[:n] for k in keys for n in range(1, 41)} | {"", "q", "é", "ho", "hot", "hots", "~", "b" * 60}
    table = spark.createDataFrame(cells, SCHEMA).repartition(5)
    asked = spark.createDataFrame([(p,) for p in sorted(prefixes)], "prefix string")
    got = dict(map(tuple, last_key_by_range(table, asked, parts).collect()))
    order = sorted({k for k, *_ in cells}, key=str.encode)
    want = {}
    for p in prefixes:
        under = [k for k in order if k.startswith(p)]
        if under:
            want[p] = under[-1]
    assert got == want and {len(p) for p in want} >= set(range(41))


def test_ranges_are_even(spark):
    cells = spark.createDataFrame([("hot", "f", f"q{i}", 0, "v") for i in range(4000)] + [(f"k{i}", "f", "q", 0, "v") for i in range(4000)], SCHEMA)
    found = last_key_by_range(cells, spark.createDataFrame([("h",), ("k",)], "prefix string"), 8)
    assert tuples(found) == [("h", "hot"), ("k", "k999")]


def test_lookup_equals_the_naive_one(spark, lines):
    rng = random.Random(3)
    table = [("".join(rng.choice("abX") for _ in range(rng.randint(1, 5))), rng.choice(["hashes", "other"]), q, rng.randint(0, 2), hashed(rng.choice("0123"), q)) for q in ("md5", "sha1", "sha256") for _ in range(20)]
    table = [r for r in table if r[1] == "hashes"]
    requests = [(f"c{i}", "".join(rng.choice("abX") for _ in range(rng.randint(0, 6)))) for i in range(40)]
    got = lines([f"{c},{p}" for c, p in requests])
    stored = spark.createDataFrame(table, SCHEMA)
    for option in (False, True):
        assert tuples(match_lookup(got, stored, search="range", blank_matches_all=option)) == brute_force(requests, table, option)


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    asked = spark.createDataFrame([("a",)], "prefix string")
    assert last_key_by_range(none, asked).count() == 0
    some = spark.createDataFrame([("a1", "f", "q", 0, "v"), (None, "f", "q", 0, "v")], SCHEMA)
    assert last_key_by_range(some, asked.limit(0)).count() == 0
    assert tuples(last_key_by_range(some, asked, 3)) == [("a", "a1")]

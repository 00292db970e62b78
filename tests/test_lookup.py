from conftest import tuples
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kinloom.operators.cells import to_cells
from kinloom.plans.match_table import match_lines, match_lookup
from pyspark.sql import functions as F

SCHEMA = "row_key string, family string, qualifier string, ts_micros bigint, value string"


def hashed(letter, kind):
    return letter * {"md5": 32, "sha1": 40, "sha256": 64}[kind]


def brute_force(requests, table, blank_matches_all=False):
    rows = {}
    for key, _, qualifier, ts, value in table:
        row = rows.setdefault(key, {})
        row[qualifier] = max(row.get(qualifier, (-1, "")), (ts, value))
    out = []
    for cookie, prefix in requests:
        hashes = ["", "", ""]
        if prefix or blank_matches_all:
            hits = [k for k in rows if k.startswith(prefix)]
            if hits:
                stored = [rows[max(hits)].get(q, (0, ""))[1] for q in ("md5", "sha1", "sha256")]
                hashes = [next((v for v in stored if len(v) == n), "") for n in (32, 40, 64)]
        out.append((cookie, *hashes))
    return sorted(out)


KEYS = st.text(alphabet="abX", min_size=1, max_size=5)
KINDS = st.sampled_from(["md5", "sha1", "sha256"])
CELLS = st.tuples(KEYS, KINDS, KINDS, st.integers(0, 2), st.sampled_from("0123"))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(CELLS, min_size=1, max_size=40),
    st.lists(st.text(alphabet="abX", max_size=6), min_size=1, max_size=30),
)
def test_lookup_equals_the_naive_prefix_join(spark, lines, writes, prefixes):
    # The kind of a value and the qualifier it is filed under may differ.
    table = [(k, "hashes", q, ts, hashed(c, kind)) for k, q, kind, ts, c in writes]
    requests = [(f"c{i}", p) for i, p in enumerate(prefixes)]
    got = lines([f"{c},{p}" for c, p in requests])
    stored = spark.createDataFrame(table, SCHEMA)
    for option in (False, True):
        found = match_lookup(got, stored, blank_matches_all=option)
        assert tuples(found) == brute_force(requests, table, option)


def test_cells_of_other_families_do_not_supply_hashes(spark, lines):
    table = [
        ("Xa1", "hashes", "md5", 0, hashed("1", "md5")),
        ("Xa2", "other", "md5", 0, hashed("2", "md5")),
    ]
    got = match_lookup(lines(["c,Xa"]), spark.createDataFrame(table, SCHEMA))
    # The last row under the prefix is Xa2, and it has no hashes.
    assert tuples(got) == [("c", "", "", "")]


def test_every_request_is_answered_once(spark, lines):
    table = spark.createDataFrame(
        [("Xa1", "hashes", "md5", 0, hashed("1", "md5")), ("Xb1", "hashes", "md5", 0, hashed("2", "md5"))],
        SCHEMA,
    )
    requests = ["c1,Xa", "c1,Xa", "c2,", " c3 , Xb1 ", "c4,none", "bad", "c5,Xa,x"]
    lines_out = [r["value"] for r in match_lines(match_lookup(lines(requests), table)).collect()]
    one, two = hashed("1", "md5"), hashed("2", "md5")
    assert sorted(lines_out) == sorted([f"c1|{one}||", f"c1|{one}||", "c2|||", f"c3|{two}||", "c4|||"])


def test_pipe_delimited_requests(spark, lines):
    table = spark.createDataFrame([("Xa", "hashes", "md5", 0, hashed("1", "md5"))], SCHEMA)
    got = match_lookup(lines(["c|Xa"]), table, delimiter="|")
    assert tuples(got) == [("c", hashed("1", "md5"), "", "")]


def test_prefix_that_covers_the_whole_table_is_combined_before_the_shuffle(spark, lines, setting):
    setting(spark__sql__autoBroadcastJoinThreshold="-1")
    rows = spark.range(5000).select(
        F.concat(F.lit("Xi"), F.lpad(F.col("id").cast("string"), 8, "0")).alias("k"),
        F.md5(F.col("id").cast("string")).alias("h"),
    )
    table = to_cells(rows, row_key=F.col("k"), family="hashes", columns={"md5": F.col("h")})
    df = match_lookup(lines(["c,Xi"] * 20), table)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    (want,) = rows.where("k = 'Xi00004999'").select("h").collect()
    assert tuples(df) == [("c", want["h"], "", "")] * 20


def test_hot_id_is_split_by_adaptive_execution(spark, setting):
    """A third of the requests asks for one id, a third for none."""
    setting(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10kb",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="5kb",
        spark__sql__shuffle__partitions="16",
    )
    key = F.concat(F.lit("Xi"), F.lpad(F.col("id").cast("string"), 8, "0"))
    ids = spark.range(0, 60_000, numPartitions=8)
    asked = F.when(F.col("id") % 3 == 0, F.lit("Xi00000007")).when(F.col("id") % 3 == 1, key).otherwise("")
    requests = ids.select(F.concat(F.lit("c"), "id", F.lit(","), asked).alias("value"))
    table = to_cells(
        ids, row_key=key, family="hashes", columns={"md5": F.md5(F.col("id").cast("string"))}
    )
    df = match_lookup(requests, table, salts=2)
    assert df.where("md5 <> ''").count() == 40_000
    df.collect()
    assert "SortMergeJoin(skew=true)" in df._jdf.queryExecution().executedPlan().toString()


def test_only_keys_are_cut_to_prefixes(spark, lines, setting, tmp_path):
    setting(spark__sql__autoBroadcastJoinThreshold="-1")
    rows = spark.range(50).select(F.concat(F.lit("X"), "id").alias("k"), F.md5(F.col("id").cast("string")).alias("h"))
    path = str(tmp_path / "cells")
    to_cells(rows, row_key=F.col("k"), family="hashes", columns={"md5": F.col("h")}).write.parquet(path)
    df = match_lookup(lines(["c,X1", "d," + "X" * 40]), spark.read.parquet(path))
    assert df.count() == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert any("struct<row_key:string>" in line for line in scans)
    generate = [line for line in plan.splitlines() if "Generate explode(" in line]
    assert generate and all("value" not in line and "ts_micros" not in line for line in generate)

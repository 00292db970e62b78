import random

from conftest import final_plan, tuples
from pyspark.sql import functions as F

from kinloom.operators.cells import (
    ADDRESS,
    CELL,
    apply_mutations,
    latest,
    latest_links,
    pivot_rows,
    replace_rows,
    scan_prefix,
    to_cells,
)
from kinloom.sources.snapshots import save_bucketed

SCHEMA = "row_key string, family string, qualifier string, ts_micros bigint, value string"


def cells(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_highest_timestamp_then_greatest_value_wins(spark):
    writes = cells(
        spark,
        ("a", "f", "q", 1, "z"),
        ("a", "f", "q", 2, "b"),
        ("a", "f", "q", 2, "c"),
        ("a", "g", "q", 0, ""),
    )
    assert tuples(latest(writes)) == [("a", "f", "q", 2, "c"), ("a", "g", "q", 0, "")]


def test_links_keep_one_cell_per_member(spark):
    writes = cells(spark, ("a", "f", "x", 1, ""), ("a", "f", "x", 3, ""), ("a", "f", "y", 2, ""))
    assert tuples(latest_links(writes)) == tuples(latest(writes))


def upsert(current, puts, deleted=()):
    """Brute force."""
    table = {c[:3]: c[3:] for c in current if c[0] not in deleted}
    for put in puts:
        table[put[:3]] = max(table.get(put[:3], (-1, "")), put[3:])
    return sorted(k + v for k, v in table.items())


def test_mutations_against_brute_force(spark):
    rng = random.Random(1)

    def some(n, keys):
        return [
            (f"k{rng.randrange(keys)}", rng.choice("fg"), rng.choice("pq"), rng.randrange(4), rng.choice("xyz"))
            for _ in range(n)
        ]

    current = upsert([], some(300, 60))
    puts = some(200, 90)
    # A third of the writes go to one address, and a third of the table to one row.
    puts += [("k1", "f", "p", 2, rng.choice("xyz")) for _ in range(100)]
    current = upsert(current, [("wide", "f", f"m{i}", 0, "") for i in range(100)])
    deleted = {f"k{i}" for i in range(0, 60, 7)} | {"wide"}
    keys = spark.createDataFrame([(k,) for k in deleted] * 2, "row_key string")
    now, new = cells(spark, *current), cells(spark, *puts)
    assert tuples(apply_mutations(now, new)) == upsert(current, puts)
    assert tuples(apply_mutations(None, new)) == upsert([], puts)
    assert tuples(apply_mutations(now, new, keys)) == upsert(current, puts, deleted)
    assert tuples(replace_rows(now, new, keys)) == upsert(current, puts, deleted)


def test_upsert_is_idempotent(spark):
    table = cells(spark, ("a", "f", "q", 1, "x"), ("b", "f", "q", 1, "x"))
    puts = cells(spark, ("a", "f", "q", 2, "y"), ("c", "f", "q", 2, "y"))
    once = apply_mutations(table, puts)
    assert tuples(apply_mutations(once, puts)) == tuples(once)


def test_a_row_without_values_writes_nothing(spark):
    df = spark.createDataFrame([("a", None, None), ("b", "1", None)], "k string, x string, y string")
    columns = {"x": F.col("x"), "y": F.col("y")}
    got = to_cells(df, row_key=F.col("k"), family="f", columns=columns)
    assert tuples(got) == [("b", "f", "x", 0, "1")]
    blank = to_cells(df, row_key=F.col("k"), family="f", columns=columns, null_as_blank=True)
    assert blank.count() == 4 and blank.columns == CELL


def test_prefix_scan_and_pivot(spark):
    table = cells(
        spark,
        ("12#a", "f", "x", 1, "old"),
        ("12#a", "f", "x", 2, "new"),
        ("12#a", "g", "y", 2, "other"),
        ("123#b", "f", "y", 1, "v"),
    )
    assert tuples(scan_prefix(table, "12#")) == [("12#a",)]
    assert tuples(scan_prefix(table, "12")) == [("12#a",), ("123#b",)]
    assert tuples(pivot_rows(table, "f", ["x", "y"])) == [("12#a", "new", None), ("123#b", None, "v")]


def test_upsert_into_a_bucketed_table_does_not_move_it(spark, setting, tmp_path):
    setting(spark__sql__autoBroadcastJoinThreshold="-1")
    rows = [(f"k{i}", "f", "q", 1, "v") for i in range(200)]
    save_bucketed(cells(spark, *rows), "bucketed_cells", 4, path=str(tmp_path / "t"))
    puts = [("k3", "f", "q", 2, "w"), ("new", "f", "q", 2, "w")]
    merged = apply_mutations(spark.table("bucketed_cells"), cells(spark, *puts))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # the puts
    assert tuples(merged) == upsert(rows, puts)
    spark.sql("DROP TABLE bucketed_cells")


def test_replace_rows_shuffles_the_table_once(spark, setting, tmp_path):
    setting(spark__sql__autoBroadcastJoinThreshold="-1")
    path = str(tmp_path / "c")
    cells(spark, *[(f"k{i}", "f", "q", 1, "v") for i in range(50)]).write.parquet(path)
    table = spark.read.parquet(path)
    keys = table.select("row_key").where("row_key < 'k2'")
    puts = cells(spark, ("k0", "f", "q", 2, "w"))
    plan = replace_rows(table, puts, keys)._jdf.queryExecution().executedPlan().toString()
    # The table, the keys, and the puts once to reduce and once to meet the table.
    assert plan.count("Exchange hashpartitioning") == 4


def test_replace_rows_holds_when_partitions_are_coalesced(spark, setting):
    setting(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__shuffle__partitions="40")

    def made(n, step, ts):
        key = F.sha1((F.col("id") * step).cast("string"))
        return spark.range(n).select(
            key.alias("row_key"),
            F.lit("f").alias("family"),
            F.when(F.col("id") % 5 == 0, "a").otherwise("b").alias("qualifier"),
            F.lit(ts).cast("bigint").alias("ts_micros"),
            F.col("id").cast("string").alias("value"),
        )

    table, puts = made(20_000, 1, 1), made(4_000, 7, 2)
    keys = table.where(F.col("value").endswith("9")).select("row_key")
    one, other = replace_rows(table, puts, keys), apply_mutations(table, puts, keys)
    assert one.exceptAll(other).count() == 0 == other.exceptAll(one).count()
    assert one.count() == one.select(*ADDRESS).distinct().count()


def test_hot_address_is_combined_before_the_shuffle(spark):
    hot = spark.range(20_000).select(
        F.lit("k").alias("row_key"),
        F.lit("f").alias("family"),
        F.lit("q").alias("qualifier"),
        F.col("id").alias("ts_micros"),
        F.col("id").cast("string").alias("value"),
    )
    df = latest(hot)
    plan = final_plan(df)
    assert "partial_max" in plan
    assert tuples(df) == [("k", "f", "q", 19_999, "19999")]
    assert df.columns == CELL and ADDRESS == CELL[:3]

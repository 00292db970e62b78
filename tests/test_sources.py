import gzip
from pathlib import Path

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from kinloom.fixed import MATCH_HEADER
from kinloom.plans.recent_pels import recent_pels
from kinloom.session import scratch_dir, staged
from kinloom.sources.lines import read_lines
from kinloom.sources.sinks import join_fields, write_lines
from kinloom.sources.snapshots import (
    append_snapshot,
    current_version,
    open_snapshot,
    publish_snapshot,
)

SCHEMA = "row_key string, family string, qualifier string, ts_micros bigint, value string"


def text_of(path):
    return [p.read_text() for p in sorted(Path(path).glob("part-*"))]


def test_globs_and_gzip(spark, tmp_path):
    (tmp_path / "in-001").write_text("a\nb\r\n")
    with gzip.open(tmp_path / "in-002.gz", "wt") as out:
        out.write("c\n\nd")
    got = read_lines(spark, f"{tmp_path}/in-00*", spread=3)
    assert got.rdd.getNumPartitions() == 3
    assert sorted(r["value"] for r in got.collect()) == ["", "a", "b", "c", "d"]
    with pytest.raises(ValueError):
        read_lines(spark)


def test_lines_are_written_raw_under_a_header(lines, tmp_path):
    path = str(tmp_path / "out")
    values = ['a|"q"|', "  b, |x", "#|", "c\\d|", "|é\t|"]
    write_lines(lines(values), path, header=MATCH_HEADER, single_file=True)
    (text,) = text_of(path)
    first, *rest = text.split("\n")[:-1]
    assert first == MATCH_HEADER and sorted(rest) == sorted(values)


def test_the_header_is_written_without_rows(lines, tmp_path):
    path = str(tmp_path / "out")
    write_lines(lines([]), path, header=MATCH_HEADER, single_file=True)
    assert "".join(text_of(path)) == MATCH_HEADER + "\n"


def test_every_task_writes_its_own_file_by_default(lines, tmp_path):
    path = str(tmp_path / "out")
    write_lines(lines([str(i) for i in range(8)]).repartition(4), path)
    assert len(text_of(path)) == 4


def test_null_prints_as_an_empty_field(spark):
    df = spark.createDataFrame([("a", None, 1)], "x string, y string, z int")
    assert tuples(df.select(join_fields("|", F.col("x"), F.col("y"), F.col("z")))) == [("a||1",)]


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "table")
    assert current_version(spark, root) == 0
    with pytest.raises(ValueError, match="no such snapshot"):
        open_snapshot(spark, root)
    first = spark.createDataFrame([("a", "f", "q", 1, "x")], SCHEMA)
    assert publish_snapshot(first, root) == 1
    # A version may be built from the one before.
    grown = open_snapshot(spark, root).unionByName(spark.createDataFrame([("b", "f", "q", 1, "x")], SCHEMA))
    assert publish_snapshot(grown, root, by_key=True) == 2
    assert open_snapshot(spark, root).count() == 2
    assert tuples(open_snapshot(spark, root, 1)) == tuples(first)


def test_additions_are_merged_on_read(spark, tmp_path):
    root = str(tmp_path / "table")

    def cells(*rows):
        return spark.createDataFrame(list(rows), SCHEMA)

    append_snapshot(cells(("a", "f", "q", 1, "x")), root)
    append_snapshot(cells(("a", "f", "q", 2, "y"), ("b", "f", "q", 0, "z")), root)
    merged = [("a", "f", "q", 2, "y"), ("b", "f", "q", 0, "z")]
    assert tuples(open_snapshot(spark, root)) == merged
    assert tuples(open_snapshot(spark, root, 1)) == [("a", "f", "q", 1, "x")]
    assert open_snapshot(spark, root, merged=False).count() == 3
    publish_snapshot(open_snapshot(spark, root), root)
    append_snapshot(cells(("c", "f", "q", 0, "w")), root)
    assert open_snapshot(spark, root, merged=False).count() == 3
    assert tuples(open_snapshot(spark, root)) == merged + [("c", "f", "q", 0, "w")]


def test_a_failed_publish_leaves_the_table_as_it_was(spark, tmp_path):
    root = str(tmp_path / "table")
    good = spark.createDataFrame([("a", "f", "q", 1, "x")], SCHEMA)
    publish_snapshot(good, root)
    bad = good.withColumn("value", F.raise_error(F.lit("boom")))
    with pytest.raises(Exception, match="boom"):
        publish_snapshot(bad, root)
    assert current_version(spark, root) == 1
    assert tuples(open_snapshot(spark, root)) == tuples(good)
    assert publish_snapshot(good, root) == 2


def test_of_two_writers_of_a_version_one_fails_and_readers_keep_the_other(spark, tmp_path):
    root = str(tmp_path / "table")

    def cells(key):
        return spark.createDataFrame([(key, "f", "q", 1, "x")], SCHEMA)

    publish_snapshot(cells("a"), root)
    first, second = open_snapshot(spark, root).unionByName(cells("b")), open_snapshot(spark, root).unionByName(cells("c"))
    assert publish_snapshot(first, root, after=1) == 2
    with pytest.raises(RuntimeError, match="another job"):
        publish_snapshot(second, root, after=1)
    assert tuples(open_snapshot(spark, root).select("row_key")) == [("a",), ("b",)]
    assert publish_snapshot(open_snapshot(spark, root), root, after=2) == 3


def test_key_order_lets_a_prefix_scan_skip_files(spark, setting, tmp_path):
    setting(spark__sql__adaptive__coalescePartitions__enabled="false")
    root = str(tmp_path / "table")
    rows = spark.range(4000).select(
        F.concat(F.col("id") % 40, F.lit("#"), "id").alias("row_key"),
        F.lit("f").alias("family"),
        F.lit("q").alias("qualifier"),
        F.lit(0).cast("bigint").alias("ts_micros"),
        F.lit("v").alias("value"),
    )
    publish_snapshot(rows, root, by_key=True)
    table = open_snapshot(spark, root)
    scan = table.where(F.col("row_key").startswith("12#")).select("row_key")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(row_key,12#)" in plan and "ReadSchema: struct<row_key:string>" in plan
    holders = scan.select(F.input_file_name()).distinct().count()
    assert holders <= 2 < table.select(F.input_file_name()).distinct().count()


def test_scratch_is_under_the_shared_folder(spark):
    assert staged(spark.range(3), "x").count() == 3
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_recent_ids(spark):
    rows = [
        ("FR", "2024-03-31", "a"), ("FR", "2024-01-01", "b"), ("FR", "2023-12-31", "c"),
        ("GB", "2024-03-31", "d"), ("FR", "2024-03-01", "a"), ("FR", "2024-04-01", "e"),
    ]
    sightings = spark.createDataFrame(rows, "country string, ts string, pel string").withColumn(
        "ts", F.to_timestamp("ts")
    )
    as_of = F.to_timestamp(F.lit("2024-03-31"))
    assert tuples(recent_pels(sightings, country="FR", as_of=as_of)) == [("a",), ("b",)]

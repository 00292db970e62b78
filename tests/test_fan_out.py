"""Several outputs of a load come from one read and one parse of its lines."""

import pytest
from conftest import tuples

from kinloom.operators.parse import parse_columns, parse_hashes_by_length, parse_identity_records
from kinloom.plans.two_way import load_two_way
from pyspark.sql import Observation

LINES = ["a|b|c", "a|b", "x||y|", "lonely", "", "|z|"]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def load(lines, **options):
    return load_two_way(lines, None, None, family="f", load_ts=1, **options)


def test_outputs_are_the_same(lines):
    once, apart = (load(lines(LINES), once=o) for o in (True, False))
    for a, b in zip(once, apart, strict=True):
        assert tuples(a) == tuples(b)
    assert tuples(once.rejects) == [("", "no_value"), ("lonely", "no_value"), ("|z|", "no_value")]


def test_lines_are_parsed_by_one_job(spark, lines, tmp_path):
    lines(LINES * 50).write.text(str(tmp_path / "in"))
    counted = Observation("lines")
    text = spark.read.text(str(tmp_path / "in"))
    loaded = load(text, once=True, observation=counted)
    # Counted when the one write was done, before any output is asked for.
    assert counted.get == {"lines": 300, "no_value": 150}
    for part in (tmp_path / "in").glob("part-*"):
        part.unlink()  # nothing reads the lines again
    assert loaded.forward.count() == 3 and loaded.reverse.count() == 3 and loaded.rejects.count() == 150
    for df, folder in ((loaded.forward, "rows"), (loaded.reverse, "rows"), (loaded.rejects, "rejects")):
        plan = plan_of(df)
        assert "split(" not in plan and " text" not in plan and f"sink#" in plan
        physical = df._jdf.queryExecution().executedPlan().toString()
        assert f"= {folder})" in physical and "PartitionFilters: [isnotnull(sink" in physical
    apart = load(text)
    assert all("split(" in plan_of(df) for df in (apart.forward, apart.reverse, apart.rejects))


@pytest.mark.parametrize(
    "parse, data",
    [
        (parse_identity_records, ["c|s|m|t", "short", "c|||", ""]),
        (parse_hashes_by_length, ["c|" + "a" * 32, '"open|x', "c"]),
        (lambda df, **o: parse_columns(df, {"a": 0, "b": 1}, required=("a",), **o), ["x|y", "|y", "x", '"x|']),
    ],
)
def test_other_parsers(lines, parse, data):
    a, b = parse(lines(data), once=True), parse(lines(data))
    assert a.rows.columns == b.rows.columns
    assert tuples(a.rows) == tuples(b.rows) and tuples(a.rejects) == tuples(b.rejects)


def test_all_lines_in_one_sink(lines):
    assert load(lines(["lonely"]), once=True).forward.count() == 0
    assert load(lines(["a|b"]), once=True).rejects.count() == 0
    assert load(lines([]), once=True).forward.count() == 0

from collections import Counter

import pytest
from conftest import tuples
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F

from kinloom.operators.parse import (
    parse_account_lines,
    parse_arl_pel,
    parse_columns,
    parse_hashes_by_length,
    parse_id_hash,
    parse_identity_records,
    parse_one_to_many,
    parse_pairs,
)
from kinloom.sources.lines import infer_delimiter


def account(lines, *values, **options):
    return parse_account_lines(lines(values), cid_key="CID", **{"delimiter": ",", **options})


def reasons(parsed):
    return Counter(r["reason"] for r in parsed.rejects.collect())


def test_greatest_id_wins(lines):
    assert tuples(account(lines, "CID=1,A=XYz,B=Xia,C=Xib,D=zz").rows) == [("1", "Xib")]


def test_preferred_key_wins_even_if_blank(lines):
    key = "LRI_DER_LRI_SHA256_EMAIL1"
    parsed = account(lines, f"CID=1,A=Xiz,{key}=any", f"CID=2,A=Xiz,{key}=", f'CID=3,{key}=""')
    assert tuples(parsed.rows) == [("1", "any")]
    assert reasons(parsed) == {"no_pel": 2}


def test_quotes_and_spaces_around_values(lines):
    assert tuples(account(lines, '\t CID="a b",P="XY1" ').rows) == [("a b", "XY1")]


def test_malformed_account_lines(lines):
    parsed = account(
        lines, "CID=1,P=XY=1", "CID=1,P", "CID=1,CID=2,P=XY", "", "  \t", "P=XY1", 'CID="",P=XY1'
    )
    assert parsed.rows.count() == 0
    assert reasons(parsed) == {"malformed_pair": 2, "duplicate_key": 1, "no_cid": 2}


def test_strict_fails_on_a_malformed_line(lines):
    assert account(lines, "CID=1,P=XY1", strict=True).rows.count() == 1
    with pytest.raises(Exception, match="malformed key=value line"):
        account(lines, "CID=1,P", strict=True).rows.collect()


def test_delimiter_is_inferred_outside_quotes(lines):
    assert infer_delimiter(lines(["", 'CID="a,b,c"|P=XY1'])) == "|"
    assert infer_delimiter(lines(["A=1;B=2;C=3,4"])) == ";"
    assert infer_delimiter(lines(["A=1"])) == ","
    assert infer_delimiter(lines([" "])) == ","
    assert infer_delimiter(lines([])) == ","
    assert infer_delimiter(lines(["A=1", "A=1,B=2", "A=1;B=2", "A=3;B=2"])) == ";"
    assert tuples(account(lines, "CID=7\tP=XY1", delimiter=None).rows) == [("7", "XY1")]


def test_required_columns(lines):
    parsed = parse_columns(
        lines(["a|b|c", "a| |c", "a", 'x|"b|b"', '"a|b']),
        {"first": 0, "second": 1, "third": 2},
        required=("second",),
    )
    assert tuples(parsed.rows) == [("a", "b", "c"), ("x", "b|b", None)]
    assert reasons(parsed) == {"blank_second": 2, "open_quote": 1}


def test_positions_are_checked_when_the_job_is_built(lines):
    with pytest.raises(ValueError, match="negative position"):
        parse_columns(lines([]), {"a": -1})
    with pytest.raises(ValueError, match="without a position"):
        parse_columns(lines([]), {"a": 0}, required=("b",))
    with pytest.raises(ValueError, match="md5|MD5=-1, SHA1=-2"):
        parse_identity_records(lines([]), md5=-1, sha1=-2)


def test_identity_records_honour_their_positions(lines):
    parsed = parse_identity_records(lines(["s1|m5|s2|c"]), clink=3, md5=1, sha1=0, sha256=2)
    assert tuples(parsed.rows) == [("m5", "c", "MD5"), ("s1", "c", "SHA1"), ("s2", "c", "SHA256")]


def test_identity_records_that_end_in_blanks_are_too_short(lines):
    parsed = parse_identity_records(lines(["c|s|m|", "c||m|x", "c"]))
    assert tuples(parsed.rows.select("hash")) == [("",), ("m",), ("x",)]
    assert reasons(parsed) == {"width": 2}


def test_pairs(lines):
    values = [" a , b ", "a,", "a", "a,b,c", ",b"]
    assert tuples(parse_pairs(lines(values)).rows) == [("", "b"), ("a", ""), ("a", "b")]
    assert tuples(parse_pairs(lines(values), allow_blank=False).rows) == [("a", "b")]
    assert tuples(parse_pairs(lines([" a|b"]), delimiter="|", trim=False).rows) == [(" a", "b")]


def test_undecodable_row_keys_are_rejected(lines):
    parsed = parse_arl_pel(lines(["abc|p", "zz|p", "0A|p"]))
    assert tuples(parsed.rows.select(F.hex("arl"), "pel")) == [("0A", "p")]
    assert reasons(parsed) == {"bad_key": 2}


def test_counters_come_with_the_rows(lines):
    seen = Observation("lines")
    parsed = parse_id_hash(lines(["a b", "a", "c d"]), observation=seen)
    assert parsed.rows.count() == 2
    assert seen.get == {"lines": 3, "width": 1}


PARSERS = {
    "pairs": lambda df: parse_pairs(df),
    "one_to_many": lambda df: parse_one_to_many(df),
    "id_hash": lambda df: parse_id_hash(df),
    "by_length": lambda df: parse_hashes_by_length(df),
    "identity": lambda df: parse_identity_records(df),
    "arl_pel": lambda df: parse_arl_pel(df),
    "columns": lambda df: parse_columns(df, {"a": 0, "b": 1}, required=("b",)),
    "account": lambda df: parse_account_lines(df, cid_key="c", delimiter=","),
}

LINE = st.text(alphabet='ac=,|"\\# \tXé', max_size=14)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(LINE, min_size=1, max_size=40))
def test_every_line_is_either_parsed_or_rejected(spark, values):
    numbered = spark.createDataFrame(list(enumerate(values)), "n int, value string")
    for name, parse in PARSERS.items():
        parsed = parse(numbered)
        rejected = Counter(r["value"] for r in parsed.rejects.collect())
        kept = [v for v in values if not rejected[v]]
        # Equal lines share their fate.
        assert all(rejected[v] == values.count(v) for v in rejected)
        rows = parsed.rows.count()
        if name == "account":
            kept = [v for v in kept if v.strip(" \t")]
        if name == "one_to_many":
            assert rows == sum(len([t for t in v.split("|") if t]) - 1 for v in kept)
        else:
            assert rows == len(kept) * (3 if name == "identity" else 1)

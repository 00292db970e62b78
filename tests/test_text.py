from pyspark.sql import functions as F

from kinloom.functions.hashes import first_of_length, hash_fault
from kinloom.functions.text import (
    is_blank,
    literal_pattern,
    split_all,
    split_quoted,
    split_ragged,
    strip_outer_quotes,
    trim_control,
)


def apply(lines, values, *functions):
    df = lines(values).select(*[f(F.col("value")).alias(f"c{i}") for i, f in enumerate(functions)])
    return [tuple(r) for r in df.collect()]


def test_trim_removes_all_characters_up_to_space(lines):
    values = ["\t a b \x01\n", " a", "", " \t"]
    assert apply(lines, values, trim_control) == [("a b",), (" a",), ("",), ("",)]


def test_blank_is_whitespace_only_or_null(lines):
    values = ["", " \t ", " ", "a", None]
    assert apply(lines, values, is_blank) == [(True,), (True,), (False,), (False,), (True,)]


def test_split_keeps_or_drops_blank_fields_at_the_end(lines):
    got = apply(
        lines, ["a||b||", "", "||"], lambda c: split_all(c, "|"), lambda c: split_ragged(c, "|")
    )
    assert got == [
        (["a", "", "b", "", ""], ["a", "", "b"]),
        ([""], [""]),
        (["", "", ""], [""]),
    ]


def test_split_takes_any_delimiter_as_text(lines):
    for delimiter in ("|", ".", "\\", "a", "||", "\t", "^", "\\E", ".*"):
        line = delimiter.join(["x", "y", ""])
        assert apply(lines, [line], lambda c: split_all(c, delimiter)) == [(["x", "y", ""],)]
        assert apply(lines, [line], lambda c: split_ragged(c, delimiter)) == [(["x", "y"],)]


def test_single_characters_avoid_a_regex():
    assert literal_pattern("|") == "\\|"
    assert literal_pattern(",") == ","


def test_outer_quotes(lines):
    values = ['"a"', '""a""', '"', "a", '"a']
    assert apply(lines, values, strip_outer_quotes) == [("a",), ('"a"',), ("",), ("a",), ("a",)]


def test_quoted_fields(lines):
    cases = {
        "a|b": ["a", "b"],
        'a|"b|c"|d': ["a", "b|c", "d"],
        '"say ""x"""|': ['say "x"', ""],
        r'"a\"b"|c\d': ['a"b', "c\\d"],
        r'"a\\"|b': ["a\\", "b"],
        '"open|b': None,
        'a"b|c"d|e': ["ab|cd", "e"],
        "": [""],
        '""': [""],
        '|""|': ["", "", ""],
    }
    got = apply(lines, list(cases), lambda c: split_quoted(c, "|"))
    assert [g[0] for g in got] == list(cases.values())


def test_quoted_fields_of_great_length(lines):
    line = '"' + "x|" * 200_000 + '"|' + '"' + '""' * 50_000 + '"'
    ((fields,),) = apply(lines, [line], lambda c: split_quoted(c, "|"))
    assert fields == ["x|" * 200_000, '"' * 50_000]


def test_hash_faults(lines):
    values = ["ab", "AB0f", "abc", "zz", "", "-a", "abc\r", None]
    want = [None, None, "odd_length", "bad_chars", "bad_chars", "bad_chars", "bad_chars", None]
    assert [r[0] for r in apply(lines, values, hash_fault)] == want


def test_first_of_length(lines):
    got = apply(lines, ["a,bb,cc", "a"], lambda c: first_of_length(F.split(c, ","), 2))
    assert got == [("bb",), (None,)]

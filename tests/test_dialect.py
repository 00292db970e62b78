"""Separator and quoting judged together by all lines."""

import pytest

from kinloom.sources.lines import Dialect, dialect_scores, infer_delimiter, infer_dialect

NOTES = ["a, b, c", "a", "a, b", ", , , ,", "none"]


@pytest.mark.parametrize(
    "data, want",
    [
        (["a|b|c", "d|e|f", "g|h"], ("|", True)),
        (["a\tb c", "d\te, f", "g\t"], ("\t", True)),
        ([f'"{n}",x,1' for n in NOTES], (",", True)),
        ([f"{n}|x|1" for n in NOTES], ("|", True)),
        ([f'"{n}; ";x' for n in NOTES], (";", True)),
        (["it's 5\" long,a", "6\" x,b", "c,d"], (",", False)),
        (["", "  ", "a;b"], (";", True)),
        (["a,b|c", "d,e|f"], (",", True)),
    ],
)
def test_dialects(lines, data, want):
    assert infer_dialect(lines(data)) == Dialect(*want)


def test_the_commonest_separator_may_be_wrong(lines):
    """Long notes have more commas than there are pipes, but uneven numbers of them."""
    data = [f"{i}|{', '.join('abcdefgh'[: 2 + i % 7])}|x" for i in range(50)]
    assert infer_delimiter(lines(data)) == ","
    assert infer_dialect(lines(data)) == Dialect("|", True)


def test_a_few_odd_lines_do_not_matter(lines):
    data = ["a|b|c"] * 200 + ["title", "one, two, three, four", '"open|quote', "a|b|c|d|e"]
    assert infer_dialect(lines(data)).delimiter == "|"


def test_nothing_to_split(lines):
    for data in ([], ["abc", "d"], [" "]):
        with pytest.raises(ValueError):
            infer_dialect(lines(data))


def test_one_aggregation(lines):
    plan = dialect_scores(lines(["a|b"]))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate inline") == 1 and plan.count("Aggregate") == 2

"""The entry survives whatever its optional part lacks."""

import sys

import pytest

import __spark_entry__ as entry


def test_a_part_that_is_gone(recwarn):
    assert entry._optional("kinloom.no_such_part.queries") is None and not recwarn.list


def test_a_part_that_lacks_a_package(tmp_path, monkeypatch):
    (tmp_path / "lacking.py").write_text("import a_package_nobody_has\n")
    monkeypatch.setattr(sys, "path", [str(tmp_path), *sys.path])
    with pytest.warns(UserWarning, match="a_package_nobody_has"):
        assert entry._optional("lacking") is None


def test_a_broken_part_is_no_missing_one(tmp_path, monkeypatch):
    (tmp_path / "broken.py").write_text("1 / 0\n")
    monkeypatch.setattr(sys, "path", [str(tmp_path), *sys.path])
    with pytest.raises(ZeroDivisionError):
        entry._optional("broken")


def test_all_queries_are_callable_and_oracles_name_queries():
    assert all(map(callable, entry.queries().values()))
    assert set(entry.oracle_sql()) <= set(entry.queries())

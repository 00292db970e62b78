"""Refreshing one account touches its folder and no other."""

import pytest
from conftest import tuples
from test_account import ARL, OPTIONS, START, tables

from kinloom.plans.account import account_refresh_full
from kinloom.plans.account_layout import open_accounts, refresh_account, save_accounts


def files(root):
    return {p.relative_to(root): p.stat().st_mtime_ns for p in root.rglob("part-*")}


@pytest.fixture
def saved(spark, tmp_path):
    diff, arl = tables(spark, *START)
    stray = diff.limit(1).selectExpr("'no account' AS row_key", "family", "qualifier", "ts_micros", "value")
    unknown = arl.limit(1).selectExpr("unhex('00') AS row_key", "'uk' AS family", "qualifier", "ts_micros", "value")
    save_accounts(diff.unionByName(stray), arl.unionByName(unknown), str(tmp_path), arl_fn=ARL)
    return tmp_path, diff.unionByName(stray), arl.unionByName(unknown)


def refresh(lines, root, *data, ana=12):
    options = {k: v for k, v in OPTIONS.items() if k != "arl_fn"}
    return refresh_account(lines(list(data)), str(root), ana=ana, arl_fn=ARL, **options)


def test_layout_holds_both_tables(spark, saved):
    root, diff, arl = saved
    assert tuples(open_accounts(spark, str(root), "diff")) == tuples(diff)
    assert tuples(open_accounts(spark, str(root), "arl")) == tuples(arl)
    assert [r.row_key for r in open_accounts(spark, str(root), "diff", 12).orderBy("row_key").collect()] == ["12#a", "12#b#c"]
    assert open_accounts(spark, str(root), "arl", 12).count() == 2


def test_refresh_equals_the_full_one_and_leaves_other_files_alone(spark, lines, saved):
    root, diff, arl = saved
    before = files(root)
    data = ["CID=a,P=XYnew", "CID=n,P=Xi1", "bad"]
    want = account_refresh_full(lines(data), diff, arl, ana=12, **OPTIONS)
    want = [tuples(want.diff), tuples(want.arl)]
    assert refresh(lines, root, *data).count() == 1
    assert [tuples(open_accounts(spark, str(root), t)) for t in ("diff", "arl")] == want
    after = files(root)
    kept = {p: t for p, t in before.items() if "ana=12" not in p.parts}
    assert len(kept) >= 5 and {p: t for p, t in after.items() if "ana=12" not in p.parts} == kept
    assert not {p for p in before if "ana=12" in p.parts} & after.keys()


def test_refresh_without_valid_lines_empties_the_account(spark, lines, saved):
    root, *_ = saved
    assert refresh(lines, root, "bad").count() == 1
    assert [open_accounts(spark, str(root), t, 12).count() for t in ("diff", "arl")] == [0, 0]
    assert open_accounts(spark, str(root), "diff").count() == 3


def test_new_account(spark, lines, saved):
    root, *_ = saved
    refresh(lines, root, "CID=z,P=XYz", ana=7)
    assert [r.value for r in open_accounts(spark, str(root), "diff", 7).collect()] == ["XYz"]
    assert open_accounts(spark, str(root), "arl", 7).count() == 1
    with pytest.raises(ValueError):
        refresh_account(lines([]), str(root), ana=7, arl_fn=ARL, cid_key="CID", delimiter=",", match="prefix")


def test_one_account_is_read(spark, saved, setting):
    root, *_ = saved
    plan = open_accounts(spark, str(root), "diff", 12)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ana" in plan

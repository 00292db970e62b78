"""The command line, end to end on files."""

import json

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from kinloom.__main__ import main
from kinloom.fixed import ENCRYPTED_HEADER, MATCH_HEADER
from kinloom.functions.identity import salted_account_arl, salted_hash_arl, salted_pel
from kinloom.operators.expansion import linked_hashes
from kinloom.sources.snapshots import open_snapshot

KEY = "0123456789abcdef"
MD5, SHA1, SHA256 = "aa" * 16, "bb" * 20, "cc" * 32


@pytest.fixture
def work(tmp_path, spark):
    class Work:
        def path(self, name):
            return str(tmp_path / name)

        def put(self, name, *lines):
            (tmp_path / name).write_text("".join(line + "\n" for line in lines))
            return self.path(name)

        def lines(self, name):
            parts = sorted((tmp_path / name).glob("part-*"))
            return [line for p in parts for line in p.read_text().splitlines()]

        def run(self, job, *flags, **options):
            named = [x for k, v in options.items() for x in (f"--{k.replace('_', '-')}", str(v))]
            main([job, *named, *flags])

        def table(self, name):
            return open_snapshot(spark, self.path(name))

    made = Work()
    secrets = [{"name": "salt", "value": "s"}, {"name": "key", "value": KEY}]
    made.secrets = made.put("secrets.json", *map(json.dumps, secrets))
    return made


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_mapping_is_built_and_loaded(work, spark):
    people = work.put("people", f"c|{SHA1}|{MD5}|{SHA256}", "c|x", f"d|{SHA1}|{MD5}|")
    work.run("build-mapping", "--single-file", input=people, output=work.path("mapping"),
             secrets=work.secrets, rejects=work.path("bad"))
    pel = one(spark, salted_pel("s")(F.lit("c")))
    lines = work.lines("mapping")
    assert len(lines) == 3 and all(line.endswith(f"|{pel}") for line in lines)
    assert spark.read.parquet(work.path("bad")).count() == 2
    work.run("load-mapping", input=work.path("mapping"), table=work.path("arl"), family="uk")
    arl = one(spark, salted_hash_arl("s")(F.lit(MD5), F.lit("MD5")))
    found = work.table("arl").where(F.col("row_key") == F.lit(arl))
    assert tuples(found.select("family", "qualifier", "value")) == [("uk", "pel", pel)]
    assert work.table("arl").count() == 3


def test_a_load_with_several_outputs_reads_its_input_once(work, spark, monkeypatch):
    import kinloom.__main__ as jobs

    read = []
    plain = jobs.staged
    monkeypatch.setattr(jobs, "staged", lambda df, label: read.append(label) or plain(df, label))
    monkeypatch.setattr(jobs, "load_two_way", lambda lines, *a, f=jobs.load_two_way, **k: read.append(lines.inputFiles()) or f(lines, *a, **k))
    work.run("load-links", input=work.put("links", "k,v,w", "k"), forward=work.path("f"), reverse=work.path("r"),
             family="cf", delimiter=",", rejects=work.path("bad"))
    label, files = read
    # What feeds both tables and the rejects is the copy, not the input.
    assert label == "lines" and files and all("/kinloom/lines-" in f for f in files)
    assert work.table("f").count() == 2 and spark.read.parquet(work.path("bad")).count() == 1


def test_links(work):
    source = work.put("links", "k,v,w", "k")
    for _ in range(2):
        work.run("load-links", input=source, forward=work.path("f"), reverse=work.path("r"),
                 family="cf", delimiter=",")
    assert tuples(work.table("f").select("row_key", "qualifier")) == [("k", "v"), ("k", "w")]
    assert tuples(work.table("r").select("row_key", "qualifier")) == [("v", "k"), ("w", "k")]


def test_match_table_and_lookup(work, spark):
    kb = work.put("kb", f"c|{MD5}|{SHA1}|{SHA256}", f"d|{MD5}|{SHA1}|{'0' * 64}")
    provider = work.put("provider", f"x|{SHA256}")
    work.run("load-matches-join", provider=provider, input=kb, table=work.path("m"), secrets=work.secrets,
             provider_index=1, clink_index=0, md5_index=1, sha1_index=2, sha256_index=3)
    work.run("load-matches-by-length", input=work.put("fr", f"e|{SHA1}"), table=work.path("m"),
             secrets=work.secrets)
    c, e = (one(spark, salted_pel("s")(F.lit(x))) for x in "ce")
    requests = work.put("requests", f"c1,{c[:20]}", f"c2, {e}", "c3,", "c4")
    work.run("lookup", "--single-file", input=requests, table=work.path("m"), output=work.path("out"),
             rejects=work.path("bad"))
    assert tuples(spark.read.parquet(work.path("bad"))) == [("c4", "width")]
    first, *rest = work.lines("out")
    assert first == MATCH_HEADER
    assert sorted(rest) == [f"c1|{MD5}|{SHA1}|{SHA256}", f"c2||{SHA1}|", "c3|||"]


def test_accounts(work, spark):
    tables = dict(diff=work.path("diff"), arl=work.path("arl"), secrets=work.secrets, cid_key="ID")
    work.run("account-load", input=work.put("a1", "ID=a,P=XY1", "ID=b,P=XY2"), ana=12, **tables)
    work.run("account-load", input=work.put("a2", "ID=a;P=XY3"), ana=123, **tables)
    work.run("account-refresh", input=work.put("a3", "ID=a,P=XY4"), ana=12, **tables)
    want = [("123#a", "XY3"), ("12#a", "XY4")]
    assert tuples(work.table("diff").select("row_key", "value")) == sorted(want)
    keys = [one(spark, salted_account_arl("s")(F.lit(n), F.lit("a"))) for n in (123, 12)]
    got = {bytes(r["row_key"]): r["value"] for r in work.table("arl").collect()}
    assert got == {bytes(keys[0]): "XY3", bytes(keys[1]): "XY4"}


def test_appended_loads_equal_rewritten_ones(work, spark):
    common = dict(secrets=work.secrets, cid_key="ID", ana=12)
    files = [work.put("a1", "ID=a,P=XY1", "ID=b,P=XY2"), work.put("a2", "ID=a,P=XY3", "ID=c,P=XY4")]
    for n, (mode, flags) in enumerate([("append", ["--append"]), ("rewrite", [])]):
        tables = dict(diff=work.path(f"{mode}-diff"), arl=work.path(f"{mode}-arl"))
        for ts, path in enumerate(files, 1):
            work.run("account-load", *flags, input=path, load_ts=ts, **tables, **common)
    for table in ("diff", "arl"):
        assert tuples(work.table(f"append-{table}")) == tuples(work.table(f"rewrite-{table}"))
    # An addition holds only what came in.
    raw = open_snapshot(spark, work.path("append-diff"), merged=False)
    assert raw.count() == 4 and work.table("append-diff").count() == 3
    work.run("account-refresh", input=work.put("a3", "ID=d,P=XY5"), **common,
             diff=work.path("append-diff"), arl=work.path("append-arl"))
    assert tuples(work.table("append-diff").select("row_key")) == [("12#d",)]
    assert work.table("append-arl").count() == 1


def test_lookup_on_appended_cells(work, spark):
    for n, sha1 in enumerate((SHA1, "dd" * 20)):
        work.run("load-matches-by-length", "--append", input=work.put(f"m{n}", f"e|{sha1}"),
                 table=work.path("m"), secrets=work.secrets)
    pel = one(spark, salted_pel("s")(F.lit("e")))
    work.run("lookup", input=work.put("requests", f"c,{pel[:9]}"), table=work.path("m"), output=work.path("out"))
    assert "c||" + "dd" * 20 + "|" in work.lines("out")


def test_encrypted_file(work):
    clink = "0000GB0123456789"
    work.run("encrypt", "--single-file", input=work.put("in", f"{clink},a,,b", "bad,a"),
             output=work.path("out"), secrets=work.secrets, rejects=work.path("bad"))
    header, line = work.lines("out")
    assert header == ENCRYPTED_HEADER
    pel, a, blank, b = line.split(",")
    assert pel.startswith("Xi") and blank == "" and a not in ("a", b)


def test_decrypted_files(work, spark, tmp_path):
    sealed = one(spark, F.aes_encrypt(F.lit("x\ny"), F.lit(KEY)))
    (tmp_path / "in.enc").write_bytes(sealed)
    work.run("decrypt", input=work.path("in.enc"), output=work.path("out"), secrets=work.secrets)
    assert work.lines("out") == ["x", "y"]


def test_a_refresh_that_does_not_fit_leaves_the_account(work, spark):
    common = dict(diff=work.path("d"), arl=work.path("a"), secrets=work.secrets, cid_key="CID", ana=12)
    work.run("account-load", input=work.put("a1", "CID=a,P=XY1"), **common)
    # The first line has no separator; all others agree.
    odd = work.put("a2", "CID=a", *[f"CID=c{i};P=XY{i}" for i in range(5)])
    work.run("account-refresh", input=odd, **common)
    assert work.table("d").count() == 5
    mixed = work.put("a3", "CID=a,P=XY1", "CID=b;P=XY1", "CID=c|P=XY1")
    with pytest.raises(ValueError, match="do not agree"):
        work.run("account-refresh", input=mixed, **common)
    assert work.table("d").count() == 5


def test_options_act():
    for job, option in (("decrypt", "--spread"), ("lookup", "--load-ts"), ("expand", "--pair-limit")):
        with pytest.raises(SystemExit):
            main([job, option, "1"])


def test_expansion(work, spark):
    options = dict(table=work.path("t"), region="ES")
    work.run("expand", emails=work.put("e", "1 a", "1 b", "1 c"), phones=work.put("p", "2 d", "2 e"), **options)
    keys = spark.createDataFrame([("email", "a"), ("phone", "d")], "type string, hash string")
    assert tuples(linked_hashes(work.table("t"), keys, region="ES")) == [
        ("ES#email#a", "email", "b"), ("ES#email#a", "email", "c"), ("ES#phone#d", "phone", "e"),
    ]


def test_options_are_required():
    with pytest.raises(SystemExit):
        main(["account-load", "--input", "x"])

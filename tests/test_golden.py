"""Known inputs and their known results."""

from collections import Counter
from hashlib import sha256

from conftest import tuples
from pyspark.sql import functions as F

from kinloom.functions.identity import decoded_hash_arl, salted_pel, same_pel
from kinloom.operators.expansion import linked_hashes
from kinloom.operators.parse import parse_account_lines, parse_hashes_by_length, parse_id_hash, parse_identity_records
from kinloom.plans.hash_mapping import build_arl_pel_mapping, load_arl_pel
from kinloom.plans.pii_expansion import expand_pii
from kinloom.plans.two_way import load_two_way



def _field(letter: str, size: int = 64) -> str:
    """Hex digits that begin with ``letter``."""
    return letter + sha256(letter.encode()).hexdigest()[: size - 1]


# Four records of 12 claims to nine hashes. Every field has 64 digits but for the last
# record's sha1 (63) and md5 (not hex).
RECORDS = [
    "|".join(_field(x) for x in "05bd"),
    "|".join(_field(x) for x in "7eba"),
    "|".join(_field(x) for x in "d52d"),
    "|".join((_field("8"), _field("6", 63), "gB0234", _field("9"))),
]


def test_person_records_give_seven_mappings(lines):
    rows = parse_identity_records(lines(RECORDS)).rows
    assert rows.count() == 12
    assert rows.select("hash").distinct().count() == 9
    built = build_arl_pel_mapping(lines(RECORDS), pel_fn=same_pel, arl_fn=decoded_hash_arl)
    assert built.mapping.count() == 7
    per_pel = Counter(r["pel"][0] for r in built.mapping.collect())
    assert sum(per_pel.values()) == 7 and per_pel["8"] == 1
    assert Counter(r["reason"] for r in built.rejects.collect()) == {"odd_length": 1, "bad_chars": 1}


def test_arl_pel_pairs(lines):
    a, b, c, d = map(_field, "abcd")
    pairs = [f"{a}|pel1", f"{b}|pel2", "|", f"{c},pel3", "", f"{d}|", "|pel5"]
    loaded = load_arl_pel(lines(pairs), None, family="uk")
    assert tuples(loaded.table.withColumn("row_key", F.lower(F.hex("row_key")))) == [
        (a, "uk", "pel", 0, "pel1"),
        (b, "uk", "pel", 0, "pel2"),
    ]
    assert Counter(r["reason"] for r in loaded.rejects.collect()) == {"width": 2, "blank_field": 3}


def test_two_way_pairs(lines):
    pairs = ["clink_0|value_0", "clink_1|value_1|", "|", "", "clink_2|", "|value_3"]
    loaded = load_two_way(lines(pairs), None, None, family="cf", load_ts=7)
    assert tuples(loaded.forward) == [
        ("clink_0", "cf", "value_0", 7, ""),
        ("clink_1", "cf", "value_1", 7, ""),
    ]
    assert tuples(loaded.reverse) == [
        ("value_0", "cf", "clink_0", 7, ""),
        ("value_1", "cf", "clink_1", 7, ""),
    ]
    assert loaded.rejects.count() == 4


def test_leading_blank_field_shifts_the_key(lines):
    assert tuples(load_two_way(lines(["|k|v"]), None, None, family="f", load_ts=0).forward) == [
        ("k", "f", "v", 0, "")
    ]


def test_any_delimiter_of_two_way_lines(lines):
    got = load_two_way(lines(["k.v.w"]), None, None, family="f", load_ts=0, delimiter=".")
    assert got.forward.count() == 2


def expanded(spark, lines, emails, phones):
    """The expansion, and every pair its member rows lead to."""
    built = expand_pii(lines(emails), lines(phones), None, region="DE", load_ts=5)
    row = F.split("row_key", "#")
    keys = built.table.where("family = 'group'").select(F.get(row, F.lit(1)).alias("type"), F.get(row, F.lit(2)).alias("hash"))
    return built, linked_hashes(built.table, keys, region="DE")


def test_expansion_has_seven_rows(spark, lines):
    emails = ["0 E1", "0 E2", "1 E3", "1 E4"]
    phones = ["0 P1", "1 P2", "1 P3"]
    _, pairs = expanded(spark, lines, emails, phones)
    assert pairs.select("row_key").distinct().count() == 7
    assert pairs.count() == 18


def test_worked_expansion(spark, lines):
    emails = ["C1 E1", "C1  E2", "C2\tE3"]
    phones = ["C1 P1", "C2 P2", "C2 P3 "]
    found = {}
    for row in expanded(spark, lines, emails, phones)[1].collect():
        found.setdefault(row["row_key"], set()).add((row["family"], row["qualifier"]))
    assert found == {
        "DE#email#E1": {("email", "E2"), ("phone", "P1")},
        "DE#email#E2": {("email", "E1"), ("phone", "P1")},
        "DE#email#E3": {("phone", "P2"), ("phone", "P3")},
        "DE#phone#P1": {("email", "E1"), ("email", "E2")},
        "DE#phone#P2": {("email", "E3"), ("phone", "P3")},
        "DE#phone#P3": {("email", "E3"), ("phone", "P2")},
    }


def test_expansion_of_seven_people(spark, lines):
    rows = ["1 {0}1", "1 {0}2", "2 {0}3", "2 {0}4", "3 {0}5", "3 {0}6", "5 {0}7"]
    emails = ["ID\tEmail Hash (SHA256)"] + ["ID" + r.format("E") for r in rows]
    phones = ["ID\tPhone Hash (SHA256)"] + ["ID" + r.format("P") for r in rows]
    built, pairs = expanded(spark, lines, emails, phones)
    assert pairs.select("row_key").distinct().count() == 14
    assert pairs.count() == 38
    assert built.rejects.count() == 2


def test_header_of_an_id_hash_file_is_rejected(lines):
    parsed = parse_id_hash(lines(["ID\tEmail Hash (SHA256)", "  0\tab ", "", "1 a b"]))
    assert tuples(parsed.rows) == [("0", "ab")]
    assert parsed.rejects.count() == 3


def test_hashes_are_told_apart_by_length(lines):
    md5, sha1, sha256 = "fe" * 16, "8d" * 20, "c7" * 32
    line = "|".join(["clink", md5, sha256, f" {sha1} ", "11" * 20])
    parsed = parse_hashes_by_length(lines([line, "clink|x", "clink", '"open|x']))
    assert tuples(parsed.rows) == [("clink", md5, sha1, sha256), ("clink", None, None, None)]
    assert Counter(r["reason"] for r in parsed.rejects.collect()) == {"width": 1, "open_quote": 1}


def test_account_lines_without_a_known_id_yield_nothing(lines):
    parsed = parse_account_lines(lines(["ISE_HASH=aaa,PEL=bbb", "ISE_HASH=ccc,PEL=ddd"]), cid_key="ISE_HASH")
    assert parsed.rows.count() == 0
    assert {r["reason"] for r in parsed.rejects.collect()} == {"no_pel"}


def test_account_lines_with_a_preferred_key(lines):
    parsed = parse_account_lines(
        lines(["ISE_HASH=aaa,PEL=bbb", "ISE_HASH=ccc,PEL="]), cid_key="ISE_HASH", preferred_pel_key="PEL"
    )
    assert tuples(parsed.rows) == [("aaa", "bbb")]


def test_salted_ids_look_like_ids(lines):
    (row,) = lines(["x"]).select(salted_pel("s")(F.col("value")).alias("p")).collect()
    assert row["p"].startswith("Xi") and len(row["p"]) == 34

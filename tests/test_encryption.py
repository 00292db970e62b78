from collections import Counter

import pytest
from conftest import tuples
from pyspark.sql import functions as F

from kinloom.functions.identity import (
    decrypt_field,
    encrypt_field,
    salted_hash_arl,
    salted_pel,
    same_pel,
    secret,
)
from kinloom.plans.column_encryption import (
    HEADER_COLUMNS,
    encrypt_columns,
    encrypt_fields,
    encrypted_lines,
)
from kinloom.plans.file_decryption import decrypt_blocks, decrypt_files, read_blocks
from kinloom.plans.hash_mapping import build_arl_pel_mapping
from kinloom.plans.match_table import load_match_table_by_length
from kinloom.sources.lines import read_files

KEY = "0123456789abcdef0123456789abcdef"
CLINK = "0000GB0123456789"
OPTIONS = dict(key=KEY, pel_fn=same_pel)


def test_fields_are_encrypted_and_blanks_stay_blank(lines):
    rows = encrypt_fields(lines([f"{CLINK},a,, ,a"]), **OPTIONS).rows
    (fields,) = [r["fields"] for r in rows.collect()]
    assert fields[0] == CLINK and fields[2:4] == ["", ""]
    # Equal values give equal ciphertext.
    assert fields[1] == fields[4] != "a"
    decrypted = rows.select(decrypt_field(F.get("fields", F.lit(1)), KEY).alias("x"))
    assert tuples(decrypted) == [("a",)]
    other = rows.select(decrypt_field(F.get("fields", F.lit(1)), "f" * 32).alias("x"))
    assert tuples(other) != [("a",)]


def test_lines_keep_their_width(lines):
    values = [CLINK, f"{CLINK},,", CLINK + "," * 20]
    out = encrypted_lines(encrypt_fields(lines(values), **OPTIONS).rows)
    assert sorted(r["value"] for r in out.collect()) == sorted(values)


def test_ids_are_checked(lines):
    values = ["0000GB", "0000DE0123456789,a", "XY1,a", "xy1,a", CLINK + ",a", "0000FR0123456789", ""]
    as_clink = encrypt_fields(lines(values), **OPTIONS)
    assert sorted(r["fields"][0] for r in as_clink.rows.collect()) == ["0000FR0123456789", CLINK]
    passed = encrypt_fields(lines(values), translate_clink=False, **OPTIONS)
    assert [r["fields"][0] for r in passed.rows.collect()] == ["XY1"]
    assert Counter(r["reason"] for r in passed.rejects.collect()) == {"invalid_id": 6}


def test_named_columns_pad_short_lines_and_keep_what_is_beyond(lines):
    values = [f"{CLINK},,x", CLINK + "," * 13, CLINK + "," * 14 + "y,z", "bad" + "," * 14]
    encrypted = encrypt_columns(lines(values), **OPTIONS)
    assert encrypted.rows.columns == [*HEADER_COLUMNS, "surplus"]
    plain = encrypted.rows.select(F.transform("surplus", lambda x: decrypt_field(x, KEY)).alias("s"))
    assert sorted(r["s"] for r in plain.collect()) == [[], [], ["y", "z"]]
    assert Counter(r["reason"] for r in encrypted.rejects.collect()) == {"invalid_id": 1}


@pytest.mark.parametrize("rows", [[], [("key", KEY), ("key", KEY)], [("key", None)]])
def test_a_missing_or_repeated_secret_fails_the_job(spark, lines, rows):
    key = secret(spark.createDataFrame(rows, "name string, value string"), "key")
    with pytest.raises(Exception, match="one secret named 'key'"):
        encrypt_fields(lines([f"{CLINK},a"]), key=key, pel_fn=same_pel).rows.collect()
    mapping = build_arl_pel_mapping(lines(["c|" + "a" * 40 + "|" + "b" * 32 + "|" + "c" * 64]), pel_fn=salted_pel(key), arl_fn=salted_hash_arl(key))
    with pytest.raises(Exception, match="one secret named 'key'"):
        mapping.mapping.collect()
    loaded = load_match_table_by_length(lines(["c|" + "a" * 40]), None, pel_fn=salted_pel(key))
    with pytest.raises(Exception, match="one secret named 'key'"):
        loaded.table.collect()


def test_secrets_come_from_a_table_and_stay_out_of_the_plan(spark, lines, tmp_path):
    path = str(tmp_path / "secrets")
    spark.createDataFrame([("key", KEY), ("other", "x")], "name string, value string").write.json(path)
    key = secret(spark.read.schema("name string, value string").json(path), "key")
    df = lines(["a"]).select(encrypt_field(F.col("value"), key).alias("c"))
    assert tuples(df) == tuples(lines(["a"]).select(encrypt_field(F.col("value"), KEY).alias("c")))
    encrypted = encrypt_fields(lines([f"{CLINK},a"]), key=key, pel_fn=same_pel).rows
    assert tuples(encrypted) == tuples(encrypt_fields(lines([f"{CLINK},a"]), **OPTIONS).rows)
    assert KEY not in encrypted._jdf.queryExecution().toString()
    assert KEY not in df._jdf.queryExecution().toString()


def sealed(spark, *texts):
    rows = [(f"f{i}", t if isinstance(t, bytes) else t.encode(), isinstance(t, str)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "path string, plain binary, seal boolean")
    content = F.when(F.col("seal"), F.aes_encrypt("plain", F.lit(KEY))).otherwise(F.col("plain"))
    return df.select("path", content.alias("content")).withColumn("length", F.length("content"))


def test_whole_files(spark):
    files = sealed(spark, "a\r\nb\n\nc\n", "", "\n", "x\ry", b"not encrypted")
    plain = decrypt_files(files, key=KEY)
    assert tuples(plain.lines) == [
        ("f0", 0, "a"), ("f0", 1, "b"), ("f0", 2, ""), ("f0", 3, "c"),
        ("f2", 0, ""), ("f3", 0, "x"), ("f3", 1, "y"),
    ]
    assert tuples(plain.rejects) == [("f4", "decrypt_failed")]


def test_charsets(spark):
    content = "é".encode("latin-1")
    files = spark.createDataFrame([("f", content)], "path string, plain binary").select(
        "path", F.aes_encrypt("plain", F.lit(KEY)).alias("content"), F.lit(9).alias("length")
    )
    assert tuples(decrypt_files(files, key=KEY, charset="ISO-8859-1").lines) == [("f", 0, "é")]
    assert tuples(decrypt_files(files, key=KEY).lines) == [("f", 0, "�")]


def test_files_from_disk(spark, tmp_path):
    (content,) = sealed(spark, "a\nb").collect()
    (tmp_path / "x.enc").write_bytes(content["content"])
    (tmp_path / "y.enc").write_bytes(b"junk")
    plain = decrypt_files(read_files(spark, f"{tmp_path}/*.enc"), key=KEY)
    assert sorted(r["value"] for r in plain.lines.collect()) == ["a", "b"]
    assert [r["path"].rsplit("/", 1)[1] for r in plain.rejects.collect()] == ["y.enc"]


def blocks_of(spark, *files):
    """(path, texts) as sealed blocks; a text of None is a broken block."""
    rows = [(path, n, t) for path, texts in files for n, t in enumerate(texts)]
    df = spark.createDataFrame(rows[::-1], "path string, block_no long, text binary")
    sealed = F.base64(F.aes_encrypt("text", F.lit(KEY)))
    return df.select("path", "block_no", F.coalesce(sealed, F.lit("broken!")).alias("value"))


def test_lines_run_over_blocks(spark):
    texts = [b"a\nb", b"", b"c", b"d\r", b"\ne\r", b"f\r\n", b"\xc3", b"\xa9\n", b"\n", b"end"]
    got = decrypt_blocks(blocks_of(spark, ("f", texts), ("g", [b"x\n"]), ("h", [b"y", None])), key=KEY)
    assert tuples(got.lines) == [
        ("f", 0, "a"), ("f", 1, "bcd"), ("f", 2, "e\rf"), ("f", 3, "é"), ("f", 4, ""), ("f", 5, "end"), ("g", 0, "x"),
    ]
    assert tuples(got.rejects) == [("h", "decrypt_failed")]


def test_numbers_go_on_over_chunks_of_blocks(spark):
    rows = spark.range(9000).select(F.lit("f").alias("path"), F.col("id").alias("block_no"), F.concat("id", F.lit("\n")).alias("t"))
    sealed = rows.select("path", "block_no", F.base64(F.aes_encrypt("t", F.lit(KEY))).alias("value"))
    lines = decrypt_blocks(sealed, key=KEY).lines
    assert lines.count() == 9000 and lines.where("value <> cast(line_no as string)").count() == 0


def test_blocks_from_disk(spark, tmp_path):
    """A broken block anywhere fails its file, and only that."""
    numbered = F.concat_ws(" ", F.col("block_no").cast("string"), "value").alias("value")
    for name, texts in (("good", [b"a\nb", b"c"]), ("bad", [b"d", None, b"e"])):
        blocks_of(spark, (name, texts)).select(numbered).coalesce(1).write.text(str(tmp_path / name))
    plain = decrypt_blocks(read_blocks(spark, str(tmp_path / "good"), str(tmp_path / "bad")), key=KEY)
    assert tuples(plain.lines.select("line_no", "value")) == [(0, "a"), (1, "bc")]
    (reject,) = plain.rejects.collect()
    assert "/bad/" in reject["path"] and reject["reason"] == "decrypt_failed"

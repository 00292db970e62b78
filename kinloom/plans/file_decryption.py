"""Encrypted files -> lines. A file that cannot be decrypted yields one reject and no lines."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinloom.functions.identity import Secret, as_column
from kinloom.operators.skew import salted_join
from kinloom.session import staged


class Decrypted(NamedTuple):
    lines: DataFrame
    rejects: DataFrame


def split_lines(text: Column) -> Column:
    """Lines of a text; the end of the last line does not start another."""
    lines = F.split(
        F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n")), "\n", -1
    )
    ended = text.endswith("\n") | text.endswith("\r") | (text == "")
    return F.slice(lines, F.lit(1), F.size(lines) - ended.cast("int"))


def _opened(df: DataFrame, sealed: Column, key: Secret, charset: str) -> DataFrame:
    """Add ``text``, NULL where ``sealed`` cannot be decrypted.

    It leaves through ``inline`` so that a filter on it does not decrypt twice.
    """
    text = _text(F.try_aes_decrypt(sealed, as_column(key)), charset)
    return df.select("*", F.inline(F.array(F.struct(text.alias("text")))))


def _text(plain: Column, charset: str) -> Column:
    if charset.upper().replace("-", "") == "UTF8":
        # Invalid bytes become U+FFFD instead of failing the job.
        return F.make_valid_utf8(plain.cast("string"))
    return F.decode(plain, charset)


def decrypt_files(files: DataFrame, *, key: Secret, charset: str = "UTF-8") -> Decrypted:
    """``path, length, content`` (AES-GCM) -> ``path, line_no, value``.

    A file is one AES message, so it is decrypted by one task and must fit in its
    memory; one that does not fails the job. Files of any size are stored in blocks
    and read by ``decrypt_blocks``.
    """
    opened = _opened(files, F.col("content"), key, charset)
    lines = opened.where(F.col("text").isNotNull()).select(
        "path", F.posexplode(split_lines(F.col("text"))).alias("line_no", "value")
    )
    failed = opened.where(F.col("text").isNull()).select(
        "path", F.lit("decrypt_failed").alias("reason")
    )
    return Decrypted(lines, failed)


def decrypt_blocks(blocks: DataFrame, *, key: Secret, charset: str = "UTF-8") -> Decrypted:
    """``path, block_no, value`` (an AES-GCM message each, base64 or binary) -> ``path, line_no, value``.

    The text of a file is that of its blocks in the order of their numbers; a line may
    run over any number of them. A line ends with a line feed, a carriage return or
    both; a carriage return at the very end of a block counts only with the line feed
    after it. A file with a broken block is left out as a whole.

    Blocks are decrypted once and written to the shared folder as lines of bytes with
    their number in the block. Only the first and the last of a block can be part of a
    longer line, so only those are shuffled. Line ends are summed in two levels, of
    4096 blocks and of those sums, so no task has to order all blocks of a large file.
    """
    binary = dict(blocks.dtypes)["value"] == "binary"
    sealed = F.col("value") if binary else F.try_to_binary(F.col("value"), F.lit("base64"))
    # A block without a number has no place.
    sealed = F.when(F.col("block_no").isNotNull(), sealed)
    opened = _opened(blocks.select("path", "block_no", "value"), sealed, key, "ISO-8859-1")
    unix = F.regexp_replace("text", r"\r(?!\n|\z)|\r\n", "\n")
    pieces = F.when(F.col("text").isNotNull(), F.split(unix, "\n", -1))
    opened = staged(opened.select("path", "block_no", pieces.alias("pieces")), "blocks")
    failed = opened.where(F.col("pieces").isNull()).select("path").distinct()
    whole = salted_join(
        opened.where(F.col("pieces").isNotNull()), failed, "path", spread_by=F.col("block_no"), how="left_anti"
    )
    chunk = F.floor(F.col("block_no") / 4096)
    ends = opened.select("path", "block_no", chunk.alias("chunk"), (F.size("pieces") - 1).cast("long").alias("ends"))
    sums = ends.groupBy("path", "chunk").agg(F.sum("ends").alias("ends"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    of_file, of_chunk = before.partitionBy("path").orderBy("chunk"), before.partitionBy("path", "chunk").orderBy("block_no")
    sums = sums.select("path", "chunk", F.coalesce(F.sum("ends").over(of_file), F.lit(0)).alias("base"))
    within = ends.select("path", "chunk", "block_no", F.coalesce(F.sum("ends").over(of_chunk), F.lit(0)).alias("at"))
    starts = within.join(sums, ["path", "chunk"]).select("path", "block_no", (F.col("base") + F.col("at")).alias("start"))

    rows = whole.join(starts, ["path", "block_no"])
    last = F.size("pieces") - 1
    inner = F.when(last > 1, F.slice("pieces", 2, last - 1)).otherwise(F.array().cast("array<string>"))
    complete = rows.select("path", "start", F.posexplode(inner).alias("n", "piece")).select(
        "path", (F.col("start") + F.col("n") + 1).alias("line_no"), "piece"
    )
    edges = F.array_distinct(F.array(F.lit(0), last))
    parts = rows.select("path", "block_no", "start", "pieces", F.explode(edges).alias("n")).select(
        "path", "block_no", (F.col("start") + F.col("n")).alias("line_no"), F.get("pieces", F.col("n")).alias("piece")
    )
    # A line's parts: at most one per block, in the order of the blocks.
    ordered = F.array_sort(F.collect_list(F.struct("block_no", "piece")))
    joined = parts.groupBy("path", "line_no").agg(F.array_join(F.transform(ordered, lambda p: p["piece"]), "").alias("piece"))
    final = joined.join(
        rows.groupBy("path").agg(F.max(F.col("start") + last).alias("final")), "path"
    ).where(~((F.col("line_no") == F.col("final")) & (F.col("piece") == "")))
    lines = complete.unionByName(final.select("path", "line_no", "piece"))
    value = _text(F.encode(F.rtrim(F.col("piece"), F.lit("\r")), "ISO-8859-1"), charset)
    return Decrypted(
        lines.select("path", "line_no", value.alias("value")),
        failed.select("path", F.lit("decrypt_failed").alias("reason")),
    )


def read_blocks(spark: SparkSession, *paths: str, name: str | None = None) -> DataFrame:
    """Block files, lines of a number, a blank and a base64 message, as ``path, block_no, value``.

    ``path`` is that of the file, or the folder's value of column ``name``.
    """
    path = F.col(name) if name else F.col("_metadata.file_path")
    lines = spark.read.text(list(paths)).select(path.alias("path"), F.split("value", " ", 2).alias("f"))
    number = F.get("f", F.lit(0)).try_cast("long")
    return lines.select("path", number.alias("block_no"), F.coalesce(F.get("f", F.lit(1)), F.lit("")).alias("value"))

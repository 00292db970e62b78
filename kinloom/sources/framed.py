"""Files of binary blocks that many tasks read at once.

A block is its number, 16 hexadecimal digits, then its bytes; a mark that stands for the
end of a block follows. The text reader cuts a file into byte ranges and each task looks for
the first mark in its range, so one file of any size is opened by as many tasks as it has
ranges. No block is encoded for the sake of the format, and none is read twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# 16 bytes that sealed blocks hold by chance once in 2**128 places. No end of it is also its
# start, so what stands before it cannot be taken for a part of it.
MARK = "\x00~kinloom-frame."
DIGITS = 16


def framed(block_no: Column, content: Column) -> Column:
    """A block as the text writer takes it: its bytes as they are."""
    number = F.lpad(F.lower(F.hex(block_no.cast("long"))), DIGITS, "0")
    return F.concat(number.cast("binary"), F.coalesce(content, F.lit(b""))).cast("string")


def write_framed(blocks: DataFrame, path: str, *, by: tuple[str, ...] = ()) -> None:
    """Write ``block_no, content`` as block files; with ``by`` in a folder for each value.

    Every task writes the blocks it has, so a folder holds several files and a large group
    is no single task's. An empty block is written, too: it keeps its number.
    """
    rows = blocks.select(*by, framed(F.col("block_no"), F.col("content")).alias("value"))
    rows.write.partitionBy(*by).option("lineSep", MARK).text(path)


def read_framed(spark: SparkSession, *paths: str, name: str | None = None) -> DataFrame:
    """``path, block_no, value`` of block files; the value is binary.

    ``path`` is that of the file, or the folder's value of column ``name``: all files in it
    are then one. A frame without a number has none, and fails its file when it is opened.
    """
    rows = spark.read.option("lineSep", MARK).text(list(paths))
    body = F.col("value").cast("binary")
    number = F.substring(body, 1, DIGITS).cast("string")
    return rows.select(
        (F.col(name) if name else F.col("_metadata.file_path")).alias("path"),
        F.when(number.rlike(f"^[0-9a-f]{{{DIGITS}}}$"), F.conv(number, 16, 10).try_cast("long")).alias("block_no"),
        F.substring(body, DIGITS + 1, (1 << 31) - 1 - DIGITS).alias("value"),
    )

"""Delimited text output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_fields(delimiter: str, *fields: Column) -> Column:
    """Join fields; NULL prints as an empty field."""
    return F.concat_ws(delimiter, *[F.coalesce(f.cast("string"), F.lit("")) for f in fields])


def write_lines(
    lines: DataFrame,
    path: str,
    *,
    header: str | None = None,
    single_file: bool = False,
    order: tuple[str, ...] = (),
) -> None:
    """Write ``value`` as text, unquoted, with an optional header line per file.

    By default every task writes its own file. ``single_file`` sends the
    finished lines to one writer through a shuffle, so the work before it keeps
    its parallelism; use it only for small deliveries. With ``order`` lines are
    written in the order of those columns, in a file and from one file to the next.
    Under a header a line must not be empty, as delimited records never are.
    """
    out = lines
    if single_file:
        out = out.repartition(1)
    elif order:
        out = out.repartitionByRange(*order)
    if order:
        out = out.sortWithinPartitions(*order)
    out = out.select("value")
    if header is None:
        out.write.text(path)
        return
    # One raw column named like the header. The separator and the comment mark, a
    # leading one of which would be quoted, are characters no line contains.
    (
        out.withColumnRenamed("value", header)
        .write.option("sep", "\n")
        .option("comment", "\r")
        .option("header", True)
        .option("quote", "")
        .option("escapeQuotes", False)
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )

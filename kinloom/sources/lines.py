"""Line and file scans."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DELIMITERS = (",", "|", ";", "\t")


def read_lines(spark: SparkSession, *paths: str, spread: int | None = None) -> DataFrame:
    """Lines of text files as ``value``; globs and compressed files are accepted.

    A gzip file is read by one task. ``spread`` redistributes its lines over
    that many partitions so that only the decompression is serial.
    """
    if not paths:
        raise ValueError("no input path")
    lines = spark.read.text(list(paths))
    return lines.repartition(spread) if spread else lines


def read_files(spark: SparkSession, *paths: str) -> DataFrame:
    """Whole files as ``path, length, content``."""
    return spark.read.format("binaryFile").load(list(paths)).select("path", "length", "content")


def infer_delimiter(lines: DataFrame, *, agreed: bool = False) -> str:
    """The separator that is most frequent, outside quotes, in most lines.

    Every line that has any separator votes for the one it has most of; ties, in a
    line and among lines, go to the first of comma, pipe, semicolon, tab. This is one
    aggregation over all lines. ``agreed`` fails if less than half of the votes are
    for the winner.
    """
    outside = F.regexp_replace("value", '"[^"]*("|$)', "")
    counts = [F.length(outside) - F.length(F.replace(outside, F.lit(d), F.lit(""))) for d in DELIMITERS]
    counted = lines.select(F.array(*counts).alias("n"))
    most = F.array_max("n")
    vote = F.when(most > 0, F.array_position("n", most))
    votes = counted.agg(*[F.count_if(vote == i).alias(str(i)) for i, _ in enumerate(DELIMITERS, 1)]).first()
    best = max(range(len(DELIMITERS)), key=votes.__getitem__)
    if agreed and 2 * votes[best] < sum(votes):
        raise ValueError(f"the lines do not agree on a delimiter: {dict(zip(DELIMITERS, votes, strict=True))}")
    return DELIMITERS[best]


class Dialect(NamedTuple):
    delimiter: str
    quoted: bool


# Lines of more fields than this count as lines of so many.
MOST_FIELDS = 256


def dialect_scores(lines: DataFrame) -> DataFrame:
    """``dialect, score``: how evenly all lines split by each separator, with quotes and without.

    Of a dialect in which a share s of the lines has L fields each, for every L, the score
    is the sum of s * s * (L - 1) / L: high if most lines have the same number of fields and
    more than one. With quotes, separators inside them do not count, and lines in which a
    quote stays open count as lines that do not split; without, so do lines in which a field
    begins with a quote and ends without another. Blank lines are left out.

    This is one aggregation: per task at most one row for each dialect and number of fields.
    """
    outside = F.regexp_replace("value", '"[^"]*"', "")
    open_quote = F.contains(outside, F.lit('"'))
    candidates = []
    for i, d in enumerate(DELIMITERS):
        for j, text in enumerate((F.col("value"), outside)):
            found = F.least(F.length(text) - F.length(F.replace(text, F.lit(d), F.lit(""))) + 1, F.lit(MOST_FIELDS))
            torn = F.col("value").rlike(f'(^|[{d}])"[^"{d}]*([{d}]|$)')
            fields = F.when(open_quote if j else torn, 1).otherwise(found)
            candidates.append(F.struct(F.lit(2 * i + j).alias("dialect"), fields.alias("fields")))
    counted = (
        lines.where(F.col("value").rlike("[^\\x00-\\x20]"))
        .select(F.inline(F.array(*candidates)))
        .groupBy("dialect", "fields")
        .agg(F.count("*").cast("double").alias("n"))
    )
    even = F.sum(F.col("n") * F.col("n") * (F.col("fields") - 1) / F.col("fields"))
    return counted.groupBy("dialect").agg((even / (F.sum("n") * F.sum("n"))).alias("score"))


def dialect_of(number: int) -> Dialect:
    """The dialect of a number in ``dialect_scores``."""
    return Dialect(DELIMITERS[number // 2], bool(number % 2))


def infer_dialect(lines: DataFrame) -> Dialect:
    """Separator and quoting judged together, by the best of ``dialect_scores``.

    The separator that occurs most may be one that texts in the fields have in uneven
    numbers. Ties go to the first of comma, pipe, semicolon, tab, and to quotes, which do no
    harm to lines without them. Fails if no separator splits a line.
    """
    scores = {r["dialect"]: r["score"] for r in dialect_scores(lines).collect()}
    best = max(scores, key=lambda d: (scores[d], -(d // 2), d % 2), default=None)
    if best is None or scores[best] <= 0:
        raise ValueError("no delimiter divides the lines")
    return dialect_of(best)

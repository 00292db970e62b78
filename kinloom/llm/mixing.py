"""Mixing sources to target weights by iterative proportional fitting, with DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinloom.session import staged

DIMENSIONS = ("source", "lang", "topic")
#: The tables have no topic; which of these stems a text has most often stands in for it.
STEMS = ("th", "er", "on", "en", "ou", "re", "es", "in")
NONE = "(none)"
TEMPER, ITERATIONS, SEED = 0.9, 8, "mix"
#: See ``probabilities``.
CAPPED, GRID = 0.01, 64


def stem_counts(text: Column, stems: tuple[str, ...] = STEMS) -> Column:
    """How often each stem occurs: each replacement by one letter less shortens the text by one."""
    return F.array(*(F.octet_length(text) - F.octet_length(F.replace(text, F.lit(s), F.lit(s[:-1]))) for s in stems))


def topic_of(counts: Column, stems: tuple[str, ...] = STEMS) -> Column:
    """The stem that occurs most in the whole text; ties go to the first, none to ``NONE``."""
    most = F.array_max(counts)
    name = F.element_at(F.array(*map(F.lit, stems)), F.array_position(counts, most).cast("int"))
    return F.when(most > 0, name).otherwise(F.lit(NONE))


def token_count(text: Column) -> Column:
    """Words, as one more than the blanks and line ends between; 0 for an empty text."""
    rest = F.replace(F.replace(text, F.lit(" "), F.lit("")), F.lit("\n"), F.lit(""))
    words = F.octet_length(text) - F.octet_length(rest) + 1
    return F.when(F.octet_length(text) > 0, words).otherwise(F.lit(0)).cast("long")


def with_cell(docs: DataFrame, *more: Column) -> DataFrame:
    """``doc_id, _source, _lang, _topic, _tokens, _draw`` and ``more``; a null source or language is ``NONE``.

    ``_draw`` is a number from 0 to 1 that hangs on the doc_id alone (on the text, if
    that is null), so a document is drawn or not however the table is laid out. The
    counts are a column of their own, so that each is computed once.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(text))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{SEED}:"), key)), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    counted = docs.select(
        *more,
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit(NONE)).alias("_source"),
        F.coalesce(F.col("lang").cast("string"), F.lit(NONE)).alias("_lang"),
        token_count(text).alias("_tokens"),
        draw.alias("_draw"),
        stem_counts(text).alias("_counts"),
    )
    return counted.withColumn("_topic", topic_of(F.col("_counts"))).drop("_counts")


def cells_of(rows: DataFrame) -> DataFrame:
    """Tokens of each source, language and topic; summed up before the shuffle."""
    named = [F.col(f"_{d}").alias(d) for d in DIMENSIONS]
    return staged(rows.groupBy(*named).agg(F.sum("_tokens").alias("tokens")), "cells")


def tempered(cells: DataFrame, dimension: str, power: float = TEMPER) -> DataFrame:
    """``value, share``: shares of tokens raised to a power, and made to sum to one.

    A power below 1 takes weight from large values and gives it to small ones.
    """
    raised = cells.groupBy(F.col(dimension).alias("value")).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("r"))
    total = raised.agg(F.sum("r")).first()[0] or 1.0
    return staged(raised.select("value", (F.col("r") / F.lit(total)).alias("share")), "target")


def rake(cells: DataFrame, targets: dict[str, DataFrame], iterations: int = ITERATIONS) -> DataFrame:
    """``cells`` with ``ratio``: what the tokens of a cell are multiplied by to meet the targets.

    Iterative proportional fitting: each margin in turn is scaled to its target (of
    ``value, share``), ``iterations`` times over. A value without a target gets none;
    a margin without tokens is left as it is. Only the table of cells is worked on, one
    row for each combination that occurs; it is written to the shared folder after each
    turn over all margins. The one number on the driver is the sum of tokens.
    """
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    now = cells.withColumn("ratio", F.lit(1.0))
    for _ in range(iterations):
        for dimension, target in targets.items():
            got = now.groupBy(dimension).agg(F.sum(F.col("tokens") * F.col("ratio")).alias("got"))
            goal = target.select(F.col("value").alias(dimension), "share")
            scale = F.when(F.col("got") > 0, F.coalesce("share", F.lit(0.0)) * total / F.col("got")).otherwise(F.lit(1.0))
            factor = got.join(goal, dimension, "left").select(dimension, scale.alias("factor"))
            now = now.join(factor, dimension).withColumn("ratio", F.col("ratio") * F.col("factor")).select(*cells.columns, "ratio")
        now = staged(now, "raked")
    return now


def probabilities(raked: DataFrame, keep_tokens: float | None = None, capped: float = CAPPED) -> DataFrame:
    """``source, lang, topic, probability``: in proportion to the ratios, 1 at most.

    A cell cannot give more than it has. Cells with the largest ratios are drawn whole
    as long as they hold no more than ``capped`` of the raked weight, so a few rare
    documents do not thin out all others; the margins hold but for that part. Fewer are
    drawn if about ``keep_tokens`` tokens are to stay. The limit is sought on a grid of
    ``GRID`` steps below the largest ratio, in one aggregation over the cells.
    """
    highest, weight = raked.agg(F.max("ratio"), F.sum(F.col("tokens") * F.col("ratio"))).first()
    if not highest:
        return raked.select(*DIMENSIONS, F.lit(1.0).alias("probability"))
    steps = raked.select("*", F.explode(F.sequence(F.lit(1), F.lit(GRID))).alias("k"))
    above = steps.where(F.col("ratio") > F.lit(highest) * F.pow(F.lit(2.0), -F.col("k") / 8))
    held = above.groupBy("k").agg(F.sum(F.col("tokens") * F.col("ratio")).alias("w"))
    step = held.where(F.col("w") <= capped * weight).agg(F.max("k")).first()[0] or 0
    rate = 2.0 ** (step / 8) / highest
    if keep_tokens is not None and weight:
        rate = min(rate, keep_tokens / weight)
    return raked.select(*DIMENSIONS, F.least(F.lit(1.0), F.col("ratio") * F.lit(rate)).alias("probability"))


def with_probability(rows: DataFrame, chances: DataFrame) -> DataFrame:
    """Cells are few and joined by their own three values; a hot one is split at run time."""
    named = chances.select(*(F.col(d).alias(f"_{d}") for d in DIMENSIONS), F.col("probability").alias("_chance"))
    return rows.join(named, [f"_{d}" for d in DIMENSIONS])


def mix(docs: DataFrame, power: float = TEMPER, iterations: int = ITERATIONS) -> DataFrame:
    """``doc_id, source, lang, topic, n_tokens, probability, sampled`` of every row.

    Targets are the tempered shares of each margin. Repeated rows are drawn alike; an
    empty text has no tokens and shares the chance of its cell.
    """
    rows = staged(with_cell(docs), "features")
    cells = cells_of(rows)
    chances = probabilities(rake(cells, {d: tempered(cells, d, power) for d in DIMENSIONS}, iterations))
    return with_probability(rows, chances).select(
        "doc_id",
        F.col("_source").alias("source"),
        F.col("_lang").alias("lang"),
        F.col("_topic").alias("topic"),
        F.col("_tokens").alias("n_tokens"),
        F.round("_chance", 6).alias("probability"),
        (F.col("_draw") < F.col("_chance")).alias("sampled"),
    )


def sample(docs: DataFrame, power: float = TEMPER, iterations: int = ITERATIONS) -> DataFrame:
    """The rows of ``docs`` that are drawn, with their own columns."""
    cells = cells_of(with_cell(docs))
    chances = probabilities(rake(cells, {d: tempered(cells, d, power) for d in DIMENSIONS}, iterations))
    own = [(c, f"_own{i}") for i, c in enumerate(docs.columns)]
    rows = with_cell(docs, *(F.col(c).alias(n) for c, n in own))
    return with_probability(rows, chances).where("_draw < _chance").select(*(F.col(n).alias(c) for c, n in own))


def oracle(power: float = TEMPER, iterations: int = ITERATIONS) -> str:
    """The same rows by DuckDB, the fitting written out step by step."""
    counts = ", ".join(f"length(t) - length(replace(t, '{s}', '{s[:-1]}')) AS n{i}" for i, s in enumerate(STEMS))
    most = f"greatest({', '.join(f'n{i}' for i in range(len(STEMS)))})"
    topic = " ".join(f"WHEN n{i} = {most} THEN '{s}'" for i, s in enumerate(STEMS))
    steps = [
        f"""d AS (SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang, coalesce(text, '') AS t FROM documents),
n AS (SELECT *, {counts} FROM d),
r AS MATERIALIZED (SELECT doc_id, source, lang, CASE WHEN {most} = 0 THEN '{NONE}' {topic} END AS topic,
  CAST(CASE WHEN length(t) > 0 THEN 1 + length(t) - length(replace(replace(t, ' ', ''), chr(10), '')) ELSE 0 END AS BIGINT) AS n_tokens,
  CAST(CAST('0x' || substr(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), md5(t))), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296 AS draw FROM n),
c0 AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens) AS tokens, CAST(1 AS DOUBLE) AS ratio FROM r GROUP BY ALL)"""
    ]
    for d in DIMENSIONS:
        raised = f"SELECT {d}, pow(CAST(sum(tokens) AS DOUBLE), {power}) AS x FROM c0 GROUP BY {d}"
        steps.append(f"t_{d} AS MATERIALIZED (SELECT {d}, x / (SELECT sum(x) FROM ({raised})) AS share FROM ({raised}))")
    for k in range(iterations * len(DIMENSIONS)):
        d = DIMENSIONS[k % len(DIMENSIONS)]
        steps.append(
            f"""c{k + 1} AS MATERIALIZED (SELECT source, lang, topic, tokens,
  ratio * CASE WHEN got > 0 THEN share * (SELECT sum(tokens) FROM c0) / got ELSE 1 END AS ratio
  FROM c{k} JOIN t_{d} USING ({d}) JOIN (SELECT {d}, sum(tokens * ratio) AS got FROM c{k} GROUP BY {d}) USING ({d}))"""
        )
    last = f"c{iterations * len(DIMENSIONS)}"
    steps.append(
        f"""h AS (SELECT max(ratio) AS highest, sum(tokens * ratio) AS weight FROM {last}),
s AS (SELECT coalesce(max(k), 0) AS k FROM (SELECT k, sum(tokens * ratio) AS w FROM {last}, h, range(1, {GRID + 1}) AS g(k)
  WHERE ratio > highest * pow(2, -k / 8.0) GROUP BY k), h WHERE w <= {CAPPED} * weight)"""
    )
    return f"""WITH {", ".join(steps)}
SELECT doc_id, source, lang, topic, n_tokens, round(p, 6) AS probability, draw < p AS sampled
  FROM (SELECT *, least(1, ratio * (SELECT pow(2, k / 8.0) / highest FROM s, h)) AS p FROM r JOIN {last} USING (source, lang, topic))"""

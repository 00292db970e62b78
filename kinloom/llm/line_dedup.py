"""Line dedup by a deletion-neighbourhood join, with DataFrame functions alone.

Two lines are near if one edit (a character put in, taken out or exchanged) at most
lies between them. Taking out one character of each then gives equal variants. Long
lines have many variants, so keys are emitted in three steps, each of which only gets
the lines that another line met in the step before:

1. Two keys per line: its first and its last half. One edit leaves a half untouched.
2. A key for each of about sqrt(length) blocks: all of the line but that block.
3. The variants: the block without one character, hashed with the rest of the line.

Every step is exact: no pair of near lines is lost, and what meets in step 3 is
verified by its edit distance. Nothing is emitted for pairs: in a group of equal keys
each member is held against the earliest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinloom.llm.common import partitions

LEAST_ID = -(1 << 63)
#: Shorter lines are compared for equality only.
MIN_CHARS = 20
GRAIN = 4


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def keyed(docs: DataFrame) -> DataFrame:
    """``_id, _t, text``: never null; rows equal in both ids are one document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)).alias("_id"), F.xxhash64(text).alias("_t"), text.alias("text")
    )


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def lines_of(rows: DataFrame) -> DataFrame:
    """``_id, _t, line_no, line, h, g`` of the lines that are not blank; h and g name the line."""
    lines = rows.select("_id", "_t", F.posexplode(split_lines(F.col("text"))).alias("line_no", "line"))
    lines = lines.withColumn("line", F.trim("line")).where("line <> ''")
    return lines.withColumns({"h": F.xxhash64("line"), "g": F.xxhash64(F.lit(1), "line")})


def half_keys(line: Column) -> Column:
    """Step 1, for the lengths that a near line may have; halves are cut to whole grains."""
    keys = []
    for less in (0, 1):
        c = F.length(line) - less
        half = F.floor(c / 2)
        front, back = (F.floor(x / GRAIN).cast("int") * GRAIN for x in (half, c - half))
        keys += [F.xxhash64(F.lit("front"), F.substring(line, F.lit(1), front)), F.xxhash64(F.lit("back"), F.right(line, back))]
    return F.array_distinct(F.array(*keys))


def block_keys(lines: DataFrame) -> DataFrame:
    """Step 2, of ``line``: for length c (the shorter of a pair) the line but for each block.

    Adds ``rest, longer, block``. Blocks are exploded first and cut then: that runs as
    compiled code, which a lambda over an array of blocks does not.
    """
    n, c, j, line = F.length("line"), F.col("_c"), F.col("_j"), F.col("line")
    blocks = F.ceil(F.sqrt(c)).cast("int")
    dealt = lines.select("*", F.explode(F.array(n, n - 1)).alias("_c"))
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("_j"))
    edge = lambda x: F.floor(x.cast("long") * c / blocks).cast("int")
    dealt = dealt.withColumns({"_lo": edge(j), "_hi": edge(j + 1)})
    rest = F.xxhash64(c, j, F.substring(line, F.lit(1), F.col("_lo")), F.right(line, c - F.col("_hi")))
    block = F.substring(line, F.col("_lo") + 1, F.col("_hi") - F.col("_lo") + n - c)
    return dealt.select(*lines.columns, rest.alias("rest"), (n > c).alias("longer"), block.alias("block")).drop("line")


def variant_keys(blocks: DataFrame) -> DataFrame:
    """Step 3, of ``rest, longer, block``: adds ``key, side``.

    Exchanged: both lines without the character at the same place. Put in: the shorter
    line's block as it is (place 0), and the longer one's without each of its characters.
    """
    block, rest, place, longer = F.col("block"), F.col("rest"), F.col("_i"), F.col("longer")
    dealt = blocks.select("*", F.explode(F.sequence(F.lit(0), F.length("block"))).alias("_i")).where(~longer | (place > 0))
    without = F.concat(F.substring(block, F.lit(1), place - 1), F.substring(block, place + 1, F.length(block)))
    put_in = F.xxhash64(rest, F.lit("in"), F.when(longer, without).otherwise(block))
    same = F.xxhash64(rest, F.lit("same"), place, without)
    side = F.when(longer, F.lit("longer")).when(place == 0, F.lit("shorter")).otherwise(F.lit("same"))
    return dealt.select(
        *(c for c in blocks.columns if c not in ("rest", "longer", "block")),
        F.when(longer | (place == 0), put_in).otherwise(same).alias("key"),
        side.alias("side"),
    )


def shared(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` whose key two different lines have; counted by minima before the shuffle."""
    met = rows.groupBy(key).agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi").select(key)
    return rows.join(met, key, "left_semi")


def kept_lines(rows: DataFrame, dealt: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``_id, _t, keep``: the numbers of the lines of a document that stay, of those not blank."""
    lines = lines_of(rows)
    place = F.struct("_id", "_t", "line_no")
    first = lines.groupBy("h", "g").agg(F.min(place).alias("o"))

    halves = lines.where(F.length("line") >= min_chars).select("h", "g", F.explode(half_keys(F.col("line"))).alias("half"))
    open_ = shared(halves, "half").select("h", "g").distinct()
    wanted = first.join(open_, ["h", "g"], "left_semi").select("o.*", "h", "g")
    by_doc = wanted.groupBy("_id", "_t").agg(F.collect_list(F.struct("line_no", "h", "g")).alias("asked"))
    texts = dealt.join(by_doc.hint("shuffle_hash"), ["_id", "_t"]).select(
        "_id",
        "_t",
        F.explode(
            let(split_lines(F.col("text")), lambda ls: F.transform("asked", lambda a: F.struct(a.alias("a"), F.trim(ls[a["line_no"]]).alias("line"))))
        ).alias("x"),
    )
    texts = texts.select(F.col("x.a.h").alias("h"), F.col("x.a.g").alias("g"), F.struct("_id", "_t", F.col("x.a.line_no").alias("line_no")).alias("o"), F.col("x.line").alias("line"))

    variants = variant_keys(shared(block_keys(texts), "rest"))
    me = F.struct("o", "h", "g")
    sides = ("same", "shorter", "longer")
    earliest = variants.groupBy("key").agg(*(F.min(F.when(F.col("side") == s, me)).alias(s) for s in sides))
    rival = F.when(F.col("side") == "same", F.col("first.same")).when(F.col("side") == "shorter", F.col("first.longer")).otherwise(F.col("first.shorter"))
    pairs = variants.join(earliest.select("key", F.struct(*sides).alias("first")), "key").withColumn("rival", rival)
    pairs = pairs.where("rival.o < o").select("h", "g", F.col("rival.h").alias("h2"), F.col("rival.g").alias("g2")).distinct()

    line = texts.select("h", "g", "line")
    other = line.toDF("h2", "g2", "line2")
    near = pairs.join(line, ["h", "g"]).join(other, ["h2", "g2"]).where(F.levenshtein("line", "line2", 1) >= 0)
    stay = first.join(near.select("h", "g").distinct(), ["h", "g"], "left_anti").select("o.*")
    return stay.groupBy("_id", "_t").agg(F.collect_list("line_no").alias("keep"))


def rebuilt(text: Column, keep: Column) -> Column:
    """``n_lines, n_removed, text`` of a text of which the blank lines and those in ``keep`` stay."""

    def of(ls: Column) -> Column:
        blank = F.filter(F.sequence(F.lit(0), F.size(ls) - 1), lambda i: F.trim(ls[i]) == "")
        stay = F.array_sort(F.array_union(F.coalesce(keep, F.array().cast("array<int>")), blank))
        return F.struct(
            F.size(ls).cast("long").alias("n_lines"),
            (F.size(ls) - F.size(stay)).cast("long").alias("n_removed"),
            F.array_join(F.transform(stay, lambda i: ls[i]), "\n").alias("text"),
        )

    return let(split_lines(text), of)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id, n_lines, n_removed, text`` of every row: its text without repeated lines.

    A line goes if an earlier one (smaller doc_id, or the same document and a smaller
    line number) is equal to it, or near it if both have ``min_chars`` characters or
    more. Blanks around a line do not count; blank lines stay. Lines are held against
    all lines of the input, those that go included. A null text is empty and has one
    blank line. A null doc_id comes before all others. Rows that repeat a doc_id are
    told apart by their text; those equal in both are one document and have one result.
    """
    rows = keyed(docs)
    dealt = rows.repartition(partitions(docs), "_id", "_t")
    joined = dealt.join(kept_lines(rows, dealt, min_chars).hint("shuffle_hash"), ["_id", "_t"], "left")
    out = joined.select("_id", rebuilt(F.col("text"), F.col("keep")).alias("r"))
    return out.select(F.expr(f"nullif(_id, {LEAST_ID + 1} - 1)").alias("doc_id"), "r.*")


def without_repeats(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with their own columns and the text without repeated lines; null texts stay null.

    A column ``n_chars`` is set anew where the text changes.
    """
    rows = keyed(docs)
    names = [f"_c{i}" for i in range(len(docs.columns))]
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID)).alias("_id"), F.xxhash64(text).alias("_t")
    own = docs.select(*(F.col(c).alias(n) for c, n in zip(docs.columns, names, strict=True)), *key)
    keep = kept_lines(rows, rows.repartition(partitions(docs), "_id", "_t"), min_chars)
    column = names[docs.columns.index("text")]
    joined = own.join(keep.hint("shuffle_hash"), ["_id", "_t"], "left")
    new = F.when(F.col(column).isNotNull(), rebuilt(F.col(column), F.col("keep")))
    joined = joined.withColumn("_new", new)
    changed = F.col("_new.n_removed") > 0
    replaced = {"text": F.col("_new.text"), "n_chars": F.length("_new.text").cast("long")}
    return joined.select(
        *(F.when(changed, replaced[c]).otherwise(F.col(n)).alias(c) if c in replaced else F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True))
    )


def oracle(table: str = "documents", min_chars: int = MIN_CHARS) -> str:
    """The same rows by DuckDB, where doc_id is unique: every pair that shares a half is measured."""
    half = "CAST(floor(least(length(a.line), length(b.line)) / 2) AS INTEGER)"
    return f"""WITH l AS MATERIALIZED (SELECT doc_id, i - 1 AS line_no, g[i] AS raw, trim(g[i]) AS line
  FROM (SELECT doc_id, g, unnest(range(1, len(g) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS g FROM {table}))),
f AS MATERIALIZED (SELECT line, min((doc_id, line_no)) AS o FROM l WHERE line <> '' GROUP BY line),
n AS (SELECT DISTINCT a.line FROM f a JOIN f b ON length(a.line) BETWEEN length(b.line) - 1 AND length(b.line) + 1
  AND length(a.line) >= {min_chars} AND length(b.line) >= {min_chars} AND b.o < a.o
  AND (left(a.line, {half}) = left(b.line, {half}) OR right(a.line, {half}) = right(b.line, {half}))
  AND levenshtein(a.line, b.line) <= 1),
k AS (SELECT l.*, l.line = '' OR (f.o = (l.doc_id, l.line_no) AND n.line IS NULL) AS stays FROM l LEFT JOIN f USING (line) LEFT JOIN n USING (line))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_removed,
       coalesce(string_agg(raw, chr(10) ORDER BY line_no) FILTER (stays), '') AS text FROM k GROUP BY doc_id"""

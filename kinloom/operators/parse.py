"""Line formats -> typed rows and rejects.

Every parser takes a DataFrame with a ``value`` column and is one narrow
projection. ``rejects`` holds ``value, reason`` of the lines left out and costs
nothing unless it is used. An ``Observation`` counts lines and rejects by reason
during the same pass that reads the rows.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kinloom.fixed import KEY_VALUE_SEPARATOR, PREFERRED_PEL_KEY
from kinloom.functions.hashes import hash_fault, hashes_by_length
from kinloom.functions.identity import is_pel
from kinloom.functions.text import (
    is_blank,
    split_all,
    split_quoted,
    split_ragged,
    strip_outer_quotes,
    trim_control,
)
from kinloom.session import scratch_dir
from kinloom.sources.lines import infer_delimiter


class Parsed(NamedTuple):
    rows: DataFrame
    rejects: DataFrame


# Folders of a fan-out.
ROWS, REJECTS = "rows", "rejects"


def divide(
    df: DataFrame,
    faults: dict[str, Column],
    rows: list[Column],
    observation: Observation | None,
    once: bool = False,
) -> Parsed:
    """Route each line by the first fault that holds (a NULL condition does not).

    The fields leave through a one-element ``inline``. A filter on them cannot
    be pushed below it, where the whole parse would be computed a second time to
    decide which lines to keep.

    ``once`` is for jobs with several outputs: rows and rejects are written to the shared
    folder in one job, each line under the folder of the sink it goes to, and what follows
    reads its folder. Lines are then read and parsed once, whatever is made of them, and an
    observation counts them once.
    """
    reason = F.lit(None).cast("string")
    for name, condition in reversed(faults.items()):
        reason = F.when(condition, F.lit(name)).otherwise(reason)
    routed = df.select("value", F.inline(F.array(F.struct(reason.alias("reason"), *rows))))
    fields = [c for c in routed.columns if c not in ("value", "reason")]
    observed = routed
    if observation is not None:
        counters = [F.count_if(F.col("reason") == name).alias(name) for name in faults]
        observed = routed.observe(observation, F.count(F.lit(1)).alias("lines"), *counters)
    if once:
        return _fanned_out(observed, fields)
    return Parsed(
        observed.where(F.col("reason").isNull()).select(*fields),
        routed.where(F.col("reason").isNotNull()).select("value", "reason"),
    )


def _fanned_out(routed: DataFrame, fields: list[str]) -> Parsed:
    """One write of all lines, divided by sink; a row keeps its fields and a reject its line."""
    spark, path = routed.sparkSession, scratch_dir(routed.sparkSession, "parsed")
    fault = F.col("reason").isNotNull()
    kept = [F.when(~fault, F.col(name)).alias(name) for name in fields]
    sink = F.when(fault, F.lit(REJECTS)).otherwise(F.lit(ROWS)).alias("sink")
    out = routed.select(F.when(fault, F.col("value")).alias("value"), "reason", *kept, sink)
    out.write.partitionBy("sink").parquet(path)
    back = spark.read.schema(out.schema).parquet(path)
    return Parsed(
        back.where(F.col("sink") == ROWS).select(*fields),
        back.where(F.col("sink") == REJECTS).select("value", "reason"),
    )


def _element(array: str, index: int) -> Column:
    return F.get(F.col(array), F.lit(index))


def parse_account_lines(
    lines: DataFrame,
    *,
    cid_key: str,
    preferred_pel_key: str = PREFERRED_PEL_KEY,
    delimiter: str | None = None,
    strict: bool = False,
    observation: Observation | None = None,
    once: bool = False,
) -> Parsed:
    """``key=value`` lists -> ``cid, pel``.

    The pseudonymous id is the value of the preferred key where that key is
    present, else the greatest value that looks like one. Blank lines are
    skipped. ``strict`` fails the job on a malformed line instead of rejecting
    it. ``delimiter=None`` infers the separator from all lines.
    """
    if delimiter is None:
        delimiter = infer_delimiter(lines)

    def value_of(key: str) -> Column:
        hit = F.filter(F.col("pairs"), lambda p: F.get(p, F.lit(0)) == key)
        return F.get(F.get(hit, F.lit(0)), F.lit(1))

    def text_of(pair: Column) -> Column:
        return strip_outer_quotes(F.get(pair, F.lit(1)))

    pairs = F.transform(
        split_all(trim_control(F.col("value")), delimiter),
        lambda p: split_all(p, KEY_VALUE_SEPARATOR),
    )
    keys = F.transform(F.col("pairs"), lambda p: F.get(p, F.lit(0)))
    pels = F.filter(F.transform(F.col("pairs"), text_of), is_pel)
    fields = (
        lines.where(F.col("value").rlike("[^\\x00-\\x20]"))
        .select("value", pairs.alias("pairs"))
        .select(
            "value",
            F.exists("pairs", lambda p: F.size(p) != 2).alias("malformed"),
            (F.size(F.array_distinct(keys)) < F.size(keys)).alias("duplicate"),
            strip_outer_quotes(F.coalesce(value_of(cid_key), F.lit(""))).alias("cid"),
            F.coalesce(
                strip_outer_quotes(value_of(preferred_pel_key)), F.array_max(pels), F.lit("")
            ).alias("pel"),
        )
    )
    if strict:
        broken = F.col("malformed") | F.col("duplicate")
        fields = fields.withColumn(
            "cid",
            F.when(broken, F.raise_error(F.lit("malformed key=value line"))).otherwise(
                F.col("cid")
            ),
        )
    return divide(
        fields,
        {
            "malformed_pair": F.col("malformed"),
            "duplicate_key": F.col("duplicate"),
            "no_cid": F.col("cid") == "",
            "no_pel": F.col("pel") == "",
        },
        [F.col("cid"), F.col("pel")],
        observation,
        once,
    )


def parse_columns(
    lines: DataFrame,
    columns: dict[str, int],
    *,
    required: tuple[str, ...] = (),
    delimiter: str = "|",
    quoted: bool = True,
    observation: Observation | None = None,
    once: bool = False,
) -> Parsed:
    """Delimited lines -> the named columns at the given positions.

    A line is rejected if a required column is absent or blank. Other absent
    columns are NULL.
    """
    for name, index in columns.items():
        if index < 0:
            raise ValueError(f"negative position {index} for {name}")
    missing = set(required) - set(columns)
    if missing:
        raise ValueError(f"required columns without a position: {sorted(missing)}")
    fields = split_quoted(F.col("value"), delimiter) if quoted else split_all(F.col("value"), delimiter)
    named = lines.select("value", fields.alias("fields")).select(
        "value",
        F.col("fields").isNull().alias("open_quote"),
        *[_element("fields", i).alias(name) for name, i in columns.items()],
    )
    faults = {"open_quote": F.col("open_quote")}
    faults.update({f"blank_{name}": is_blank(F.col(name)) for name in required})
    return divide(named, faults, [F.col(name) for name in columns], observation, once)


def parse_pairs(
    lines: DataFrame,
    *,
    delimiter: str = ",",
    trim: bool = True,
    allow_blank: bool = True,
    observation: Observation | None = None,
    once: bool = False,
) -> Parsed:
    """Lines of exactly two fields -> ``key, value_``."""

    def field(index: int) -> Column:
        text = _element("fields", index)
        return trim_control(text) if trim else text

    fields = lines.select("value", split_all(F.col("value"), delimiter).alias("fields"))
    faults = {"width": F.size("fields") != 2}
    if not allow_blank:
        faults["blank_field"] = (field(0) == "") | (field(1) == "")
    return divide(fields, faults, [field(0).alias("key"), field(1).alias("value_")], observation, once)


def parse_one_to_many(
    lines: DataFrame, *, delimiter: str = "|", observation: Observation | None = None, once: bool = False
) -> Parsed:
    """``key | value | value ...`` -> one ``key, value_`` row per value.

    Empty fields are removed first, so the first field with text is the key.
    """
    tokens = F.filter(split_all(F.col("value"), delimiter), lambda t: t != "")
    fields = lines.select("value", tokens.alias("fields"))
    values = F.slice(F.col("fields"), F.lit(2), F.greatest(F.size("fields") - 1, F.lit(0)))
    parsed = divide(
        fields,
        {"no_value": F.size("fields") < 2},
        [_element("fields", 0).alias("key"), values.alias("values")],
        observation,
        once,
    )
    return Parsed(parsed.rows.select("key", F.explode("values").alias("value_")), parsed.rejects)


def parse_id_hash(lines: DataFrame, *, observation: Observation | None = None, once: bool = False) -> Parsed:
    """Lines of exactly two words -> ``id, hash``."""
    fields = lines.select("value", F.split(trim_control(F.col("value")), "\\s+", -1).alias("fields"))
    return divide(
        fields,
        {"width": F.size("fields") != 2},
        [_element("fields", 0).alias("id"), _element("fields", 1).alias("hash")],
        observation,
        once,
    )


def parse_hashes_by_length(
    lines: DataFrame,
    *,
    delimiter: str = "|",
    quoted: bool = True,
    observation: Observation | None = None,
    once: bool = False,
) -> Parsed:
    """``key | hash | hash ...`` in any order -> ``key, md5, sha1, sha256``.

    The first hash of each length counts; a missing kind is NULL.
    """
    split = split_quoted(F.col("value"), delimiter) if quoted else split_all(F.col("value"), delimiter)
    rest = F.transform(
        F.slice(F.col("fields"), F.lit(2), F.greatest(F.size("fields") - 1, F.lit(0))),
        trim_control,
    )
    fields = lines.select("value", split.alias("fields")).select(
        "value", "fields", rest.alias("rest")
    )
    return divide(
        fields,
        {"open_quote": F.col("fields").isNull(), "width": F.size("fields") < 2},
        [_element("fields", 0).alias("key")]
        + [hashed.alias(kind) for kind, hashed in hashes_by_length(F.col("rest")).items()],
        observation,
        once,
    )


def parse_identity_records(
    lines: DataFrame,
    *,
    clink: int = 0,
    md5: int = 2,
    sha1: int = 1,
    sha256: int = 3,
    delimiter: str = "|",
    observation: Observation | None = None,
    once: bool = False,
) -> Parsed:
    """Person records -> one ``hash, clink, hash_type`` row per hash column."""
    positions = {"clink": clink, "MD5": md5, "SHA1": sha1, "SHA256": sha256}
    negative = [f"{name}={i}" for name, i in positions.items() if i < 0]
    if negative:
        raise ValueError(f"negative positions: {', '.join(negative)}")
    fields = lines.select("value", split_ragged(F.col("value"), delimiter).alias("fields"))
    hashes = F.array(
        *[
            F.struct(_element("fields", positions[kind]).alias("hash"), F.lit(kind).alias("hash_type"))
            for kind in ("MD5", "SHA1", "SHA256")
        ]
    )
    parsed = divide(
        fields,
        {"width": F.size("fields") <= max(positions.values())},
        [_element("fields", clink).alias("clink"), hashes.alias("hashes")],
        observation,
        once,
    )
    rows = parsed.rows.select("clink", F.inline("hashes")).select("hash", "clink", "hash_type")
    return Parsed(rows, parsed.rejects)


def valid_hashes(rows: DataFrame) -> DataFrame:
    """Rows whose ``hash`` decodes as hex."""
    return rows.where(hash_fault(F.col("hash")).isNull())


def hash_faults(rows: DataFrame) -> DataFrame:
    """``value, reason`` once per distinct hash that does not decode as hex."""
    return (
        rows.select(F.col("hash").alias("value"), hash_fault(F.col("hash")).alias("reason"))
        .where(F.col("reason").isNotNull())
        .distinct()
    )


def parse_arl_pel(lines: DataFrame, *, observation: Observation | None = None, once: bool = False) -> Parsed:
    """``arl|pel`` lines with a hex key -> ``arl`` (binary), ``pel``."""
    fields = lines.select("value", split_all(F.col("value"), "|").alias("fields")).select(
        "value",
        F.size("fields").alias("width"),
        _element("fields", 0).alias("arl"),
        _element("fields", 1).alias("pel"),
    )
    return divide(
        fields,
        {
            "width": F.col("width") != 2,
            "blank_field": (F.col("arl") == "") | (F.col("pel") == ""),
            "bad_key": hash_fault(F.col("arl")).isNotNull(),
        },
        [F.unhex("arl").alias("arl"), F.col("pel")],
        observation,
        once,
    )

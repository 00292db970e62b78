"""Spark side of the registered queries: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from catalog.feeds import ACCOUNT, REGION, SALT, feed_sql, tables_of
from kinloom.fixed import ENCRYPTED_HEADER, HASH_FAMILY, MATCH_HEADER
from kinloom.functions.hashes import hash_fault, hashes_by_length
from kinloom.functions.identity import (
    decrypt_field,
    is_clink,
    is_pel,
    salted_account_arl,
    salted_hash_arl,
    salted_pel,
    same_pel,
    secret,
)
from kinloom.functions.text import is_blank, split_ragged, strip_outer_quotes, trim_control
from kinloom.operators.cells import (
    apply_mutations,
    latest,
    pivot_rows,
    scan_prefix,
    to_cells,
)
from kinloom.operators.counters import STANDARD_ERROR, load_counters, merged_counters, observed
from kinloom.operators.expansion import cells_of, look_up, pairs_of, save_expansion
from kinloom.operators.owners import merge_load, merge_ranks, owner_per_hash, owner_ranks, owners_of
from kinloom.operators.parse import (
    parse_account_lines,
    parse_columns,
    parse_hashes_by_length,
    parse_id_hash,
    parse_identity_records,
    parse_one_to_many,
    parse_pairs,
    valid_hashes,
)
from kinloom.plans.account import (
    account_keys,
    account_load_incremental,
    account_refresh_full,
)
from kinloom.plans.account_layout import open_accounts, refresh_account, save_accounts
from kinloom.plans.column_encryption import (
    HEADER_COLUMNS,
    encrypt_columns,
    encrypt_fields,
    encrypted_lines,
)
from kinloom.plans.file_decryption import decrypt_blocks, decrypt_files, read_blocks, split_lines
from kinloom.plans.hash_mapping import build_arl_pel_mapping, load_arl_pel, mapping_lines
from kinloom.plans.last_seen import merge_sightings, open_seen, save_seen, seen_lately
from kinloom.plans.match_table import (
    load_match_table_by_length,
    load_match_table_join,
    match_lines,
    match_lookup,
)
from kinloom.plans.pii_expansion import expand_pii
from kinloom.plans.recent_pels import recent_pels
from kinloom.plans.two_way import load_two_way
from kinloom.session import passing, scratch_dir, staged
from kinloom.sources.buckets import open_buckets
from kinloom.sources.framed import read_framed, write_framed
from kinloom.sources.lines import dialect_scores, infer_dialect, read_files, read_lines
from kinloom.sources.sinks import write_lines
from kinloom.sources.snapshots import append_snapshot, open_snapshot, publish_snapshot

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

KEY = "0123456789abcdef0123456789abcdef"
OLD_TS, NEW_TS = 1000, 2000
ACCOUNT_OPTIONS = dict(
    ana=ACCOUNT, cid_key="CID", delimiter=",", arl_fn=salted_account_arl(SALT), load_ts=NEW_TS
)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# The reader's setting for tables of fewer row groups than the machine has cores.
FEED_PARTITIONS = "spark.kinloom.feedPartitions"


def spread(df: DataFrame) -> DataFrame:
    """Rows over as many partitions as the setting names; as they were read where it is not set."""
    partitions = df.sparkSession.conf.get(FEED_PARTITIONS, None)
    return df.repartition(int(partitions)) if partitions else df


def feed(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.sql(feed_sql(name, "spark"), **{t: spread(table(spark, sf, t)) for t in tables_of(name)})


def hex_key(cells: DataFrame) -> DataFrame:
    return cells.withColumn("row_key", F.lower(F.hex("row_key")))


# Hashed identifiers -> pseudonymous ids


def _mapping(spark: SparkSession, sf: str):
    return build_arl_pel_mapping(
        feed(spark, sf, "identity_lines"), pel_fn=salted_pel(SALT), arl_fn=salted_hash_arl(SALT)
    )


@query
def arl_pel_mapping(spark, sf):
    return _mapping(spark, sf).mapping


@query
def arl_pel_rejects(spark, sf):
    return _mapping(spark, sf).rejects


@query
def arl_pel_load(spark, sf):
    """The mapping loaded as cells."""
    return hex_key(load_arl_pel(mapping_lines(_mapping(spark, sf).mapping), None, family="uk").table)


@query
def arl_pel_through_files(spark, sf):
    """The mapping written as text files, read back and loaded."""
    path = scratch_dir(spark, "mapping")
    write_lines(mapping_lines(_mapping(spark, sf).mapping), path)
    return hex_key(load_arl_pel(read_lines(spark, f"{path}/part-*"), None, family="uk").table)


@query
def identity_unpivot(spark, sf):
    """Claims per hash type and hash length after the unpivot, before any check."""
    rows = parse_identity_records(feed(spark, sf, "identity_lines")).rows
    return rows.groupBy("hash_type", F.length("hash").alias("hash_length")).agg(
        F.count("*").alias("claims")
    )


@query
def owner_of_hash(spark, sf):
    rows = parse_identity_records(feed(spark, sf, "identity_lines")).rows
    return owner_per_hash(valid_hashes(rows))


def _two_loads(spark, sf):
    """The claims of about half of the records, and of the others."""
    lines = feed(spark, sf, "identity_lines")
    first = F.substring(F.md5("value"), 1, 1) < "8"
    return [parse_identity_records(lines.where(part)).rows for part in (first, ~first)]


def _owner_loads(spark, sf):
    """The state after the first load, and what the second one changes."""
    first, second = map(valid_hashes, _two_loads(spark, sf))
    ranks = staged(owner_ranks(first), "ranks")
    return ranks, merge_load(ranks, second).changed


@query
def owner_over_loads(spark, sf):
    """Owners after two loads, from the stored state and the changes of the second."""
    ranks, changed = _owner_loads(spark, sf)
    return owners_of(merge_ranks(ranks, changed.select("hash", "rank")))


@query
def owner_changes(spark, sf):
    """Hashes whose owner the second load changes, with the owner before."""
    _, changed = _owner_loads(spark, sf)
    return changed.select("hash", "rank.clink", "rank.hash_type", "before")


@query
def counters_over_loads(spark, sf):
    """Records and different hashes of two loads by fault: exact numbers, and whether the united sketches are near."""
    loads = _two_loads(spark, sf)
    stored = staged(load_counters(loads[0], "1").unionByName(load_counters(loads[1], "2")), "counters")
    both = loads[0].unionByName(loads[1]).where(F.col("hash").isNotNull())
    reason = F.coalesce(hash_fault(F.col("hash")), F.lit("success")).alias("reason")
    exact = both.groupBy(reason).agg(F.count_distinct("hash").alias("exact"))
    off = F.abs(F.col("distinct_hashes") - F.col("exact"))
    return (
        merged_counters(stored)
        .join(exact, "reason")
        .select("reason", "n", (off <= 4 * STANDARD_ERROR * F.col("exact")).alias("near"))
    )


@query
def observed_counters(spark, sf):
    """Lines and rejects by reason, counted by the job that wrote the claims."""
    seen = Observation("identity_lines")
    rows = parse_identity_records(feed(spark, sf, "identity_lines"), observation=seen).rows
    staged(rows, "claims")
    return observed(seen, rows)


@query
def mappings_per_pel(spark, sf):
    return _mapping(spark, sf).mapping.groupBy("pel").agg(F.count("*").alias("mappings"))


@query
def hash_check_counters(spark, sf):
    """How many records were too short, how many distinct hashes failed and passed."""
    built = _mapping(spark, sf)
    failed = built.rejects.groupBy("reason").agg(F.count("*").alias("n"))
    passed = built.mapping.agg(F.lit("success").alias("reason"), F.count("*").alias("n"))
    return failed.unionByName(passed)


# Two-way link tables


def _two_way(spark, sf):
    return load_two_way(
        feed(spark, sf, "two_way_lines"), None, None, family="links", load_ts=NEW_TS
    )


@query
def two_way_forward(spark, sf):
    return _two_way(spark, sf).forward


@query
def two_way_reverse(spark, sf):
    return _two_way(spark, sf).reverse


@query
def two_way_fan_out(spark, sf):
    """Both tables and the rejects from one parse, each row with its sink."""
    loaded = load_two_way(
        feed(spark, sf, "two_way_lines"), None, None, family="links", load_ts=NEW_TS, once=True
    )

    def to(sink, rows, key, linked):
        return rows.select(F.lit(sink).alias("sink"), F.col(key).alias("key"), F.col(linked).alias("linked"))

    tables = to("forward", loaded.forward, "row_key", "qualifier").unionByName(to("reverse", loaded.reverse, "row_key", "qualifier"))
    return tables.unionByName(to("rejects", loaded.rejects, "value", "reason"))


@query
def one_to_many_rows(spark, sf):
    rows = parse_one_to_many(feed(spark, sf, "two_way_lines")).rows
    return rows.select("key", F.col("value_").alias("linked"))


# Expansion of a person's hashes


def _expansion(spark, sf, emails="email_lines", phones="phone_lines", **options):
    return expand_pii(
        feed(spark, sf, emails),
        feed(spark, sf, phones),
        None,
        region=REGION,
        load_ts=NEW_TS,
        **options,
    )


@query
def pii_expansion(spark, sf):
    return _expansion(spark, sf).table


@query
def pii_expansion_rejects(spark, sf):
    return _expansion(spark, sf).rejects


def _saved_expansion(spark, sf):
    path = scratch_dir(spark, "expansion")
    with passing(spark):
        save_expansion(_expansion(spark, sf, kept=True).table, path, region=REGION, rounds=4)
    return open_buckets(spark, path)


@query
def pii_expansion_lookup(spark, sf):
    """An e-mail and a phone request per customer: the cells that answer them, and how many hashes each group links."""
    customers = table(spark, sf, "customer")

    def asked(kind: str, letter: str, step: int) -> DataFrame:
        key = step * F.col("c_custkey")
        return customers.select(F.lit(kind).alias("type"), F.sha2(F.concat(F.lit(letter), key.cast("string")), 256).alias("hash"))

    keys = asked("email", "e", 4).unionByName(asked("phone", "p", 6))
    with passing(spark):
        found = look_up(_saved_expansion(spark, sf), keys, region=REGION, kept=True)
    return cells_of(found, kept=True)


@query
def pii_expansion_pairs(spark, sf):
    """Everything linked to one e-mail and one phone hash per supplier, pair by pair."""
    suppliers = table(spark, sf, "supplier")

    def asked(kind: str, letter: str, step: int) -> DataFrame:
        key = F.col("s_suppkey") - F.col("s_suppkey") % step
        return suppliers.select(F.lit(kind).alias("type"), F.sha2(F.concat(F.lit(letter), key.cast("string")), 256).alias("hash"))

    keys = asked("email", "e", 4).unionByName(asked("phone", "p", 6))
    return pairs_of(look_up(_saved_expansion(spark, sf), keys, region=REGION))


@query
def id_hash_pairs(spark, sf):
    return parse_id_hash(feed(spark, sf, "email_lines")).rows


# Match table


def _match_join(spark, sf):
    return load_match_table_join(
        feed(spark, sf, "provider_lines"),
        feed(spark, sf, "kb_lines"),
        None,
        provider_sha256=1,
        kb_clink=0,
        kb_md5=1,
        kb_sha1=2,
        kb_sha256=3,
        pel_fn=salted_pel(SALT),
    )


@query
def match_load_join(spark, sf):
    return _match_join(spark, sf).table


@query
def match_load_join_rejects(spark, sf):
    rejects = _match_join(spark, sf).rejects
    return rejects.groupBy("reason").agg(F.count("*").alias("n"))


@query
def match_load_by_length(spark, sf):
    """Keyed by the person key itself, so lines with a blank key are dropped."""
    return load_match_table_by_length(
        feed(spark, sf, "any_order_lines"), None, pel_fn=same_pel
    ).table


@query
def first_hash_by_length(spark, sf):
    return parse_hashes_by_length(feed(spark, sf, "any_order_lines")).rows


@query
def csv_columns(spark, sf):
    return parse_columns(
        feed(spark, sf, "kb_lines"),
        {"clink": 0, "md5": 1, "sha256": 3, "absent": 9},
        required=("clink", "sha256"),
    ).rows


def match_cells(spark, sf):
    rows = feed(spark, sf, "match_rows")
    return to_cells(
        rows,
        row_key=F.col("pel"),
        family=HASH_FAMILY,
        columns={name: F.col(name) for name in ("md5", "sha1", "sha256")},
    )


@query
def match_table_cells(spark, sf):
    return match_cells(spark, sf)


def _lookup(spark, sf, **options):
    return match_lookup(feed(spark, sf, "request_lines"), match_cells(spark, sf), **options)


@query
def match_lookup_latest(spark, sf):
    return _lookup(spark, sf)


@query
def match_lookup_of_one_family(spark, sf):
    """The table also holds later cells of another family, which answer nothing."""
    cells = match_cells(spark, sf)
    other = cells.withColumns({"family": F.lit("other"), "ts_micros": F.lit(NEW_TS).cast("bigint"), "value": F.reverse("value")})
    return match_lookup(feed(spark, sf, "request_lines"), cells.unionByName(other))


@query
def match_lookup_blank_matches_all(spark, sf):
    return _lookup(spark, sf, blank_matches_all=True)


@query
def match_delivery_file(spark, sf):
    """The lookup written as files with a header and read back."""
    path = scratch_dir(spark, "delivery")
    write_lines(match_lines(_lookup(spark, sf)), path, header=MATCH_HEADER)
    back = spark.read.option("sep", "|").option("header", True).option("quote", "").csv(path)
    return back.select(*[F.coalesce(c, F.lit("")).alias(c) for c in MATCH_HEADER.split("|")])


@query
def request_pairs(spark, sf):
    rows = parse_pairs(feed(spark, sf, "request_lines")).rows
    return rows.select(F.col("key").alias("cookie"), F.col("value_").alias("pel"))


@query
def hash_repair(spark, sf):
    rows = pivot_rows(match_cells(spark, sf), HASH_FAMILY, ["md5", "sha1", "sha256"])
    fixed = hashes_by_length(F.array("md5", "sha1", "sha256"))
    return rows.select("row_key", *[F.coalesce(c, F.lit("")).alias(n) for n, c in fixed.items()])


# Cell tables


@query
def latest_cells(spark, sf):
    return latest(feed(spark, sf, "cell_writes"))


@query
def row_pivot(spark, sf):
    return pivot_rows(feed(spark, sf, "cell_writes"), HASH_FAMILY, ["md5", "sha1", "sha256"])


@query
def upsert_and_delete(spark, sf):
    """Delete the rows of customers with a negative balance, then upsert."""
    current = latest(feed(spark, sf, "cell_writes"))
    customer = table(spark, sf, "customer")
    key = F.concat(
        F.lit("0000GB"), F.upper(F.substring(F.md5(F.col("c_custkey").cast("string")), 1, 10))
    )
    puts = to_cells(
        customer,
        row_key=key,
        family=HASH_FAMILY,
        columns={"md5": F.md5("c_name"), "sha1": F.sha1("c_name")},
        ts_micros=F.when(F.col("c_mktsegment") == "BUILDING", F.lit(0)).otherwise(F.lit(NEW_TS)),
    )
    gone = customer.where(F.col("c_acctbal") < 0).select(key.alias("row_key"))
    return apply_mutations(current, puts, gone)


@query
def published_snapshot(spark, sf):
    """Two versions published one after the other; readers see the second."""
    root = scratch_dir(spark, "snapshot")
    before = _accounts(spark, sf).diff
    publish_snapshot(before, root, by_key=True)
    loaded = account_load_incremental(
        feed(spark, sf, "account_lines"), open_snapshot(spark, root), None, **ACCOUNT_OPTIONS
    )
    publish_snapshot(loaded.diff, root)
    return open_snapshot(spark, root)


@query
def appended_snapshot(spark, sf):
    """The load added to the table instead of rewriting it; merged when read."""
    root = scratch_dir(spark, "snapshot")
    publish_snapshot(_accounts(spark, sf).diff, root)
    loaded = account_load_incremental(
        feed(spark, sf, "account_lines"), None, None, **ACCOUNT_OPTIONS
    )
    append_snapshot(loaded.diff, root)
    return open_snapshot(spark, root)


# Customer accounts


@query
def account_parse(spark, sf):
    return parse_account_lines(
        feed(spark, sf, "account_lines"), cid_key="CID", delimiter=","
    ).rows


@query
def account_rejects(spark, sf):
    """Delimiter inferred from the lines."""
    return parse_account_lines(feed(spark, sf, "account_lines"), cid_key="CID").rejects


class _accounts:
    """Account tables before the load: accounts 1, 12 and 123, and rows of another family."""

    def __init__(self, spark, sf):
        rows = feed(spark, sf, "accounts")
        arl = salted_account_arl(SALT)(F.col("ana"), F.col("cid"))
        cells = dict(columns={"pel": F.col("pel")}, ts_micros=OLD_TS)
        self.diff = to_cells(
            rows, row_key=F.concat_ws("#", F.col("ana").cast("string"), "cid"), family="pel", **cells
        )
        by_hash = to_cells(rows, row_key=arl, family="pel", **cells)
        uk = rows.where(F.col("c_mktsegment") == "MACHINERY")
        self.arl = by_hash.unionByName(to_cells(uk, row_key=arl, family="uk", **cells))


def _incremental(spark, sf):
    now = _accounts(spark, sf)
    return account_load_incremental(
        feed(spark, sf, "account_lines"), now.diff, now.arl, **ACCOUNT_OPTIONS
    )


def _refresh(spark, sf, match="exact"):
    now = _accounts(spark, sf)
    return account_refresh_full(
        feed(spark, sf, "account_lines"), now.diff, now.arl, match=match, **ACCOUNT_OPTIONS
    )


@query
def account_incremental_diff(spark, sf):
    return _incremental(spark, sf).diff


@query
def account_incremental_arl(spark, sf):
    return hex_key(_incremental(spark, sf).arl)


@query
def account_refresh_diff(spark, sf):
    return _refresh(spark, sf).diff


@query
def account_refresh_arl(spark, sf):
    return hex_key(_refresh(spark, sf).arl)


@query
def account_refresh_prefix_diff(spark, sf):
    """Without the separator in the prefix, account 12 also covers 123."""
    return _refresh(spark, sf, match="prefix").diff


@query
def account_refresh_prefix_arl(spark, sf):
    return hex_key(_refresh(spark, sf, match="prefix").arl)


def _partitioned(spark, sf) -> str:
    """Folder with the tables of accounts 1, 12 and 123, a folder each."""
    root = scratch_dir(spark, "accounts")
    now = _accounts(spark, sf)
    save_accounts(now.diff, now.arl, root, arl_fn=salted_account_arl(SALT))
    return root


def _refresh_folder(spark, sf, root):
    options = {k: v for k, v in ACCOUNT_OPTIONS.items() if k not in ("ana", "arl_fn")}
    refresh_account(feed(spark, sf, "account_lines"), root, ana=ACCOUNT, arl_fn=salted_account_arl(SALT), **options)
    return root


@query
def account_folder_refresh_diff(spark, sf):
    """The refresh of one account's folder."""
    return open_accounts(spark, _refresh_folder(spark, sf, _partitioned(spark, sf)), "diff")


@query
def account_folder_refresh_arl(spark, sf):
    return hex_key(open_accounts(spark, _refresh_folder(spark, sf, _partitioned(spark, sf)), "arl"))


@query
def account_folder_files(spark, sf):
    """Per account, whether all its files are the same after the refresh of account 12."""
    root = _partitioned(spark, sf)

    def files(table):
        meta = spark.read.parquet(f"{root}/{table}").select("ana", "_metadata.file_name", "_metadata.file_modification_time")
        return meta.withColumn("in_table", F.lit(table)).distinct()

    before = staged(files("diff").unionByName(files("arl")), "before")
    _refresh_folder(spark, sf, root)
    after = files("diff").unionByName(files("arl"))
    found = before.withColumn("b", F.lit(1)).join(after.withColumn("a", F.lit(1)), before.columns, "full_outer")
    return found.groupBy("ana").agg(F.bool_and(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("untouched"))


@query
def account_key_scan(spark, sf):
    return scan_prefix(_accounts(spark, sf).diff, f"{ACCOUNT}#")


@query
def account_key_parts(spark, sf):
    return account_keys(_accounts(spark, sf).diff, 1, match="prefix")


@query
def account_key_parts_exact(spark, sf):
    return account_keys(_accounts(spark, sf).diff, ACCOUNT)


@query
def account_parse_semicolons(spark, sf):
    """The same lines with another separator, which is inferred from all of them."""
    lines = feed(spark, sf, "account_lines").select(F.replace("value", F.lit(","), F.lit(";")).alias("value"))
    return parse_account_lines(lines, cid_key="CID").rows


def _dialect_feeds(spark, sf):
    """Feeds of several dialects made of the given rows."""
    kb = feed(spark, sf, "kb_lines")
    orders = table(spark, sf, "orders")
    notes = F.repeat(F.lit("a, b, c; "), (F.col("o_orderkey") % 7).cast("int"))
    values = {
        "pipes": F.col("value"),
        "tabs": F.replace(F.replace("value", F.lit('"'), F.lit("")), F.lit("|"), F.lit("\t")),
        "semicolons": F.replace("value", F.lit("|"), F.lit(";")),
    }
    feeds = {name: kb.select(value.alias("value")) for name, value in values.items()}
    # The commonest sign is a comma: within quotes, and in notes of uneven length.
    quoted = F.concat(F.lit('"'), notes, F.lit('x",'), "o_orderstatus", F.lit(","), F.col("o_custkey").cast("string"))
    feeds["quoted_commas"] = orders.select(quoted.alias("value"))
    feeds["uneven_commas"] = orders.select(F.concat_ws("|", F.col("o_orderkey").cast("string"), notes, "o_orderstatus").alias("value"))
    return feeds


@query
def dialect_scores_of_feeds(spark, sf):
    """How well each dialect fits each of five feeds, in parts per thousand."""
    out = None
    for name, lines in _dialect_feeds(spark, sf).items():
        scores = dialect_scores(lines).select(F.lit(name).alias("feed"), "dialect", F.round(1000 * F.col("score"), 3).alias("score"))
        out = scores if out is None else out.unionByName(scores)
    return out


@query
def dialect_of_feeds(spark, sf):
    """The dialect chosen for each feed, and the lines that three fields or four come of when it is used."""
    out = None
    for name, lines in _dialect_feeds(spark, sf).items():
        found = infer_dialect(lines)
        parsed = parse_columns(lines, {"a": 0, "c": 2}, required=("c",), delimiter=found.delimiter, quoted=found.quoted)
        row = parsed.rows.agg(
            F.lit(name).alias("feed"), F.lit(found.delimiter).alias("delimiter"), F.lit(found.quoted).alias("quoted"), F.count("*").alias("lines")
        )
        out = row if out is None else out.unionByName(row)
    return out


# Identifiers


@query
def identifier_translation(spark, sf):
    """The three translations, with their salts read from a table."""
    salts = table(spark, sf, "region").select(
        F.col("r_regionkey").cast("string").alias("name"), F.md5("r_name").alias("value")
    )
    rows = feed(spark, sf, "accounts")
    return rows.select(
        "ana",
        "cid",
        salted_pel(secret(salts, "0"))(F.col("pel")).alias("pel"),
        F.lower(F.hex(salted_account_arl(secret(salts, "1"))(F.col("ana"), F.col("cid")))).alias("arl"),
        F.lower(
            F.hex(salted_hash_arl(secret(salts, "2"))(F.upper(F.md5("cid")), F.lit("MD5")))
        ).alias("hash_arl"),
    )


@query
def identifier_predicates(spark, sf):
    """First field of identity and person lines, checked for both id forms."""
    lines = feed(spark, sf, "identity_lines").unionByName(feed(spark, sf, "person_lines"))
    lines = lines.unionByName(feed(spark, sf, "match_rows").select(F.col("pel").alias("value")))
    first = F.get(F.split("value", "[,|]", -1), F.lit(0))
    return lines.select("value", is_clink(first).alias("clink"), is_pel(first).alias("pel"))


@query
def text_rules(spark, sf):
    """Trimming, quote removal, blank test, hash faults and ragged width of every line."""
    lines = feed(spark, sf, "account_lines").unionByName(feed(spark, sf, "identity_lines"))
    value = F.col("value")
    return lines.select(
        trim_control(value).alias("trimmed"),
        strip_outer_quotes(trim_control(value)).alias("unquoted"),
        is_blank(value).alias("blank"),
        F.size(split_ragged(value, "|")).alias("width"),
        hash_fault(F.get(split_ragged(value, "|"), F.lit(1))).alias("fault"),
    )


# Encryption


def _encrypted(function, spark, sf):
    return function(
        feed(spark, sf, "person_lines"), key=KEY, pel_fn=salted_pel(SALT)
    )


@query
def encrypt_round_trip(spark, sf):
    """The fourteen columns and what a line has beyond; all but the id are decrypted again."""
    rows = _encrypted(encrypt_columns, spark, sf).rows
    return rows.select(
        F.col("PEL").alias("pel"),
        *[
            F.when(F.col(c) == "", F.lit("")).otherwise(decrypt_field(F.col(c), KEY)).alias(c.lower())
            for c in HEADER_COLUMNS[1:]
        ],
        F.array_join(F.transform("surplus", lambda x: decrypt_field(x, KEY)), ",").alias("surplus"),
    )


@query
def encrypt_rejects(spark, sf):
    return _encrypted(encrypt_columns, spark, sf).rejects


@query
def encrypted_file(spark, sf):
    """Lines of any width written with the header and read back, then decrypted."""
    path = scratch_dir(spark, "encrypted")
    lines = encrypted_lines(_encrypted(encrypt_fields, spark, sf).rows)
    write_lines(lines, path, header=ENCRYPTED_HEADER)
    fields = F.split("value", ",", -1)
    rest = F.transform(
        F.slice(fields, F.lit(2), F.size(fields) - 1),
        lambda x: F.when(x == "", F.lit("")).otherwise(decrypt_field(x, KEY)),
    )
    back = read_lines(spark, path).where(F.col("value") != ENCRYPTED_HEADER)
    return back.select(F.array_join(F.concat(F.array(F.get(fields, F.lit(0))), rest), ",").alias("value"))


def _sealed(spark, sf, broken):
    text = F.col("text").cast("binary")
    sealed = F.when(broken, text).otherwise(F.aes_encrypt(text, F.lit(KEY)))
    return spread(table(spark, sf, "documents")).withColumn("content", sealed)


@query
def decrypt_files_lines(spark, sf):
    """One file per document; those in German are not encrypted and fail."""
    docs = _sealed(spark, sf, F.col("lang") == "de")
    files = docs.select(
        F.col("doc_id").cast("string").alias("path"), F.length("content").alias("length"), "content"
    )
    return decrypt_files(files, key=KEY).lines


@query
def decrypt_files_rejects(spark, sf):
    docs = _sealed(spark, sf, F.col("lang") == "de")
    files = docs.select(
        F.col("doc_id").cast("string").alias("path"), F.length("content").alias("length"), "content"
    )
    return decrypt_files(files, key=KEY).rejects


@query
def decrypt_blocks_lines(spark, sf):
    """One file per source, one block per document; a broken block fails its file."""
    docs = _sealed(spark, sf, (F.col("lang") == "de") & (F.col("source") == "src2"))
    blocks = docs.select(F.col("source").alias("path"), F.col("doc_id").alias("block_no"), F.base64("content").alias("value"))
    return decrypt_blocks(blocks, key=KEY).lines


@query
def decrypted_file_lines(spark, sf):
    """Each source's texts sealed in blocks, written as files, read, opened and written as lines in order."""
    docs = spread(table(spark, sf, "documents"))
    # Spark breaks base64 into lines; a block is one line.
    text = F.coalesce("text", F.lit("")).cast("binary")
    sealed = F.translate(F.base64(F.aes_encrypt(text, F.lit(KEY))), "\r\n", "")
    path, out = scratch_dir(spark, "blocks"), scratch_dir(spark, "opened")
    lines = docs.select("source", F.concat_ws(" ", F.col("doc_id").cast("string"), sealed).alias("value"))
    lines.write.partitionBy("source").text(path)
    opened = decrypt_blocks(read_blocks(spark, path, name="source"), key=KEY).lines
    write_lines(opened, out, order=("path", "line_no"))
    return read_lines(spark, out)


@query
def decrypt_framed_lines(spark, sf):
    """Each source's texts, empty ones too, as sealed blocks of binary files, opened by many tasks into a table of lines."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    blocks = spread(table(spark, sf, "documents")).select(
        "source", F.col("doc_id").alias("block_no"), F.aes_encrypt(text, F.lit(KEY)).alias("content")
    )
    path = scratch_dir(spark, "framed")
    write_framed(blocks, path, by=("source",))
    return staged(decrypt_blocks(read_framed(spark, path, name="source"), key=KEY).lines, "opened")


@query
def single_file_delivery(spark, sf):
    """Encrypted columns of one width, delivered as one file with its header."""
    path = scratch_dir(spark, "single")
    rows = parse_id_hash(feed(spark, sf, "email_lines")).rows
    write_lines(rows.select(F.concat_ws(" ", "id", "hash").alias("value")), path, single_file=True)
    back = spark.read.text(path).withColumn("file", F.input_file_name())
    return back.agg(F.count_distinct("file").alias("files"), F.count("*").alias("lines"), F.count_distinct("value").alias("different"))


@query
def ciphertext_of_fields(spark, sf):
    """Equal fields have equal ciphertext, different ones different, and none is its own."""
    lines = feed(spark, sf, "person_lines")
    sealed = encrypt_fields(lines, key=KEY, pel_fn=salted_pel(SALT)).rows
    cipher = sealed.select(F.explode(F.slice("fields", 2, 100)).alias("c")).where("c <> ''")
    pairs = cipher.select("c", decrypt_field(F.col("c"), KEY).alias("p"))
    return pairs.agg(
        F.count("*").alias("fields"),
        F.count_distinct("p").alias("texts"),
        F.count_distinct("c").alias("ciphertexts"),
        F.count_if(F.col("c") == F.col("p")).alias("unchanged"),
    )


# Sources


@query
def compressed_text_scan(spark, sf):
    """Lines written as gzip files, read back by glob and spread over the cluster."""
    path = scratch_dir(spark, "lines")
    feed(spark, sf, "identity_lines").write.option("compression", "gzip").text(path)
    spread = spark.sparkContext.defaultParallelism
    return read_lines(spark, f"{path}/part-*.gz", spread=spread)


@query
def binary_file_scan(spark, sf):
    """Text files written by Spark, read back as whole files and split into lines."""
    path = scratch_dir(spark, "files")
    # A file becomes one row when read whole, so files are kept small.
    feed(spark, sf, "identity_lines").write.option("maxRecordsPerFile", 500_000).text(path)
    files = read_files(spark, f"{path}/part-*")
    return files.select(F.explode(split_lines(F.col("content").cast("string"))).alias("value"))


def _sightings(spark, sf):
    """Orders as sightings of their customers' ids, and the time of the last one."""
    orders = table(spark, sf, "orders")
    customer = table(spark, sf, "customer")
    sightings = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_nationkey").cast("string").alias("country"),
        F.col("o_orderdate").alias("ts"),
        F.concat(F.lit("Xi"), F.md5("c_name")).alias("pel"),
    )
    return sightings, orders.agg(F.max("o_orderdate")).scalar()


@query
def recent_pels_of_country(spark, sf):
    """Ids of customers in nation 3 ordering in the 90 days before the last order."""
    sightings, as_of = _sightings(spark, sf)
    return recent_pels(sightings, country="3", as_of=as_of)


@query
def recent_pels_by_day(spark, sf):
    """The same from a table of last sightings that was brought forward in five steps, one of many days, then by days."""
    sightings, as_of = _sightings(spark, sf)
    root, seen, before = scratch_dir(spark, "seen"), None, None
    for back in (100, 60, 2, 1, 0):
        end = as_of - F.make_dt_interval(F.lit(back))
        part = sightings.where(F.col("ts") <= end)
        if before is not None:
            part = part.where(F.col("ts") > before)
        seen = open_seen(spark, save_seen(merge_sightings(seen, part, as_of=end), root))
        before = end
    return seen_lately(seen, country="3", as_of=as_of)

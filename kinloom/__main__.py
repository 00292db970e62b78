"""Run a job: spark-submit ... kinloom/__main__.py <job> [options], or python -m kinloom.

Tables are folders of snapshots (see ``sources.snapshots``); a job reads the
newest version, if there is one, and publishes the next. With --append a load
writes only the cells that came in and adds them to the table. Salts and keys come
from a JSON file of ``{"name": ..., "value": ...}`` lines, so they appear neither
on the command line nor in plans.
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import DataFrame, SparkSession

from kinloom.fixed import ENCRYPTED_HEADER, HASH_FAMILY, MATCH_HEADER, PREFERRED_PEL_KEY
from kinloom.functions import identity
from kinloom.plans.account import account_load_incremental, account_refresh_full
from kinloom.plans.column_encryption import encrypt_fields, encrypted_lines
from kinloom.plans.file_decryption import decrypt_blocks, decrypt_files, read_blocks
from kinloom.plans.hash_mapping import build_arl_pel_mapping, load_arl_pel, mapping_lines
from kinloom.plans.match_table import (
    load_match_table_by_length,
    load_match_table_join,
    match_lines,
    match_requests,
    parse_requests,
)
from kinloom.plans.pii_expansion import expand_pii
from kinloom.plans.two_way import load_two_way
from kinloom.session import session, staged
from kinloom.sources.lines import read_files, read_lines
from kinloom.sources.sinks import write_lines
from kinloom.sources.snapshots import (
    append_snapshot,
    current_version,
    open_snapshot,
    publish_snapshot,
)


class _Table:
    """The newest version of a table (none for a load that only adds), and the next one."""

    def __init__(self, spark: SparkSession, args: argparse.Namespace, root: str):
        self.append, self.root = args.append, root
        self.version = current_version(spark, root)
        old = self.version and not args.append
        self.cells: DataFrame | None = open_snapshot(spark, root, self.version) if old else None

    def publish(self, cells: DataFrame, *, by_key: bool = False) -> None:
        if self.append:
            append_snapshot(cells, self.root, by_key=by_key)
        else:
            publish_snapshot(cells, self.root, by_key=by_key, after=self.version)


def _lines(spark: SparkSession, args: argparse.Namespace, path: str) -> DataFrame:
    return read_lines(spark, path, spread=args.spread)


def _once(lines: DataFrame, args: argparse.Namespace) -> DataFrame:
    """Lines that feed several outputs, copied to the shared folder in one pass.

    Text is read, decompressed and spread once; the copy is columnar and each output
    parses the part it needs from there.
    """
    return staged(lines, "lines")


def _save_rejects(rejects: DataFrame, args: argparse.Namespace) -> None:
    if args.rejects:
        rejects.write.parquet(args.rejects)


def _secret(spark: SparkSession, args: argparse.Namespace, name: str):
    return identity.secret(spark.read.schema("name string, value string").json(args.secrets), name)


def build_mapping(spark, args):
    salt = _secret(spark, args, "salt")
    built = build_arl_pel_mapping(
        _lines(spark, args, args.input),
        pel_fn=identity.salted_pel(salt),
        arl_fn=identity.salted_hash_arl(salt),
        clink=args.clink_index,
        md5=args.md5_index,
        sha1=args.sha1_index,
        sha256=args.sha256_index,
        once=True,  # rows are read for the mapping and for the hashes that fail
    )
    write_lines(mapping_lines(built.mapping), args.output, single_file=args.single_file)
    _save_rejects(built.rejects, args)


def load_mapping(spark, args):
    table = _Table(spark, args, args.table)
    loaded = load_arl_pel(
        _lines(spark, args, args.input), table.cells, family=args.family, once=bool(args.rejects)
    )
    table.publish(loaded.table)
    _save_rejects(loaded.rejects, args)


def load_links(spark, args):
    forward, reverse = _Table(spark, args, args.forward), _Table(spark, args, args.reverse)
    loaded = load_two_way(
        _once(_lines(spark, args, args.input), args),
        forward.cells,
        reverse.cells,
        family=args.family,
        delimiter=args.delimiter,
        load_ts=args.load_ts,
    )
    forward.publish(loaded.forward)
    reverse.publish(loaded.reverse)
    _save_rejects(loaded.rejects, args)


def load_matches_join(spark, args):
    table = _Table(spark, args, args.table)
    loaded = load_match_table_join(
        _lines(spark, args, args.provider),
        _lines(spark, args, args.input),
        table.cells,
        provider_sha256=args.provider_index,
        kb_clink=args.clink_index,
        kb_md5=args.md5_index,
        kb_sha1=args.sha1_index,
        kb_sha256=args.sha256_index,
        pel_fn=identity.salted_pel(_secret(spark, args, "salt")),
        family=args.family,
        delimiter=args.delimiter,
    )
    table.publish(loaded.table)
    _save_rejects(loaded.rejects, args)


def load_matches_by_length(spark, args):
    table = _Table(spark, args, args.table)
    loaded = load_match_table_by_length(
        _lines(spark, args, args.input),
        table.cells,
        pel_fn=identity.salted_pel(_secret(spark, args, "salt")),
        family=args.family,
        delimiter=args.delimiter,
        once=bool(args.rejects),
    )
    table.publish(loaded.table)
    _save_rejects(loaded.rejects, args)


def lookup(spark, args):
    # Requests are needed twice, as prefixes and as rows to be answered.
    lines = _once(_lines(spark, args, args.input), args)
    requests = parse_requests(lines, delimiter=args.delimiter)
    table = open_snapshot(spark, args.table, merged=False)
    found = match_requests(requests.rows, table, family=args.family)
    write_lines(
        match_lines(found), args.output, header=MATCH_HEADER, single_file=args.single_file
    )
    _save_rejects(requests.rejects, args)


def _account(spark, args, job, **options):
    diff, arl = _Table(spark, args, args.diff), _Table(spark, args, args.arl)
    loaded = job(
        _once(_lines(spark, args, args.input), args),
        diff.cells,
        arl.cells,
        ana=args.ana,
        cid_key=args.cid_key,
        preferred_pel_key=args.preferred_pel_key,
        delimiter=args.delimiter,
        arl_fn=identity.salted_account_arl(_secret(spark, args, "salt")),
        load_ts=args.load_ts,
        **options,
    )
    # The keys to delete come from diff, so it is published last: a run that is
    # repeated after a failure in between still finds them.
    arl.publish(loaded.arl)
    diff.publish(loaded.diff, by_key=True)
    _save_rejects(loaded.rejects, args)


def account_load(spark, args):
    _account(spark, args, account_load_incremental)


def account_refresh(spark, args):
    _account(spark, args, account_refresh_full, match=args.match)


def encrypt(spark, args):
    encrypted = encrypt_fields(
        _lines(spark, args, args.input),
        key=_secret(spark, args, "key"),
        pel_fn=identity.salted_pel(_secret(spark, args, "salt")),
        translate_clink=not args.pass_ids_through,
    )
    write_lines(
        encrypted_lines(encrypted.rows),
        args.output,
        header=ENCRYPTED_HEADER,
        single_file=args.single_file,
    )
    _save_rejects(encrypted.rejects, args)


def decrypt(spark, args):
    key = _secret(spark, args, "key")
    if args.blocks:
        plain = decrypt_blocks(read_blocks(spark, args.input), key=key, charset=args.charset)
    else:
        plain = decrypt_files(read_files(spark, args.input), key=key, charset=args.charset)
    write_lines(plain.lines, args.output, single_file=args.single_file, order=("path", "line_no"))
    _save_rejects(plain.rejects, args)


def expand(spark, args):
    table = _Table(spark, args, args.table)
    expanded = expand_pii(
        _lines(spark, args, args.emails),
        _lines(spark, args, args.phones),
        table.cells,
        region=args.region,
        load_ts=args.load_ts,
        once=bool(args.rejects),
    )
    table.publish(expanded.table, by_key=True)
    _save_rejects(expanded.rejects, args)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="kinloom", description=__doc__)
    top.add_argument("--shuffle-partitions", type=int)
    jobs = top.add_subparsers(required=True)

    def job(function, help, *required):
        sub = jobs.add_parser(function.__name__.replace("_", "-"), help=help)
        sub.set_defaults(run=function, append=False)
        for name in required:
            sub.add_argument(f"--{name}", required=True)
        sub.add_argument("--rejects", help="folder for the lines left out")
        if function is not decrypt:
            sub.add_argument("--spread", type=int, help="partitions to spread gzip input over")
        if function in (load_links, account_load, account_refresh, expand):
            sub.add_argument("--load-ts", type=int, default=int(time.time() * 1_000_000))
        return sub

    def positions(sub, **defaults):
        for name, index in defaults.items():
            sub.add_argument(
                f"--{name.replace('_', '-')}-index", type=int, default=index, required=index is None
            )

    def flag(sub, *names):
        for name in names:
            sub.add_argument(f"--{name}", action="store_true")

    sub = job(build_mapping, "person records -> arl|pel lines", "input", "output", "secrets")
    positions(sub, clink=0, sha1=1, md5=2, sha256=3)
    flag(sub, "single-file")

    flag(job(load_mapping, "arl|pel lines -> table", "input", "table", "family"), "append")

    sub = job(
        load_links, "key|value|... lines -> two tables", "input", "forward", "reverse", "family"
    )
    sub.add_argument("--delimiter", default="|")
    flag(sub, "append")

    sub = job(
        load_matches_join, "records a provider also lists -> match table",
        "provider", "input", "table", "secrets",
    )
    positions(sub, provider=None, clink=None, md5=None, sha1=None, sha256=None)
    sub.add_argument("--family", default=HASH_FAMILY)
    sub.add_argument("--delimiter", default="|")
    flag(sub, "append")

    sub = job(
        load_matches_by_length, "records with hashes in any order -> match table",
        "input", "table", "secrets",
    )
    sub.add_argument("--family", default=HASH_FAMILY)
    sub.add_argument("--delimiter", default="|")
    flag(sub, "append")

    sub = job(lookup, "cookie,pel lines -> cookie|md5|sha1|sha256", "input", "table", "output")
    sub.add_argument("--family", default=HASH_FAMILY)
    sub.add_argument("--delimiter", default=",")
    flag(sub, "single-file")

    for function, help in (
        (account_load, "key=value lines added to one account"),
        (account_refresh, "key=value lines that replace one account"),
    ):
        sub = job(function, help, "input", "cid-key", "diff", "arl", "secrets")
        sub.add_argument("--ana", type=int, required=True)
        sub.add_argument("--preferred-pel-key", default=PREFERRED_PEL_KEY)
        sub.add_argument("--delimiter")
        if function is account_load:
            flag(sub, "append")
    sub.add_argument("--match", choices=("exact", "prefix"), default="exact")

    sub = job(encrypt, "encrypt all fields but the id", "input", "output", "secrets")
    flag(sub, "single-file", "pass-ids-through")

    sub = job(decrypt, "encrypted files -> lines", "input", "output", "secrets")
    sub.add_argument("--charset", default="UTF-8")
    flag(sub, "single-file", "blocks")

    sub = job(expand, "id hash lines -> expansion table", "emails", "phones", "table", "region")
    flag(sub, "append")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = session("kinloom", shuffle_partitions=args.shuffle_partitions)
    args.run(spark, args)


if __name__ == "__main__":
    main()

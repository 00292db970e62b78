"""Placement on shards by a permutation-filled lookup table, with DataFrame functions alone."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLE_SIZE = 65_537


def _number(name: str, use: str) -> int:
    return int.from_bytes(hashlib.md5(f"{use}:{name}".encode()).digest()[:8], "big")


def fill_table(shards: dict[str, int], size: int = TABLE_SIZE) -> list[str]:
    """The shard of each slot. ``shards`` has the turns each shard takes in a round.

    Every shard prefers the slots in an order of its own, start + k * step modulo the
    prime ``size``, both taken from a hash of its name. Shards take turns by name, each
    claiming the first free slot it prefers, until all are claimed. Shares differ by one
    turn at most, and a shard that comes or goes moves few other slots. The table is as
    large as ``size``, whatever the data, so it is filled here.
    """
    if size < 2 or any(size % k == 0 for k in range(2, int(size**0.5) + 1)):
        raise ValueError("the size of the table must be prime")
    turns = {s: n for s, n in sorted(shards.items()) if n > 0}
    if not turns or len(turns) > size:
        raise ValueError("there must be a shard, and a slot for each")
    at = {s: _number(s, "start") % size for s in turns}
    step = {s: _number(s, "step") % (size - 1) + 1 for s in turns}
    table: list[str | None] = [None] * size
    free = size
    while free:
        for shard, n in turns.items():
            for _ in range(min(n, free)):
                slot = at[shard]
                while table[slot] is not None:
                    slot = (slot + step[shard]) % size
                table[slot] = shard
                at[shard] = (slot + step[shard]) % size
                free -= 1
    return table  # type: ignore[return-value]


def lookup_table(spark: SparkSession, shards: dict[str, int], size: int = TABLE_SIZE) -> DataFrame:
    """``slot, shard``."""
    return spark.createDataFrame(list(enumerate(fill_table(shards, size))), "slot int, shard string")


def slot_of(key: Column, size: int = TABLE_SIZE) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(size)).cast("int")


def place(rows: DataFrame, key: Column, shards: dict[str, int], size: int = TABLE_SIZE) -> DataFrame:
    """``rows`` with ``slot, shard`` (which replace columns of these names).

    The table has ``size`` slots, about one MB at the default, and is therefore
    broadcast: a key is placed by one lookup and no row moves. Equal keys share a shard;
    a null key hashes like an empty one's seed and has one slot, so give rows without a
    key something else to hash. An empty table gives none.
    """
    table = F.broadcast(lookup_table(rows.sparkSession, shards, size))
    return rows.drop("slot", "shard").withColumn("slot", slot_of(key, size)).join(table, "slot")


def place_documents(docs: DataFrame, shards: dict[str, int], size: int = TABLE_SIZE) -> DataFrame:
    """``doc_id, slot, shard``: documents placed by doc_id, those without one by their whole text.

    Rows that repeat a doc_id share a shard. A null text counts as empty. Shares of a
    source, a language or a group of copies play no part.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    return place(docs.select(F.col("doc_id").cast("long").alias("doc_id"), key.alias("_key")), F.col("_key"), shards, size).select(
        "doc_id", "slot", "shard"
    )

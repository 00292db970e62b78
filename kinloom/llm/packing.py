"""Best-fit packing of token sequences by hierarchical residual packing."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinloom.llm.common import texts
from kinloom.llm.word_bpe import word_bpe
from kinloom.llm.wordwise import ragged
from kinloom.session import staged

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
NAMES = [c.split()[0] for c in PIECES.split(", ")]
PACKED = f"{PIECES}, _row long, sequence_id long, offset long, done boolean"


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document.

    The ids of a document are those of its text and one 0; a document over ``capacity``
    is cut into pieces of that many ids, the last one shorter. A null or empty text has
    the id 0 alone. Rows with a null or a repeated doc_id are documents of their own.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_bpe(tokenizer_path)
        for batch in batches:
            for first, ids, size in tokens.encoded(batch["text"], 0):
                count = -(-size // capacity)
                piece = ragged(np.zeros(len(size), np.int64), count)
                start = piece * capacity
                length = np.minimum(np.repeat(size, count) - start, capacity)
                ends = np.cumsum(length).tolist()
                crc = [zlib.crc32(ids[a:b]) for a, b in zip([0, *ends], ends)]
                doc = np.repeat(np.arange(first, first + len(size)), count)
                columns = [batch["doc_id"].take(pa.array(doc)), pa.array(piece, pa.int32()), start, length, pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names=NAMES)

    return texts(docs).mapInArrow(cut, PIECES)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin of each item, and the room that is left in each bin: best fit, large items first.

    Rooms are small integers: one stack of bins for each, and one bit set of the
    stacks that hold any, whose lowest bit at or above a size is the best fit.
    """
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, bin_of, filled = [], np.empty(len(sizes), np.int64), 0
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fits = filled >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            target = stacks[room].pop()
            if not stacks[room]:
                filled &= ~(1 << room)
        else:
            room, target = capacity, len(rooms)
            rooms.append(capacity)
        room -= size
        rooms[target] = room
        stacks[room].append(target)
        filled |= 1 << room
        bin_of[item] = target
    return bin_of, np.array(rooms, np.int64)


def best_fit_packing(pieces: DataFrame, capacity: int = 2048, slack: int = 8, group_rows: int = 100_000, fan_in: int = 8) -> DataFrame:
    """``pieces`` with ``sequence_id, offset``: which sequence holds a piece, and where.

    Hierarchical residual packing. Rows are dealt by hash into groups of about
    ``group_rows``, which are packed best fit for themselves. Sequences with at most
    ``slack`` ids of room are done; of the others each becomes one item of the next
    round, in which ``fan_in`` groups meet. Rounds end when one group is left, or when a
    round saved less than a hundredth of the sequences it got: what cannot be joined is
    then final, so no task ever gets all rows. Each round is written to the shared
    folder. Pieces longer than ``capacity`` are refused; an empty table gives none.
    """

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["sequence_id", "offset"], kind="stable")
        items, item = np.unique(rows["sequence_id"].to_numpy(), return_inverse=True)
        sizes = np.bincount(item, rows["length"].to_numpy(), len(items)).astype(np.int64)
        if len(sizes) and sizes.max() > capacity:
            raise ValueError("a piece is longer than a sequence")
        bin_of, room = best_fit(sizes, capacity)
        order = np.argsort(bin_of, kind="stable")
        placed, starts = sizes[order], np.flatnonzero(np.diff(bin_of[order], prepend=-1))
        before = np.cumsum(placed) - placed
        base = np.empty(len(items), np.int64)
        base[order] = before - np.repeat(before[starts], np.diff(starts, append=len(items)))
        first = items[order][starts]
        return rows.assign(
            sequence_id=first[bin_of][item],
            offset=rows["offset"].to_numpy() + base[item],
            done=(room <= slack)[bin_of][item],
        )[[c.split()[0] for c in PACKED.split(", ")]]

    rows = pieces.select(*NAMES)
    rows = staged(rows.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    todo = rows.withColumns({"sequence_id": F.col("_row"), "offset": F.lit(0).cast("long"), "done": F.col("length") == capacity})
    parts, todo = [todo.where("done")], todo.where("not done")
    n = before = todo.count()
    groups = -(-n // group_rows)
    while n:
        grouped = todo.withColumn("_g", F.pmod(F.xxhash64("sequence_id", F.lit(len(parts))), F.lit(groups)))
        packed = staged(grouped.repartition(max(groups, 1), "_g").groupBy("_g").applyInPandas(lambda x: pack(x), PACKED), "packed")
        n, bins = packed.where("not done").agg(F.count("*"), F.count_distinct("sequence_id")).first()
        if groups == 1 or bins > 0.99 * before:
            parts.append(packed)
            break
        parts.append(packed.where("done"))
        todo, before = packed.where("not done"), bins
        groups = max(-(-groups // fan_in), -(-n // (group_rows * fan_in)))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")

"""Token ids of a corpus as files of Simple-8b words, in the order of doc_id.

A folder of Parquet files holds *stripes*: documents that follow one another, with about
65,536 ids or one longer document. A stripe has ``part`` (its place among the files),
``first`` (ids before it in the part), of each document ``doc_ids`` and ``lengths``, the
64-bit ``words`` in little-endian order, and ``offsets``: where in the words each block
begins. A block has up to 1,024 ids of one document, so any stretch of ids is decoded from
the blocks it touches.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinloom.llm import simple8b
from kinloom.llm.common import texts
from kinloom.llm.simple8b import BLOCK, blocks_of
from kinloom.llm.word_bpe import word_bpe
from kinloom.session import staged

ENCODED = "part int, doc_id long, tie long, length int, counts binary, words binary"
STRIPE = "part int, first long, doc_ids array<long>, lengths array<int>, offsets array<int>, words binary"
STRIPE_IDS = 1 << 16
#: Stands for a null doc_id, which comes first.
LEAST_ID = -(1 << 63)


def bounds(docs: DataFrame, parts: int) -> list[int]:
    """Upper ends of the first ``parts - 1`` of about equally many rows; a frequent doc_id fills several."""
    if parts < 2:
        return []
    at = [i / parts for i in range(1, parts)]
    number = F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST_ID))
    return docs.agg(F.percentile_approx(number, F.lit(at), F.lit(max(10_000, 20 * parts)))).first()[0] or []


def parts_of(doc_ids: np.ndarray, ties: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Part of each row. Ranges are closed above; an id that is the end of several has its rows dealt by ``ties``."""
    low, high = np.searchsorted(ends, doc_ids, "left"), np.searchsorted(ends, doc_ids, "right")
    return low + np.where(high > low, ties % np.maximum(high - low, 1), 0)


def write_tokens(docs: DataFrame, tokenizer_path: str, end: int) -> DataFrame:
    """The stripes of all ``docs``, written to the shared folder.

    The ids of a text are those of the vocabulary and ``end``; a null or empty text has
    ``end`` alone. A null doc_id comes before all others. Rows of one doc_id are documents
    of their own, ordered by a hash of their texts. Texts are encoded where they are read
    and only their words travel, to the part that their doc_id falls in. Parts are as many
    as the table has input partitions and their ends are approximate percentiles of
    doc_id, so no id and no part gets more than its share. An empty table gives none.
    """
    parts = max(docs.rdd.getNumPartitions(), 1)
    ends = np.array(bounds(docs, parts), np.int64)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_bpe(tokenizer_path)
        for batch in batches:
            for first, ids, size in tokens.encoded(batch["text"], end):
                blocks = blocks_of(size)
                words, counts = simple8b.encode(ids.astype(np.uint64), blocks)
                n = len(size)
                of_doc = np.append(0, np.cumsum(-(-size // BLOCK)))
                at = np.append(0, np.cumsum(counts))[of_doc]
                doc = batch["doc_id"].slice(first, n)
                tie = batch["tie"].slice(first, n)
                number = doc.fill_null(LEAST_ID).to_numpy()
                columns = [
                    pa.array(parts_of(number, tie.to_numpy(), ends), pa.int32()),
                    doc,
                    tie,
                    pa.array(size, pa.int32()),
                    slices(counts.astype("<i4"), of_doc),
                    slices(words.astype("<u8"), at),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names(ENCODED))

    def stripes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count, before, part = 0, 0, -1
        for batch in batches:
            for row in zip(*(batch[c].to_pylist() for c in ("part", "doc_id", "length", "counts", "words"))):
                if held and (row[0] != part or count >= STRIPE_IDS):
                    yield stripe(part, before, held)
                    before = before + count if row[0] == part else 0
                    held, count = [], 0
                part = row[0]
                held.append(row)
                count += row[2]
        if held:
            yield stripe(part, before, held)

    rows = texts(docs).withColumn("tie", F.xxhash64("text").bitwiseAND(F.lit((1 << 62) - 1)))
    dealt = rows.mapInArrow(encode, ENCODED).repartitionById(parts, F.col("part"))
    ordered = dealt.sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "tie")
    return staged(ordered.mapInArrow(stripes, STRIPE), "tokens")


def names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def slices(values: np.ndarray, at: np.ndarray) -> pa.Array:
    """values[at[0]:at[1]], values[at[1]:at[2]] and so on as bytes."""
    offsets = pa.py_buffer((at * values.itemsize).astype(np.int32))
    return pa.BinaryArray.from_buffers(pa.binary(), len(at) - 1, [None, offsets, pa.py_buffer(values)])


def stripe(part: int, first: int, rows: list[tuple]) -> pa.RecordBatch:
    """Documents that follow one another as one row."""
    _, doc_ids, lengths, counts, words = zip(*rows)
    offsets = np.cumsum(np.frombuffer(b"".join(counts), "<i4"))
    columns = [
        pa.array([part], pa.int32()),
        pa.array([first], pa.int64()),
        pa.array([doc_ids], pa.list_(pa.int64())),
        pa.array([lengths], pa.list_(pa.int32())),
        pa.array([np.append(0, offsets[:-1])], pa.list_(pa.int32())),
        pa.array([b"".join(words)], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=names(STRIPE))


def decoded(words: np.ndarray, offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All ids of a stripe."""
    return simple8b.decode(words, np.diff(offsets, append=len(words)), blocks_of(lengths))


def window(words: np.ndarray, offsets: np.ndarray, lengths: np.ndarray, document: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of one document of a stripe, from the blocks that hold them."""
    blocks = -(-lengths // BLOCK)
    base = int(blocks[:document].sum())
    a, b = start // BLOCK, -(-stop // BLOCK)
    some = blocks_of(lengths[document : document + 1])[a:b]
    edges = np.append(offsets, len(words))[base + a : base + b + 1]
    ids = simple8b.decode(words[edges[0] : edges[-1]], np.diff(edges), some)
    return ids[start - a * BLOCK : stop - a * BLOCK]


def read_tokens(stripes: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the written stripes.

    ``start`` counts the ids of all documents before: those of earlier parts (one number
    a part), of earlier stripes of the part, and of the stripe itself.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, firsts = batch["part"].to_pylist(), batch["first"].to_pylist()
            for i in range(len(batch)):
                lengths = batch["lengths"][i].values.to_numpy().astype(np.int64)
                words = np.frombuffer(batch["words"][i].as_buffer(), "<u8")
                ids = decoded(words, batch["offsets"][i].values.to_numpy().astype(np.int64), lengths).astype("<u4")
                ends = np.cumsum(lengths)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip([0, *ends.tolist()], ends.tolist())]
                columns = [
                    pa.array(np.full(len(ends), parts[i]), pa.int32()),
                    batch["doc_ids"][i].values,
                    pa.array(firsts[i] + ends - lengths, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "doc_id", "place", "n_tokens", "ids_crc32"])

    sizes = stripes.groupBy("part").agg(F.sum(_sum("lengths")).alias("ids"))
    before = sizes.select("part", (F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).alias("base"))
    rows = stripes.mapInArrow(read, "part int, doc_id long, place long, n_tokens long, ids_crc32 long")
    return rows.join(before, "part").select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def _sum(array: str) -> Column:
    return F.aggregate(array, F.lit(0).cast("long"), lambda a, x: a + x)

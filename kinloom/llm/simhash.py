"""SimHash near-duplicates, found exactly with vantage-point trees."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinloom.llm.common import texts
from kinloom.llm.components import connected, local_labels
from kinloom.session import staged

CHUNK = 1 << 16


def fingerprint(text: str, words: int = 4) -> int:
    """64-bit SimHash: a bit is set if it is in over half the shingle hashes; 0 without words."""
    import xxhash

    tokens = text.encode("utf-8", "replace").lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(1, len(tokens) - words + 1)
    starts, ends = starts[:n].tolist(), ends[-n:].tolist()
    one, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, CHUNK):
        counts += bit_counts(np.fromiter((one(joined[s:e], 42) for s, e in zip(starts[at : at + CHUNK], ends[at : at + CHUNK])), np.uint64))
    return of_counts(counts, n)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """In how many of ``hashes`` each bit is set."""
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)


def of_counts(counts: np.ndarray, n: int) -> int:
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """``doc_id, fp``: the fingerprint's 64 bits as a long."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = np.fromiter((fingerprint(t, words) for t in batch["text"]), np.uint64, len(batch))
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "fp": found.view(np.int64)})

    return texts(docs).mapInPandas(scan, "doc_id long, fp long")


class Node:
    """A vantage point: points within ``radius`` lie inside, the others outside."""

    def __init__(self, point: np.uint64, radius: int, inside, outside):
        self.point, self.radius, self.inside, self.outside = point, radius, inside, outside


def distances(points: np.ndarray, to: np.uint64) -> np.ndarray:
    return np.bitwise_count(points ^ to).astype(np.int16)


def shard_tree(sample: np.ndarray, depth: int):
    """A tree of ``depth`` levels over a sample; leaves are shard numbers from left to right.

    Of a few candidates the vantage point with the widest spread of distances is taken.
    """
    shards = iter(range(1 << depth))

    def grow(points: np.ndarray, level: int):
        if level == 0:
            return next(shards)
        if not len(points):
            return Node(np.uint64(0), 32, grow(points, level - 1), grow(points, level - 1))
        point = max(points[:: max(1, len(points) // 16)], key=lambda p: distances(points, p).std())
        d = distances(points, point)
        radius = int(np.median(d))
        return Node(point, radius, grow(points[d <= radius], level - 1), grow(points[d > radius], level - 1))

    return grow(sample, depth)


def routes(node, points: np.ndarray, bits: int, at: np.ndarray, home: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, indexes, whether each lives there) for every shard a ball of ``bits`` reaches."""
    if not len(at):
        return
    if isinstance(node, int):
        yield node, at, home
        return
    d = distances(points[at], node.point)
    near, far = d <= node.radius + bits, d > node.radius - bits
    yield from routes(node.inside, points, bits, at[near], home[near] & (d <= node.radius)[near])
    yield from routes(node.outside, points, bits, at[far], home[far] & (d > node.radius)[far])


def near_labels(points: np.ndarray, home: np.ndarray, bits: int, leaf: int = 256) -> np.ndarray:
    """For each row of a shard the first row it can reach over links to rows that live here.

    The shard's own tree is searched for all rows at once: the rows that live in it are
    split at the median distance from a vantage point, and the queries go down each side
    that the triangle inequality leaves open. Links are merged into labels as they are
    found, so memory follows the rows and not the links.
    """
    labels = np.arange(len(points))
    us, vs, held = [], [], 0

    def merge() -> None:
        nonlocal labels, us, vs, held
        own = np.arange(len(points))
        labels = local_labels(len(points), np.concatenate([*us, own]), np.concatenate([*vs, labels]))
        us, vs, held = [], [], 0

    stack = [(np.flatnonzero(home), np.arange(len(points)))]
    while stack:
        data, queries = stack.pop()
        if not len(data) or not len(queries):
            continue
        d = None
        if len(data) > leaf:
            point = points[data[len(data) // 2]]
            d = distances(points[data], point)
            radius = int(np.median(d))
            if (d > radius).any():
                q = distances(points[queries], point)
                stack.append((data[d <= radius], queries[q <= radius + bits]))
                stack.append((data[d > radius], queries[q > radius - bits]))
                continue
            if int(d.min()) < radius:  # the median is the largest distance: split below it
                q = distances(points[queries], point)
                stack.append((data[d < radius], queries[q < radius + bits]))
                stack.append((data[d == radius], queries[(q <= radius + bits) & (q >= radius - bits)]))
                continue
        for b in range(0, len(data), 1024):
            block = data[b : b + 1024]
            for a in range(0, len(queries), 1024):
                some = queries[a : a + 1024]
                i, j = np.nonzero(np.bitwise_count(points[some][:, None] ^ points[block][None, :]) <= bits)
                u, v = some[i], block[j]
                new = labels[u] != labels[v]
                if new.any():
                    us.append(u[new])
                    vs.append(v[new])
                    held += int(new.sum())
                    if held > 500_000:
                        merge()
    merge()
    return labels


def fingerprint_links(points: DataFrame, bits: int = 4, shard_rows: int = 16_384, sample_rows: int = 4_096) -> DataFrame:
    """Edges ``a, b`` that join all of ``points (fp)`` within ``bits`` bits, and no others' groups.

    A tree of vantage points is fitted to ``sample_rows`` fingerprints (a fixed number)
    and has a leaf, a shard, for every ``shard_rows`` of them, a quarter of the sample at
    most. Each fingerprint lives in
    one shard and asks every later shard that a ball of ``bits`` around it touches; two
    near fingerprints always meet. A shard gives a star for each group it finds, so a
    group of any size costs as many edges as it has members.
    """
    spark = points.sparkSession
    n = points.count()
    if n < 2:
        return points.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    sample = points.orderBy(F.xxhash64("fp"), "fp").limit(sample_rows).toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    depth = max(0, int(np.ceil(np.log2(n / shard_rows)))) if n > shard_rows else 0
    depth = max(depth, 3 if n > 4 * sample_rows else 0)
    # A vantage point needs a few of the sample to find its median; beyond that shards grow.
    depth = min(depth, int(np.log2(max(1, len(sample)) / 4))) if len(sample) >= 4 else 0
    tree = spark.sparkContext.broadcast(shard_tree(sample, depth))

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            fp = batch["fp"].to_numpy(np.int64)
            own = fp.view(np.uint64)
            every = np.arange(len(fp))
            parts = list(routes(tree.value, own, bits, every, np.ones(len(fp), bool)))
            lives = np.zeros(len(fp), np.int64)
            for shard, at, home in parts:
                lives[at[home]] = shard
            for shard, at, home in parts:
                keep = home | (lives[at] < shard)
                yield pd.DataFrame({"shard": shard, "fp": fp[at[keep]], "home": home[keep]})

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        fp = rows["fp"].to_numpy(np.int64)
        labels = near_labels(fp.view(np.uint64), rows["home"].to_numpy(bool), bits)
        linked = labels != np.arange(len(fp))
        return pd.DataFrame({"a": fp[linked], "b": fp[labels[linked]]})

    routed = points.select("fp").mapInPandas(route, "shard int, fp long, home boolean")
    return routed.groupBy("shard").applyInPandas(search, "a long, b long")


def fingerprint_pairs(points: DataFrame, bits: int = 4) -> DataFrame:
    """``a, b, size, size2``: the candidates that fingerprints give, for ``points (node, size, fp)``.

    Every link of ``fingerprint_links`` joins two fingerprints, the first set of each, and
    every other set of a fingerprint is held against the first: a row for each link and set.
    """
    point = F.struct("node", "size")
    first = staged(points.groupBy("fp").agg(F.min(point).alias("m")), "firsts")
    links = fingerprint_links(first.select("fp"), bits).distinct()
    far = links.join(first.toDF("a", "p"), "a").join(first.toDF("b", "q"), "b").select("p", "q")
    same = points.join(first, "fp").select(point.alias("p"), F.col("m").alias("q")).where("p.node <> q.node")
    both = far.unionByName(same).where("p.node <> q.node")
    return both.select(F.col("p.node").alias("a"), F.col("q.node").alias("b"), F.col("p.size").alias("size"), F.col("q.size").alias("size2"))


def verified_groups(points: DataFrame, verified: Callable[[DataFrame], DataFrame], bits: int = 4) -> tuple[DataFrame, DataFrame]:
    """Links ``a, b`` that ``verified`` leaves of the ``fingerprint_pairs``, and ``node, label`` of their components."""
    links = staged(verified(fingerprint_pairs(points, bits)), "simhash")
    return links, staged(connected(links), "labels")


def simhash_groups(docs: DataFrame, words: int = 4, bits: int = 4) -> DataFrame:
    """``doc_id, fp, component_id``: fingerprints within ``bits`` bits link, links chain.

    ``component_id`` is the smallest doc_id that can be reached, the document's own
    included. A null text is empty; a text without words has the fingerprint 0 and is
    linked like any other. Rows with a repeated doc_id each give a row; a null doc_id is
    never the smallest, and a component of such rows alone has a null component_id.
    Equal fingerprints are one point of the search.
    """
    found = staged(fingerprints(docs, words), "fingerprints")
    points = staged(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "points")
    labels = connected(fingerprint_links(points, bits))
    joined = points.join(labels.withColumnRenamed("node", "fp"), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    joined = staged(joined, "labels")
    least = joined.groupBy("label").agg(F.min("least").alias("component_id"))
    classes = joined.join(least, "label").select("fp", "component_id")
    return found.join(classes, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, words: int = 4, bits: int = 4) -> DataFrame:
    """One row of ``docs`` of each group of near duplicates: that with the smallest doc_id.

    Documents whose doc_id is null are kept; of rows that repeat a doc_id all are kept
    or none.
    """
    names = docs.columns
    groups = simhash_groups(docs, words, bits).where("doc_id <> component_id").select(F.col("doc_id").alias("_id_that_goes")).distinct()
    return docs.join(groups, F.col("doc_id") == F.col("_id_that_goes"), "left_anti").select(*names)

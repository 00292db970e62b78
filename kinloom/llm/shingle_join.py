"""Texts whose sets of shingles are alike: SimHash first, then exactly by their rarest shingles.

The fingerprints of the sets are searched by the vantage-point trees of ``simhash``, and what
they bring together is verified on the whole sets. Fingerprints of texts that are alike may be
far apart, so an exact search for the links between what is still in different groups
follows. Of two sets with a Jaccard similarity of t or more, each with its shingles in one and the
same order, the first ``n - ceil(t * n) + 1`` shingles have one in common. Only those
become keys, rare ones first, and what meets under a key is verified on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kinloom.llm.common import texts
from kinloom.llm.components import connected
from kinloom.llm.simhash import CHUNK, bit_counts, of_counts, verified_groups
from kinloom.session import passing, staged

NEAR = 1e-9  # rounding of the similarity


def shingles(text: str, words: int = 5) -> np.ndarray:
    """Sorted different hashes of the text's runs of ``words`` words; a shorter text is one run."""
    import xxhash

    tokens = text.encode("utf-8", "replace").lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    joined = b" ".join(tokens)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    n = max(1, len(tokens) - words + 1)
    starts, ends = (ends - lengths)[:n].tolist(), ends[-n:].tolist()
    one = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((one(joined[s:e], 42) for s, e in zip(starts, ends)), np.uint64, n))


def name_of(found: np.ndarray) -> int:
    """A set's name: equal sets have one, and are one point of the search."""
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), 7)).view(np.int64))


def set_fingerprint(found: np.ndarray) -> int:
    """The 64-bit SimHash of a set of shingles, as ``simhash.fingerprint`` has it for a list; 0 for none."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(found), CHUNK):
        counts += bit_counts(found[at : at + CHUNK])
    return of_counts(counts, len(found))


def common_shingles(docs: DataFrame, words: int, sample_rows: int = 4_096, every: int = 16, most: int = 1 << 18) -> np.ndarray:
    """The shingles that most of a sample of rows have, the most common last; they only set the order of keys.

    The sample has ``sample_rows`` rows, and of many rows each in ``every``: of a sample of
    fixed size the shingles it misses would be in ever more texts, and their pairs grow
    with the square of that.
    """
    share = min(max(1, docs.count() // sample_rows), every)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text in batch["text"]:
                yield pd.DataFrame({"s": shingles(text, words).view(np.int64)})

    some = texts(docs).where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(share)) == 0)
    counts = some.mapInPandas(scan, "s long").groupBy("s").count().where("count > 1")
    return counts.orderBy(F.col("count").desc(), "s").limit(most).toPandas()["s"].to_numpy(np.int64)[::-1].view(np.uint64)


def first_shingles(found: np.ndarray, similarity: float, common: np.ndarray, places: np.ndarray) -> np.ndarray:
    """The keys of a set. ``common`` is sorted, ``places`` their places in the order, 1 and up."""
    place = np.zeros(len(found), np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
        place = np.where(common[at] == found, places[at], 0)
    n = len(found) - int(np.ceil(similarity * len(found) - NEAR)) + 1 if len(found) else 0
    return found[np.lexsort((found, place))[:n]]


def alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both) - NEAR


def distinct_keys(rows: DataFrame) -> DataFrame:
    """``key, node, size, w`` of ``rows (key, node, size)``: of keys that the same nodes hold one, ``w`` says for how many.

    Texts that share a passage hold all its shingles, so their pairs would be made once for
    each. Nodes are compared by their number and two hashes of 64 bits, xored.
    """
    marks = [F.bit_xor(F.xxhash64("node", F.lit(seed))).alias(f"mark{seed}") for seed in range(2)]
    same = rows.groupBy("key").agg(F.count("*").alias("n"), *marks).groupBy("n", "mark0", "mark1")
    return rows.join(same.agg(F.min("key").alias("key"), F.count("*").alias("w")).select("key", "w"), "key").select("key", "node", "size", "w")


def shingle_groups(docs: DataFrame, words: int = 5, similarity: float = 0.8, direct: int = 1_000_000, bits: int = 4) -> DataFrame:
    """``doc_id, component_id``: texts with that Jaccard similarity of shingles or more link, links chain.

    ``component_id`` is the smallest doc_id that can be reached, as in ``simhash_groups``;
    texts without words are alike. No pair is lost and none is linked unverified, up to
    equal 64-bit hashes. Fingerprints within ``bits`` bits give the first candidates, and only
    what these leave in different groups is searched by keys. There stars come first where there are more than ``direct`` pairs and 8
    for each member of a key: every text goes under one of its keys, another one in each
    round, and is held against one text of those under it. So a large group of near copies
    costs a row for each of them in a round and not one for each of their keys. What is
    still in different groups is then held against each other.
    """
    spark = docs.sparkSession
    with passing(spark):
        listed = common_shingles(docs, words)
        by_hash = np.argsort(listed)
        order = spark.sparkContext.broadcast((listed[by_hash], by_hash + 1))

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                sets = [shingles(t, words) for t in batch["text"]]
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].astype("Int64"),
                    "t": batch["t"],
                    "node": np.array([name_of(s) for s in sets], np.int64),
                    "size": np.array([len(s) for s in sets], np.int64),
                    "fp": np.array([set_fingerprint(s) for s in sets], np.uint64).view(np.int64),
                    "keys": [first_shingles(s, similarity, *order.value).view(np.int64) for s in sets],
                })

        keyed = texts(docs).withColumn("t", F.xxhash64("text"))
        found = staged(keyed.mapInPandas(scan, "doc_id long, t long, node long, size long, fp long, keys array<long>"), "shingles", lasting=True)
        points = found.groupBy("node").agg(
            F.min("doc_id").alias("least"),
            F.max(F.struct("doc_id", "t")).alias("row"),
            F.first("size").cast("int").alias("size"),
            F.first("fp").alias("fp"),
        )
        points = staged(points, "points", lasting=True)
        one = found.dropDuplicates(["node"]).select("node", F.col("size").cast("int").alias("size"), F.explode("keys").alias("key"))
        under = Window.partitionBy("key")
        met = one.withColumns({"_lo": F.min("node").over(under), "_hi": F.max("node").over(under)}).where("_lo <> _hi")
        rows = staged(met.select("key", "node", "size"), "keys")

        def to_sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                sets = [shingles(t, words) for t in batch["text"]]
                yield pd.DataFrame({"node": np.array([name_of(s) for s in sets], np.int64), "s": [s.tobytes() for s in sets]})

        def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                both = zip(batch["s"], batch["s2"], strict=True)
                ok = [alike(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), similarity) for a, b in both]
                yield batch.loc[np.array(ok, bool), ["a", "b"]]

        def many(met: DataFrame) -> DataFrame:
            """Of ``a, b, size, size2, w``, a row for each key the two share, the pairs that may be alike.

            Up to the earlier end of their keys all they have in common is a shared key (``w``
            of them a row); what comes after it is at most the rest of that set,
            ``ceil(similarity * size) - 1``.
            """
            rest = F.ceil(similarity * F.greatest("size", "size2") - NEAR) - 1
            enough = similarity / (1 + similarity) * (F.col("size") + F.col("size2")) - NEAR
            return met.groupBy("a", "b", "size", "size2").agg(F.sum("w").alias("count")).where(F.col("count") + rest >= enough)

        def verified(near: DataFrame) -> DataFrame:
            """Those of the pairs ``a, b`` that are alike."""
            pairs = staged(near.select("a", "b"), "pairs")
            nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
            wanted = points.join(nodes, "node", "left_semi").select("row.*").toDF("_id", "_t")
            chosen = keyed.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("t") == F.col("_t")), "left_semi")
            chosen = chosen.dropDuplicates(["doc_id", "t"]).select("text")
            sets = staged(chosen.mapInPandas(to_sets, "node long, s binary"), "sets")
            both = pairs.join(sets.withColumnRenamed("node", "a"), "a").join(sets.toDF("b", "s2"), "b")
            return both.select("a", "b", "s", "s2").mapInPandas(verify, "a long, b long")

        def sized(size, size2):
            return F.least(size, size2) >= similarity * F.greatest(size, size2) - NEAR

        def of_fingerprints(met: DataFrame) -> DataFrame:
            return verified(met.where(sized(F.col("size"), F.col("size2"))))

        links, labels = verified_groups(points.select("node", "size", "fp"), of_fingerprints, bits)
        key_and_weight = F.struct("key", "w")
        held = staged(distinct_keys(rows).groupBy("node", "size").agg(F.collect_list(key_and_weight).alias("keys")), "held")
        for seed in range(8):
            with passing(spark):
                known = held.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
                own = known.select("node", "size", "label", F.inline("keys"))
                # Pairs of members of different groups under a key, each of them once.
                per = own.groupBy("key", "label").agg(F.count("*").alias("n")).groupBy("key")
                per = per.agg((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))).alias("open")).where("open > 0")
                # A key's number of open pairs goes with its members, so that they can be added up afterwards.
                with_open = own.join(per, "key").select("node", "size", "label", "key", "w", (F.col("open") / 2).alias("open"))
                open_ = staged(with_open, "open", lasting=True)
                left = open_.groupBy("key").agg(F.max("open").alias("open")).agg(F.sum("open")).first()[0] or 0.0
                if left <= max(8 * open_.count(), direct):
                    break
                one_key = F.min_by("key", F.xxhash64("key", F.lit(seed))).alias("key")
                picked = staged(open_.groupBy("node", "size", "label").agg(one_key), "picked")
                star = picked.groupBy("key").agg(F.min_by(F.struct("node", "size", "label"), F.xxhash64("node", F.lit(seed))).alias("m"))
                pairs = picked.join(star, "key").where((F.col("label") != F.col("m.label")) & sized(F.col("size"), F.col("m.size")))
                pairs = pairs.select(F.col("node").alias("a"), F.col("m.node").alias("b"), "size", F.col("m.size").alias("size2"))
                # Each text is in one pair, so this is a row for each of its keys at most.
                keys_of_a, keys_of_b = open_.select(F.col("node").alias("a"), "key", "w"), open_.select(F.col("node").alias("b"), "key")
                shared = pairs.join(keys_of_a, "a").join(keys_of_b, ["b", "key"])
                new = staged(verified(many(shared)), "stars", lasting=True)
                links = links.unionByName(new)
            with passing(spark):
                labels = staged(connected(links), "labels", lasting=True)
        a, b = open_.alias("a"), open_.alias("b")
        unlike = (F.col("a.node") < F.col("b.node")) & (F.col("a.label") != F.col("b.label"))
        fits = sized(F.col("a.size"), F.col("b.size"))
        rest = a.join(b, (F.col("a.key") == F.col("b.key")) & unlike & fits)
        rest = rest.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"), F.col("a.size").alias("size"), F.col("b.size").alias("size2"), "a.w")
        new = verified(many(rest))
        labels = connected(links.unionByName(new))

        joined = points.select("node", "least").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        joined = staged(joined.select("node", "least", "label"), "labels", lasting=True)
    least = joined.groupBy("label").agg(F.min("least").alias("component_id"))
    return found.select("doc_id", "node").join(joined.join(least, "label").select("node", "component_id"), "node").select("doc_id", "component_id")


def keep_one_alike(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row of ``docs`` of each group of texts that are alike: that with the smallest doc_id.

    Rows with a null or a repeated doc_id are treated as by ``simhash.keep_one``.
    """
    names = docs.columns
    gone = shingle_groups(docs, words, similarity).where("doc_id <> component_id").select(F.col("doc_id").alias("_id_that_goes")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("_id_that_goes"), "left_anti").select(*names)

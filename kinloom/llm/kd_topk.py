"""Exact top-k inner products with a KD-tree per shard."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from kinloom.session import staged
from kinloom.llm.vectors import SQL, finite, matrix

HIT = T.StructType([T.StructField(n, T.LongType()) for n in ("query_row", "query_id", "vec_id", "score")])
#: Lower than any score.
NONE = -(1 << 62)


class KDTree:
    """Median splits along the widest side; every node has the tight box of its rows.

    Rows are kept in leaf order, so a node is a range of rows. Nodes are in the order of
    a heap: those below node i are 2i+1 and 2i+2.
    """

    def __init__(self, ids: np.ndarray, keys: np.ndarray, rows: np.ndarray, leaf: int = 128):
        # Doubles are exact (and faster) while all sums stay below 2**53.
        self.exact = float(np.abs(rows).max(initial=0)) ** 2 * rows.shape[1] < 1 << 50
        depth = max(0, int(np.ceil(np.log2(max(1, len(rows)) / leaf))))
        order = np.argsort(ids, kind="stable")
        self.first_leaf = (1 << depth) - 1
        n = 2 * self.first_leaf + 1
        self.ranges = np.zeros((n, 2), np.int64)
        self.low, self.high = np.zeros((n, rows.shape[1])), np.zeros((n, rows.shape[1]))
        self.ranges[0] = 0, len(rows)
        for node in range(n):
            a, b = self.ranges[node]
            if a == b:
                continue
            own = rows[order[a:b]]
            self.low[node], self.high[node] = own.min(0), own.max(0)
            if node < self.first_leaf:
                middle = (b - a) // 2
                axis = int((self.high[node] - self.low[node]).argmax()) if rows.shape[1] else 0
                if rows.shape[1]:
                    order[a:b] = order[a:b][np.argpartition(own[:, axis], middle)]
                self.ranges[2 * node + 1], self.ranges[2 * node + 2] = (a, a + middle), (a + middle, b)
        self.ids, self.keys, self.rows = ids[order], keys[order], rows[order].astype(np.float64 if self.exact else np.int64)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The greatest inner product each query can have with anything in each node's box."""
        most = np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T
        # Above all rounding, which hangs on the terms and not on what is left of them.
        terms = np.abs(queries) @ np.maximum(np.abs(self.high), np.abs(self.low)).T
        return most + terms * (queries.shape[1] + 2) * 2.0**-52 + 1

    def search(self, bounds: np.ndarray, query: np.ndarray, own: int, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Best first: ids and scores of the k best rows that score ``least`` or more.

        Ends at a node whose bound is below the kth score. A node that can only tie is
        still opened, because a tie goes to the smaller id. ``own`` is the query's own row.
        """
        queue, ids, scores = [(-bounds[0], 0)], np.empty(0, np.int64), np.empty(0, np.int64)
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < least:
                break
            if node < self.first_leaf:
                for child in (2 * node + 1, 2 * node + 2):
                    if bounds[child] >= least and self.ranges[child, 0] < self.ranges[child, 1]:
                        heapq.heappush(queue, (-bounds[child], child))
                continue
            a, b = self.ranges[node]
            got = (self.rows[a:b] @ query).astype(np.int64)
            new = (got >= least) & (self.keys[a:b] != own)
            ids, scores = np.concatenate([ids, self.ids[a:b][new]]), np.concatenate([scores, got[new]])
            if len(ids) >= k:
                best = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[best], scores[best]
                least = max(least, int(scores[-1]))
        return ids, scores


def _search(rows: pd.DataFrame, asked: pd.DataFrame, k: int) -> pd.DataFrame:
    found = []
    if len(rows) and len(asked):
        width = max(len(v) for v in (*rows["v"], *asked["q"]))
        tree = KDTree(rows["vec_id"].to_numpy(np.int64), rows["row"].to_numpy(np.int64), matrix(rows["v"], width).astype(np.int64))
        queries = matrix(asked["q"], width).astype(np.int64)
        tree.exact &= float(np.abs(queries).max(initial=0)) ** 2 * width < 1 << 50
        tree.rows = tree.rows.astype(np.float64 if tree.exact else np.int64)
        for at in range(0, len(queries), 512):
            bounds = tree.bounds(queries[at : at + 512])
            for i, one in enumerate(queries[at : at + 512], at):
                own, least = int(asked["query_row"].iat[i]), int(asked["least"].iat[i])
                one = one.astype(tree.rows.dtype)
                ids, scores = tree.search(bounds[i - at], one, own, k, least)
                found.append(pd.DataFrame({"query_row": own, "query_id": asked["query_id"].iat[i], "vec_id": ids, "score": scores}))
    return pd.concat(found) if found else pd.DataFrame({f.name: np.empty(0, np.int64) for f in HIT})


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, shard_rows: int = 8_192, block_rows: int = 4_096
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows for each row that ``is_query`` marks.

    ``vectors`` has ``vec_id, embedding``; other columns may be used by ``is_query``
    alone. A component x counts as floor(scale * x); the score is the inner product of
    those integers, ties go to the smaller vec_id, and a query's own row is no answer.
    Rows with a null id, a null vector or a component that is null or not finite take no
    part, nor do those of which a scaled component is so large that a sum of as many
    products as the longest vector has might not fit a long (at 64 components, one of 268
    million; a score must be a long). Rows that repeat a vec_id with another vector are
    rows of their own, as queries and as answers; of equal rows one counts. A shorter
    vector is filled up with zeros.

    Rows are dealt into shards of about ``shard_rows``, each with its KD-tree. A query
    first searches its own shard; the kth score it finds there goes with it to all other
    shards and closes most of them early. Queries travel in blocks of ``block_rows``, so
    a task holds one shard and one block whatever the size of the table.
    """
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    good = vectors.where(F.col("vec_id").isNotNull() & finite(F.col("embedding")))
    width = good.agg(F.max(F.size("embedding"))).first()[0] or 1
    limit = math.isqrt((1 << 62) // width)
    good = good.where(F.forall("embedding", lambda x: F.abs(x.cast("double") * scale) < limit))
    marked = good.select(F.col("vec_id").cast("long").alias("vec_id"), scaled.alias("v"), is_query.alias("asked"))
    different = marked.groupBy("vec_id", "v").agg(F.max("asked").alias("asked"))
    rows = staged(different.withColumn("row", F.monotonically_increasing_id()), "vectors")
    n, n_queries = rows.select(F.count("*"), F.count_if("asked")).first()
    shards, blocks = max(1, -(-n // shard_rows)), max(1, -(-n_queries // block_rows))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))

    def first(r: pd.DataFrame) -> pd.DataFrame:
        return _search(r, r[r["asked"]].rename(columns={"vec_id": "query_id", "row": "query_row", "v": "q"}).assign(least=NONE), k)

    def other(r: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        return _search(r, q, k)

    home = staged(rows.groupBy("shard").applyInPandas(first, HIT), "home")
    # A query that found fewer than k rows at home has no bound yet.
    kth = home.groupBy("query_row").agg(F.when(F.count("*") >= k, F.min("score")).alias("least"))
    asked = rows.where("asked").select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.col("shard").alias("own"))
    known = asked.join(kth, "query_row", "left").withColumn("least", F.coalesce("least", F.lit(NONE).cast("long")))
    block = F.pmod(F.xxhash64("query_row", F.lit(1)), F.lit(blocks)).cast("int")
    ask = known.withColumn("block", block).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    ask = ask.where("shard <> own").select("shard", "block", "query_row", "query_id", "q", "least")
    held = rows.select("shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "row", "vec_id", "v")
    others = (
        held.groupBy("shard", "block")
        .cogroup(ask.groupBy("shard", "block"))
        .applyInPandas(other, HIT)
    )
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    best = home.union(others).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def oracle(every: int = 50, k: int = 5, scale: int = 256) -> str:
    """The same rows by DuckDB, every pair measured."""
    return f"""WITH {SQL}, i AS (SELECT vec_id, list_transform(e, lambda x: floor({scale} * x)) AS e FROM v),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM i q JOIN i c ON q.vec_id <> c.vec_id WHERE q.vec_id % {every} = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM p QUALIFY rank <= {k}"""

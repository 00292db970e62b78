"""Embedding near-duplicates by hashing to the E8 lattice."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinloom.session import staged
from kinloom.llm.components import connected
from kinloom.llm.vectors import SQL, finite

#: The 240 shortest vectors of E8, all of length sqrt(2): the neighbouring cells.
NEIGHBOURS = np.array(
    [
        [s if k == i else t if k == j else 0 for k in range(8)]
        for i, j in combinations(range(8), 2)
        for s, t in product((1, -1), repeat=2)
    ]
    + [signs for signs in product((0.5, -0.5), repeat=8) if signs.count(-0.5) % 2 == 0]
)


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum."""
    point = np.rint(x)
    odd = np.flatnonzero(point.sum(1) % 2)
    off = x[odd] - point[odd]
    worst = np.abs(off).argmax(1)
    point[odd, worst] += np.where(off[np.arange(len(odd)), worst] < 0, -1, 1)
    return point


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8: even integer points, or those moved by one half in all places."""
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(1) < ((x - whole) ** 2).sum(1)
    return np.where(closer[:, None], half, whole)


def cells(units: np.ndarray, table: int, scale: float, probes: int, seed: int) -> np.ndarray:
    """For each row the key of its lattice cell and of the ``probes`` nearest neighbouring ones."""
    random = np.random.default_rng([seed, table, units.shape[1]])
    x = units @ random.standard_normal((units.shape[1], 8)) * scale
    point = nearest_e8(x)
    near = np.argpartition(-((x - point) @ NEIGHBOURS.T), min(probes, 239), axis=1)[:, :probes]
    points = np.concatenate([point[:, None, :], point[:, None, :] + NEIGHBOURS[near]], axis=1)
    mix = random.integers(1, 1 << 62, 8, dtype=np.int64) * 2 + 1
    with np.errstate(over="ignore"):
        return ((2 * points).astype(np.int64) * mix).sum(2) + table


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.95,
    tables: int = 5,
    probes: int = 8,
    scale: float = 0.9,
    cell_rows: int = 16_384,
    seed: int = 7,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors (vec_id, embedding)``.

    Two rows link if their cosine in double precision is at least ``threshold`` and the
    index brings them together; none below it link. ``n_links`` counts the other rows
    linked directly, ``component_id`` is the smallest vec_id that can be reached, and a
    row is kept if that is its own. Null and zero vectors and those with a component
    that is null or not finite link with nothing, nor do vectors of different lengths.
    A row that repeats a vec_id counts as another vector. A null vec_id is never the
    smallest; such a row is kept only if nothing it reaches has an id.

    Equal vectors are one class. In each of ``tables`` tables a random projection to
    eight dimensions is decoded to its E8 point; a class is filed under that cell and
    asks it and the ``probes`` neighbours nearest to the projection. Only a byte per
    component travels: what is near in that form is verified with the whole vectors.
    A cell with over ``cell_rows`` rows is searched as blocks against blocks by several
    tasks, so all its pairs are still seen; small cells share a task.
    """
    as_double = F.transform("embedding", lambda x: x.cast("double")).alias("v")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), as_double)
    zero = F.forall("v", lambda x: x == 0)
    rows = rows.withColumn("v", F.when(finite(F.col("v")) & ~zero, F.col("v")))
    classes = rows.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("least"), F.count("*").alias("size"))
    classes = staged(classes.withColumn("class", F.monotonically_increasing_id()), "classes")

    def file(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for width, same in batch.groupby(batch["v"].map(len)):
                v = np.stack(same["v"].to_list())
                v = v / np.abs(v).max(1, keepdims=True)  # squares neither overflow nor vanish
                units = v / np.linalg.norm(v, axis=1, keepdims=True)
                peak = np.abs(units).max(1, keepdims=True)
                short = [x.tobytes() for x in np.rint(units / peak * 127).astype(np.int8)]
                number = same["class"].to_numpy()
                for table in range(tables):
                    keys = cells(units, table, scale, probes, seed)
                    yield pd.DataFrame(
                        {
                            "cell": keys.T.ravel(),
                            "home": np.repeat([True] + [False] * probes, len(same)),
                            "class": np.tile(number, probes + 1),
                            "short": short * (probes + 1),
                        }
                    )

    filed = classes.select("class", "v").mapInPandas(file, "cell long, home boolean, class long, short binary")
    filed = staged(filed, "cells")
    large = filed.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > cell_rows)
    large = large.select("cell", F.ceil(F.col("n") / cell_rows).cast("int").alias("blocks"))
    dealt = filed.join(large, "cell", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    # A row that lives here sits in one block and meets all blocks of those that ask;
    # a row that asks (one that lives here asks, too) does the same the other way round.
    lives = dealt.where("home").select("cell", own.alias("i"), F.explode(every).alias("j"), F.lit(True).alias("home"), "class", "short")
    asks = dealt.select("cell", F.explode(every).alias("i"), own.alias("j"), F.lit(False).alias("home"), "class", "short")

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        pairs = [np.empty((2, 0), np.int64)]
        group = group.sort_values(["cell", "i", "j", "class"], kind="stable")
        keys = group[["cell", "i", "j"]].to_numpy()
        starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)])
        home, number, short = group["home"].to_numpy(), group["class"].to_numpy(), group["short"].to_numpy()
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(group)]):
            lives = home[start:end]
            if not lives.any() or end - start - lives.sum() < 2:  # its own question at most
                continue
            for width in {len(x) for x in short[start:end]}:
                same = np.array([len(x) == width for x in short[start:end]])
                codes = np.stack([np.frombuffer(x, np.int8) for x in short[start:end][same]]).astype(np.float32)
                norm = np.linalg.norm(codes, axis=1, keepdims=True)
                codes, slip = codes / norm, (0.55 * np.sqrt(width) / norm)[:, 0]
                at, named = lives[same], number[start:end][same]
                asked, least = codes[~at], threshold - slip[~at] - slip.max()
                for a in range(0, len(asked), 512):
                    i, j = np.nonzero(asked[a : a + 512] @ codes[at].T >= least[a : a + 512, None])
                    x, y = named[~at][a : a + 512][i], named[at][j]
                    new = x != y
                    pairs.append(np.sort(np.stack([x[new], y[new]]), axis=0))
        a, b = np.unique(np.concatenate(pairs, axis=1), axis=1)
        return pd.DataFrame({"a": a, "b": b})

    groups = max(1, -(-filed.count() // 100_000))
    met = lives.unionByName(asks).withColumn("g", F.pmod(F.xxhash64("cell", "i", "j"), F.lit(groups)))
    pairs = met.groupBy("g").applyInPandas(meet, "a long, b long").distinct()
    # Squares of very large or small components leave the range of doubles.
    peak = F.array_max(F.transform("v", lambda x: F.abs(x)))
    tame = classes.withColumn("v", F.when(peak.between(1e-100, 1e100), F.col("v")).otherwise(F.transform("v", lambda x: x / peak)))
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    side = tame.select("class", "v", F.sqrt(norm).alias("norm"), "size")
    left, right = ([F.col(c).alias(f"{c}_{s}") for c in side.columns] for s in "ab")
    dot = F.aggregate(F.zip_with("v_a", "v_b", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    both = pairs.join(side.select(*left), F.col("a") == F.col("class_a")).join(side.select(*right), F.col("b") == F.col("class_b"))
    links = both.where(dot / (F.col("norm_a") * F.col("norm_b")) >= threshold).select("a", "b", "size_a", "size_b")
    links = staged(links, "links")

    ends = links.select("a", F.col("size_b").alias("n")).union(links.select("b", F.col("size_a").alias("n")))
    near = ends.groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("near"))
    labels = connected(links.select("a", "b")).withColumnRenamed("node", "class")
    joined = classes.join(near, "class", "left").join(labels, "class", "left").withColumn("label", F.coalesce("label", "class"))
    joined = staged(joined.select("v", "least", "size", "label", F.coalesce("near", F.lit(0)).alias("near")), "joined")
    least = joined.groupBy("label").agg(F.min("least").alias("component_id"))
    found = joined.join(least, "label").select("v", "component_id", (F.col("size") - 1 + F.col("near")).alias("n_links"))
    own_id = F.when(F.col("v").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return rows.join(found, "v", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        own_id.alias("component_id"),
        F.col("vec_id").eqNullSafe(own_id).alias("kept"),
    )


def oracle(threshold: float = 0.95) -> str:
    """The same rows by DuckDB, every pair measured."""
    return f"""WITH RECURSIVE {SQL},
n AS (SELECT vec_id, e FROM v WHERE list_inner_product(e, e) > 0),
l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM n a JOIN n b
  ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= {threshold}),
r AS (SELECT vec_id, vec_id AS c FROM embeddings UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.vec_id)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept
  FROM (SELECT vec_id, min(c) AS component_id FROM r GROUP BY vec_id)
  LEFT JOIN (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a) USING (vec_id)"""

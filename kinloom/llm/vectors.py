"""Rows of an embeddings table as arrays."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """Whether a vector is present and each of its components is a finite number."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good, F.lit(False))


def matrix(vectors: pd.Series, width: int = 0) -> np.ndarray:
    """One row per vector, shorter ones filled up with zeros."""
    width = max([width, *map(len, vectors)])
    if len(vectors) and all(len(v) == width for v in vectors):
        return np.stack(vectors.to_list())
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


#: Usable vectors as doubles, for oracles in DuckDB; vec_id is unique there.
SQL = """v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding))"""

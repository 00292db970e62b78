"""Document quality by a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinloom.llm.common import texts

#: Bytes by kind: capital, small, digit, blank, mark, stop, beyond ASCII, other.
KINDS = np.full(256, 7, np.int64)
for _kind, _bytes in enumerate((range(65, 91), range(97, 123), range(48, 58), b" \t\r", b"*#%$&!|@^~=+<>{}[]\\/_", b".,;:?'\"()-", range(128, 256))):
    KINDS[list(_bytes)] = _kind
OWN = 14
WIDTH = 3 * OWN + 2
#: Training reads the lines of a document in stretches of this many.
STRETCH = 64


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A row per line of what it, the line before and the line after look like; and line lengths.

    Only shapes are looked at: kinds of characters, lengths of words, words repeated in
    the line, and a line that repeats the one before.
    """
    lines = text.split("\n")
    n = len(lines)
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    ends = raw == 10
    at = np.cumsum(ends) - ends
    counts = np.bincount(8 * at + KINDS[raw], minlength=8 * n).reshape(n, 8).astype(float)
    counts[:-1, 7] -= 1  # the line end itself
    size = counts.sum(1)
    words = np.empty((n, 5))
    for i, line in enumerate(lines):
        found = line.split()
        lengths = list(map(len, found))
        words[i] = (len(found), len(set(found)), sum(map(eq, found, found[1:])), sum(map((3).__ge__, lengths)), max(lengths, default=0))
    k = np.maximum(words[:, 0], 1)
    letters = np.maximum(counts[:, 0] + counts[:, 1], 1)
    own = np.zeros((n, OWN))
    own[:, 0] = np.log1p(size) / 8
    own[:, 1] = counts[:, 0] / letters
    own[:, 2:8] = counts[:, 2:8] / np.maximum(size, 1)[:, None]
    own[:, 8] = words[:, 1] / k
    own[:, 9] = words[:, 2] / k
    own[:, 10] = words[:, 3] / k
    own[:, 11] = np.minimum(size / k, 30) / 30
    own[:, 12] = np.minimum(words[:, 4], 60) / 60
    own[:, 13] = size == 0
    out = np.zeros((n, WIDTH))
    out[:, :OWN] = own
    out[1:, OWN : 2 * OWN] = own[:-1]
    out[:-1, 2 * OWN : 3 * OWN] = own[1:]
    out[1:, 3 * OWN] = list(map(eq, lines[1:], lines))
    out[:, 3 * OWN + 1] = 1
    return out, size + 1


@dataclass
class Chain:
    """Weights of a line being good against bad, and of each step between the two (bad 0, good 1)."""

    weights: np.ndarray
    steps: np.ndarray
    #: Slope and shift that turn the log odds of a mean into those of the document's label.
    calibration: tuple[float, float] = (1.0, 0.0)

    def marginals(self, features: np.ndarray) -> np.ndarray:
        """The probability of each line being good, given all lines: forward and backward."""
        good = 1 / (1 + np.exp(-np.clip(features @ self.weights, -30, 30)))
        (bb, bg), (gb, gg) = np.exp(self.steps - self.steps.max()).tolist()
        local, n = good.tolist(), len(good)
        ahead = [0.0] * n
        p = 0.5
        for i, g in enumerate(local):
            b, a = (1 - g), g
            if i:
                b, a = b * ((1 - p) * bb + p * gb), a * ((1 - p) * bg + p * gg)
            p = ahead[i] = a / (a + b)
        back_b = back_g = 1.0
        out = [0.0] * n
        for i in range(n - 1, -1, -1):
            a, b = ahead[i] * back_g, (1 - ahead[i]) * back_b
            out[i] = a / (a + b)
            g = local[i]
            x, y = (1 - g) * back_b, g * back_g
            back_b, back_g = bb * x + bg * y, gb * x + gg * y
            total = back_b + back_g
            back_b, back_g = back_b / total, back_g / total
        return np.array(out)

    def odds(self, features: np.ndarray, sizes: np.ndarray) -> float:
        """Log odds of the mean probability of good lines, weighted by their lengths."""
        mean = np.clip(self.marginals(features) @ sizes / sizes.sum(), 1e-6, 1 - 1e-6)
        return float(np.log(mean / (1 - mean)))

    def score(self, text: str) -> float:
        slope, shift = self.calibration
        return float(1 / (1 + np.exp(-np.clip(slope * self.odds(*line_features(text)) + shift, -30, 30))))


def fit(features: list[np.ndarray], labels: np.ndarray, rounds: int = 150, rate: float = 0.15, shrink: float = 1e-3) -> Chain:
    """Maximum likelihood by gradient steps, each line of a document having its label.

    Both labels weigh alike in all, so a rare one is not drowned; so do documents of
    any length. Without documents of both labels every score is one half.
    """
    chain = Chain(np.zeros(WIDTH), np.zeros((2, 2)))
    parts, gold, weight = [], [], []
    share = {y: 0.5 / max(1, int((labels == y).sum())) for y in (0, 1)}
    for f, y in zip(features, labels):
        stretches = range(0, len(f), STRETCH)
        for s in stretches:
            parts.append(f[s : s + STRETCH])
            gold.append(int(y))
            weight.append(share[int(y)] / len(stretches))
    if len(set(gold)) < 2:
        return chain
    order = np.argsort([-len(p) for p in parts], kind="stable")
    lengths = np.array([len(parts[i]) for i in order])
    y, w = np.array(gold)[order], np.array(weight)[order] / lengths
    n, longest = len(order), int(lengths.max())
    x = np.zeros((longest, n, WIDTH), np.float32)
    for column, i in enumerate(order):
        x[: len(parts[i]), column] = parts[i]
    active = [int((lengths > t).sum()) for t in range(longest)]  # stretches this long come first
    parameters = np.zeros(WIDTH + 4)
    mean, spread = np.zeros_like(parameters), np.zeros_like(parameters)
    state = np.arange(2)
    for k in range(1, rounds + 1):
        steps = parameters[WIDTH:].reshape(2, 2)
        jump = np.exp(steps - steps.max())
        logits = np.clip(x.astype(np.float64) @ parameters[:WIDTH], -30, 30)
        good = 1 / (1 + np.exp(-logits))
        local = np.stack([1 - good, good], axis=2)
        ahead = np.empty((longest, n, 2))
        ahead[0] = local[0]
        for t in range(1, longest):
            m = active[t]
            a = (ahead[t - 1, :m] @ jump) * local[t, :m]
            ahead[t, :m] = a / a.sum(1, keepdims=True)
        slope = np.zeros_like(parameters)
        back = np.ones((n, 2))
        for t in range(longest - 1, -1, -1):
            m = active[t]
            both = ahead[t, :m] * back[:m]
            marginal = both[:, 1] / both.sum(1)
            slope[:WIDTH] += ((y[:m] - marginal) * w[:m]) @ x[t, :m]
            if t:
                after = local[t, :m] * back[:m]
                pair = ahead[t - 1, :m, :, None] * jump * after[:, None, :]
                pair /= pair.sum((1, 2), keepdims=True)
                seen = (y[:m, None, None] == state[:, None]) & (y[:m, None, None] == state)
                slope[WIDTH:] += ((seen - pair) * w[:m, None, None]).sum(0).ravel()
                b = after @ jump.T
                back[:m] = b / b.sum(1, keepdims=True)
        slope -= shrink * parameters
        mean, spread = 0.9 * mean + 0.1 * slope, 0.99 * spread + 0.01 * slope**2
        parameters += rate * (mean / (1 - 0.9**k)) / (np.sqrt(spread / (1 - 0.99**k)) + 1e-9)
    chain = Chain(parameters[:WIDTH], parameters[WIDTH:].reshape(2, 2))
    odds = np.array([chain.odds(f.astype(float), np.expm1(8.0 * f[:, 0]) + 1) for f in features])
    chain.calibration = calibrated(odds, labels)
    return chain


def calibrated(odds: np.ndarray, labels: np.ndarray, shrink: float = 1e-3) -> tuple[float, float]:
    """Logistic regression of the label on the log odds, both labels weighing alike.

    Every document of a bad kind may open with good lines, so the mean at which labels
    change is not one half.
    """
    x = np.stack([odds, np.ones_like(odds)], axis=1)
    w = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum()))
    b = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        slope = x.T @ (w * (labels - p)) - shrink * (b - [1.0, 0.0])
        b = b + np.linalg.solve((x.T * (w * p * (1 - p))) @ x + shrink * np.eye(2), slope)
    return max(float(b[0]), 0.1), float(b[1])


def held_out(doc_id: Column) -> Column:
    """Every fifth document by the CRC of its id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, per_label: int = 2_000) -> Chain:
    """Fit to at most ``per_label`` documents of each label, those with the least hash of doc_id.

    All their lines are read, as in scoring, so what the driver gets grows with the picked
    documents' lines (176 bytes each) and not with the table. Only labels of documents that are not held out are read. A doc_id with different
    labels, a null id and a label other than 0 and 1 are left out.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.min("quality").alias("y"), F.max("quality").alias("y2")).where("y = y2")
    least = [known.where(F.col("y") == y).orderBy(F.xxhash64("_id"), "_id").limit(per_label) for y in (0, 1)]
    picked = F.broadcast(least[0].union(least[1]).select("_id", "y"))  # 2 * per_label rows
    width = WIDTH

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [line_features(t)[0].astype(np.float32) for t in batch["text"]]
            yield pd.DataFrame({"_id": batch["_id"], "y": batch["y"], "f": [r.tobytes() for r in rows]})

    rows = texts(docs).join(picked, F.col("doc_id") == F.col("_id")).select("_id", "y", "text")
    rows = rows.mapInPandas(scan, "_id long, y int, f binary").toPandas().sort_values(["_id", "f"])
    rows = rows.drop_duplicates("_id")
    return fit([np.frombuffer(f, np.float32).reshape(-1, width) for f in rows["f"]], rows["y"].to_numpy())


def score_of(text: Column, chain: Chain) -> Column:
    """The score of each whole text; a null one is empty, a line without characters."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([chain.score(t or "") for t in texts], dtype=float)

    return score(text)


def quality_scores(docs: DataFrame, chain: Chain, threshold: float = 0.3) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; repeated rows have the same score.

    A score needs the text alone, all of it. The model is a few dozen numbers and goes
    with the code of the task.
    """
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), score_of(F.col("text"), chain).alias("score"))
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


def accepted(docs: DataFrame, chain: Chain, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that are predicted good, with their own columns."""
    return docs.where(score_of(F.col("text"), chain) >= threshold)

"""Runs of words that repeat with a period, by Lyndon roots.

Every run holds the longest Lyndon word that starts somewhere in it, for one of two
opposite orders of the words, and that word is as long as the run's smallest period. The
first phase of Baier's suffix sorter yields these lengths directly: suffixes are grouped by
the Lyndon word they start with, groups are taken from the highest down, and each gives its
word to the suffixes right before it. What is left is to extend each root to both sides for
as long as words a period apart agree (longest common extensions).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinloom.llm.common import texts
from kinloom.llm.wordwise import ragged

#: Documents are worked on together up to this number of words; a longer one is alone.
BUNDLE_WORDS = 600_000
SLOTS_BITS = 22
_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
FOUND = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def longest_lyndon(codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word that starts at each place, within its stretch.

    ``codes`` are the letters of all stretches, one after another. The stretches are
    grouped side by side: each step takes the highest open group of every stretch.
    """
    n = len(codes)
    base = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    # Suffixes in the order of their groups; a group is named by its first slot.
    order = np.lexsort((codes, owner))
    slot = np.empty(n, np.int64)
    slot[order] = np.arange(n)
    new = np.ones(n, bool)
    new[1:] = (codes[order[1:]] != codes[order[:-1]]) | (owner[order[1:]] != owner[order[:-1]])
    starts = np.flatnonzero(new)
    members = np.zeros(n + 1, np.int64)
    members[starts] = np.diff(starts, append=n)
    group = np.empty(n, np.int64)
    group[order] = starts[np.cumsum(new) - 1]
    # Open suffixes of a stretch as a chain; n stands for none.
    left, right = np.arange(-1, n), np.arange(1, n + 2)
    left[base[sizes > 0]] = n
    right[(base + sizes - 1)[sizes > 0]] = n
    length = np.ones(n, np.int64)
    moved = np.zeros(n, bool)
    low, top = base[sizes > 0], (base + sizes)[sizes > 0]
    while len(top):
        first = group[order[top - 1]]
        highest = order[ragged(first, top - first)]
        highest.sort()
        before = left[highest]
        head = np.ones(len(highest), bool)
        head[1:] = before[1:] != highest[:-1]
        head = np.flatnonzero(head)
        times = np.diff(head, append=len(highest))
        taker, after = before[head], right[highest[head + times - 1]]
        right[taker] = after
        left[after] = taker
        some = taker < n
        taker, times = taker[some], times[some]
        length[taker] += times * length[highest[head[some]]]
        # Takers go to the end of their group, those of more repetitions further up.
        place = np.lexsort((times, group[taker]))
        taker, times = taker[place], times[place]
        old = group[taker]
        edge = np.ones(len(old), bool)
        edge[1:] = old[1:] != old[:-1]
        cut = np.flatnonzero(edge)
        count = np.diff(cut, append=len(old))
        tail = np.repeat(old[cut] + members[old[cut]] - count, count)
        target = tail + np.arange(len(old)) - np.repeat(cut, count)
        moved[taker] = True
        there = order[target]
        there = there[~moved[there]]
        vacant = slot[taker]
        vacant = vacant[vacant < tail]
        order[vacant] = there
        slot[there] = vacant
        order[target] = taker
        slot[taker] = target
        moved[taker] = False
        edge[1:] |= times[1:] != times[:-1]
        members[old[cut]] -= count
        cut = np.flatnonzero(edge)
        count = np.diff(cut, append=len(old))
        members[target[cut]] = count
        group[taker] = np.repeat(target[cut], count)
        on = first > low
        low, top = low[on], first[on]
    return length


@lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = _U(pow(int(_ODD), -1, 1 << 64))
    return np.cumprod(np.r_[_U(1), np.full(n, _ODD)]), np.cumprod(np.r_[_U(1), np.full(n, inverse)])


class Names:
    """Equal substrings have equal names; unequal ones differ but for a chance of about 2**-64."""

    def __init__(self, codes: np.ndarray):
        up, self.down = _powers(1 << max(len(codes), 1).bit_length())
        values = np.random.default_rng(12).integers(0, 1 << 64, int(codes.max(initial=0)) + 1, dtype=np.uint64)
        self.sums = np.zeros(len(codes) + 1, _U)
        np.cumsum(values[codes] * up[: len(codes)], out=self.sums[1:])

    def of(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.sums[at + size] - self.sums[at]) * self.down[at]

    def agreement(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray, back: bool) -> np.ndarray:
        """Number of letters, up to ``limit``, that agree from ``a`` and ``b`` on, or backwards before them."""
        low, high = np.zeros(len(a), np.int64), limit.copy()
        while (low < high).any():
            size = (low + high + 1) // 2
            shift = size if back else 0
            same = self.of(a - shift, size) == self.of(b - shift, size)
            low, high = np.where(same, size, low), np.where(same, high, size - 1)
        return low


def stretch_runs(codes: np.ndarray, sizes: np.ndarray, exponent: float, least: int) -> np.ndarray:
    """Start, end and period of each run, in that order; runs lie within stretches.

    A run of ``exponent`` periods holds a root that ``exponent - 1`` whole copies follow
    or start, so roots without them are left out before they are extended. Each run found
    is checked letter by letter; should two names ever have been equal by chance, its
    extent is counted anew.
    """
    ends = np.cumsum(sizes)
    low, high = np.repeat(ends - sizes, sizes), np.repeat(ends, sizes)
    names, found = Names(codes), []
    copies = max(int(exponent) - 1, 1)
    for letters in (codes, -codes):
        period = longest_lyndon(letters, sizes)
        at = np.flatnonzero(np.arange(len(codes)) + copies * period <= high)
        p = period[at]
        own = names.of(at, p)
        whole = np.ones(len(at), bool)
        for k in range(1, copies):
            whole &= names.of(at + k * p, p) == own
        at, p = at[whole], p[whole]
        # Of roots that follow one another the first is enough.
        root = np.zeros(len(codes), np.int64)
        root[at] = p
        earlier = (at - p >= low[at]) & (root[np.maximum(at - p, 0)] == p)
        if copies > 1:
            at, p = at[~earlier], p[~earlier]
        back = names.agreement(at, at + p, at - low[at], True)
        ahead = names.agreement(at, at + p, high[at] - at - p, False)
        found.append(np.stack([at - back, at + p + ahead, p, low[at], high[at]]))
    runs = np.unique(np.concatenate(found, axis=1), axis=1)
    start, end, period, first, last = runs
    for k in np.flatnonzero(~agree(codes, start, end, period)):  # names of different words were equal
        same = codes[first[k] : last[k] - period[k]] == codes[first[k] + period[k] : last[k]]
        breaks = np.flatnonzero(np.diff(np.r_[False, same, False].astype(np.int8)))
        a, b = max((breaks.reshape(-1, 2) + first[k]).tolist(), key=lambda x: min(end[k], x[1]) - max(start[k], x[0]), default=(first[k], first[k]))
        start[k], end[k] = a, b + period[k]
    length = end - start
    return runs[:3, (length >= least) & (length >= exponent * period)]


def agree(codes: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Whether letters a period apart are the same all through each run."""
    size = end - start - period
    at = ragged(start, size)
    differs = codes[at] != codes[at + np.repeat(period, size)]
    return np.bincount(np.repeat(np.arange(len(size)), size), differs, len(size)) == 0


def stretches(words: list[list[bytes]], exponent: float, least: int) -> Iterator[tuple[int, int, int]]:
    """Document, first and last word (exclusive) of all stretches in which a run can lie.

    In a run every three words that follow one another come again a period on, so often
    as whole periods less one fit. Their counts are taken in a table of hashes, in which
    strangers may meet: that makes a stretch longer, never shorter.
    """
    sizes = np.array([len(w) for w in words], np.int64)
    n = int(sizes.sum())
    if n < 3:
        return
    h = np.fromiter(map(hash, chain.from_iterable(words)), np.int64, n).astype(_U)
    owner = np.repeat(np.arange(len(words)), sizes)
    three = (h[:-2] * _ODD + h[1:-1]) * _ODD + h[2:] + owner[:-2].astype(_U) * _U(0xD6E8FEB86659FD93)
    three = ((three ^ (three >> _U(32))) * _ODD) >> _U(64 - SLOTS_BITS)
    inner = owner[:-2] == owner[2:]
    counts = np.bincount(three[inner].astype(np.int64), minlength=1 << SLOTS_BITS)
    often = inner & (counts[three.astype(np.int64)] >= max(min(int(exponent) - 1, least - 2), 1))
    turns = np.flatnonzero(np.diff(np.r_[False, often, False].astype(np.int8)) != 0).reshape(-1, 2)
    # Places of one document do not run on into the next, whose last two have no three words.
    turns = turns[turns[:, 1] - turns[:, 0] + 2 >= least]
    begin = np.cumsum(sizes) - sizes
    doc = owner[turns[:, 0]]
    yield from zip(doc.tolist(), (turns[:, 0] - begin[doc]).tolist(), (turns[:, 1] + 2 - begin[doc]).tolist())


def runs_of(words: list[list[bytes]], exponent: float = 4, least: int = 6) -> list[np.ndarray | None]:
    """For each list of words its runs as rows of start, length and period, or None."""
    codes, sizes, owners, shift = [], [], [], []
    for doc, a, b in stretches(words, exponent, least):
        letters: dict[bytes, int] = {}
        codes.append(np.array([letters.setdefault(w, len(letters)) for w in words[doc][a:b]], np.int64))
        sizes.append(b - a)
        owners.append(doc)
        shift.append(a)
    out: list[np.ndarray | None] = [None] * len(words)
    if not codes:
        return out
    size = np.array(sizes, np.int64)
    start, end, period = stretch_runs(np.concatenate(codes), size, exponent, least)
    base = np.cumsum(size) - size
    k = np.searchsorted(base, start, "right") - 1
    doc = np.array(owners)[k]
    rows = np.stack([start - base[k] + np.array(shift)[k], end - start, period], axis=1)
    order = np.lexsort((rows[:, 2], rows[:, 0], doc))
    doc, rows = doc[order], rows[order]
    cut = np.flatnonzero(np.diff(doc, prepend=-1))
    for d, part in zip(doc[cut].tolist(), np.split(rows, cut[1:])):
        out[d] = part
    return out


def collapsed(words: list[bytes], runs: np.ndarray | None) -> bytes:
    """The words but those that a run holds after its first period, with one blank between."""
    if runs is None:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)])


def periodic_runs(docs: DataFrame, exponent: float = 4, least: int = 6) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every text.

    Words are separated by blanks and the control characters from tab to carriage return.
    A run is a stretch of words with smallest period q, at least ``least`` words and
    ``exponent`` periods long, that no neighbouring word extends; ``runs`` has them by
    start and period, as numbers of words. ``collapsed`` has the words without what runs
    repeat. A null, empty or blank text has no words and an empty ``collapsed``. Rows with
    a null or a repeated doc_id are documents of their own; an empty table gives none.
    Nothing is shuffled: a document is whole in its task.
    """
    if exponent < 2 or least < 3:
        raise ValueError("runs have two periods and three words at least")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, count = [], [], 0
        for batch in batches:
            for number, text in zip(batch["doc_id"], batch["text"].cast(pa.binary())):
                ids.append(number)
                held.append(text.as_py().split())
                count += len(held[-1])
                if count >= BUNDLE_WORDS:
                    yield result(ids, held)
                    ids, held, count = [], [], 0
        if ids:
            yield result(ids, held)

    def result(ids: list, words: list[list[bytes]]) -> pa.RecordBatch:
        runs = runs_of(words, exponent, least)
        counts = [0 if r is None else len(r) for r in runs]
        rows = np.concatenate([np.empty((0, 3), np.int64), *(r for r in runs if r is not None)])
        fields = pa.StructArray.from_arrays([pa.array(c) for c in rows.T], ["start", "length", "period"])
        columns = [
            pa.array([i.as_py() for i in ids], pa.int64()),
            pa.array([len(w) for w in words], pa.int64()),
            pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(counts)), pa.int32()), fields),
            pa.array([collapsed(w, r) for w, r in zip(words, runs)], pa.binary()).cast(pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    return texts(docs).mapInArrow(find, FOUND)


def planted(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` with runs put into about a tenth of the texts, by a hash of doc_id.

    With h the crc32 of the decimal doc_id and g = h div 10, a text of n > 0 words whose h
    ends in 0 repeats p = 1 + (n-a) div (3 + g mod 8) words from word a = g mod n on.
    """
    rows = texts(docs).withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+", -1), lambda w: w != "")
    rows = rows.withColumn("w", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("w"))
    g = F.floor(F.col("h") / 10)
    rows = rows.withColumn("a", F.when(F.col("n") > 0, g % F.col("n")).cast("int"))
    p = (1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8))).cast("int")
    rows = rows.withColumn("p", p)
    again = F.transform(
        F.sequence(F.lit(0), F.col("n") - 1),
        lambda i: F.get("w", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))),
    )
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """Number of runs, the longest one, and hashes of all runs and of what is left."""
    longest = F.get(F.array_sort("runs", lambda x, y: _order(x, y)), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        longest.alias("top"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id",
        "n_runs",
        "top.start",
        "top.length",
        "top.period",
        F.floor(1000 * F.col("top.length") / F.col("top.period")).alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


def _order(x, y):
    """Longer first, then by start and period."""
    keys = [(y["length"], x["length"]), (x["start"], y["start"]), (x["period"], y["period"])]
    out = F.lit(0)
    for a, b in reversed(keys):
        out = F.when(a < b, -1).when(a > b, 1).otherwise(out)
    return out

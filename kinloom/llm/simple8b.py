"""Simple-8b: as many ids as fit in each 64-bit word, with a selector in its top four bits.

Selectors 2 to 15 say how many ids of equal width share the other 60 bits, the first id in
the lowest. Selector 1 is a run: an id of 32 bits above a count of 28. Selector 0 is the
escape for an id of over 60 bits: two such words hold its upper and its lower half. A block
begins with a word of its own, and what its last word has room for is zero.
"""

from __future__ import annotations

import numpy as np

from kinloom.llm.wordwise import ragged

#: Ids in a word of each selector; 0 and 1 are the escape and the run.
COUNTS = np.array([0, 0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([64, 32, *(60 // COUNTS[2:])])
_TAKE = np.maximum(COUNTS, 1).astype(np.int32)
BLOCK = 1024
_U = np.uint64
_SHIFTS = {s: np.arange(COUNTS[s], dtype=_U) * _U(WIDTHS[s]) for s in range(2, 16)}


def widths(ids: np.ndarray) -> np.ndarray:
    """Bits of each id."""
    bits = np.frexp(ids.astype(np.float64))[1]
    if ids.max(initial=0) >= 1 << 53:  # a double would round up
        upper = ids >> _U(32)
        bits = np.where(upper > 0, np.frexp(upper.astype(np.float64))[1] + 32, bits)
    return bits.astype(np.uint8)


def blocks_of(lengths: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Number of ids in each block: stretches of given lengths are cut every ``block`` ids."""
    count = -(-lengths // block)
    place = ragged(np.zeros(len(lengths), np.int64), count)
    return np.minimum(np.repeat(lengths, count) - place * block, block)


def encode(ids: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of all blocks, and how many words each block has; ``blocks`` are their numbers of ids."""
    gap = int(COUNTS[2]) - 1  # zeros after each block, so that no word reaches into the next one
    begin = np.cumsum(blocks + gap) - blocks - gap
    n = int((blocks + gap).sum())
    inside = ragged(begin, blocks)
    flat = np.zeros(n, _U)
    flat[inside] = ids
    width = np.zeros(n, np.uint8)
    width[inside] = widths(ids)
    # The largest width among the next 1, 2, 3 ... ids; the longest stretch that fits wins.
    most = {1: width}
    selector = np.where(width <= 60, 15, 0).astype(np.uint8)
    for s in range(14, 1, -1):
        count = int(COUNTS[s])
        part = max(c for c in most if c < count)
        now = most[part].copy()
        step = count - part
        np.maximum(now[:-step], most[part][step:], out=now[:-step])
        most[count] = now
        selector[now <= WIDTHS[s]] = s
    # Runs of one id, told apart from what a word of equal widths would take.
    breaks = np.ones(n, bool)
    breaks[1:] = flat[1:] != flat[:-1]
    breaks[np.minimum(begin + blocks, n - 1)] = True
    starts = np.flatnonzero(breaks)
    run = np.diff(starts, append=n)
    starts, run = starts[run > 1], run[run > 1]
    at = ragged(starts, run)
    left = np.repeat(starts + run, run) - at
    longer = (left > COUNTS[selector[at]]) & (width[at] <= 32)
    take = _TAKE[selector]
    take[at[longer]] = left[longer]
    selector[at[longer]] = 1
    # All blocks go forward together, a word at a time.
    first = np.zeros(n, bool)
    at, end = begin, begin + blocks
    while len(at):
        first[at] = True
        at = at + take[at]
        on = at < end
        at, end = at[on], end[on]
    at = np.flatnonzero(first)
    kind = selector[at]
    size = np.where(kind == 0, 2, 1)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), _U)
    for s in range(2, 16):
        here = np.flatnonzero(kind == s)
        values = flat[at[here][:, None] + np.arange(COUNTS[s])] << _SHIFTS[s]
        words[place[here]] = np.bitwise_or.reduce(values, axis=1) | _U(s << 60)
    here = np.flatnonzero(kind == 1)
    words[place[here]] = _U(1 << 60) | (flat[at[here]] << _U(28)) | take[at[here]].astype(_U)
    here = np.flatnonzero(kind == 0)
    words[place[here]] = flat[at[here]] >> _U(32)
    words[place[here] + 1] = flat[at[here]] & _U((1 << 32) - 1)
    return words, np.bincount(np.searchsorted(begin, at, "right") - 1, size, len(blocks)).astype(np.int64)


def decode(words: np.ndarray, word_counts: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Ids of all blocks, whose numbers of words and of ids are given."""
    kind = (words >> _U(60)).astype(np.int64)
    count = COUNTS[kind]
    here = np.flatnonzero(kind == 1)
    count[here] = (words[here] & _U((1 << 28) - 1)).astype(np.int64)
    escape = np.flatnonzero(kind == 0)
    count[escape[1::2]] = 1
    before = np.append(0, np.cumsum(count))
    flat = np.empty(before[-1], _U)
    run = ragged(before[here], count[here])
    flat[run] = np.repeat((words[here] >> _U(28)) & _U((1 << 32) - 1), count[here])
    flat[before[escape[1::2]]] = (words[escape[0::2]] << _U(32)) | words[escape[1::2]]
    for s in range(2, 16):
        here = np.flatnonzero(kind == s)
        if len(here):
            values = (words[here][:, None] >> _SHIFTS[s]) & _U((1 << int(WIDTHS[s])) - 1)
            flat[before[here][:, None] + np.arange(COUNTS[s])] = values
    return flat[ragged(before[np.cumsum(word_counts) - word_counts], blocks)]

"""Token ids of many texts at once: cut into words in compiled code, each different word encoded once."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once, and bytes of words and ids that a memory holds.
STEP_BYTES, MEMORY_BYTES = 2 << 20, 96 << 20
#: Longer words are encoded each time they come.
LONGEST_KEPT = 64


def steps(texts: pa.Array, step_bytes: int = STEP_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Row number and rows of parts of about ``step_bytes``; a null text is empty, a long one is a part of its own."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        to = max(int(np.searchsorted(ends, before + step_bytes, "right")), at + 1)
        yield at, texts[at:to]
        at = to


def body(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts (large binary), and where each begins, with the end."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
    return raw, offsets - offsets[0]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0] .. starts[0]+lengths[0]-1, starts[1] .. and so on."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - ends + lengths, lengths)


class Words:
    """What ``encode`` makes of words, remembered within a bound of bytes.

    ``encode`` takes different words and gives the ids of all and how many each has.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]], memory_bytes: int = MEMORY_BYTES):
        self.encode, self.memory_bytes = encode, memory_bytes
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.at, self.size, self.pool = (np.empty(1 << 12, t) for t in (np.int64, np.int32, np.uint32))
        self.count = self.used = self.held = 0

    def _add(self, ids: np.ndarray, size: np.ndarray) -> range:
        count, used = self.count + len(size), self.used + len(ids)
        if used > len(self.pool):
            self.pool = np.resize(self.pool, 2 * used)
        if count > len(self.at):
            self.at, self.size = np.resize(self.at, 2 * count), np.resize(self.size, 2 * count)
        self.pool[self.used : used] = ids
        self.size[self.count : count] = size
        self.at[self.count : count] = self.used + np.cumsum(size) - size
        new = range(self.count, count)
        self.count, self.used = count, used
        return new

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """A number for each different word."""
        if self.held > self.memory_bytes:
            self.forget()
        out = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(out < 0)
        if len(missing):
            fresh = [words[i] for i in missing]
            ids, size = self.encode(fresh)
            new = self._add(ids, size)
            out[missing] = new
            kept = {w: n for w, n in zip(fresh, new, strict=True) if len(w) <= LONGEST_KEPT}
            self.known |= kept
            self.held += sum(map(len, kept)) + 130 * len(kept) + 12 * len(fresh) + 4 * len(ids)
        return out

    def ids(self, words: pa.DictionaryArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and how many of them each word has."""
        number, code = self.numbers(words.dictionary.to_pylist()), words.indices.to_numpy()
        size = self.size[number].astype(np.int64)[code]
        return self.pool[ragged(self.at[number][code], size)], size


def cut_at(raw: np.ndarray, cuts: np.ndarray) -> pa.DictionaryArray:
    """The bytes between ``cuts``, each different string once."""
    buffers = [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(raw)]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, buffers).dictionary_encode()

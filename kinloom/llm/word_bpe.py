"""Ids of the word vocabulary, in which white space ends every token."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from kinloom.llm.wordwise import Words, body, cut_at, steps

#: A-Z in lower case and the end of a line as a blank; other letters are left to the tokenizer.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
FOLD[10] = 32
LETTER, MARK, LATIN = (np.zeros(256, bool) for _ in range(3))
LETTER[97:123] = True
MARK[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True
#: Second bytes of the letters from U+00C0 to U+00FF; two signs lie between them.
LATIN[0x80:0xC0] = True
LATIN[[0x97, 0xB7]] = False

_encoders: dict[str, WordBpe] = {}


class WordBpe:
    """Ids of texts for a vocabulary that lower-cases, drops white space and ends tokens there.

    Texts are cut before blanks and ends of lines, and before marks that follow a letter; a
    word with the blank before it has the ids of the word. A text in which a special token may stand is encoded as a whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words = Words(self._encode)

        (self.mark,) = self.plain("\x01")

    def plain(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Many words as one text, with a mark between them that is a token of its own."""
        ids, size = [], []
        for at in range(0, len(words), 2000):
            some = words[at : at + 2000]
            found = self.plain(b" \x01 ".join([*some, b""]).decode("utf-8", "replace"))
            ends = np.flatnonzero(found == self.mark)
            if len(ends) == len(some):
                ids.append(found[found != self.mark])
                size.append(np.diff(ends, prepend=-1) - 1)
            else:  # a word holds the mark
                alone = [self.plain(w.decode("utf-8", "replace")) for w in some]
                ids += alone
                size.append(np.array([len(w) for w in alone]))
        return np.concatenate(ids), np.concatenate(size)

    def encoded(self, texts: pa.Array, end: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Parts of the rows: number of the first, the ids of all (each row's followed by ``end``), ids of each."""
        for first, part in steps(texts):
            raw, offsets = body(part)
            special = np.flatnonzero(pc.match_substring(part, "<|").to_numpy(zero_copy_only=False))
            raw = FOLD[raw]
            # An empty text has no word.
            cut = raw == 32
            # A mark after a letter (of ASCII or Latin-1) starts another token, too.
            letter = LETTER[raw]
            letter[1:] |= (raw[:-1] == 0xC3) & LATIN[raw[1:]]
            cut[1:] |= MARK[raw[1:]] & letter[:-1]
            cut[offsets[:-1][offsets[:-1] < len(raw)]] = True
            cuts = np.append(np.flatnonzero(cut), len(raw))
            ids, size = self.words.ids(cut_at(raw, cuts))
            ends = np.append(0, np.cumsum(size))[np.searchsorted(cuts, offsets[1:])]
            if len(special):
                pieces = np.split(ids, ends[:-1])
                for row in special.tolist():
                    text = part[row].as_py().decode("utf-8", "replace")
                    pieces[row] = self.plain(text)
                ids, ends = np.concatenate(pieces), np.cumsum([len(p) for p in pieces])
            ends = ends + np.arange(1, len(part) + 1)
            out = np.full(ends[-1], end, np.uint32)
            inner = np.ones(ends[-1], bool)
            inner[ends - 1] = False
            out[inner] = ids
            yield first, out, np.diff(ends, prepend=0)


def word_bpe(path: str) -> WordBpe:
    """One encoder per worker process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = WordBpe(path)
    return _encoders[path]

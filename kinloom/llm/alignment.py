"""Which tokens of two tokenizers cover the same bytes.

Both tokenise the whole text. Where a token of each ends at the same byte and both next
ones begin with a blank lies an anchor; anchors split a document into windows, short pairs
of id tuples that come again and again. The alignment of a window hangs on its ids alone,
so it is worked out once and remembered.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import repeat
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinloom.llm.common import texts
from kinloom.llm.word_bpe import LATIN
from kinloom.llm.wordwise import Words, body, cut_at, ragged, steps
from kinloom.session import staged

EMPTY, BLANK = pa.scalar(b"", pa.large_binary()), pa.scalar(b" ", pa.large_binary())
#: What stands before a word that is cut off after a letter, while it is encoded.
LEAD = b" a"
LETTER = np.zeros(256, bool)
LETTER[[*range(65, 91), *range(97, 123)]] = True
OF_B = np.uint32(1 << 31)
WORDS_BYTES, WINDOWS_BYTES = 112 << 20, 80 << 20
#: Pairs of ids whose counts are sent to all tasks: 17 bytes each. Rarer ones are joined.
SENT_PAIRS = 2_000_000
PAIRS = "pair long, n long"
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string, rare array<struct<pair:long,n:long>>"


def byte_level() -> dict[str, int]:
    """The characters that byte-level vocabularies write for bytes: itself if it is visible, else one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Side:
    """One tokenizer: bytes of each id, their number, and whether they begin with a blank."""

    def __init__(self, token_bytes: list[bytes]):
        self.bytes = token_bytes
        self.size = np.array([len(b) for b in token_bytes], np.int64)
        self.blank = np.array([b[:1] == b" " for b in token_bytes])


class Aligner:
    """Tokens and window alignments of texts, remembered within bounds of bytes.

    Words are cut before a blank between two characters that are surely no white space, and
    between a letter and a mark that no piece has after a letter: there no token of either
    vocabulary reaches over, so a word has the ids it has in its text. Words that the second tokenizer does not give back byte for byte have no ids.
    """

    def __init__(self, byte_bpe: str, piece_bpe: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.byte_bpe = Tokenizer.from_file(byte_bpe)
        self.byte_bpe.encode_special_tokens = True
        to_byte = byte_level()
        entries = [b""] * self.byte_bpe.get_vocab_size()
        for token, i in self.byte_bpe.get_vocab().items():
            entries[i] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
        self.a = Side(entries)
        self.piece_bpe = sentencepiece.SentencePieceProcessor(model_file=piece_bpe)
        pieces = []
        for i in range(self.piece_bpe.get_piece_size()):
            piece = self.piece_bpe.id_to_piece(i)
            pieces.append(bytes([int(piece[3:5], 16)]) if self.piece_bpe.is_byte(i) else piece.replace("▁", " ").encode())
            if "▁" in piece.lstrip("▁"):
                raise ValueError("a piece has a blank within it: texts cannot be cut at blanks")
        self.b = Side(pieces)
        plain = [p for i in range(len(pieces)) if not (self.piece_bpe.is_control(i) or self.piece_bpe.is_unknown(i)) for p in [self.piece_bpe.id_to_piece(i)]]
        joined = {y for p in plain for x, y in zip(p, p[1:]) if x.isalpha()}
        self.marks = np.zeros(256, bool)
        self.marks[[ord(m) for m in punctuation if m not in joined]] = True
        self.words = Words(self._encode, WORDS_BYTES)
        numbers = [b"%d" % i for i in range(max(len(entries), len(pieces)))]
        length = np.array([len(n) for n in numbers])
        self.digits = np.frombuffer(b"".join(numbers), np.uint8), np.cumsum(length) - length, length
        self.forget()

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids, size = [], []
        for at in range(0, len(words), 1000):
            some = words[at : at + 1000]
            # A mark that follows a letter is encoded after one, which is then left out.
            led = [w[:1] != b" " for w in some]
            listed = [x for w, lead in zip(some, led, strict=True) for x in ([LEAD, w] if lead else [w])]
            both = self._together(listed)
            if both is None:
                for one in map(self._alone, some):
                    ids.append(one[0])
                    size.append(one[1])
                continue
            own = np.ones(len(listed), bool)
            own[(np.flatnonzero(led) + np.arange(sum(led)))] = False
            ids.append(both[0][np.repeat(own, both[1])])
            size.append(both[1][own])
        return np.concatenate(ids), np.concatenate(size)

    def _tokens(self, text: bytes) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both for a text that begins with a blank, None if the second one loses a byte."""
        b = self.piece_bpe.encode(text[1:].decode())
        if b"".join(map(self.b.bytes.__getitem__, b)) != text:
            return None
        a = self.byte_bpe.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids
        return np.array(a, np.uint32), np.array(b, np.uint32)

    def _alone(self, word: bytes) -> tuple[np.ndarray, np.ndarray]:
        lead = word[:1] != b" "
        tokens = self._tokens(LEAD + word if lead else word)
        if tokens is None:
            return np.empty(0, np.uint32), np.array([0])
        a, b = (x[1:] for x in tokens) if lead else tokens
        return np.concatenate([a, b | OF_B]), np.array([len(a) + len(b)])

    def _together(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray] | None:
        """Many words as one text, None where one of them must be encoded alone."""
        if any(ends_blank(w) for w in words):
            return None
        tokens = self._tokens(b"".join(words))
        if tokens is None:
            return None
        word_ends = np.cumsum([len(w) for w in words])
        a, b = tokens
        cut = []
        for ids, side in ((a, self.a), (b, self.b)):
            ends = np.cumsum(side.size[ids])
            at = np.searchsorted(ends, word_ends)
            if (ends[at] != word_ends).any():
                return None
            cut.append(np.diff(at, prepend=-1))
        size = cut[0] + cut[1]
        out = np.empty(len(a) + len(b), np.uint32)
        start = np.cumsum(size) - size
        out[ragged(start, cut[0])] = a
        out[ragged(start + cut[0], cut[1])] = b | OF_B
        return out, size

    # Windows

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.text: list[str] = []
        self.groups, self.links, self.at = (np.empty(1 << 12, np.int64) for _ in range(3))
        self.pairs = np.empty(1 << 14, np.int64)
        self.count = self.used = self.held = 0

    def align(self, keys: list[bytes]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Of each window the groups as text, their number and that of its links; the linked pairs of all."""
        flat = np.frombuffer(b"".join(keys), "<u4")
        size = np.array([len(k) for k in keys]) // 4
        base = np.cumsum(size) - size
        size_a = flat[base].astype(np.int64)
        size_b = size - 1 - size_a
        a, b = flat[ragged(base + 1, size_a)].astype(np.int64), flat[ragged(base + 1 + size_a, size_b)].astype(np.int64)
        # Windows follow one another and each has as many bytes on both sides.
        end_a, end_b = np.cumsum(self.a.size[a]), np.cumsum(self.b.size[b])
        first = np.searchsorted(end_b, end_a - self.a.size[a], "right")
        stop = np.searchsorted(end_b - self.b.size[b], end_a, "left")
        many = stop - first
        pairs = np.repeat(a, many) << 32 | b[ragged(first, many)]
        closes_a = end_b[np.minimum(np.searchsorted(end_b, end_a), len(b) - 1)] == end_a
        closes_b = end_a[np.minimum(np.searchsorted(end_a, end_b), len(a) - 1)] == end_b
        last_a, last_b = np.cumsum(size_a) - 1, np.cumsum(size_b) - 1
        groups = np.diff(np.cumsum(closes_a)[last_a], prepend=0)
        links = np.diff(np.cumsum(many)[last_a], prepend=0)
        # Of each group the first ids, then the second ones, each with the sign behind it.
        group_a = np.cumsum(closes_a) - closes_a
        group_b = np.cumsum(closes_b) - closes_b
        before_b = np.append(0, np.cumsum(np.bincount(group_b)))[group_a]
        through_a = np.cumsum(np.bincount(group_a))[group_b]
        sign_b = np.where(closes_b, ord(";"), ord(","))
        sign_b[last_b] = ord("\n")
        ids, signs = np.empty(len(a) + len(b), np.int64), np.empty(len(a) + len(b), np.uint8)
        for place, side, sign in ((np.arange(len(a)) + before_b, a, np.where(closes_a, ord("|"), ord(","))), (np.arange(len(b)) + through_a, b, sign_b)):
            ids[place], signs[place] = side, sign
        digits, start, length = self.digits
        width = length[ids]
        at = np.cumsum(width + 1) - width - 1
        text = np.empty(int((width + 1).sum()), np.uint8)
        text[ragged(at, width)] = digits[ragged(start[ids], width)]
        text[at + width] = signs
        return text.tobytes().decode("ascii").split("\n")[:-1], groups, links, pairs

    def numbers(self, keys: list[bytes]) -> np.ndarray:
        """A number for each different window."""
        out = np.fromiter(map(self.known.get, keys, repeat(-1)), np.int64, len(keys))
        missing = np.flatnonzero(out < 0)
        if len(missing):
            fresh = [keys[i] for i in missing]
            text, groups, links, pairs = self.align(fresh)
            count, used = self.count + len(fresh), self.used + len(pairs)
            if count > len(self.at):
                self.groups, self.links, self.at = (np.resize(x, 2 * count) for x in (self.groups, self.links, self.at))
            if used > len(self.pairs):
                self.pairs = np.resize(self.pairs, 2 * used)
            new = slice(self.count, count)
            self.groups[new], self.links[new], self.at[new] = groups, links, self.used + np.cumsum(links) - links
            self.pairs[self.used : used] = pairs
            self.text += text
            out[missing] = np.arange(self.count, count)
            self.known |= dict(zip(fresh, range(self.count, count), strict=True))
            self.count, self.used = count, used
            self.held += sum(map(len, fresh)) + sum(map(len, text)) + 8 * len(pairs) + 240 * len(fresh)
        return out

    def pairs_of(self, windows: np.ndarray) -> np.ndarray:
        return self.pairs[ragged(self.at[windows], self.links[windows])]

    def windows(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Parts of the rows: first row, rows, ids of each by both, windows of each, and all windows' numbers."""
        for first, part in steps(texts):
            n = len(part)
            if self.held > WINDOWS_BYTES:
                yield first, 0, *(np.empty(0, np.int64),) * 4  # what was counted is to be taken now
                self.forget()
            some = pc.binary_length(part).to_numpy() > 0
            raw, offsets = body(pc.binary_join_element_wise(EMPTY, part.filter(pa.array(some)), BLANK))
            cuts = np.append(np.flatnonzero(word_starts(raw, offsets, self.marks)), len(raw))
            words = cut_at(raw, cuts)
            number, code = self.words.numbers(words.dictionary.to_pylist()), words.indices.to_numpy()
            size = self.words.size[number].astype(np.int64)[code]
            doc = np.flatnonzero(some)[np.searchsorted(offsets, cuts[:-1], "right") - 1] if len(raw) else np.empty(0, np.int64)
            lost = np.bincount(doc, size == 0, n) > 0
            kept = ~lost[doc]
            doc, code, size = doc[kept], code[kept], size[kept]
            ids = self.words.pool[ragged(self.words.at[number][code], size)]
            of_b = ids >= OF_B
            a, b = ids[~of_b], ids[of_b] & ~OF_B
            ends = np.append(0, np.cumsum(size))[np.searchsorted(doc, np.arange(n + 1))]
            n_b = np.diff(np.append(0, np.cumsum(of_b))[ends])
            n_a = np.diff(ends) - n_b
            n_w, keys = self._cut(a, b, n_a, n_b)
            yield first, n, n_a, n_b, n_w, self.numbers(keys.dictionary.to_pylist())[keys.indices.to_numpy()]

    def _cut(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, pa.DictionaryArray]:
        """Number of windows of each document, and all windows as id tuples: number of the first's ids, ids of both."""
        start_a = np.cumsum(self.a.size[a]) - self.a.size[a]
        start_b = np.cumsum(self.b.size[b]) - self.b.size[b]
        anchor = np.zeros((start_a[-1] if len(a) else 0) + 1, bool)
        anchor[start_a[self.a.blank[a]]] = True
        both = start_b[self.b.blank[b]]
        both = both[anchor[np.minimum(both, len(anchor) - 1)] & (both < len(anchor))]
        anchor[:] = False
        anchor[both] = True
        begin = (np.cumsum(n_a) - n_a)[n_a > 0]
        anchor[start_a[begin]] = True
        at_a = np.flatnonzero(anchor[start_a])
        at_b = np.flatnonzero(anchor[np.minimum(start_b, len(anchor) - 1)] & (start_b < len(anchor)))
        size_a, size_b = np.diff(at_a, append=len(a)), np.diff(at_b, append=len(b))
        size = 1 + size_a + size_b
        base = np.cumsum(size) - size
        flat = np.empty(int(size.sum()), "<u4")
        flat[base] = size_a
        flat[ragged(base + 1, size_a)] = a
        flat[ragged(base + 1 + size_a, size_b)] = b
        n_w = np.diff(np.append(0, np.searchsorted(at_a, np.cumsum(n_a))))
        return n_w, cut_at(flat.view(np.uint8), 4 * np.append(base, len(flat)))


def ends_blank(word: bytes) -> bool:
    """Whether the last character may be white space."""
    last = word[-1]
    return last <= 32 or last == 127 or (last > 127 and (word[-2:-1] == b"\xc2" or word[-3:-2] in (b"\xe1", b"\xe2", b"\xe3")))


def word_starts(raw: np.ndarray, offsets: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Where words of texts begin: at their start, at blanks between what is surely no white space, at marks after letters.

    White space beyond ASCII begins with the bytes C2, E1, E2 or E3.
    """
    sure = (raw > 32) & (raw != 127)
    lead = sure & ~np.isin(raw, [0xC2, 0xE1, 0xE2, 0xE3])
    last = sure.copy()
    last[1:] &= raw[:-1] != 0xC2
    last[2:] &= ~np.isin(raw[:-2], [0xE1, 0xE2, 0xE3])
    out = np.zeros(len(raw), bool)
    out[1:-1] = (raw[1:-1] == 32) & last[:-2] & lead[2:]
    letter = LETTER[raw]
    letter[1:] |= (raw[:-1] == 0xC3) & LATIN[raw[1:]]
    out[1:] |= marks[raw[1:]] & letter[:-1]
    out[offsets[:-1]] = True
    return out


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(byte_bpe: str, piece_bpe: str) -> Aligner:
    """One per worker process and pair of vocabularies."""
    if (byte_bpe, piece_bpe) not in _aligners:
        _aligners[byte_bpe, piece_bpe] = Aligner(byte_bpe, piece_bpe)
    return _aligners[byte_bpe, piece_bpe]


def pair_counts(docs: DataFrame, byte_bpe: str, piece_bpe: str) -> DataFrame:
    """``pair, n``: how many links of all documents hold a pair of ids.

    ``pair`` is the first id times 2**32 plus the second. A task counts windows and sends
    each pair once, or once for each time its memory was full.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = aligner(byte_bpe, piece_bpe)
        seen = np.zeros(0, np.int64)
        for batch in batches:
            for _, n, *_, windows in one.windows(batch["text"]):
                if n:
                    if one.count > len(seen):
                        seen = np.append(seen, np.zeros(2 * one.count - len(seen), np.int64))
                    seen += np.bincount(windows, minlength=len(seen))
                else:
                    yield from send(one, seen)
                    seen = np.zeros(0, np.int64)
        yield from send(one, seen)

    def send(one: Aligner, seen: np.ndarray) -> Iterator[pa.RecordBatch]:
        windows = np.flatnonzero(seen)
        if len(windows):
            pairs, times = one.pairs_of(windows), np.repeat(seen[windows], one.links[windows])
            order = np.argsort(pairs, kind="stable")
            first = np.flatnonzero(np.diff(pairs[order], prepend=-1))
            sums = np.add.reduceat(times[order], first)
            for at in range(0, len(first), 10_000):
                part = slice(at, at + 10_000)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[order][first[part]]), pa.array(sums[part])], names=["pair", "n"])

    return texts(docs).select("text").mapInArrow(count, PAIRS).groupBy("pair").agg(F.sum("n").alias("n"))


def align(docs: DataFrame, byte_bpe: str, piece_bpe: str, sent_pairs: int = SENT_PAIRS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups`` of every text.

    The first tokenizer is a byte-level one, the second one of pieces, which puts a blank
    before the text; the first gets one, too. ``groups`` has the ids of tokens that cover
    the same bytes, as `a1,a2|b1;a3|b2`. Tokens that share a byte are linked. ``count_sum``
    adds up, for all links, how many links of all documents hold the same ids; ``n_best``
    counts the links than which no other first id has more with that second id. A null or
    empty text, and one whose bytes the tokens do not give back, has zeros and no groups.
    Rows with a null or a repeated doc_id are documents of their own; an empty table gives
    none.

    Two passes over the texts: one counts pairs of ids, whose number hangs on the
    vocabularies, the other sums them up. The counts of the ``sent_pairs`` most frequent
    pairs go to all tasks. If there are more, the links that hold rarer ones are written
    with the documents and their counts joined.
    """
    counts = staged(pair_counts(docs, byte_bpe, piece_bpe), "pairs")
    second = F.col("pair").bitwiseAND((1 << 32) - 1)
    top = counts.groupBy(second.alias("b")).agg(F.max("n").alias("top"))
    table = counts.withColumn("b", second).join(top, "b").select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    whole = counts.count() <= sent_pairs
    sent = (table if whole else table.orderBy(F.desc("n"), "pair").limit(sent_pairs)).toArrow()
    order = np.argsort(sent["pair"].to_numpy())
    packed = [sent["pair"].to_numpy()[order], sent["n"].to_numpy()[order], sent["best"].to_numpy()[order]]
    known = docs.sparkSession.sparkContext.broadcast(packed)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = aligner(byte_bpe, piece_bpe)
        for batch in batches:
            for first, n, n_a, n_b, n_w, windows in one.windows(batch["text"]):
                if n:
                    yield result(one, batch["doc_id"].slice(first, n), n_a, n_b, n_w, windows)

    def result(one: Aligner, ids: pa.Array, n_a: np.ndarray, n_b: np.ndarray, n_w: np.ndarray, windows: np.ndarray) -> pa.RecordBatch:
        pair, count, is_best = known.value
        used, place = np.unique(windows, return_inverse=True)
        own = one.pairs_of(used)
        at = np.minimum(np.searchsorted(pair, own), max(len(pair) - 1, 0))
        there = pair[at] == own if len(pair) else np.zeros(len(own), bool)
        at = at[there]
        sums, best = np.zeros(len(own), np.int64), np.zeros(len(own), np.int64)
        sums[there], best[there] = count[at], is_best[at]
        edge = np.append(0, np.cumsum(one.links[used]))

        def of_docs(per_window: np.ndarray) -> pa.Array:
            added = np.append(0, np.cumsum(per_window))[np.append(0, np.cumsum(n_w))]
            return pa.array(np.diff(added))

        def of_windows(per_pair: np.ndarray) -> np.ndarray:
            return np.diff(np.append(0, np.cumsum(per_pair))[edge])[place]

        parts = list(map(one.text.__getitem__, windows.tolist()))
        ends = np.cumsum(n_w).tolist()
        columns = [
            ids,
            pa.array(n_a, pa.int64()),
            pa.array(n_b, pa.int64()),
            of_docs(one.groups[windows]),
            of_docs(one.links[windows]),
            of_docs(of_windows(best)),
            of_docs(of_windows(sums)),
            pa.array([";".join(parts[a:b]) for a, b in zip([0, *ends], ends)], pa.string()),
            rare(own, there, edge, place, n_w, windows),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in ALIGNED.split(", ")])

    def rare(own: np.ndarray, there: np.ndarray, edge: np.ndarray, place: np.ndarray, n_w: np.ndarray, windows: np.ndarray) -> pa.Array:
        """Of each document the pairs that were not sent, with the number of their links."""
        kind = pa.list_(pa.struct([("pair", pa.int64()), ("n", pa.int64())]))
        if there.all():
            return pa.array([None] * len(n_w), kind)
        missing = np.add.reduceat(~there, edge[:-1], dtype=np.int64)
        doc = np.repeat(np.arange(len(n_w)), n_w)
        some = np.flatnonzero(missing[place])
        of = place[some]
        size = edge[of + 1] - edge[of]
        at = ragged(edge[of], size)
        out = ~there[at]
        docs_, pairs = np.repeat(doc[some], size)[out], own[at[out]]
        order = np.lexsort((pairs, docs_))
        docs_, pairs = docs_[order], pairs[order]
        new = np.ones(len(pairs), bool)
        new[1:] = (docs_[1:] != docs_[:-1]) | (pairs[1:] != pairs[:-1])
        cut = np.flatnonzero(new)
        fields = pa.StructArray.from_arrays([pa.array(pairs[cut]), pa.array(np.diff(cut, append=len(pairs)))], ["pair", "n"])
        ends = np.searchsorted(docs_[cut], np.arange(len(n_w) + 1))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), fields)

    found = texts(docs).mapInArrow(find, ALIGNED)
    if whole:
        return found.drop("rare")
    found = staged(found.withColumn("_row", F.monotonically_increasing_id()), "aligned")
    links = found.select("_row", F.inline("rare"))
    more = (
        links.join(table.withColumnRenamed("n", "count"), "pair")
        .groupBy("_row")
        .agg(F.sum(F.col("n") * F.col("count")).alias("more_sum"), F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("more_best"))
    )
    joined = found.join(more, "_row", "left")
    for name, extra in (("n_best", "more_best"), ("count_sum", "more_sum")):
        joined = joined.withColumn(name, F.col(name) + F.coalesce(extra, F.lit(0)))
    return joined.drop("_row", "rare", "more_sum", "more_best")

"""Simple-8b coding, token files against the tokenizer, and texts cut into words."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from kinloom.llm import queries, simple8b, token_files
from kinloom.llm.simple8b import blocks_of
from kinloom.llm.token_files import parts_of, read_tokens, window, write_tokens
from kinloom.llm.word_bpe import WordBpe

from .conftest import ODD, SF
from .test_operators import VOCABULARY


@pytest.mark.parametrize("seed", range(40))
def test_words_hold_what_was_put_in(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(0, 300, 8) if seed % 2 else rng.integers(0, 4, 40)
    n = int(lengths.sum())
    bits = rng.integers(0, 65, n)
    ids = rng.integers(0, 1 << 64, n, dtype=np.uint64) >> np.minimum(64 - bits, 63).astype(np.uint64)
    if seed % 3 == 0:
        ids = np.resize(np.repeat(ids[: n // 20 + 1], 40), n)
    blocks = blocks_of(lengths, int(rng.integers(1, 200)))
    words, counts = simple8b.encode(ids, blocks)
    assert counts.sum() == len(words) and blocks.sum() == n
    assert (simple8b.decode(words, counts, blocks) == ids).all()
    # Each block stands for itself.
    at, before = np.cumsum(counts) - counts, np.cumsum(blocks) - blocks
    for b in rng.integers(0, len(blocks), 3) if len(blocks) else []:
        part = simple8b.decode(words[at[b] : at[b] + counts[b]], counts[b : b + 1], blocks[b : b + 1])
        assert (part == ids[before[b] : before[b] + blocks[b]]).all()


def test_escapes_runs_and_room():
    ids = np.array([2**64 - 1, 2**60, 2**60 - 1, 7], np.uint64)
    words, _ = simple8b.encode(ids, np.array([4]))
    assert len(words) == 2 + 2 + 1 + 1 and (words >> np.uint64(60)).tolist() == [0, 0, 0, 0, 15, 4]
    words, _ = simple8b.encode(np.full(1000, 40_000, np.uint64), np.array([1000]))
    assert len(words) == 1 and int(words[0] >> np.uint64(60)) == 1
    words, _ = simple8b.encode(np.arange(60, dtype=np.uint64) % np.uint64(2), np.array([60]))
    assert len(words) == 1
    assert len(simple8b.encode(np.empty(0, np.uint64), np.empty(0, np.int64))[0]) == 0


TRICKY = ["a's don't≠x É̸.≠ é.!é's ×! ÷,x ß.", "a\x01b \x01 c", "x<|endoftext|>y <|EndOfText|> <|", "Á ́x İI ǅ", "a\tb\r\nc d　e", "日本語 テキスト " * 30, "\x00 \x1f", "Ａ K ſ. x.y,z!a"]


def test_words_have_the_ids_of_the_text(docs):
    encoder = WordBpe(VOCABULARY)
    encoder.words.memory_bytes = 200_000
    texts = [r.text for r in docs.select("text").limit(60).collect()] + TRICKY + [t[1] for t in ODD]
    for _ in range(2):
        got = []
        for _, ids, size in encoder.encoded(pa.array(texts), 9):
            got += [p.tolist() for p in np.split(ids, np.cumsum(size)[:-1])]
        assert got == [[*encoder.tokenizer.encode(t or "", add_special_tokens=False).ids, 9] for t in texts]
    assert list(encoder.encoded(pa.array([], pa.string()), 9)) == []


def plain_files(df, end):
    """Per document in order: doc_id, start, number and crc32 of its ids."""
    tokenizer = WordBpe(VOCABULARY).tokenizer
    start, out = 0, []
    rows = df.select("doc_id", "text").collect()
    for r in sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0)):
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, end], "<u4")
        out.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_token_files(spark, docs, make_docs):
    want = plain_files(docs, 1)
    assert sorted(map(tuple, queries.QUERIES["op11_token_files"](spark, SF).collect())) == want
    spread = docs.repartition(7)
    assert sorted(map(tuple, read_tokens(write_tokens(spread, VOCABULARY, 1)).collect())) == want
    assert read_tokens(write_tokens(make_docs([]), VOCABULARY, 1)).count() == 0


def test_token_files_of_odd_rows(make_docs):
    """Rows of one doc_id come in any order; all else is fixed, and nothing overlaps."""
    odd = make_docs(ODD + [(20 + i, t) for i, t in enumerate(TRICKY)] + [(None, "")] * 40).repartition(5)
    got = read_tokens(write_tokens(odd, VOCABULARY, 1)).collect()
    want = plain_files(odd, 1)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter((i, n, c) for i, _, n, c in want)
    in_order = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in in_order] == [i for i, *_ in want]
    assert [r.start for r in in_order] == [0, *np.cumsum([r.n_tokens for r in in_order])[:-1].tolist()]


def test_stripes_and_windows(docs, monkeypatch):
    monkeypatch.setattr(token_files, "STRIPE_IDS", 3000)
    stripes = write_tokens(docs.repartition(3), VOCABULARY, 1)
    rows = stripes.collect()
    assert len(rows) > 3
    row = max(rows, key=lambda r: max(r.lengths))
    lengths, offsets = np.array(row.lengths), np.array(row.offsets)
    words = np.frombuffer(bytes(row.words), "<u8")
    ids = token_files.decoded(words, offsets, lengths)
    document = int(lengths.argmax())
    own = ids[lengths[:document].sum() :][: lengths[document]]
    for a, b in ((0, 1), (1000, 1030), (5, len(own)), (len(own) - 1, len(own)), (7, 7)):
        assert (window(words, offsets, lengths, document, a, b) == own[a:b]).all()


def test_rows_of_a_frequent_id_are_dealt():
    ids, ties = np.array([1, 5, 5, 5, 5, 9, -3]), np.arange(7)
    assert parts_of(ids, ties, np.array([2, 5, 5, 5])).tolist() == [0, 2, 3, 1, 2, 4, 0]
    assert parts_of(ids, ties, np.array([], np.int64)).tolist() == [0] * 7

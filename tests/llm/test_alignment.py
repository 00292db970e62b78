"""Alignment of two tokenizers against a plain version."""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from kinloom.llm import queries
from kinloom.llm.alignment import Aligner, align, byte_level
from tokenizers import Tokenizer

from .conftest import ODD, SF
from .test_token_files import TRICKY

BYTES, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
SPACES = ["a.b..c!d's e'S é.x É!y ×.z ÷,q ß;ß", ".", "x.", "x. .y", "don't", "a▁.b", "x,\u3000y", "Zoë's.\n.", "  a  b \n c\t d", " \n x", "x ", "   ", "\n", "a b   c  d 　e", "▁ a ▁b", "a▁", "don't  stop  's", "x\x00y \x7f z", "ж ж щ", "a 　b", "<|endoftext|> x <s> </s> <unk> <0x41>"]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    names = {i: t for t, i in a.get_vocab().items()}
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES), names


def plain_tokens(tokenizers, text):
    """Ids and bytes of both."""
    a, b, names = tokenizers
    if not text:
        return [], [], [], []
    to_byte = byte_level()
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    bytes_a = [bytes(to_byte[c] for c in names[i]) for i in ids_a]
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    if any(b"".join(x) != (" " + text).encode() for x in (bytes_a, bytes_b)):
        return [], [], [], []
    return ids_a, ids_b, bytes_a, bytes_b


def plain(tokenizers, rows):
    counts, docs = Counter(), []
    for number, text in rows:
        a, b, bytes_a, bytes_b = plain_tokens(tokenizers, text)
        span_a, span_b = ([(e - len(x), e) for x, e in zip(p, np.cumsum([len(x) for x in p]).tolist())] for p in (bytes_a, bytes_b))
        links, j = [], 0
        for i, (s, e) in enumerate(span_a):
            while span_b[j][1] <= s:
                j += 1
            k = j
            while k < len(b) and span_b[k][0] < e:
                links.append((a[i], b[k]))
                k += 1
        cuts = sorted({e for _, e in span_a} & {e for _, e in span_b})
        held = [([], []) for _ in cuts]
        for side, (ids, span) in enumerate(((a, span_a), (b, span_b))):
            for token, (_, e) in zip(ids, span):
                held[bisect_left(cuts, e)][side].append(str(token))
        groups = [f"{','.join(x)}|{','.join(y)}" for x, y in held]
        counts.update(links)
        docs.append((number, len(a), len(b), len(groups), links, ";".join(groups)))
    top = Counter()
    for (_, b), n in counts.items():
        top[b] = max(top[b], n)
    return Counter((i, a, b, g, len(x), sum(counts[p] == top[p[1]] for p in x), sum(counts[p] for p in x), t) for i, a, b, g, x, t in docs)


@pytest.mark.parametrize("sent", [10**6, 300, 0])
def test_odd_rows(make_docs, tokenizers, sent):
    """Whether all counts are sent to the tasks, some or none."""
    odd = make_docs([*ODD, *((100 + i, t) for i, t in enumerate(TRICKY + SPACES))]).repartition(3)
    want = plain(tokenizers, odd.select("doc_id", "text").collect())
    assert Counter(map(tuple, align(odd, BYTES, PIECES, sent).collect())) == want


def test_query(spark, docs, tokenizers):
    got = {r.doc_id: r for r in queries.QUERIES["op13_alignment"](spark, SF).collect()}
    want = {r[0]: r for r in plain(tokenizers, docs.select("doc_id", "text").collect())}
    assert got.keys() == want.keys()
    for i, r in want.items():
        assert tuple(got[i])[:7] == r[:7]
        assert got[i].groups_sha256 == (hashlib.sha256(r[7].encode()).hexdigest() if r[7] else "")


def test_empty_table(make_docs):
    assert align(make_docs([]), BYTES, PIECES).count() == 0
    assert [r.n_links for r in align(make_docs([(1, None), (2, "")]), BYTES, PIECES).collect()] == [0, 0]


def test_memory_is_bounded_and_words_have_the_ids_of_the_text(docs, tokenizers, monkeypatch):
    import kinloom.llm.alignment as module

    monkeypatch.setattr(module, "WINDOWS_BYTES", 100_000)
    one = Aligner(BYTES, PIECES)
    one.words.memory_bytes = 100_000
    texts = [r.text for r in docs.select("text").limit(80).collect()] + TRICKY + SPACES
    for at in range(0, len(texts), 10):
        some = texts[at : at + 10]
        for first, n, n_a, n_b, n_w, windows in one.windows(pa.array(some)):
            for i in range(n):
                a, b, *_ = plain_tokens(tokenizers, some[first + i])
                assert (n_a[i], n_b[i]) == (len(a), len(b))
            assert len(windows) == n_w.sum()
    assert one.held < 400_000

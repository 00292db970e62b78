"""The pipeline as a whole."""

from __future__ import annotations

import os

import corpus_pipeline
import numpy as np
import pytest
from kinloom.llm import shingle_join, simhash
from kinloom.llm.common import documents
from kinloom.session import staged

from .conftest import ODD, SF


def test_stages(spark):
    docs = before = documents(spark, SF)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = staged(stage(spark, docs, SF), "test")
        assert after.columns == before.columns, name
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        kept = {r.doc_id for r in after.select("doc_id").collect()}
        assert kept and kept <= ids, name
        assert (kept == ids) == (name == "line dedup"), name
        docs = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in docs.collect()}


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    again = corpus_pipeline.run(spark, SF).collect()
    facts = lambda rows: sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in rows)
    assert rows and facts(rows) == facts(again)


def plain_shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_kept(rows):
    """Ids that stay, all pairs measured; of different ids."""
    sets = [(i, plain_shingles(t)) for i, t in rows]
    label = {i: i for i, _ in rows}
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a == b or (a and b and len(a & b) >= 0.8 * len(a | b) - 1e-9):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = {k: new if v == old else v for k, v in label.items()}
    return {i for i, v in label.items() if i == v}


def test_near_duplicates_against_all_pairs(spark, make_docs):
    """Reworded copies from 0.7 to 1, a crowd around one text, and texts of a few words."""
    rng = np.random.default_rng(12)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for base in range(24):
        words = rng.choice(vocabulary, rng.integers(3, 120)).tolist()
        for copy in range(60 if base == 0 else 6):
            new = list(words)
            for at in rng.integers(0, len(new), rng.integers(0, 1 + len(new) // 30) if copy else 0):
                new[at] = f"x{rng.integers(0, 1000)}"
            rows.append((len(rows), " ".join(new)))
    rows += [(len(rows) + i, t) for i, t in enumerate(["", None, " ", "A b", "a  B", "a b c d e f g h i", "b c d e f g h i j"])]
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, make_docs(rows), SF).collect()}
    assert kept == plain_kept(rows)
    assert 24 < len(kept) < len(rows) // 2


@pytest.mark.parametrize("direct", [0, 1_000_000])
def test_groups_with_and_without_stars(spark, make_docs, direct, monkeypatch):
    """A crowd of near copies that share all keys, one of unlike texts that share a passage, and chains."""
    rounds = []
    monkeypatch.setattr(shingle_join, "connected", lambda links, f=shingle_join.connected: rounds.append(1) or f(links))
    rng = np.random.default_rng(13)
    vocabulary = [f"w{i}" for i in range(500)]
    rows, words = [], rng.choice(vocabulary, 90).tolist()
    for _ in range(70):
        new = list(words)
        new[rng.integers(0, 90)] = f"x{rng.integers(0, 1000)}"
        rows.append((len(rows), " ".join(new)))
    for _ in range(8):
        rows.append((len(rows), " ".join([*rng.choice(vocabulary, 40), *words[:30], *rng.choice(vocabulary, 40)])))
    for step in range(12):
        rows.append((len(rows), " ".join([*words[:8], *(f"c{i}" for i in range(2 * step, 2 * step + 90))])))
    rows.append((len(rows), None))
    got = {r.doc_id: r.component_id for r in shingle_join.shingle_groups(make_docs(rows), direct=direct).collect()}
    assert {i for i, c in got.items() if i == c} == plain_kept(rows)
    assert len({got[i] for i in range(70)}) == 1 and len({got[i] for i in range(78, 90)}) == 1
    assert (len(rounds) > 1) == (direct == 0)


def test_fingerprints_come_first(spark, make_docs, monkeypatch):
    """Vantage-point trees give candidates; those that are alike link, and keys find the links they miss."""
    calls, met, links = [], [], simhash.fingerprint_links
    monkeypatch.setattr(simhash, "fingerprint_links", lambda points, bits: calls.append(bits) or links(points, bits))
    pairs = simhash.fingerprint_pairs
    monkeypatch.setattr(simhash, "fingerprint_pairs", lambda points, bits: met.append(points) or pairs(points, bits))
    rng = np.random.default_rng(14)
    rows = []
    for _ in range(20):
        words = [f"w{i}" for i in rng.integers(0, 5000, 300)]
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join([*words[:-1], "end"])), (len(rows) + 2, " ".join([*words[:-24], *(f"y{i}" for i in rng.integers(0, 5000, 24))]))]
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, make_docs(rows), SF).collect()}
    assert kept == plain_kept(rows) and calls == [4] and len(met) == 1
    points = [(r.node, r.size, r.fp) for r in met[0].collect()]
    node = {i: shingle_join.name_of(shingle_join.shingles(t)) for i, t in rows}
    assert {n for n, _, _ in points} == set(node.values())
    fp = {n: f for n, _, f in points}
    bits = {i: (fp[node[i]] ^ fp[node[j]]) & (1 << 64) - 1 for i in range(0, 60, 3) for j in (i + 1,)}
    label = {n: n for n in node.values()}
    for r in pairs(met[0], 4).collect():
        old, new = label[r.a], label[r.b]
        label = {n: new if v == old else v for n, v in label.items()}
    close = [i for i, x in bits.items() if x.bit_count() <= 4]
    assert close and all(label[node[i]] == label[node[i + 1]] for i in close)
    assert any(label[node[i]] != label[node[i + 2]] for i in range(0, 60, 3))


def test_keys_of_the_same_texts_are_one(spark):
    """The shingles of a passage that the same texts share make their pairs once, with their number."""
    held = {1: (7, 8, 9), 2: (7, 8, 9), 3: (9, 8, 7), 4: (7, 8), 5: (8, 9), 6: (7, 8)}
    rows = spark.createDataFrame([(k, n, 10 * n) for k, nodes in held.items() for n in nodes], "key long, node long, size int")
    got = sorted(map(tuple, shingle_join.distinct_keys(rows).collect()))
    assert got == sorted([(1, n, 10 * n, 3) for n in (7, 8, 9)] + [(4, n, 10 * n, 2) for n in (7, 8)] + [(5, n, 10 * n, 1) for n in (8, 9)])


@pytest.mark.parametrize("direct", [0, 1_000_000])
def test_near_duplicates_leave_only_what_the_result_reads(spark, make_docs, direct, monkeypatch):
    """Tables of the steps go with them; stars of unlike texts that share a passage are not verified."""
    counted, f = [], shingle_join.staged
    monkeypatch.setattr(shingle_join, "staged", lambda df, label, **o: counted.append((label, (out := f(df, label, **o)).count())) or out)
    passage = [f"p{i}" for i in range(60)]
    texts = [" ".join([*passage[: 50 + i % 8], *(f"t{i}-{j}" for j in range(8))]) for i in range(40)]
    texts += [f"{text} end" for text in texts[:5]]
    root = f"{spark.conf.get('spark.checkpoint.dir').removeprefix('file://')}/kinloom"
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    groups = shingle_join.shingle_groups(make_docs(list(enumerate(texts))), direct=direct)
    left = sorted(name.split("-")[0] for name in set(os.listdir(root)) - before)
    assert left == ["labels", "points", "shingles"]
    got = {r.doc_id: r.component_id for r in groups.collect()}
    assert {i for i, c in got.items() if i == c} == plain_kept(list(enumerate(texts)))
    assert ("stars" in dict(counted)) == (direct == 0)


def test_fingerprint_of_a_set():
    found = shingle_join.shingles("a b c d e f g")
    counts = [sum(int(s) >> b & 1 for s in found) for b in range(64)]
    assert shingle_join.set_fingerprint(found) == sum(1 << b for b in range(64) if 2 * counts[b] > len(found))
    assert shingle_join.set_fingerprint(found[:0]) == 0


def test_near_duplicates_of_odd_rows(spark, make_docs):
    kept = corpus_pipeline.near_duplicates(spark, make_docs(ODD), SF)
    assert kept.columns == make_docs(ODD).columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(8) == 3 and ids.count(None) == 2 and 6 in ids and 7 not in ids and 2 not in ids
    assert corpus_pipeline.near_duplicates(spark, make_docs([]), SF).count() == 0

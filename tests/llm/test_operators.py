"""Each operator against a plain version, and on odd rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from check import compare, connect
from kinloom.llm import mixing, queries, secret_scan
from kinloom.llm.components import connected
from kinloom.llm.crf_quality import Chain, accepted, fit, line_features, quality_scores, train
from kinloom.llm.kd_topk import KDTree, top_k
from kinloom.llm.lattice_dedup import near_duplicates, nearest_e8
from kinloom.llm.line_dedup import dedup_lines, without_repeats
from kinloom.llm.packing import best_fit_packing, token_pieces
from kinloom.llm.sharding import fill_table, place_documents
from kinloom.llm.simhash import keep_one, simhash_groups
from kinloom.llm.suffix_dedup import remove_repeats
from pyspark.sql import functions as F

from .conftest import ODD, SF

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def rows_of(df):
    return [r.asDict(recursive=True) for r in df.collect()]


class Sets:
    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_oracles(spark, name):
    assert compare(spark, connect(SF), SF, name) == ""


def test_connected(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(1000 + i, 1001 + i) for i in range(60)]
    sets = Sets({x for e in edges for x in e})
    for a, b in edges:
        sets.join(a, b)
    got = {r.node: r.label for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    groups, want = defaultdict(set), defaultdict(set)
    for node, label in got.items():
        groups[label].add(node)
    for x in got:
        want[sets.find(x)].add(x)
    assert set(got) == {x for a, b in edges if a != b for x in (a, b)}
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
    assert connected(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


# 1


def plain_repeats(texts, length):
    """texts: sorted (id, bytes); which bytes go."""
    first, out = {}, []
    for number, body in texts:
        gone = np.zeros(len(body), bool)
        for i in range(len(body) - length + 1):
            s = body[i : i + length]
            if first.setdefault(s, (number, i)) != (number, i):
                gone[i : i + length] = True
        out.append(gone)
    return out


def check_repeats(df, length, **options):
    got = sorted(rows_of(remove_repeats(df, length, **options)), key=lambda r: r["doc_id"])
    texts = sorted((r.doc_id, (r.text or "").encode()) for r in df.select("doc_id", "text").collect())
    for row, (number, body), gone in zip(got, texts, plain_repeats(texts, length), strict=True):
        turns = np.flatnonzero(np.diff(gone, prepend=False, append=False)).reshape(-1, 2)
        assert (row["doc_id"], row["n_bytes"]) == (number, len(body))
        assert [(s["start"], s["stop"]) for s in row["spans"]] == [tuple(t) for t in turns.tolist()]
        assert bytes(row["kept"]) == np.frombuffer(body, np.uint8)[~gone].tobytes()


def test_repeats(docs):
    check_repeats(docs, 100)


@pytest.mark.parametrize("hot", [(32, 2048), (1, 2048), (32, 1), (1, 1)])
def test_repeats_of_few_letters(spark, make_docs, monkeypatch, hot):
    """Many repeats of all kinds, with every way to settle a hot string."""
    import kinloom.llm.suffix_dedup as module

    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abc"), 5)) for _ in range(6)]
    texts = ["".join(rng.choice(words, rng.integers(0, 40))) for _ in range(60)] + ["a" * 60, "a" * 61, "ab" * 40]
    texts += [texts[5], texts[7] + "q" + texts[8], texts[7][3:70]]
    monkeypatch.setattr(module, "HOT_BATCH", hot[0])
    monkeypatch.setattr(module, "HOT_ALL", hot[1])
    monkeypatch.setattr(module, "FLUSH", 40)
    check_repeats(make_docs(list(enumerate(texts))), 20, k=6)


def test_repeats_of_odd_rows(make_docs):
    got = rows_of(remove_repeats(make_docs(ODD)))
    assert len(got) == len(ODD)
    by = defaultdict(list)
    for row in got:
        by[row["doc_id"]].append(row)
    assert [s["start"] for s in by[7][0]["spans"]] == [0] and by[7][0]["kept"] == b""
    assert by[1][0]["n_bytes"] == 0 and by[1][0]["spans"] == []
    assert by[10][0]["spans"] == [{"start": 1, "stop": 500}]
    assert {r["n_bytes"] for r in by[8]} == {8, 24}
    assert remove_repeats(make_docs([])).count() == 0


# 2


def test_raking_meets_targets(spark, docs):
    rows = mixing.with_cell(docs)
    cells = mixing.cells_of(rows)
    targets = {d: mixing.tempered(cells, d, 0.5) for d in mixing.DIMENSIONS}
    raked = mixing.rake(cells, targets, 30)
    total = cells.agg(F.sum("tokens")).first()[0]
    for d, target in targets.items():
        got = raked.groupBy(F.col(d).alias("value")).agg((F.sum(F.col("tokens") * F.col("ratio")) / total).alias("got"))
        for r in got.join(target, "value").collect():
            assert r.got == pytest.approx(r.share, abs=5e-3)
    chances = [r.probability for r in mixing.probabilities(raked).collect()]
    assert max(chances) == pytest.approx(1) and min(chances) > 0


def test_mixing_of_odd_rows(make_docs):
    df = make_docs(ODD)
    got = mixing.mix(df)
    assert got.count() == len(ODD) and got.where("probability is null or sampled is null").count() == 0
    kept = mixing.sample(df)
    assert kept.columns == df.columns and 0 < kept.count() <= len(ODD)
    assert mixing.mix(make_docs([])).count() == 0 and mixing.sample(make_docs([])).count() == 0


# 3


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", text.encode().lower())
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def check_simhash(df):
    got = {(r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash_groups(df).collect()}
    rows = [(r.doc_id, plain_fingerprint(r.text or "")) for r in df.select("doc_id", "text").collect()]
    sets = Sets({fp for _, fp in rows})
    points = sorted(sets.up)
    for i, a in enumerate(points):
        for b in points[:i]:
            if (a ^ b).bit_count() <= 4:
                sets.join(a, b)
    least = {}
    for number, fp in rows:
        if number is not None:
            least[sets.find(fp)] = min(number, least.get(sets.find(fp), number))
    assert got == {(n, fp, least.get(sets.find(fp))) for n, fp in rows}


def test_simhash(docs, make_docs):
    check_simhash(docs)
    check_simhash(make_docs(ODD))
    assert simhash_groups(make_docs([])).count() == 0


def test_vantage_points_find_all(spark):
    """Crowded fingerprints over many shards."""
    from kinloom.llm.simhash import fingerprint_links

    rng = np.random.default_rng(2)
    seeds = rng.integers(0, 1 << 62, 40)
    points = {int(s) for s in seeds}
    for s in seeds:
        for _ in range(20):
            points.add(int(s) ^ sum(1 << int(b) for b in set(rng.integers(0, 62, rng.integers(1, 6)).tolist())))
    df = spark.createDataFrame([(p,) for p in points], "fp long")
    links = connected(fingerprint_links(df, 4, shard_rows=50, sample_rows=200))
    sets = Sets(points)
    every = sorted(points)
    for i, a in enumerate(every):
        for b in every[:i]:
            if (a ^ b).bit_count() <= 4:
                sets.join(a, b)
    got = {r.node: r.label for r in links.collect()}
    labels = defaultdict(set)
    for p in points:
        labels[sets.find(p)].add(got.get(p, p))
    assert all(len(x) == 1 for x in labels.values()) and len({next(iter(x)) for x in labels.values()}) == len(labels)


def test_keep_one(make_docs):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "quite another text is here"), (None, "a b c d e f g")]
    kept = keep_one(make_docs(rows))
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "None"]


# 4


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_near_lines(make_docs):
    """All kinds of one edit at all places, against all earlier lines."""
    rng = np.random.default_rng(4)
    lines = ["".join(rng.choice(list("ab "), n)).strip() for n in (19, 20, 21, 22, 40, 75)]
    made = []
    for line in lines:
        made.append(line)
        for i in range(0, len(line), 3):
            kind = rng.integers(0, 4)
            new = rng.choice(list("abc"))
            made.append([line[:i] + line[i + 1 :], line[:i] + new + line[i + 1 :], line[:i] + new + line[i:], new + line[:i] + line[i + 2 :]][kind])
    order = rng.permutation(len(made))
    rows = [(int(i), made[o] + "\n\n" + made[o // 2]) for i, o in enumerate(order)]
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in dedup_lines(make_docs(rows)).collect()}
    seen = []
    for number, text in rows:
        kept = []
        for line in text.split("\n"):
            s = line.strip(" ")
            near = any(s == t or (min(len(s), len(t)) >= 20 and abs(len(s) - len(t)) < 2 and edits(s, t) <= 1) for t in seen)
            if not s or not near:
                kept.append(line)
            if s:
                seen.append(s)
        assert got[number] == (text.count("\n") + 1, text.count("\n") + 1 - len(kept), "\n".join(kept)), number


def test_lines_of_odd_rows(make_docs):
    df = make_docs(ODD)
    by = defaultdict(list)
    for r in dedup_lines(df).collect():
        by[r.doc_id].append(r)
    assert sum(map(len, by.values())) == len(ODD)
    assert by[3][0].n_removed == 1 and by[4][0].n_removed == 1 and by[7][0].text == "" and by[1][0].n_lines == 1
    assert sorted(r.text for r in by[8]) == ["other row of the same id", "same row", "same row"]
    kept = without_repeats(df)
    assert kept.columns == df.columns
    rows = {r.doc_id: r for r in kept.collect()}
    assert rows[7].text == "" and rows[7].n_chars == 0 and rows[9].text is None and rows[3].spans == "x"
    assert dedup_lines(make_docs([])).count() == 0


# 5


def test_lookup_table():
    shards = {f"s{i}": 1 for i in range(7)}
    table = fill_table(shards, 1009)
    counts = Counter(table)
    assert max(counts.values()) - min(counts.values()) <= 1 and len(counts) == 7
    fewer = fill_table({s: 1 for s in shards if s != "s3"}, 1009)
    moved = sum(a != b for a, b in zip(table, fewer) if a != "s3")
    assert moved < 0.25 * 1009
    double = Counter(fill_table({"a": 2, "b": 1, "c": 0}, 1009))
    assert abs(double["a"] - 2 * double["b"]) <= 2 and "c" not in double
    with pytest.raises(ValueError):
        fill_table(shards, 1000)
    with pytest.raises(ValueError):
        fill_table({}, 1009)


def test_placement(docs, make_docs):
    table = fill_table(queries.SHARDS)
    for r in place_documents(docs, queries.SHARDS).collect():
        slot = xxhash.xxh64_intdigest(str(r.doc_id).encode(), 42)
        slot = (slot - (1 << 64) if slot >> 63 else slot) % 65537
        assert (r.slot, r.shard) == (slot, table[slot])
    odd = place_documents(make_docs(ODD), queries.SHARDS)
    assert odd.count() == len(ODD) and odd.where("doc_id = 8").select("shard").distinct().count() == 1
    assert place_documents(make_docs([]), queries.SHARDS).count() == 0


# 6


def test_marginals_against_all_labelings():
    rng = np.random.default_rng(5)
    features, size = line_features("One line.\nTWO!! LINES!!\n\nand and and one more")
    chain = Chain(rng.normal(size=features.shape[1]), rng.normal(size=(2, 2)))
    logits = features @ chain.weights
    n, total, good = len(features), 0.0, np.zeros(len(features))
    for code in range(1 << n):
        y = [code >> i & 1 for i in range(n)]
        weight = np.exp(sum(logits[i] * y[i] for i in range(n)) + sum(chain.steps[a, b] for a, b in zip(y, y[1:])))
        total += weight
        good += weight * np.array(y)
    assert chain.marginals(features) == pytest.approx(good / total)


def test_training_needs_both_labels():
    features = [line_features("a line")[0]]
    assert fit(features, np.array([1])).score("anything") == pytest.approx(0.5)
    assert fit([], np.array([])).score("") == pytest.approx(0.5)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scored = quality_scores(docs, train(docs, labels))
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 40
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95


def test_quality_of_odd_rows(spark, make_docs):
    df = make_docs(ODD)
    labels = spark.createDataFrame([(1, 0, 0), (3, 1, 0), (6, 0, None), (6, 1, 0), (None, 1, 1), (7, None, 0)], "doc_id long, quality int, toxic int")
    chain = train(df, labels)
    rows = quality_scores(df, chain).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert accepted(df, chain).columns == df.columns
    assert quality_scores(make_docs([]), train(make_docs([]), labels.limit(0))).count() == 0


def test_training_reads_whole_texts(spark, make_docs):
    """Good and bad documents open with the same 300 lines; only what follows tells them apart."""
    good = [f"This is a quiet line of plain prose, the {w} of many in the text." for w in ("first", "second", "third")] * 100
    ids = [i for i in range(1, 40) if zlib.crc32(str(i).encode()) % 5]
    made = [(i, "\n".join(good + (["$$$ 9999 ### 1234 !!!! 5678"] * 300 if i % 2 else good))) for i in ids]
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in ids], "doc_id long, quality int")
    df = make_docs(made)
    rows = quality_scores(df, train(df, labels)).collect()
    assert all(r.predicted == 1 - r.doc_id % 2 for r in rows)


# 7


def plain_top(vectors, k, every):
    ints = {i: np.floor(256 * np.array(v, float)).astype(object) for i, v in vectors.items()}
    for q in sorted(ints):
        if q % every == 0:
            scores = sorted((-int((ints[q] * v).sum()), i) for i, v in ints.items() if i != q)[:k]
            yield from ((q, r, i, -s) for r, (s, i) in enumerate(scores, 1))


def test_top_k(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    vectors = {r.vec_id: r.embedding for r in df.collect()}
    got = top_k(df, F.col("vec_id") % 50 == 0, shard_rows=60, block_rows=4)
    assert sorted(map(tuple, got.collect())) == list(plain_top(vectors, 5, 50))


def test_top_k_of_odd_rows(spark):
    rng = np.random.default_rng(6)
    good = {i: rng.integers(-2, 3, 3).astype(float).tolist() for i in range(40)} | {40: [30000.5, -29999.0, 1.0]}
    bad = [(41, None), (42, [1.0, None, 0.0]), (43, [float("nan"), 0.0, 0.0]), (44, [float("inf"), 0.0, 1.0]), (None, [1.0, 1.0, 1.0]), (3, good[3])]
    df = spark.createDataFrame([*good.items(), *bad], "vec_id long, embedding array<double>").withColumn("v", F.lit("clash"))
    got = top_k(df, F.col("vec_id") % 10 == 0, shard_rows=9)
    assert sorted(map(tuple, got.collect())) == list(plain_top(good, 5, 10))
    few = df.where("vec_id in (10, 11)")
    assert [tuple(r)[:3] for r in top_k(few, F.col("vec_id") == 10).collect()] == [(10, 1, 11)]
    assert top_k(df.limit(0), F.lit(True)).count() == 0


def test_top_k_of_large_and_repeated_rows(spark):
    """Large components count, and rows of one id with different vectors are rows of their own."""
    rows = [(0, [1.0]), (1, [600000.0]), (2, [2.0]), (2, [3.0])]
    got = top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 0)
    assert sorted(map(tuple, got.collect())) == [(0, 1, 1, 256 * 256 * 600000), (0, 2, 2, 196608), (0, 3, 2, 131072)]
    got = top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 2)
    assert sorted(map(tuple, got.where("rank < 3").select("query_id", "rank", "vec_id").collect())) == [(2, 1, 1), (2, 1, 1), (2, 2, 2), (2, 2, 2)]


def test_bounds_are_above_all_products():
    rng = np.random.default_rng(17)
    for _ in range(300):
        row = rng.integers(-(1 << 27), 1 << 27, (1, 64))
        query = rng.integers(-(1 << 27), 1 << 27, 64)
        query[63] = -sum(int(a) * int(b) for a, b in zip(query[:63], row[0])) // max(int(row[0][63]), 1)
        query[63] = np.clip(query[63], -(1 << 27), 1 << 27)
        tree = KDTree(np.array([1]), np.array([1]), row)
        assert tree.bounds(query[None].astype(float))[0, 0] >= sum(int(a) * int(b) for a, b in zip(query, row[0]))


# 8


def plain_spans(text):
    found = []
    for number, rule in enumerate(secret_scan.RULES):
        for m in re.finditer(rule.pattern, text):
            if len(m.group(rule.group)) >= rule.least:
                found.append((m.start(), number, m.end(), rule.kind))
    return sorted(found)


def test_trigram_queries():
    queries_of = {r.kind: secret_scan.trigram_query(r.pattern) for r in secret_scan.RULES}
    assert queries_of["hex"] == [] and queries_of["access"] == [[frozenset({"aki", "kia"})]]
    (clause,) = queries_of["assign"]
    assert frozenset({"tok", "oke", "ken"}) in clause and frozenset({"api", "pik", "ike", "key"}) in clause
    assert secret_scan.trigram_query("ab+cde") == [[frozenset({"cde"})]]
    assert secret_scan.trigram_query("x(abc|de)y") == [[frozenset({"xab", "abc", "bcy"}), frozenset({"xde", "dey"})]]


def test_secrets(docs, make_docs):
    tricky = [
        (100, 'é PASSWORD = "abc" token: abcdefg, secret=token : abcdefgh apikey=\'A+/=._-x\' api_key:short'),
        (101, "AKIA" + "Z9" * 8 + " AKIAAKIA" + "B" * 12 + " AKIA1234 " + "deadbeef" * 4 + "x" + "0" * 23),
        (102, "ghp_" + "a1" * 18 + "\n-----BEGIN RSA PRIVATE KEY-----\ntoken=" + "f" * 30),
    ]
    for df in (docs, make_docs(ODD + tricky)):
        got = Counter((r.doc_id, str([tuple(s) for s in r.spans])) for r in secret_scan.scan_secrets(df).collect())
        want = Counter((r.doc_id, str(plain_spans(r.text or ""))) for r in df.select("doc_id", "text").collect())
        assert got == want
    row = secret_scan.digest(secret_scan.scan_secrets(make_docs([(1, "token=abcdef")]))).first()
    assert row.base_sha256 == hashlib.sha256(b"assign:0:12").hexdigest() and row.spans == "assign:0:12" and row.n_assign == 1
    assert secret_scan.scan_secrets(make_docs([])).count() == 0


# 9


def test_nearest_lattice_points():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 8)) * 2
    points = nearest_e8(x)
    whole = (points == np.rint(points)).all(1)
    half = (points - 0.5 == np.rint(points - 0.5)).all(1)
    assert (whole | half).all() and (np.rint(points.sum(1)) % 2 == 0).all()
    assert (((x - points) ** 2).sum(1) <= 1 + 1e-9).all()  # the covering radius of E8


def plain_links(vectors, threshold):
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in vectors.items()}
    ids = sorted(unit)
    m = np.array([unit[i] for i in ids])
    a, b = np.nonzero(m @ m.T >= threshold)
    return {(ids[i], ids[j]) for i, j in zip(a.tolist(), b.tolist()) if i < j}


def test_lattice_recall_and_groups(spark):
    rng = np.random.default_rng(8)
    vectors = {}
    for c in range(150):
        centre = rng.normal(size=64)
        for _ in range(6):
            vectors[len(vectors)] = (centre + rng.normal(size=64) * rng.uniform(0, 0.3)).tolist()
    links = plain_links(vectors, 0.95)
    near_limit = plain_links(vectors, 0.95) - plain_links(vectors, 0.96)
    assert len(links) > 500 and len(near_limit) > 50
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in near_duplicates(df, cell_rows=20).collect()}
    degree = Counter(x for pair in links for x in pair)
    assert all(got[i].n_links <= degree[i] for i in vectors)
    assert sum(r.n_links for r in got.values()) >= 0.98 * 2 * len(links)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_lattice_of_odd_rows(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [5e200, 1e190]), (4, [0.0, 0.0]), (5, None), (6, [1.0, None]), (7, [float("nan"), 1.0]), (8, [0.0, 1.0, 0.0]), (9, [0.0, -1.0]), (None, [1.0, 0.0]), (2, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("class", F.lit(1))
    got = Counter((r.vec_id, r.n_links, r.component_id, r.kept) for r in near_duplicates(df).collect())
    alone = [(i, 0, i, True) for i in (4, 5, 6, 7, 8, 9)]
    assert got == Counter([(1, 4, 1, True), (2, 4, 1, False), (2, 4, 1, False), (3, 4, 1, False), (None, 4, 1, False), *alone])
    assert near_duplicates(df.limit(0)).count() == 0


# 10


def check_packing(df, packed, capacity):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(VOCABULARY)
    want = Counter()
    for r in df.select("doc_id", "text").collect():
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        for start in range(0, len(ids), capacity):
            part = ids[start : start + capacity]
            want[r.doc_id, start // capacity, start, len(part), zlib.crc32(part.tobytes())] += 1
    rows = packed.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences), sum(r.length for r in rows) / capacity


def test_packing(docs, make_docs):
    used, least = check_packing(docs, best_fit_packing(token_pieces(docs, VOCABULARY)), 2048)
    assert used <= least * 1.02 + 1
    used, least = check_packing(docs, best_fit_packing(token_pieces(docs, VOCABULARY, 300), 300, slack=0, group_rows=100, fan_in=2), 300)
    assert used <= least * 1.03 + 1
    odd = make_docs(ODD)
    check_packing(odd, best_fit_packing(token_pieces(odd, VOCABULARY)), 2048)
    assert best_fit_packing(token_pieces(make_docs([]), VOCABULARY)).count() == 0


def test_packing_of_what_cannot_be_joined(spark):
    """Pieces over half a sequence stay alone, and never meet in one task."""
    pieces = spark.range(5_000).selectExpr("id AS doc_id", "0 AS piece", "0L AS start", "60L AS length", "0L AS ids_crc32")
    packed = best_fit_packing(pieces, 100, group_rows=100, fan_in=2)
    assert packed.select("sequence_id").distinct().count() == 5_000

"""Removal of repeated byte strings by prefix doubling over sampled positions.

A suffix array ranks all positions by their first byte, then by pairs of ranks at
growing offsets, and drops a position once its rank is unique. Here the ranks are
names (hashes) of the strings, the first length is already long, and only sampled
positions are ranked, of which every string of ``length`` bytes holds one:

1. In every window of ``length`` bytes the string of ``k`` bytes with the least hash is
   its anchor; equal windows have the same anchor in the same place. About one position
   in 35 is an anchor. Anchors are ranked by their ``k`` bytes. One whose rank is unique
   drops out, for none of its windows can repeat.
2. The others are ranked again together with all bytes that their windows reach on
   both sides. Where that rank repeats, all windows but those of the earliest anchor do.
3. What is left (an anchor that repeats among neighbours that do not) is ranked for
   each of its windows of ``length`` bytes, the threshold.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinloom.llm.common import partitions
from kinloom.llm.line_dedup import LEAST_ID, keyed

_U = np.uint64
_ODD = 0x9E3779B97F4A7C15
_random = np.random.default_rng(100)
TABLES = [_random.integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1) for _ in range(2)]
#: Anchors are gathered up to this number before they are sent.
FLUSH = 1_000_000
#: An anchor string with more different neighbourhoods in one batch, or in all, is hot:
#: its windows are ranked one by one in many tasks instead of together in one.
HOT_BATCH, HOT_ALL = 32, 2_048
ENTRY = np.dtype([("key", "<u8"), ("around", "<u8"), ("doc", "<i4"), ("at", "<i4"), ("first", "<i2"), ("last", "<i2")])
FOUND = "_id long, _t long, open boolean, v long"


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    base, inverse = _U(_ODD), _U(pow(_ODD, -1, 1 << 64))
    return np.cumprod(np.r_[_U(1), np.full(n, base)]), np.cumprod(np.r_[_U(1), np.full(n, inverse)])


_cache: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse, modulo 2**64."""
    if not _cache or len(_cache[0]) <= n:
        _cache[:] = _powers(max(n, 1 << 16))
    return _cache[0], _cache[1]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def anchors(raw: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """Name, name of the neighbourhood, place, and the first and last window start of each anchor."""
    n, width = len(raw), length - k + 1
    up, down = powers(n)
    sums = np.zeros(n + 1, _U)
    np.cumsum(TABLES[0][raw] * up[:n], out=sums[1:])
    names = mixed((sums[k:] - sums[:-k]) * down[: n - k + 1])
    # The leftmost least name of each window, from windows of 1, 2, 4 ... and the rest.
    least, where, span = names, np.arange(len(names)), 1
    while span < width:
        step = min(span, width - span)
        a, b = least[: len(least) - step], least[step:]
        right = b < a
        least, where = np.where(right, b, a), np.where(right, where[step:], where[: len(where) - step])
        span += step
    first = np.flatnonzero(np.diff(where, prepend=-1))
    at, last = where[first], np.r_[first[1:], len(where)] - 1
    left, right = np.maximum(at - (length - k), 0), np.minimum(at + length, n)
    # Cut short by an end of the text, a neighbourhood differs from a whole one.
    shape = ((at - left) * 8192 + (right - at)).astype(_U)
    around = mixed((sums[right] - sums[left]) * down[left] + mixed(shape + _U(1)))
    return names[at], around, at, first, last


def windows(raw: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Two names of each window: with equal ones the windows are taken to be equal."""
    up, down = powers(len(raw))
    out = np.empty((2, len(starts)), _U)
    for i, table in enumerate(TABLES):
        sums = np.zeros(len(raw) + 1, _U)
        np.cumsum(table[raw] * up[: len(raw)], out=sums[1:])
        out[i] = mixed((sums[starts + length] - sums[starts]) * down[starts])
    return out


def run(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Window starts first..last as one number."""
    return (first.astype(np.int64) << 31) | (last - first)


def open_anchor(at: np.ndarray, first: np.ndarray, last: np.ndarray, hot) -> np.ndarray:
    """An anchor whose windows are to be ranked, as one number."""
    return (at.astype(np.int64) << 27) | (np.int64(hot) << 26) | ((at - first).astype(np.int64) << 13) | (at - last)


def joined_runs(doc: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs that follow one another in a document as one."""
    order = np.lexsort((first, doc))
    doc, first, last = doc[order], first[order], last[order]
    new = np.r_[True, (doc[1:] != doc[:-1]) | (first[1:] > last[:-1] + 1)] if len(doc) else np.empty(0, bool)
    starts = np.flatnonzero(new)
    return doc[starts], first[starts], np.maximum.reduceat(last, starts) if len(starts) else last


def settled(group: list[np.ndarray], ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by ``group``, and which of it come after the earliest of their group."""
    order = np.lexsort((at, ids, *group[::-1]))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for g in group:
        s = g[order]
        new[1:] |= s[1:] != s[:-1]
    lead = order[np.flatnonzero(new)][np.cumsum(new) - 1]
    return order, (ids[order] != ids[lead]) | (at[order] != at[lead])


def kinds_of(key: np.ndarray, around: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For entries sorted by key and neighbourhood: the key's number, and of each key the neighbourhoods and entries."""
    new_key = np.r_[True, key[1:] != key[:-1]] if len(key) else np.empty(0, bool)
    new = new_key.copy()
    new[1:] |= around[1:] != around[:-1]
    number = np.cumsum(new_key) - 1
    return number, np.bincount(number, new).astype(np.int64), np.bincount(number)


def repeats(docs: DataFrame, length: int = 100, k: int = 32) -> DataFrame:
    """``_id, _t, runs``: of each document that has any, the window starts that came earlier.

    Documents are as ``keyed`` gives them. What a task holds is bounded: a batch of
    anchors, the anchors of one page of names, the strings around the open anchors of
    one page. Anchors that repeat within a batch are settled there, so a hot string
    sends as many entries as there are batches and not as there are copies.
    """
    k = min(k, length)
    if not 1 <= k <= length < 4096:
        raise ValueError("length must be from 1 to 4095")
    rows = keyed(docs)
    pages = 2 * partitions(docs)
    dealt = rows.repartition(partitions(docs), "_id", "_t")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, ids, ts, count = [], [], [], 0
        for batch in batches:
            for number, t, text in zip(batch["_id"], batch["_t"], batch["text"]):
                raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
                if len(raw) < length:
                    continue
                key, around, at, first, last = anchors(raw, length, k)
                entry = np.empty(len(key), ENTRY)
                entry["key"], entry["around"], entry["at"], entry["doc"] = key, around, at, len(ids)
                entry["first"], entry["last"] = at - first, at - last
                held.append(entry)
                ids.append(number)
                ts.append(t)
                count += len(key)
                if count >= FLUSH:
                    yield from send(np.concatenate(held), np.array(ids, np.int64), np.array(ts, np.int64))
                    held, ids, ts, count = [], [], [], 0
        if held:
            yield from send(np.concatenate(held), np.array(ids, np.int64), np.array(ts, np.int64))

    def send(e: np.ndarray, ids: np.ndarray, ts: np.ndarray) -> Iterator[pd.DataFrame]:
        order, later = settled([e["key"], e["around"]], ids[e["doc"]], e["at"])
        again = e[order[later]]
        e = e[order[~later]]
        doc, first, last = joined_runs(again["doc"], again["at"] - again["first"], again["at"] - again["last"])
        direct = [np.stack([ids[doc], ts[doc], np.zeros(len(doc), np.int64), run(first, last)])]
        number, kinds, _ = kinds_of(e["key"], e["around"])
        hot = (kinds > HOT_BATCH)[number]
        h = e[hot]
        direct.append(np.stack([ids[h["doc"]], ts[h["doc"]], np.ones(len(h), np.int64), open_anchor(h["at"], h["at"] - h["first"], h["at"] - h["last"], True)]))
        lead = hot & np.r_[True, number[1:] != number[:-1]] if len(e) else hot
        mark = e[lead]
        mark["doc"] = -1  # a key that is hot here is hot for all
        e = np.concatenate([e[~hot], mark])
        page = (e["key"] % _U(pages)).astype(np.int64)
        order = np.argsort(page, kind="stable")
        cuts = np.flatnonzero(np.diff(page[order], prepend=-1))
        blobs, numbers = [], page[order][cuts].tolist()
        for part in np.split(order, cuts[1:]) if len(order) else []:
            sent = e[part]
            used, sent["doc"] = np.unique(sent["doc"], return_inverse=True)
            own = np.stack([np.where(used < 0, 0, ids[used]), np.where(used < 0, 0, ts[used])])
            head = np.array([len(used), len(sent), used[0] < 0], np.int64)
            # Column after column: these compress better than entries.
            body = b"".join(np.ascontiguousarray(sent[c]).tobytes() for c in ENTRY.names)
            blobs.append(head.tobytes() + own.tobytes() + body)
        if numbers:
            yield pd.DataFrame({"page": numbers, "direct": False, "blob": blobs})
        body = np.concatenate(direct, axis=1)
        if body.shape[1]:
            yield pd.DataFrame({"page": [int(e["key"][0] % _U(pages)) if len(e) else 0], "direct": True, "blob": [body.tobytes()]})

    def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        docs_n, n, marked = np.frombuffer(blob, np.int64, 3)
        own = np.frombuffer(blob, np.int64, 2 * docs_n, 24).reshape(2, docs_n)
        e, place = np.empty(n, ENTRY), 24 + 16 * docs_n
        for name in ENTRY.names:
            e[name] = np.frombuffer(blob, ENTRY[name], n, place)
            place += n * ENTRY[name].itemsize
        return e, own[0][e["doc"]], own[1][e["doc"]], (e["doc"] == 0) & bool(marked)

    def settle(rows: pd.DataFrame) -> pd.DataFrame:
        out = [np.frombuffer(b, np.int64).reshape(4, -1) for b in rows["blob"][rows["direct"]]]
        parts = [unpack(b) for b in rows["blob"][~rows["direct"]]]
        if parts:
            e, ids, ts, mark = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(e["key"], kind="stable")
            key = e["key"][order]
            new = np.r_[True, key[1:] != key[:-1]]
            number = np.cumsum(new) - 1
            keep = (np.bincount(number) > 1)[number]  # a unique rank drops out
            order = order[keep]
            e, ids, ts, mark = e[order], ids[order], ts[order], mark[order]
        if parts and len(e):
            order, later = settled([e["key"], e["around"]], ids, e["at"])
            e, ids, ts, mark = e[order], ids[order], ts[order], mark[order]
            number, kinds, _ = kinds_of(e["key"], e["around"])
            hot_key = (np.bincount(number, mark) > 0) | (kinds > HOT_ALL)
            # Marks stand for entries settled elsewhere, which have more neighbourhoods.
            later &= ~mark & ~hot_key[number]
            left = ~mark & ~later & ((kinds > 1) | hot_key)[number]
            first, last = e["at"] - e["first"], e["at"] - e["last"]
            zero, one = np.zeros(int(later.sum()), np.int64), np.ones(int(left.sum()), np.int64)
            out.append(np.stack([ids[later], ts[later], zero, run(first[later], last[later])]))
            out.append(np.stack([ids[left], ts[left], one, open_anchor(e["at"][left], first[left], last[left], hot_key[number][left])]))
        found = np.concatenate([*out, np.empty((4, 0), np.int64)], axis=1)
        return pd.DataFrame({"_id": found[0], "_t": found[1], "open": found[2] == 1, "v": found[3]})

    sent = rows.mapInPandas(scan, "page int, direct boolean, blob binary").repartition(pages, "page")
    found = sent.groupBy("page").applyInPandas(settle, FOUND)
    asked = found.where("open").groupBy("_id", "_t").agg(F.collect_list("v").alias("open"))

    def around(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The strings that the open anchors' windows reach; of hot ones each window's names."""
        for batch in batches:
            for a in range(0, len(batch), 1024):
                yield from neighbourhoods(batch.iloc[a : a + 1024])

    def neighbourhoods(batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
        page, numbers, t_of, start, span, strings = [], [], [], [], [], []
        names = []
        for number, t, text, v in zip(batch["_id"], batch["_t"], batch["text"], batch["open"]):
            body = text.encode("utf-8", "replace")
            raw = np.frombuffer(body, np.uint8)
            v = np.unique(np.asarray(v, np.int64))
            at, hot = v >> 27, (v >> 26 & 1).astype(bool)
            first, last = at - (v >> 13 & 8191), at - (v & 8191)
            if (~hot).any():
                key = windows(raw, at[~hot], k)[0]
                page += (key % _U(pages)).astype(np.int64).tolist()
                for f, z in zip(first[~hot].tolist(), last[~hot].tolist()):
                    strings.append(body[f : z + length])
                    start.append(f)
                    span.append(z - f + 1)
                    numbers.append(number)
                    t_of.append(t)
            if hot.any():
                at_hot = np.unique(np.concatenate([np.arange(f, z + 1) for f, z in zip(first[hot], last[hot])]))
                one = windows(raw, at_hot, length)
                same = len(at_hot)
                names.append((one, np.full(same, len(names)), np.full(same, number), np.full(same, t), at_hot))
        if page:
            yield pd.DataFrame({"page": page, "_id": numbers, "_t": t_of, "start": start, "span": span, "string": strings})
        if names:
            one, docs, ids, ts, at = (np.concatenate(x, axis=-1) for x in zip(*names))
            order, later = settled([one[0], one[1]], ids, at)  # of equal windows in a batch one is sent
            gone, stay = order[later], order[~later]
            both = [one[:, i].T.tobytes() for i in stay]
            yield pd.DataFrame({"page": (one[0][stay] % _U(pages)).astype(np.int64), "_id": ids[stay], "_t": ts[stay], "start": at[stay], "span": 0, "string": both})
            if len(gone):  # settled: runs that only pass through, spread by document
                doc, first, last = joined_runs(docs[gone], at[gone], at[gone])
                lead = np.searchsorted(docs, doc)
                yield pd.DataFrame({"page": (ids[lead] + first) % pages, "_id": ids[lead], "_t": ts[lead], "start": first, "span": first - last - 1, "string": b""})

    def rank(rows: pd.DataFrame) -> pd.DataFrame:
        """Runs of windows that came earlier, among the windows of one page."""
        ids, ts, start, span = (rows[c].to_numpy(np.int64) for c in ("_id", "_t", "start", "span"))
        strings = rows["string"].to_list()
        done = span < 0
        out = [np.stack([ids[done], ts[done], run(start[done], start[done] - span[done] - 1)])]
        hot = np.flatnonzero(span == 0)
        if len(hot):
            names = np.frombuffer(b"".join(strings[i] for i in hot), _U).reshape(-1, 2)
            order, later = settled([names[:, 0], names[:, 1]], ids[hot], start[hot])
            again = hot[order[later]]
            out.append(np.stack([ids[again], ts[again], run(start[again], start[again])]))
        cold = np.flatnonzero(span > 0)
        if len(cold):
            names = np.empty((2, int(span[cold].sum())), _U)
            place = 0
            for a in range(0, len(cold), 4096):
                some = cold[a : a + 4096]
                raw = np.frombuffer(b"".join(strings[i] for i in some), np.uint8)
                sizes = span[some] + length - 1
                begin = np.repeat(np.cumsum(sizes) - sizes, span[some])
                inner = np.arange(len(begin)) - np.repeat(np.cumsum(span[some]) - span[some], span[some])
                names[:, place : place + len(begin)] = windows(raw, begin + inner, length)
                place += len(begin)
            owner = np.repeat(cold, span[cold])
            inner = np.arange(len(owner)) - np.repeat(np.cumsum(span[cold]) - span[cold], span[cold])
            order, later = settled([names[0], names[1]], ids[owner], start[owner] + inner)
            again = np.sort(order[later])
            number, first, last = joined_runs(owner[again], start[owner[again]] + inner[again], start[owner[again]] + inner[again])
            out.append(np.stack([ids[number], ts[number], run(first, last)]))
        found = np.concatenate(out, axis=1)
        return pd.DataFrame({"_id": found[0], "_t": found[1], "v": found[2]})

    strings = dealt.join(asked.hint("shuffle_hash"), ["_id", "_t"]).mapInPandas(
        around, "page int, _id long, _t long, start long, span int, string binary"
    )
    ranked = strings.repartition(pages, "page").groupBy("page").applyInPandas(rank, "_id long, _t long, v long")
    runs = found.where("not open").select("_id", "_t", "v").unionByName(ranked)
    return runs.groupBy("_id", "_t").agg(F.collect_list("v").alias("runs"))


def remove_repeats(docs: DataFrame, length: int = 100, k: int = 32) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: what of each text's UTF-8 bytes repeats, and what is left.

    A byte goes if a string of ``length`` bytes that covers it starts earlier, too: in a
    document with a smaller doc_id, or in the same one further left, overlaps included.
    Strings are judged on the input. ``spans`` has the maximal runs removed, in order,
    as start and stop; ``kept`` the other bytes. A null text is empty; a text under
    ``length`` bytes keeps all. A null doc_id comes before all others, and rows with
    the same doc_id are one document for what is earlier, each with a result of its own.
    """
    found = repeats(docs, length, k)
    dealt = keyed(docs).repartition(partitions(docs), "_id", "_t")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes, spans, kept = [], [], []
            for text, runs in zip(batch["text"], batch["runs"]):
                body = text.encode("utf-8", "replace")
                sizes.append(len(body))
                if runs is None or not len(runs):
                    spans.append([])
                    kept.append(body)
                    continue
                v = np.asarray(runs, np.int64)
                edge = np.zeros(len(body) + 1, np.int32)
                first = v >> 31
                np.add.at(edge, first, 1)
                np.add.at(edge, first + (v & (1 << 31) - 1) + length, -1)
                gone = np.cumsum(edge[:-1]) > 0
                turns = np.flatnonzero(np.diff(gone, prepend=False, append=False))
                spans.append([{"start": int(a), "stop": int(b)} for a, b in turns.reshape(-1, 2)])
                kept.append(np.frombuffer(body, np.uint8)[~gone].tobytes())
            yield pd.DataFrame({"_id": batch["_id"], "n_bytes": sizes, "spans": spans, "kept": kept})

    joined = dealt.join(found.hint("shuffle_hash"), ["_id", "_t"], "left")
    out = joined.mapInPandas(cut, "_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary")
    return out.select(F.expr(f"nullif(_id, {LEAST_ID + 1} - 1)").alias("doc_id"), "n_bytes", "spans", "kept")


def oracle(table: str = "documents", length: int = 100) -> str:
    """Every window of every text by DuckDB, bytes as two hex digits each."""
    return f"""WITH h AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM {table}),
w AS (SELECT doc_id, i, md5(substr(x, 2 * i + 1, {2 * length})) AS s
  FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - {length - 1})) AS i FROM h)),
d AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM w) WHERE r > 1),
g AS (SELECT doc_id, i, sum(CAST(i > before + {length} AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY i) AS n
  FROM (SELECT doc_id, i, coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -{2 * length}) AS before FROM d)),
r AS MATERIALIZED (SELECT doc_id, min(i) AS a, max(i) + {length} AS b FROM g GROUP BY doc_id, n),
k AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS f, a AS t FROM r
  UNION ALL SELECT doc_id, coalesce(max(b), 0), length(any_value(x)) // 2 FROM h LEFT JOIN r USING (doc_id) GROUP BY doc_id),
t AS (SELECT doc_id, string_agg(substr(x, 2 * f + 1, 2 * (t - f)), '' ORDER BY f) AS kept FROM k JOIN h USING (doc_id) GROUP BY doc_id)
SELECT doc_id, length(x) // 2 AS n_bytes, (length(x) - length(kept)) // 2 AS n_removed,
       coalesce(n, 0) AS n_spans, sha256(unhex(kept)) AS kept_sha256
  FROM h JOIN t USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM r GROUP BY doc_id) USING (doc_id)"""

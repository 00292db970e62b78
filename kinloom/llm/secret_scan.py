"""Secret scans through a trigram inverted index, with DataFrame functions alone."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinloom.llm.common import texts


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Matches whose ``group`` has under ``least`` characters are dropped.

    ``pattern`` is read alike by Java, Python and RE2. ``base`` marks the kinds that
    are counted and summed up for themselves.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join([*map(either_case, ("password", "passwd", "secret", "token")), "[Aa][Pp][Ii]_?[Kk][Ee][Yy]"])

RULES = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", "AKIA[A-Z0-9]{16,}", base=True),  # 20 characters and more: a run is matched as a whole
    Rule("hex", "[0-9a-f]{24,}", base=True),
    Rule("github", "gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)

#: A query is a list of clauses that must all hold; a clause is a list of alternatives,
#: each a set of trigrams that must all occur.
Query = list[list[frozenset[str]]]
MOST = 16


def trigram_query(pattern: str) -> Query:
    """The Boolean trigram query of a pattern, over lower-cased text; empty: scan everything.

    Literal stretches of the pattern are gathered as sets of the strings they can be.
    Small classes and alternatives multiply the set; repetitions, large classes and more
    than ``MOST`` strings end the stretch. A stretch is a clause if each of its strings
    has three characters or more.
    """
    from re import _parser as parser

    def stretches(items) -> list[set[str]]:
        """Strings of each stretch; the first and the last may continue outside."""
        done, now = [], {""}
        for code, value in items:
            name = str(code)
            if name == "LITERAL":
                options = [{chr(value).lower()}]
            elif name == "IN":
                kinds = {str(c) for c, _ in value}
                options = [{chr(v).lower() for _, v in value}] if kinds == {"LITERAL"} else None
            elif name == "SUBPATTERN":
                options = stretches(value[-1])
            elif name == "BRANCH":
                parts = [stretches(x) for x in value[1]]
                options = [set().union(*(p[0] for p in parts))] if all(len(p) == 1 for p in parts) else None
            elif name == "MAX_REPEAT" and tuple(value[:2]) == (0, 1):
                inner = stretches(value[2])
                options = [inner[0] | {""}] if len(inner) == 1 else None
            else:
                options = None
            if options is None:
                done.append(now)
                now = {""}
                continue
            for k, strings in enumerate(options):
                if k:
                    done.append(now)
                    now = {""}
                if len(now) * len(strings) > MOST:
                    done.append(now)
                    now = {""}
                    if len(strings) > MOST:
                        continue
                now = {a + b for a, b in product(now, strings)}
        return [*done, now]

    clauses = [s for s in stretches(parser.parse(pattern)) if all(len(x) >= 3 for x in s)]
    return [[frozenset(x[i : i + 3] for i in range(len(x) - 2)) for x in sorted(s)] for s in clauses]


def trigrams(rules: tuple[Rule, ...]) -> list[str]:
    """The trigrams that any rule asks for: the vocabulary of the index."""
    return sorted({t for r in rules for clause in trigram_query(r.pattern) for alternative in clause for t in alternative})


def trigram_index(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Postings ``trigram, doc_id``: which documents hold which trigram of the vocabulary."""
    low = F.lower("text")
    held = F.array_compact(F.array(*(F.when(F.contains(F.col("low"), F.lit(t)), F.lit(i)) for i, t in enumerate(vocabulary))))
    found = texts(docs).select("doc_id", low.alias("low")).select("doc_id", F.explode(held).alias("trigram"))
    return found.select("doc_id", F.col("trigram").cast("int").alias("trigram"))


def candidates(postings: DataFrame, rules: tuple[Rule, ...], vocabulary: list[str]) -> DataFrame:
    """``doc_id, candidate_of``: the kinds whose trigram query a document's postings meet.

    Postings are intersected as bits: the ones of a document are combined before the
    shuffle, and a rule holds if each clause has an alternative with all its bits.
    """
    words = range(-(-len(vocabulary) // 63))
    bit = F.expr("shiftleft(1L, trigram % 63)")
    masks = postings.groupBy("doc_id").agg(
        *(F.bit_or(F.when(F.floor(F.col("trigram") / 63) == w, bit).otherwise(F.lit(0).cast("long"))).alias(f"mask{w}") for w in words)
    )

    def has(alternative: frozenset[str]) -> Column:
        need = [sum(1 << i % 63 for i, t in enumerate(vocabulary) if t in alternative and i // 63 == w) for w in words]
        tests = [F.col(f"mask{w}").bitwiseAND(F.lit(n).cast("long")) == F.lit(n).cast("long") for w, n in enumerate(need) if n]
        return _all(tests)

    kinds = []
    for rule in rules:
        query = trigram_query(rule.pattern)
        if query:
            kinds.append(F.when(_all([_any([has(a) for a in clause]) for clause in query]), F.lit(rule.kind)))
    found = F.array_compact(F.array(*kinds)) if kinds else F.array().cast("array<string>")
    return masks.select("doc_id", found.alias("candidate_of")).where(F.size("candidate_of") > 0)


def _all(tests: list[Column]) -> Column:
    out = tests[0]
    for test in tests[1:]:
        out = out & test
    return out


def _any(tests: list[Column]) -> Column:
    out = tests[0]
    for test in tests[1:]:
        out = out | test
    return out


def rule_spans(text: Column, rule: Rule) -> Column:
    """Leftmost non-overlapping matches as array<struct<start, stop>> in code points.

    The text between the matches and the matches take turns; their lengths add up to
    the places.
    """
    pattern = F.lit(rule.pattern)
    between, matches = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    value = lambda m: F.regexp_extract(m, rule.pattern, rule.group) if rule.group else m
    steps = F.zip_with(
        F.slice(between, 1, F.greatest(F.size(matches), F.lit(0))),
        matches,
        lambda gap, m: F.struct(
            F.length(gap).alias("gap"), F.length(m).alias("size"), (F.length(value(m)) >= rule.least).alias("good")
        ),
    )
    none = F.array().cast("array<struct<start:int,stop:int>>")
    walk = F.aggregate(
        steps,
        F.struct(F.lit(0).alias("at"), none.alias("spans")),
        lambda s, x: F.struct(
            (s["at"] + x["gap"] + x["size"]).alias("at"),
            F.when(
                x["good"],
                F.concat(
                    s["spans"],
                    F.array(F.struct((s["at"] + x["gap"]).alias("start"), (s["at"] + x["gap"] + x["size"]).alias("stop"))),
                ),
            )
            .otherwise(s["spans"])
            .alias("spans"),
        ),
        lambda s: s["spans"],
    )
    return F.when(F.size(matches) > 0, walk).otherwise(none)


def _named(number: int, kind: str) -> Callable[[Column], Column]:
    return lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("kind_no"), s["stop"].alias("stop"), F.lit(kind).alias("kind"))


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, spans``: for every row its spans, array<struct<start, kind_no, stop, kind>>.

    Spans are in code points, the end exclusive, sorted by start and then by the order
    of ``rules``. A null text is empty. Rules with mandatory trigrams are run on the
    documents that the index gives; rules without are run on all. Rows that repeat a
    doc_id share their postings and are each verified; so are rows whose doc_id is null.
    Candidates join by doc_id with the documents and are the side that is hashed.
    """
    vocabulary = trigrams(rules)
    found = candidates(trigram_index(docs, vocabulary), rules, vocabulary)
    found = found.select(F.col("doc_id").alias("_id"), "candidate_of").hint("shuffle_hash")
    rows = texts(docs).join(found, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    kinds = []
    for number, rule in enumerate(rules):
        spans = rule_spans(F.col("text"), rule)
        if trigram_query(rule.pattern):
            spans = F.when(F.array_contains("candidate_of", rule.kind), spans)
        named = F.transform(spans, _named(number, rule.kind))
        kinds.append(F.coalesce(named, F.array().cast("array<struct<start:int,kind_no:int,stop:int,kind:string>>")))
    return rows.select("doc_id", F.array_sort(F.concat(*kinds)).alias("spans"))


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Counts of the base kinds, a hash of their spans, and all spans as text."""
    base = [r.kind for r in rules if r.base]
    show = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ","
    )
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(of(kind).alias(f"n_{kind}") for kind in base),
        F.sha2(show(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        show(F.col("spans")).alias("spans"),
    )


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """The same rows by DuckDB, which scans every text with every rule."""
    parts = []
    for number, rule in enumerate(rules):
        pattern = rule.pattern.replace("'", "''")
        group = f"regexp_extract(m[i], '{pattern}', {rule.group})"
        parts.append(
            f"""SELECT row_id, '{rule.kind}' AS kind, {number} AS kind_no, i AS match_no,
       list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) AS start,
       length(m[i]) AS size, length({group}) >= {rule.least} AS good
  FROM (SELECT row_id, m, g, unnest(range(1, len(m) + 1)) AS i
          FROM (SELECT row_id, regexp_extract_all(t, '{pattern}') AS m, string_split_regex(t, '{pattern}') AS g FROM d))"""
        )
    union = "\nUNION ALL\n".join(parts)
    base = ", ".join(f"'{r.kind}'" for r in rules if r.base)
    counts = ", ".join(f"count(*) FILTER (kind = '{r.kind}') AS n_{r.kind}" for r in rules if r.base)
    one = "kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + size AS BIGINT)"
    return f"""WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT * FROM ({union}) WHERE good),
a AS (SELECT row_id, {counts},
        string_agg({one}, ',' ORDER BY start, kind_no) FILTER (kind IN ({base})) AS base,
        string_agg({one}, ',' ORDER BY start, kind_no) AS spans FROM s GROUP BY row_id)
SELECT doc_id, {", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in rules if r.base)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
  FROM d LEFT JOIN a USING (row_id)"""



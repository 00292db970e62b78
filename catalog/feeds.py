"""Input feeds as SQL over the given tables.

The tables hold no identity records, so each feed turns every row of a table
into one line of the format a job reads, including the faults that occur in such
files (which fault a row gets depends on one of its attributes). The same text
builds the lines in Spark and in the oracle's engine; only sha256 is spelled
differently. ``{name}`` stands for a table.
"""

from __future__ import annotations

import re

from kinloom.fixed import PREFERRED_PEL_KEY

SALT = "pepper"
ACCOUNT = 12
REGION = "DE"


def _clink(key: str) -> str:
    return f"'0000GB' || upper(substr(md5(CAST({key} AS STRING)), 1, 10))"


def _pel(key: str) -> str:
    return f"'Xi' || substr(SHA256('pel' || CAST({key} AS STRING)), 1, 32)"


# Two customers share an address; a third of the orders carries one address.
_EMAIL = (
    "CASE WHEN o_orderstatus = 'F' THEN 'noreply'"
    " ELSE 'u' || CAST(o_custkey - o_custkey % 2 AS STRING) END"
)
# One id stands for a third of all rows.
_HOUSEHOLD = "CASE WHEN o_orderstatus = 'F' THEN 'household' ELSE CAST(o_custkey AS STRING) END"
_EMAIL_HASH = "SHA256('e' || CAST(o_orderkey - o_orderkey % 4 AS STRING))"
_PHONE_HASH = "SHA256('p' || CAST(o_orderkey - o_orderkey % 6 AS STRING))"
_KB_EMAIL = (
    "CASE WHEN o_orderstatus = 'F' THEN 'shared'"
    " ELSE CAST(o_orderkey - o_orderkey % 3 AS STRING) END"
)
_PROVIDER_EMAIL = (
    "CASE WHEN l_linestatus = 'F' THEN 'shared'"
    " ELSE CAST(l_orderkey - l_orderkey % 3 AS STRING) END"
)
_CID = (
    "CAST(user_id AS STRING) || CASE WHEN event_type = 'view'"
    " THEN '#' || CAST(event_id AS STRING) ELSE '' END"
)
_ANA = "CASE WHEN c_nationkey < 8 THEN 1 WHEN c_nationkey < 16 THEN 12 ELSE 123 END"

FEEDS = {
    # clink|sha1|md5|sha256
    "identity_lines": f"""
        SELECT CASE o_orderpriority
            WHEN '1-URGENT' THEN clink || '|' || sha1(email) || '|' || md5(email) || '|' || SHA256(email)
            WHEN '2-HIGH' THEN clink || '|' || upper(sha1(email)) || '|' || upper(md5(email)) || '|' || SHA256(email)
            WHEN '3-MEDIUM' THEN clink || '|' || sha1(email) || '|' || md5(email) || '||'
            WHEN '4-NOT SPECIFIED' THEN clink || '|' || substr(sha1(email), 2) || '|z' || substr(md5(email), 2) || '|' || SHA256(email)
            ELSE clink || '||' || md5(email) || '|' || SHA256(email) END AS value
        FROM (SELECT o_orderpriority, {_clink('o_custkey')} AS clink, {_EMAIL} AS email FROM {{orders}}) o""",
    # clink|value|value
    "two_way_lines": f"""
        SELECT CASE o_orderpriority
            WHEN '4-NOT SPECIFIED' THEN '|' || clink || '||' || v || '|'
            WHEN '5-LOW' THEN clink || '|'
            ELSE clink || '|' || v || '|' || w END AS value
        FROM (SELECT o_orderpriority, {_clink('o_custkey')} AS clink,
                     SHA256('v' || CAST(o_orderkey - o_orderkey % 4 AS STRING)) AS v,
                     SHA256('w' || {_EMAIL}) AS w FROM {{orders}}) o""",
    # id <whitespace> hash
    "email_lines": f"""
        SELECT CASE o_orderpriority
            WHEN '5-LOW' THEN id || chr(9) || 'Email Hash (SHA256)'
            WHEN '4-NOT SPECIFIED' THEN chr(9) || id || '  ' || upper(h) || ' '
            ELSE id || ' ' || h END AS value
        FROM (SELECT o_orderpriority, {_HOUSEHOLD} AS id, {_EMAIL_HASH} AS h FROM {{orders}}) o""",
    "phone_lines": f"""
        SELECT CASE o_orderpriority
            WHEN '5-LOW' THEN id
            WHEN '2-HIGH' THEN id || chr(9) || e
            WHEN '1-URGENT' THEN id || ' ' || upper(e)
            ELSE id || ' ' || p END AS value
        FROM (SELECT o_orderpriority, {_HOUSEHOLD} AS id, {_EMAIL_HASH} AS e, {_PHONE_HASH} AS p
              FROM {{orders}}) o""",
    # clink|md5|sha1|sha256, some fields quoted
    "kb_lines": f"""
        SELECT CASE o_orderpriority
            WHEN '3-MEDIUM' THEN '"' || clink || '"|"' || md5(email) || '"|' || sha1(email) || '|"' || SHA256(email) || '"'
            WHEN '4-NOT SPECIFIED' THEN clink || '||' || sha1(email) || '|' || SHA256(email)
            WHEN '5-LOW' THEN ' |' || md5(email) || '|' || sha1(email) || '|' || SHA256(email)
            ELSE clink || '|' || md5(email) || '|' || sha1(email) || '|' || SHA256(email) END AS value
        FROM (SELECT o_orderpriority, {_clink('o_custkey')} AS clink, {_KB_EMAIL} AS email FROM {{orders}}) o""",
    # line number|sha256
    "provider_lines": f"""
        SELECT CAST(l_linenumber AS STRING) || '|' ||
            CASE WHEN l_returnflag = 'R' THEN '' ELSE SHA256({_PROVIDER_EMAIL}) END AS value
        FROM {{lineitem}}""",
    # clink|hash|hash in any order
    "any_order_lines": f"""
        SELECT CASE o_orderpriority
            WHEN '1-URGENT' THEN clink || '|' || md5(email) || '|' || SHA256(email) || '|' || sha1(email)
            WHEN '2-HIGH' THEN clink || '| ' || sha1(email) || ' |' || sha1(clink) || '|' || SHA256(email)
            WHEN '3-MEDIUM' THEN '"' || clink || '"|"' || md5(email) || '"|' || sha1(email)
            WHEN '4-NOT SPECIFIED' THEN clink
            ELSE '|' || sha1(email) END AS value
        FROM (SELECT o_orderpriority, {_clink('o_custkey')} AS clink, {_EMAIL} AS email FROM {{orders}}) o""",
    # rows of the match table; one segment has md5 and sha1 under each other's
    # name, another has no sha1
    "match_rows": f"""
        SELECT {_pel('c_custkey')} AS pel,
            CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN sha1(email) ELSE md5(email) END AS md5,
            CASE c_mktsegment WHEN 'AUTOMOBILE' THEN md5(email) WHEN 'BUILDING' THEN NULL ELSE sha1(email) END AS sha1,
            SHA256(email) AS sha256
        FROM (SELECT c_custkey, c_mktsegment, 'c' || CAST(c_custkey AS STRING) AS email FROM {{customer}}) c""",
    # cookie,pel
    "request_lines": f"""
        SELECT 'c' || CAST(event_id AS STRING) || CASE event_type
            WHEN 'view' THEN ', ' || pel || ' '
            WHEN 'click' THEN ',' || substr(pel, 1, 20)
            WHEN 'signup' THEN ',' || 'Xi'
            WHEN 'purchase' THEN CASE WHEN value < 5 THEN ',' || pel || ',x' ELSE ',XY' || substr(pel, 3) END
            ELSE ',' END AS value
        FROM (SELECT event_id, event_type, value, {_pel('user_id')} AS pel FROM {{events}}) e""",
    # key=value lists
    "account_lines": f"""
        SELECT CASE event_type
            WHEN 'view' THEN 'CID=' || cid || ',PEL=XY' || h || ',SITE=Xenon'
            WHEN 'click' THEN ' CID="' || cid || '",A=Xi' || h || ',{PREFERRED_PEL_KEY}="' || CASE WHEN value < 5 THEN '' ELSE 'p' || h END || '"' || chr(9)
            WHEN 'signup' THEN 'A="Xi' || h || '",B=XY' || h || ',CID=' || cid
            WHEN 'purchase' THEN CASE WHEN value < 2 THEN 'CID=' || cid || ',PEL' WHEN value < 5 THEN 'CID=' || cid || ',PEL=XY' || h || ',PEL=XY'
                WHEN value < 10 THEN 'CID=' || cid || ',PEL=XY=' || h WHEN value < 15 THEN '  ' ELSE 'CID=' || cid || ',PEL=XY' || h END
            ELSE CASE WHEN value < 5 THEN 'CID="",PEL=XY' || h ELSE 'CID=' || cid || ',PEL=' || h END END AS value
        FROM (SELECT event_type, value, {_CID} AS cid, md5(CAST(event_id AS STRING)) AS h FROM {{events}}) e""",
    # current account tables, before translation of the key
    "accounts": f"""
        SELECT {_ANA} AS ana,
            CAST(c_custkey AS STRING) || CASE WHEN c_mktsegment = 'BUILDING' THEN '#b' ELSE '' END AS cid,
            'XY' || md5(c_name) AS pel, c_mktsegment
        FROM {{customer}}""",
    # PEL or clink, then thirteen more fields
    "person_lines": f"""
        SELECT CASE c_mktsegment
            WHEN 'BUILDING' THEN '0000DE' || substr(clink, 7) || ',x,y'
            WHEN 'MACHINERY' THEN clink || ',' || CAST(c_custkey AS STRING) || ', ,' || c_name
            ELSE clink || ',' || CAST(c_custkey AS STRING) || ',' || c_name || '@example.org,' || c_name || ',,M,1,'
                || CAST(c_nationkey AS STRING) || ',' || CAST(c_custkey + 10000 AS STRING) || ',,1970,01,02,'
                || CASE WHEN c_mktsegment = 'FURNITURE' THEN 'FR,extra' ELSE 'GB' END END AS value
        FROM (SELECT *, {_clink('c_custkey')} AS clink FROM {{customer}}) c""",
    # several writes per address
    "cell_writes": f"""
        SELECT {_clink('o_custkey')} AS row_key, 'hashes' AS family,
            CASE o_orderstatus WHEN 'F' THEN 'md5' WHEN 'O' THEN 'sha1' ELSE 'sha256' END AS qualifier,
            CAST(year(o_orderdate) AS BIGINT) AS ts_micros, md5(CAST(o_orderkey AS STRING)) AS value
        FROM {{orders}}""",
}


def feed_sql(name: str, dialect: str) -> str:
    """The feed for ``spark`` (tables in braces) or ``duckdb`` (plain table names)."""
    text = FEEDS[name]
    if dialect == "duckdb":
        return re.sub(r"\{(\w+)\}", r"\1", text).replace("SHA256(", "sha256(")
    return _sha2(text)


def _sha2(text: str) -> str:
    """Rewrite ``SHA256(x)`` as ``sha2(x, 256)``."""
    out, rest = "", text
    while "SHA256(" in rest:
        head, rest = rest.split("SHA256(", 1)
        depth, end = 1, 0
        while depth:
            depth += {"(": 1, ")": -1}.get(rest[end], 0)
            end += 1
        out += f"{head}sha2({_sha2(rest[: end - 1])}, 256)"
        rest = rest[end:]
    return out + rest


def tables_of(name: str) -> set[str]:
    return set(re.findall(r"\{(\w+)\}", FEEDS[name]))

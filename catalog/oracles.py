"""The same results as plain SQL for an independent engine, written without the job code."""

from __future__ import annotations

from catalog.feeds import ACCOUNT, REGION, SALT, feed_sql
from kinloom.fixed import ENCRYPTED_HEADER, PREFERRED_PEL_KEY


def _lines(name: str) -> str:
    return feed_sql(name, "duckdb")


def _pel(expr: str) -> str:
    return f"'Xi' || substr(sha256('{SALT}|pel|' || {expr}), 1, 32)"


def _hash_arl(hashed: str, kind: str, salt: str = f"'{SALT}'") -> str:
    return f"sha256({salt} || '|' || {kind} || '|' || lower({hashed}))"


def _account_arl(ana: str, cid: str, salt: str = f"'{SALT}'") -> str:
    return f"sha256({salt} || '|cid|' || CAST({ana} AS VARCHAR) || '#' || {cid})"


_TRIM = "regexp_replace({0}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"
_UNQUOTE = "regexp_replace({0}, '^\"|\"$', '', 'g')"

# Person records

_RECORDS = f"""records AS (
    SELECT value, string_split(rtrim(value, '|'), '|') AS f FROM ({_lines('identity_lines')})),
claims AS (
    SELECT f[3] AS hash, f[1] AS clink, 'MD5' AS hash_type FROM records WHERE len(f) >= 4
    UNION ALL SELECT f[2], f[1], 'SHA1' FROM records WHERE len(f) >= 4
    UNION ALL SELECT f[4], f[1], 'SHA256' FROM records WHERE len(f) >= 4)"""
_OWNERS = f"""{_RECORDS},
owners AS (
    SELECT hash, clink, hash_type FROM claims
    WHERE length(hash) % 2 = 0 AND regexp_full_match(hash, '[0-9a-fA-F]+')
    QUALIFY row_number() OVER (PARTITION BY hash ORDER BY right(clink, 16), clink, hash_type) = 1)"""
_FIRST_LOAD = "substr(md5(value), 1, 1) < '8'"
_LOAD_OWNERS = f"""{_RECORDS.replace("AS f FROM", f"AS f, {_FIRST_LOAD} AS is_first FROM").replace("AS hash_type FROM", "AS hash_type, is_first FROM").replace("'SHA1' FROM", "'SHA1', is_first FROM").replace("'SHA256' FROM", "'SHA256', is_first FROM")},
valid AS (SELECT * FROM claims WHERE length(hash) % 2 = 0 AND regexp_full_match(hash, '[0-9a-fA-F]+')),
before AS (SELECT * FROM valid WHERE is_first
    QUALIFY row_number() OVER (PARTITION BY hash ORDER BY right(clink, 16), clink, hash_type) = 1),
after AS (SELECT * FROM valid
    QUALIFY row_number() OVER (PARTITION BY hash ORDER BY right(clink, 16), clink, hash_type) = 1)"""
_FAULT = "CASE WHEN length(hash) % 2 = 1 THEN 'odd_length' WHEN NOT regexp_full_match(hash, '[0-9a-fA-F]+') THEN 'bad_chars' ELSE 'success' END"
_MAPPING = f"""{_OWNERS},
mapping AS (SELECT {_hash_arl('hash', 'hash_type')} AS arl, {_pel('clink')} AS pel FROM owners)"""
_RECORD_REJECTS = f"""{_MAPPING},
rejects AS (
    SELECT value, 'width' AS reason FROM records WHERE len(f) < 4
    UNION ALL SELECT DISTINCT hash, CASE WHEN length(hash) % 2 = 1 THEN 'odd_length' ELSE 'bad_chars' END
    FROM claims WHERE length(hash) % 2 = 1 OR NOT regexp_full_match(hash, '[0-9a-fA-F]+'))"""
_ARL_CELLS = f"""WITH {_MAPPING}
SELECT arl AS row_key, 'uk' AS family, 'pel' AS qualifier, 0::BIGINT AS ts_micros, max(pel) AS value
FROM mapping GROUP BY arl"""

# Two-way links

_LINKS = f"""tokens AS (
    SELECT list_filter(string_split(value, '|'), lambda t: t <> '') AS t FROM ({_lines('two_way_lines')})),
links AS (SELECT t[1] AS key, unnest(t[2:]) AS linked FROM tokens WHERE len(t) > 1)"""

# Expansion

_PEOPLE = """words AS (
    SELECT kind, value, string_split_regex(trim(replace(value, chr(9), ' ')), ' +') AS w
    FROM (SELECT 'email' AS kind, value FROM ({emails}) UNION ALL SELECT 'phone', value FROM ({phones}))),
owned AS (SELECT DISTINCT w[1] AS id, kind, w[2] AS hash FROM words WHERE len(w) = 2)""".format(
    emails=_lines("email_lines"), phones=_lines("phone_lines")
)


def _pairs(owned: str, rows: str) -> str:
    """Naive expansion: for each row hash every other hash of the same id."""
    return f"""SELECT DISTINCT '{REGION}#' || kind || '#' || hash AS row_key,
        CASE WHEN own THEN kind ELSE other_kind END AS family, other AS qualifier
    FROM (SELECT a.id, a.kind, a.hash, b.hash AS other, max(b.kind) AS any_kind,
                 bool_or(a.kind = b.kind) AS own,
                 CASE a.kind WHEN 'email' THEN 'phone' ELSE 'email' END AS other_kind
          FROM ({rows}) a JOIN {owned} b ON a.id = b.id
          WHERE NOT (a.kind = b.kind AND lower(a.hash) = lower(b.hash))
          GROUP BY a.id, a.kind, a.hash, b.hash)"""


_GROUPS = f"""entries AS (SELECT id, hash, bool_or(kind = 'email') AS e, bool_or(kind = 'phone') AS p FROM owned GROUP BY id, hash),
groups AS (
    SELECT id, '{REGION}#group#' || id || '#' || n || '-' || lower(to_hex(mark)) AS group_key
    FROM (SELECT id, sum(e::INT + p::INT) AS n,
            bit_xor(CAST('0x' || substr(md5(hash || '|' || e || '|' || p), 1, 15) AS BIGINT)) AS mark
          FROM entries GROUP BY id) WHERE n > 1),
listed AS (
    SELECT group_key, kind, hash, e AND p AS in_both
    FROM owned JOIN entries USING (id, hash) JOIN groups USING (id))"""
_ASKED_BY_CUSTOMER = """SELECT 'email' AS kind, sha256('e' || CAST(4 * c_custkey AS STRING)) AS hash FROM customer
    UNION ALL SELECT 'phone', sha256('p' || CAST(6 * c_custkey AS STRING)) FROM customer"""
_ASKED = """SELECT DISTINCT 'email' AS kind, sha256('e' || CAST(s_suppkey - s_suppkey % 4 AS STRING)) AS hash FROM supplier
    UNION ALL SELECT DISTINCT 'phone', sha256('p' || CAST(s_suppkey - s_suppkey % 6 AS STRING)) FROM supplier"""

# Match table


def _csv(name: str) -> str:
    """Quotes in these feeds only enclose whole fields."""
    return f"SELECT string_split(replace(value, '\"', ''), '|') AS f FROM ({_lines(name)})"


def _hash_cells(rows: str) -> str:
    return f"""SELECT pel AS row_key, 'hashes' AS family, qualifier, 0::BIGINT AS ts_micros, max(value) AS value
    FROM (SELECT pel, 'md5' AS qualifier, coalesce(md5, '') AS value FROM ({rows})
          UNION ALL SELECT pel, 'sha1', coalesce(sha1, '') FROM ({rows})
          UNION ALL SELECT pel, 'sha256', coalesce(sha256, '') FROM ({rows}))
    GROUP BY pel, qualifier"""


def _first(length: int, values: str = "rest") -> str:
    return f"list_filter({values}, lambda x: length(x) = {length})[1]"


_BY_LENGTH = f"""by_length AS (
    SELECT f[1] AS key, {_first(32)} AS md5, {_first(40)} AS sha1, {_first(64)} AS sha256
    FROM (SELECT f, list_transform(f[2:], lambda x: trim(x)) AS rest FROM ({_csv('any_order_lines')}))
    WHERE len(f) > 1)"""
_REQUESTS = f"""requests AS (
    SELECT trim(f[1]) AS cookie, trim(f[2]) AS pel
    FROM (SELECT string_split(value, ',') AS f FROM ({_lines('request_lines')})) WHERE len(f) = 2)"""


def _filed(alias: str = "") -> str:
    # A missing cell is blank; a hash counts as what its length says.
    return f"list_value(coalesce({alias}md5, ''), coalesce({alias}sha1, ''), coalesce({alias}sha256, ''))"


def _match_lookup(condition: str) -> str:
    """Naive prefix join over the distinct ids, last row wins."""
    return f"""WITH {_REQUESTS}, stored AS ({_lines('match_rows')}),
    found AS (
        SELECT r.pel, arg_max({_filed('s.')}, s.pel) AS h
        FROM (SELECT DISTINCT pel FROM requests) r JOIN stored s ON starts_with(s.pel, r.pel) {condition}
        GROUP BY r.pel)
    SELECT cookie, coalesce({_first(32, 'h')}, '') AS md5, coalesce({_first(40, 'h')}, '') AS sha1,
        coalesce({_first(64, 'h')}, '') AS sha256
    FROM requests LEFT JOIN found USING (pel)"""


_NOT_BLANK = "AND r.pel <> ''"

# Cell tables

_LATEST = f"""latest AS (
    SELECT row_key, family, qualifier, max(ts_micros) AS ts_micros,
        arg_max(value, (ts_micros, value)) AS value
    FROM ({_lines('cell_writes')}) GROUP BY row_key, family, qualifier)"""

# Accounts

_ACCOUNT = f"""trimmed AS (
    SELECT value, {_TRIM.format('value')} AS line FROM ({_lines('account_lines')})),
pairs AS (
    SELECT value, list_transform(string_split(line, ','), lambda p: string_split(p, '=')) AS p
    FROM trimmed WHERE line <> ''),
fields AS (
    SELECT value, p,
        len(list_filter(p, lambda x: len(x) <> 2)) > 0 AS malformed,
        len(list_distinct(list_transform(p, lambda x: x[1]))) < len(p) AS duplicate,
        coalesce({_UNQUOTE.format("list_filter(p, lambda x: x[1] = 'CID')[1][2]")}, '') AS cid,
        len(list_filter(p, lambda x: x[1] = '{PREFERRED_PEL_KEY}')) > 0 AS preferred,
        {_UNQUOTE.format(f"list_filter(p, lambda x: x[1] = '{PREFERRED_PEL_KEY}')[1][2]")} AS preferred_value,
        list_max(list_filter(list_transform(p, lambda x: {_UNQUOTE.format('x[2]')}),
            lambda v: starts_with(v, 'XY') OR starts_with(v, 'Xi'))) AS best
    FROM pairs),
judged AS (
    SELECT value, cid, pel, CASE WHEN malformed THEN 'malformed_pair' WHEN duplicate THEN 'duplicate_key'
        WHEN cid = '' THEN 'no_cid' WHEN pel = '' THEN 'no_pel' END AS reason
    FROM (SELECT *, CASE WHEN preferred THEN preferred_value ELSE coalesce(best, '') END AS pel FROM fields)),
loaded AS (SELECT cid, max(pel) AS pel FROM judged WHERE reason IS NULL GROUP BY cid),
accounts AS ({_lines('accounts')})"""
_NEW_ARL = f"{_account_arl(str(ACCOUNT), 'cid')}"
_OLD_ARL = f"{_account_arl('ana', 'cid')}"
_OLD_KEY = "CAST(ana AS VARCHAR) || '#' || cid"
_CURRENT = f"""{_ACCOUNT},
diff_old AS (SELECT {_OLD_KEY} AS row_key, 'pel' AS family, pel, 1000::BIGINT AS ts FROM accounts),
arl_old AS (
    SELECT {_OLD_ARL} AS row_key, 'pel' AS family, pel, 1000::BIGINT AS ts, ana FROM accounts
    UNION ALL SELECT {_OLD_ARL}, 'uk', pel, 1000, ana FROM accounts WHERE c_mktsegment = 'MACHINERY'),
diff_new AS (SELECT '{ACCOUNT}#' || cid AS row_key, 'pel' AS family, pel, 2000::BIGINT AS ts FROM loaded),
arl_new AS (SELECT {_NEW_ARL} AS row_key, 'pel' AS family, pel, 2000::BIGINT AS ts FROM loaded)"""


def _account_table(old: str, new: str, keep: str = "true") -> str:
    return f"""WITH {_CURRENT}
    SELECT row_key, family, 'pel' AS qualifier, ts AS ts_micros, pel AS value FROM {new}
    UNION ALL
    SELECT row_key, family, 'pel', ts, pel FROM {old} o
    WHERE {keep} AND NOT EXISTS (SELECT 1 FROM {new} n WHERE n.row_key = o.row_key AND n.family = o.family)"""


# Encryption

_PERSON = f"""person AS (
    SELECT value, string_split(value, ',') AS f FROM ({_lines('person_lines')})),
valid AS (SELECT * FROM person
    WHERE length(f[1]) = 16 AND (starts_with(f[1], '0000GB') OR starts_with(f[1], '0000FR')))"""
_BLANKED = "CASE WHEN trim(coalesce({0}, '')) = '' THEN '' ELSE {0} END"
_ENCRYPTED = ", ".join(
    f"{_BLANKED.format(f'f[{i}]')} AS {name.lower()}"
    for i, name in enumerate(ENCRYPTED_HEADER.split(","), 1)
    if i > 1
)
_TEXT_LINES = (
    "string_split_regex(regexp_replace(text, '(\\r\\n|\\n|\\r)$', ''), '\\r\\n|\\n|\\r')"
)

# A source's texts are one text in the order of their ids; its last line may lack an end.
_WHOLE = f"""WITH w AS (SELECT source AS path, {_TEXT_LINES.replace("text", "t")} AS g
    FROM (SELECT source, string_agg(text, '' ORDER BY doc_id) AS t FROM documents WHERE text <> '' GROUP BY source)),
l AS (SELECT path, CAST(unnest(range(len(g))) AS BIGINT) AS line_no, unnest(g) AS value FROM w)"""

# Dialects

_NOTES = "repeat('a, b, c; ', (o_orderkey % 7)::INT)"
_DIALECT_FEEDS = f"""feeds AS (
    SELECT 'pipes' AS feed, value FROM ({_lines('kb_lines')})
    UNION ALL SELECT 'tabs', replace(replace(value, '"', ''), '|', chr(9)) FROM ({_lines('kb_lines')})
    UNION ALL SELECT 'semicolons', replace(value, '|', ';') FROM ({_lines('kb_lines')})
    UNION ALL SELECT 'quoted_commas', '"' || {_NOTES} || 'x",' || o_orderstatus || ',' || o_custkey FROM orders
    UNION ALL SELECT 'uneven_commas', o_orderkey || '|' || {_NOTES} || '|' || o_orderstatus FROM orders)"""
_DIALECT_SCORES = f"""{_DIALECT_FEEDS},
signs AS (SELECT unnest([',', '|', ';', chr(9)]) AS sign, unnest([0, 1, 2, 3]) AS i),
texts AS (
    SELECT feed, 0 AS j, value AS t, false AS is_open FROM feeds
    UNION ALL SELECT feed, 1, regexp_replace(value, '"[^"]*"', '', 'g'), contains(regexp_replace(value, '"[^"]*"', '', 'g'), '"') FROM feeds),
counted AS (
    SELECT feed, 2 * i + j AS dialect,
        CASE WHEN is_open OR (j = 0 AND regexp_matches(t, '(^|[' || sign || '])"[^"' || sign || ']*([' || sign || ']|$)')) THEN 1 ELSE least(len(string_split(t, sign)), 256) END AS fields, count(*)::DOUBLE AS n
    FROM texts CROSS JOIN signs GROUP BY ALL),
scores AS (
    SELECT feed, dialect::INT AS dialect, sum(n * n * (fields - 1) / fields) / (sum(n) * sum(n)) AS score FROM counted GROUP BY ALL)"""

ORACLES: dict[str, str] = {
    "dialect_scores_of_feeds": f"WITH {_DIALECT_SCORES} SELECT feed, dialect, round(1000 * score, 3) AS score FROM scores",
    "dialect_of_feeds": f"""WITH {_DIALECT_SCORES},
        best AS (SELECT feed, arg_max(dialect, (score, -(dialect // 2), dialect % 2)) AS d FROM scores GROUP BY feed),
        used AS (
            SELECT f.feed, f.value, b.d, CASE WHEN b.d % 2 = 1 THEN replace(regexp_replace(value, '"[^"]*"', 'q', 'g'), '"', '') ELSE value END AS t,
                [',', '|', ';', chr(9)][b.d // 2 + 1] AS sign FROM feeds f JOIN best b ON f.feed = b.feed)
        SELECT feed, sign AS delimiter, d % 2 = 1 AS quoted, count(*) AS lines FROM used
        WHERE trim(string_split(t, sign)[3]) <> '' GROUP BY ALL""",
    "arl_pel_mapping": f"WITH {_MAPPING} SELECT arl, pel FROM mapping",
    "arl_pel_rejects": f"WITH {_RECORD_REJECTS} SELECT value, reason FROM rejects",
    "arl_pel_load": _ARL_CELLS,
    "arl_pel_through_files": _ARL_CELLS,
    "identity_unpivot": f"""WITH {_RECORDS}
        SELECT hash_type, length(hash)::INT AS hash_length, count(*) AS claims FROM claims GROUP BY ALL""",
    "owner_of_hash": f"WITH {_OWNERS} SELECT hash, clink, hash_type FROM owners",
    "owner_over_loads": f"WITH {_OWNERS} SELECT hash, clink, hash_type FROM owners",
    "owner_changes": f"""WITH {_LOAD_OWNERS}
        SELECT a.hash, a.clink, a.hash_type, b.clink AS before FROM after a LEFT JOIN before b ON a.hash = b.hash
        WHERE b.hash IS NULL OR (a.clink, a.hash_type) <> (b.clink, b.hash_type)""",
    "counters_over_loads": f"""WITH {_RECORDS}
        SELECT {_FAULT} AS reason, count(*) AS n, true AS near FROM claims WHERE hash IS NOT NULL GROUP BY ALL""",
    "observed_counters": f"""WITH {_RECORDS}
        SELECT 'lines' AS counter, count(*) AS n FROM records UNION ALL SELECT 'width', count(*) FROM records WHERE len(f) < 4""",
    "mappings_per_pel": f"WITH {_MAPPING} SELECT pel, count(*) AS mappings FROM mapping GROUP BY pel",
    "hash_check_counters": f"""WITH {_RECORD_REJECTS}
        SELECT reason, count(*) AS n FROM rejects GROUP BY reason
        UNION ALL SELECT 'success', count(*) FROM mapping""",
    "two_way_forward": f"""WITH {_LINKS}
        SELECT DISTINCT key AS row_key, 'links' AS family, linked AS qualifier, 2000::BIGINT AS ts_micros, '' AS value FROM links""",
    "two_way_reverse": f"""WITH {_LINKS}
        SELECT DISTINCT linked AS row_key, 'links' AS family, key AS qualifier, 2000::BIGINT AS ts_micros, '' AS value FROM links""",
    "two_way_fan_out": f"""WITH all_tokens AS (
            SELECT value, list_filter(string_split(value, '|'), lambda t: t <> '') AS t FROM ({_lines('two_way_lines')})), {_LINKS}
        SELECT DISTINCT 'forward' AS sink, key, linked FROM links
        UNION ALL SELECT DISTINCT 'reverse', linked, key FROM links
        UNION ALL SELECT 'rejects', value, 'no_value' FROM all_tokens WHERE len(t) < 2""",
    "one_to_many_rows": f"WITH {_LINKS} SELECT key, linked FROM links",
    "pii_expansion": f"""WITH {_PEOPLE}, {_GROUPS}
        SELECT DISTINCT '{REGION}#' || kind || '#' || hash AS row_key, 'group' AS family, group_key AS qualifier,
            2000::BIGINT AS ts_micros, '' AS value FROM listed
        UNION ALL
        SELECT group_key, kind, hash, 2000::BIGINT, CASE WHEN in_both THEN 'both' ELSE '' END FROM listed""",
    "pii_expansion_rejects": f"WITH {_PEOPLE} SELECT value, 'width' AS reason FROM words WHERE len(w) <> 2",
    "pii_expansion_lookup": f"""WITH {_PEOPLE}, {_GROUPS}, asked AS ({_ASKED_BY_CUSTOMER}),
        reached AS (SELECT DISTINCT kind, hash, group_key FROM listed JOIN asked USING (kind, hash)),
        sizes AS (SELECT group_key, count(*) AS n, count(*) FILTER (in_both) // 2 AS n_both FROM listed GROUP BY group_key),
        same AS (SELECT r.kind, r.hash, r.group_key, sum(CASE WHEN l.kind = r.kind THEN 1 WHEN l.in_both THEN -1 ELSE 0 END)::BIGINT AS n_same
                 FROM reached r JOIN listed l ON l.group_key = r.group_key AND lower(l.hash) = lower(r.hash)
                 GROUP BY r.kind, r.hash, r.group_key)
        SELECT '{REGION}#' || kind || '#' || hash AS row_key, 'group' AS family, group_key AS qualifier, '' AS value,
            n - n_both - n_same AS n_links
        FROM reached JOIN sizes USING (group_key) JOIN same USING (kind, hash, group_key)
        UNION ALL SELECT group_key, kind, hash, CASE WHEN in_both THEN 'both' ELSE '' END, NULL FROM listed
        WHERE group_key IN (SELECT group_key FROM reached)""",
    "pii_expansion_pairs": f"""WITH {_PEOPLE}, asked AS ({_ASKED})
        {_pairs('owned', 'SELECT o.* FROM owned o JOIN (SELECT DISTINCT kind, hash FROM asked) USING (kind, hash)')}""",
    "id_hash_pairs": f"WITH {_PEOPLE} SELECT w[1] AS id, w[2] AS hash FROM words WHERE kind = 'email' AND len(w) = 2",
    "match_load_join": f"""WITH kb AS ({_csv('kb_lines')}), provider AS ({_csv('provider_lines')}),
        joined AS (SELECT {_pel('f[1]')} AS pel, f[2] AS md5, f[3] AS sha1, f[4] AS sha256 FROM kb
            WHERE trim(f[1]) <> '' AND f[4] IN (SELECT f[2] FROM provider WHERE f[2] <> ''))
        {_hash_cells('SELECT * FROM joined')}""",
    "match_load_join_rejects": f"""WITH kb AS ({_csv('kb_lines')}), provider AS ({_csv('provider_lines')})
        SELECT 'blank_sha256' AS reason, count(*) AS n FROM provider WHERE f[2] = ''
        UNION ALL SELECT 'blank_clink', count(*) FROM kb WHERE trim(f[1]) = ''""",
    "match_load_by_length": f"""WITH {_BY_LENGTH}, keyed AS (SELECT key AS pel, md5, sha1, sha256 FROM by_length WHERE key <> '')
        {_hash_cells('SELECT * FROM keyed')}""",
    "first_hash_by_length": f"WITH {_BY_LENGTH} SELECT key, md5, sha1, sha256 FROM by_length",
    "csv_columns": f"""SELECT f[1] AS clink, f[2] AS md5, f[4] AS sha256, CAST(NULL AS VARCHAR) AS absent
        FROM ({_csv('kb_lines')}) WHERE trim(f[1]) <> ''""",
    "match_table_cells": f"""WITH stored AS ({_lines('match_rows')})
        SELECT pel AS row_key, 'hashes' AS family, qualifier, 0::BIGINT AS ts_micros, value
        FROM (UNPIVOT stored ON md5, sha1, sha256 INTO NAME qualifier VALUE value)""",
    "match_lookup_latest": _match_lookup(_NOT_BLANK),
    "match_lookup_blank_matches_all": _match_lookup(""),
    "match_lookup_of_one_family": _match_lookup(_NOT_BLANK),
    "match_delivery_file": _match_lookup(_NOT_BLANK),
    "request_pairs": f"WITH {_REQUESTS} SELECT cookie, pel FROM requests",
    "hash_repair": f"""SELECT pel AS row_key, coalesce({_first(32, 'h')}, '') AS md5,
            coalesce({_first(40, 'h')}, '') AS sha1, coalesce({_first(64, 'h')}, '') AS sha256
        FROM (SELECT pel, {_filed()} AS h FROM ({_lines('match_rows')}))""",
    "latest_cells": f"WITH {_LATEST} SELECT * FROM latest",
    "row_pivot": f"""WITH {_LATEST}
        SELECT row_key, max(value) FILTER (qualifier = 'md5') AS md5,
            max(value) FILTER (qualifier = 'sha1') AS sha1, max(value) FILTER (qualifier = 'sha256') AS sha256
        FROM latest GROUP BY row_key""",
    "upsert_and_delete": f"""WITH {_LATEST},
        c AS (SELECT *, '0000GB' || upper(substr(md5(CAST(c_custkey AS VARCHAR)), 1, 10)) AS row_key,
                CASE c_mktsegment WHEN 'BUILDING' THEN 0 ELSE 2000 END::BIGINT AS ts FROM customer),
        puts AS (SELECT row_key, 'hashes' AS family, 'md5' AS qualifier, ts AS ts_micros, md5(c_name) AS value FROM c
                 UNION ALL SELECT row_key, 'hashes', 'sha1', ts, sha1(c_name) FROM c),
        kept AS (SELECT * FROM latest WHERE row_key NOT IN (SELECT row_key FROM c WHERE c_acctbal < 0))
        SELECT row_key, family, qualifier, max(ts_micros) AS ts_micros, arg_max(value, (ts_micros, value)) AS value
        FROM (SELECT * FROM kept UNION ALL SELECT * FROM puts) GROUP BY row_key, family, qualifier""",
    "published_snapshot": _account_table("diff_old", "diff_new"),
    "appended_snapshot": _account_table("diff_old", "diff_new"),
    "account_parse_semicolons": f"WITH {_ACCOUNT} SELECT replace(cid, ',', ';') AS cid, pel FROM judged WHERE reason IS NULL",
    "account_key_parts_exact": f"SELECT ana, cid FROM ({_lines('accounts')}) WHERE ana = {ACCOUNT}",
    "account_parse": f"WITH {_ACCOUNT} SELECT cid, pel FROM judged WHERE reason IS NULL",
    "account_rejects": f"WITH {_ACCOUNT} SELECT value, reason FROM judged WHERE reason IS NOT NULL",
    "account_incremental_diff": _account_table("diff_old", "diff_new"),
    "account_incremental_arl": _account_table("arl_old", "arl_new"),
    "account_refresh_diff": _account_table(
        "diff_old", "diff_new", f"NOT starts_with(row_key, '{ACCOUNT}#')"
    ),
    "account_refresh_arl": _account_table("arl_old", "arl_new", f"ana <> {ACCOUNT}"),
    "account_folder_refresh_diff": _account_table(
        "diff_old", "diff_new", f"NOT starts_with(row_key, '{ACCOUNT}#')"
    ),
    "account_folder_refresh_arl": _account_table("arl_old", "arl_new", f"ana <> {ACCOUNT}"),
    "account_folder_files": f"""WITH accounts AS ({_lines('accounts')})
        SELECT DISTINCT ana::INT AS ana, ana <> {ACCOUNT} AS untouched FROM accounts""",
    "account_refresh_prefix_diff": _account_table(
        "diff_old", "diff_new", f"NOT starts_with(row_key, '{ACCOUNT}')"
    ),
    "account_refresh_prefix_arl": _account_table("arl_old", "arl_new", "ana = 1"),
    "account_key_scan": f"SELECT DISTINCT {_OLD_KEY} AS row_key FROM ({_lines('accounts')}) WHERE ana = {ACCOUNT}",
    "account_key_parts": f"SELECT ana, cid FROM ({_lines('accounts')})",
    "identifier_translation": f"""WITH s AS (
            SELECT max(md5(r_name)) FILTER (r_regionkey = 0) AS s0, max(md5(r_name)) FILTER (r_regionkey = 1) AS s1,
                max(md5(r_name)) FILTER (r_regionkey = 2) AS s2 FROM region)
        SELECT ana, cid, 'Xi' || substr(sha256(s0 || '|pel|' || pel), 1, 32) AS pel,
            {_account_arl('ana', 'cid', 's1')} AS arl, {_hash_arl('md5(cid)', "'MD5'", 's2')} AS hash_arl
        FROM ({_lines('accounts')}), s""",
    "identifier_predicates": f"""SELECT value,
            length(w) = 16 AND (w LIKE '0000GB%' OR w LIKE '0000FR%') AS clink, w LIKE 'XY%' OR w LIKE 'Xi%' AS pel
        FROM (SELECT value, string_split(replace(value, ',', '|'), '|')[1] AS w FROM (
            {_lines('identity_lines')} UNION ALL {_lines('person_lines')}
            UNION ALL SELECT pel FROM ({_lines('match_rows')})))""",
    "text_rules": f"""SELECT {_TRIM.format('value')} AS trimmed,
            {_UNQUOTE.format(_TRIM.format('value'))} AS unquoted, trim(value, ' ' || chr(9)) = '' AS blank,
            len(f)::INT AS width,
            CASE WHEN length(f[2]) % 2 = 1 THEN 'odd_length' WHEN NOT regexp_full_match(f[2], '[0-9a-fA-F]+') THEN 'bad_chars' END AS fault
        FROM (SELECT value, string_split(rtrim(value, '|'), '|') AS f FROM (
            {_lines('account_lines')} UNION ALL {_lines('identity_lines')}))""",
    "encrypt_round_trip": f"""WITH {_PERSON} SELECT {_pel('f[1]')} AS pel, {_ENCRYPTED},
            coalesce(array_to_string(f[15:], ','), '') AS surplus FROM valid""",
    "encrypt_rejects": f"""WITH {_PERSON}
        SELECT value, 'invalid_id' AS reason FROM person ANTI JOIN (SELECT DISTINCT value FROM valid) USING (value)""",
    "ciphertext_of_fields": f"""WITH {_PERSON}, x AS (SELECT unnest(f[2:]) AS t FROM valid)
        SELECT count(*) AS fields, count(DISTINCT t) AS texts, count(DISTINCT t) AS ciphertexts, 0::BIGINT AS unchanged
        FROM x WHERE trim(t) <> ''""",
    "encrypted_file": f"""WITH {_PERSON}
        SELECT array_to_string(list_prepend({_pel('f[1]')},
            list_transform(f[2:], lambda x: CASE WHEN trim(x) = '' THEN '' ELSE x END)), ',') AS value FROM valid""",
    "decrypt_files_lines": f"""SELECT CAST(doc_id AS VARCHAR) AS path, (unnest(range(len(l))))::INT AS line_no, unnest(l) AS value
        FROM (SELECT doc_id, {_TEXT_LINES} AS l FROM documents WHERE lang <> 'de' AND text <> '')""",
    "decrypt_files_rejects": "SELECT CAST(doc_id AS VARCHAR) AS path, 'decrypt_failed' AS reason FROM documents WHERE lang = 'de'",
    "decrypt_blocks_lines": f"""{_WHOLE} SELECT path, line_no, value FROM l
        WHERE path NOT IN (SELECT source FROM documents WHERE lang = 'de' AND source = 'src2')""",
    "decrypt_framed_lines": f"{_WHOLE} SELECT path, line_no, value FROM l",
    "decrypted_file_lines": f"{_WHOLE} SELECT value FROM l",
    "single_file_delivery": f"""WITH {_PEOPLE}
        SELECT 1::BIGINT AS files, count(*) AS lines, count(DISTINCT (w[1], w[2])) AS different FROM words WHERE kind = 'email' AND len(w) = 2""",
    "compressed_text_scan": _lines("identity_lines"),
    "binary_file_scan": _lines("identity_lines"),
    "recent_pels_by_day": """SELECT DISTINCT 'Xi' || md5(c_name) AS pel
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE c_nationkey = 3 AND o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 90 DAY""",
    "recent_pels_of_country": """SELECT DISTINCT 'Xi' || md5(c_name) AS pel
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE c_nationkey = 3 AND o_orderdate >= (SELECT max(o_orderdate) FROM orders) - INTERVAL 90 DAY""",
}

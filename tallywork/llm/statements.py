"""DuckDB SQL of the operations that SQL expresses, written independently of the Spark code."""

from __future__ import annotations

STATEMENTS: dict[str, str] = {}

STATEMENTS["op7_temperature_mixing"] = r"""
WITH sizes AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS tokens, substr(md5(coalesce(text, '')), 1, 15) AS mark FROM documents
), sources AS (
    SELECT source, CAST(sum(tokens) AS BIGINT) AS total FROM sizes GROUP BY source
), shares AS (
    SELECT source, total, CAST(total AS DOUBLE) / CAST(sum(total) OVER () AS DOUBLE) AS p FROM sources
), exponent AS (
    SELECT CASE WHEN max(p) / min(p) <= 2.0 THEN 0.0 ELSE 1 - ln(2.0) / ln(max(p) / min(p)) END AS x FROM shares WHERE total > 0
), raw AS (
    SELECT source, total, CASE WHEN total > 0 THEN pow(p, x) ELSE 0 END AS w FROM shares, exponent
), plan AS (
    SELECT source, total, CAST(round(w * (SELECT max(total / w) FROM raw WHERE w > 0)) AS BIGINT) AS budget FROM raw
), reads AS (
    SELECT s.doc_id, s.source, s.tokens, s.mark, p.budget, unnest(range(0, CAST(greatest(1, ceil(p.budget / greatest(p.total, 1))) AS BIGINT))) AS pass
    FROM sizes s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source
), keyed AS (
    SELECT *, CAST('0x' || substr(md5('mix|' || pass || '|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || CAST(CAST('0x' || mark AS BIGINT) AS VARCHAR)), 1, 15) AS BIGINT) AS key
    FROM reads WHERE tokens > 0 OR pass = 0
), placed AS (
    SELECT *, coalesce(sum(tokens) OVER (PARTITION BY source ORDER BY pass, key, doc_id, mark ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM keyed
), blocks AS (
    SELECT greatest(1, CAST(ceil(sum(budget) / 1000000.0) AS BIGINT)) AS n FROM plan
), kept AS (
    SELECT doc_id, source, tokens, pass, least(n - 1, CAST(CAST(start AS HUGEINT) * n // greatest(budget, 1) AS BIGINT)) AS block
    FROM placed, blocks WHERE start < budget OR tokens = 0
)
SELECT doc_id, source, CAST(pass AS INTEGER) AS pass, block,
    CAST(row_number() OVER (PARTITION BY block ORDER BY CAST('0x' || substr(md5('mix|block|' || pass || '|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT), doc_id, source, tokens) AS INTEGER) AS place
FROM kept
"""

STATEMENTS["op5_perspective_rotation"] = """
WITH said AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, substr(md5(role || '|' || text), 1, 2), role, text) - 1 AS position FROM (
        SELECT DISTINCT conv_id, CAST(turn AS BIGINT) AS turn, role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL AND role IS NOT NULL
    ) d
), speakers AS (
    SELECT DISTINCT conv_id, role AS perspective FROM said WHERE role <> 'system'
), lines AS (
    SELECT s.*, p.perspective, CAST(position // 256 AS BIGINT) AS part,
        '<|im_start|>' || CASE WHEN role = 'system' THEN 'system' WHEN role = perspective THEN 'assistant' ELSE 'user name=' || role END || chr(10) AS head,
        text || '<|im_end|>' || chr(10) AS body, role = perspective AS learned
    FROM said s JOIN speakers p USING (conv_id)
), placed AS (
    SELECT *, coalesce(sum(length(head) + length(body)) OVER (
        PARTITION BY conv_id, perspective, part ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM lines
)
SELECT conv_id, perspective, part, count(*) AS n_turns, CAST(coalesce(sum(length(body)) FILTER (WHERE learned), 0) AS BIGINT) AS n_masked,
    string_agg(head || body, '' ORDER BY position) AS rendered,
    coalesce(string_agg(CAST(before + length(head) AS BIGINT) || ':' || CAST(before + length(head) + length(body) AS BIGINT), ',' ORDER BY position) FILTER (WHERE learned), '') AS mask
FROM placed GROUP BY conv_id, perspective, part
"""


def _number(*parts: str) -> str:
    return f"CAST('0x' || substr(md5({' || chr(124) || '.join(parts)}), 1, 8) AS BIGINT)"


def _day(*parts: str) -> str:
    return f"DATE '2024-01-01' + CAST({_number(*parts)} % 366 AS INTEGER)"


def _action(*parts: str) -> str:
    return f"(['block', 'allow', 'drop', NULL])[{_number(*parts)} % 4 + 1]"


_HOST = r"regexp_replace(lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '\.+$', '')"
_PATH = r"regexp_replace(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/+$', '')"

STATEMENTS["op6_temporal_list_join"] = rf"""
WITH captures AS (
    SELECT page_id, {_HOST} AS host, {_PATH} AS path, {_day("'fetch'", "page_id")} AS fetched_on, row_number() OVER () AS n FROM pages
), entries AS (
    SELECT regexp_replace(host, '^(www|m|blog)\.', '') AS key, {_action("'action'", "host", "i")} AS action, {_day("'day'", "host", "i")} AS listed_on
    FROM (SELECT DISTINCT host FROM captures WHERE host <> '') h, (SELECT unnest(range(3)) AS i) t
    UNION ALL
    SELECT host || path, {_action("'page'", "page_id")}, {_day("'listed'", "page_id")} FROM captures WHERE host <> ''
), days AS (
    SELECT key, listed_on, arg_min(action, list_position(['block', 'allow', 'drop'], action)) AS action FROM entries WHERE action IS NOT NULL GROUP BY key, listed_on
), spans AS (
    SELECT key, action, listed_on AS valid_from, lead(listed_on) OVER (PARTITION BY key ORDER BY listed_on) AS valid_to
    FROM (SELECT *, lag(action) OVER (PARTITION BY key ORDER BY listed_on) AS before FROM days) d WHERE before IS NULL OR before <> action
), asked AS (
    SELECT n, fetched_on, unnest(every) AS key, generate_subscripts(every, 1) AS place FROM (
        SELECT n, fetched_on, CASE WHEN path = '' THEN domains ELSE list_prepend(host || path, domains) END AS every FROM (
            SELECT *, [array_to_string(string_split(host, '.')[i:], '.') FOR i IN range(1, greatest(1, len(string_split(host, '.')) - 1) + 1)] AS domains FROM captures WHERE host <> ''
        ) x
    ) y
), hits AS (
    SELECT n, arg_min({{'action': action, 'key': key, 'since': valid_from}}, place) AS hit
    FROM asked JOIN spans USING (key) WHERE valid_from <= fetched_on AND (valid_to IS NULL OR fetched_on < valid_to) AND action <> 'drop' GROUP BY n
)
SELECT page_id, host, fetched_on, coalesce(hit.action, 'none') AS verdict, hit.key AS list_key, hit.since AS active_since
FROM captures LEFT JOIN hits USING (n)
"""

_KINDS = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
    "github": (r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    "pem": (r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", 0, 1),
}


def _kind(rank: int, kind: str, pattern: str, group: int, least: int) -> str:
    return f"""
    SELECT doc_id, {rank} AS rank, '{kind}' AS kind, s AS start, s + length(m) AS stop FROM (
        SELECT doc_id, matches[i] AS m, vals[i] AS v, CAST(list_sum([length(g) FOR g IN gaps[1:i]]) + coalesce(list_sum([length(x) FOR x IN matches[1:i-1]]), 0) AS BIGINT) AS s
        FROM (
            SELECT *, unnest(range(1, len(matches) + 1)) AS i FROM (
                SELECT doc_id, regexp_extract_all(text, '{pattern}', 0) AS matches, regexp_extract_all(text, '{pattern}', {group}) AS vals, regexp_split_to_array(text, '{pattern}') AS gaps
                FROM docs WHERE regexp_matches(text, '{pattern}')
            ) a
        ) b
    ) c WHERE length(v) >= {least}"""


STATEMENTS["op8_secret_ledger"] = rf"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
spans AS ({" UNION ALL ".join(_kind(i, k, *v) for i, (k, v) in enumerate(_KINDS.items()))}),
listed AS (
    SELECT doc_id, count(*) FILTER (WHERE rank = 0) AS a, count(*) FILTER (WHERE rank = 1) AS b, count(*) FILTER (WHERE rank = 2) AS c,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (WHERE rank < 3) AS base,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS every
    FROM spans GROUP BY doc_id
)
SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(b, 0) AS n_access, coalesce(c, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(every, '') AS spans
FROM docs LEFT JOIN listed USING (doc_id)
"""

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + "".join(chr(c) for c in range(0xC0, 0xDF) if c != 0xD7)

STATEMENTS["op3_cross_entropy_difference"] = rf"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1), false) AS marked,
        list_append(regexp_extract_all(translate(coalesce(text, ''), '{_CAPITALS}', '{_CAPITALS.lower()}'), '[0-9A-Za-z\x{{80}}-\x{{10FFFF}}]+'), '') AS words
    FROM documents
), symbols AS (
    SELECT r, doc_id, marked, unnest(words) AS word, unnest(list_prepend('', words[1:len(words) - 1])) AS context FROM texts
), own AS (
    SELECT r, marked, NULL AS context, word, count(*) AS c FROM symbols GROUP BY r, marked, word
    UNION ALL
    SELECT r, marked, context, word, count(*) FROM symbols GROUP BY r, marked, context, word
), counts AS (
    SELECT context, word, sum(c) AS n, coalesce(sum(c) FILTER (WHERE marked), 0) AS m FROM own GROUP BY context, word
), total AS (
    SELECT CAST(sum(n) AS DOUBLE) AS n, CAST(sum(m) AS DOUBLE) AS m, 0.5 * (count(*) FILTER (WHERE n > 1) + 1) AS size FROM counts WHERE context IS NULL
), others AS (
    SELECT o.r, o.context, o.c, unnest([CAST(k.m AS DOUBLE), CAST(greatest(k.m - o.c, 0) AS DOUBLE), t.m / t.n * CAST(k.n - o.c AS DOUBLE)]) AS x, unnest([1, 2, 3]) AS side, t.size
    FROM own o JOIN counts k ON o.word = k.word AND o.context IS NOT DISTINCT FROM k.context, total t WHERE k.n > 1
), sums AS (
    SELECT r, side, CAST(sum(round(c * (ln((x + 0.5) / 0.5) - CASE WHEN context IS NULL THEN ln((x + size) / size) ELSE 0 END) * 4294967296)) AS DOUBLE) AS g FROM others GROUP BY r, side
), sides AS (
    SELECT r, max(g) FILTER (WHERE side = 1) AS outside, max(g) FILTER (WHERE side = 2) AS inside, max(g) FILTER (WHERE side = 3) AS background FROM sums GROUP BY r
), losses AS (
    SELECT doc_id, len(words) AS s,
        (ln(t.m - CASE WHEN marked THEN len(words) ELSE 0 END + size) - 2 * ln(0.5) + ln(size) - coalesce(CASE WHEN marked THEN inside ELSE outside END, 0) / (len(words) * 4294967296.0::DOUBLE)) / 2 AS target,
        (ln(t.m / t.n * (t.n - len(words)) + size) - 2 * ln(0.5) + ln(size) - coalesce(background, 0) / (len(words) * 4294967296.0::DOUBLE)) / 2 AS background
    FROM texts LEFT JOIN sides USING (r), total t
)
SELECT doc_id, CAST(s AS BIGINT) AS n_symbols, round(target, 9) AS target_loss, round(background, 9) AS background_loss, round(target - background, 9) AS score FROM losses
"""

STATEMENTS["op4_ngram_jaccard_join"] = r"""
WITH RECURSIVE texts AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE unnest([array_to_string(w[i:i + 2], ' ') FOR i IN range(1, greatest(len(w) - 1, 2))]) END AS s
    FROM texts WHERE len(w) > 0
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
    SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared >= 90 * (x.n + y.n - shared)
), reach AS (
    SELECT DISTINCT a AS doc_id, a AS other FROM links
    UNION
    SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other
), least AS (
    SELECT doc_id, min(other) AS component FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, doc_id) AS component_id FROM texts LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
"""

"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

import re

from tallyhouse.llm import quality, urlfilter

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WORD = r"[^\x20\x09-\x0D]+"


def lowered(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{CAPITALS}', '{CAPITALS.lower()}')"


NEAR_DUPLICATES = f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({lowered('text')}, '{WORD}') AS ws FROM documents),
s AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(ws) = 0 THEN []
        WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS shingle
    FROM w),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
    FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
    WHERE 100 * shared >= 80 * (x.size + y.size - shared)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (
    SELECT a, b FROM both_ways
    UNION
    SELECT r.a, l.b FROM reached r JOIN both_ways l ON r.b = l.a),
least_one AS (SELECT a, min(b) AS b FROM reached GROUP BY a)
SELECT w.doc_id, coalesce(n.size, 0)::BIGINT AS n_shingles, least(w.doc_id, coalesce(l.b, w.doc_id)) AS component_id,
    least(w.doc_id, coalesce(l.b, w.doc_id)) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least_one l ON l.a = w.doc_id
"""

PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({lowered('text')}, '{PLAIN_WORD}') AS ws FROM documents),
i AS (SELECT item_id, regexp_extract_all({lowered('text')}, '{PLAIN_WORD}') AS ws FROM benchmark),
sized AS (SELECT item_id, ws, least(10, len(ws)) AS size FROM i WHERE len(ws) > 0),
item_windows AS (
    SELECT DISTINCT item_id, size,
        unnest(list_transform(range(1, len(ws) - size + 2), lambda k: array_to_string(ws[k:k + size - 1], ' '))) AS words
    FROM sized),
sizes AS (SELECT DISTINCT size FROM sized),
own AS (SELECT doc_id, size, ws, unnest(range(1, len(ws) - size + 2)) AS pos FROM d, sizes WHERE len(ws) >= size),
doc_windows AS (SELECT doc_id, size, pos, array_to_string(ws[pos:pos + size - 1], ' ') AS words FROM own),
hits AS (SELECT doc_id, item_id, pos, o.size FROM doc_windows o JOIN item_windows w ON o.words = w.words AND o.size = w.size),
places AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS place FROM hits) GROUP BY doc_id),
items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ARCHIVES = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha256(html) AS payload_digest, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM f
"""


def quality_rules() -> str:
    gamma = (1 + quality.ERROR) / (1 - quality.ERROR)
    value = {
        "symbols_per_word": "n_symbols / greatest(n_words, 1)",
        "duplicate_line_share": "n_dup_lines / greatest(n_lines, 1)",
        "word_length": "word_chars / greatest(n_words, 1)",
    }
    long = " UNION ALL ".join(
        f"SELECT lang, source, '{name}' AS ratio, CASE WHEN {v} > 0 THEN ceil(ln({v}) / ln({gamma!r}))::INT END AS bucket FROM base WHERE NOT base_failed"
        for name, v in value.items()
    )
    levels = []
    for label, keys in (("own", "lang, source, "), ("lang", "lang, "), ("corpus", "")):
        part = f"PARTITION BY {keys}ratio"
        levels.append(f"""
{label}_ranked AS (
    SELECT {keys}ratio, bucket, sum(n) OVER ({part} ORDER BY bucket NULLS FIRST) AS below, sum(n) OVER ({part}) AS texts
    FROM (SELECT {keys}ratio, bucket, count(*) AS n FROM long GROUP BY ALL)),
{label}_level AS (
    SELECT {keys}ratio, max(texts) AS texts,
        min(coalesce(bucket, -2000000000)) FILTER (below >= ceil(texts * 0.25)) AS q1,
        min(coalesce(bucket, -2000000000)) FILTER (below >= ceil(texts * 0.75)) AS q3
    FROM {label}_ranked GROUP BY ALL)""")

    def middle(q: str) -> str:
        chosen = f"CASE WHEN o.texts >= {quality.MIN_GROUP} THEN o.{q} WHEN l.texts >= {quality.MIN_GROUP} THEN l.{q} ELSE c.{q} END"
        return f"CASE WHEN {chosen} = -2000000000 THEN 0 ELSE pow({gamma!r}, {chosen}) * {2 / (1 + gamma)!r} END"

    bounds, checks = [], []
    for name, (least, both) in quality.RATIOS.items():
        reach = f"{quality.FENCE} * greatest(q3 - q1, {least})"
        low = f"q1 - {reach}" if both else "0.0"
        bounds.append(f"max({low}) FILTER (ratio = '{name}') AS {name}_least, max(q3 + {reach}) FILTER (ratio = '{name}') AS {name}_most")
        checks.append(f"coalesce({value[name]} BETWEEN {name}_least AND {name}_most, true)")
    return f"""
WITH w AS (
    SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{WORD}')) AS ls
    FROM documents),
runs AS (
    SELECT doc_id, unnest(range(1, len(ws) - 3)) AS pos,
        unnest(list_transform(range(1, len(ws) - 3), lambda k: array_to_string(ws[k:k + 4], ' '))) AS run
    FROM w),
counted AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, run) AS n FROM runs),
again AS (SELECT doc_id, count(DISTINCT place) AS n_repeat_words FROM (SELECT doc_id, unnest(range(pos, pos + 5)) AS place FROM counted WHERE n > 1) GROUP BY doc_id),
counts AS (
    SELECT doc_id, lang, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
        len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
    FROM w LEFT JOIN again USING (doc_id)),
base AS (
    SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM counts),
long AS ({long}),{','.join(levels)},
limits AS (
    SELECT o.lang, o.source, o.ratio, {middle('q1')} AS q1, {middle('q3')} AS q3
    FROM own_level o JOIN lang_level l ON o.lang IS NOT DISTINCT FROM l.lang AND o.ratio = l.ratio JOIN corpus_level c ON o.ratio = c.ratio),
fences AS (SELECT lang, source, {', '.join(bounds)} FROM limits GROUP BY ALL)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND {' AND '.join(checks)} AS kept
FROM base LEFT JOIN fences f ON f.lang IS NOT DISTINCT FROM base.lang AND f.source IS NOT DISTINCT FROM base.source
"""


LINE_DEDUP = f"""
WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
runs AS (SELECT doc_id, unnest(range(1, len(ls) - 1)) AS pos, ls FROM l WHERE text IS NOT NULL),
w AS (SELECT doc_id, pos, ls[pos:pos + 2] AS lines FROM runs WHERE regexp_matches(array_to_string(ls[pos:pos + 2], ''), '{WORD}')),
later AS (SELECT doc_id, pos FROM w QUALIFY row_number() OVER (PARTITION BY lines ORDER BY doc_id, pos) > 1),
gone AS (SELECT DISTINCT doc_id, unnest([pos, pos + 1, pos + 2]) AS place FROM later),
cut AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id),
kept AS (
    SELECT doc_id, string_agg(line, chr(10) ORDER BY place) AS text
    FROM (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS place FROM l JOIN cut USING (doc_id))
    ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT l.doc_id, coalesce(len(ls), 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
    CASE WHEN n_removed IS NULL THEN l.text ELSE coalesce(kept.text, '') END AS text
FROM l LEFT JOIN cut USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


def url_filters() -> str:
    def pattern(glob: str) -> str:
        parts = re.split(r"(\*\*|\*)", glob)
        return "".join({"**": "(?s:.*)", "*": "[^/]*"}.get(p, re.escape(p)) for p in parts)

    sites = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in urlfilter.SITE_RULES)
    globs = " OR ".join(f"regexp_full_match('.' || host || path, '{pattern(g)}')" for g in urlfilter.BLOCKED_GLOBS)
    return f"""
WITH r(verdict, h, p) AS (VALUES {sites}),
u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS host, rest FROM u),
q AS (
    SELECT page_id, translate(host, '{CAPITALS}', '{CAPITALS.lower()}') AS host, regexp_extract(substr(rest, length(host) + 1), '^[^?#]*') AS path
    FROM h),
best AS (
    SELECT page_id, h || p AS rule, verdict FROM q JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
    QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC) = 1)
SELECT q.page_id, host, path, rule, coalesce(verdict, CASE WHEN {globs} THEN 'block' ELSE 'allow' END) AS verdict
FROM q LEFT JOIN best USING (page_id)
"""


def crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    bits = "list_reduce([xor(c, b) & 255, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)"
    start = f"list_concat([4294967295], list_transform(string_split({text}, ''), lambda x: ord(x)::BIGINT))"
    return f"xor(list_reduce({start}, lambda c, b: xor(c // 256, {bits})), 4294967295)"


def conversation_repair() -> str:
    """Row by row: for each of four states (none yet, system, user, assistant) the cheapest and then least way there."""

    def arc(state: str, letter: str, cost: str, line: str | None = None) -> str:
        lines = f"{state}.r" if line is None else f"list_append({state}.r, {line})"
        return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 'r': {lines}}} END"

    def stays(state: str, role: str, initial: str) -> list[str]:
        kept = f"CASE WHEN initial = '{initial}' AND fault IN (0, 3) THEN {arc(state, 'K', 'cut', 'own')} END"
        return [kept, f"CASE WHEN fault IN (0, 3) THEN {arc(state, 'R', '2 + cut', f"'{role}:' || text")} END"]

    def least(*ways: str) -> str:
        return f"list_min([{', '.join(ways)}])"

    gone = {s: arc(s, "D", "3") for s in ("s0", "s1", "s2", "s3")}
    system = f"CASE WHEN initial = 's' AND fault IN (0, 3) THEN {arc('s0', 'K', 'cut', 'own')} END"
    user = [way for s in ("s0", "s1", "s3") for way in stays(s, "user", "u")]
    added = [arc(s, "I", "2", "'user:'") for s in ("s0", "s1", "s3")]
    spaces = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH RECURSIVE d AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind
    FROM conversations),
damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM d WHERE kind <> 0),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, left(role, 1) AS initial,
        rtrim(text, {spaces}) AS body
    FROM damaged),
judged AS (
    SELECT *, CASE WHEN body = '' THEN 1 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
        WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault,
        coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au'), false) AS bad_pair
    FROM placed),
rows AS (SELECT *, (fault = 3)::BIGINT AS cut, role || ':' || text AS own FROM judged),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count_if(fault = 1)::BIGINT AS blank,
        count_if(fault = 2)::BIGINT AS duplicate, count_if(fault = 3)::BIGINT AS truncated, count_if(bad_pair)::BIGINT AS illegal, max(i) AS n
    FROM rows GROUP BY conv_id),
begin AS (
    SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'a': '', 'r': []::VARCHAR[]}} AS s0 FROM counts),
ways AS (
    SELECT conv_id, i, s0, NULL::STRUCT(c BIGINT, a VARCHAR, r VARCHAR[]) AS s1, {arc('s0', 'I', '2', "'user:'")} AS s2,
        {{'c': 4::BIGINT, 'a': 'II', 'r': ['user:', 'assistant:']}} AS s3 FROM begin
    UNION ALL
    SELECT conv_id, i, s0, s1, s2, {least('s3', arc('s2', 'I', '2', "'assistant:'"))} AS s3
    FROM (
        SELECT conv_id, i, s0, s1, {least('s2', *added)} AS s2, s3
        FROM (
            SELECT rows.conv_id, rows.i, {gone['s0']} AS s0, {least(gone['s1'], system)} AS s1, {least(gone['s2'], *user)} AS s2,
                {least(gone['s3'], *stays('s2', 'assistant', 'a'))} AS s3
            FROM ways JOIN rows ON ways.conv_id IS NOT DISTINCT FROM rows.conv_id AND ways.i + 1 = rows.i))),
best AS (
    SELECT c.*, {least('s0', 's3')} AS way FROM counts c JOIN ways w ON c.conv_id IS NOT DISTINCT FROM w.conv_id AND c.n = w.i)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, coalesce(way.c, 0) AS cost, coalesce(way.a, '') AS audit,
    sha256(coalesce(array_to_string(way.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e LEFT JOIN best b ON e.conv_id IS NOT DISTINCT FROM b.conv_id
"""

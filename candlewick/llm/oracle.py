"""DuckDB SQL for the operators that SQL can express, written apart from the Spark code."""

from __future__ import annotations

from candlewick.llm.quality_rules import STOP_WORDS

_SPACE = r"[\x20\x09-\x0D]+"

OP7 = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}'), lambda x: x <> '') AS w,
         row_number() OVER () AS rid
  FROM documents
), win AS (
  SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)
), again AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n > 1
), cover AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(i, i + 8)) AS p FROM again) GROUP BY rid
), line AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT l) AS dup
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid
), c AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(line.dup, 0)::BIGINT AS n_dup_lines, coalesce(cover.n, 0)::BIGINT AS n_repeat_words,
         coalesce(line.n_lines, 0) AS n_lines,
         len(list_filter(w, lambda x: lower(rtrim(x, ',.;:!?')) IN ({", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))}))) AS n_stop
  FROM d LEFT JOIN line USING (rid) LEFT JOIN cover USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       (NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
        AND word_chars BETWEEN 2 * n_words AND 12 * n_words
        AND n_symbols / n_words <= 0.2 AND n_stop / n_words >= 0.05
        AND (n_lines = 0 OR n_dup_lines / n_lines <= 0.5)) AS kept
FROM c
"""

OP8 = r"""
WITH r AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id, rest,
         translate(regexp_extract(rest, '(?s)^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path,
         regexp_extract(rest, '(?s)^[^?#]*(\?[^#]*)?', 1) AS query
  FROM r
), f AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM p
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
    WHEN rule IS NOT NULL THEN 'allow'
    WHEN regexp_matches(host || path || query, '(?s)^[^/]*(casino|free-bets|cheap-pills|spam-farm)[^/]*/')
      OR regexp_matches(host || path || query, '(?s)^[^/]*/.*\.exe$')
      OR regexp_matches(host || path || query, '(?s)^[^/]*/.*/wp-login\.php') THEN 'block'
    ELSE 'allow' END AS verdict
FROM f
"""

OP10 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 9) AS k
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
  FROM d GROUP BY source
), fill(step, source, source_size, w, target) AS (
  -- rounds of sharing: sources above twice their size stop there
  SELECT 0, source, source_size, w, NULL::DOUBLE FROM s
  UNION ALL
  SELECT step + 1, source, source_size, w,
         CASE WHEN target IS NOT NULL THEN target
              WHEN 2 * source_size < share * w THEN (2 * source_size)::DOUBLE END
  FROM (SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(target) OVER (), 0))
                  / sum(CASE WHEN target IS NULL THEN w END) OVER () AS share FROM fill)
  WHERE step < 60
), t AS (
  SELECT source, source_size,
         coalesce(target, w * (1.5 * sum(source_size) OVER () - coalesce(sum(target) OVER (), 0))
                          / sum(CASE WHEN target IS NULL THEN w END) OVER ()) AS target
  FROM fill WHERE step = 60
), n AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM t
), g AS (
  SELECT d.source, k, sum(size) AS tokens FROM d GROUP BY d.source, k
), c AS (
  SELECT g.source, k, sum(tokens) OVER (PARTITION BY g.source ORDER BY k) AS upto, tokens,
         n.target - n.whole * n.source_size AS need
  FROM g JOIN n ON g.source IS NOT DISTINCT FROM n.source
), x AS (
  SELECT source, max(k) AS cut FROM c
  WHERE upto <= need OR (upto - tokens < need AND upto - need < need - (upto - tokens)) GROUP BY source
)
SELECT d.doc_id, d.size, n.source_size, n.target,
       CASE WHEN n.source_size = 0 THEN 0
            ELSE d.size * (n.whole + CASE WHEN d.k <= coalesce(x.cut, '') THEN 1 ELSE 0 END) END::BIGINT AS taken
FROM d JOIN n ON d.source IS NOT DISTINCT FROM n.source
LEFT JOIN x ON d.source IS NOT DISTINCT FROM x.source
"""

_UNIT = rf"{_SPACE[:-1]}*[^\x20\x09-\x0D]+|{_SPACE}"

OP12 = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_UNIT}') AS u,
         sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), k AS (
  SELECT *, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM d
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM k
), p AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

#: The rules in the order in which they are listed: kind, pattern, least length, and
#: where that length is measured ('' is the whole match, else what a lead is cut off).
_LEAD = """([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?"""
_SECRETS = [
    ("assign", _LEAD + "[A-Za-z0-9+/_.=-]+", 6, _LEAD),
    ("access", "AKIA[A-Z0-9]+", 20, ""),
    ("hex", "[0-9a-f]+", 24, ""),
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, ""),
    ("forge", "gh[pousr]_[A-Za-z0-9]{36,}", 0, ""),
]


def _found_sql(rank: int, kind: str, pattern: str, least: int, lead: str) -> str:
    """Matches of one kind with their places: what stands between matches, and the matches
    before, add up to the start of each."""
    inner = f"regexp_replace(m[i], '^{lead}', '')" if lead else "m[i]"
    return f"""
  SELECT rid, {rank} AS rank, '{kind}' AS kind, list_sum(lens[1:2 * i - 1])::BIGINT AS a, list_sum(lens[1:2 * i])::BIGINT AS b
  FROM (SELECT rid, m, flatten(list_transform(range(1, len(m) + 1), lambda j: [length(g[j]), length(m[j])])) AS lens,
               unnest(range(1, len(m) + 1)) AS i
        FROM (SELECT rid, regexp_extract_all(t, '{pattern}') AS m, regexp_split_to_array(t, '{pattern}') AS g FROM d
              WHERE regexp_matches(t, '{pattern}')))
  WHERE length({inner}) >= {least}"""


OP13 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
f AS ({" UNION ALL ".join(_found_sql(i, *rule) for i, rule in enumerate(_SECRETS))}),
s AS (
  SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank) FILTER (rank < 3) AS base,
         string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank) AS spans
  FROM f GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN s USING (rid)
"""

ORACLE_SQL: dict[str, str] = {
    "op7_quality_rules": OP7,
    "op8_url_filters": OP8,
    "op10_source_mix": OP10,
    "op12_fim": OP12,
    "op13_secrets": OP13,
}

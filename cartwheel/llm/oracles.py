"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP2 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text, {_WORDS} AS ws
           FROM documents),
grams AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
          FROM d, unnest(range(1, greatest(len(ws) - 1, 1))) AS u(i)),
again AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM grams),
covered AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM again, unnest([0, 1, 2]) AS v(k)
            WHERE n > 1 GROUP BY rid),
lines AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
          FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
m AS (SELECT d.rid, doc_id, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
             coalesce(n_lines, 0) AS n_lines
      FROM d LEFT JOIN covered USING (rid) LEFT JOIN lines USING (rid)),
f AS (SELECT *, n_words < 50 AS short, 100 * n_repeat_words > 50 * n_words AS repeats,
             100 * n_symbols > 25 * word_chars AS symbols, 100 * n_dup_lines > 30 * n_lines AS dups FROM m),
hosts AS (SELECT source, rule, count(*)::DOUBLE AS n, count(*) FILTER (failed)::DOUBLE AS x
          FROM (SELECT source, unnest(['short', 'repeats', 'symbols', 'dups']) AS rule,
                       unnest([short, repeats, symbols, dups]) AS failed FROM f WHERE source IS NOT NULL)
          GROUP BY source, rule),
pooled AS (SELECT rule, sum(x) / sum(n) AS p, count(*) AS h, sum(n) AS big_n, sum(n * n) / sum(n) AS q,
                  sum(x * x / n) - sum(x) * sum(x) / sum(n) AS s FROM hosts GROUP BY rule),
fitted AS (SELECT rule, p, 1 / least(greatest(coalesce(
               (s / nullif(p * (1 - p), 0) - (h - 1)) / nullif(big_n - q - h + 1, 0), 0), 1e-4), 0.99) - 1 AS strength
           FROM pooled),
rates AS (SELECT source, rule, (x + p * strength) / (n + strength) AS rate FROM hosts JOIN fitted USING (rule)),
verdicts AS (SELECT source, bool_and(rate <= 0.8) AS host_ok, bool_or(rule = 'short' AND rate > 0.02) AS short_strict,
                    bool_or(rule = 'repeats' AND rate > 0.02) AS repeats_strict,
                    bool_or(rule = 'symbols' AND rate > 0.02) AS symbols_strict,
                    bool_or(rule = 'dups' AND rate > 0.02) AS dups_strict FROM rates GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repeats AS base_failed,
       NOT (short OR repeats) AND coalesce(host_ok AND NOT (short AND short_strict OR repeats AND repeats_strict
           OR symbols AND symbols_strict OR dups AND dups_strict), TRUE) AS kept
FROM f LEFT JOIN verdicts USING (source)
"""

_HOST = r"translate(regexp_extract({url}, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PATH = r"regexp_extract({url}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
_NODE = (r"CASE WHEN contains({url}, '://') THEN " + _HOST
         + r" || regexp_extract({url}, '(?s)^.*?://[^/?#]*([^#]*)', 1) END")


def _of(pattern: str, url: str) -> str:
    return pattern.replace("{url}", url)


OP3 = rf"""
WITH RECURSIVE rules(verdict, rule) AS (VALUES ('allow', 'com/'), ('block', 'example.com/en/'),
    ('allow', 'www.example.com/en/'), ('block', 'net/es/'), ('block', 'net/fr/')),
p AS (SELECT page_id, {_of(_HOST, "coalesce(url, '')")} AS host, {_of(_PATH, "coalesce(url, '')")} AS path,
             {_of(_NODE, 'url')} AS node FROM pages),
tags AS (SELECT url, unnest(regexp_extract_all(regexp_replace(html,
             '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g'),
             '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM pages WHERE contains(url, '://')),
hrefs AS (SELECT url, replace(trim(CASE
    WHEN regexp_matches(tag, '(?is)^<link\b.*\brel\s*=\s*(?:"[^"]*\bcanonical\b|''[^'']*\bcanonical\b|canonical\b)')
    THEN regexp_extract(tag, '(?is)\bhref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>"'']+))', 1)
      || regexp_extract(tag, '(?is)\bhref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>"'']+))', 2)
      || regexp_extract(tag, '(?is)\bhref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>"'']+))', 3)
    WHEN regexp_matches(tag, '(?is)^<meta\b.*\bhttp-equiv\s*=\s*["'']?refresh\b')
    THEN regexp_extract(tag, '(?is)\bcontent\s*=\s*["'']?[\s\d.]*[;,]?\s*url\s*=\s*["'']?([^"''>\s]+)', 1) END),
    '&amp;', '&') AS href FROM tags),
links AS (SELECT url AS src, CASE
    WHEN regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN href
    WHEN starts_with(href, '//') THEN regexp_extract(url, '(?s)^(.*?)://', 1) || ':' || href
    WHEN starts_with(href, '/') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || href
    WHEN starts_with(href, '?') THEN regexp_extract(url, '(?s)^([^?#]*)', 1) || href
    WHEN href = '' OR starts_with(href, '#') OR regexp_matches(href, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
    ELSE regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1)
         || coalesce(nullif(regexp_replace({_of(_PATH, 'url')}, '[^/]*$', ''), ''), '/') || href END AS dst
    FROM hrefs WHERE href <> ''),
edges AS (SELECT DISTINCT {_of(_NODE, 'src')} AS a, {_of(_NODE, 'dst')} AS b FROM links WHERE dst IS NOT NULL),
both_ways AS (SELECT a, b FROM edges WHERE a <> b UNION SELECT b, a FROM edges WHERE a <> b),
reach(a, b) AS (SELECT a, a FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
fits AS (SELECT host, path, arg_min([verdict, rule], [lpad((9999 - length(rule))::VARCHAR, 4, '0'), verdict, rule]) AS best
         FROM (SELECT DISTINCT host, path FROM (SELECT host, path FROM p UNION ALL
               SELECT {_of(_HOST, "('x://' || b)")}, {_of(_PATH, "('x://' || b)")} FROM reach))
         JOIN rules ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
                   AND starts_with(path, substr(rule, length(split_part(rule, '/', 1)) + 1))
         GROUP BY host, path),
aliases AS (SELECT a AS node, CASE WHEN bool_or(best[1] = 'allow') THEN 'allow' ELSE 'block' END AS verdict
            FROM reach JOIN fits ON host = {_of(_HOST, "('x://' || b)")} AND path = {_of(_PATH, "('x://' || b)")}
            GROUP BY a)
SELECT page_id, p.host, p.path, best[2] AS rule, coalesce(best[1], aliases.verdict, 'allow') AS verdict
FROM p LEFT JOIN fits ON p.host = fits.host AND p.path = fits.path LEFT JOIN aliases ON p.node = aliases.node
"""

OP5 = rf"""
WITH d AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size,
                  md5(coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank,
             [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(rank % 3 + 1)::INT] AS weight, 2.0::DOUBLE * source_size AS cap
      FROM s),
levels AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
    - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, rank, CASE WHEN cap <= level * weight THEN cap ELSE weight *
          (SELECT arg_min(level, [cap / weight, rank]) FROM levels WHERE cap > level * weight) END AS target
      FROM levels),
placed AS (SELECT d.doc_id, size, source_size, target, rank, coalesce(sum(size) OVER (
        PARTITION BY d.source ORDER BY k, doc_id NULLS FIRST, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + size / 2 AS middle
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
shaped AS (SELECT *, [2.0, 1.0, 1.0][(rank % 3 + 1)::INT]::DOUBLE AS w0,
                  [-1.0, 0.0, 1.0][(rank % 3 + 1)::INT]::DOUBLE AS slope,
                  [1.5, 1.0, 1.5][(rank % 3 + 1)::INT]::DOUBLE AS whole FROM placed)
SELECT doc_id, size, source_size, target,
       (size * ((middle < target)::INT + (source_size + middle < target)::INT))::BIGINT AS taken,
       CASE WHEN middle < target THEN least(2 * (middle / target * whole)
            / (w0 + sqrt(w0 * w0 + 2 * slope * (middle / target * whole))), 1) END::DOUBLE AS position
FROM shaped
"""

OP9 = r"""
WITH said AS (SELECT conv_id, turn, floor(turn / 64)::BIGINT AS part, coalesce(nullif(trim(role), ''), 'unknown') AS speaker,
                     replace(coalesce(text, ''), '<|im_', '<| im_') AS txt FROM conversations),
people AS (SELECT DISTINCT conv_id AS of, speaker AS perspective FROM said WHERE speaker <> 'system'),
shown AS (SELECT conv_id, perspective, part, speaker = perspective AS own, txt,
                 row_number() OVER each AS i,
                 '<|im_start|>' || CASE speaker WHEN 'system' THEN 'system' WHEN perspective THEN 'assistant'
                     ELSE 'user name=' || regexp_replace(speaker, '[^\p{L}\p{N}_.-]', '_', 'g') END || chr(10) AS head
          FROM said JOIN people ON conv_id IS NOT DISTINCT FROM of
          WINDOW each AS (PARTITION BY conv_id, perspective, part ORDER BY turn NULLS FIRST, speaker, txt)),
placed AS (SELECT *, sum(length(head) + length(txt) + 11) OVER (
               PARTITION BY conv_id, perspective, part ORDER BY i) AS stop FROM shown)
SELECT conv_id, perspective, part, count(*) AS n_turns, count(*) FILTER (own) AS n_own,
       string_agg(head || txt || '<|im_end|>' || chr(10), '' ORDER BY i) AS rendered,
       coalesce(string_agg((stop - 11 - length(txt)) || ':' || (stop - 1), ',' ORDER BY i) FILTER (own), '') AS mask
FROM placed GROUP BY conv_id, perspective, part
"""

OP13 = """
WITH t AS (SELECT row_number() OVER () AS rid, vec_id,
                  CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
                  [floor(256 * x::DOUBLE) for x in embedding] AS q
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (SELECT a.rid AS anchor, a.vec_id AS anchor_id, b.rid, b.vec_id, a.label = b.label AS same,
                 list_sum([z[1] * z[2] for z in list_zip(a.q, b.q)])::BIGINT AS score
          FROM t a JOIN t b ON a.rid <> b.rid AND len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0),
positives AS (SELECT * FROM pairs WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, rid) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       (row_number() OVER (PARTITION BY p.anchor, p.rid ORDER BY n.score DESC, n.vec_id NULLS LAST, n.rid))::INTEGER AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON n.anchor = p.anchor AND NOT n.same
     AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor, p.rid ORDER BY n.score DESC, n.vec_id NULLS LAST, n.rid) <= 10
"""

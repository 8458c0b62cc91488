"""DuckDB SQL for the registered queries that SQL can express on whole tables."""

from __future__ import annotations

from math import ceil

from .decontaminate import SIMILARITY, STRETCH
from .line_dedup import MIN_CHARS
from .queries import URL_RULES
from .secret_scan import BASE, EXTRA
from .substring_dedup import WINDOW

NEED = ceil(SIMILARITY * STRETCH)
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)

OP1 = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM docs),
keyed AS (SELECT *, translate(trim(line, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
firsts AS (SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= {MIN_CHARS} GROUP BY k),
judged AS (SELECT doc_id, pos, line, length(keyed.k) >= {MIN_CHARS} AND first < doc_id AS gone FROM keyed LEFT JOIN firsts USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (gone IS NOT TRUE), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""

OP2 = f"""
WITH docs AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
items AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\\x20\\x09-\\x0D]+') AS ws FROM benchmark),
dw AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM docs),
iw AS (SELECT item_id, len(ws) AS n, unnest(ws) AS w, generate_subscripts(ws, 1) AS k FROM items),
diagonals AS (SELECT doc_id, item_id, n, p - k AS start, count(*) AS m, list(k ORDER BY k) AS ks FROM dw JOIN iw USING (w)
  GROUP BY ALL HAVING count(*) >= least(ceil(n * {SIMILARITY}::DOUBLE), {NEED})),
good AS (SELECT * FROM diagonals WHERE m >= ceil(n * {SIMILARITY}::DOUBLE)
  OR (n > {STRETCH} AND len(list_filter(range({NEED}, m + 1), lambda i: ks[i] - ks[i - {NEED - 1}] < {STRETCH})) > 0))
SELECT doc_id, item_id, arg_max(start, m * 1000000000 - start) AS start, max(m) AS n_matched, max(m) / n AS overlap, true AS contaminated
FROM good GROUP BY doc_id, item_id, n"""

OP3 = f"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
windows AS (SELECT doc_id, i, sha256(array_to_string(ws[i:i + {WINDOW - 1}], ' ')) AS w FROM docs, unnest(range(1, len(ws) - {WINDOW - 2})) AS g(i)),
firsts AS (SELECT w, min(doc_id) AS first FROM windows GROUP BY w),
late AS (SELECT doc_id, i FROM windows JOIN firsts USING (w) WHERE first < doc_id),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS pos FROM late),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM docs),
kept AS (SELECT words.doc_id, count(*) AS n, sha256(string_agg(word, ' ' ORDER BY words.pos)) AS h FROM words ANTI JOIN covered ON covered.doc_id = words.doc_id AND covered.pos = words.pos GROUP BY 1)
SELECT docs.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, coalesce(h, sha256('')) AS kept_sha256 FROM docs LEFT JOIN kept USING (doc_id)"""

OP6 = f"""
WITH rules(rh, rp, verdict) AS (VALUES {_RULES}),
cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM cut),
best AS (SELECT page_id, max_by(rh || rp, length(rh || rp)) AS rule, max_by(verdict, length(rh || rp)) AS verdict FROM parts JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY 1)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (page_id)"""


def _op8() -> str:
    """Every rule as lists of gaps, matches and groups; positions are sums over them."""
    lists, spans = [], []
    for place, r in enumerate(BASE + EXTRA):
        pattern = r.pattern.replace("'", "''")
        lists.append(f"regexp_split_to_array(x, '{pattern}') AS g{place}, regexp_extract_all(x, '{pattern}', 0) AS m{place}, regexp_extract_all(x, '{pattern}', {r.group}) AS n{place}")
        start = f"CAST(list_sum(list_transform(g{place}[1:i], lambda s: length(s))) + coalesce(list_sum(list_transform(m{place}[1:i - 1], lambda s: length(s))), 0) AS BIGINT)"
        spans.append(f"list_transform(list_filter(range(1, len(m{place}) + 1), lambda i: length(n{place}[i]) >= {r.least}), lambda i: {{'s': {start}, 'p': {place}, 'e': {start} + length(m{place}[i]), 'k': '{r.kind}'}}) AS s{place}")
    said = "array_to_string(list_transform(list_sort(list_concat({})), lambda z: z.k || ':' || z.s || ':' || z.e), ',')"
    base, every = (said.format(", ".join(f"s{k}" for k in range(n))) for n in (len(BASE), len(BASE + EXTRA)))
    return f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS x FROM documents), parts AS (SELECT doc_id, {", ".join(lists)} FROM docs), found AS (SELECT doc_id, {", ".join(spans)} FROM parts)
SELECT doc_id, {", ".join(f"CAST(len(s{k}) AS BIGINT) AS n_{r.kind}" for k, r in enumerate(BASE))}, sha256({base}) AS base_sha256, {every} AS spans FROM found"""


def oracle_sql() -> dict[str, str]:
    return {"op1_line_dedup": OP1, "op2_decontaminate": OP2, "op3_substring_dedup": OP3, "op6_url_filter": OP6, "op8_secret_scan": _op8()}

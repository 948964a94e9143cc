"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from reelrank.llm import licences

WORD = r"[^\x20\x09-\x0D]+"

OP10 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS dom, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, unnest(regexp_extract_all(t, '{WORD}')) AS x,
             generate_subscripts(regexp_extract_all(t, '{WORD}'), 1) AS i FROM d),
win AS (SELECT r, i, CASE WHEN lead(i, 7) OVER s IS NOT NULL THEN
          x || ' ' || lead(x, 1) OVER s || ' ' || lead(x, 2) OVER s || ' ' || lead(x, 3) OVER s || ' ' ||
          lead(x, 4) OVER s || ' ' || lead(x, 5) OVER s || ' ' || lead(x, 6) OVER s || ' ' || lead(x, 7) OVER s END AS k
        FROM w WINDOW s AS (PARTITION BY r ORDER BY i)),
twice AS (SELECT r, i, k IS NOT NULL AND count(*) OVER (PARTITION BY r, k) > 1 AS rep FROM win),
cov AS (SELECT r, i, max(rep::INT) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS c FROM twice),
rep AS (SELECT r, sum(c) AS n_repeat_words FROM cov GROUP BY r),
cnt AS (SELECT r, count(*) AS n_words, sum(length(x)) AS word_chars FROM w GROUP BY r),
ln AS (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d),
dup AS (SELECT r, count(*) - count(DISTINCT l) AS n_dup_lines, count(*) AS n_lines FROM ln WHERE regexp_matches(l, '{WORD}') GROUP BY r),
j AS (SELECT d.doc_id, dom, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_lines, 0)::BIGINT AS n_lines,
        coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN cnt USING (r) LEFT JOIN rep USING (r) LEFT JOIN dup USING (r)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
             100 * n_symbols > 10 * word_chars AS x1, 100 * n_dup_lines > 50 * n_lines AS x2,
             word_chars < 3 * n_words OR word_chars > 10 * n_words AS x3 FROM j),
h AS (SELECT dom, count(*) AS n, sum(base_failed::INT) AS f0, sum(x1::INT) AS f1, sum(x2::INT) AS f2, sum(x3::INT) AS f3
      FROM b GROUP BY dom),
u AS (UNPIVOT (SELECT dom, n, f0, f1, f2, f3 FROM h) ON f0, f1, f2, f3 INTO NAME rule VALUE f),
m AS (SELECT rule, avg(f / n) AS m, var_pop(f / n) AS v FROM u GROUP BY rule),
p AS (SELECT rule, m, CASE WHEN v > 0 THEN greatest(1.0, m * (1 - m) / v - 1) ELSE 1.0 END AS k FROM m),
rates AS (SELECT dom, rule, (f + k * m) / (n + k) AS rate FROM u JOIN p USING (rule)),
hosts AS (SELECT dom, max(rate) <= 0.5 AS host_kept, max(rate) FILTER (rule = 'f1') >= 0.01 AS d1,
                 max(rate) FILTER (rule = 'f2') >= 0.01 AS d2, max(rate) FILTER (rule = 'f3') >= 0.01 AS d3 FROM rates GROUP BY dom)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND host_kept AND NOT (x1 AND d1) AND NOT (x2 AND d2) AND NOT (x3 AND d3) AS kept
FROM b JOIN hosts USING (dom)
"""

_KEY = " || ' ' || ".join(f"lead(x, {k}) OVER s" if k else "x" for k in range(20))
OP7 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, unnest(regexp_extract_all(t, '{WORD}')) AS x,
             generate_subscripts(regexp_extract_all(t, '{WORD}'), 1) AS i FROM d),
win AS (SELECT r, doc_id, i, x, CASE WHEN lead(i, 19) OVER s IS NOT NULL THEN {_KEY} END AS k
        FROM w WINDOW s AS (PARTITION BY r ORDER BY i)),
rep AS (SELECT *, (k IS NOT NULL AND row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1)::INT AS again FROM win),
cov AS (SELECT *, max(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM rep),
s AS (SELECT r, count(*) AS n_words, sum(gone) AS n_removed,
             string_agg(x, ' ' ORDER BY i) FILTER (WHERE gone = 0) AS kept FROM cov GROUP BY r)
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s USING (r)
"""

_KNOWN, _UNKNOWN = licences.weights()
_NAMES = sorted(licences.TEMPLATES)
_VALUES = ", ".join(f"('{x}', {w!r}::DOUBLE, [{', '.join(f'{v!r}::DOUBLE' for v in vs)}])" for x, (w, vs) in _KNOWN.items())
_MARK = f"regexp_matches(%s, '{licences.MARKERS}')"
_FILE = f"regexp_matches(%s, '{licences.LICENCE_FILE}')"
_UP = "regexp_replace(%s, '/?[^/]*$', '')"
OP6 = rf"""
WITH d AS (SELECT doc_id, source, lang, coalesce(text, '') AS t FROM documents),
f AS (SELECT doc_id, t, concat_ws('/', coalesce(source, ''), coalesce(lang, ''),
        CASE WHEN len(regexp_split_to_array(trim(t, ' '), '[ \t\n\x0B\f\r]+')) < 60 AND {_MARK % 't'}
             THEN 'LICENSE-' || name ELSE name || '.txt' END) AS path
      FROM (SELECT *, concat_ws('-', coalesce(CAST(doc_id AS VARCHAR), 'none'), substring(md5(t), 1, 12)) AS name FROM d)),
ln AS (SELECT DISTINCT path, l FROM (SELECT path, unnest(string_split(t, chr(10))) AS l FROM f)
       WHERE ({_MARK % 'l'} OR ({_FILE % 'path'} AND regexp_matches(l, '[A-Za-z0-9]'))) AND NOT regexp_matches(l, '{licences.NEGATED}')),
tm AS (SELECT path, l, term, count(*) AS tf FROM (
         SELECT path, l, unnest(regexp_extract_all(lower(l), '({licences.TERM})', 1)) AS term FROM ln) GROUP BY ALL),
known(term, idf, ws) AS (VALUES {_VALUES}),
w AS (SELECT path, l, tf * coalesce(idf, {_UNKNOWN!r}::DOUBLE) AS w, ws FROM tm LEFT JOIN known USING (term)),
names AS (SELECT unnest({_NAMES!r}) AS name, unnest(range(1, {len(_NAMES) + 1})) AS i),
c AS (SELECT path, l, name, round(sum(coalesce(ws[i], 0.0) * w) / sqrt(sum(w * w)), 9) AS cosine
      FROM w CROSS JOIN names GROUP BY path, l, name),
own AS (SELECT path, regexp_replace(name, ' \(.*\)$', '') AS own, cosine FROM (
          SELECT *, row_number() OVER (PARTITION BY path ORDER BY cosine DESC, name) AS r FROM c
          WHERE cosine >= {licences.LEAST}) WHERE r = 1),
given AS (SELECT folder, own AS lic FROM (
            SELECT {_UP % 'path'} AS folder, own,
                   row_number() OVER (PARTITION BY {_UP % 'path'} ORDER BY cosine DESC, path) AS r
            FROM own WHERE {_FILE % 'path'}) WHERE r = 1),
p AS (SELECT doc_id, path, {_UP % 'path'} AS d2 FROM f),
a AS (SELECT path, folder, depth FROM (SELECT DISTINCT path, d2 FROM p), LATERAL (VALUES (d2, 2), ({_UP % 'd2'}, 1), ('', 0)) v(folder, depth)),
near AS (SELECT path, arg_max(folder, depth) AS from_dir, arg_max(lic, depth) AS lic FROM a JOIN given USING (folder) GROUP BY path)
SELECT doc_id, path, own, round(cosine, 6) AS cosine, CASE WHEN own IS NULL THEN lic END AS inherited,
       CASE WHEN own IS NULL THEN from_dir END AS from_dir, coalesce(own, lic) AS licence
FROM p LEFT JOIN own USING (path) LEFT JOIN near USING (path)
"""

ORACLE = {"op6_licence_scan": OP6, "op7_substring_dedup": OP7, "op10_host_rules": OP10}

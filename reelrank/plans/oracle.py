"""DuckDB SQL for the driver's correctness check.

Each statement is self-contained: the movie/rating/tag/rating_event
projections (FIXTURES.md) are CTEs over the pre-registered driver views.
"""

from __future__ import annotations

BASE_CTES = {
    "movie": """movie AS (
  SELECT CAST(p_partkey AS INT) AS mid, p_name AS name, concat_ws(' ', p_type, p_name) AS descri,
         concat_ws(' ', CAST(p_size AS VARCHAR), 'minutes') AS timelong, 'September 21, 2004' AS issue,
         CAST(1950 + p_size AS VARCHAR) AS shoot, 'English' AS language,
         concat_ws('|', p_type, p_brand, replace(p_name, ' ', '|')) AS genres,
         replace(p_name, ' ', '|') AS actors, p_brand AS directors
  FROM part)""",
    "rating": """rating AS (
  SELECT CAST(o_custkey AS INT) AS uid, CAST(l_partkey AS INT) AS mid,
         CAST(ceil(l_quantity / 5) AS DOUBLE) / 2 AS score,
         CAST(floor(epoch(l_shipdate)) AS INT) AS "timestamp"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "tag": """tag AS (
  SELECT CAST(o_custkey AS INT) AS uid, CAST(l_partkey AS INT) AS mid, o_orderpriority AS tag,
         CAST(floor(epoch(o_orderdate)) AS INT) AS "timestamp"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "rating_event": """rating_event AS (
  SELECT CAST(user_id AS INT) AS uid, CAST((event_id * 7919) % (SELECT count(*) FROM part) AS INT) AS mid,
         CAST((event_id * 7 + user_id) % 10 + 1 AS DOUBLE) / 2 AS score,
         CAST(floor(epoch(ts)) AS INT) AS "timestamp"
  FROM events)""",
}


def with_ctes(names: list[str], extra: list[str], body: str) -> str:
    """``WITH`` the named base projections, then ``extra`` CTE texts, then ``body``."""
    parts = [BASE_CTES[n] for n in names] + list(extra)
    return "WITH " + ",\n".join(parts) + "\n" + body


# Bucket of each fixture token under Spark's SQL ``hash`` mod 50
# (Murmur3, seed 42).  DuckDB has no Murmur3, so the oracle looks them up.
TOKEN_BUCKETS = [
    ("anvil", 46), ("blue", 18), ("bolt", 40), ("brand#1", 26), ("brand#10", 34), ("brand#11", 18),
    ("brand#12", 0), ("brand#13", 12), ("brand#14", 38), ("brand#15", 44), ("brand#16", 15),
    ("brand#17", 19), ("brand#18", 8), ("brand#19", 25), ("brand#2", 42), ("brand#20", 43),
    ("brand#21", 44), ("brand#22", 17), ("brand#23", 22), ("brand#24", 4), ("brand#25", 23),
    ("brand#3", 21), ("brand#4", 37), ("brand#5", 43), ("brand#6", 21), ("brand#7", 5),
    ("brand#8", 36), ("brand#9", 6), ("cold", 20), ("economy", 31), ("gear", 45), ("gizmo", 39),
    ("hot", 31), ("large", 32), ("medium", 25), ("new", 25), ("old", 22), ("plate", 6),
    ("promo", 24), ("red", 41), ("ring", 46), ("rod", 10), ("small", 42), ("standard", 17),
    ("widget", 47),
]

# TF-IDF and cosine in DuckDB.  Sums that feed the cosine are folds over
# term-ordered lists, the same order the Spark operator uses.
CONTENT_CTES = [
    "tok AS (SELECT mid, t.token, t.pos FROM movie, "
    "unnest(string_split(lower(replace(genres, '|', ' ')), ' ')) WITH ORDINALITY AS t(token, pos))",
    "bk AS (SELECT * FROM (VALUES " + ", ".join(f"('{t}', {b})" for t, b in TOKEN_BUCKETS)
    + ") v(token, term))",
    "tf AS (SELECT mid, term, CAST(count(*) AS DOUBLE) AS tf FROM tok JOIN bk USING (token) GROUP BY mid, term)",
    "idf AS (SELECT term, count(*) AS df, ln(((SELECT count(*) FROM movie) + 1) / (count(*) + 1)) AS idf "
    "FROM tf GROUP BY term)",
    "w AS (SELECT mid, term, tf, tf * idf AS w FROM tf JOIN idf USING (term))",
    "norms AS (SELECT mid, sqrt(list_reduce(list(w * w ORDER BY term), lambda x, y: x + y)) AS norm "
    "FROM w WHERE w != 0 GROUP BY mid)",
    "uvec AS (SELECT mid, term, w / norm AS u FROM w JOIN norms USING (mid) WHERE w != 0 AND norm > 0)",
    "sims AS MATERIALIZED (SELECT a.mid, b.mid AS other_mid, "
    "list_reduce(list(a.u * b.u ORDER BY a.term), lambda x, y: x + y) AS score "
    "FROM uvec a JOIN uvec b ON a.term = b.term AND a.mid != b.mid GROUP BY a.mid, b.mid "
    "HAVING list_reduce(list(a.u * b.u ORDER BY a.term), lambda x, y: x + y) > 0.6)",
]

# The same over the exact terms: no bucket table, so nothing of the engine's hash is copied.
EXACT_CTES = [
    CONTENT_CTES[0],
    "tf AS (SELECT mid, token AS term, CAST(count(*) AS DOUBLE) AS tf FROM tok GROUP BY mid, token)",
    *CONTENT_CTES[3:],
]

# Real-time scoring over the whole event table as one batch (needs CONTENT_CTES).
REALTIME_CTES = [
    "last_ev AS (SELECT uid, mid, score, \"timestamp\" FROM (SELECT *, row_number() OVER "
    "(PARTITION BY uid ORDER BY \"timestamp\" DESC, mid DESC, score DESC) AS rn FROM rating_event) WHERE rn = 1)",
    "unseen AS (SELECT l.uid, s.other_mid AS mid, s.score AS sim FROM last_ev l JOIN sims s ON s.mid = l.mid "
    "WHERE NOT EXISTS (SELECT 1 FROM rating r WHERE r.uid = l.uid AND r.mid = s.other_mid))",
    "topsim AS MATERIALIZED (SELECT * FROM (SELECT uid, mid, sim, row_number() OVER (PARTITION BY uid ORDER BY sim DESC, mid ASC) "
    "AS rank FROM unseen) WHERE rank <= 20)",
    "hist AS MATERIALIZED (SELECT uid, mid, score, \"timestamp\" FROM rating WHERE uid IN (SELECT uid FROM rating_event) "
    "UNION ALL SELECT uid, mid, score, \"timestamp\" FROM rating_event)",
    "recents AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY \"timestamp\" DESC, "
    "mid ASC, score DESC) AS rn FROM hist) WHERE rn <= 20)",
    # similarities of the candidates' movies only, before they are looked up
    "cpairs AS MATERIALIZED (SELECT t.uid, t.mid, r.mid AS recent_mid, r.score AS recent_score, coalesce(s.score, 0.0) AS sim "
    "FROM topsim t JOIN recents r ON t.uid = r.uid LEFT JOIN (SELECT * FROM sims WHERE mid IN (SELECT mid FROM topsim)) s "
    "ON s.mid = t.mid AND s.other_mid = r.mid)",
    "boost AS (SELECT uid, mid, list_reduce(list(sim * recent_score ORDER BY sim * recent_score), "
    "lambda x, y: x + y) / count(*) AS base, "
    "count(*) FILTER (WHERE recent_score > 3) AS incr, count(*) FILTER (WHERE recent_score <= 3) AS decr "
    "FROM cpairs WHERE sim > 0.7 GROUP BY uid, mid)",
    "scores AS (SELECT uid, mid, base + CASE WHEN x > 0 THEN log10(x) WHEN x = 0 THEN CAST('-inf' AS DOUBLE) "
    "ELSE CAST('nan' AS DOUBLE) END AS score FROM (SELECT *, "
    "CAST(CASE WHEN incr = 0 THEN 1 ELSE incr END AS DOUBLE) - "
    "log10(CAST(CASE WHEN decr = 0 THEN 1 ELSE decr END AS DOUBLE)) AS x FROM boost))",
    "listed AS (SELECT uid, CAST(row_number() OVER (PARTITION BY uid ORDER BY isnan(score), "
    "CASE WHEN isnan(score) THEN 0 ELSE -score END, mid) AS INT) AS rank, mid, score FROM scores)",
    # a user without any scored candidate has an empty list: one row, no rank
    "ranked AS (SELECT uid, rank, mid, score FROM (SELECT DISTINCT uid FROM rating_event) LEFT JOIN listed USING (uid))",
]

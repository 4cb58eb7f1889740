"""Oracle SQL (DuckDB) for every registered query.

The oracle answers from the base tables without any JSON: a film is an
order, its genre entries are the distinct (order, part type) pairs, its
keyword entries the distinct (order, part, part name) triples, its company
entries the distinct (order, supplier) pairs and its language entries the
distinct (order, supplier nation) pairs. The Spark side builds JSON text and
parses it back, so the two paths share no code.
"""

from __future__ import annotations

_BASE = """
WITH f AS (
  SELECT o.o_orderkey AS id,
         'Order#' || CAST(o.o_orderkey AS VARCHAR) AS title,
         CAST(floor(o.o_totalprice / 10000) * 10000 AS BIGINT) AS budget,
         strftime(o.o_orderdate, '%Y-%m-%d') AS release_date,
         CAST(o.o_orderdate AS DATE) AS release_day,
         coalesce(max(l.l_tax), 0.0) AS popularity,
         coalesce(round(max(l.l_discount) * 100, 1), 0.0) AS vote_average,
         coalesce(CAST(sum(l.l_quantity) AS BIGINT), 0) AS vote_count,
         coalesce(CAST(floor(sum(CAST(l.l_extendedprice AS DECIMAL(12,2)))) AS BIGINT), 0) AS revenue,
         coalesce(CAST(max(l.l_quantity) AS BIGINT), 0) AS runtime
  FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey
  GROUP BY o.o_orderkey, o.o_totalprice, o.o_orderdate
),
o AS (SELECT o_orderkey AS k FROM orders),
g AS (SELECT DISTINCT k, p_type FROM o JOIN lineitem ON l_orderkey = k JOIN part ON p_partkey = l_partkey),
kw AS (SELECT DISTINCT k, l_partkey, p_name FROM o JOIN lineitem ON l_orderkey = k JOIN part ON p_partkey = l_partkey),
co AS (SELECT DISTINCT k, l_suppkey, s_name FROM o JOIN lineitem ON l_orderkey = k JOIN supplier ON s_suppkey = l_suppkey),
la AS (SELECT DISTINCT k, n_nationkey, n_name FROM o JOIN lineitem ON l_orderkey = k
       JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey)
"""

_GENRE_YEARS = """,
ge AS (
  SELECT g.p_type AS genre, CAST(year(f.release_day) AS BIGINT) AS year
  FROM g JOIN f ON f.id = g.k
  WHERE year(f.release_day) BETWEEN 1996 AND 2000
),
gc AS (SELECT genre, year, count(*) AS cnt FROM ge GROUP BY genre, year),
gs AS (
  SELECT genre, year,
         CAST(cnt AS DOUBLE) / CAST(sum(cnt) OVER (PARTITION BY year) AS DOUBLE) AS ratio
  FROM gc
)
"""

_REVENUE_YEARS = """,
ry AS (
  SELECT CAST(year(release_day) AS BIGINT) AS year, revenue FROM f
  WHERE release_day IS NOT NULL AND revenue <> 0
)
"""

_COMPANY = """,
cr AS (
  SELECT co.s_name AS company, f.vote_average
  FROM co JOIN f ON f.id = co.k
  WHERE f.vote_count > 100 AND f.vote_average <> 0
),
crv AS (
  SELECT co.s_name AS company, f.vote_average
  FROM co JOIN f ON f.id = co.k
  WHERE f.vote_count > 100
)
"""

_TOP_LANG = """,
lt AS (
  SELECT n_name AS language, count(*) AS count FROM la WHERE n_name <> ''
  GROUP BY n_name ORDER BY count DESC, language LIMIT 10
)
"""

_TOP_KW100 = """,
kt AS (
  SELECT p_name AS keyword, count(*) AS count FROM kw
  GROUP BY p_name ORDER BY count DESC, keyword LIMIT 100
)
"""

_BUDGET_TOP = """,
bt AS (
  SELECT budget, count(*) AS count FROM f WHERE budget <> 0
  GROUP BY budget ORDER BY count DESC, budget LIMIT 10
)
"""

def _films_text(overview: str) -> str:
    """The 20 source columns as text, lists as JSON."""
    def listed(table: str, entry: str, order: str) -> str:
        return f"SELECT k, '[' || string_agg({entry}, ',' ORDER BY {order}) || ']' AS j FROM {table} GROUP BY k"

    return _BASE + f""",
jg AS ({listed("g", """'{"id":' || length(p_type) || ',"name":' || to_json(p_type) || '}'""", "length(p_type), p_type")}),
jk AS ({listed("kw", """'{"id":' || l_partkey || ',"name":' || to_json(p_name) || '}'""", "l_partkey, p_name")}),
jc AS ({listed("co", """'{"name":' || to_json(s_name) || ',"id":' || l_suppkey || '}'""", "s_name, l_suppkey")}),
jl AS ({listed("la", """'{"iso_639_1":"' || n_nationkey || '","name":' || to_json(n_name) || '}'""", "CAST(n_nationkey AS VARCHAR), n_name")})
SELECT CAST(f.budget AS VARCHAR) AS budget, coalesce(jg.j, '[]') AS genres, CAST(NULL AS VARCHAR) AS homepage,
       CAST(f.id AS VARCHAR) AS id, coalesce(jk.j, '[]') AS keywords, CAST(NULL AS VARCHAR) AS original_language,
       f.title AS original_title, {overview} AS overview, CAST(f.popularity AS VARCHAR) AS popularity,
       coalesce(jc.j, '[]') AS production_companies, '[]' AS production_countries, f.release_date AS release_date,
       CAST(f.revenue AS VARCHAR) AS revenue, CAST(f.runtime AS VARCHAR) AS runtime, coalesce(jl.j, '[]') AS spoken_languages,
       r.o_orderstatus AS status, CAST(NULL AS VARCHAR) AS tagline, f.title AS title,
       CAST(f.vote_average AS VARCHAR) AS vote_average, CAST(f.vote_count AS VARCHAR) AS vote_count
FROM f JOIN orders r ON r.o_orderkey = f.id LEFT JOIN jg ON jg.k = f.id LEFT JOIN jk ON jk.k = f.id
LEFT JOIN jc ON jc.k = f.id LEFT JOIN jl ON jl.k = f.id"""


_EXPORTS = _BASE + _COMPANY + """
SELECT 'genres' AS job, count(DISTINCT p_type) AS elements FROM g
UNION ALL SELECT 'keywords', least(100, count(DISTINCT p_name)) FROM kw
UNION ALL SELECT 'company_count', least(10, count(DISTINCT s_name)) FROM co
UNION ALL SELECT 'budget', least(10, count(DISTINCT budget)) FROM f WHERE budget <> 0
UNION ALL SELECT 'language', least(10, count(DISTINCT n_name)) FROM la WHERE n_name <> ''
UNION ALL SELECT 'runtime', count(*) FROM (SELECT runtime FROM f WHERE runtime <> 0 GROUP BY runtime HAVING count(*) >= 100)
UNION ALL SELECT 'budget_vote', count(*) FROM f WHERE budget <> 0 AND vote_count > 100
UNION ALL SELECT 'date_vote', count(*) FROM f WHERE release_date <> '' AND vote_count > 100
UNION ALL SELECT 'pop_vote', count(*) FROM f WHERE popularity <> 0 AND vote_count > 100
UNION ALL SELECT 'movies_vote', count(DISTINCT company) FROM crv
UNION ALL SELECT 'budget_revenue', count(*) FROM f WHERE budget <> 0 AND revenue <> 0"""

ORACLE: dict[str, str] = {
    "genre_counts": _BASE + "SELECT p_type AS genre, count(*) AS count FROM g GROUP BY p_type",
    "genre_counts_contains": _BASE + "SELECT p_type AS genre, count(DISTINCT k) AS count FROM g GROUP BY p_type",
    "keyword_top": _BASE + """SELECT p_name AS keyword, count(*) AS count FROM kw
        GROUP BY p_name ORDER BY count DESC, keyword LIMIT 20""",
    "keyword_top_xv": _BASE + """SELECT p_name AS x, count(*) AS value FROM kw
        GROUP BY p_name ORDER BY value DESC, x LIMIT 100""",
    "budget_top": _BASE + _BUDGET_TOP + "SELECT budget, count FROM bt",
    "budget_ordered": _BASE + """SELECT budget, count(*) AS count FROM f WHERE budget <> 0
        GROUP BY budget ORDER BY budget LIMIT 10""",
    "runtime_common": _BASE + """SELECT runtime, count(*) AS count FROM f WHERE runtime <> 0
        GROUP BY runtime HAVING count(*) > 101""",
    "runtime_common_inclusive": _BASE + """SELECT runtime, count(*) AS count FROM f WHERE runtime <> 0
        GROUP BY runtime HAVING count(*) >= 101""",
    "company_top": _BASE + """SELECT s_name AS production_company, count(*) AS count FROM co
        GROUP BY s_name ORDER BY count DESC, production_company LIMIT 10""",
    "company_top_named": _BASE + """SELECT s_name AS company, count(*) AS count FROM co
        GROUP BY s_name ORDER BY count DESC, company LIMIT 10""",
    "language_top": _BASE + """SELECT n_name AS language, count(*) AS count FROM la
        GROUP BY n_name ORDER BY count DESC, language LIMIT 10""",
    "language_top_nonblank": _BASE + _TOP_LANG + "SELECT language, count FROM lt",
    "budget_vs_rating": _BASE + """SELECT title, budget, vote_average FROM f
        WHERE title <> '' AND vote_average <> 0 AND budget <> 0""",
    "budget_vs_rating_voted": _BASE + """SELECT title, budget, vote_average FROM f
        WHERE budget <> 0 AND vote_count > 100""",
    "budget_vs_popularity": _BASE + """SELECT title, budget, popularity FROM f
        WHERE title <> '' AND popularity <> 0 AND budget <> 0""",
    "budget_vs_votes": _BASE + """SELECT title, budget, vote_count FROM f
        WHERE title <> '' AND vote_count <> 0 AND budget <> 0""",
    "release_vs_rating": _BASE + """SELECT title, release_date AS release, vote_average FROM f
        WHERE title <> '' AND vote_average <> 0""",
    "release_vs_rating_voted": _BASE + """SELECT release_date, vote_average, title FROM f
        WHERE release_date <> '' AND vote_count > 100""",
    "popularity_vs_rating": _BASE + """SELECT title, popularity, vote_average FROM f
        WHERE title <> '' AND vote_average <> 0""",
    "popularity_vs_rating_voted": _BASE + """SELECT title, popularity, vote_average FROM f
        WHERE popularity <> 0 AND vote_count > 100""",
    "budget_vs_revenue": _BASE + """SELECT title, budget, revenue FROM f
        WHERE title <> '' AND budget <> 0 AND revenue <> 0""",
    "budget_vs_revenue_any_title": _BASE + """SELECT title, budget, revenue FROM f
        WHERE budget <> 0 AND revenue <> 0""",
    "company_rating": _BASE + _COMPANY + """SELECT company,
        CAST(sum(CAST(vote_average AS DECIMAL(18,6))) AS DOUBLE) / count(*) AS average,
        count(*) AS count FROM cr GROUP BY company""",
    "company_rating_voted": _BASE + _COMPANY + """SELECT company,
        CAST(sum(CAST(vote_average AS DECIMAL(18,6))) AS DOUBLE) / count(*) AS average,
        count(*) AS count FROM crv GROUP BY company""",
    "genre_share": _BASE + """SELECT p_type AS genre,
        CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM g) AS DOUBLE) AS ratio
        FROM g GROUP BY p_type""",
    "genre_share_by_year": _BASE + _GENRE_YEARS + "SELECT genre, year, ratio FROM gs",
    "genre_entries_by_year": _BASE + """SELECT CAST(year(f.release_day) AS BIGINT) AS year, count(*) AS count
        FROM g JOIN f ON f.id = g.k WHERE f.release_day IS NOT NULL GROUP BY 1""",
    "revenue_mean_by_year": _BASE + _REVENUE_YEARS + """SELECT year,
        CAST(sum(revenue) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_revenue
        FROM ry GROUP BY year ORDER BY year""",
    "revenue_total_by_year": _BASE + _REVENUE_YEARS + """SELECT year,
        CAST(sum(revenue) AS DECIMAL(38,0)) AS total_revenue FROM ry GROUP BY year ORDER BY year""",
    "genre_year_counts": _BASE + """SELECT g.p_type AS genre, substr(f.release_date, 1, 4) AS release_year,
        count(*) AS count FROM g JOIN f ON f.id = g.k GROUP BY 1, 2 ORDER BY 1, 2""",
    "budget_revenue_millions": _BASE + """SELECT title, budget / 1e6 AS budget_millions,
        revenue / 1e6 AS revenue_millions FROM f
        WHERE title <> '' AND budget <> 0 AND revenue <> 0""",
    "language_top_share": _BASE + """, lt AS (
          SELECT n_name AS language, count(*) AS count FROM la
          GROUP BY n_name ORDER BY count DESC, language LIMIT 10)
        SELECT language, count,
        CAST(count AS DOUBLE) / CAST(sum(count) OVER () AS DOUBLE) AS share FROM lt""",
    "runtime_labels": _BASE + """SELECT runtime, count(*) AS count,
        CAST(runtime AS VARCHAR) || ' min.' AS label FROM f WHERE runtime <> 0
        GROUP BY runtime HAVING count(*) > 101""",
    "keyword_weight": _BASE + _TOP_KW100 + """SELECT keyword, count,
        CASE WHEN max(count) OVER () = min(count) OVER () THEN NULL
             ELSE CAST(count - min(count) OVER () AS DOUBLE)
                  / CAST(max(count) OVER () - min(count) OVER () AS DOUBLE) * 16.0 + 24.0 END AS weight
        FROM kt""",
    "release_date_labels": _BASE + """SELECT title, release_date AS release, vote_average,
        CAST(year(release_day) AS VARCHAR) || '-' || CAST(month(release_day) AS VARCHAR) || '-'
          || CAST(day(release_day) AS VARCHAR) AS label
        FROM f WHERE title <> '' AND vote_average <> 0""",
    "company_rating_rounded": _BASE + _COMPANY + """SELECT company, round(avg(vote_average), 2) AS average,
        count(*) AS count FROM cr GROUP BY company""",
    "genre_year_matrix": _BASE + _GENRE_YEARS + """SELECT genre,
        coalesce(max(CASE WHEN year = 1996 THEN ratio END), 0.0) AS "1996",
        coalesce(max(CASE WHEN year = 1997 THEN ratio END), 0.0) AS "1997",
        coalesce(max(CASE WHEN year = 1998 THEN ratio END), 0.0) AS "1998",
        coalesce(max(CASE WHEN year = 1999 THEN ratio END), 0.0) AS "1999",
        coalesce(max(CASE WHEN year = 2000 THEN ratio END), 0.0) AS "2000"
        FROM gs GROUP BY genre""",
    "language_counts_contains": _BASE + """SELECT n.n_name AS language, count(DISTINCT la.k) AS count
        FROM la JOIN (SELECT DISTINCT n_name FROM la) n ON contains(la.n_name, n.n_name) GROUP BY 1""",
    "budget_ordered_rare": _BASE + """SELECT budget, count(*) AS count FROM f WHERE budget <> 0
        GROUP BY budget ORDER BY count, budget LIMIT 10""",
    "budget_rating_millions": _BASE + """SELECT title, budget / 1e6 AS budget_millions, vote_average FROM f
        WHERE title <> '' AND vote_average <> 0 AND budget <> 0""",
    "budget_popularity_millions": _BASE + """SELECT title, budget / 1e6 AS budget_millions, popularity FROM f
        WHERE title <> '' AND popularity <> 0 AND budget <> 0""",
    "budget_votes_millions": _BASE + """SELECT title, budget / 1e6 AS budget_millions, vote_count FROM f
        WHERE title <> '' AND vote_count <> 0 AND budget <> 0""",
    "budget_top_millions": _BASE + _BUDGET_TOP + "SELECT budget / 1e6 AS budget_millions, count FROM bt",
    "language_top_percent": _BASE + """, lt AS (
          SELECT n_name AS language, count(*) AS count FROM la
          GROUP BY n_name ORDER BY count DESC, language LIMIT 10),
        sh AS (SELECT language, count, CAST(count AS DOUBLE) / CAST(sum(count) OVER () AS DOUBLE) AS share FROM lt)
        SELECT language, count, share, round(share * 100, 2) AS percent FROM sh""",
    "genre_year_matrix_cut": _BASE + _GENRE_YEARS + "SELECT genre, " + ", ".join(
        f"""coalesce(max(CASE WHEN year = {y} THEN floor(ratio * 1000) / 1000.0::DOUBLE END), 0.0) AS "{y}\""""
        for y in range(1996, 2001)) + " FROM gs GROUP BY genre",
    "revenue_mean_arrays": _BASE + _REVENUE_YEARS + """, rt AS (
          SELECT year, CAST(round(CAST(sum(revenue) AS DOUBLE) / CAST(count(*) AS DOUBLE), 2) AS DECIMAL(20,2)) AS avg_revenue
          FROM ry GROUP BY year)
        SELECT to_json(list(year ORDER BY year))::VARCHAR AS keys,
               to_json(list(avg_revenue ORDER BY year))::VARCHAR AS "values" FROM rt""",
    "csv_roundtrip": _BASE + "SELECT p_name AS keyword, count(*) AS count FROM kw GROUP BY p_name",
    "csv_blocks_roundtrip": _films_text("""r.o_orderpriority || chr(10) || 'said "' || r.o_orderstatus || '",' || chr(10) || f.id"""),
    "csv_lines_roundtrip": _films_text("r.o_orderpriority"),
    "json_array_roundtrip": _BASE + "SELECT title, budget, vote_average FROM f WHERE budget <> 0 AND vote_count > 100",
    "export_jobs_roundtrip": _EXPORTS,
    "export_jobs_resumed": f"SELECT job, elements, job IN ('movies_vote', 'budget_revenue') AS second FROM ({_EXPORTS})",
    "keyword_top_heavy": _BASE + """SELECT p_name AS keyword, count(*) AS count FROM kw
        GROUP BY p_name ORDER BY count DESC, keyword LIMIT 20""",
    "company_top_heavy": _BASE + """SELECT s_name AS production_company, count(*) AS count FROM co
        GROUP BY s_name ORDER BY count DESC, production_company LIMIT 10""",
    "language_top_heavy": _BASE + _TOP_LANG + "SELECT language, count FROM lt",
    "clustered_share_by_year": _BASE + _GENRE_YEARS + "SELECT genre, year, ratio FROM gs",
    "genre_cube": _BASE + """SELECT CAST(grouping(g.p_type, year(f.release_day)) AS INTEGER) AS level,
        g.p_type AS genre, CAST(year(f.release_day) AS BIGINT) AS year, count(*) AS count
        FROM g JOIN f ON f.id = g.k
        GROUP BY GROUPING SETS ((g.p_type, year(f.release_day)), (g.p_type), (year(f.release_day)), ())""",
    "genre_results_one_pass": _BASE + _GENRE_YEARS + """SELECT 'counts' AS result, p_type AS genre,
          CAST(NULL AS BIGINT) AS year, CAST(count(*) AS DOUBLE) AS value FROM g GROUP BY p_type
        UNION ALL SELECT 'share', p_type, NULL, CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM g) AS DOUBLE) FROM g GROUP BY p_type
        UNION ALL SELECT 'entries_by_year', NULL, CAST(year(f.release_day) AS BIGINT), CAST(count(*) AS DOUBLE)
          FROM g JOIN f ON f.id = g.k WHERE f.release_day IS NOT NULL GROUP BY 3
        UNION ALL SELECT 'share_by_year', genre, year, ratio FROM gs""",
    "json_sink_roundtrip": _BASE + "SELECT title, budget, vote_average FROM f WHERE budget <> 0 AND vote_count > 100",
    "genre_counts_sql": _BASE + "SELECT p_type AS genre, count(*) AS count FROM g GROUP BY p_type",
    "runtime_common_sql": _BASE + """SELECT runtime, count(*) AS count FROM f WHERE runtime <> 0
        GROUP BY runtime HAVING count(*) > 101""",
    "budget_top_document": _BASE + _BUDGET_TOP + """SELECT
        to_json(list(struct_pack(budget := budget, count := count) ORDER BY count DESC, budget))::VARCHAR
        AS document FROM bt""",
    "budget_top_json_lines": _BASE + _BUDGET_TOP + """SELECT
        to_json(struct_pack(budget := budget, count := count))::VARCHAR AS json FROM bt""",
    "revenue_total_arrays": _BASE + _REVENUE_YEARS + """, rt AS (
          SELECT year, CAST(sum(revenue) AS BIGINT) AS total_revenue FROM ry GROUP BY year)
        SELECT to_json(list(year ORDER BY year))::VARCHAR AS keys,
               to_json(list(total_revenue ORDER BY year))::VARCHAR AS "values" FROM rt""",
    "genre_year_lines": _BASE + """SELECT g.p_type || ',' || coalesce(substr(f.release_date, 1, 4), 'null')
          || ',' || CAST(count(*) AS VARCHAR) || '&' AS line
        FROM g JOIN f ON f.id = g.k GROUP BY g.p_type, substr(f.release_date, 1, 4)""",
}

"""SQL pieces shared by the reference queries."""

from __future__ import annotations

from fieldatlas.derive import HOME_COUNTRY, RECENT_YEAR

WORKS = """
lines AS (
  SELECT l_orderkey, min(p_name) || ' ' || max(p_name) AS title,
         list_sort(list(DISTINCT n_name)) AS countries,
         list_sort(list(DISTINCT p_brand)) AS institutions
  FROM lineitem JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY l_orderkey),
works AS (
  SELECT 'W' || o_orderkey AS id, title, CAST(NULL AS VARCHAR) AS abstract,
    CASE WHEN o_orderkey % 50 <> 0 THEN CAST(floor(o_totalprice / 5000) AS BIGINT) END AS citations,
    countries, institutions, o_custkey AS micro_cluster,
    CAST(c_nationkey AS BIGINT) AS meso_cluster, CAST(n_regionkey AS BIGINT) AS macro_cluster,
    CASE WHEN o_orderkey = 0 THEN 1990 ELSE CAST(year(o_orderdate) AS INTEGER) END AS publication_year
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN lines ON l_orderkey = o_orderkey)"""

FAULTY = WORKS + """,
faulty AS (
  SELECT * REPLACE (
    CASE WHEN micro_cluster % 17 <> 0 THEN meso_cluster END AS meso_cluster,
    CASE WHEN CAST(substring(id, 2) AS BIGINT) % 101 = 0 THEN (macro_cluster + 1) % 5
         ELSE macro_cluster END AS macro_cluster)
  FROM works)"""


FLAT_LISTS = ("coalesce(array_to_string(countries, '|'), '') AS countries, "
              "coalesce(array_to_string(institutions, '|'), '') AS institutions")


def rounded(expression: str, digits: int) -> str:
    scale = f"{10 ** digits}.0"
    return f"floor(CAST({expression} AS DOUBLE) * {scale} + 0.5) / {scale}"


def title_cased(expression: str) -> str:
    return (f"list_aggregate(list_transform(regexp_extract_all({expression}, '[\\p{{L}}]+|[^\\p{{L}}]+'), "
            "lambda x: upper(x[1]) || lower(x[2:])), 'string_agg', '')")


def ranked(level: str) -> str:
    key = f"{level}_cluster"
    return f"""ranked_{level} AS (
  SELECT *, publication_year AS py,
    CASE WHEN count(*) OVER (PARTITION BY publication_year) = 1 THEN 0.5
         ELSE percent_rank() OVER (PARTITION BY publication_year ORDER BY citations ASC NULLS LAST) END AS paper_rank
  FROM works WHERE {key} IS NOT NULL)"""


def report(level: str) -> str:
    """Name and body of the CTEs for one cluster report."""
    key = f"{level}_cluster"
    parents = {"micro": ["meso_cluster", "macro_cluster"], "meso": ["macro_cluster"], "macro": []}[level]
    children = {"micro": [], "meso": ["micro"], "macro": ["meso", "micro"]}[level]
    columns = [key] + [f"CAST(min({p}) AS BIGINT) AS {p}" for p in parents]
    columns += [f"count(DISTINCT {c}_cluster) AS {c}_clusters" for c in children]
    columns += [
        "count(*) AS publications", "min(citations) AS min_citations",
        f"{rounded('avg(citations)', 2)} AS ave_citations",
        "quantile_disc(citations, 0.5) AS median_citations", "max(citations) AS max_citations",
        f"{rounded('avg(paper_rank)', 4)} AS yearly_rank_citations",
        "CAST(min(py) AS BIGINT) AS min_py", f"{rounded('avg(py)', 1)} AS ave_py",
        "CAST(quantile_disc(py, 0.5) AS BIGINT) AS median_py", "CAST(max(py) AS BIGINT) AS max_py",
        f"{rounded(f'count(*) FILTER (WHERE py >= {RECENT_YEAR}) / CAST(count(*) AS DOUBLE)', 4)} AS recency_py",
        f"count(*) FILTER (WHERE list_contains(countries, '{HOME_COUNTRY}')) AS japan_count"]
    return (f"{ranked(level)},\nreport_{level} AS (\n  SELECT " + ",\n    ".join(columns)
            + f"\n  FROM ranked_{level} GROUP BY {key})")


REPORTS = WORKS + ",\n" + ",\n".join(report(level) for level in ("micro", "meso", "macro"))
MICRO = WORKS + ",\n" + report("micro")

# maximum spanning forest of the graph g between nations: an edge belongs unless heavier ones (ties by ends) already join its ends
FOREST = """g AS (
  SELECT least(x.c_nationkey, y.c_nationkey)::BIGINT AS a, greatest(x.c_nationkey, y.c_nationkey)::BIGINT AS b, sum(w) AS w
  FROM (SELECT least(l_orderkey, l_partkey) AS s, greatest(l_orderkey, l_partkey) AS t, count(*) AS w
        FROM lineitem GROUP BY 1, 2)
    JOIN orders p ON s = p.o_orderkey JOIN customer x ON p.o_custkey = x.c_custkey
    JOIN orders r ON t = r.o_orderkey JOIN customer y ON r.o_custkey = y.c_custkey
  GROUP BY 1, 2),
e AS (SELECT *, row_number() OVER (ORDER BY w DESC, a, b) AS rank FROM g WHERE a <> b),
steps AS (
  SELECT 0::BIGINT AS rank, map_from_entries(list((v, v))) AS label, NULL::BIGINT AS a, NULL::BIGINT AS b
  FROM (SELECT DISTINCT unnest([a, b]) AS v FROM g)
  UNION ALL
  SELECT e.rank, CASE WHEN s.label[e.a] = s.label[e.b] THEN s.label ELSE map_from_entries(list_transform(
      map_entries(s.label), lambda x: (x.key, CASE WHEN x.value = s.label[e.b] THEN s.label[e.a] ELSE x.value END))) END,
    CASE WHEN s.label[e.a] <> s.label[e.b] THEN e.a END, CASE WHEN s.label[e.a] <> s.label[e.b] THEN e.b END
  FROM steps s JOIN e ON e.rank = s.rank + 1)"""

"""op2: verdicts on every page's URL, and the same in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfloom.llm.common import table
from shelfloom.llm.url_filter import VARIABLE, TreeSpec, judge

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op2_url_template_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, RULES).select("page_id", "host", "path", "rule", "verdict")


#: SQL has to name its levels: more than the paths of the test tables have.  Levels at which paths no longer
#: differ change nothing.
SQL_LEVELS = 8


def _sql(spec: TreeSpec = TreeSpec()) -> str:
    ordered = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in ordered)
    verdict = " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for v, h, p in ordered)
    levels, last = [], "t0"
    for i in range(1, SQL_LEVELS + 1):
        levels.append(f"""
s{i} AS MATERIALIZED (SELECT host, shape, n, bad, prefix, regexp_extract(rest, '^/?([^/]*)', 1) AS seg,
  regexp_replace(rest, '^/?[^/]*', '') AS rest FROM {last}),
b{i} AS (SELECT host, prefix, seg, sum(n)::DOUBLE AS bn FROM s{i} GROUP BY ALL),
n{i} AS (SELECT host, prefix, count(*) AS k, sum(bn) AS nn FROM b{i} GROUP BY ALL),
p{i} AS (SELECT host, prefix, rest, sum(n)::DOUBLE AS pn FROM s{i} GROUP BY ALL),
o{i} AS (SELECT host, prefix, seg, rest, sum(n)::DOUBLE AS onn FROM s{i} GROUP BY ALL),
a{i} AS (SELECT host, prefix, seg, sum(greatest(0.0, onn / bn - pn / nn)) AS tv, max(bn) AS bn,
  bool_or(k >= {spec.min_branches} AND nn < {spec.mean_support} * k) AS variable
  FROM o{i} JOIN b{i} USING (host, prefix, seg) JOIN p{i} USING (host, prefix, rest) JOIN n{i} USING (host, prefix)
  GROUP BY host, prefix, seg),
m{i} AS (SELECT host, prefix, seg, variable,
  NOT variable AND round(tv, 9) <= round({spec.tolerance} + 1 / sqrt(bn), 9) AS near FROM a{i}),
d{i} AS MATERIALIZED (SELECT host, prefix, seg, CASE WHEN variable THEN '*'
  WHEN near AND count_if(near) OVER (PARTITION BY host, prefix) > 1 THEN '(+)' ELSE seg END AS sego FROM m{i}),
t{i} AS MATERIALIZED (SELECT host, shape, n, bad, prefix || '/' || sego AS prefix, rest
  FROM s{i} JOIN d{i} USING (host, prefix, seg))""")
        last = f"t{i}"
    return f"""
WITH u AS (SELECT page_id, coalesce(contains(url, '://'), false) AS ok,
    substring(url, position('://' IN url) + 3) AS r FROM pages),
h AS (SELECT page_id,
    CASE WHEN ok THEN translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN ok THEN regexp_extract(r, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM u),
j AS MATERIALIZED (SELECT *, CASE {rule} END AS rule, CASE {verdict} END AS ruled,
    regexp_replace(path, '{VARIABLE}', '*', 'g') AS shape FROM h),
t0 AS MATERIALIZED (SELECT host, shape, count(*) AS n, count_if(coalesce(ruled = 'block', false)) AS bad,
    '' AS prefix, shape AS rest FROM j GROUP BY host, shape),{','.join(levels)},
f AS (SELECT host, shape, (sum(bad) OVER w + {spec.prior * spec.prior_weight}) / (sum(n) OVER w + {spec.prior_weight}) AS purity
    FROM {last} WINDOW w AS (PARTITION BY host, prefix || rest))
SELECT page_id, j.host, path, rule, coalesce(ruled, CASE WHEN purity >= {spec.reject_at} THEN 'block' ELSE 'allow' END) AS verdict
FROM j JOIN f ON j.host = f.host AND j.shape = f.shape"""


QUERIES = {"op2_url_template_tree": op2_url_template_tree}
ORACLES = {"op2_url_template_tree": _sql()}

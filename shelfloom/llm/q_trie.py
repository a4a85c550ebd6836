"""op13: the prefixes that conversations share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfloom.llm import prefix_trie
from shelfloom.llm.common import table


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return prefix_trie.prefix_trie(prefix_trie.rebuilt(turns))


#: Prefixes as lists; nodes are joined with the nodes that lists begin with.
SQL = r"""
WITH rule AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)) AS t),
own AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
hashed AS (
  SELECT conv_id, turns, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(CAST(conv_id AS VARCHAR))), '..'), lambda x: CAST(concat('0x', x) AS BIGINT)),
    lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1]), CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) % 4 AS h
  FROM own, rule),
lists AS (
  SELECT a.conv_id, list_concat(coalesce(b.turns[1:a.h], []), a.turns[a.h + 1:]) AS turns FROM hashed a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 20),
marks AS (SELECT conv_id, len(turns) AS n, list_transform(turns, lambda x: md5(concat(length(x.role), ':', x.role, x.text))) AS keys, list_transform(turns, lambda x: len(regexp_extract_all(x.text, '[^\x20\x09-\x0D]+'))) AS words FROM lists),
steps AS (SELECT conv_id, n, keys, words, unnest(range(0, n + 1)) AS depth FROM marks),
members AS (SELECT conv_id, n, depth, md5(CAST(keys[1:depth] AS VARCHAR)) AS node, CASE WHEN depth > 0 THEN md5(CAST(keys[1:depth - 1] AS VARCHAR)) END AS parent, CASE WHEN depth > 0 THEN words[depth] ELSE 0 END AS w FROM steps),
nodes AS (
  SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(w) AS w,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
  FROM members GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
below AS (SELECT DISTINCT a.node AS top, b.node AS node FROM members a JOIN members b ON a.conv_id = b.conv_id AND a.depth <= b.depth),
sums AS (
  SELECT top AS node, count(*) FILTER (WHERE k.node IS NULL) AS n_leaves, sum((x.n_convs - 1) * x.w) AS saved_tokens
  FROM below JOIN nodes x ON x.node = below.node LEFT JOIN kids k ON k.node = below.node GROUP BY top)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, s.n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.node = n.parent LEFT JOIN kids k ON k.node = n.node JOIN sums s ON s.node = n.node
"""

QUERIES = {"op13_prefix_trie": op13_prefix_trie}
ORACLES: dict[str, str] = {"op13_prefix_trie": SQL}

"""op11: words of all documents that differ in one letter, grouped around their commonest form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfloom.llm import variants
from shelfloom.llm.common import table


def op11_permuterm_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return variants.group_variants(variants.word_counts(docs)).select("word", "n", "n_near", "form", "form_n", "root")


#: Every word is joined with those that lack one letter; crc32 by its table, which a rule makes.
SQL = r"""
WITH RECURSIVE rule AS (
  SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)) AS t),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run FROM documents),
distinct_runs AS (SELECT doc_id, run, count(*) AS k FROM runs WHERE length(run) >= 6 GROUP BY ALL),
bytes AS (
  SELECT doc_id, run, k, list_transform(regexp_extract_all(hex(encode(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', run))), '..'), lambda x: CAST(concat('0x', x) AS BIGINT)) AS b
  FROM distinct_runs),
hashed AS (
  SELECT doc_id, run, k, xor(list_reduce(b, lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1]), CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) AS h
  FROM bytes, rule),
dropped AS (
  SELECT k, CASE WHEN h % 199 = 0 THEN concat(substring(run, 1, CAST(h % length(run) AS INT)), substring(run, CAST(h % length(run) AS INT) + 2)) ELSE run END AS word FROM hashed),
words AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM dropped WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
less AS (
  SELECT word, n, i, concat(substring(word, 1, i - 1), substring(word, i + 1)) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word != b.word
  UNION SELECT a.word, b.word, b.n FROM less a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM less a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS form, max(near_n) AS form_n FROM pairs GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * w.n THEN form END AS form, CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
way AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL SELECT way.word, way.next, f.form FROM way JOIN forms f ON f.word = way.next)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, way.root FROM forms f JOIN way ON way.word = f.word AND way.next IS NULL
"""

QUERIES = {"op11_permuterm_variants": op11_permuterm_variants}
ORACLES: dict[str, str] = {"op11_permuterm_variants": SQL}

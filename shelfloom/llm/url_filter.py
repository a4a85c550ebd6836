"""URL verdicts from rules and a path-template tree, in DataFrame functions only.

Explicit rules (host suffix and path prefix, the longest wins) judge first.  For every other URL a
tree of path templates decides.  For each host:

1. digits and long hexadecimal runs in the path become ``*``; equal generalised paths are counted;
2. level by level, until no two paths that a node holds differ any more, a node whose branches are many and thinly used is variable: they become ``*``;
3. of the other branches of a node, those whose distribution of remaining paths does not differ
   from the node's pooled one by more than sampling noise are merged into ``(+)``;
4. a template is rejected if its smoothed labelled purity, the share of its URLs labelled bad with a
   prior of ``prior_weight`` URLs at ``prior``, reaches ``reject_at``.

URLs are counted before anything is shuffled, so a host with a third of all pages arrives as its
few generalised paths; the way back is a join on (host, path) against that small table, which
adaptive execution broadcasts only when its measured size allows, and splits when skewed.

Cases: a null URL or one without ``://`` has empty host and path, which form a template of their
own; a URL without a path fits no rule; repeated rows are judged alike; an empty table gives an
empty table; other columns pass through unless named like an output.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfloom.llm.common import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
VARIABLE = "[0-9A-Fa-f]{8,}|[0-9]+"


@dataclass(frozen=True)
class TreeSpec:
    """A node is variable if it has ``min_branches`` branches with fewer than ``mean_support`` URLs on average.
    Branches merge within a total variation of ``tolerance`` plus one over the root of their count."""

    min_branches: int = 10
    mean_support: int = 4
    tolerance: float = 0.2
    prior: float = 0.1
    prior_weight: int = 10
    reject_at: float = 0.5


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL."""
    at = F.instr(url, "://")
    rest = F.expr("substring({0}, {1})".format("__url", "instr(__url, '://') + 3"))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    found = F.coalesce(at > 0, F.lit(False))
    return F.when(found, host).otherwise(F.lit("")), F.when(found, path).otherwise(F.lit(""))


def matching_rule(rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, null where none fits.  rules: (verdict, host, path)."""
    rule = verdict = None
    for v, host, path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1], r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule = F.when(fits, host + path) if rule is None else rule.when(fits, host + path)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    if rule is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return rule, verdict


def _head(rest: Column) -> Column:
    return F.regexp_extract(rest, "^/?([^/]*)", 1)


def _tail(rest: Column) -> Column:
    return F.regexp_replace(rest, "^/?[^/]*", "")


def template_tree(counts: DataFrame, spec: TreeSpec = TreeSpec()) -> DataFrame:
    """counts: (host, shape, n, bad), one row per host and generalised path.

    Returns (host, shape, template, purity, reject).  The tree is as deep as paths differ; segments that a
    node's paths share are passed at once, so there are as many rounds as branchings on a path.
    """
    rows = counts.select("host", "shape", "n", "bad", F.lit("").alias("prefix"), F.col("shape").alias("rest"))
    done = []
    while True:
        # What the first and the last of a node's paths have in common, all have.  A node whose paths do not differ
        # never branches: what remains of them is literal.
        ended = F.concat("rest", F.lit("/"))
        ends = rows.groupBy("host", "prefix").agg(F.min(ended).alias("lo"), F.max(ended).alias("hi"))
        inner = lambda c: F.slice(F.split(c, "/"), F.lit(1), F.size(F.split(c, "/")) - 1)
        same = F.array_position(F.zip_with(inner("lo"), inner("hi"), lambda x, y: x.eqNullSafe(y)), False).cast("int") - 1
        ends = ends.select("host", "prefix", (F.col("lo") != F.col("hi")).alias("open"), F.when(F.col("lo") != F.col("hi"), same).otherwise(0).alias("same"))
        at = F.split("rest", "/")
        moved = F.when(F.col("same") > 0, F.concat("prefix", F.array_join(F.slice(at, F.lit(1), F.col("same")), "/"))).otherwise(F.col("prefix"))
        left = F.array_join(F.slice(at, F.col("same") + 1, F.size(at)), "/")
        left = F.when(F.col("same") == 0, F.col("rest")).when(F.size(at) > F.col("same"), F.concat(F.lit("/"), left)).otherwise("")
        split = rows.join(ends, ["host", "prefix"]).select("host", "shape", "n", "bad", moved.alias("prefix"), left.alias("rest"), "open")
        split = materialize(split, "url-split")
        done.append(split.where("not open").select("host", "shape", "n", "bad", F.concat("prefix", "rest").alias("template")))
        rows = split.where("open").drop("open")
        if rows.isEmpty():
            break
        rows = materialize(rows.withColumn("seg", _head(F.col("rest"))).withColumn("rest", _tail(F.col("rest"))), "url-level")
        branch = rows.groupBy("host", "prefix", "seg").agg(F.sum("n").cast("double").alias("bn"))
        node = branch.groupBy("host", "prefix").agg(F.count("*").alias("k"), F.sum("bn").alias("nn"))
        variable = (F.col("k") >= spec.min_branches) & (F.col("nn") < spec.mean_support * F.col("k"))
        # Total variation to the pooled distribution: the positive parts over the rows that exist.
        pooled = rows.groupBy("host", "prefix", "rest").agg(F.sum("n").cast("double").alias("pn"))
        own = rows.groupBy("host", "prefix", "seg", "rest").agg(F.sum("n").cast("double").alias("on"))
        apart = (
            own.join(branch, ["host", "prefix", "seg"])
            .join(pooled, ["host", "prefix", "rest"])
            .join(node, ["host", "prefix"])
            .groupBy("host", "prefix", "seg")
            .agg(
                F.sum(F.greatest(F.lit(0.0), F.col("on") / F.col("bn") - F.col("pn") / F.col("nn"))).alias("tv"),
                F.max("bn").alias("bn"),
                F.max(variable).alias("variable"),
            )
        )
        near = ~F.col("variable") & (F.round("tv", 9) <= F.round(F.lit(spec.tolerance) + 1 / F.sqrt("bn"), 9))
        marked = materialize(apart.select("host", "prefix", "seg", "variable", near.alias("near")), "url-branch")
        alike = marked.groupBy("host", "prefix").agg(F.count_if("near").alias("alike"))
        decided = marked.join(alike, ["host", "prefix"]).select(
            "host",
            "prefix",
            "seg",
            F.when(F.col("variable"), "*").when(F.col("near") & (F.col("alike") > 1), "(+)").otherwise(F.col("seg")).alias("as"),
        )
        rows = rows.join(materialize(decided, "url-decided"), ["host", "prefix", "seg"]).select(
            "host", "shape", "n", "bad", F.concat("prefix", F.lit("/"), "as").alias("prefix"), "rest"
        )
    rows = materialize(reduce(DataFrame.unionByName, done), "url-tree")
    purity = (F.sum("bad") + spec.prior * spec.prior_weight) / (F.sum("n") + spec.prior_weight)
    judged = rows.groupBy("host", "template").agg(purity.alias("purity"))
    return rows.join(judged, ["host", "template"]).select(
        "host", "shape", "template", "purity", (F.col("purity") >= spec.reject_at).alias("reject")
    )


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], spec: TreeSpec = TreeSpec(), url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, verdict, template and purity.

    URLs that a rule blocks are the labelled bad ones; what a rule allows, and what none fits, is not bad.
    """
    out = ["host", "path", "rule", "verdict", "template", "purity"]
    kept = [c for c in pages.columns if c not in out]
    base = pages.select(*[F.col(c) for c in kept], F.col(url).alias("__url"))
    host, path = parts(F.col("__url"))
    base = base.select(*kept, host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(rules)
    base = base.withColumns({"rule": rule, "__ruled": verdict, "shape": F.regexp_replace("path", VARIABLE, "*")})
    counts = base.groupBy("host", "shape").agg(
        F.count("*").alias("n"), F.count_if(F.coalesce(F.col("__ruled") == "block", F.lit(False))).alias("bad")
    )
    tree = materialize(template_tree(materialize(counts, "url-counts"), spec), "url-verdicts")
    found = base.join(tree.withColumnsRenamed({"host": "__host", "shape": "__shape"}), (F.col("host") == F.col("__host")) & (F.col("shape") == F.col("__shape")), "left")
    method = F.when(F.col("reject"), "block").otherwise("allow")
    return found.select(*kept, "host", "path", "rule", F.coalesce("__ruled", method).alias("verdict"), "template", "purity")

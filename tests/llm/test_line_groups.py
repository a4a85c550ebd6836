"""op7: the lines of a bucket are linked inside a task; only links, and packed bands, are rows."""

import itertools
import random

import numpy as np

from shelfloom.llm import line_dedup
from shelfloom.llm.line_dedup import LineSpec


def edited(rnd: random.Random, n: int, at_most: int) -> list[str]:
    base = [rnd.choice("abcdefghij ") for _ in range(300)]
    out = []
    for _ in range(n):
        x = list(base)
        for _ in range(rnd.randrange(at_most)):
            x[rnd.randrange(len(x))] = rnd.choice("klmnop")
        out.append("".join(x))
    return list(dict.fromkeys(out))


def brute(lines: list[str], groups: list[list[int]]) -> set[frozenset[int]]:
    sets, low = [line_dedup.shingle_set(x) for x in lines], list(range(len(lines)))
    for g in groups:
        for a, b in itertools.combinations(g, 2):
            if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low = [low[a] if v == low[b] else v for v in low]
    return {frozenset(i for i, v in enumerate(low) if v == c) for c in set(low)}


def test_groups_are_joined_as_all_pairs_inside_them_join_them_by_a_forest():
    rnd = random.Random(5)
    lines = edited(rnd, 150, 14) + edited(rnd, 60, 9) + ["short", "shorter"] + ["x" * 3000 + str(i) * 40 for i in range(3)]
    groups = [list(range(len(lines)))] + [rnd.sample(range(len(lines)), k) for k in (2, 2, 3, 7, 40)]
    for some in (groups, groups[1:]):
        flat = [i for g in some for i in g]
        a, b = line_dedup.link_groups(np.cumsum([len(g) for g in some]), np.array(flat), [lines[i] for i in flat], 80)
        assert brute(lines, some) == {frozenset(x) for x in joined(len(lines), zip(a.tolist(), b.tolist(), strict=True))}
        assert len(a) == len(lines) - len(brute(lines, some))  # no link more than joins two groups


def joined(n: int, links) -> list[set[int]]:
    of = [{i} for i in range(n)]
    for a, b in links:
        if of[a] is not of[b]:
            of[a] |= of[b]
            for i in of[b]:
                of[i] = of[a]
    return list({id(x): x for x in of}.values())


def test_bands_are_packed_and_large_buckets_cut_into_blocks(spark, monkeypatch):
    lines = edited(random.Random(6), 90, 4)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(3)
    want = {r.doc_id for r in line_dedup.kept_lines(docs).collect()}
    found = line_dedup.sketch(docs, LineSpec()).cache()
    # Not a row for each band of each line.
    assert found.where("part is not null").count() < 10 * len(lines) and found.where("key is not null").count() == len(lines)
    monkeypatch.setattr(line_dedup, "BLOCK_LINES", 8)
    blocks = line_dedup._buckets(found).collect()
    assert max(r.blocks for r in blocks) > 1 and all(2 <= len(r.ids) <= 8 or r.blocks > 1 for r in blocks)
    assert {r.doc_id for r in line_dedup.kept_lines(docs).collect()} == want

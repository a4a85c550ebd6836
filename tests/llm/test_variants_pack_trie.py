"""Spelling variants, best-fit packing and the conversation trie against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfloom.llm import packing, prefix_trie, variants
from shelfloom.llm.common import materialize
from shelfloom.llm.q_pack import VOCABULARY
from shelfloom.llm.q_pack import op12_best_fit_packing as op12

SF = "/root/testdata/sf0.001"


def one_apart(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[i:] == b[i + 1 :] or (len(a) == len(b) and a[i + 1 :] == b[i + 1 :])


def brute_variants(counts: dict[str, int], ratio: int = 5) -> dict:
    near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= ratio * counts[w] else None
    out = {}
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (counts[w], len(near[w]), form[w], counts[form[w]] if form[w] else None, root)
    return out


def some_words(rng: random.Random, n: int) -> dict[str, int]:
    """Words about a few centres, with repeated letters, ties and chains of forms."""
    centres = ["aaaaaa", "aaabbb", "schäden", "passage", "ééééééé", "z" * 70, "ab" * 32, "y" * 63]
    out = {}
    while len(out) < n:
        w = list(rng.choice(centres))
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(w))
            w[i : i + rng.choice([0, 1])] = rng.choice([[], ["a"], ["b"], ["é"], [rng.choice("abyzÿ")]])
            w = w or ["a"]
        if len(w) >= 6:
            out["".join(w)] = rng.choice([5, 5, 6, 30, 151, 800, 5000])
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_variants_equal_brute_force(spark, seed):
    counts = some_words(random.Random(seed), 400)
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(seed + 2)
    got = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in variants.group_variants(words).collect()}
    assert got == brute_variants(counts)
    assert any(v[4] not in (k, v[2]) for k, v in got.items()), "no chain of forms was met"
    pairs = sorted((r["word"], r["near"]) for r in variants.neighbours(words).collect())
    assert pairs == sorted((a, b) for a in counts for b in counts if one_apart(a, b))


def test_word_counts_equal_brute_force(spark):
    rng = random.Random(5)
    run = ["Straße", "ÉCOLE", "école", "çavaça", "Abcdef", "abcdef", "x", "abcde", "naïve" * 3, "a×b÷cd", "A" * 3000]
    rows = [(i, rng.choice([" ", "\n", "1", "中", "💡", "-"]).join(rng.choices(run, k=rng.randint(0, 60)))) for i in range(300)]
    rows += [(None, "abcdef abcdef"), (7, None), (8, ""), (9, "Abcdef"), (9, "Abcdef")]
    want: Counter = Counter()
    import re

    for i, text in rows:
        for r in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            r = "".join(c.lower() if c.isascii() else c for c in r)
            h = zlib.crc32(f"{'' if i is None else i}:{r}".encode())
            if h % 7 == 0:
                r = r[: h % len(r)] + r[h % len(r) + 1 :]
            if len(r) >= 6:
                want[r] += 1
    docs = spark.createDataFrame([(i, t, "w", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    got = {r["word"]: r["n"] for r in variants.word_counts(docs, every=7).collect()}
    assert got == {w: n for w, n in want.items() if n >= 5}


def test_variants_of_odd_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert variants.group_variants(variants.word_counts(none)).collect() == []
    run = "q" * 200_000  # rotations of it would hold 40 GB
    docs = spark.createDataFrame([(1, f"{run} {run} {run} {run} {run} {run}x {run}x {run}x {run}x {run}x")], "doc_id long, text string")
    got = {len(r["word"]): (r["n"], r["n_near"]) for r in variants.group_variants(variants.word_counts(docs, every=10**12)).collect()}
    assert got == {200_000: (5, 1), 200_001: (5, 1)}


def brute_best_fit(sizes: list[int], capacity: int) -> int:
    bins: list[int] = []
    for s in sorted(sizes, reverse=True):
        fits = [i for i, left in enumerate(bins) if left >= s]
        if fits:
            bins[min(fits, key=lambda i: bins[i])] -= s
        else:
            bins.append(capacity - s)
    return sorted(bins)


@pytest.mark.parametrize("seed", range(6))
def test_runs_of_bins_equal_one_item_at_a_time(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 64, 100])
    sizes = [rng.choice([rng.randint(1, capacity), capacity // 3 + 1, 1]) for _ in range(rng.choice([0, 1, 400]))]
    plan = packing.best_fit(Counter(sizes).items(), capacity)
    left: dict[int, int] = defaultdict(lambda: capacity)
    ranks: dict[int, list[int]] = defaultdict(list)
    for size, lo, hi, each, at, offset in plan:
        for k in range(lo, hi):
            ranks[size].append(k)
            b, place = at + (k - lo) // each, offset + (k - lo) % each * size
            assert place == capacity - left[b]
            left[b] -= size
    assert {s: sorted(k) for s, k in ranks.items()} == {s: list(range(n)) for s, n in Counter(sizes).items()}
    assert sorted(left.values()) == brute_best_fit(sizes, capacity)
    assert len({(p[4], p[0]) for p in plan}) <= 3 * capacity * capacity


def check_packed(rows, texts, capacity):
    """rows: (doc, piece, start, length, crc, sequence, offset) of documents with distinct ids."""
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r[0]].append(r)
        by_seq[r[5]].append((r[6], r[3]))
    assert set(by_doc) == set(texts)
    lengths = []
    for doc, text in texts.items():
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want, first = [], len(ids) % capacity or min(capacity, len(ids))
        edges = [0, *range(first, len(ids) + 1, capacity)]
        for k, (i, j) in enumerate(zip(edges, edges[1:], strict=False)):
            want.append((doc, k, i, j - i, zlib.crc32(ids[i:j].tobytes())))
            lengths.append(j - i)
        assert sorted(r[:5] for r in by_doc[doc]) == want
    for parts in by_seq.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end
            end += n
        assert end <= capacity
    assert sorted(capacity - sum(n for _, n in p) for p in by_seq.values()) == brute_best_fit(lengths, capacity)


def test_packing_equals_the_library_and_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    check_packed([tuple(r) for r in op12(spark, SF).collect()], texts, 1024)


def test_packing_of_odd_texts(spark):
    rng = random.Random(3)
    alphabet = ["a", "B", " ", "  ", "\n", "\t", "'s", "é", "é", "中文", "💡", " ", " ", "1234", "<|endoftext|>", "<|endo", "!!", "\x00", "‍", "ß"]
    texts = {i: "".join(rng.choices(alphabet, k=rng.randint(0, 80))) for i in range(200)}
    texts |= {300: None, 301: "", 302: "x" * 50_000, 303: " " * 20_000, 304: "word " * 20_000, 305: "<|endoftext|>" * 40}
    docs = spark.createDataFrame([(i, t, 0, "k") for i, t in texts.items()], "doc_id long, text string, length int, sequence_id string").repartition(5)
    got = packing.pack_documents(docs, VOCABULARY, 64)
    cols = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    check_packed([tuple(r) for r in got.select(cols).collect()], texts, 64)
    same = spark.createDataFrame([(None, "abc")] * 50 + [(1, "abc")] * 50, "doc_id long, text string").repartition(7)
    rows = packing.pack_documents(same, VOCABULARY, 64).collect()
    assert len(rows) == 100 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 100
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(none, VOCABULARY).collect() == []


def test_sequences_hold_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    packed = materialize(packing.pack_documents(docs, VOCABULARY, 128, ids=True), "t")
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r["doc_id"]: [*t.encode(r["text"], add_special_tokens=False).ids, 2] for r in docs.collect()}
    parts = defaultdict(list)
    ids = {r["sequence_id"]: r["ids"] for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        parts[r["doc_id"]].append((r["start"], ids[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]))
    assert {d: [x for _, p in sorted(ps) for x in p] for d, ps in parts.items()} == want


def brute_trie(rows):
    """rows: (conv_id, turn, role, text) with distinct turns.  Nodes as the query gives them."""
    own = defaultdict(list)
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0], r[1] is not None, r[1])):
        if c is not None:
            own[c].append((role or "", text or ""))
    lists = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        lists[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, x in lists.items():
        for d in range(len(x) + 1):
            members[x[:d]].append(c)
    import re

    own_saved = {p: (len(m) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0) for p, m in members.items()}
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p in members:
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += own_saved[p]
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if lists[c] == p)
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def some_turns(rng: random.Random, n: int):
    said = ["hello", "hello  there\x0bnow", "", None, "a b c", "中 文", "one word"]
    rows = []
    for c in range(n):
        if c % 17 == 3:
            continue
        k = rng.choice([1, 1, 2, 3, 5, 40])
        first = "prompt of a third of all" if c % 3 else rng.choice(said)
        rows += [(c, None if t == 0 and c % 5 == 0 else t, rng.choice(["user", None]) if t > 3 else "user", first if t < 2 else rng.choice(said)) for t in range(k)]
    return rows


@pytest.mark.parametrize("limit", [1, 30, 300, 10**6])
def test_trie_equals_brute_force_at_any_shard_size(spark, limit, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PART_IDS", 3)
    rows = some_turns(random.Random(limit), 150)
    turns = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, path string").repartition(6)
    got = [tuple(r) for r in prefix_trie.prefix_trie(prefix_trie.rebuilt(turns), limit).collect()]
    assert sorted(got, key=str) == brute_trie(rows)


def test_trie_of_odd_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.prefix_trie(prefix_trie.rebuilt(spark.createDataFrame([], schema))).collect() == []
    rows = [(None, 1, "user", "lost"), (41, 1, "user", "x y"), (41, 1, "user", "x y"), (41, 2, None, None), (7, None, None, None)]
    rows += [(60, t, "user", f"turn {t} " + "w " * 3) for t in range(400)]
    rows += [(c, t, "user", f"shared {t}" if t < 100 else str(c)) for c in (80, 100, 120) for t in range(102)]
    got = sorted((tuple(r) for r in prefix_trie.prefix_trie(prefix_trie.rebuilt(spark.createDataFrame(rows, schema)), 100).collect()), key=str)
    assert got == brute_trie(rows)


def test_double_array_holds_every_prefix():
    rng = random.Random(9)
    seqs = {tuple(rng.choices(range(1, 60), k=rng.randint(0, 6))) for _ in range(800)} | {(i,) for i in range(1, 300)}
    trie = prefix_trie.packed([np.array(s, np.int64) for s in seqs])
    states = {(): 0}
    for s in sorted(seqs, key=len):
        for d in range(len(s)):
            at = trie.base[states[s[:d]]] + s[d]
            assert trie.check[at] == states[s[:d]]
            states[s[: d + 1]] = at
    assert len(set(states.values())) == len(states) == 1 + sum(c >= 0 for c in trie.check)


@pytest.mark.parametrize("name", ["op11_permuterm_variants", "op13_prefix_trie"])
def test_queries_equal_their_sql(spark, name):
    import importlib

    module = importlib.import_module("shelfloom.llm." + {"op11_permuterm_variants": "q_variants", "op13_prefix_trie": "q_trie"}[name])
    got = module.QUERIES[name](spark, SF)
    c = duckdb.connect()
    for t in ("documents", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    rows = c.sql(f"SELECT {', '.join(got.columns)} FROM ({module.ORACLES[name]})").fetchall()
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(rows, key=str) and rows

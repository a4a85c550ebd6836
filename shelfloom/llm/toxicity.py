"""Toxicity by weak supervision.

1. *Terms* of a text are its distinct words and their beginnings of four to six letters, hashed.  On a
   bounded sample of labelled rows (``TRAIN_ROWS``, chosen by hash) the terms that tell the labels
   apart are selected.
2. *Voters*: the strongest toxic terms, by purity, form ``LEXICONS`` small lexicons, each a voter that
   fires if one of its terms occurs; ``PATTERNS`` fire on the form of the text.
3. *Label model*: every document's votes are counted by vote pattern, over all rows.  Expectation
   maximisation estimates how often each voter fires in either class, with the labelled sample's
   rates as the anchor.  Correlations of voters within the classes then discount those that repeat
   each other.
4. *Classifier*: a logistic regression on the selected terms learns the label model's posterior of
   the sample's rows and of as many rows without a label; given labels are no voters.  It scores every
   document.

All documents are read once for votes and selected terms, which are small; votes and scores come
from those.  The driver sees term counts (``BUCKETS`` at most), per-voter sums and the selected terms
of at most twice ``TRAIN_ROWS`` rows, never texts.

Cases: null or empty text has no term and gets the classifier's base score; labels other than 0 and
1 are ignored; if the sample lacks a class, every score is the (smoothed) share of toxic labels;
several labels of one document all count; repeated rows are scored alike; empty tables are fine;
columns named like the outputs (score, predicted; in ``score`` also votes, terms) are replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfloom.llm.common import materialize

TRAIN_ROWS = 20_000
BUCKETS = 1 << 19
SELECTED = 4096
#: Rows that must hold a term for it to count.
SUPPORT = 5
LEXICONS = 48
LEXICON_TERMS = 480
WORD = re.compile(r"[^\W\d_]+")
STEMS = (4, 5, 6)
WORD_MEMORY = 150_000
EM_ROUNDS = 8
#: Texts that a task holds as Python objects at once.
SLICE = 256
#: Pattern voters: each is the share or count of something in the text, and the level at which it fires.
PATTERNS = (
    ("exclamations", re.compile("!"), 0.002),
    ("capitals in a row", re.compile("[A-Z]{4,}"), 0.002),
    ("masked letters", re.compile(r"[*#$%&@]{3,}"), 0.002),
    ("stretched letters", re.compile(r"(\w)\1{3,}"), 0.001),
    ("second person", re.compile(r"\b[Yy]ou\b"), 0.002),
)


def term_codes(word: str) -> list[int]:
    """Hashed terms of a word: itself, and its beginnings."""
    data = [f"{word}$", *(word[:n] for n in STEMS if len(word) >= n)]
    return [zlib.crc32(d.encode("utf-8", "surrogatepass")) % BUCKETS for d in data]


def words(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


def patterns(text: str | None) -> int:
    """Bits of the pattern voters that fire."""
    out = 0
    if text:
        for i, (_, pattern, level) in enumerate(PATTERNS):
            if sum(1 for _ in pattern.finditer(text)) > level * len(text):
                out |= 1 << i
    return out


def _term_counts(sample: DataFrame) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Rows of the sample with each term, by label, and the numbers of rows.

    Tasks count their own rows, Spark adds the counts; the driver gets one row for each hashed term.
    """
    schema = "term int, y int, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rows = np.zeros((2, BUCKETS), np.int64), [0, 0]
        for text, y in _slices(batches, 0, 1):
            codes = np.array([c for w in words(text) for c in term_codes(w)], np.int64)
            counts[y][np.unique(codes)] += 1
            rows[y] += 1
        for y in (0, 1):
            if rows[y]:
                at = np.flatnonzero(counts[y])
                out = [np.append(at, BUCKETS).astype(np.int32), np.full(len(at) + 1, y, np.int32), np.append(counts[y][at], rows[y])]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["term", "y", "n"])

    counted = sample.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(run, schema)
    side = lambda y: F.sum(F.when(F.col("y") == y, F.col("n")).otherwise(0)).alias(f"n{y}")
    added = counted.groupBy("term").agg(side(0), side(1)).where(f"n0 + n1 >= {SUPPORT} or term = {BUCKETS}").toPandas()
    counts = np.zeros((2, BUCKETS + 1), np.int64)
    counts[:, added["term"].to_numpy(np.int64)] = added[["n0", "n1"]].to_numpy(np.int64).T
    return counts[0][:-1], counts[1][:-1], int(counts[0][-1]), int(counts[1][-1])


def _slices(batches: Iterator[pa.RecordBatch], *columns: int) -> Iterator[tuple]:
    """The rows' values, a few at a time: whole batches of long texts are never held as Python objects."""
    for b in batches:
        for lo in range(0, b.num_rows, SLICE):
            yield from zip(*(b.column(i).slice(lo, SLICE).to_pylist() for i in columns), strict=True)


def select_terms(neg: np.ndarray, pos: np.ndarray, n_neg: int, n_pos: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(selected buckets by strength, lexicons as positions in them).

    A lexicon holds toxic terms of like purity, so that one accuracy suits them all.
    """
    p, q = (pos + 0.5) / (n_pos + 1), (neg + 0.5) / (n_neg + 1)
    both = (pos + neg) / max(n_pos + n_neg, 1)
    z = (p - q) / np.sqrt(np.maximum(both * (1 - both), 1e-12) * (1 / max(n_pos, 1) + 1 / max(n_neg, 1)))
    z[(pos + neg) < SUPPORT] = 0
    order = np.argsort(-np.abs(z), kind="stable")[:SELECTED]
    order = order[np.abs(z[order]) > 3]
    toxic = np.flatnonzero((z[order] > 0) & (p[order] > 4 * q[order]))[:LEXICON_TERMS]
    toxic = toxic[np.argsort(-(p / q)[order[toxic]], kind="stable")]
    return order, [x for x in np.array_split(toxic, LEXICONS) if len(x)]


def observe(docs: DataFrame, buckets: np.ndarray, lexicons: list[np.ndarray]) -> DataFrame:
    """(kept columns, votes long, terms binary): the pass over all texts.

    terms: positions of the selected terms that occur, as 16-bit numbers.
    """
    kept = [f for f in docs.schema.fields if f.name != "text"]
    voter = {int(t): i + len(PATTERNS) for i, x in enumerate(lexicons) for t in x}
    position = {int(b): i for i, b in enumerate(buckets)}
    model = docs.sparkSession.sparkContext.broadcast((position, voter))
    schema = T.StructType([*kept, T.StructField("votes", T.LongType()), T.StructField("terms", T.BinaryType())])
    source = docs.select(*[f.name for f in kept], "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        position, voter = model.value
        memory: dict[str, tuple] = {}

        def selected(word: str) -> tuple:
            if len(memory) >= WORD_MEMORY:
                memory.clear()
            found = tuple(position[c] for c in term_codes(word) if c in position)
            if len(word) <= 64:
                memory[word] = found
            return found

        for b in batches:
            votes, terms = np.zeros(b.num_rows, np.int64), []
            for k, (text,) in enumerate(_slices(iter([b]), len(kept))):
                found: set[int] = set()
                for w in words(text):
                    ids = memory.get(w)
                    if ids is None:
                        ids = selected(w)
                    if ids:
                        found.update(ids)
                bits = patterns(text)
                for t in found:
                    v = voter.get(t)
                    if v is not None:
                        bits |= 1 << v
                votes[k] = bits
                terms.append(np.array(sorted(found), np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(len(kept))], pa.array(votes), pa.array(terms, pa.binary())], names=schema.fieldNames())

    return source.mapInArrow(run, schema)


def _bits(votes: np.ndarray, n: int) -> np.ndarray:
    return ((votes[:, None] >> np.arange(n)) & 1).astype(np.float64)


class LabelModel:
    """How often each voter fires in either class, and how much of its evidence is its own."""

    def __init__(self, n: int, share: float, fires: np.ndarray):
        self.n, self.share, self.fires = n, share, fires
        self.own = np.ones(n)

    def log_odds(self, bits: np.ndarray) -> np.ndarray:
        a, b = self.fires[1], self.fires[0]
        on, off = self.own * np.log(a / b), self.own * np.log((1 - a) / (1 - b))
        return np.log(self.share / (1 - self.share)) + bits @ (on - off) + off.sum()

    def posterior(self, bits: np.ndarray) -> np.ndarray:
        return _sigmoid(self.log_odds(bits))


def _sums(patterns_: DataFrame, n: int, f) -> np.ndarray:
    """Adds f(bits, counts) -> 1-d array over all vote patterns, in the tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                out = f(_bits(b.column(0).to_numpy(), n), b.column(1).to_numpy().astype(np.float64))
                total = out if total is None else total + out
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], names=["i", "v"])

    got = patterns_.select("votes", "n").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(max((r.i for r in got), default=-1) + 1)
    for r in got:
        out[r.i] = r.v
    return out


def fit_label_model(pattern_counts: DataFrame, votes: np.ndarray, y: np.ndarray, n: int) -> LabelModel:
    """pattern_counts: (votes, n) over all rows; votes, y: the labelled sample, which anchors the classes."""
    bits = _bits(votes, n)
    rows = np.array([(y == c).sum() for c in (0, 1)], np.float64)
    labelled = np.stack([bits[y == c].sum(axis=0) for c in (0, 1)])
    model = LabelModel(n, (rows[1] + 1) / (rows.sum() + 2), (labelled + 0.5) / (rows[:, None] + 1))
    for _ in range(EM_ROUNDS):

        def expect(b: np.ndarray, c: np.ndarray, m=model) -> np.ndarray:
            p = m.posterior(b)
            return np.concatenate([[c.sum(), (c * p).sum()], (c * (1 - p)) @ b, (c * p) @ b])

        s = _sums(pattern_counts, n, expect)
        if not len(s):
            break
        weight = s[0] / max(rows.sum(), 1)  # the sample weighs as much as all rows together
        size = np.array([s[0] - s[1], s[1]]) + weight * rows
        fires = (np.stack([s[2 : 2 + n], s[2 + n :]]) + weight * labelled + 0.5) / (size[:, None] + 1)
        model = LabelModel(n, size[1] / size.sum(), np.clip(fires, 1e-6, 1 - 1e-6))

    def second(b: np.ndarray, c: np.ndarray, m=model) -> np.ndarray:
        p = m.posterior(b)
        return np.concatenate([[(c * (1 - p)).sum(), (c * p).sum()], ((b * (c * (1 - p))[:, None]).T @ b).ravel(), ((b * (c * p)[:, None]).T @ b).ravel()])

    s = _sums(pattern_counts, n, second)
    if len(s):
        total = np.zeros((n, n))
        for k in (0, 1):
            size = max(s[k], 1e-9)
            joint = s[2 + k * n * n : 2 + (k + 1) * n * n].reshape(n, n) / size
            rate = np.clip(np.diag(joint), 1e-6, 1 - 1e-6)
            cov = joint - np.outer(rate, rate)
            total += np.abs(cov) / np.sqrt(np.outer(rate * (1 - rate), rate * (1 - rate))) / 2
        np.fill_diagonal(total, 0)
        model.own = 1 / np.sqrt(1 + np.where(total > 0.1, total, 0).sum(axis=1))
    return model


def fit_classifier(terms: list[np.ndarray], target: np.ndarray, size: int, l2: float = 0.2, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on sets of terms with soft labels: accelerated gradient steps."""
    rows = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
    cols = np.concatenate(terms).astype(np.int64) if len(rows) else np.empty(0, np.int64)
    n = len(terms)
    mean = np.clip(target.mean(), 1e-4, 1 - 1e-4)
    w, b = np.zeros(size), np.log(mean / (1 - mean))
    mw, mb = w.copy(), b
    most = max([len(t) for t in terms], default=0)
    usual = np.bincount(cols, minlength=size).astype(float)
    # Each term has its own step: the inverse of its curvature's bound.
    step_w = 1 / (0.25 * np.maximum(usual, 1) * max(np.sqrt(most), 1) + l2)
    step_b = 1 / (0.25 * n + 1e-9)
    for k in range(rounds):
        z = mb + np.bincount(rows, weights=mw[cols], minlength=n)
        error = _sigmoid(z) - target
        gw = np.bincount(cols, weights=error[rows], minlength=size) + l2 * mw
        nw, nb = mw - step_w * gw, mb - step_b * error.sum()
        mw, mb = nw + k / (k + 3) * (nw - w), nb + k / (k + 3) * (nb - b)
        w, b = nw, nb
    return w, float(b)


class Model:
    """What scoring needs: the selected terms' buckets and weights, and the bias."""

    def __init__(self, buckets: np.ndarray, weights: np.ndarray, bias: float):
        self.weight = {int(b): float(w) for b, w in zip(buckets, weights, strict=True)}
        self.bias = bias


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(docs: DataFrame, labelled: DataFrame) -> tuple[Model, DataFrame | None]:
    """(model, observations): docs (doc_id, text and others), labelled (doc_id, toxic).

    The observations have all columns of docs but the text, with votes and terms; none if the sample
    lacks a class.
    """
    labelled = labelled.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1) and doc_id is not null")
    # TRAIN_ROWS rows at most, so this one is safe to broadcast.
    picked = materialize(labelled.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(TRAIN_ROWS), "tox-picked")
    neg, pos, n_neg, n_pos = _term_counts(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id"))
    if not n_neg or not n_pos:
        flat = (n_pos + 1) / (n_neg + n_pos + 3)  # without any label: not toxic
        return Model(np.empty(0), np.empty(0), float(np.log(flat / (1 - flat)))), None
    buckets, lexicons = select_terms(neg, pos, n_neg, n_pos)
    n = len(PATTERNS) + len(lexicons)
    seen = materialize(observe(docs, buckets, lexicons), "tox-seen")
    counts = materialize(seen.groupBy("votes").agg(F.count("*").alias("n")), "tox-patterns")
    rows = seen.select("doc_id", "votes", "terms")
    order = [F.xxhash64("doc_id"), "doc_id", "votes", "terms"]
    anchor = rows.join(F.broadcast(picked), "doc_id").orderBy(*order, "toxic").limit(TRAIN_ROWS).toPandas()
    model = fit_label_model(counts, anchor["votes"].to_numpy(np.int64), anchor["toxic"].to_numpy(np.int64), n)
    # The classifier sees the label model's posterior only, of rows with and without a label alike.
    others = rows.join(F.broadcast(picked.select("doc_id").distinct()), "doc_id", "left_anti").orderBy(*order).limit(TRAIN_ROWS).toPandas()
    votes = np.concatenate([x["votes"].to_numpy(np.int64) for x in (anchor, others)])
    terms = [np.frombuffer(bytes(t), np.uint16) for x in (anchor, others) for t in x["terms"]]
    w, b = fit_classifier(terms, model.posterior(_bits(votes, n)), len(buckets))
    return Model(buckets, w, b), seen


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with score and predicted, from the texts (column ``text``), which alone travel to Python."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        weight, bias = shared.value.weight, shared.value.bias
        memory: dict[str, tuple] = {}
        for batch in texts:
            z = []
            for lo in range(0, len(batch), SLICE):
                for text in batch.slice(lo, SLICE).to_pylist():
                    found: set[int] = set()
                    for w in words(text):
                        codes = memory.get(w)
                        if codes is None:
                            codes = tuple(c for c in term_codes(w) if c in weight)
                            if len(memory) >= WORD_MEMORY:
                                memory.clear()
                            if len(w) <= 64:
                                memory[w] = codes
                        if codes:
                            found.update(codes)
                    z.append(bias + sum(weight[c] for c in sorted(found)))
            yield pa.array(_sigmoid(np.array(z, np.float64)))

    return _judged(docs, scored("text"))


def score(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and others) without the text, with score and predicted.

    The terms seen while the label model counted its votes are used, so texts are read once.
    """
    docs = docs.select(*[c for c in docs.columns if c not in ("score", "predicted", "votes", "terms")])
    model, seen = fit(docs, labelled)
    if seen is None:
        return predict(docs, model).drop("text")
    linear = docs.sparkSession.sparkContext.broadcast((np.array(list(model.weight.values())), model.bias))

    @F.arrow_udf("double")
    def scored(terms: Iterator[pa.Array]) -> Iterator[pa.Array]:
        w, bias = linear.value
        for batch in terms:
            z = [bias + w[np.frombuffer(t, np.uint16)].sum() for t in batch.to_pylist()]
            yield pa.array(_sigmoid(np.array(z, np.float64)))

    return _judged(seen, scored("terms")).drop("votes", "terms")


def _judged(df: DataFrame, made: Column) -> DataFrame:
    scored = df.drop("score", "predicted").withColumn("score", made)
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

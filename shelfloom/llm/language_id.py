"""Language identification by hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1.  An n-gram is the *binding* (element-wise
product) of its letters' vectors, each rotated by its distance from the n-gram's end, so order
matters.  A text is the *bundle* (sum) of the vectors of all its n-grams, a language prototype the
bundle of all its training texts, less the mean direction that all languages share.  A text gets the
language whose prototype has the largest cosine with it.

Every letter, of any script, has a vector of its own, made from a hash of its code point when it is
first met.

Training counts n-grams per language inside each batch before any vector is made, so a prototype
costs one vector per distinct n-gram and batch; what leaves a task is one vector per language.  All
training rows count.  The sums are of integers: the model does not depend on partitioning.

Only prototypes travel, ``BLOCK`` languages at a time; more languages make more passes over the rows in
place.  The driver holds one prototype (8 kB) a language.

Cases: null text, or one without a letter, gives ``und`` with score 0; rows with null language or
text do not train; ties go to the language that sorts first; no training rows at all: every row is
``und``; repeated rows train once for each; whole texts are read; columns named lang_pred and score are
replaced, others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

N, DIMS, SEED = 3, 1024, 20_011
#: Languages of one pass.
BLOCK = 2_000
#: n-gram vectors that a worker keeps, by hash; and texts that a task holds as Python objects.
KEPT = 1 << 16
SLICE = 256


def letter_vector(code_point: int, dims: int = DIMS) -> np.ndarray:
    """The random vector of a letter; code point 0 is the gap between words."""
    bits = b"".join(xxhash.xxh3_64_digest(b"%d %d" % (code_point, i), SEED) for i in range(-(-dims // 64)))
    return (np.unpackbits(np.frombuffer(bits, np.uint8))[:dims].astype(np.int8) * 2 - 1).astype(np.int8)


class Space:
    """The item memory, filled as letters are met, and the n-gram vectors met last."""

    def __init__(self, dims: int = DIMS):
        self.dims = dims
        self.slot = np.full(0x110000, -1, np.int32)
        #: The letters' vectors at each place of an n-gram.
        self.at = [np.empty((0, dims), np.int8) for _ in range(N)]
        self.tag = np.full(KEPT, np.iinfo(np.uint64).max, np.uint64)
        self.known = np.empty((KEPT, dims), np.int8)
        self.letter = np.zeros(0x110000, bool)
        for start in range(0, 0x110000, 0x1000):
            self.letter[start : start + 0x1000] = [chr(c).isalpha() for c in range(start, start + 0x1000)]

    def grams(self, text: str | None) -> np.ndarray:
        """The codes of all n-grams of a text, 21 bits a letter; word gaps count as one letter, outer gaps included."""
        if not text:
            return np.empty(0, np.uint64)
        s = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        s = np.concatenate([[0], np.where(self.letter[s], s, 0), [0]]).astype(np.uint64)
        s = s[np.concatenate([[True], (s[1:] != 0) | (s[:-1] != 0)])]
        if len(s) < N:
            return np.empty(0, np.uint64)
        out = np.zeros(len(s) - N + 1, np.uint64)
        for i in range(N):
            out = (out << np.uint64(21)) | s[i : len(s) - N + 1 + i]
        return out

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        """One row per code (distinct ones)."""
        place = ((codes * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)
        out = self.known[place]
        new = np.flatnonzero(self.tag[place] != codes)
        if len(new):
            out[new] = self._bind(codes[new])
            self.known[place[new]], self.tag[place[new]] = out[new], codes[new]
            # Of several codes for one place the last is kept: its tag and its vector alike.
        return out

    def _bind(self, codes: np.ndarray) -> np.ndarray:
        out = None
        for i in range(N):
            letters = ((codes >> np.uint64(21 * (N - 1 - i))) & np.uint64(0x1FFFFF)).astype(np.int64)
            for c in np.unique(letters[self.slot[letters] < 0]).tolist():
                self.slot[c] = len(self.at[0])
                v = letter_vector(c, self.dims)
                self.at = [np.concatenate([x, np.roll(v, N - 1 - k)[None, :]]) for k, x in enumerate(self.at)]
            part = self.at[i][self.slot[letters]]
            out = part if out is None else out * part
        return out

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The sum of the vectors, in whole numbers (exact in double precision)."""
        out = np.zeros(self.dims)
        for i in range(0, len(codes), 4096):
            out += counts[i : i + 4096].astype(np.float64) @ self.vectors(codes[i : i + 4096]).astype(np.float64)
        return out


_SPACE: dict[int, Space] = {}


def space() -> Space:
    """Made once in each worker."""
    if DIMS not in _SPACE:
        _SPACE[DIMS] = Space()
    return _SPACE[DIMS]


def train(rows: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, prototypes) of the rows whose language and text are not null."""
    rows = rows.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, sums = space(), {}
        for b in batches:
            for lo in range(0, b.num_rows, SLICE):
                by: dict[str, list] = {}
                for t, g in zip(*(b.column(i).slice(lo, SLICE).to_pylist() for i in (0, 1)), strict=True):
                    by.setdefault(g, []).append(s.grams(t))
                for g, parts in by.items():
                    codes, counts = np.unique(np.concatenate(parts), return_counts=True)
                    sums[g] = sums.get(g, 0) + s.bundle(codes, counts)
        for g, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([g] * s.dims, pa.string()), pa.array(np.arange(s.dims, dtype=np.int32)), pa.array(v.astype(np.int64))], names=["lang", "i", "v"])

    summed = rows.mapInArrow(run, "lang string, i int, v long").groupBy("lang", "i").agg(F.sum("v").alias("v"))
    found = summed.toPandas()
    langs = sorted(found["lang"].unique())
    out = np.zeros((len(langs), DIMS))
    if langs:
        out[found["lang"].map({g: k for k, g in enumerate(langs)}).to_numpy(), found["i"].to_numpy()] = found["v"].to_numpy()
    return langs, out


def directions(prototypes: np.ndarray) -> np.ndarray:
    """Unit prototypes without the direction that all languages share (if there are several)."""
    unit = prototypes / np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1e-300)
    if len(unit) > 1:
        unit = unit - unit.mean(axis=0)
    return unit / np.maximum(np.linalg.norm(unit, axis=1, keepdims=True), 1e-300)


def predict(df: DataFrame, langs: list[str], prototypes: np.ndarray, text: str = "text") -> DataFrame:
    """``df`` without the text, with lang_pred and score: (1 + cosine) / 2 of the best prototype."""
    unit = directions(prototypes) if langs else prototypes
    out = df.drop("lang_pred", "score").withColumn("__best", F.lit(None).cast("struct<lang: string, cosine: double>"))
    for lo in range(0, len(langs), BLOCK):
        model = df.sparkSession.sparkContext.broadcast((langs[lo : lo + BLOCK], unit[lo : lo + BLOCK]))
        out = out.withColumn("__best", _better(model)(F.col(text), F.col("__best")))
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (text, "lang_pred", "score")]
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (1 + F.col("__best.cosine")) / 2))
    return out.select(*kept, F.coalesce("__best.lang", F.lit("und")).alias("lang_pred"), F.coalesce(score, F.lit(0.0)).alias("score"))


def _better(model):
    """Arrow function of a text and the best language so far: the best one with these languages."""

    @F.arrow_udf("lang string, cosine double")
    def better(texts: pa.Array, best: pa.Array) -> pa.Array:
        s = space()
        names, unit = model.value
        pred, cosine = [], []
        for lo in range(0, len(texts), SLICE):
            for t, so_far in zip(texts.slice(lo, SLICE).to_pylist(), best.slice(lo, SLICE).to_pylist(), strict=True):
                so_far = so_far or {"lang": None, "cosine": None}
                g = s.grams(t)
                if len(g):
                    codes, counts = np.unique(g, return_counts=True)
                    v = s.bundle(codes, counts)
                    cos = np.round(unit @ v / max(np.linalg.norm(v), 1e-300), 12)
                    k = int(np.argmax(cos))
                    if so_far["lang"] is None or cos[k] > so_far["cosine"]:
                        so_far = {"lang": names[k], "cosine": float(cos[k])}
                pred.append(so_far["lang"])
                cosine.append(so_far["cosine"])
        return pa.StructArray.from_arrays([pa.array(pred, pa.string()), pa.array(cosine, pa.float64())], names=["lang", "cosine"])

    return better

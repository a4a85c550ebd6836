"""BPE encoding and decoding through a tokenization automaton.

The merge list is compiled by *successive merge gadgets*.  The automaton starts as one state with
an arc to itself for every base symbol, which accepts each spelling of a word in base symbols.
The gadget of a merge ``(u, v)`` takes the target state of the ``u`` arcs, splits a copy off that
has no ``v`` arc, and gives every state that had both steps a new arc ``uv`` whose target is the
old target of ``v``.  After the last gadget the automaton accepts, for every word, exactly one
sequence of arc labels: the word's BPE segmentation.

States are kept as a tree: a gadget adds one child (its parent is the state it splits) that
differs from its parent by one missing arc, so 49k merges give 49k small records instead of a
dense table of states times tokens.  Whether a state has an arc is read off the tree and kept in a
transition table that fills as words are met.

Encoding a pre-split word walks the table from left to right: a reached position follows the arcs
that match the next symbols, the longest first.  Each prefix of a word has one segmentation, so a
position is entered at most once, by one arc, and the accepting path is read backwards.  Work is
linear in the word's length.  Decoding emits the arc labels.

Cases: null text encodes as the empty text (no ids); null ids decode to the empty string; an id
outside the vocabulary is an error; very long words are handled in linear time; rows are
independent, so repeated rows and empty tables need nothing special.  Other columns pass through,
whatever their names, as long as they do not equal the output column (which is replaced).
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

END = "</w>"
#: Text chunks, words and (state, token) arcs that a worker remembers (about 150 MB).
CHUNK_MEMORY, WORD_MEMORY, ARC_MEMORY = 300_000, 200_000, 400_000
CONTROLS = re.compile("[\x1c-\x1f]")
SPACE = regex.compile(r"\s+")


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte: printable Latin-1 bytes stand for themselves."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    out, extra = [""] * 256, 0
    for b in range(256):
        if b in set(plain):
            out[b] = chr(b)
        else:
            out[b] = chr(256 + extra)
            extra += 1
    return out


class Automaton:
    """The compiled merge list; ``segment`` gives a symbol sequence's only accepted path."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]]):
        self.label = {i: s for s, i in vocab.items()}
        n = max(vocab.values(), default=-1) + 1
        self.born = {}  # token -> the gadget that made it; base symbols are older than all
        self.left, self.right = {}, {}
        parent, target, self.gadget = [-1], {}, {}
        for rank, (a, b) in enumerate(merges):
            u, v, w = vocab[a], vocab[b], vocab[a + b]
            if w in self.born or self.born.get(u, -1) >= rank or self.born.get(v, -1) >= rank:
                raise ValueError(f"merge {rank} ({a!r}, {b!r}) comes before its parts or repeats a token")
            old_u, old_v = target.get(u, 0), target.get(v, 0)
            parent.append(old_u)  # the copy that has no v arc: state rank + 1
            target[u] = rank + 1
            target[w] = old_v
            self.gadget[u, v] = rank
            self.born[w], self.left[w], self.right[w] = rank, u, v
        self.target = target
        self._number(parent)
        self.arcs: dict[int, bool] = {}
        self.size = n
        self.starts: dict[int, list] = {}
        self.tails: dict[int, list] = {}
        # A gadget that finds no v arc after u adds no arc: its token never occurs.
        dead: set[int] = set()
        for (u, v), rank in self.gadget.items():
            if u in dead or v in dead or not self._arc_from(self.first[parent[rank + 1]], u, v):
                dead.add(vocab[merges[rank][0] + merges[rank][1]])
        # The spellings of all tokens, as one tree over base symbols; a node's token is at key None.
        self.spellings: dict = {}
        for s, i in vocab.items():
            if i not in dead:
                node = self.spellings
                for c in self.spell(s):
                    node = node.setdefault(c, {})
                node[None] = i

    @staticmethod
    def spell(token: str) -> list[str]:
        body = token[: -len(END)] if token.endswith(END) and len(token) > len(END) else token
        out = list(body)
        if body is not token:
            out[-1] += END
        return out

    def _number(self, parent: list[int]) -> None:
        """Pre-order intervals of the state tree: one state descends from another if it lies inside."""
        children: dict[int, list[int]] = {}
        for s, p in enumerate(parent):
            if p >= 0:
                children.setdefault(p, []).append(s)
        first, last, clock = [0] * len(parent), [0] * len(parent), 0
        stack = [(0, False)]
        while stack:
            s, leaving = stack.pop()
            if leaving:
                last[s] = clock
                continue
            first[s] = clock
            clock += 1
            stack.append((s, True))
            stack += [(c, False) for c in children.get(s, ())]
        self.first, self.last = first, last

    def has_arc(self, before: int, token: int) -> bool:
        """Whether the state entered by an arc ``before`` (-1: the start) still has an arc ``token``.

        A gadget took the arc ``z`` from the state if the gadget's state is the state or above it;
        the arcs that grew out of ``z`` later (its extensions to the right) never came to exist.
        """
        if before < 0:
            return True
        key = before * self.size + token
        known = self.arcs.get(key)
        if known is None:
            known = self._arc(before, token)
            if len(self.arcs) >= ARC_MEMORY:
                self.arcs.clear()
            self.arcs[key] = known
        return known

    def _starts(self, token: int) -> list[tuple[int, int]]:
        """The arcs that ``token`` grew out of, from itself down, each with the gadget that extended it."""
        found = self.starts.get(token)
        if found is None:
            found, z, newer = [], token, len(self.first)
            while z is not None:
                found.append((z, newer))
                newer, z = self.born.get(z, -1), self.left.get(z)
            self.starts[token] = found
        return found

    def _tails(self, token: int) -> list[int]:
        """The tokens whose gadgets shaped the state that ``token`` leads to."""
        found = self.tails.get(token)
        if found is None:
            found, y = [], token
            while y is not None:
                found.append(y)
                y = self.right.get(y)
            self.tails[token] = found
        return found

    def _arc(self, before: int, token: int) -> bool:
        return self._arc_from(self.first[self.target.get(before, 0)], before, token)

    def _arc_from(self, at: int, before: int, token: int) -> bool:
        """at: the pre-order number of the state, which arcs ``before`` lead to or once led to."""
        gadget, first = self.gadget, self.first
        starts = self._starts(token)
        for y in self._tails(before):
            for z, newer in starts:
                g = gadget.get((y, z))
                if g is not None and g <= newer and first[g + 1] <= at < self.last[g + 1]:
                    return False
        return True

    def segment(self, symbols: list[str]) -> list[int]:
        """The labels of the accepting path, longest arcs tried first.

        A prefix has one segmentation, so a position is entered at most once, by its own arc.
        """
        n, spellings, arcs, size = len(symbols), self.spellings, self.arcs, self.size
        by, start = [-1] * (n + 1), [-1] * (n + 1)
        steps = [(0, -1, 0)]
        while start[n] < 0 and steps:
            i, token, origin = steps.pop()
            if i:
                if start[i] >= 0:
                    continue
                before = by[origin]
                if before >= 0:
                    ok = arcs.get(before * size + token)
                    if not (self.has_arc(before, token) if ok is None else ok):
                        continue
                by[i], start[i] = token, origin
            node, j = spellings, i
            while j < n:
                node = node.get(symbols[j])
                if node is None:
                    break
                j += 1
                token = node.get(None)
                if token is not None:
                    steps.append((j, token, i))
        if n and start[n] < 0:
            raise ValueError(f"no path for {''.join(symbols)!r}")
        out, j = [], n
        while j:
            out.append(by[j])
            j = start[j]
        return out[::-1]


class Memory:
    """A bounded dictionary of two generations: the older one goes when the newer one is full."""

    def __init__(self, most: int):
        self.most, self.new, self.old = most // 2, {}, {}

    def get(self, key: str) -> bytes | None:
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key: str, value: bytes) -> bytes:
        if len(key) <= 64:
            if len(self.new) >= self.most:
                self.old = dict(self.new)
                self.new.clear()
            self.new[key] = value
        return value


class Tokenizer:
    """A word-splitting BPE vocabulary file, run by the automaton."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m if isinstance(m, list) else m.split(" ", 1)) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        splits = [p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        self.words = regex.compile(splits[0]["pattern"]["Regex"])
        self.bytes = byte_symbols()
        self.forget()

    def forget(self) -> None:
        """Drops the words met so far; the automaton stays."""
        self.memory, self.chunks = Memory(WORD_MEMORY), Memory(CHUNK_MEMORY)

    def word(self, word: str) -> bytes:
        ids = self.memory.get(word)
        if ids is None:
            symbols = [self.bytes[b] for b in word.encode("utf-8")]
            symbols[-1] += END
            ids = self.memory.put(word, array("i", self.automaton.segment(symbols)).tobytes())
        return ids

    def chunk(self, chunk: str) -> bytes:
        """The ids of text between two white spaces, which no word spans."""
        ids = self.chunks.get(chunk)
        if ids is None:
            found = self.words.findall(chunk)
            ids = self.word(found[0]) if len(found) == 1 else b"".join(map(self.word, found))
            self.chunks.put(chunk, ids)
        return ids

    def _plain(self, text: str) -> bytes:
        # Lower case letter by letter, as the vocabulary's library does: sigma has no final form.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        known, out = self.chunks.new, []
        # str.split() also cuts at four control characters that the pattern takes as symbols.
        for w in text.split() if not CONTROLS.search(text) else SPACE.split(text):
            ids = known.get(w)
            out.append(self.chunk(w) if ids is None else ids)
        return b"".join(out)

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        if self.cut is not None and any(s in text for s in self.special):
            parts = [np.int32(self.special[p]).tobytes() if p in self.special else self._plain(p) for p in self.cut.split(text)]
            return np.frombuffer(b"".join(parts), np.int32)
        return np.frombuffer(self._plain(text), np.int32)


def read_labels(path: str) -> np.ndarray:
    """The arc label of each id."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    found = {**spec["model"]["vocab"], **{t["content"]: t["id"] for t in spec["added_tokens"]}}
    out = np.full(max(found.values()) + 1, None, dtype=object)
    for s, i in found.items():
        out[i] = s
    return out


def emit(labels: np.ndarray, ids: np.ndarray) -> str:
    """The arc labels, joined by one space: the vocabulary file names no decoder."""
    return " ".join(labels[ids].tolist())


_LOADED: dict[str, Tokenizer] = {}
_LABELS: dict[str, np.ndarray] = {}


def located(vocabulary: str) -> str:
    """The path of a vocabulary file on this machine; a bare name is that of a public vocabulary."""
    if os.path.exists(vocabulary):
        return vocabulary
    import public_tokenizers

    return public_tokenizers.path(vocabulary)


def tokenizer(vocabulary: str) -> Tokenizer:
    """Compiled once in each worker."""
    if vocabulary not in _LOADED:
        _LOADED[vocabulary] = Tokenizer(located(vocabulary))
    return _LOADED[vocabulary]


def _with(schema: T.StructType, field: T.StructField) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name != field.name] + [field])


def encode(df: DataFrame, vocabulary: str, text: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with a column ``out`` array<int>: the token ids of the whole text."""
    schema = _with(df.schema, T.StructField(out, T.ArrayType(T.IntegerType(), False), False))
    keep = [i for i, f in enumerate(df.schema.fields) if f.name != out]
    at = df.schema.fieldNames().index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(vocabulary)
        try:
            for b in batches:
                for lo in range(0, b.num_rows, 1000):
                    part = b.slice(lo, 1000)
                    ids = [t.encode(x) for x in part.column(at).to_pylist()]
                    offsets = np.zeros(len(ids) + 1, np.int32)
                    np.cumsum([len(x) for x in ids], out=offsets[1:])
                    values = np.concatenate(ids) if ids else np.empty(0, np.int32)
                    column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
                    yield pa.RecordBatch.from_arrays([part.column(i) for i in keep] + [column], names=schema.fieldNames())
        finally:
            t.forget()  # an idle worker keeps no words of a task that is over

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with a column ``out`` string: the labels of the ids, special tokens included."""
    schema = _with(df.schema, T.StructField(out, T.StringType(), False))
    keep = [i for i, f in enumerate(df.schema.fields) if f.name != out]
    at = df.schema.fieldNames().index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _LABELS:
            _LABELS[vocabulary] = read_labels(located(vocabulary))
        labels = _LABELS[vocabulary]
        for b in batches:
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                lists = part.column(at)
                bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                texts = [emit(labels, flat[bounds[i] : bounds[i + 1]]) for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([part.column(i) for i in keep] + [pa.array(texts, pa.string())], names=schema.fieldNames())

    return df.mapInArrow(run, schema)


def digests(df: DataFrame, ids: str = "ids", decoded: str = "decoded") -> list:
    """Columns that identify an encoding: count, and hashes of the ids and of the decoded text."""
    return [
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col(ids).cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded).cast("binary"), 256).alias("decoded_sha256"),
    ]

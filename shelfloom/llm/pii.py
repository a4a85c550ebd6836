"""Personal data: fixed patterns, and terms that disclose them (information-theoretic sanitisation).

*Entities* are found by patterns: e-mail addresses, IPv4 addresses, payment cards (Luhn) and phone
numbers.  *Secrets* (keys, tokens, passwords, account numbers) are protected too; the corpus says what
they look like.  Runs of letters and digits with room for ``bits`` bits or more fall into *shapes*
(alphabet and length).  A value with n distinct uses among N documents has PMI(value; its document) =
log N / n, of the IC log N that the document has; where the mean share over a shape's values is at least
``disclosure``, values of the shape name their record, and all are spans of kind ``secret``.  A shape with fewer than ``support``
values goes by its alphabet as a whole; one of which neither has so many is left alone.

*Terms* that give an entity away are found from the corpus as well.  With

    p(e)     the share of all words of the corpus that stand beside entity e,
    p(e | t) the share of the uses of term t that stand beside e,

an entity's information content is IC(e) = -log p(e), a term's information about it is the pointwise
mutual information PMI(t; e) = log p(e | t) / p(e), and t discloses e if

    PMI(t; e) >= ``disclosure`` * IC(e):

a term that stands beside e only has PMI = IC; rare entities are given away by less certain terms than
common ones.  An entity is a kind as a whole (all e-mail addresses, all secrets), for values hardly
repeat, and each value besides, for those that do.  Uses are *distinct* ones (the term with its neighbours), so copies of a text are one piece
of evidence, and at least ``support`` of them must be near the entity.  Everything is counted over all
documents.  Terms over the threshold become spans of kind ``term`` wherever they occur; ``sanitize``
generalises entities and secrets to their kind and removes terms.

Terms travel to the tasks in blocks of at most ``MAX_TERMS``; more terms make more passes over the
rows in place, never a larger broadcast.  Two facts decide most terms exactly, without their uses being
shuffled: a term has at least as many uses as stand beside any entity, and at least as many as one task
finds.  A term over what its threshold allows by either is out; a task says so in one row.
Shapes are a few
alphabets times ``LONGEST`` lengths at most, whatever the corpus, and are read on the driver.

Cases: null and empty texts have no spans; entities of one kind do not overlap, of several kinds may;
terms and secrets inside an entity are not reported; repeated rows are treated alike; an empty table is fine;
long digit or letter runs are handled in linear time; columns named like the output are replaced, others
pass through.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfloom.llm.common import discard, materialize

KINDS = ("email", "ip", "card", "phone")
SECRET = "secret"
MAX_TERMS = 200_000
#: Texts that a task holds as Python objects at once.
SLICE = 256
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
HEX = re.compile(r"[0-9A-Fa-f]+")
WORD = re.compile(r"[^\W\d_]{3,}")
RUN = re.compile(r"(?<![^\W_])[A-Za-z0-9]{8,}(?![^\W_])")
#: Lengths of runs from here on are one shape.
LONGEST = 128
#: Characters on either side of a run that tell its uses apart.
BESIDE = 16
SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


@dataclass(frozen=True)
class DisclosureSpec:
    """window: characters beside an entity; words: at most so many on either side."""

    window: int = 60
    words: int = 4
    support: int = 3
    disclosure: float = 0.95
    bits: float = 48.0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """An address begins with the longest run of local characters before its @ that is still free."""
    free, at = 0, text.find("@")
    while at >= 0:
        head = text[free:at]
        start = free + len(head.rstrip(LOCAL))
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
        free = found.end() if found else at + 1
        at = text.find("@", free)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def entities(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    if not text:
        return []
    out = [("email", a, b) for a, b in emails(text)]
    if DIGIT.search(text):
        if "." in text:
            for m in IP.finditer(text):
                # Long parts are over the limit whatever they say; int() is not asked for them.
                if all(len(p.lstrip("0")) <= 3 and int(p[-3:] if len(p) > 3 else p) <= 255 for p in m[0].split(".")):
                    out.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            if m.end() - m.start() <= 37:
                digits = m[0].replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    out.append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append(("phone", *m.span()))
    return out


def lowered(text: str) -> str:
    """Lower case in which all positions hold: U+0130 alone would become two characters."""
    return text.replace("\u0130", "i").lower()


def shape(run: str) -> tuple[str, int, float]:
    """(alphabet, length, bits): the smallest alphabet that holds a run with digits, and the room that it gives.

    A run without digits is a word and has no room.
    """
    lower, upper = run != run.upper(), run != run.lower()
    if not DIGIT.search(run):
        return "", len(run), 0.0
    if not lower and not upper:
        name, size = "digits", 10
    elif lower != upper and HEX.fullmatch(run):
        name, size = "hex" if lower else "HEX", 16
    elif lower != upper:
        name, size = "lower" if lower else "upper", 36
    else:
        name, size = "mixed", 62
    return name, min(len(run), LONGEST), len(run) * math.log2(size)


def runs(text: str, taken: list[tuple[int, int]], bits: float) -> Iterator[tuple[str, int, int, int]]:
    """(alphabet, length, start, end) of the runs of at least ``bits`` bits outside ``taken``, which is sorted."""
    i = 0
    for m in RUN.finditer(text):
        name, length, room = shape(m[0])
        if room >= bits:
            while i < len(taken) and taken[i][1] <= m.start():
                i += 1
            if not any(s < m.end() for s, _ in taken[i : i + 1]):
                yield name, length, m.start(), m.end()


def _taken(found: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Sorted spans without overlaps."""
    out: list[tuple[int, int]] = []
    for s, e in sorted((s, e) for _, s, e in found):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def protected(text: str | None, shapes: frozenset[tuple[str, int]], bits: float) -> list[tuple[str, int, int]]:
    """Entities, then secrets of the given shapes."""
    found = entities(text)
    if text and shapes and DIGIT.search(text):
        found += [(SECRET, s, e) for name, length, s, e in runs(text, _taken(found), bits) if (name, length) in shapes]
    return found


def secret_shapes(docs: DataFrame, spec: DisclosureSpec | None = None) -> DataFrame:
    """(alphabet, length, n_values, n_uses, revealed): every shape of the corpus and what a value of it reveals, 0 to 1.

    revealed is of the alphabet as a whole where the shape has fewer values than ``support``, and null if that has, too.
    """
    spec = spec or DisclosureSpec()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = set()
            for text in (t for lo in range(0, b.num_rows, SLICE) for t in b.column(0).slice(lo, SLICE).to_pylist()):
                if text and DIGIT.search(text):
                    for name, length, s, e in runs(text, _taken(entities(text)), spec.bits):
                        rows.add((name, length, _hash(text[s:e].lower()), _hash(text[max(0, s - BESIDE) : s], text[e : e + BESIDE])))
            cols = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds, strict=True)], names=["alphabet", "length", "value", "use"])

    found = docs.select("text").mapInArrow(run, "alphabet string, length int, value long, use long").distinct()
    values = found.groupBy("alphabet", "length", "value").agg(F.count("*").alias("n"))
    sums = [F.count("*").alias("n_values"), F.sum("n").alias("n_uses"), F.sum(F.log("n")).alias("logs")]
    one = materialize(values.groupBy("alphabet", "length").agg(*sums), "pii-shapes")
    ic = F.lit(math.log(max(docs.count(), 2)))
    whole = one.groupBy("alphabet").agg(*(F.sum(c).alias(f"all_{c}") for c in ("n_values", "logs")))

    def revealed(prefix: str) -> Column:
        n, logs = F.col(f"{prefix}n_values"), F.col(f"{prefix}logs")
        return F.when(n >= spec.support, F.greatest(1 - logs / n / ic, F.lit(0.0)))

    return one.join(F.broadcast(whole), "alphabet").select("alphabet", "length", "n_values", "n_uses", F.coalesce(revealed(""), revealed("all_")).alias("revealed"))


def revealing(shapes: DataFrame, spec: DisclosureSpec | None = None) -> frozenset[tuple[str, int]]:
    """The shapes over the threshold; at most six alphabets times ``LONGEST`` lengths."""
    spec = spec or DisclosureSpec()
    return frozenset((r[0], r[1]) for r in shapes.where(F.col("revealed") >= spec.disclosure).select("alphabet", "length").collect())


def _hash(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\0".join(parts).encode("utf-8", "surrogatepass")) - (1 << 63)


def _uses(words: list[tuple[str, int, int]], k: int) -> int:
    """Hash of a word with its neighbours."""
    before = words[k - 1][0] if k else ""
    after = words[k + 1][0] if k + 1 < len(words) else ""
    return _hash(before, words[k][0], after)


#: Entities that stand for a kind as a whole.
POOLED = {kind: _hash(kind) for kind in (*KINDS, SECRET)}
#: Stands for all entities together.
ANY = _hash("any")


def neighbours(docs: DataFrame, spec: DisclosureSpec, shapes: frozenset[tuple[str, int]] = frozenset()) -> DataFrame:
    """(entity, term, use): the distinct uses of terms beside each entity value, each kind, and any entity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = set()
            for text in (t for lo in range(0, b.num_rows, SLICE) for t in b.column(0).slice(lo, SLICE).to_pylist()):
                found = protected(text, shapes, spec.bits)
                if not found:
                    continue
                taken = _taken(found)
                low = lowered(text)
                for kind, start, end in found:
                    value = _hash(kind, text[start:end].lower())
                    lo, hi = max(0, start - spec.window), min(len(text), end + spec.window)
                    around = [(m[0], m.start(), m.end()) for m in WORD.finditer(low, lo, hi)]
                    # Words cut by the window's edge are left out, and so are the entities' own.
                    around = [w for w in around if (w[1] > lo or lo == 0) and (w[2] < hi or hi == len(text)) and not any(s < w[2] and w[1] < e for s, e in taken)]
                    left = [k for k, w in enumerate(around) if w[2] <= start][-spec.words :]
                    right = [k for k, w in enumerate(around) if w[1] >= end][: spec.words]
                    for k in left + right:
                        use = _uses(around, k)
                        rows.update((e, around[k][0], use) for e in (value, POOLED[kind], ANY))
            cols = list(zip(*rows, strict=True)) if rows else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(list(cols[0]), pa.int64()), pa.array(list(cols[1]), pa.string()), pa.array(list(cols[2]), pa.int64())], names=["entity", "term", "use"])

    return docs.select("text").mapInArrow(run, "entity long, term string, use long").distinct()


def _blocks(terms: DataFrame, value: str) -> Iterator[dict]:
    """(term -> value) in blocks of at most MAX_TERMS, as a table sorted by term gives them."""
    block: dict = {}
    for r in terms.select("term", value).orderBy("term").toLocalIterator():
        block[r[0]] = r[1]
        if len(block) == MAX_TERMS:
            yield block
            block = {}
    if block:
        yield block


def disclosing_terms(docs: DataFrame, spec: DisclosureSpec = DisclosureSpec(), shapes: frozenset[tuple[str, int]] = frozenset()) -> DataFrame:
    """(term, near, uses, pmi, ic): terms whose information about an entity is at least ``disclosure`` of the entity's own.

    near, pmi and ic (in nats) are those of the entity that the term gives away most surely.
    """
    spark = docs.sparkSession
    words = docs.agg(F.sum(F.regexp_count("text", F.lit(r"\p{L}{3,}"))).alias("n")).collect()[0]["n"] or 0
    pairs = materialize(neighbours(docs, spec, shapes).groupBy("entity", "term").agg(F.count("*").alias("n")), "pii-pairs")
    beside = pairs.where(F.col("entity") != ANY).groupBy("entity").agg(F.sum("n").alias("beside"))
    # More distinct uses than words cannot be, but a window may cut words otherwise: never below zero.
    ic = F.greatest(F.log(F.lit(float(words)) / F.col("beside")), F.lit(0.0))
    # PMI >= d * IC  is  uses <= near * exp((1 - d) * IC): what a term may have at most, by its best entity.
    # A kind is one hot key: its few sums are sent to the pairs, those of values are joined.
    of_kind = F.col("entity").isin(list(POOLED.values()))
    strong = pairs.where((F.col("n") >= spec.support) & (F.col("entity") != ANY))
    best = strong.where(~of_kind).join(beside.where(~of_kind), "entity").unionByName(strong.where(of_kind).join(F.broadcast(beside.where(of_kind)), "entity"))
    best = best.select("term", "n", ic.alias("ic"))
    best = best.withColumn("allowed", F.floor(F.col("n") * F.exp((1 - spec.disclosure) * F.col("ic"))).cast("long"))
    best = best.groupBy("term").agg(F.max(F.struct("allowed", F.col("n").alias("near"), "ic")).alias("b"))
    # Uses beside any entity are uses: too many of them, and the term is out before it is counted.
    beside_any = pairs.where(F.col("entity") == ANY).select("term", F.col("n").alias("beside_any"))
    best = best.select("term", "b.allowed", "b.near", "b.ic").join(beside_any, "term").where("beside_any <= allowed")
    near = materialize(best, "pii-near")
    discard(pairs)
    out = None
    for block in _blocks(near, "allowed"):
        model = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            allowed = model.value
            seen: dict[str, set[int]] = {t: set() for t in allowed}
            for b in batches:
                for text in (t for lo in range(0, b.num_rows, SLICE) for t in b.column(0).slice(lo, SLICE).to_pylist()):
                    words = WORD.findall(lowered(text)) if text else []
                    for k, w in enumerate(words):
                        uses = seen.get(w)
                        if uses is not None and len(uses) <= allowed[w]:
                            before = words[k - 1] if k else ""
                            after = words[k + 1] if k + 1 < len(words) else ""
                            uses.add(_hash(before, w, after))
            # A null for all the uses of a term that has too many here already.
            rows = [(t, u) for t, uses in seen.items() for u in (uses if len(uses) <= allowed[t] else (None,))]
            for lo in range(0, len(rows), 50_000):
                part = rows[lo : lo + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in part], pa.string()), pa.array([r[1] for r in part], pa.int64())], names=["term", "use"])

        counted = docs.select("text").mapInArrow(run, "term string, use long").distinct().groupBy("term").agg(F.count("use").alias("uses"), F.count_if(F.col("use").isNull()).alias("over"))
        out = counted if out is None else out.unionByName(counted)
    if out is None:
        return spark.createDataFrame([], "term string, near long, uses long, pmi double, ic double")
    # Beside an entity a use may lack a neighbour that the window cut: uses are never fewer than those.
    pmi = F.log(F.col("near") / F.col("uses")) + F.col("ic")
    counted = near.join(out, "term").where("over = 0 AND uses <= allowed").withColumn("uses", F.greatest("uses", "beside_any"))
    return counted.select("term", "near", "uses", pmi.alias("pmi"), "ic")


def detect(df: DataFrame, terms: DataFrame | None = None, out: str = "spans", shapes: frozenset[tuple[str, int]] = frozenset(), bits: float = DisclosureSpec.bits) -> DataFrame:
    """``df`` (with ``text``) and a column ``out``: array of (kind, start, end), entities first, then secrets, then terms."""
    found = df.drop(out).withColumn(out, _protected_spans(shapes, bits)("text"))
    for block in _blocks(terms.withColumn("one", F.lit(1)), "one") if terms is not None else ():
        found = found.withColumn(out, _term_spans(df.sparkSession.sparkContext.broadcast(block))("text", out))
    return found


def _protected_spans(shapes: frozenset[tuple[str, int]], bits: float):
    @F.arrow_udf(SPANS)
    def spans(texts: pa.Array) -> pa.Array:
        out = []
        for lo in range(0, len(texts), SLICE):
            out += [[{"kind": k, "start": s, "end": e} for k, s, e in protected(t, shapes, bits)] for t in texts.slice(lo, SLICE).to_pylist()]
        return pa.array(out, _SPAN_TYPE)

    return spans


def _term_spans(model):
    @F.arrow_udf(SPANS)
    def more(texts: pa.Array, spans: pa.Array) -> pa.Array:
        block, out = model.value, []
        for lo in range(0, len(texts), SLICE):
            for text, own in zip(texts.slice(lo, SLICE).to_pylist(), spans.slice(lo, SLICE).to_pylist(), strict=True):
                taken = sorted((s["start"], s["end"]) for s in own)
                for m in WORD.finditer(lowered(text)) if text else ():
                    if m[0] in block and not any(s < m.end() and m.start() < e for s, e in taken):
                        own.append({"kind": "term", "start": m.start(), "end": m.end()})
                out.append(own)
        return pa.array(out, _SPAN_TYPE)

    return more


@F.arrow_udf(T.StringType())
def _sanitized(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for lo in range(0, len(texts), SLICE):
        for text, own in zip(texts.slice(lo, SLICE).to_pylist(), spans.slice(lo, SLICE).to_pylist(), strict=True):
            parts, free = [], 0
            for s in sorted(own or (), key=lambda s: (s["start"], -s["end"])):
                if s["start"] >= free and text is not None:
                    parts += [text[free : s["start"]], "" if s["kind"] == "term" else f"<{s['kind'].upper()}>"]
                    free = s["end"]
            out.append(None if text is None else "".join(parts) + text[free:])
    return pa.array(out, pa.string())


def sanitize(df: DataFrame, spans: str = "spans", out: str = "clean_text") -> DataFrame:
    """``df`` with ``out``: entities and secrets generalised to ``<KIND>``, disclosing terms removed."""
    return df.drop(out).withColumn(out, _sanitized("text", spans))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

"""Spelling variants by permuterm rotations: words that differ in one letter, grouped around their commonest form.

1. *Words.*  Maximal runs of letters are counted over whole texts, partially in each task.
2. *Rotations.*  A word with a terminator after it is turned so that every place comes last once.  A rotation
   without its last letter is the word without that letter, seen from that place: the prefix that all words
   share which differ there only.  Sorted, a prefix range holds these words next to each other, after the
   word (if any) whose whole rotation the prefix is, which lacks the letter.  So replacements are pairs of one
   range, insertions and deletions are pairs of its head and its rest.  An indel within repeated letters shows
   at each of them; only the first counts.
3. *Scan.*  Ranges of several words are scanned.  A range holds one word for each letter that may stand at its
   place, and one without: never more than the alphabet and one, however many words there are.
4. *Forms.*  A word's form is its commonest neighbour, where that is ``ratio`` times as common.  Counts grow
   along forms, so there are no cycles; roots are found by pointer doubling, in rounds that grow with the
   logarithm of the logarithm of the largest count.

Words are numbered in code-point order, so ranges carry numbers of 8 bytes and ties need no words.  From
``LONG`` letters on a prefix is stood for by hashes of its two sides (modulo 2^127 - 1), found in one pass over
the word: rotations of a very long run would be quadratic.

Cases: null and empty texts hold no words; repeated rows count each; a null doc_id is hashed as the empty text;
of equal counts the word that is smaller in code-point order is the form; without words the result is empty;
columns besides id and text are not read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfloom.llm.common import carried, discard, materialize

#: Shortest words and fewest occurrences; a form is so many times as common; every so manieth hash drops a letter.
SHORTEST, LEAST, RATIO, EVERY = 6, 5, 5, 199
#: Remaining letters from which a prefix is hashed.
LONG = 64
END = "$"
_PRIME, _BASE = (1 << 127) - 1, 0x5DEECE66D1CE4E5B9F4A7C15F39CC0605


def word_counts(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, every: int = EVERY, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): the words of all texts, A-Z lower-cased.

    Where ``every`` divides the crc32 of ``<id>:<run>``, the run loses the letter at that hash modulo its length.
    """
    lower = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    # A shorter run can't give a word, with or without a letter less.
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(lower, F.lit(f"[a-zÀ-ÿ]{{{shortest},}}"), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    without = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2, F.length("run")))
    words = runs.withColumn("h", h).select(F.when(F.col("h") % every == 0, without).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def numbered(words: DataFrame) -> DataFrame:
    """(wid, word, n), written; numbers are in code-point order."""
    counted = materialize(words.select("word", "n"), "var-counts")
    inorder = counted.repartitionByRange("word").sortWithinPartitions("word")
    out = materialize(inorder.select(F.monotonically_increasing_id().alias("wid"), "word", "n"), "var-words")
    discard(counted)
    return out


def _plain(words: DataFrame) -> DataFrame:
    """Rotations of words below LONG letters: (key, wid, n, skip, first)."""
    cut = words.where(F.length("word") < LONG).select("wid", "n", "word", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("i"))
    after = F.substr("word", F.col("i") + 1, F.length("word"))
    before = F.substr("word", F.lit(1), F.col("i"))
    # The rotation that ends before letter i, whole; and the one that ends with it, without it.
    whole = F.struct(F.concat(after, F.lit(END), before).alias("key"), F.lit(False).alias("skip"), F.lit(True).alias("first"))
    letter, last = F.substr("word", F.col("i") + 1, F.lit(1)), F.substr("word", F.greatest(F.col("i"), F.lit(1)), F.lit(1))
    rest = F.concat(F.substr("word", F.col("i") + 2, F.length("word")), F.lit(END), before)
    less = F.struct(rest.alias("key"), F.lit(True).alias("skip"), ((F.col("i") == 0) | (letter != last)).alias("first"))
    both: Column = F.when(F.col("i") < F.length("word"), F.array(whole, less)).otherwise(F.array(whole))
    return cut.select("wid", "n", F.explode(both).alias("r")).select("r.key", "wid", "n", "r.skip", "r.first")


def _hashed(words: DataFrame) -> DataFrame:
    """The same for longer words, one pass over each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for wid, n, word in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                size, front, back = len(word), [0], [0]
                for c, d in zip(word, reversed(word), strict=True):
                    front.append((front[-1] * _BASE + ord(c)) % _PRIME)
                    back.append((back[-1] * _BASE + ord(d)) % _PRIME)

                def key(i: int, j: int, left: int) -> str:
                    """Letters from j on, then those before i: ``left`` letters."""
                    if left < LONG:
                        return f"{word[j:]}{END}{word[:i]}"  # noqa: B023
                    return f"{left:x} {back[size - j]:x}{END}{front[i]:x}"  # noqa: B023

                for lo in range(0, size + 1, 10_000):
                    at = range(lo, min(lo + 10_000, size + 1))
                    rows = [(key(i, i, size), False, True) for i in at]
                    rows += [(key(i, i + 1, size - 1), True, i == 0 or word[i] != word[i - 1]) for i in at if i < size]
                    keys, skip, first = zip(*rows, strict=True)
                    same = [pa.array([x] * len(rows), pa.int64()) for x in (wid, n)]
                    yield pa.RecordBatch.from_arrays([pa.array(keys), *same, pa.array(skip), pa.array(first)], names=["key", "wid", "n", "skip", "first"])

    long = words.where(F.length("word") >= LONG).select("wid", "n", "word")
    return long.mapInArrow(run, "key string, wid long, n long, skip boolean, first boolean")


def ranges(words: DataFrame) -> DataFrame:
    """(members): the words of each prefix range that holds several, commonest first, as (more, wid, skip, first)."""
    member = F.struct((-F.col("n")).alias("more"), "wid", "skip", "first")
    found = _plain(words).unionByName(_hashed(words)).groupBy("key").agg(F.collect_list(member).alias("m"))
    return found.where(F.size("m") > 1).select(F.array_sort("m").alias("members"))


def _near(x: Column, y: Column) -> Column:
    """Two members of a range are neighbours: both lack the letter at its place, or the first of its kind does."""
    return (x["wid"] != y["wid"]) & ((x["skip"] & y["skip"]) | (x["skip"] & x["first"] & ~y["skip"]) | (y["skip"] & y["first"] & ~x["skip"]))


def neighbours(words: DataFrame) -> DataFrame:
    """(word, near): all pairs of words of (word, n) that differ in one letter, in both directions, each once."""
    known = numbered(words)
    pairs = ranges(known).select(F.explode("members").alias("x"), "members").select("x", F.explode("members").alias("y"))
    pairs = pairs.where(_near(F.col("x"), F.col("y"))).select(F.col("x.wid").alias("wid"), F.col("y.wid").alias("other"))
    named = known.select(F.col("wid").alias("other"), F.col("word").alias("near"))
    return pairs.join(known.select("wid", "word"), "wid").join(named, "other").select("word", "near")


def _best(words: DataFrame) -> DataFrame:
    """(wid, n_near, best_n, best): each word's number of neighbours and the commonest of them."""
    mine = lambda x: F.filter("members", lambda y: _near(x, y))
    each = F.transform("members", lambda x: F.struct(x["wid"].alias("wid"), mine(x).alias("others")))
    found = ranges(words).select(F.explode(each).alias("e")).select("e.wid", F.size("e.others").alias("k"), F.get("e.others", F.lit(0)).alias("o"))
    top = F.min(F.struct(F.col("o.more").alias("more"), F.col("o.wid").alias("wid")))
    got = found.where("k > 0").groupBy("wid").agg(F.sum("k").alias("n_near"), top.alias("t"))
    return got.select("wid", "n_near", (-F.col("t.more")).alias("best_n"), F.col("t.wid").alias("best"))


def _roots(links: DataFrame) -> DataFrame:
    """links: (wid, root), a forest.  Follows them to the end, twice as far each round."""
    out = materialize(links, "var-roots")
    while True:
        ahead = out.select(F.col("wid").alias("root"), F.col("root").alias("next"))
        step = materialize(out.join(ahead, "root", "left").select("wid", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "var-roots")
        done = step.where("moved").isEmpty()
        discard(out)
        out = carried(step.drop("moved"), step)
        if done:
            return out


def group_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """words: (word, n).  Returns word, n, n_near, form, form_n, root."""
    known = numbered(words)
    best = materialize(_best(known).join(known.select("wid", "n"), "wid").drop("n"), "var-best")
    held = known.join(best, "wid", "left")
    form = F.when(F.col("best_n") >= ratio * F.col("n"), F.col("best"))
    held = materialize(held.select("wid", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), form.alias("form_id"), F.when(form.isNotNull(), F.col("best_n")).alias("form_n")), "var-forms")
    discard(best)
    roots = _roots(held.where("form_id is not null").select("wid", F.col("form_id").alias("root")))
    name = lambda i, c: known.select(F.col("wid").alias(i), F.col("word").alias(c))
    linked = held.where("form_id is not null").join(roots.withColumnRenamed("root", "root_id"), "wid").join(name("form_id", "form"), "form_id").join(name("root_id", "root"), "root_id")
    out = held.drop("form_id").join(linked.select("wid", "form", "root"), "wid", "left")
    return carried(out.select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")), known)

"""Groups of spelling variants: words that differ by one character, found by asymmetric q-chunks.

Of two words that one edit parts, the shorter one (either, if both are as long) gives two disjoint chunks, its halves;
the other one gives the grams of the same sizes at the places a chunk can have there. One edit leaves a chunk as it is:
the first one in its place, the last one shifted by the difference in length, so by one at most. (Grams at other places
meet no chunk within that shift, so they aren't written.) Words meet by chunk and are verified by edit distance.

Where more than ``hot`` words share a chunk, what is left of them must still differ by one edit, so it is chunked again,
for these words alone, until few share a chunk or one character is left. Then the words that meet are all one edit apart,
and no more than the alphabet has letters. So a chunk never brings all pairs of many words together, whatever it is.

Words come from runs of letters, counted within tasks first. Joins by chunk have plain exchanges, so that adaptive
execution splits what many longer words share.

Defined cases: null and empty texts have no words; very long texts are scanned as arrays of bytes, very long runs are
words like others. Repeated rows count each time. A null doc_id counts as the empty text where it is hashed. Chunks carry
64-bit hashes, which only choose what is compared. Ties between near words go to the smallest in code-point order. Empty
tables give no words. Columns other than id and text are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_signals.llm.shared import staged, union
from review_signals.llm.text_arrays import chunks, tidy

#: Words that a task counts before it sends them on.
COUNTED = 100_000
_LEAD = 0xC3  # the first byte of all of U+00C0 to U+00FF in UTF-8
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_LETTER = (_LOWER >= 97) & (_LOWER <= 122)


@dataclass(frozen=True)
class Variants:
    min_length: int = 7
    min_count: int = 2
    #: How much more often a near word must occur to be a word's form.
    times: int = 10
    #: One in so many runs of a document, by hash, loses a letter.
    worn: int = 31
    hot: int = 64


def worn_run(run: str, hashed: int, worn: int) -> str:
    """A run, without one of its letters if its hash says so."""
    if hashed % worn:
        return run
    at = hashed % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, variants: Variants) -> DataFrame:
    """``word``, its count ``n`` and its ``length`` in code points."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return batch

        for part, texts in chunks(batches, "text"):
            data = _LOWER[texts.data]
            lead = data == _LEAD
            letter = _IS_LETTER[data] | lead
            letter[1:] |= lead[:-1]
            edge = np.zeros(len(data) + 1, bool)
            edge[texts.first] = True
            before = np.concatenate([[False], letter[:-1]])[: len(letter)]
            starts = np.flatnonzero(letter & (~before | edge[:-1]))
            # a run ends where the next one starts or the first sign that is no letter follows
            stops = np.flatnonzero(np.append(~letter | edge[:-1], True))
            ends = stops[np.searchsorted(stops, starts, side="right")]
            seen = np.concatenate([[0], np.cumsum(lead)])
            long_enough = ends - starts - (seen[ends] - seen[starts]) >= variants.min_length
            starts, ends = starts[long_enough], ends[long_enough]
            raw = data.tobytes()
            prefixes = [zlib.crc32(b"%s:" % (b"" if number is None else str(number).encode())) for number in part.column("doc_id").to_pylist()]
            crc, worn = zlib.crc32, variants.worn
            for low, high, owner in zip(starts.tolist(), ends.tolist(), texts.owner(starts).tolist(), strict=True):
                run = raw[low:high]
                hashed = crc(run, prefixes[owner])
                counts[run.decode() if hashed % worn else worn_run(run.decode(), hashed, worn)] += 1
            if len(counts) > COUNTED:
                yield flush()
        yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(tidy(task), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return found.withColumn("length", F.char_length("word")).filter(
        (F.col("n") >= variants.min_count) & (F.col("length") >= variants.min_length))


def _part(low: str, high: str) -> Column:
    return F.struct(F.expr(f"int({low})").alias("low"), F.expr(f"int({high})").alias("high"))


def chunked(rows: DataFrame) -> DataFrame:
    """The rows once more for each chunk of what was left of them: ``low`` to ``high`` is left of the shorter word then.

    ``longer`` is 1 for a word that meets words shorter by one, so what is left of it is longer by one.
    """
    middle = "low + (high - low) div 2"
    halves = F.array(_part(middle, "high"), _part("low", middle))
    single = F.array(_part("high", "high"), _part("low", "low"))
    parts = rows.select("word", "n", "longer", F.explode(F.when(F.expr("high - low > 1"), halves).otherwise(single)).alias("part"))
    parts = parts.select("word", "n", "longer", "part.low", "part.high")
    kept = F.concat(F.expr("substring(word, 1, low)"), F.lit("|"), F.expr("substring(word, high + longer + 1)"))
    return parts.withColumn("chunk", F.xxhash64(kept, "low", "high", F.expr("char_length(word) - longer")))


def _met(rows: DataFrame, longer: bool) -> DataFrame:
    """Verified pairs among rows that share a chunk: words of one length, or if ``longer`` also of two."""
    left = rows.filter("longer = 0").select("chunk", F.col("word").alias("a"), F.col("n").alias("a_n"))
    right = rows.select("chunk", "longer", F.col("word").alias("b"), F.col("n").alias("b_n"))
    pairs = left.join(right if longer else right.filter("longer = 0"), "chunk").filter((F.col("longer") == 1) | (F.col("a") < F.col("b")))
    return pairs.filter(F.levenshtein("a", "b", 1) == 1).select("a", "a_n", "b", "b_n")


def near_pairs(words: DataFrame, variants: Variants) -> DataFrame:
    """Each pair of words that one edit parts, once: ``a``, ``a_n``, ``b``, ``b_n``."""
    longer = F.explode(F.array(F.lit(0), F.lit(1))).alias("longer")
    rows = words.select("word", "n", longer, F.lit(0).alias("low"), F.col("length").alias("high")).withColumn("high", F.expr("high - longer"))
    found = []
    while True:
        rows = staged(chunked(rows), "chunks")
        own = F.sum(1 - F.col("longer"))
        shared = rows.groupBy("chunk").agg(own.alias("own"), F.count(F.lit(1)).alias("all")).filter("own > 0 and all > 1")
        left = F.col("high") > F.col("low")
        hot = (F.col("own") > variants.hot) & left
        rows = staged(rows.join(shared.drop("all"), "chunk").withColumn("hot", hot).drop("own"), "shared-chunks")
        again = rows.filter("hot")
        found.append(staged(_met(rows.filter("not hot"), longer=True).unionByName(_met(again.filter("high - low = 1"), longer=False)), "near-words"))
        if again.isEmpty():
            return union(found).distinct()
        rows = again


def roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the last of the forms that follow from it; each form is commoner, so there is a last one."""
    now = staged(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        then = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ahead = staged(now.join(then, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "forms")
        now = ahead.drop("moved")
        if ahead.filter("moved").isEmpty():
            return now


def group_variants(docs: DataFrame, variants: Variants = Variants()) -> DataFrame:  # noqa: B008 - frozen
    """Every word with its ``form``, ``root``, counts ``n`` and ``form_n``, and ``n_near``, the number of near words."""
    words = staged(word_counts(docs, variants), "words")
    pairs = near_pairs(words, variants)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("b_n").alias("a_n"), F.col("a").alias("b"), F.col("a_n").alias("b_n")))
    best = F.min(F.struct((-F.col("b_n")).alias("less"), F.col("b").alias("near"))).alias("best")
    near = both.groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), best)
    forms = words.select("word", "n").join(near, "word", "left")
    common = F.col("best").isNotNull() & (-F.col("best.less") >= variants.times * F.col("n"))
    forms = staged(forms.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(common, F.col("best.near")).alias("form"),
        F.when(common, -F.col("best.less")).alias("form_n")), "word-forms")
    last = roots(forms.filter(F.col("form").isNotNull()))
    return forms.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

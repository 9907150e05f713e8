"""Benchmark passages in training documents, tolerant of substituted words. Native DataFrame functions only.

Words are lower-case runs of letters and digits. A mask of 1s and 0s, laid over consecutive words, hashes the words
under its 1s and ignores the others. Every place of a document is hashed under every mask and looked up among the
hashes of the benchmark; a hit fixes how document and item are aligned. Along that alignment an overlap counts if some
``window`` consecutive words are equal in at least ``min_equal`` places. With the default masks every such window
holds a hit, wherever its two substitutions are (a test goes through all of them), so the search loses nothing.

An item with fewer words than ``window`` counts if a document holds it whole. Such items are looked up by the same steps,
once for each length that occurs among them, with a mask of as many 1s.

The index of the benchmark is broadcast in blocks of at most ``block_rows`` rows, whose number is counted first: a
larger benchmark means more blocks, each against all documents. A row of it has a hash, its place, and the few words around
that a window with that place can reach, so it is small however long the item. Every hit is compared where it is found, and only
documents and items that overlap are shuffled. Documents and items are hashed in pieces of some words, so the work
grows with the length of a text, not with its square.

Defined cases: null and empty texts and items have no overlaps, nor has a document with fewer words than the item and than
``window``. A null doc_id is kept. Repeated rows of a document give one result row per item; repeated items with
different ids each count. Empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_signals.llm.shared import bounded, staged, union


@dataclass(frozen=True)
class Seeds:
    masks: tuple[str, ...] = ("11110011", "11010111")
    window: int = 13
    min_equal: int = 11
    block_rows: int = 500_000
    #: Places of a document that are looked up together, with the words around them.
    piece: int = 128

    def __post_init__(self) -> None:
        if len({len(mask) for mask in self.masks}) != 1 or len(self.masks[0]) > self.window:
            raise ValueError("masks must have one common length, not over the window")

    @property
    def span(self) -> int:
        return len(self.masks[0])

    @property
    def reach(self) -> int:
        """Words on either side of a hit that a window with the hit can have."""
        return self.window - self.span

    def whole(self, n_words: int) -> Seeds:
        """For items of fewer words than the window: all of them must be equal."""
        return replace(self, masks=("1" * n_words,), window=n_words, min_equal=n_words)


def word_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda word: word != "")
    return F.transform(words, lambda word: F.xxhash64(word))


def _pieces(texts: DataFrame, seeds: Seeds) -> DataFrame:
    """The texts (key, words) in pieces: ``piece`` places each, after ``ahead`` words before them, and as many words behind
    them as a window with one of the places can reach. A piece is all that is copied for a place, however long its text."""
    starts = F.sequence(F.lit(0), F.size("words") - seeds.span, F.lit(seeds.piece))

    def piece(start: Column) -> Column:
        first = F.greatest(start - seeds.reach, F.lit(0))
        return F.struct((start - first).alias("ahead"), F.slice("words", first + 1, start - first + seeds.piece + seeds.span + seeds.reach).alias("words"))

    long_enough = texts.filter(F.size("words") >= seeds.window)
    return long_enough.select("key", F.explode(F.transform(starts, piece)).alias("piece")).select("key", "piece.ahead", "piece.words")


def _hashes(seeds: Seeds) -> Column:
    """Hashes of the places of a piece: place i under mask m is at m * piece + i; null beyond the end of the text."""
    places = F.sequence(F.lit(0), F.lit(seeds.piece - 1))

    def under(number: int, mask: str) -> Column:
        steps = [step for step, bit in enumerate(mask) if bit == "1"]

        def hashed(i: Column) -> Column:
            here = F.xxhash64(F.lit(number), *(F.get(F.col("words"), F.col("ahead") + i + step) for step in steps))
            return F.when(F.col("ahead") + i + seeds.span <= F.size("words"), here)

        return F.transform(places, hashed)

    return F.concat(*(under(number, mask) for number, mask in enumerate(seeds.masks)))


def places(texts: DataFrame, seeds: Seeds) -> DataFrame:
    """All places of the texts (key, words) with their hashes; ``place`` counts from the first word of the piece."""
    rows = _pieces(texts, seeds).select("key", "words", "ahead", F.posexplode(_hashes(seeds)).alias("at", "seed"))
    return rows.select("seed", "key", F.expr(f"ahead + at % {seeds.piece}").alias("place"), "words")


def index(items: DataFrame, seeds: Seeds) -> DataFrame:
    """The hashes of the items (key, words), each with its item and the words around its place."""
    before = F.least("place", F.lit(seeds.reach))
    around = F.slice("words", F.col("place") - before + 1, before + seeds.span + seeds.reach)
    rows = places(items, seeds).filter(F.col("seed").isNotNull())
    return rows.select("seed", F.col("key").alias("item_id"), before.alias("item_place"), around.alias("item_words")).distinct()


def _overlaps(docs: DataFrame, items: DataFrame, seeds: Seeds) -> DataFrame:
    """Equal words of the best window of each document and item (key, words) that overlap."""
    known = staged(index(items, seeds), "benchmark-seeds")
    blocks = max(1, -(-known.count() // seeds.block_rows))
    found = []
    for block in range(blocks):
        part = known.filter(F.pmod(F.xxhash64("seed", "item_id"), F.lit(blocks)) == block)
        found.append(places(docs, seeds).join(bounded(part, 2 * seeds.block_rows), "seed"))
    # what the alignment lays over each other: as many words before and behind the place as both have
    before = F.least("place", "item_place")
    first, item_first = F.col("place") - before, F.col("item_place") - before
    length = F.least(F.size("words") - first, F.size("item_words") - item_first)
    aligned = union(found).filter(length >= seeds.window).select(
        F.col("key").alias("doc_id"), "item_id",
        F.zip_with(F.slice("words", first + 1, length), F.slice("item_words", item_first + 1, length), lambda a, b: (a == b).cast("int")).alias("equal"))
    starts = F.sequence(F.lit(1), F.size("equal") - seeds.window + 1)
    best = F.array_max(F.transform(starts, lambda i: F.aggregate(F.slice("equal", i, seeds.window), F.lit(0), lambda a, b: a + b)))
    rows = aligned.select("doc_id", "item_id", best.alias("best")).filter(F.col("best") >= seeds.min_equal)
    return rows.groupBy("doc_id", "item_id").agg(F.max("best").cast("long").alias("equal_words")).withColumn(
        "similarity", F.col("equal_words") / F.lit(float(seeds.window)))


def overlaps(docs: DataFrame, benchmark: DataFrame, seeds: Seeds = Seeds()) -> DataFrame:  # noqa: B008 - frozen
    """One row per document and item that overlap: the equal words of the best window, and its share of the window."""
    texts = docs.select(F.col("doc_id").cast("long").alias("key"), word_hashes(F.col("text")).alias("words"))
    items = benchmark.select(F.col("item_id").alias("key"), word_hashes(F.col("text")).alias("words"))
    size = F.size("words")
    short = items.filter((size > 0) & (size < seeds.window)).select(size.alias("n")).distinct().collect()  # fewer rows than window
    whole = [_overlaps(texts, items.filter(size == n), seeds.whole(n)) for n in sorted(row["n"] for row in short)]
    return union([_overlaps(texts, items, seeds), *whole])

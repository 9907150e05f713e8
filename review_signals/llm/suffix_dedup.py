"""Removal of every byte that a repeated string of ``length`` bytes covers, by sorting suffixes where repeats can be.

1. Equal texts are one class; all bytes of a class with copies go, if it is long enough.
2. Every window of ``length`` bytes picks the ``gram``-byte string with the smallest hash inside it as its anchor. Equal
   windows pick it at the same place, so a repeated window has an anchor that occurs at least twice; all other text is
   out. Windows in a row mostly share an anchor.
3. Texts around the repeated anchors meet by anchor. There the suffixes at the windows' starts are sorted by
   deep-shallow sorting (``deep_shallow.py``); neighbours that are equal on ``length`` bytes are repeats.
4. An anchor with more than ``hot`` occurrences is spread over several sorts. What such a sort leaves single meets once
   more, by anchor and hash of the window: there every group is one string and is counted with map-side combine.

Anchors carry 64-bit hashes, which only choose what is compared; windows are compared byte by byte, except in step 4,
which takes equal anchors and equal 64-bit hashes for equal. Texts are told apart by 64-bit hashes.

Defined cases: a null text counts as empty and loses nothing; texts shorter than ``length`` lose nothing. Every row is a
document: repeated rows are copies of each other. A null doc_id is kept. Empty tables stay empty. Columns other than
id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_signals.llm.deep_shallow import equal_suffixes
from review_signals.llm.shared import bounded, staged
from review_signals.llm.text_arrays import Texts, as_texts, chunks

_SORTED_BYTES = 1 << 20


@dataclass(frozen=True)
class Repeats:
    length: int = 200
    gram: int = 40
    hot: int = 256
    shallow: int = 16
    max_broadcast: int = 200_000

    def __post_init__(self) -> None:
        if not 8 <= self.gram < self.length <= 255 + self.gram:
            raise ValueError("the anchor must be shorter than the repeat, by 255 bytes at most")


def pick_anchors(texts: Texts, repeats: Repeats) -> tuple[np.ndarray, ...]:
    """Owner, first window, number of windows and hash of each anchor, and the way from its first window to it."""
    size, width = len(texts.data), repeats.length - repeats.gram + 1
    places = size - repeats.gram + 1
    nothing = np.zeros(0, np.int64)
    if size < repeats.length:
        return nothing, nothing, nothing, nothing.astype(np.uint64), nothing
    at = np.arange(places)
    hashes = texts.hashes(at, at + repeats.gram)
    # order by hash, then by place: both are settled by what the window holds
    low = np.uint64((1 << int(size).bit_length()) - 1)
    ranks = (hashes & ~low) | at.astype(np.uint64)
    rows = -(-places // width)
    padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:places] = ranks
    blocks = padded.reshape(rows, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    windows = size - repeats.length + 1
    best = (np.minimum(backward[:windows], forward[width - 1:width - 1 + windows]) & low).astype(np.int64)
    owner = texts.owner(np.arange(windows))
    inside = np.arange(windows) + repeats.length <= texts.offsets[owner + 1]
    starts = np.flatnonzero(inside)
    if not len(starts):
        return nothing, nothing, nothing, nothing.astype(np.uint64), nothing
    best, owner = best[starts], owner[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (best[1:] != best[:-1]) | (owner[1:] != owner[:-1])
    begins = np.flatnonzero(new)
    lengths = np.diff(np.append(begins, len(starts)))
    return owner[begins], starts[begins] - texts.offsets[owner[begins]], lengths, hashes[best[begins]], (best - starts)[begins]


def anchors(docs: DataFrame, repeats: Repeats) -> DataFrame:
    """A row per anchor and text: its hash, and ``place``, which packs the first window, their number and the way from
    the first window to the anchor."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, "text"):
            owner, first, count, hashes, back = pick_anchors(texts, repeats)
            place = (first << 16) | (count << 8) | back
            yield pa.RecordBatch.from_arrays([
                part.column("node").take(pa.array(owner)), pa.array(hashes.astype(np.int64)), pa.array(place.astype(np.int64)),
            ], names=["node", "anchor", "place"])

    return docs.select("node", "text").mapInArrow(task, "node long, anchor long, place long")


_FOUND = "node long, first long, last long, anchor long, window long"


def sort_contexts(contexts: DataFrame, repeats: Repeats) -> DataFrame:
    """Sorts the suffixes around anchors that met. Rows with ``first`` and ``last`` and no window hash are runs of
    repeated windows; rows with a window hash are what a part of a hot anchor can't settle alone: a single window with
    its place, or one of several equal ones without."""

    def settle(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        batch = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
        texts = as_texts(batch.column("context"))
        anchor, part, hot, node, place = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "part", "hot", "node", "place"))
        first, count, back = place >> 16, (place >> 8) & 255, place & 255
        row = np.repeat(np.arange(len(count)), count)
        step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        starts = texts.offsets[row] + step
        met = np.zeros(len(anchor), np.int64)
        met[1:] = np.cumsum((anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1]))
        leader = equal_suffixes(texts.data, starts, met[row] * 256 + (back[row] - step), repeats.length, repeats.shallow)
        members = np.bincount(leader, minlength=len(leader))
        again = members[leader] > 1
        # runs of repeated windows, row by row
        marked = np.flatnonzero(again)
        breaks = np.ones(len(marked), bool)
        breaks[1:] = (np.diff(marked) > 1) | (row[marked][1:] != row[marked][:-1])
        begin = marked[breaks]
        end = marked[np.append(np.flatnonzero(breaks)[1:], len(marked)) - 1] if len(marked) else marked
        is_hot = hot[row]
        single = np.flatnonzero(is_hot & ~again)
        one_of = np.flatnonzero(is_hot & (members > 1))
        asked = np.concatenate([single, one_of])
        window = texts.hashes(starts[asked], starts[asked] + repeats.length).astype(np.int64)
        known = np.zeros(len(begin) + len(asked), bool)
        known[: len(begin) + len(single)] = True
        which = np.concatenate([begin, asked])
        return pa.RecordBatch.from_arrays([
            pa.array(node[row[which]]), pa.array(first[row[which]] + step[which], mask=~known),
            pa.array(np.concatenate([first[row[end]] + step[end], first[row[asked]] + step[asked]]), mask=~known),
            pa.array(anchor[row[which]]),
            pa.array(np.concatenate([np.zeros(len(begin), np.int64), window]), mask=np.arange(len(which)) < len(begin)),
        ], names=["node", "first", "last", "anchor", "window"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for low in range(0, batch.num_rows, 1000):
                piece = batch.slice(low, 1000)
                if size > _SORTED_BYTES:  # only whole groups may go: cut before the last group seen
                    table = pa.Table.from_batches([*held, piece]).combine_chunks().to_batches()[0]
                    anchor, part = (table.column(c).to_numpy(zero_copy_only=False) for c in ("anchor", "part"))
                    others = np.flatnonzero((anchor != anchor[-1]) | (part != part[-1]))
                    bound = int(others[-1]) + 1 if len(others) else 0
                    if bound:
                        yield settle([table.slice(0, bound)])
                    held, size = [table.slice(bound)], 0
                else:
                    held.append(piece)
                size += sum(len(value.as_buffer()) for value in piece.column("context"))
        if held and sum(piece.num_rows for piece in held):
            yield settle(held)

    dealt = contexts.repartition("anchor", "part").sortWithinPartitions("anchor", "part")
    return dealt.select("anchor", "part", "hot", "node", "place", "context").mapInArrow(task, _FOUND)


def repeated_windows(docs: DataFrame, repeats: Repeats) -> DataFrame:
    """``node``, ``first`` and ``last``: runs of windows that occur elsewhere, too; ``docs`` has node and text (binary)."""
    picked = staged(anchors(docs, repeats), "anchors")
    often = staged(picked.groupBy("anchor").count().filter("count > 1"), "repeated-anchors")
    kept = picked.join(often, "anchor")
    parts = F.ceil(F.col("count") / repeats.hot)
    kept = kept.select(
        "node", F.struct("anchor", "place", (F.col("count") > repeats.hot).alias("hot"),
                         F.pmod(F.xxhash64("node", "place"), parts).alias("part")).alias("found"))
    wanted = staged(kept.groupBy("node").agg(F.collect_list("found").alias("found")), "wanted-contexts")
    rows = docs.join(wanted, "node").select("node", "text", F.explode("found").alias("f")).select(
        "node", "f.*", F.expr(f"substring(text, int((f.place >> 16) + 1), int(((f.place >> 8) & 255) + {repeats.length - 1}))").alias("context"))
    found = staged(sort_contexts(rows, repeats), "sorted-contexts")
    asked = found.filter(F.col("window").isNotNull())
    again = staged(asked.groupBy("anchor", "window").count().filter("count > 1").select("anchor", "window"), "hot-windows")
    late = asked.filter(F.col("first").isNotNull()).join(again, ["anchor", "window"]).select("node", "first", "last")
    return found.filter(F.col("window").isNull()).select("node", "first", "last").unionByName(late)


def merged(first: np.ndarray, last: np.ndarray, length: int) -> np.ndarray:
    """Runs of windows as disjoint byte ranges, in order, one row of begin and end each."""
    order = np.argsort(first, kind="stable")
    begins, reach = first[order], np.maximum.accumulate(last[order] + length)
    new = np.ones(len(begins), bool)
    new[1:] = begins[1:] > reach[:-1]
    starts = np.flatnonzero(new)
    return np.column_stack([begins[starts], reach[np.append(starts[1:], len(begins)) - 1]])


def ranges(windows: DataFrame, repeats: Repeats) -> DataFrame:
    """Per text its removed byte ranges, merged, as pairs of 64-bit numbers in ``spans``."""
    gathered = windows.groupBy("node").agg(F.collect_list("first").alias("first"), F.collect_list("last").alias("last"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [
                merged(first.values.to_numpy(), last.values.to_numpy(), repeats.length).astype("<i8").tobytes()
                for first, last in zip(batch.column("first"), batch.column("last"), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(held, pa.binary())], names=["node", "spans"])

    return gathered.mapInArrow(task, "node long, spans binary")


def deduplicate(docs: DataFrame, repeats: Repeats = Repeats()) -> DataFrame:  # noqa: B008 - frozen
    """Per row its doc_id, ``n_bytes``, ``n_removed``, ``n_spans`` (removed runs) and ``kept``, the other bytes."""
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw.alias("text")).withColumn("node", F.xxhash64("text"))
    long_enough = F.octet_length("text") >= repeats.length
    copies = staged(rows.filter(long_enough).groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("kept_id")).filter(
        "n > 1").select("node", "kept_id"), "copied-texts")
    copies = bounded(copies.withColumn("copied", F.lit(True)), repeats.max_broadcast)
    marked = rows.filter(long_enough).join(copies, "node", "left")
    # one row of each class, whether its ids differ, repeat or are null
    same_id = F.col("copied") & F.col("doc_id").eqNullSafe(F.col("kept_id"))
    once = staged(marked.filter(same_id).select("node", "text").dropDuplicates(["node"]), "copied-once")
    classes = marked.filter(F.col("copied").isNull()).select("node", "text").unionByName(once)
    spans = staged(ranges(repeated_windows(classes, repeats), repeats), "repeated-spans")
    joined = rows.join(bounded(spans, repeats.max_broadcast, sized="spans"), "node", "left").join(
        copies.select("node", "copied"), "node", "left")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, "text"):
            out: list[tuple] = []
            for raw_text, held, copied in zip(texts.slices(), part.column("spans").to_pylist(), part.column("copied").to_pylist(), strict=True):
                gone = np.array([[0, len(raw_text)]]) if copied else np.frombuffer(held or b"", "<i8").reshape(-1, 2)
                begins, ends = [*gone[:, 0].tolist(), len(raw_text)], [0, *gone[:, 1].tolist()]
                kept = b"".join(raw_text[end:begin] for end, begin in zip(ends, begins, strict=True))
                out.append((len(raw_text), len(raw_text) - len(kept), len(gone), kept))
            columns = list(zip(*out, strict=True)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(column, pa.int64()) for column in columns[:3]), pa.array(columns[3], pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.select("doc_id", "text", "spans", "copied").mapInArrow(
        task, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


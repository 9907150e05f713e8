"""Removal of line passages that repeat anywhere in the corpus.

Every three consecutive lines that hold a word form a window. Windows that occur more than once are found by one
aggregation of their hashes, which also names the first occurrence, in the order of doc_id and line. Every later
occurrence is removed: its three lines are covered, and covered lines of overlapping windows merge into runs. Lines
without a word stay, and so does the first place in the corpus of any line's content.

A hot window is counted with map-side combine; the join that brings the first occurrences back has plain exchanges on
both sides, so that adaptive execution splits its hot partitions.

Defined cases: null texts stay null. Texts of fewer than three lines with a word stay. Repeated rows of one doc_id and
text are one document: none of them is the later copy of another. A null doc_id sorts first. Rows of one doc_id with
different texts are told apart by a hash of the text. Empty tables stay empty. All columns of the input are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from review_signals.llm.shared import dropped, staged
from review_signals.llm.text_arrays import chunks, roll, tidy

WINDOW = 3
_KEY = ("__doc", "__key")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("__doc"), F.xxhash64("text").alias("__key"), F.col("text").alias("__text"))


def windows(docs: DataFrame) -> DataFrame:
    """A row per window: its document, its first line (counted over lines with a word) and its hash."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, "__text"):
            starts, ends = texts.lines
            owner = texts.owner(starts)
            number = np.arange(len(owner)) - np.searchsorted(owner, owner)
            valid = np.flatnonzero(owner[: max(0, len(owner) - WINDOW + 1)] == owner[WINDOW - 1:])
            yield pa.RecordBatch.from_arrays([
                *(part.column(name).take(pa.array(owner[valid])) for name in _KEY),
                pa.array(number[valid].astype(np.int32)),
                pa.array(roll(texts.hashes(starts, ends), WINDOW)[valid].astype(np.int64)),
            ], names=[*_KEY, "line", "window"])

    return _keyed(docs).filter(F.col("__text").isNotNull()).mapInArrow(task, "__doc long, __key long, line int, window long")


def later_windows(found: DataFrame) -> DataFrame:
    """Per document the first lines of its windows that occurred before, in order."""
    place = F.struct(*_KEY, "line")
    repeats = found.groupBy("window").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first <> last")
    repeats = staged(repeats.select("window", "first"), "repeated-windows")
    later = found.join(repeats.hint("shuffle_merge"), "window").filter(~place.eqNullSafe(F.col("first")))
    later = staged(later.groupBy(*_KEY).agg(F.sort_array(F.collect_set("line")).alias("__later")), "later-windows")
    dropped(repeats)
    return later


def covered_lines(first_lines: list[int] | None) -> list[int]:
    return sorted({line + step for line in first_lines or () for step in range(WINDOW)})


def cut_lines(text: str, covered: list[int]) -> str:
    """The text without the covered lines, which are counted over lines with a word."""
    gone, number, kept = set(covered), 0, []
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            if number not in gone:
                kept.append(line)
            number += 1
        else:
            kept.append(line)
    return "\n".join(kept)


def deduplicate(docs: DataFrame) -> DataFrame:
    """The documents with ``text`` cut; beside their columns ``n_lines`` (lines with a word), ``n_removed`` of them and
    ``n_spans`` (maximal removed runs)."""
    found = staged(windows(docs), "line-windows")
    later = later_windows(found)
    dropped(found)
    own = [name for name in docs.columns if name not in ("n_lines", "n_removed", "n_spans")]
    keyed = docs.select(*own, F.col("doc_id").cast("long").alias("__id"), F.xxhash64("text").alias("__hash"))
    same = F.col("__id").eqNullSafe(F.col("__doc")) & (F.col("__hash") == F.col("__key"))
    # texts move once, in the same way at every size
    joined = keyed.join(later.hint("shuffle_merge"), same, "left").select(*own, "__later")
    schema = docs.select(*own).schema.add("n_lines", "long").add("n_removed", "long").add("n_spans", "long")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, "text"):
            lines = np.bincount(texts.owner(texts.lines[0]), minlength=len(texts)).astype(np.int64)
            removed, spans = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            new = part.column("text")
            touched = np.flatnonzero(part.column("__later").is_valid().to_numpy(zero_copy_only=False)).tolist()
            if touched:
                cut = new.to_pylist()
                for i in touched:
                    covered = covered_lines(part.column("__later")[i].as_py())
                    cut[i] = cut_lines(cut[i], covered)
                    removed[i] = len(covered)
                    spans[i] = 1 + int((np.diff(np.array(covered)) > 1).sum())
                new = pa.array(cut, new.type)
            columns = [new if name == "text" else part.column(name) for name in own]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(lines), pa.array(removed), pa.array(spans)], names=[*own, "n_lines", "n_removed", "n_spans"]
            )

    return joined.mapInArrow(tidy(task), schema)

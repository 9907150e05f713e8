"""Document lengths in flat token files that have no index: find the end-of-document ids.

A file is a run of blocks of token ids. Every block is searched on its own, with one vectorised comparison; it yields
the documents that end in it and a small summary. Where a document began is a question to the blocks before: the last
separator before a block is a running maximum over the summaries, the number of documents before it a running sum.
The scan is done in two levels, inside segments of ``SEGMENT`` blocks and over segments, so no task gets all blocks
of a large file.

Defined cases: an empty block has no tokens. Null ids count as empty. What follows the last separator of a file is an
open document (``closed`` false), left out if it has no tokens. Adjacent separators are documents of one token, the
separator. A repeated block (same file and number) is an error of the caller: blocks are told apart by number only.
An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from review_signals.llm.shared import staged
from review_signals.llm.text_arrays import chunks
from review_signals.llm.tokens import END_OF_TEXT, TOKENISED_BYTES, encoder

BLOCK_TOKENS = 1 << 16
SEGMENT = 1024
TOKEN_TYPE = "<u2"

BLOCKS = "file_id long, block long, ids binary"
_FOUND = "file_id long, block long, n_tokens long, n_ends long, last_end long, ends array<long>"


def read_token_files(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of all flat files under a path, each below 2 GB. The file id is a hash of its path."""
    width = block_tokens * np.dtype(TOKEN_TYPE).itemsize
    starts = F.sequence(F.lit(0), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(width))
    files = spark.read.format("binaryFile").load(path).select(F.xxhash64("path").alias("file_id"), "content", starts.alias("at"))
    rows = files.select("file_id", "content", F.posexplode("at").alias("block", "start"))
    return rows.select("file_id", F.col("block").cast("long").alias("block"), F.expr(f"substring(content, int(start) + 1, {width})").alias("ids"))


def find_ends(blocks: DataFrame, end_id: int = END_OF_TEXT) -> DataFrame:
    """Per block its tokens, its separators, where the last one is (null without any) and where all are."""

    def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            ids = [np.frombuffer(held or b"", TOKEN_TYPE) for held in frame["ids"]]
            ends = [np.flatnonzero(block == end_id) for block in ids]
            yield pd.DataFrame({
                "file_id": frame["file_id"], "block": frame["block"],
                "n_tokens": [len(block) for block in ids], "n_ends": [len(found) for found in ends],
                "last_end": pd.array([found[-1] if len(found) else None for found in ends], "Int64"),
                "ends": ends,
            })

    return blocks.select("file_id", "block", "ids").mapInPandas(task, _FOUND)


def stitch(found: DataFrame) -> DataFrame:
    """Per block, what the blocks before it in its file leave: tokens, documents and the last separator's position."""
    found = found.withColumn("segment", F.floor(F.col("block") / SEGMENT))
    before = Window.partitionBy("file_id", "segment").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inner = found.select(
        "*",
        F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("inner_tokens"),
        F.coalesce(F.sum("n_ends").over(before), F.lit(0)).alias("inner_ends"),
    ).withColumn("inner_last", F.col("inner_tokens") + F.col("last_end"))
    inner = inner.withColumn("inner_open", F.max("inner_last").over(before))
    totals = inner.groupBy("file_id", "segment").agg(
        F.sum("n_tokens").alias("seg_tokens"), F.sum("n_ends").alias("seg_ends"), F.max("inner_last").alias("seg_last"),
    )
    earlier = Window.partitionBy("file_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        "file_id", "segment", "seg_last",
        F.coalesce(F.sum("seg_tokens").over(earlier), F.lit(0)).alias("base_tokens"),
        F.coalesce(F.sum("seg_ends").over(earlier), F.lit(0)).alias("base_ends"),
    ).withColumn("base_open", F.max(F.col("base_tokens") + F.col("seg_last")).over(earlier)).drop("seg_last")
    joined = inner.join(bases, ["file_id", "segment"])
    return joined.select(
        "file_id", "block", "n_tokens", "ends",
        (F.col("base_tokens") + F.col("inner_tokens")).alias("first_token"),
        (F.col("base_ends") + F.col("inner_ends")).alias("first_doc"),
        F.coalesce(F.col("base_tokens") + F.col("inner_open"), F.col("base_open"), F.lit(-1)).alias("open_after"),
    )


def count_tokens(blocks: DataFrame, end_id: int = END_OF_TEXT) -> DataFrame:
    """One row per document: its file, its number there, its first token, its tokens with the separator, and whether
    it is closed."""
    scanned = staged(find_ends(blocks, end_id), "token-ends")
    placed = staged(stitch(scanned), "token-blocks")
    closed = placed.select("file_id", "first_token", "first_doc", "open_after", F.posexplode("ends").alias("i", "at"), "ends").select(
        "file_id",
        (F.col("first_doc") + F.col("i")).alias("doc_number"),
        F.when(F.col("i") == 0, F.col("open_after") + 1)
        .otherwise(F.col("first_token") + F.try_element_at("ends", F.col("i")) + 1).alias("start"),
        (F.col("first_token") + F.col("at")).alias("end"),
    ).select("file_id", "doc_number", "start", (F.col("end") - F.col("start") + 1).alias("n_tokens"), F.lit(True).alias("closed"))
    last = F.when(F.size("ends") > 0, F.col("first_token") + F.element_at("ends", -1)).otherwise(F.col("open_after"))
    files = placed.withColumn("last", last).groupBy("file_id").agg(
        F.max("last").alias("last"), F.sum("n_tokens").alias("total"), F.max(F.col("first_doc") + F.size("ends")).alias("docs"),
    )
    rest = files.filter("total - 1 > last").select(
        "file_id", F.col("docs").alias("doc_number"), (F.col("last") + 1).alias("start"),
        (F.col("total") - F.col("last") - 1).alias("n_tokens"), F.lit(False).alias("closed"),
    )
    return closed.unionByName(rest)


def write_flat(docs: DataFrame, tokenizer_path: str, block_tokens: int = BLOCK_TOKENS, end_id: int = END_OF_TEXT) -> DataFrame:
    """Tokenise documents into flat streams, one per task, cut into blocks without regard to documents.

    Rows with ``ids`` are blocks; rows with a ``doc_number`` only say which document stands where.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file_id, block, number = TaskContext.get().partitionId(), 0, 0
        words, end = encoder(tokenizer_path), np.array([end_id], np.uint32)
        pending: list[np.ndarray] = []

        def cut(everything: bool) -> list[bytes]:
            stream = np.concatenate(pending) if pending else np.zeros(0, TOKEN_TYPE)
            bound = len(stream) if everything else len(stream) - len(stream) % block_tokens
            pending[:] = [stream[bound:]]
            return [stream[low:min(low + block_tokens, bound)].tobytes() for low in range(0, bound, block_tokens)]

        def rows(held: list[bytes], ids: pa.Array) -> pa.RecordBatch:
            n, m = len(held), len(ids)
            return pa.RecordBatch.from_arrays([
                pa.array([file_id] * (n + m), pa.int64()),
                pa.array([*range(block, block + n), *[None] * m], pa.int64()),
                pa.array([*held, *[None] * m], pa.binary()),
                pa.array([*[None] * n, *range(number, number + m)], pa.int64()),
                pa.concat_arrays([pa.nulls(n, pa.int64()), ids]),
            ], names=["file_id", "block", "ids", "doc_number", "doc_id"])

        for part, texts in chunks(batches, "text", TOKENISED_BYTES):
            for ids in words.encode(texts):
                pending.append(np.concatenate([ids, end]).astype(TOKEN_TYPE))
            held = cut(everything=False)
            yield rows(held, part.column("doc_id"))
            block, number = block + len(held), number + part.num_rows
        yield rows(cut(everything=True), pa.nulls(0, pa.int64()))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        task, f"{BLOCKS}, doc_number long, doc_id long")


def count_documents(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Tokens of every document, counted from the flat streams that hold them all (end id included)."""
    flat = staged(write_flat(docs, tokenizer_path), "flat-tokens")
    counted = count_tokens(flat.filter(F.col("ids").isNotNull()).select("file_id", "block", "ids"))
    names = flat.filter(F.col("doc_number").isNotNull()).select("file_id", "doc_number", "doc_id")
    return names.join(counted, ["file_id", "doc_number"]).select("doc_id", "file_id", "doc_number", "start", "n_tokens")

"""A corpus from raw documents to packed sequences, in stages that are each written and read again.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept. All but the last return the
columns of ``documents``. Rows are told apart by doc_id and a hash of the text, so repeated ids do no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from review_signals.llm import jaccard_join, line_windows, risk_thresholds, spaced_seeds, vector_packing
from review_signals.llm.shared import bounded, staged
from review_signals.llm.tokens import vocabulary

#: Rejected rows are looked up by broadcast up to this many, else by a shuffled join.
MAX_BROADCAST_IDS = 1_000_000

#: Near copies share at least 0.8 of their shingles of five words; other settings than those of op10's query.
NEAR_COPIES = jaccard_join.Join(percent=80, words=5)

#: A document leaks an item if that many of its words are found: shorter items are phrases that clean documents hold by chance.
LEAK_WORDS = 8

#: The packing has no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def _without(docs: DataFrame, rejected: DataFrame, name: str) -> DataFrame:
    """The documents that aren't among ``rejected`` (doc_id, text_key)."""
    ids = bounded(staged(rejected.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct(), name), MAX_BROADCAST_IDS)
    return docs.join(ids, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__key")), "left_anti")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a risk-controlled setting rejects go. Texts count as in the operator: a null one has
    no words, so it goes; repeated rows are judged alike; a long text is measured whole."""
    return risk_thresholds.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows go; a document of which nothing is left goes, too."""
    rows = line_windows.deduplicate(docs).filter((F.col("n_lines") == 0) | (F.col("n_removed") < F.col("n_lines")))
    return rows.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def jaccard_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest doc_id stays, whether ids repeat or are null."""
    found = jaccard_join.rooted_rows(docs, NEAR_COPIES)
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    groups = found.filter("n > 0").groupBy("root").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    groups = staged(groups.filter("first <> last").select("root", "first"), "similar-groups")
    others = found.filter("n > 0").join(groups, "root").filter(
        ~F.col("doc_id").eqNullSafe(F.col("first.doc_id")) | (F.col("text_key") != F.col("first.text_key")))
    once = _without(docs, others, "similar-to-others")
    # rows that repeat an id and its text: only these few are shuffled
    repeats = staged(found.groupBy("doc_id", "text_key").count().filter("count > 1"), "repeated-rows")
    if repeats.isEmpty():
        return once
    wanted = bounded(repeats.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")), MAX_BROADCAST_IDS)
    repeated = once.join(wanted, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__key")), "left_semi")
    return _without(once, repeats, "repeated-ids").unionByName(repeated.dropDuplicates(["doc_id", "text"]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go, or with a whole item of at least ``LEAK_WORDS`` words. Repeated rows and null
    ids are judged by their text, a long text is searched whole, a null or empty one stays."""
    row = F.xxhash64("doc_id", "text")
    leaks = spaced_seeds.overlaps(docs.withColumn("doc_id", row), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    leaks = leaks.filter(F.col("equal_words") >= LEAK_WORDS)
    leaks = bounded(staged(leaks.select(F.col("doc_id").alias("__row")).distinct(), "leaks"), MAX_BROADCAST_IDS)
    return docs.join(leaks, row == F.col("__row"), "left_anti")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return vector_packing.pack(docs, vocabulary())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("jaccard_dedup", jaccard_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs

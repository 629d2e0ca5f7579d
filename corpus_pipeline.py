"""A training corpus in five stages: quality, repeated lines, near copies, benchmark passages, packing.

Each stage takes and returns the columns of ``documents`` (the last one the packed pieces), works on every row
of its predecessor, and is written before the next one reads it. ``n_chars`` follows the text. Rows
with a null id are scored, cut, checked and packed like others, but never counted as near copies; of repeated
rows with one id the near-copy stage leaves one, the one whose hash is smallest. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.llm import (
    arrays,
    decontamination,
    line_dedup,
    near_dedup,
    packing,
    quality_classifier,
    queries,
)
from reviewmill.session import materialise

LEAST_SCORE = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves documents that the classifier accepts."""
    model = quality_classifier.fit(docs, queries.table(spark, sf_dir, "labels"), "quality")
    return docs.where(quality_classifier.score_column(docs, model) >= LEAST_SCORE)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts lines that an earlier document holds."""
    made = arrays.fresh(docs.columns, "line_dedup")
    cut = line_dedup.deduplicated(docs, made=made).withColumn("text", F.col(f"{made}.kept"))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves one document of each group of near copies, the one with the smallest id."""
    row_key = arrays.fresh(docs.columns, "row_key")
    named = docs.where("doc_id IS NOT NULL").withColumn(row_key, F.xxhash64(*docs.columns))
    # Of several rows with one id always the same one.
    rows = named.groupBy("doc_id").agg(F.min(row_key).alias(row_key))
    kept = near_dedup.components(docs).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    one_each = named.join(kept.join(rows, "doc_id"), ["doc_id", row_key], "left_semi")
    one_each = one_each.dropDuplicates(["doc_id", row_key]).select(*docs.columns)
    return one_each.unionByName(docs.where("doc_id IS NULL").select(*docs.columns))


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves documents without a benchmark passage."""
    return decontamination.clean(docs, queries.table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents, in sequences."""
    return packing.packed(docs, *queries.tokenizer())


STAGES = [
    ("quality classifier", quality),
    ("line dedup", lines),
    ("near-dedup", near_copies),
    ("decontamination", benchmark),
    ("packing", pack),
]

# A learned classifier, MinHash and a tokenizer are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

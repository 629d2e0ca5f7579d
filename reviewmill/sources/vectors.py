"""Vector files: ``#id,idx:count,...`` (sparse) and ``#id,v1,v2,...`` (dense); word-vector tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_HEAD = r"^#(-?\d+),"


def _identified(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(
        F.regexp_extract("value", _HEAD, 1).cast("bigint").alias("doc_id"),
        F.regexp_replace("value", _HEAD, "").alias("body"),
    )


def count_lines(counts: DataFrame, documents: DataFrame) -> DataFrame:
    """One line per document; entries in index order, none for a document without terms."""
    # At most one entry per distinct term of the document.
    entries = counts.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("idx", "tf"))).alias("entries")
    )
    return _lines(entries, documents)


def list_lines(counted: DataFrame, documents: DataFrame) -> DataFrame:
    """``count_lines`` of documents as lists of ascending indexes, ``(doc_id, values, tfs)``; no entry is shuffled alone."""
    entries = F.arrays_zip(F.col("values").alias("idx"), F.col("tfs").alias("tf"))
    return _lines(counted.select("doc_id", entries.alias("entries")), documents)


def _lines(entries: DataFrame, documents: DataFrame) -> DataFrame:
    body = F.array_join(
        F.transform("entries", lambda e: F.concat_ws(":", e["idx"], e["tf"])), ","
    )
    line = F.concat(F.lit("#"), F.col("doc_id"), F.lit(","), F.coalesce(body, F.lit("")))
    return documents.select("doc_id").join(entries, "doc_id", "left").select(
        "doc_id", line.alias("line")
    )


def dense_lines(vectors: DataFrame, column: str = "vector") -> DataFrame:
    """One line per document with six decimals per value."""

    def six_places(value):
        text = F.format_string("%.6f", value)
        return F.when(text == "-0.000000", F.lit("0.000000")).otherwise(text)

    body = F.array_join(F.transform(column, six_places), ",")
    return vectors.select("doc_id", F.concat(F.lit("#"), "doc_id", F.lit(","), body).alias("line"))


def write_lines(lines: DataFrame, path: str) -> None:
    lines.select(F.col("line").alias("value")).write.text(path)


def read_lines(spark: SparkSession, path: str, name: str) -> DataFrame:
    """``(doc_id, <name>)``: the lines as they stand, by the key at their start."""
    return spark.read.text(path).select(
        F.regexp_extract("value", _HEAD, 1).cast("bigint").alias("doc_id"), F.col("value").alias(name)
    )


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """Long form ``(doc_id, idx, tf)``; a document without entries gives no row."""
    entries = _identified(spark, path).where("body != ''").select(
        "doc_id", F.explode(F.split("body", ",")).alias("entry")
    )
    pair = F.split("entry", ":")
    return entries.select(
        "doc_id", pair[0].cast("bigint").alias("idx"), pair[1].cast("bigint").alias("tf")
    )


def read_dense(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, vector)``; lines of differing width are an error."""
    vectors = _identified(spark, path).select(
        "doc_id", F.split("body", ",").cast("array<double>").alias("vector")
    )
    return one_width(vectors)


def width(vectors: DataFrame, column: str = "vector") -> int:
    """The width all vectors share; an error if they do not."""
    size = F.size(column)
    row = vectors.agg(F.min(size).alias("low"), F.max(size).alias("high")).first()
    if row["low"] != row["high"]:
        raise ValueError(f"vectors of width {row['low']} to {row['high']} in one table")
    return row["low"] or 0


def one_width(vectors: DataFrame, column: str = "vector") -> DataFrame:
    width(vectors, column)
    return vectors


def read_word_vectors(spark: SparkSession, path: str) -> DataFrame:
    """A pretrained table ``(term, vector)`` in parquet, all vectors of one width."""
    return one_width(spark.read.parquet(path).select("term", "vector"))

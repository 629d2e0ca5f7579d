"""Vocabulary and vector files against their contract: good lines, and a table of what is wrong with the others.

Problems are ``(file, reason, line)``. Nothing is dropped in silence: each line is good or has a reason, and
what is missing altogether is a problem without a file.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.session import materialise

_TERM = r"^(.+):(\d+)$"
_HEADED = r"^#(-?\d+),(.*)$"
_ENTRY = r"^\d+:[1-9]\d*$"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.text(path)
    return text.select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("line"))


def _problem(rows: DataFrame, reason: str, line="line", file=None) -> DataFrame:
    of = F.col("file") if file is None else file
    return rows.select(of.alias("file"), F.lit(reason).alias("reason"), F.col(line).cast("string").alias("line"))


def _all(problems: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, problems)


def vocabulary_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, line, term, idx)``; term and index are null where a line is not ``term:index``."""
    lines = _lines(spark, path)
    good = F.col("line").rlike(_TERM)
    return lines.select(
        "*",
        F.when(good, F.regexp_extract("line", _TERM, 1)).alias("term"),
        F.when(good, F.try_to_number(F.regexp_extract("line", _TERM, 2), F.lit("999999999999999999"))).cast("bigint").alias("idx"),
    )


def vocabulary_problems(spark: SparkSession, path: str) -> DataFrame:
    """What is wrong with a vocabulary file of ``term:index`` lines.

    ``malformed`` lines; all lines of a ``repeated index`` or ``repeated term``; ``out of order``, a term that does not
    come after the one of the index before; ``missing index``, the indexes from 0 on that no line has.
    """
    lines = vocabulary_lines(spark, path)
    good = lines.where("idx IS NOT NULL")

    def repeated(column: str) -> DataFrame:
        often = good.groupBy(column).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(column)
        return _problem(good.join(often, column), f"repeated {column}")

    before = good.select((F.col("idx") + 1).alias("idx"), F.col("term").alias("_before")).groupBy("idx").agg(F.max("_before").alias("_before"))
    unordered = good.join(before, "idx").where("term <= _before")
    top = good.agg(F.coalesce(F.max("idx") + 1, F.lit(0)).alias("n")).first()["n"]
    missing = spark.range(top).withColumnRenamed("id", "idx").join(good.select("idx"), "idx", "left_anti")
    return _all(
        [
            _problem(lines.where("idx IS NULL"), "malformed"),
            repeated("idx").withColumn("reason", F.lit("repeated index")),
            repeated("term"),
            _problem(unordered, "out of order"),
            _problem(missing, "missing index", "idx", F.lit(None).cast("string")),
        ]
    )


def _order(width: int):
    """Of a line's indexes: whether one is not above its neighbour before, and whether one is no index of the vocabulary."""

    def of(idx):
        after = F.slice(idx, F.lit(2), F.greatest(F.size(idx), F.lit(1)))
        falls = F.exists(F.zip_with(after, F.slice(idx, F.lit(1), F.greatest(F.size(idx) - 1, F.lit(0))), lambda b, a: b <= a), lambda x: x)
        return F.struct(falls.alias("falls"), (F.array_max(idx) >= width).alias("too_large"))

    return of


def count_vector_problems(spark: SparkSession, path: str, documents: DataFrame, width: int) -> DataFrame:
    """What is wrong with a file of ``#id,idx:count,...`` lines, given the documents and the vocabulary's size.

    ``malformed`` lines; of the others ``unordered indexes`` (equal neighbours included), ``index too large``,
    ``repeated document`` (all its lines), ``unknown document``; and each ``missing document``, by its id.
    """
    # Entry by entry: one pattern for a whole line would nest as deep as the line has entries. The arrays are bound
    # once per line, as an expression inside a lambda is computed for every element.
    body = F.regexp_extract("line", _HEADED, 2)
    entries = F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, ","))

    def verdict(e):
        first = F.transform(e, lambda x: F.substring_index(x, ":", 1).cast("bigint"))
        return F.when(F.forall(e, lambda x: x.rlike(_ENTRY)), F.get(F.transform(F.array(first), _order(width)), F.lit(0)))

    of_line = F.get(F.transform(F.array(entries), verdict), F.lit(0))
    read = _lines(spark, path).select(
        "file", "line",
        F.when(F.col("line").rlike(_HEADED), of_line).alias("_verdict"),
        F.regexp_extract("line", _HEADED, 1).alias("_id"),
    )
    # Written, as every kind of problem reads it.
    read = materialise(
        read.select("file", "line", "_verdict.*", F.col("_verdict").isNotNull().alias("_good"), "_id"), "read-lines"
    )
    good = read.where("_good").withColumn("doc_id", F.col("_id").cast("bigint"))
    often = good.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    known = documents.select("doc_id").distinct()
    return _all(
        [
            _problem(read.where("NOT _good"), "malformed"),
            _problem(good.where("falls"), "unordered indexes"),
            _problem(good.where("too_large"), "index too large"),
            _problem(good.join(often, "doc_id"), "repeated document"),
            _problem(good.join(known, "doc_id", "left_anti"), "unknown document"),
            _problem(known.join(good, "doc_id", "left_anti"), "missing document", "doc_id", F.lit(None).cast("string")),
        ]
    )

"""Word lists as one-column text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """Distinct words of a file with one word per line, trimmed and lowercased, blanks dropped."""
    word = F.lower(F.regexp_replace("value", r"^\s+|\s+$", "")).alias("word")
    return spark.read.text(path).select(word).where("word != ''").distinct()


def write_word_list(words: DataFrame, path: str) -> None:
    words.select(F.col(words.columns[0]).alias("value")).write.text(path)

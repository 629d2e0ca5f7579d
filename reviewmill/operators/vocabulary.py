"""The indexed vocabulary and checks on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.operators.ordering import with_ordinal


def build_vocabulary(terms: DataFrame) -> DataFrame:
    """``(term, idx)`` of distinct terms: code-point order, indexes 0, 1, 2, ..."""
    return with_ordinal(terms.select("term"), ["term"], "idx")


def check_vocabulary(vocabulary: DataFrame) -> DataFrame:
    """One row: size, index range, distinct indexes, and neighbours that are not in order.

    A term is compared with the term at the next index, an equi-join and not a window over all terms.
    """
    following = vocabulary.select((F.col("idx") - 1).alias("idx"), F.col("term").alias("_next"))
    return (
        vocabulary.join(following, "idx", "left")
        .agg(
            F.count(F.lit(1)).alias("n_terms"),
            F.min("idx").alias("min_idx"),
            F.max("idx").alias("max_idx"),
            F.count_distinct("idx").alias("n_indexes"),
            F.count_if(F.col("term") >= F.col("_next")).alias("out_of_order"),
        )
        .withColumn(
            "valid",
            (F.col("min_idx") == 0)
            & (F.col("max_idx") == F.col("n_terms") - 1)
            & (F.col("n_indexes") == F.col("n_terms"))
            & (F.col("out_of_order") == 0),
        )
    )

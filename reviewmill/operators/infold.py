"""Statistics of each training set without a pass per fold: the whole's less the left-out fold's."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.operators import ordering
from reviewmill.operators.profile import long_numbers
from reviewmill.session import materialise


def _less_one(rows: DataFrame, dealt: DataFrame, key: Sequence[str], sizes: Sequence[str]) -> DataFrame:
    """``rows`` hold sums per key and fold; per key and left-out fold, the sums over all other folds.

    A key missing from a fold loses nothing there. Folds are those of ``dealt``.
    """
    held = F.map_from_entries(F.collect_list(F.struct("fold", F.struct(*sizes))))
    folds = dealt.agg(F.sort_array(F.collect_set("fold"))).scalar()
    whole = rows.groupBy(*key).agg(held.alias("_held"), *[F.sum(s).alias(f"_{s}") for s in sizes])
    cells = whole.select("*", F.explode(folds).alias("fold"))
    left = [(F.col(f"_{s}") - F.coalesce(F.element_at("_held", F.col("fold"))[s], F.lit(0))).alias(s) for s in sizes]
    return cells.select(*key, "fold", *left)


def idf(pairs: DataFrame, dealt: DataFrame) -> DataFrame:
    """``(fold, term, df, idf)``: the inverse document frequency of each training set's terms.

    ``pairs`` are ``(doc_id, term, tf)``, ``dealt`` is ``(doc_id, fold)``; a document without terms counts too.
    """
    counts = pairs.join(dealt.select("doc_id", "fold"), "doc_id").groupBy("term", "fold").agg(F.count(F.lit(1)).alias("df"))
    rest = _less_one(materialise(counts, "fold-df"), dealt, ["term"], ["df"]).where("df > 0")
    sizes = dealt.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).withColumn("all", F.lit(1))
    n = _less_one(sizes, dealt, ["all"], ["n"])
    weight = F.log((1.0 + F.col("n")) / (1.0 + F.col("df"))) + 1
    return rest.join(F.broadcast(n.drop("all")), "fold").select("fold", "term", "df", weight.alias("idf"))


def numbers(table: DataFrame, dealt: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(fold, column, n, mean, std, median)`` of each training set; nulls are left out, ``std`` is the population's.

    Medians come from values counted per fold, less the fold's counts. Sums are taken around the whole
    table's mean, so that the variance keeps its digits.
    """
    long = long_numbers(table.join(dealt.select("doc_id", "fold"), "doc_id"), columns, ["fold"]).where("value IS NOT NULL")
    counted = materialise(long.groupBy("column", "value", "fold").agg(F.count(F.lit(1)).alias("n")), "fold-values")
    centre = counted.groupBy("column").agg((F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("centre"))
    off = F.col("value") - F.col("centre")
    sums = (
        counted.join(F.broadcast(centre), "column")
        .groupBy("column", "centre", "fold")
        .agg(F.sum("n").alias("n"), F.sum(off * F.col("n")).alias("s1"), F.sum(off * off * F.col("n")).alias("s2"))
    )
    rest = _less_one(materialise(sums, "fold-sums"), dealt, ["column", "centre"], ["n", "s1", "s2"]).where("n > 0")
    shift = F.col("s1") / F.col("n")
    moments = rest.select(
        "fold", "column", "n", (F.col("centre") + shift).alias("mean"),
        F.sqrt(F.greatest(F.col("s2") / F.col("n") - shift * shift, F.lit(0.0))).alias("std"),
    )
    values = _less_one(counted, dealt, ["column", "value"], ["n"]).where("n > 0")
    within = ["column", "fold"]
    placed = ordering.with_running_total(values, "n", ["value"], within, "upto")
    medians = ordering.quantiles_of_counted(materialise(placed, "placed"), "value", {"median": 0.5}, within)
    return moments.join(medians, within)

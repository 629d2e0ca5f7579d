"""Proofs that a fitted model is what its rows call for, computed by joins and sums over those rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.operators.ordering import with_running_total
from reviewmill.session import fresh_path, materialise

INTERCEPT = -1


def stationarity(
    entries: DataFrame, dealt: DataFrame, fitted: Mapping[int, LogisticRegressionModel], penalty: float = 1.0
) -> DataFrame:
    """``(fold, idx, observed, fitted)``: both sides of the optimality condition of each left-out fold's model.

    A logistic regression with an L2 penalty is optimal exactly if, for each feature, ``sum(x p) + penalty w`` equals
    ``sum(x y)`` over its training rows, and for the intercept (``idx`` -1, without penalty) the same with x = 1.
    ``observed`` depends on the data alone. ``entries`` are ``(doc_id, idx, value)``, ``dealt`` is
    ``(doc_id, label, fold)``. All folds share one pass: a weight is an array with a place per fold.
    """
    spark = entries.sparkSession
    folds = sorted(fitted)
    columns = zip(*(fitted[f].coefficients.toArray().tolist() for f in folds))
    weights = materialise(
        spark.createDataFrame(list(enumerate(map(list, columns))), "idx bigint, weights array<double>"), "weights"
    )
    used = materialise(entries.join(dealt.select("doc_id"), "doc_id", "left_semi"), "entries")
    sums = [F.sum(F.col("value") * F.get("weights", F.lit(i))) for i in range(len(folds))]
    margins = used.join(weights, "idx").groupBy("doc_id").agg(F.array(*sums).alias("margins"))
    odds = [
        1 / (1 + F.exp(-(F.coalesce(F.get("margins", F.lit(i)), F.lit(0.0)) + F.lit(float(fitted[f].intercept)))))
        for i, f in enumerate(folds)
    ]
    rows = materialise(
        dealt.join(margins, "doc_id", "left").select("doc_id", "label", "fold", F.array(*odds).alias("p")), "odds"
    )

    def moments(cells: DataFrame) -> DataFrame:
        def total(i: int, what):
            return F.sum(F.when(F.col("fold") != folds[i], F.col("value") * what).otherwise(0.0))

        pairs = [
            F.struct(
                F.lit(f).alias("fold"),
                total(i, F.col("label")).alias("observed"),
                total(i, F.get("p", F.lit(i))).alias("expected"),
                F.lit(i).alias("place"),
            )
            for i, f in enumerate(folds)
        ]
        return cells.groupBy("idx").agg(F.array(*pairs).alias("moments")).select("idx", F.inline("moments"))

    ones = rows.withColumns({"idx": F.lit(INTERCEPT).cast("bigint"), "value": F.lit(1.0)})
    both = moments(used.join(rows, "doc_id")).unionByName(moments(ones))
    weight = F.coalesce(F.get("weights", F.col("place")), F.lit(0.0))
    return both.join(weights, "idx", "left").select(
        F.col("fold").cast("int").alias("fold"), "idx", "observed", (F.col("expected") + penalty * weight).alias("fitted")
    )


def node_table(model, spark) -> DataFrame:
    """``(node, feature, threshold, left, right, prediction)`` of a decision tree with numeric splits, by Spark's
    own export; leaves have no children."""
    path = fresh_path(spark, "tree")
    model.write().save(path)
    return spark.read.parquet(f"{path}/data").select(
        F.col("id").alias("node"),
        F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.when(F.col("leftChild") >= 0, F.col("leftChild")).alias("left"),
        F.when(F.col("rightChild") >= 0, F.col("rightChild")).alias("right"),
        "prediction",
    )


def routed(rows: DataFrame, nodes: DataFrame, depth: int, key: str = "fold") -> DataFrame:
    """All nodes that each row passes on its way down: ``rows`` with ``node``, ``path`` and the node's columns.

    ``rows`` have an array ``values``; ``nodes`` are those of several trees, named by ``key``. One join per level.
    """
    at = rows.withColumns({"node": F.lit(0), "path": F.lit("")})
    passed = None
    for level in range(depth + 1):
        here = materialise(at.join(nodes, [key, "node"]), "passed")
        passed = here if passed is None else passed.unionByName(here)
        goes_left = F.get("values", F.col("feature")) <= F.col("threshold")
        at = here.where("left IS NOT NULL").select(
            *rows.columns,
            F.when(goes_left, F.col("left")).otherwise(F.col("right")).alias("node"),
            F.concat("path", F.when(goes_left, F.lit("L")).otherwise(F.lit("R"))).alias("path"),
        )
    return passed


def _gini(ones, n):
    return 2.0 * ones / n * (1 - ones / n)


def split_gains(passed: DataFrame, key: str = "fold") -> DataFrame:
    """Per inner node ``n``, ``ones``, its split, the split's Gini ``gain`` and ``best_gain``, that of the best candidate.

    Candidates are all features and all values but the largest, from counts per node, feature and value.
    """
    node = [key, "path"]
    inner = passed.where("left IS NOT NULL")
    counts = (
        inner.select(*node, "label", F.posexplode("values").alias("candidate", "value"))
        .groupBy(*node, "candidate", "value")
        .agg(F.count(F.lit(1)).alias("here"), F.sum("label").alias("ones_here"))
    )
    group = [*node, "candidate"]
    running = with_running_total(materialise(counts, "counts"), "here", ["value"], group, "below")
    running = with_running_total(running, "ones_here", ["value"], group, "ones_below")
    totals = inner.groupBy(*node, "feature", "threshold").agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("ones")
    )
    both = materialise(running, "running").join(materialise(totals, "totals"), node).where("below < n")
    above, ones_above = F.col("n") - F.col("below"), F.col("ones") - F.col("ones_below")
    gain = (
        _gini(F.col("ones"), F.col("n"))
        - _gini(F.col("ones_below"), F.col("below")) * F.col("below") / F.col("n")
        - _gini(ones_above, above) * above / F.col("n")
    )
    chosen = (F.col("candidate") == F.col("feature")) & (F.col("value") <= F.col("threshold"))
    return (
        both.withColumn("_gain", gain)
        .groupBy(*node, "feature", "threshold", "n", "ones")
        .agg(
            F.max("_gain").alias("best_gain"),
            # The largest value on the left side stands for the split.
            F.max_by("_gain", F.when(chosen, F.col("value"))).alias("gain"),
        )
    )

"""Positions, running totals and exact quantiles over a global order, without a one-task window.

Each works on a range-partitioned table: what happens inside a partition is local, and the partitions
are tied together by a table with one row per partition and group. That table is written, so that its
real size decides how it is joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.session import materialise

def with_ordinal(
    rows: DataFrame, order_by: Sequence[str], name: str, within: Sequence[str] = ()
) -> DataFrame:
    """Add the 0-based position of each row in ``order_by`` order, restarting in each group.

    ``within`` and ``order_by`` together must identify a row, which also keeps ranges balanced.
    """
    keys = [*within, *order_by]
    placed = materialise(
        rows.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        # Partition number in the high bits, row number within the partition in the low 33.
        .withColumn("_at", F.monotonically_increasing_id()),
        "ordinal",
    ).withColumn("_part", F.shiftright("_at", 33))
    spans = placed.groupBy("_part", *within).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    earlier = (
        Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = spans.select(
        "_part",
        *within,
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    return (
        placed.join(materialise(shifts, "shifts"), ["_part", *within])
        .withColumn(name, F.col("_at") + F.col("_shift"))
        .drop("_at", "_part", "_shift")
    )


def with_running_total(
    rows: DataFrame, value: str, order_by: Sequence[str], within: Sequence[str], name: str
) -> DataFrame:
    """Add the running total of ``value`` up to and including each row, restarting in each group.

    Pre-aggregate first: ``within`` and ``order_by`` together must identify a row.
    """
    keys = [*within, *order_by]
    placed = materialise(
        rows.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "running"
    )
    spans = placed.groupBy("_part", *within).agg(F.sum(value).alias("_sum"))
    earlier = (
        Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    before = spans.select(
        "_part", *within, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("_part", *within).orderBy(*order_by)
    return (
        placed.withColumn("_inside", F.sum(value).over(inside))
        .join(materialise(before, "before"), ["_part", *within])
        .withColumn(name, F.col("_before") + F.col("_inside"))
        .drop("_part", "_inside", "_before")
    )


def counted_values(rows: DataFrame, value: str, within: Sequence[str]) -> DataFrame:
    """One row per group and distinct value, with its count and the running count."""
    counts = (
        rows.where(F.col(value).isNotNull())
        .groupBy(*within, value)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return with_running_total(counts, "n", [value], within, "upto")


def quantiles_of_counted(
    counted: DataFrame, value: str, probs: dict[str, float], within: Sequence[str]
) -> DataFrame:
    """Exact, linearly interpolated quantiles per group from the output of ``counted_values``.

    ``probs`` maps output column names to probabilities.
    """
    sizes = counted.groupBy(*within).agg(F.sum("n").alias("_size"))
    ranked = counted.join(materialise(sizes, "sizes"), list(within))

    def at(rank):
        covers = (F.col("upto") - F.col("n") <= rank) & (rank < F.col("upto"))
        return F.max(F.when(covers, F.col(value)))

    ends = []
    for name, prob in probs.items():
        rank = (F.col("_size") - 1) * F.lit(float(prob))
        ends += [
            at(F.floor(rank)).alias(f"_{name}_low"),
            at(F.ceil(rank)).alias(f"_{name}_high"),
        ]
    found = ranked.groupBy(*within).agg(F.first("_size").alias("_size"), *ends)

    def between(name, prob):
        rank = (F.col("_size") - 1) * F.lit(float(prob))
        low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        return (low + (high - low) * (rank - F.floor(rank))).alias(name)

    return found.select(*within, *[between(name, prob) for name, prob in probs.items()])


def exact_quantiles(
    rows: DataFrame, value: str, probs: dict[str, float], within: Sequence[str]
) -> DataFrame:
    """Exact, linearly interpolated quantiles of ``value`` per group; nulls are left out."""
    return quantiles_of_counted(counted_values(rows, value, within), value, probs, within)

"""Joins of many rows to a table with one row per key, where a few keys may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.session import materialise


def join_counted(facts: DataFrame, table: DataFrame, key: list[str], n: str, how: str = "inner") -> DataFrame:
    """``facts`` joined to ``table``, whose column ``n`` says how many facts have its key (pass both written).

    Keys with more than a task's share of the facts go by broadcast; they are fewer than there are tasks. All
    other keys are joined by shuffle. Adaptive execution splits hot keys only at the borders of map outputs, and
    rows of one key compress so well that one output can hold most of them.
    """
    tasks = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total, most = table.agg(F.sum(n), F.max(n)).first()
    share = (total or 0) / tasks
    if (most or 0) <= share:
        return facts.join(table, key, how)
    values = [c for c in table.columns if c not in key]
    hot = table.where(F.col(n) > share).select(*key, F.struct(*values).alias("_hot"))
    marked = facts.join(F.broadcast(hot), key, "left")
    taken = marked.where("_hot IS NOT NULL").select(*facts.columns, "_hot.*")
    rest = marked.where("_hot IS NULL").drop("_hot").join(table.where(F.col(n) <= share), key, how)
    return taken.unionByName(rest)


def join_salted(facts: DataFrame, table: DataFrame, key: str, spread_by: str) -> DataFrame:
    """``facts`` (pass them written) joined to ``table``, which may have several rows per key.

    A key with more than a task's share of the facts is cut into pieces by ``spread_by``, and its table rows are
    repeated once per piece; such keys are fewer than there are tasks.
    """
    tasks = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = materialise(facts.groupBy(key).agg(F.count(F.lit(1)).alias("_n")), "key-counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    hot = F.broadcast(
        counts.where(F.col("_n") * tasks > total).select(key, F.ceil(F.col("_n") * tasks / total).cast("int").alias("_pieces"))
    )
    pieces = F.coalesce("_pieces", F.lit(1))
    cut = facts.join(hot, key, "left").withColumn("_piece", F.pmod(F.xxhash64(spread_by), pieces).cast("int"))
    repeated = table.join(hot, key, "left").withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
    return cut.drop("_pieces").join(repeated.drop("_pieces"), [key, "_piece"]).drop("_piece")

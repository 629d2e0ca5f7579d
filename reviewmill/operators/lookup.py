"""Joining a large table to a table with one row per key, whatever the key's skew."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.session import materialise

BROADCAST_BYTES = 64 * 1024 * 1024
# The hash table's own overhead per row.
ROW_OVERHEAD = 64


def fits_broadcast(table: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    """Whether a table is below ``limit`` bytes, by measuring all its columns."""
    row = F.octet_length(F.to_json(F.struct("*"))).cast("bigint")
    size = table.agg(F.sum(row + ROW_OVERHEAD).alias("bytes")).first()["bytes"]
    return (size or 0) <= limit


def lookup(
    facts: DataFrame,
    table: DataFrame,
    key: str,
    spread_by: str,
    how: str = "inner",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``facts`` to ``table`` (unique on ``key``; pass it materialised, it is measured).

    A table measured below ``limit`` is broadcast. A larger one is joined by shuffle, with every hot
    key cut into pieces by ``spread_by`` and its single table row repeated once per piece. Adaptive
    execution splits a skewed partition only if no aggregation needs its order, as those behind the
    lookups here do.
    """
    if fits_broadcast(table, limit):
        return facts.join(F.broadcast(table), key, how)
    return _salted_join(facts, table, key, spread_by, how)


def _salted_join(facts: DataFrame, table: DataFrame, key: str, spread_by: str, how: str) -> DataFrame:
    tasks = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Keys go by their hash, so a key of any length can be hot; keys of one hash are cut alike.
    hashed = F.xxhash64(key)
    # Written, as three parts of the plan read them.
    counts = materialise(facts.groupBy(hashed.alias("_hash")).agg(F.count(F.lit(1)).alias("_rows")), "key-counts")
    fair_share = counts.agg(F.sum("_rows") / F.lit(tasks)).scalar()
    # A hot key holds more than 1/tasks of all rows, so there are fewer than `tasks` of them.
    hot = (
        counts.withColumn("_pieces", F.ceil(F.col("_rows") / fair_share).cast("int"))
        .where("_pieces > 1")
        .select("_hash", "_pieces")
    )
    pieces = F.coalesce(F.col("_pieces"), F.lit(1))
    salted = (
        facts.withColumn("_hash", hashed)
        .join(F.broadcast(hot), "_hash", "left")
        .withColumn("_piece", F.pmod(F.xxhash64(spread_by), pieces).cast("int"))
    )
    repeated = (
        table.withColumn("_hash", hashed)
        .join(F.broadcast(hot), "_hash", "left")
        .withColumn("_piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
        .drop("_pieces", "_hash")
    )
    return (
        salted.drop("_pieces", "_hash").join(repeated, [key, "_piece"], how).drop("_piece")
    )

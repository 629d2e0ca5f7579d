"""A large table beside a table of any size, without the second as a whole in any task.

Documents are dealt into groups of bounded size; a group gets the rows of its own keys, each once. What is moved is
one row per group and distinct key, so it grows with the documents and not with documents times the table.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def beside(
    facts: DataFrame,
    keys: DataFrame,
    table: DataFrame,
    key: str,
    bytes_of_pair: int,
    group_bytes: int,
    run: Callable[[pa.Table, pa.Table], pa.Table],
    ddl: str,
    number: Column | None = None,
    pairs: int | None = None,
) -> DataFrame:
    """``run(facts, rows)`` for every group of documents, as one table with the columns of ``ddl``.

    ``facts`` and ``keys`` have a ``doc_id``; ``keys`` are the written pairs of document and ``key``. ``rows`` are the rows
    of ``table`` (unique on ``key``) for the keys of the group's documents. A group holds about ``group_bytes``, counted
    as ``bytes_of_pair`` for each of its pairs, and no document is in two. Without another ``number`` that both tables have,
    documents are dealt by ``doc_id``; without ``pairs``, their number is that of the ``keys``.
    """
    cores = keys.sparkSession.sparkContext.defaultParallelism
    pairs = keys.count() if pairs is None else pairs
    groups = max(cores, math.ceil(pairs * bytes_of_pair / group_bytes))
    number = F.xxhash64("doc_id") if number is None else number
    group = F.pmod(number, F.lit(groups)).cast("int")
    needed = keys.select(group.alias("_group"), key).distinct()
    rows = needed.join(table, key)
    # Named anew, as both sides may come from one table.
    rows = rows.select(*[F.col(c).alias(c) for c in rows.columns]).groupBy("_group")
    return facts.withColumn("_group", group).groupBy("_group").cogroup(rows).applyInArrow(run, ddl)

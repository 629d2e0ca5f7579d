"""Feature blocks beside the body text, and their assembly into model inputs.

A block is long form ``(doc_id, idx, value)``; blocks are put side by side by shifting ``idx``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from reviewmill.functions.values import standard_score
from reviewmill.operators import profile
from reviewmill.operators.lookup import lookup
from reviewmill.operators.ordering import with_ordinal
from reviewmill.session import materialise


# Fixed value: the mark of a sparse vector in Spark ML's storage format.
SPARSE = 0


@dataclass(frozen=True)
class Block:
    """A feature block: its entries in long form and its number of columns."""

    entries: DataFrame
    width: int


def categories(table: DataFrame, column: str) -> DataFrame:
    """``(category, value, code)``: all values in alphabetical order, null as the last category.

    ``category`` is a join key that is never null and differs from every value's key.
    """
    counts = table.groupBy(category_key(column).alias("category")).agg(
        F.first(column).alias("value")
    )
    return with_ordinal(counts, ["category"], "code")


def category_key(column: str):
    return F.when(F.col(column).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), column))


def one_hot(table: DataFrame, column: str, known: DataFrame) -> DataFrame:
    """``(doc_id, idx, value)``: 1 in the column of the row's category, nothing if it is unknown."""
    keyed = table.select("doc_id", category_key(column).alias("category"))
    codes = known.select("category", F.col("code").alias("idx"))
    return lookup(keyed, codes, "category", "doc_id").select(
        "doc_id", "idx", F.lit(1.0).alias("value")
    )


def numeric_features(
    table: DataFrame, plain: Sequence[str] = ("avg_product_rating",), logged: Sequence[str] = ("price",)
) -> DataFrame:
    """Median-filled numbers, ``log1p`` of some, all scaled to mean 0 and population deviation 1."""
    filled = profile.with_medians_filled(table.select("doc_id", *plain, *logged), [*plain, *logged])
    inputs = filled.select(
        "doc_id",
        *[F.col(c).alias(c) for c in plain],
        *[F.log1p(c).alias(f"log_{c}") for c in logged],
    )
    names = inputs.columns[1:]
    moments = inputs.agg(
        F.struct(
            *[F.avg(c).alias(f"mean_{c}") for c in names],
            *[F.stddev_pop(c).alias(f"std_{c}") for c in names],
        ).alias("moments")
    )
    scaled = inputs.withColumn("_moments", moments.scalar())
    of = F.col("_moments").getField
    return scaled.select(
        "doc_id", *[standard_score(F.col(c), of(f"mean_{c}"), of(f"std_{c}")).alias(c) for c in names]
    )


def columns_to_entries(table: DataFrame) -> DataFrame:
    """Long form of all columns but ``doc_id``, in column order."""
    names = [c for c in table.columns if c != "doc_id"]
    cells = [
        F.struct(F.lit(i).cast("bigint").alias("idx"), F.col(c).cast("double").alias("value"))
        for i, c in enumerate(names)
    ]
    return table.select("doc_id", F.inline(F.array(*cells)))


def vector_to_entries(vectors: DataFrame) -> DataFrame:
    return vectors.select("doc_id", F.posexplode("vector").alias("idx", "value")).select(
        "doc_id", F.col("idx").cast("bigint").alias("idx"), "value"
    )


def counts_to_entries(counts: DataFrame) -> DataFrame:
    return counts.select("doc_id", "idx", F.col("tf").cast("double").alias("value"))


def side_by_side(blocks: Sequence[Block]) -> Block:
    """One block with the columns of all, in order."""
    offset, entries = 0, None
    for block in blocks:
        shifted = block.entries.select(
            "doc_id", (F.col("idx") + F.lit(offset)).alias("idx"), "value"
        )
        entries = shifted if entries is None else entries.unionByName(shifted)
        offset += block.width
    return Block(entries, offset)


def written(block: Block) -> Block:
    """The block with its non-zero entries as a written table, for blocks that several inputs use."""
    return Block(materialise(block.entries.where("value != 0"), "block"), block.width)


def occupied(block: Block, documents: DataFrame) -> Block:
    """The block's entries of these documents, without the columns that are zero in all of them; order stays.

    A penalised linear model gives such columns the coefficient 0, so its predictions are the same without.
    """
    mine = block.entries.where("value != 0").join(documents.select("doc_id").distinct(), "doc_id", "left_semi")
    mine = materialise(mine, "occupied")
    columns = with_ordinal(mine.select("idx").distinct(), ["idx"], "_new")
    known = materialise(columns.select("idx", "_new"), "columns")
    entries = lookup(mine, known, "idx", "doc_id").select("doc_id", F.col("_new").alias("idx"), "value")
    return Block(entries, known.count())


def entry_rows(documents: DataFrame, block: Block) -> DataFrame:
    """``(doc_id, features)``, one row per document; documents without entries are zero.

    ``features`` is the struct that a sparse ML vector is stored as.
    """
    # A row's entries become one vector, so a group is one output row.
    rows = (
        block.entries.where("value != 0")
        .join(documents.select("doc_id"), "doc_id", "left_semi")
        .groupBy("doc_id")
        .agg(F.sort_array(F.collect_list(F.struct("idx", "value"))).alias("_entries"))
    )
    vector = F.struct(
        F.lit(SPARSE).cast("tinyint").alias("type"),
        F.lit(block.width).cast("int").alias("size"),
        F.coalesce(F.col("_entries.idx").cast("array<int>"), F.array().cast("array<int>")).alias("indices"),
        F.coalesce("_entries.value", F.array().cast("array<double>")).alias("values"),
    )
    return documents.select("doc_id").join(rows, "doc_id", "left").select("doc_id", vector.alias("features"))


def with_vectors(rows: DataFrame, label: str = "vectors") -> DataFrame:
    """The rows written, and read back with ``features`` as ML vectors.

    A vector is stored as its struct, so reading it under the vector type is all it takes; no row
    passes through Python.
    """
    fields = [
        StructField("features", VectorUDT()) if f.name == "features" else f for f in rows.schema
    ]
    return materialise(rows, label, StructType(fields))


def assembled(documents: DataFrame, block: Block) -> DataFrame:
    """``(doc_id, features)`` as ML vectors, one per document."""
    return with_vectors(entry_rows(documents, block))


def block_stats(documents: DataFrame, block: Block) -> DataFrame:
    """Rows, columns and non-zeros of a block."""
    filled = block.entries.where("value != 0").agg(
        F.count(F.lit(1)).alias("nonzeros"), F.count_distinct("doc_id").alias("rows_filled")
    )
    n = documents.agg(F.count(F.lit(1))).scalar()
    return filled.select(
        n.alias("n_rows"),
        F.lit(block.width).cast("bigint").alias("n_columns"),
        "nonzeros",
        "rows_filled",
    )


def stacked_stats(
    documents: DataFrame, blocks: Mapping[str, Block], stacks: Mapping[str, Sequence[str]]
) -> DataFrame:
    """``block_stats`` of several blocks and of stacks of them side by side, each block read once.

    Entries are counted per document and block, which says all of every stack; a stack of one is the block.
    """
    marked = [b.entries.where("value != 0").select("doc_id", F.lit(name).alias("block")) for name, b in blocks.items()]
    per_document = reduce(DataFrame.unionByName, marked).groupBy("doc_id").agg(
        *[F.count_if(F.col("block") == name).alias(f"n_{name}") for name in blocks]
    )
    sums = []
    for stack, names in stacks.items():
        entries = reduce(Column.__add__, [F.col(f"n_{name}") for name in names])
        sums += [
            F.coalesce(F.sum(entries), F.lit(0)).alias(f"nonzeros_{stack}"),
            F.count_if(entries > 0).alias(f"filled_{stack}"),
        ]
    totals = per_document.agg(*sums).withColumn("n_rows", documents.agg(F.count(F.lit(1))).scalar())
    rows = [
        F.struct(
            F.lit(stack).alias("block"),
            "n_rows",
            F.lit(sum(blocks[name].width for name in names)).cast("bigint").alias("n_columns"),
            F.col(f"nonzeros_{stack}").alias("nonzeros"),
            F.col(f"filled_{stack}").alias("rows_filled"),
        )
        for stack, names in stacks.items()
    ]
    return totals.select(F.inline(F.array(*rows)))


def with_label(features: DataFrame, labels: DataFrame) -> DataFrame:
    return features.join(labels.select("doc_id", "label"), "doc_id")

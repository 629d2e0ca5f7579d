"""Count vectors, TF-IDF weights and averaged word vectors, in long form until the very end.

The hub is ``pairs``: one row ``(doc_id, term, tf)`` per document and distinct term, where ``term`` may be any
key, such as an index.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.operators.dealt import beside
from reviewmill.operators.lookup import lookup
from reviewmill.session import materialise
from reviewmill.sources.vectors import width

# Bytes of a group of documents that is averaged at once, and of a pair without its vector. Several pairs share a
# vector, which counts as a byte for each of its values.
VECTOR_BLOCK_BYTES = 512 * 1024 * 1024
PAIR_BYTES = 64
# Pairs of one document whose vectors are laid side by side.
ROWS_AT_ONCE = 1 << 16


def term_pairs(documents: DataFrame) -> DataFrame:
    """``(doc_id, term, tf)`` from token arrays, counted without a shuffle and written once.

    A document is one row, so its sorted tokens are cut into runs of equal terms inside that row. All
    pairs of a document stay together, and later sums per document finish before their shuffle.
    Every feature reads the pairs; written, they also keep later filters from being pushed into the
    run expressions, where Spark would evaluate the sort once per token.
    """
    tokens, bounds, length = F.col("_sorted"), F.col("_bounds"), F.size("_sorted")
    starts = F.filter(
        F.slice(F.sequence(F.lit(0), length), F.lit(1), length),
        lambda i: (i == 0) | (F.get(tokens, i) != F.get(tokens, i - 1)),
    )
    # The explode takes an expression: for a plain column Spark adds such a filter itself.
    runs = (
        documents.select("doc_id", F.sort_array("tokens").alias("_sorted"))
        .withColumn("_bounds", F.concat(starts, F.array(length)))
        .select(
            "doc_id",
            "_sorted",
            "_bounds",
            F.posexplode(F.slice(bounds, F.lit(1), F.size(bounds) - 1)).alias("_run", "_start"),
        )
    )
    pairs = runs.select(
        "doc_id",
        F.get(tokens, F.col("_start")).alias("term"),
        (F.get(bounds, F.col("_run") + 1) - F.col("_start")).cast("bigint").alias("tf"),
    )
    return materialise(pairs, "pairs")


def count_vectors(pairs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(doc_id, idx, tf)`` for the terms of the vocabulary; other terms are dropped."""
    return lookup(pairs, vocabulary, "term", "doc_id").select("doc_id", "idx", "tf")


def inverse_document_frequency(pairs: DataFrame, reviews: DataFrame) -> DataFrame:
    """``(term, idf)`` with ``idf = ln((1 + n) / (1 + df)) + 1``; ``n`` counts empty reviews too."""
    n = reviews.agg(F.count(F.lit(1))).scalar()
    return pairs.groupBy("term").agg(
        (F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.count(F.lit(1)))) + 1).alias("idf")
    )


def tfidf(pairs: DataFrame, idf: DataFrame) -> DataFrame:
    """``(doc_id, term, weight)``: tf times idf, scaled to unit length per document."""
    raw = (F.col("tf") * F.col("idf")).alias("_raw")
    # Dealt before the window, which would shuffle the squares as well.
    weighted = lookup(pairs, idf, "term", "doc_id").select("doc_id", "term", raw).repartition("doc_id")
    norm = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy("doc_id")))
    return weighted.select("doc_id", "term", (F.col("_raw") / norm).alias("weight"))


def occurrence_weights(pairs: DataFrame, idf: DataFrame) -> DataFrame:
    """Add the TF-IDF weight all occurrences of a term carry together.

    Each of the ``tf`` occurrences is weighted by ``tf * idf``; the document's scale cancels in the
    mean. A term missing from ``idf`` has weight 0. Written, as its readers read it more than once.
    """
    weight = F.col("tf") * F.col("tf") * F.coalesce(F.col("idf"), F.lit(0.0))
    weighed = lookup(pairs, idf, "term", "doc_id", "left").select("doc_id", "term", "tf", weight.alias("weight"))
    return materialise(weighed, "weights")


def mean_vectors(
    reviews: DataFrame,
    pairs: DataFrame,
    vectors: DataFrame,
    weight: str = "tf",
    may_be_zero: bool = False,
    block_bytes: int = VECTOR_BLOCK_BYTES,
    scale: str | None = None,
) -> DataFrame:
    """``(doc_id, vector)``: the weighted mean word vector of every review.

    Terms without a vector are dropped; a review without any gets zeros. Weights from the same
    corpus are above 0. With weights from another, set ``may_be_zero``: a review whose weights sum
    to 0 then gets the plain mean over occurrences. ``scale`` names a column of ``vectors`` by which a term's weights
    are multiplied. Pass the pairs written, they are read more than once.
    Documents are dealt into groups of about ``block_bytes``; each group gets the vectors of its own terms once, and
    no vector is repeated per pair.
    """
    shares = [weight, "tf"] if may_be_zero else [weight]
    ways = {"vector": [("_by_0", 1, True), ("_by_1", 1, False)][: len(shares)]}
    return _averages(reviews, pairs, shares, vectors, scale, ways, block_bytes)


def plain_and_weighted(
    reviews: DataFrame, pairs: DataFrame, vectors: DataFrame, idf: DataFrame, block_bytes: int = VECTOR_BLOCK_BYTES
) -> DataFrame:
    """``(doc_id, vector, weighted)``: ``mean_vectors`` and ``weighted_means`` of written pairs, moved only once."""
    ways = {"vector": [("_by_0", 1, False)], "weighted": [("_by_0", 2, True)]}
    return _averages(reviews, pairs, ["tf"], _scaled(vectors, idf), "idf", ways, block_bytes)


def _averages(
    reviews: DataFrame, pairs: DataFrame, shares: list[str], vectors: DataFrame, scale: str | None,
    ways: dict[str, list[tuple[str, int, bool]]], block_bytes: int,
) -> DataFrame:
    """A column of means for each of ``ways``, see ``_averaging``; zeros where there is nothing to average."""
    dim = width(vectors)
    weighed = pairs.select(
        "doc_id", "term", *[F.col(s).cast("double").alias(f"_by_{i}") for i, s in enumerate(shares)]
    )
    found = beside(
        weighed,
        pairs.select("doc_id", "term"),
        vectors.select("term", "vector", (F.lit(1.0) if scale is None else F.col(scale)).alias("_scale")),
        "term",
        PAIR_BYTES + dim,
        block_bytes,
        _averaging(dim, ways),
        ", ".join(
            [f"doc_id {pairs.schema['doc_id'].dataType.simpleString()}", *[f"{name} array<double>" for name in ways]]
        ),
    )
    return _with_zeros(reviews, found, ways, dim)


def _with_zeros(reviews: DataFrame, found: DataFrame, ways: dict, dim: int) -> DataFrame:
    zeros = F.array_repeat(F.lit(0.0), dim)
    return (
        reviews.select("doc_id")
        .join(found, "doc_id", "left")
        .select("doc_id", *[F.coalesce(name, zeros).alias(name) for name in ways])
    )


def _averaging(dim: int, ways: dict[str, list[tuple[str, int, bool]]]):
    """The means of a group's documents from its pairs and vectors, a document at a time.

    A way of averaging is a list of weights, each a column of the pairs, its power, and whether the term's scale goes
    with it. A document takes the first whose sum is above 0, and zeros without any.
    """

    def averaged(pairs: pa.Table, known: pa.Table) -> pa.Table:
        if pa.types.is_list(pairs["term"].type):
            terms = pairs["term"].combine_chunks()
            of = pc.list_parent_indices(terms)
            flat = {c: pairs[c].combine_chunks().flatten() for c in pairs.column_names if c.startswith("_by_")}
            pairs = pa.table({"doc_id": pairs["doc_id"].combine_chunks().take(of), "term": terms.flatten()} | flat)
        at = pc.index_in(pairs["term"], value_set=known["term"].combine_chunks())
        pairs, at = pairs.filter(pc.is_valid(at)), at.drop_null().to_numpy()
        documents = pairs["doc_id"].combine_chunks().dictionary_encode()
        doc, n = documents.indices.to_numpy(), len(documents.dictionary)
        x = known["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(-1, dim)
        scale = known["_scale"].to_numpy()[at]
        order = np.argsort(doc, kind="stable")
        sorted_at, ends = at[order], np.cumsum(np.bincount(doc, minlength=n))
        offsets = np.arange(0, (n + 1) * dim, dim or 1, dtype="int32")[: n + 1]
        made = {"doc_id": documents.dictionary}
        for name, weights in ways.items():
            means, done = np.zeros((n, dim)), np.zeros(n, bool)
            for column, power, scaled in weights:
                w = np.nan_to_num(pairs[column].to_numpy() ** power * (scale if scaled else 1.0))
                w = np.where(w > 0, w, 0.0)
                total = np.bincount(doc, w, n)
                w = w[order]
                now = (total > 0) & ~done
                for i in np.flatnonzero(now):
                    first, end = ends[i - 1] if i else 0, ends[i]
                    for start in range(first, end, ROWS_AT_ONCE):
                        some = slice(start, min(start + ROWS_AT_ONCE, end))
                        means[i] += w[some] @ x[sorted_at[some]]
                means[now] /= total[now, None]
                done |= now
            made[name] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(means.ravel()))
        return pa.table(made)

    return averaged


def means_of_lists(
    reviews: DataFrame, counted: DataFrame, words: DataFrame, vectors: DataFrame, pairs: int | None = None,
    block_bytes: int = VECTOR_BLOCK_BYTES,
) -> DataFrame:
    """``mean_vectors`` of documents as lists, ``(part, doc_id, values, tfs)`` with values for terms (``coded.recounted``).

    Whole parts go to a group, and the terms it needs are read from ``words`` ``(part, term)``, not from the documents.
    ``pairs`` is about the number of entries of all lists; without it, the words are counted for it.
    """
    dim = width(vectors)
    ways = {"vector": [("_by_0", 1, False)]}
    found = beside(
        counted.select(
            "part", "doc_id", F.col("values").alias("term"), F.col("tfs").cast("array<double>").alias("_by_0")
        ),
        words,
        vectors.select("term", "vector", F.lit(1.0).alias("_scale")),
        "term",
        PAIR_BYTES + dim,
        block_bytes,
        _averaging(dim, ways),
        f"doc_id {counted.schema['doc_id'].dataType.simpleString()}, vector array<double>",
        F.col("part"),
        pairs,
    )
    return _with_zeros(reviews, found, ways, dim)


def weighted_means(
    reviews: DataFrame, pairs: DataFrame, vectors: DataFrame, idf: DataFrame
) -> DataFrame:
    """Mean vectors under ``occurrence_weights``; the idf goes with the vectors and not to the pairs."""
    squared = pairs.withColumn("weight", F.col("tf") * F.col("tf"))
    return mean_vectors(reviews, squared, _scaled(vectors, idf), "weight", scale="idf")


def _scaled(vectors: DataFrame, idf: DataFrame) -> DataFrame:
    return vectors.join(idf, "term", "left").withColumn("idf", F.coalesce("idf", F.lit(0.0)))


def written_idf(pairs: DataFrame, reviews: DataFrame) -> DataFrame:
    return materialise(inverse_document_frequency(pairs, reviews), "idf")

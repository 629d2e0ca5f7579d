"""Groups of documents beside the table rows of their own keys."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reviewmill.operators import consolidate, terms, vectors
from reviewmill.operators.dealt import beside


@pytest.fixture(scope="module")
def pairs(spark):
    rows = spark.range(400).select(F.col("id").alias("doc_id"), F.explode(F.sequence(F.lit(0), F.lit(4))).alias("k"))
    term = F.concat(F.lit("t"), (F.col("doc_id") * 7 + F.col("k")) % 50)
    return rows.select("doc_id", term.alias("term"), (F.col("k") + 1).cast("bigint").alias("tf"))


def test_a_group_has_whole_documents_and_each_of_its_keys_once(spark, pairs):
    table = spark.range(60).select(F.concat(F.lit("t"), "id").alias("term"), "id")

    def seen(facts, rows):
        assert set(facts["term"].to_pylist()) == set(rows["term"].to_pylist())
        group = facts["_group"][0].as_py()
        docs = sorted(set(facts["doc_id"].to_pylist()))
        n = len(rows)
        return pa.table({"g": pa.array([group] * len(docs), pa.int32()), "doc_id": docs, "n": pa.array([n] * len(docs), pa.int64())})

    found = beside(pairs, pairs, table, "term", 10, 1000, seen, "g int, doc_id bigint, n bigint").collect()
    assert sorted(r["doc_id"] for r in found) == list(range(400))
    assert len({r["g"] for r in found}) > 8 and max(r["n"] for r in found) <= 50


def test_no_vector_is_repeated_per_pair(spark, pairs):
    known = spark.range(50).select(F.concat(F.lit("t"), "id").alias("term"), F.array(F.col("id").cast("float")).alias("vector"))
    docs = pairs.select("doc_id").distinct()
    means = vectors.mean_vectors(docs, pairs, known)
    plan = means._jdf.queryExecution().executedPlan().toString()
    # A vector per pair made the aggregate sort all of them, once a task had over 128 documents.
    assert "ObjectHashAggregate" not in plan and means.count() == 400
    one = means.where("doc_id = 3").first()["vector"][0]
    assert one == pytest.approx(sum((21 + k) * (k + 1) for k in range(5)) / 15)


def test_idf_beside_the_vectors_weighs_as_beside_the_pairs(spark, pairs):
    known = spark.range(40).select(F.concat(F.lit("t"), "id").alias("term"), F.array(F.col("id").cast("float"), F.lit(1).cast("float")).alias("vector"))
    docs = pairs.select("doc_id").distinct()
    idf = vectors.written_idf(pairs.where("doc_id % 3 = 0 AND term <> 't5'"), docs)
    weights = vectors.occurrence_weights(pairs, idf)
    once = {r["doc_id"]: [round(v, 9) for v in r["vector"]] for r in vectors.mean_vectors(docs, weights, known, "weight").collect()}
    other = {r["doc_id"]: [round(v, 9) for v in r["vector"]] for r in vectors.weighted_means(docs, pairs, known, idf).collect()}
    assert once == other


def test_tokens_replaced_in_groups_keep_order_and_empty_documents(spark):
    reviews = spark.createDataFrame([(1, "b a b zz"), (2, None), (3, "c"), (4, "A-b a")], "doc_id bigint, review_text string")
    counted = terms.token_pairs(reviews, least=1)
    assert sorted(map(tuple, counted.collect())) == [
        (1, "a", 1), (1, "b", 2), (1, "zz", 1), (3, "c", 1), (4, "a", 1), (4, "a-b", 1),
    ]
    forms = spark.createDataFrame([("a", "x"), ("b", "y"), ("a-b", "x")], "term string, form string")
    for size in (1, 1 << 20):
        done = consolidate.replaced_tokens(terms.tokenized(reviews), counted, forms, size)
        assert {r["doc_id"]: r["tokens"] for r in done.collect()} == {1: ["y", "x", "y"], 2: [], 3: [], 4: ["x", "x"]}

"""What the queries over pairs write and move: indexes in place of forms, one pass for both kinds of means."""

import pytest
from pyspark.sql import functions as F

from reviewmill import session
from reviewmill.operators import features, vectors
from reviewmill.operators.features import Block
from reviewmill.plans import queries

SF = "/root/testdata/sf0.001"


def written_by(call):
    before = set(session._written)
    made = call()
    return made, {path.rsplit("/", 1)[1].rsplit("-", 1)[0] for path in session._written - before}


@pytest.fixture
def passes(monkeypatch):
    seen, real = [], vectors.beside

    def counted(facts, keys, *rest):
        seen.append(keys)
        return real(facts, keys, *rest)

    monkeypatch.setattr(vectors, "beside", counted)
    return seen


@pytest.mark.parametrize("name", ["weighted_vectors", "title_weighted_vectors", "consolidate", "infold_tfidf"])
def test_no_pairs_of_forms_are_written(spark, name):
    _, labels = written_by(lambda: queries.REGISTERED[name](spark, SF))
    assert labels and "stemmed-pairs" not in labels


def test_scopes_move_the_pairs_of_each_text_once(spark, passes):
    queries.feature_scopes(spark, SF)
    assert len(passes) == 2 and all(dict(keys.dtypes)["term"] == "bigint" for keys in passes)


def test_grid_of_the_body_makes_the_body_alone(spark, passes):
    made, labels = written_by(lambda: queries._body_inputs(spark, SF))
    assert len(made) == 3 and len(passes) == 1 and "block" not in labels


def test_both_means_are_those_made_apart(spark):
    pairs = spark.createDataFrame(
        [(1, 7, 2), (1, 8, 1), (2, 8, 3), (2, 9, 1), (3, 9, 5)], "doc_id bigint, term bigint, tf bigint"
    )
    known = spark.createDataFrame([(7, [1.0, 0.0]), (8, [0.0, 4.0])], "term bigint, vector array<float>")
    docs = spark.range(1, 5).withColumnRenamed("id", "doc_id")
    idf = vectors.written_idf(pairs, docs)
    both = {r["doc_id"]: r for r in vectors.plain_and_weighted(docs, pairs, known, idf, 100).collect()}
    plain = {r["doc_id"]: r["vector"] for r in vectors.mean_vectors(docs, pairs, known).collect()}
    weighted = {r["doc_id"]: r["vector"] for r in vectors.weighted_means(docs, pairs, known, idf).collect()}
    assert {d: r["vector"] for d, r in both.items()} == plain
    assert {d: r["weighted"] for d, r in both.items()} == weighted
    assert plain[1] == pytest.approx([2 / 3, 4 / 3]) and plain[3] == plain[4] == [0.0, 0.0]


def test_a_long_document_is_averaged_in_parts(spark, monkeypatch):
    docs = spark.range(2).withColumnRenamed("id", "doc_id")
    pairs = docs.select("doc_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(99).cast("bigint"))).alias("term"), F.lit(1).alias("tf"))
    known = spark.range(100).select(F.col("id").alias("term"), F.array(F.col("id").cast("float")).alias("vector"))
    monkeypatch.setattr(vectors, "ROWS_AT_ONCE", 7)
    assert [r["vector"] for r in vectors.mean_vectors(docs, pairs, known).collect()] == [[49.5], [49.5]]


def test_models_of_means_average_labelled_reviews_alone(spark, passes):
    labels = queries._labelled(spark, SF).where("doc_id % 2 = 0")
    some = {r["doc_id"]: r["vector"] for r in queries._body_means(spark, SF, False, labels).collect()}
    every = {r["doc_id"]: r["vector"] for r in queries._body_means(spark, SF, False).collect()}
    assert set(some) == {r["doc_id"] for r in labels.collect()}
    assert all(vector == pytest.approx(every[doc_id]) for doc_id, vector in some.items())
    assert passes[0].count() < passes[1].count()


def test_counts_of_some_documents_are_theirs_among_all(spark):
    words, some = queries._words(spark, SF), queries._labelled(spark, SF).where("doc_id % 3 = 0")
    mine = sorted(map(tuple, words.counts_among(some.unionByName(some)).collect()))
    assert mine and mine == sorted(map(tuple, words.counts.join(some.select("doc_id"), "doc_id", "left_semi").collect()))


def test_stacks_are_counted_like_blocks_side_by_side(spark):
    def block(rows, width):
        return Block(spark.createDataFrame(rows, "doc_id bigint, idx bigint, value double"), width)

    a, b = block([(1, 0, 1.0), (1, 2, 1.0), (2, 1, 0.0)], 3), block([(1, 0, 1.0), (3, 1, 2.0)], 2)
    none = block([], 4)
    docs = spark.range(5).withColumnRenamed("id", "doc_id")
    stacks = {"a": ["a"], "b": ["b"], "none": ["none"], "all": ["a", "b", "none"]}
    rows = {r["block"]: r[1:] for r in features.stacked_stats(docs, {"a": a, "b": b, "none": none}, stacks).collect()}
    side = features.side_by_side([a, b, none])
    for name, alone in {"a": a, "b": b, "none": none, "all": side}.items():
        assert rows[name] == tuple(features.block_stats(docs, alone).first())
    assert rows["all"] == (5, 9, 4, 2)

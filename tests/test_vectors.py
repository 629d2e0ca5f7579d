import math
import random

import pytest
from pyspark.sql import functions as F

from reviewmill.operators import consolidate, features, lookup, vectors
from reviewmill.operators.features import Block
from reviewmill.session import fresh_path, materialise
from reviewmill.sources import vectors as files


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(1, ["a", "a", "b"]), (2, ["b"]), (3, [])]
    return spark.createDataFrame(rows, "doc_id bigint, tokens array<string>")


@pytest.fixture(scope="module")
def word_vectors(spark):
    rows = [("a", [1.0, 0.0]), ("b", [0.0, 1.0])]
    return spark.createDataFrame(rows, "term string, vector array<float>")


def as_dict(rows):
    return {r["doc_id"]: [round(v, 4) for v in r["vector"]] for r in rows.collect()}


def test_pairs(corpus):
    pairs = {(r["doc_id"], r["term"]): r["tf"] for r in vectors.term_pairs(corpus).collect()}
    assert pairs == {(1, "a"): 2, (1, "b"): 1, (2, "b"): 1}


def test_tfidf(corpus):
    pairs = vectors.term_pairs(corpus)
    idf = {
        r["term"]: r["idf"] for r in vectors.inverse_document_frequency(pairs, corpus).collect()
    }
    assert idf["a"] * 2 == pytest.approx(3.386294, abs=1e-6)
    assert idf["b"] == pytest.approx(1.287682, abs=1e-6)
    weights = vectors.tfidf(pairs, vectors.written_idf(pairs, corpus)).collect()
    one = {r["term"]: r["weight"] for r in weights if r["doc_id"] == 1}
    assert one["a"] == pytest.approx(3.386294 / math.hypot(3.386294, 1.287682), abs=1e-6)
    assert sum(w * w for w in one.values()) == pytest.approx(1)


def test_mean_and_weighted_vectors(corpus, word_vectors):
    pairs = vectors.term_pairs(corpus)
    plain = vectors.mean_vectors(corpus, pairs, word_vectors)
    assert as_dict(plain) == {1: [0.6667, 0.3333], 2: [0.0, 1.0], 3: [0.0, 0.0]}
    weights = vectors.occurrence_weights(pairs, vectors.written_idf(pairs, corpus))
    weighted = vectors.mean_vectors(corpus, weights, word_vectors, "weight")
    assert as_dict(weighted) == {1: [0.8402, 0.1598], 2: [0.0, 1.0], 3: [0.0, 0.0]}


def test_weights_of_zero_fall_back_to_the_plain_mean(corpus, word_vectors):
    pairs = vectors.term_pairs(corpus)
    other = corpus.sparkSession.createDataFrame([("z", 2.0)], "term string, idf double")
    weights = vectors.occurrence_weights(pairs, other)
    weighted = vectors.mean_vectors(corpus, weights, word_vectors, "weight", may_be_zero=True)
    assert as_dict(weighted) == as_dict(vectors.mean_vectors(corpus, pairs, word_vectors))


@pytest.fixture(scope="module")
def skewed(spark):
    """Pairs in which one term is in every document and so holds a third of the rows."""
    draw = random.Random(7)
    rows = []
    for doc in range(300):
        rows.append((doc, "hot", draw.randint(1, 4)))
        rows += [(doc, f"t{t}", draw.randint(1, 4)) for t in draw.sample(range(200), 2)]
    return spark.createDataFrame(rows, "doc_id bigint, term string, tf bigint")


def test_vector_blocks_give_the_same_means(spark, skewed):
    draw = random.Random(8)
    table = [("hot", [1.0, 2.0, 3.0])] + [
        (f"t{t}", [draw.random() for _ in range(3)]) for t in range(0, 200, 2)
    ]
    known = spark.createDataFrame(table, "term string, vector array<float>")
    docs = skewed.select("doc_id").distinct()
    once = as_dict(vectors.mean_vectors(docs, skewed, known))
    assert as_dict(vectors.mean_vectors(docs, skewed, known, block_bytes=2000)) == once
    byhand = dict((t, v) for t, v in known.collect())
    sums = {}
    for doc, term, tf in skewed.collect():
        if term in byhand:
            total, weight = sums.get(doc, ([0.0] * 3, 0))
            sums[doc] = ([s + tf * x for s, x in zip(total, byhand[term])], weight + tf)
    assert once == {d: [round(s / w, 4) for s in total] for d, (total, w) in sums.items()}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_lookup_equals_plain_join(many_partitions, skewed, how):
    spark = many_partitions
    table = spark.createDataFrame(
        [("hot", 1)] + [(f"t{t}", t) for t in range(0, 200, 3)], "term string, idx bigint"
    )
    expected = sorted(map(tuple, skewed.join(table, "term", how).collect()), key=str)
    broadcast = lookup.lookup(skewed, table, "term", "doc_id", how)
    salted = lookup.lookup(skewed, table, "term", "doc_id", how, limit=0)
    assert sorted(map(tuple, broadcast.collect()), key=str) == expected
    assert sorted(map(tuple, salted.select(broadcast.columns).collect()), key=str) == expected


def test_hot_key_is_cut_into_pieces(many_partitions, skewed):
    table = many_partitions.createDataFrame([("hot", 1)], "term string, idx bigint")
    plan = lookup._salted_join(skewed, table, "term", "doc_id", "inner")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "_piece" in text and plan.count() == 300


def test_long_hot_key_is_cut_into_pieces(many_partitions):
    spark, key = many_partitions, "k" * 300
    facts = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, F.lit(key)).otherwise(F.col("id").cast("string")).alias("term")
    )
    table = spark.createDataFrame([(key, 1)], "term string, idx bigint")
    joined = lookup.lookup(facts, table, "term", "doc_id", "left", limit=0)
    sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    assert joined.count() == 4000 and joined.where("idx = 1").count() == 2000
    assert max(r["count"] for r in sizes) < 1500


def test_broadcast_measures_all_columns(spark):
    long = spark.createDataFrame([("a", "x" * 100_000)], "term string, form string")
    assert not lookup.fits_broadcast(long, 1000) and lookup.fits_broadcast(long, 200_000)


def test_wide_vectors_in_blocks(spark, skewed):
    draw = random.Random(9)
    table = [(t, [draw.random() for _ in range(300)]) for t in ("hot", *(f"t{i}" for i in range(40)))]
    known = spark.createDataFrame([*table, ("unused", [0.0] * 300)], "term string, vector array<float>")
    docs = skewed.select("doc_id").distinct()
    once = as_dict(vectors.mean_vectors(docs, skewed, known))
    assert as_dict(vectors.mean_vectors(docs, skewed, known, block_bytes=30_000)) == once
    assert all(len(v) == 300 for v in once.values())


def test_consolidation_adds_counts(spark, skewed):
    forms = materialise(
        skewed.select("term").distinct().withColumn("form", F.substring("term", 1, 2)), "forms"
    )
    merged = consolidate.consolidated_pairs(skewed, forms)
    assert merged.agg(F.sum("tf")).first()[0] == skewed.agg(F.sum("tf")).first()[0]
    assert merged.where("term = 'ho'").count() == 300


def test_count_files_round_trip(spark, corpus):
    counts = spark.createDataFrame(
        [(1, 10, 2), (1, 2, 1), (2, 2, 1)], "doc_id bigint, idx bigint, tf bigint"
    )
    lines = files.count_lines(counts, corpus)
    assert {r["line"] for r in lines.collect()} == {"#1,2:1,10:2", "#2,2:1", "#3,"}
    path = fresh_path(spark, "test")
    files.write_lines(lines, path)
    assert sorted(map(tuple, files.read_counts(spark, path).collect())) == [
        (1, 2, 1),
        (1, 10, 2),
        (2, 2, 1),
    ]


def test_dense_files(spark):
    rows = spark.createDataFrame(
        [(1, [0.5, -0.0000001]), (2, [1.0, 2.0])], "doc_id bigint, vector array<double>"
    )
    lines = files.dense_lines(rows)
    assert {r["line"] for r in lines.collect()} == {"#1,0.500000,0.000000", "#2,1.000000,2.000000"}
    path = fresh_path(spark, "test")
    files.write_lines(lines, path)
    assert as_dict(files.read_dense(spark, path)) == {1: [0.5, 0.0], 2: [1.0, 2.0]}
    uneven = rows.withColumn("vector", F.when(F.col("doc_id") == 1, F.col("vector")).otherwise(F.array(F.lit(1.0))))
    with pytest.raises(ValueError):
        files.one_width(uneven)


def test_assembled_vectors(spark, corpus):
    entries = spark.createDataFrame(
        [(1, 3, 2.0), (1, 0, 1.0), (2, 1, 0.0), (9, 1, 5.0)], "doc_id bigint, idx bigint, value double"
    )
    both = features.side_by_side([Block(entries, 4), Block(entries, 4)])
    rows = {r["doc_id"]: r["features"] for r in features.assembled(corpus, both).collect()}
    assert both.width == 8 and set(rows) == {1, 2, 3}
    assert rows[1].toArray().tolist() == [1, 0, 0, 2, 1, 0, 0, 2]
    assert rows[2].toArray().sum() == 0 and rows[3].size == 8

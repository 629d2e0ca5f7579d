import random
import statistics

import pytest
from pyspark.sql import functions as F

from reviewmill.functions import values
from reviewmill.operators import features, ordering, profile
from reviewmill.session import fresh_path
from reviewmill.sources import tables, vocabulary, wordlists


def test_exact_quantiles_over_many_partitions(many_partitions):
    draw = random.Random(3)
    groups = {
        "hot": [5.0] * 400 + [draw.random() * 9 for _ in range(201)],
        "few": [1.0, 2.0, 3.0, 10.0],
        "one": [7.0],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("few", None)]
    table = many_partitions.createDataFrame(rows, "g string, v double")
    probs = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    found = ordering.exact_quantiles(table, "v", probs, ["g"]).collect()
    assert {r["g"] for r in found} == set(groups)
    for row in found:
        held = groups[row["g"]]
        if len(held) == 1:
            expected = held * 3
        else:
            expected = statistics.quantiles(held, n=4, method="inclusive")
        assert [row["q1"], row["median"], row["q3"]] == pytest.approx(expected)


def test_ordinals_and_running_totals(many_partitions):
    rows = [(g, i, (i * 7) % 5) for g in ("x", "y") for i in range(50)]
    table = many_partitions.createDataFrame(rows, "g string, k int, v int").repartition(8)
    placed = ordering.with_ordinal(table, ["k"], "at", within=["g"])
    assert placed.where("at != k").count() == 0 and placed.count() == 100
    whole = ordering.with_ordinal(table, ["g", "k"], "at")
    assert sorted(r["at"] for r in whole.collect()) == list(range(100))
    running = ordering.with_running_total(table, "v", ["k"], ["g"], "total")
    expected = {(g, i): sum((j * 7) % 5 for j in range(i + 1)) for g, i, _ in rows}
    assert {(r["g"], r["k"]): r["total"] for r in running.collect()} == expected


def test_median_fill_and_scores(spark):
    table = spark.createDataFrame(
        [(1, 1.0, 5.0), (2, 2.0, 5.0), (3, 3.0, 5.0), (4, 10.0, 5.0), (5, None, None)],
        "doc_id bigint, a double, b double",
    )
    filled = profile.with_medians_filled(table, ["a", "b"]).where("doc_id = 5").first()
    assert (filled["a"], filled["b"]) == (2.5, 5.0)
    scored = features.numeric_features(table.where("doc_id < 5"), ["a", "b"], []).orderBy("doc_id")
    rows = scored.collect()
    assert [round(r["a"], 4) for r in rows] == [-0.8485, -0.5657, -0.2828, 1.6971]
    assert [r["b"] for r in rows] == [0.0] * 4


def test_correlations(spark):
    table = spark.createDataFrame([(1, 5, 2), (2, 5, 4), (5, 5, 10)], "a int, b int, c int")
    found = {(r["a"], r["b"]): r["r"] for r in profile.correlations(table, ["a", "b", "c"]).collect()}
    assert found[("a", "c")] == pytest.approx(1) and found[("a", "a")] == pytest.approx(1)
    assert found[("a", "b")] is None and found[("b", "b")] is None


def test_dates(spark):
    rows = [("01-02-2019", True), ("05-06-2019", False), ("07-08-2020", True), ("31-12-2016", True)]
    table = spark.createDataFrame(rows, "review_date string, is_a_buyer boolean")
    counts = {tuple(r) for r in profile.yearly_counts(table).collect()}
    assert counts == {(2019, 1, 1), (2020, 1, 0), (2016, 1, 0)}
    bad = table.unionByName(
        spark.createDataFrame([("31-31-2019", True), (None, True)], table.schema)
    )
    assert profile.since_year(bad, 2017).count() == 3
    report = profile.since_year_report(bad, 2017).first()
    assert (report["total"], report["kept"], report["dropped"], report["without_date"]) == (6, 3, 3, 2)
    with pytest.raises(Exception, match="31-31-2019"):
        profile.yearly_counts(bad).collect()


def test_labels(spark):
    table = spark.createDataFrame([("True",), ("FALSE",)], "flag string")
    codes = table.select(values.label_code(F.col("flag")).alias("label"))
    assert [r["label"] for r in codes.collect()] == [1, 0]
    wrong = spark.createDataFrame([("yes",)], "flag string")
    with pytest.raises(Exception, match="not a label: yes"):
        wrong.select(values.label_code(F.col("flag"))).collect()


def test_one_hot_with_null_and_unseen(spark):
    table = spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "b")], "doc_id bigint, brand string")
    known = features.categories(table, "brand")
    assert [r["value"] for r in known.orderBy("code").collect()] == ["a", "b", None]
    new = table.unionByName(spark.createDataFrame([(5, "new")], table.schema))
    hot = {r["doc_id"]: r["idx"] for r in features.one_hot(new, "brand", known).collect()}
    assert hot == {1: 1, 2: 2, 3: 0, 4: 1}


def test_histogram_of_one_value(spark):
    table = spark.createDataFrame([(3.0, 0.0, True), (3.0, 10.0, True), (None, 9.9, False)], "a double, b double, y boolean")
    found = {tuple(r) for r in profile.class_histograms(table, ["a", "b"], "y", 10).collect()}
    assert found == {("a", "true", 0, 2), ("b", "true", 0, 1), ("b", "true", 9, 1), ("b", "false", 9, 1)}


def test_csv_round_trip(spark):
    row = {f.name: None for f in tables.REVIEW_SCHEMA}
    row |= {
        "doc_id": 1,
        "review_text": 'line one\nline "two", with comma\\ and\ttab\r\nand  end ',
        "price": 2.5,
        "is_a_buyer": True,
    }
    reviews = spark.createDataFrame([row], tables.REVIEW_SCHEMA)
    path = fresh_path(spark, "test")
    tables.write_reviews(reviews, path, "csv")
    assert tables.read_reviews(spark, path).collect() == reviews.collect()


def test_word_list_and_vocabulary_files(spark):
    path = fresh_path(spark, "test")
    wordlists.write_word_list(
        spark.createDataFrame([(" The",), ("the",), ("",), ("And ",)], "word string"), path
    )
    assert sorted(r["word"] for r in wordlists.read_word_list(spark, path).collect()) == ["and", "the"]
    path = fresh_path(spark, "test")
    known = spark.createDataFrame([("a:b", 0), ("c", 1)], "term string, idx bigint")
    vocabulary.write_vocabulary(known, path)
    assert vocabulary.read_vocabulary(spark, path).collect() == known.collect()

"""Certificates of models, statistics inside folds, date formats, file contracts, long word lists, entry point."""

import math
import os
import subprocess
import sys
import time
from pathlib import Path

from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from reviewmill.operators import certificates, dates, infold, models, profile, terms
from reviewmill.session import fresh_path
from reviewmill.sources import checks
from reviewmill.sources import vectors as vector_files

ROOT = Path(__file__).resolve().parents[1]


def training(spark, n=120):
    rows = [(i, Vectors.dense([float(i % 5), float(i % 3)]), int((i % 5 > 2) != (i % 3 == 1) or i % 7 == 0), i % 3) for i in range(n)]
    return spark.createDataFrame(rows, ["doc_id", "features", "label", "fold"]).withColumn("fold", F.col("fold").cast("int"))


def test_a_wrong_model_gets_no_certificate(spark):
    rows = training(spark)
    cells = [(i, j, v) for i in range(120) for j, v in enumerate([float(i % 5), float(i % 3)])]
    entries = spark.createDataFrame(cells, "doc_id bigint, idx bigint, value double")
    dealt = rows.select("doc_id", "label", "fold")

    def furthest(make):
        proof = certificates.stationarity(entries, dealt, models.fitted_by_fold(rows, make))
        assert proof.count() == 3 * 3
        return proof.agg(F.max(F.abs(F.col("observed") - F.col("fitted")))).first()[0]

    assert furthest(lambda n: models.logistic_regression(n, tol=1e-12)) < 1e-4
    # Another penalty is another optimum.
    assert furthest(lambda n: models.logistic_regression(n, c=0.01, tol=1e-12)) > 1


def test_replayed_tree(spark):
    rows = training(spark)
    model = models.decision_tree(120, depth=4).fit(rows)
    nodes = certificates.node_table(model, spark).withColumn("fold", F.lit(9))
    plain = spark.createDataFrame(
        [(r["doc_id"], r["label"], 9, r["features"].toArray().tolist()) for r in rows.collect()],
        "doc_id bigint, label int, fold int, values array<double>",
    )
    passed = certificates.routed(plain, nodes, 4)
    said = {r["doc_id"]: r["prediction"] for r in model.transform(rows).collect()}
    leaves = passed.where("left IS NULL").collect()
    assert {r["doc_id"]: r["prediction"] for r in leaves} == said and len(leaves) == 120
    gains = certificates.split_gains(passed).collect()
    assert len(gains) == model.numNodes // 2
    assert max(len(r["path"]) for r in gains) >= 2
    exported = {round(r["gain"], 9) for r in spark.read.parquet(_saved(model, spark)).where("leftChild >= 0").collect()}
    assert {round(r["gain"], 9) for r in gains} == exported
    assert all(abs(r["gain"] - r["best_gain"]) < 1e-9 for r in gains)


def _saved(model, spark):
    path = fresh_path(spark, "tree")
    model.write().save(path)
    return f"{path}/data"


def test_statistics_inside_folds(spark):
    dealt = spark.createDataFrame([(i, i % 3) for i in range(10)], "doc_id bigint, fold int")
    table = spark.createDataFrame([(i, None if i == 4 else float(i * i % 11)) for i in range(12)], "doc_id bigint, x double")
    found = {r["fold"]: r for r in infold.numbers(table, dealt, ["x"]).collect()}
    for fold in range(3):
        values = sorted(float(i * i % 11) for i in range(10) if i % 3 != fold and i != 4)
        mean = sum(values) / len(values)
        assert found[fold]["n"] == len(values)
        assert math.isclose(found[fold]["mean"], mean)
        assert math.isclose(found[fold]["std"], math.sqrt(sum((v - mean) ** 2 for v in values) / len(values)))
        middle = (values[(len(values) - 1) // 2] + values[len(values) // 2]) / 2
        assert found[fold]["median"] == middle
    pairs = spark.createDataFrame([(0, "a", 1), (3, "a", 2), (1, "b", 1), (0, "b", 1), (11, "c", 1)], "doc_id bigint, term string, tf bigint")
    got = {(r["fold"], r["term"]): r["df"] for r in infold.idf(pairs, dealt).collect()}
    # "a" is in fold 0 alone, so its training set does not know it; "c" is in no fold.
    assert got == {(1, "a"): 2, (2, "a"): 2, (0, "b"): 1, (1, "b"): 1, (2, "b"): 2}


def test_density(spark):
    table = spark.createDataFrame([(float(i), i % 2 == 0, 3.0) for i in range(41)] + [(None, True, 3.0), (1.0, None, 3.0)], "x double, c boolean, same double")
    rows = profile.class_densities(table, ["x", "same"], "c", points=201).collect()
    assert {r["column"] for r in rows} == {"x"}
    for flag in ("true", "false"):
        mine = sorted((r["x"], r["density"]) for r in rows if r["class"] == flag)
        step = mine[1][0] - mine[0][0]
        assert 0.75 < sum(d for _, d in mine) * step < 1  # the tails lie beyond the range
        assert mine[100][1] > 1.5 * mine[0][1]


def test_date_formats(spark):
    texts = ["31-01-2020", "05-06-2021", "12-31-2020", "07-07-2020", "nonsense", "", None]
    table = spark.createDataFrame([(t,) for t in texts], "d string")
    votes = {r["format"]: r for r in dates.format_votes(table, "d", ["MM-dd-yyyy", "dd-MM-yyyy", "yyyy"]).collect()}
    day = votes["dd-MM-yyyy"]
    assert (day["parsed"], day["alone"], day["ambiguous"], day["elected"]) == (3, 1, 1, False)
    # Equal in all counts: the first given is elected.
    assert votes["MM-dd-yyyy"]["elected"] and not votes["yyyy"]["elected"]
    assert dates.elected_format(table, "d", ["yyyy", "dd-MM-yyyy"]) == "dd-MM-yyyy"
    assert dates.elected_format(table.where("d IS NULL"), "d", ["yyyy"]) is None
    assert dates.elected_format(table.limit(0), "d", ["yyyy"]) is None


def problems(frame):
    return sorted((r["reason"], r["line"]) for r in frame.collect())


def test_vocabulary_contract(spark):
    path = fresh_path(spark, "v")
    lines = ["a:0", "b:1", "no index", "c:3", "bb:4", "d:5", "d:6", "e:6", "", "x:99999999999999999999"]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    assert problems(checks.vocabulary_problems(spark, path)) == sorted(
        [("malformed", ""), ("malformed", "no index"), ("malformed", "x:99999999999999999999"), ("missing index", "2"), ("out of order", "bb:4"),
         ("out of order", "d:6"), ("repeated index", "d:6"), ("repeated index", "e:6"), ("repeated term", "d:5"), ("repeated term", "d:6")]
    )
    assert checks.vocabulary_problems(spark, path).where("reason = 'malformed'").first()["file"].startswith("part-")


def test_vector_contract(spark):
    path = fresh_path(spark, "c")
    long = "#6," + ",".join(f"{i}:1" for i in range(5000))
    lines = ["#1,0:2,3:1", "#2,", "#3,1:0", "#4,2:1,2:1", "#5,9000:1", "#7,1:1", "#2,", "junk", long]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    docs = spark.createDataFrame([(i,) for i in (1, 2, 3, 4, 5, 6, 8)], "doc_id bigint")
    assert problems(checks.count_vector_problems(spark, path, docs, 6000)) == sorted(
        [("index too large", "#5,9000:1"), ("malformed", "#3,1:0"), ("malformed", "junk"), ("missing document", "3"), ("missing document", "8"),
         ("repeated document", "#2,"), ("repeated document", "#2,"), ("unknown document", "#7,1:1"), ("unordered indexes", "#4,2:1,2:1")]
    )


def test_negative_ids_are_read_back(spark):
    path = fresh_path(spark, "n")
    spark.createDataFrame([("#-4,1:2",)], "value string").write.text(path)
    assert [tuple(r) for r in vector_files.read_counts(spark, path).collect()] == [(-4, 1, 2)]


def test_lists_of_any_length(spark, monkeypatch):
    docs = spark.createDataFrame([(1, ["w7", "x", "w7", "w4999", ""]), (2, []), (3, ["y"])], "doc_id bigint, tokens array<string>")
    words = spark.range(5000).select(F.concat(F.lit("w"), "id").alias("word")).union(spark.createDataFrame([(None,), ("",), ("w7",)], "word string"))
    for size in (terms.LIST_BYTES, 20_000):
        left = {r["doc_id"]: r["tokens"] for r in terms.drop_words(docs, words, size).collect()}
        assert left == {1: ["x"], 2: [], 3: ["y"]}
    none = {r["doc_id"]: r["tokens"] for r in terms.drop_words(docs, words.limit(0)).collect()}
    assert none[1] == ["w7", "x", "w7", "w4999", ""]


def test_entry_point_without_the_optional_part(tmp_path):
    """A copy of the repository's code without the subpackage, with and without the pipeline."""
    for kept in (["corpus_pipeline.py"], []):
        home = tmp_path / f"copy{len(kept)}"
        (home / "reviewmill").mkdir(parents=True)
        for part in (ROOT / "reviewmill").iterdir():
            if part.name != "llm":
                os.symlink(part, home / "reviewmill" / part.name)
        for name in ("__spark_entry__.py", *kept):
            os.symlink(ROOT / name, home / name)
        code = (
            "import importlib.util as u, sys; sys.path.insert(0, '.'); sys.dont_write_bytecode = True\n"
            "s = u.spec_from_file_location('__spark_entry__', '__spark_entry__.py'); m = u.module_from_spec(s); s.loader.exec_module(m)\n"
            "assert len(m.queries()) > 80 and not [q for q in m.queries() if q.startswith('op') or q == 'pipeline'], m.queries().keys()\n"
        )
        env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
        done = subprocess.run([sys.executable, "-c", code], cwd=home, env=env, capture_output=True, text=True, timeout=120)
        assert done.returncode == 0, done.stderr


def test_long_lines_of_counts_are_checked_in_one_pass(spark):
    n = 40_000
    good = ",".join(f"{i}:1" for i in range(n))
    path = fresh_path(spark, "long-lines")
    lines = [f"#1,{good}", f"#2,{good},{n - 1}:2", f"#3,{good},{n}:1", f"#4,{good},x", "#5,"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    documents = spark.range(1, 6).withColumnRenamed("id", "doc_id")
    began = time.monotonic()
    found = checks.count_vector_problems(spark, path, documents, n).collect()
    # Arrays computed anew for every entry took time by the square of a line's entries.
    assert time.monotonic() - began < 60
    assert sorted((r["reason"], r["line"][:3]) for r in found) == [
        ("index too large", "#3,"), ("malformed", "#4,"), ("missing document", "4"), ("unordered indexes", "#2,"),
    ]

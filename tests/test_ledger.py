"""A model comparison that stops in the middle and goes on gives what one run gives."""

import pytest
from pyspark.sql import functions as F

from reviewmill.operators import models
from reviewmill.operators.features import Block
from reviewmill.plans import grid
from reviewmill.plans.ledger import COMPLETE, Ledger, fingerprint, resumed_predictions
from reviewmill.session import fresh_path

KEY = ["scope", "representation", "model", "doc_id"]


@pytest.fixture
def inputs(spark):
    cells = [(i, j, float((i * (j + 3)) % 7)) for i in range(60) for j in range(2)]
    entries = spark.createDataFrame(cells, "doc_id bigint, idx bigint, value double")
    return {("a", "x"): Block(entries, 2), ("b", "x"): lambda: Block(entries.where("idx = 0"), 1)}


def labels(spark, shift=0):
    return spark.createDataFrame([(i, int((i + shift) % 7 > 2)) for i in range(60)], "doc_id bigint, label int")


def registry(fits, stops_at=None):
    def counted(name, depth):
        def make(n):
            fits.append(name)
            if len(fits) == stops_at:
                raise RuntimeError("stopped")
            return models.decision_tree(n, depth=depth)

        return make

    return {"one": counted("one", 1), "two": counted("two", 2)}


def rows_of(frame):
    return sorted(tuple(r) for r in frame.select(*KEY, "prediction", "score", "fold").collect())


def test_stopped_and_resumed(spark, inputs):
    whole = resumed_predictions(Ledger(spark, fresh_path(spark, "ledger")), inputs, labels(spark), registry([]), k=3)
    book, fits = Ledger(spark, fresh_path(spark, "ledger")), []
    with pytest.raises(RuntimeError, match="stopped"):
        # In the middle of the second configuration.
        resumed_predictions(book, inputs, labels(spark), registry(fits, stops_at=5), k=3)
    done = []
    again = resumed_predictions(book, inputs, labels(spark), registry(done), k=3)
    assert len(done) == 3 * 3 and rows_of(again) == rows_of(whole)
    assert again.groupBy(*KEY).count().where("count > 1").isEmpty() and again.count() == 4 * 60
    # Nothing is left to fit; the results follow from the ledger.
    none = []
    assert rows_of(resumed_predictions(book, inputs, labels(spark), registry(none), k=3)) == rows_of(whole)
    assert none == [] and grid.results(again).count() == 4
    # Other labels are other rows.
    resumed_predictions(book, {("a", "x"): inputs["a", "x"]}, labels(spark, 1), registry(none), k=3)
    assert len(none) == 6


def test_unfinished_entries_do_not_count(spark, inputs):
    book = Ledger(spark, fresh_path(spark, "ledger"))
    rows = grid.training_rows(inputs["a", "x"], labels(spark), 3)
    digest, config = fingerprint(rows), ("a", "x / y", "one")
    book.add(config, digest, rows.select("doc_id", "label"))
    assert book.has(config, digest) and book.read(config, digest).columns[:3] == list(grid.CONFIG)
    files, mark = book._files(f"{book.entry(config, digest)}/{COMPLETE}")
    files.delete(mark, False)
    assert not book.has(config, digest)
    assert fingerprint(rows.orderBy(F.desc("doc_id"))) == digest
    assert fingerprint(rows.withColumn("fold", F.lit(0))) != digest

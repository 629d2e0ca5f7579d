"""Written tables: who deletes them, what can be read back under another type, what CSV keeps."""

import os

from pyspark.sql import functions as F

from reviewmill import session
from reviewmill.sources import tables


def folders(table):
    return {os.path.dirname(f.removeprefix("file:").replace("///", "/", 1)) for f in table.inputFiles()}


def test_intermediates_are_deleted_at_the_end(spark):
    before = session.materialise(spark.range(3), "kept")
    with session.intermediates(spark):
        table = session.materialise(spark.range(5), "gone")
        (inside,) = folders(table)
        assert table.count() == 5 and os.path.isdir(inside)
    assert not os.path.exists(inside)
    (outside,) = folders(before)
    assert before.count() == 3
    session.forget(before)
    assert not os.path.exists(outside)


def test_forget_leaves_tables_of_others(spark, tmp_path):
    spark.range(4).write.parquet(f"{tmp_path}/mine")
    mine = spark.read.parquet(f"{tmp_path}/mine")
    session.forget(mine)
    assert mine.count() == 4


def test_shuffle_setting_is_put_back(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    session.materialise(spark.range(9).groupBy((F.col("id") % 2).alias("k")).count())
    assert spark.conf.get(key) == before


def test_csv_keeps_empty_and_missing_texts_apart(spark, tmp_path):
    names = tables.REVIEW_SCHEMA.fieldNames()
    row = {n: None for n in names}
    rows = [
        tuple({**row, "doc_id": i, "review_text": t}.values())
        for i, t in enumerate(("", None, 'a "quoted",\nline\r end', " spaced "))
    ]
    written = spark.createDataFrame(rows, tables.REVIEW_SCHEMA)
    tables.write_reviews(written, f"{tmp_path}/csv", "csv")
    back = tables.read_reviews(spark, f"{tmp_path}/csv")
    assert sorted(map(tuple, back.collect())) == sorted(rows)

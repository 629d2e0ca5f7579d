"""The review table over the given parquet tables, one review per document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CUTOFF_YEAR = 1997

_ALL = (
    "review_id", "product_id", "review_title", "review_text", "review_rating", "review_date",
    "author", "is_a_buyer", "price", "avg_product_rating", "product_rating_count", "brand_name",
    "product_title", "product_url", "product_tags",
)


def reviews(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """``doc_id`` and the asked review columns (default all); joins only the tables they need.

    A review's product is the smallest part key in the order with the review's key, its rating that of all
    line items of the part. Orders without line items leave product, price, rating and title unknown. A
    title is the part's name and the text of a ``benchmark`` item, whose passages ``documents`` quote.
    """
    wanted = columns or _ALL

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    sources = {
        "review_text": ("text",),
        "review_title": ("text",),
        "review_rating": ("n_chars",),
        "brand_name": ("source",),
    }
    read = dict.fromkeys(c for w in wanted for c in sources.get(w, ()))
    rows = spread(table("documents").select("doc_id", *read))
    if {"product_id", "price", "product_title", "avg_product_rating", "product_rating_count"} & set(wanted):
        products = (
            table("lineitem")
            .groupBy(F.col("l_orderkey").alias("doc_id"))
            .agg(F.min("l_partkey").alias("_product"))
        )
        rows = rows.join(products, "doc_id", "left")
    if "review_date" in wanted:
        dates = table("orders").select(
            F.col("o_orderkey").alias("doc_id"),
            F.date_format("o_orderdate", "dd-MM-yyyy").alias("review_date"),
        )
        rows = rows.join(dates, "doc_id", "left")
    if "is_a_buyer" in wanted:
        flags = table("labels").select("doc_id", (F.col("quality") == 1).alias("is_a_buyer"))
        rows = rows.join(flags, "doc_id", "left")
    if {"price", "product_title"} & set(wanted):
        parts = table("part").select(
            F.col("p_partkey").alias("_product"),
            F.col("p_retailprice").alias("price"),
            F.col("p_name").alias("_name"),
        )
        if "product_title" in wanted:
            items = table("benchmark").select(F.col("item_id").alias("_item"), F.col("text").alias("_words"))
            n = table("benchmark").agg(F.count(F.lit(1))).scalar()
            parts = parts.withColumn("_item", F.col("_product") % n).join(items, "_item", "left")
            parts = parts.withColumn("product_title", F.concat_ws(" ", "_name", "_words"))
        rows = rows.join(parts, "_product", "left")
    if {"avg_product_rating", "product_rating_count"} & set(wanted):
        ratings = (
            table("lineitem")
            .groupBy(F.col("l_partkey").alias("_product"))
            .agg(
                F.avg("l_quantity").alias("avg_product_rating"),
                F.count(F.lit(1)).alias("product_rating_count"),
            )
        )
        rows = rows.join(ratings, "_product", "left")
    made = {
        "review_id": F.col("doc_id").cast("string"),
        "product_id": F.col("_product").cast("string") if "product_id" in wanted else None,
        "review_title": F.regexp_extract("text", r"^[^.\n]*", 0) if "text" in read else None,
        "review_text": F.col("text") if "text" in read else None,
        "review_rating": (1 + F.col("n_chars") % 5).cast("double") if "n_chars" in read else None,
        "brand_name": F.col("source") if "source" in read else None,
        "author": F.lit(None).cast("string"),
        "product_url": F.lit(None).cast("string"),
        "product_tags": F.lit(None).cast("string"),
    }
    return rows.select(
        "doc_id", *[made[c].alias(c) if made.get(c) is not None else F.col(c) for c in wanted]
    )


def spread(rows: DataFrame) -> DataFrame:
    """The rows over all cores, if their scan has fewer parts than there are cores to work on them."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, label)`` of the labelled documents."""
    table = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return table.select("doc_id", F.col("quality").alias("label"))


def word_vectors(spark: SparkSession, sf_dir: str, vocabulary: DataFrame) -> DataFrame:
    """``(term, vector)``: stands in for a pretrained table that knows every vocabulary term."""
    embeddings = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    n = embeddings.agg(F.count(F.lit(1))).scalar()
    known = vocabulary.select("term", (F.col("idx") % n).alias("vec_id"))
    return known.join(embeddings, "vec_id").select("term", F.col("embedding").alias("vector"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prediction table over ``labels``: 27 configurations, five folds."""
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select(
        (F.col("doc_id") % 27).cast("int").alias("config"),
        (F.floor(F.col("doc_id") / 27) % 5).cast("int").alias("fold"),
        "doc_id",
        F.col("quality").alias("label"),
        F.col("toxic").alias("prediction"),
        ((F.col("doc_id") * 37 % 101) / F.lit(101.0)).alias("score"),
    )

"""Corpus-wide term statistics and the four token filters.

Documents are ``(doc_id, tokens)``: a long key and the ordered token array. Filters work on the array
inside its row; only per-term statistics and the few removed terms are shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.functions import text
from reviewmill.operators.lookup import lookup
from reviewmill.session import materialise

# Words of a list that are taken at a time; a longer list is taken in several parts.
LIST_BYTES = 4 << 20
# Of a list, in a bucket.
BUCKET_WORDS = 2


def tokenized(reviews: DataFrame, column: str = "review_text") -> DataFrame:
    return reviews.select("doc_id", text.tokenize(F.col(column)).alias("tokens"))


def token_pairs(reviews: DataFrame, column: str = "review_text", least: int = text.MIN_LENGTH) -> DataFrame:
    """``(doc_id, term, tf)``: every long enough token of a text column, counted per document.

    Texts are dealt by ``doc_id`` first, so the tokens are counted where they are found and none is shuffled.
    """
    spark = reviews.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    dealt = reviews.select("doc_id", column).repartition(tasks, "doc_id")
    # Made lower in the row of a token: a lambda over the array would be interpreted.
    tokens = dealt.select("doc_id", F.explode(text.found(F.col(column))).alias("_token"))
    return (
        tokens.select("doc_id", F.lower("_token").alias("term"))
        .where(F.length("term") >= least)
        .groupBy("doc_id", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def term_stats(documents: DataFrame) -> DataFrame:
    """Per term: ``cnt`` occurrences, ``df`` documents, and ``first_doc``/``first_pos``.

    One scan and one shuffle of partial sums: behind the tokens of a document come its distinct
    tokens again, so positions past the end count documents and the others count occurrences. For a
    term with ``cnt`` 1, ``first_doc`` and ``first_pos`` are its only place in the corpus.
    """
    marked = documents.select(
        "doc_id",
        F.size("tokens").alias("length"),
        F.posexplode(F.concat("tokens", F.array_distinct("tokens"))).alias("pos", "term"),
    )
    occurrence = F.col("pos") < F.col("length")
    return marked.groupBy("term").agg(
        F.count_if(occurrence).alias("cnt"),
        F.count_if(~occurrence).alias("df"),
        F.min("doc_id").alias("first_doc"),
        F.min("pos").alias("first_pos"),
    )


def top_terms(stats: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` terms in most documents; equal counts in alphabetical order."""
    return stats.orderBy(F.desc("df"), "term").limit(k)


def keep_long(documents: DataFrame, least: int = text.MIN_LENGTH) -> DataFrame:
    return documents.withColumn("tokens", text.long_enough(F.col("tokens"), least))


def drop_words(documents: DataFrame, words: DataFrame, list_bytes: int = LIST_BYTES) -> DataFrame:
    """Drop the words of a one-column table from every token array; all other columns stay.

    The list comes to the rows as an array of buckets by hash, so a token is compared with the few words of its
    own bucket, whatever the length of the list, and no token is shuffled. Long lists come in parts of about
    ``list_bytes``. Null words list nothing.
    """
    word = F.col(words.columns[0])
    listed = words.select(word.alias("word")).where("word IS NOT NULL").distinct()
    n, total = listed.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("word").cast("bigint") + 16), F.lit(0))
    ).first()
    parts = max(1, math.ceil(total / list_bytes))
    buckets = max(1, n // (parts * BUCKET_WORDS))
    for part in range(parts):
        some = listed.where(F.pmod(F.xxhash64("word"), F.lit(parts)) == part)
        documents = _without_listed(documents, some, buckets)
    return documents


def _bucket(word, buckets: int):
    # Another seed than the one that deals the list into parts.
    return F.pmod(F.xxhash64(word, F.lit(1)), F.lit(buckets)).cast("int")


def _without_listed(documents: DataFrame, listed: DataFrame, buckets: int) -> DataFrame:
    filled = listed.groupBy(_bucket("word", buckets).alias("bucket")).agg(F.collect_list("word").alias("words"))
    every = listed.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    none = F.array().cast("array<string>")
    table = (
        every.join(filled, "bucket", "left")
        .agg(F.sort_array(F.collect_list(F.struct("bucket", F.coalesce("words", none).alias("words")))).alias("all"))
        .select(F.transform("all", lambda b: b["words"]))
    )
    # A column of its own, as a lambda cannot hold a subquery.
    unlisted = F.filter(
        "tokens", lambda t: ~F.array_contains(F.get("_known", _bucket(t, buckets)), t)
    )
    return documents.withColumn("_known", table.scalar()).withColumn("tokens", unlisted).drop("_known")


def occurrences_of(documents: DataFrame) -> DataFrame:
    """``(doc_id, pos, token)``, one row per token.

    The explode takes an expression: for a plain column Spark adds a not-empty filter and pushes it
    down to the scan, where the tokens would be made a second time.
    """
    tokens = F.slice("tokens", F.lit(1), F.size("tokens"))
    return documents.select("doc_id", F.posexplode(tokens).alias("pos", "token"))


def regrouped(occurrences: DataFrame, documents: DataFrame) -> DataFrame:
    """Token arrays again from ``(doc_id, pos, token)``; documents left without tokens get ``[]``."""
    # A group is one document, so it is no larger than an input row.
    arrays = occurrences.groupBy("doc_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "token"))), lambda o: o["token"])
        .alias("tokens")
    )
    return documents.select("doc_id").join(arrays, "doc_id", "left").select(
        "doc_id", F.coalesce("tokens", F.array().cast("array<string>")).alias("tokens")
    )


def drop_singletons(documents: DataFrame, stats: DataFrame) -> DataFrame:
    """Drop terms that occur once in the corpus.

    Each sits at one known place, so documents are joined on ``doc_id`` to the positions to leave
    out: token arrays may be shuffled by document, but no token by term.
    """
    gone = (
        stats.where("cnt = 1")
        .groupBy(F.col("first_doc").alias("doc_id"))
        .agg(F.collect_list("first_pos").alias("_gone"))
    )
    tokens = F.col("tokens")
    positions = F.sequence(F.lit(0), F.size(tokens) - 1)
    kept = F.transform(F.array_except(positions, F.col("_gone")), lambda at: F.get(tokens, at))
    return documents.join(gone, "doc_id", "left").select(
        "doc_id", F.when(F.col("_gone").isNull(), tokens).otherwise(kept).alias("tokens")
    )


def drop_top(documents: DataFrame, top: DataFrame) -> DataFrame:
    """Drop the terms of a top-k table from every token array."""
    return drop_words(documents, top.select("term"))


def stage_summary(reviews: DataFrame, stopwords: DataFrame, k: int = 20, column: str = "review_text"):
    """Token totals after each preparation step, from one table of term statistics.

    Every filter looks at a term only, so a step's total is a sum over the terms it keeps. The
    statistics are written once, as filters pushed below the token scan would tokenise twice.
    """
    stats = materialise(term_stats(tokenized(reviews, column)).select("term", "cnt", "df"), "terms")
    word = F.col(stopwords.columns[0])
    flags = stopwords.select(word.alias("term"), F.lit(True).alias("_listed")).distinct()
    # No hint: the word list is the smaller side, and AQE broadcasts it if it measures small.
    flagged = stats.join(flags, "term", "left")
    steps = [
        ("all tokens", F.lit(True)),
        ("without short words", F.length("term") >= text.MIN_LENGTH),
        ("without stop words", F.col("_listed").isNull()),
        ("without singletons", F.col("cnt") > 1),
    ]
    kept = F.lit(True)
    sums = []
    for i, (_, condition) in enumerate(steps):
        kept = kept & condition
        sums += [
            F.coalesce(F.sum(F.when(kept, F.col("cnt"))), F.lit(0)).alias(f"tokens_{i}"),
            F.count_if(kept).alias(f"terms_{i}"),
        ]
    top = top_terms(flagged.where(kept), k).agg(
        F.struct(
            F.coalesce(F.sum("cnt"), F.lit(0)).alias("tokens"),
            F.count(F.lit(1)).alias("terms"),
        )
    )
    totals = flagged.agg(*sums).withColumn("top", top.scalar())
    totals = totals.withColumn("n_reviews", reviews.agg(F.count(F.lit(1))).scalar())
    rows = [
        (name, F.col(f"tokens_{i}"), F.col(f"terms_{i}")) for i, (name, _) in enumerate(steps)
    ]
    last = len(steps) - 1
    rows.append(
        (
            f"without the {k} most common",
            F.col(f"tokens_{last}") - F.col("top.tokens"),
            F.col(f"terms_{last}") - F.col("top.terms"),
        )
    )
    entries = []
    for i, (name, tokens, terms) in enumerate(rows):
        before = rows[i - 1][1] if i else tokens
        entries.append(
            F.struct(
                F.lit(i + 1).alias("step_no"),
                F.lit(name).alias("step"),
                tokens.alias("total_tokens"),
                (before - tokens).alias("tokens_removed"),
                F.round(F.try_divide(100.0 * tokens, F.col("tokens_0")), 2).alias(
                    "percent_remaining"
                ),
                terms.alias("distinct_terms"),
                F.round(F.try_divide(tokens, F.col("n_reviews")), 2).alias("mean_tokens"),
            )
        )
    return totals.select(F.inline(F.array(*entries)))

"""Mapping surface terms to base forms over the distinct terms, then back onto the tokens."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions.porter import stem
from reviewmill.operators.dealt import beside
from reviewmill.operators.lookup import lookup
from reviewmill.operators.terms import occurrences_of, regrouped
from reviewmill.session import materialise

# Bytes of a group of documents whose tokens are replaced at once, and of a pair with all its tokens.
GROUP_BYTES = 128 * 1024 * 1024
PAIR_BYTES = 128

# Noun suffix rules of the WordNet morphology (morphy, public documentation).
NOUN_RULES = (
    ("s", ""),
    ("ses", "s"),
    ("ves", "f"),
    ("xes", "x"),
    ("zes", "z"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("men", "man"),
    ("ies", "y"),
)


def noun_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(NOUN_RULES), "suffix string, replacement string")


def lemma_map(
    terms: DataFrame, rules: DataFrame, lexicon: DataFrame, exceptions: DataFrame | None = None
) -> DataFrame:
    """``(term, lemma)`` for every distinct term.

    An exception ``(term, lemma)`` wins. Otherwise a rule replaces a matching suffix, candidates count
    if the lexicon ``(word)`` has them, the shortest wins, and without any the term stays. A term is
    its own candidate, as the lexicon may list it. Suffixes are matched by equality with the term's
    own endings, so rules are found by hash and not by comparing every term with every rule.
    """
    longest = rules.agg(F.max(F.length("suffix"))).scalar()
    endings = terms.select("term", longest.alias("_longest")).select(
        "term",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.least("_longest", F.greatest(F.length("term"), F.lit(1)))),
                lambda n: F.right("term", n),
            )
        ).alias("suffix"),
    )
    base = F.expr("left(term, length(term) - length(suffix))")
    by_rule = lookup(endings, rules, "suffix", "term").select(
        "term", F.concat(base, "replacement").alias("word")
    )
    itself = terms.select("term", F.col("term").alias("word"))
    listed = (
        by_rule.unionByName(itself)
        .where("word != ''")
        .join(lexicon.select("word").distinct(), "word", "left_semi")
    )
    found = listed.groupBy("term").agg(
        F.min(F.struct(F.length("word").alias("size"), "word"))["word"].alias("_found")
    )
    mapped = terms.join(found, "term", "left")
    if exceptions is None:
        return mapped.select("term", F.coalesce("_found", "term").alias("lemma"))
    special = exceptions.select("term", F.col("lemma").alias("_special"))
    return mapped.join(special, "term", "left").select(
        "term", F.coalesce("_special", "_found", "term").alias("lemma")
    )


def stem_map(terms: DataFrame, column: str = "term") -> DataFrame:
    """Add the Porter stem of a column of distinct words."""
    return terms.withColumn("stem", stem(F.col(column)))


def written_form_map(
    terms: DataFrame,
    rules: DataFrame | None = None,
    lexicon: DataFrame | None = None,
    exceptions: DataFrame | None = None,
) -> DataFrame:
    """``(term, form)``: lemma first if rules and lexicon are given, then stem; written once."""
    if rules is None or lexicon is None:
        return materialise(stem_map(terms).select("term", F.col("stem").alias("form")), "forms")
    lemmas = lemma_map(terms, rules, lexicon, exceptions)
    return materialise(
        stem_map(lemmas, "lemma").select("term", F.col("stem").alias("form")), "forms"
    )


def consolidated_pairs(pairs: DataFrame, forms: DataFrame) -> DataFrame:
    """``(doc_id, term, tf)`` with terms replaced by their form and counts added up."""
    return (
        lookup(pairs, forms, "term", "doc_id", "left")
        .groupBy("doc_id", F.coalesce("form", "term").alias("term"))
        .agg(F.sum("tf").alias("tf"))
    )


def consolidated_documents(documents: DataFrame, forms: DataFrame) -> DataFrame:
    """Token arrays with every token replaced by its form; order and duplicates stay."""
    by_token = forms.withColumnRenamed("term", "token")
    replaced = lookup(occurrences_of(documents), by_token, "token", "doc_id", "left").select(
        "doc_id", "pos", F.coalesce("form", "token").alias("token")
    )
    return regrouped(replaced, documents)


def replaced_tokens(
    documents: DataFrame, pairs: DataFrame, forms: DataFrame, group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """Token arrays with every token replaced by its form; tokens without a form are dropped, order stays.

    ``pairs`` are the written pairs of document and term. Documents meet the forms of their own terms in groups
    (``dealt.beside``), so no token is shuffled apart from its document.
    """

    def replaced(texts: pa.Table, known: pa.Table) -> pa.Table:
        tokens = texts["tokens"].combine_chunks()
        at = pc.index_in(tokens.flatten(), value_set=known["term"].combine_chunks())
        doc = pc.list_parent_indices(tokens).filter(pc.is_valid(at)).to_numpy()
        ends = np.cumsum(np.bincount(doc, minlength=len(tokens)))
        offsets = pa.array(np.concatenate([[0], ends]).astype("int32"))
        left = known["form"].combine_chunks().take(at.drop_null())
        return pa.table({"doc_id": texts["doc_id"], "tokens": pa.ListArray.from_arrays(offsets, left)})

    ddl = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, tokens array<string>"
    return beside(
        documents.select("doc_id", "tokens"), pairs.select("doc_id", "term"), forms.select("term", "form"),
        "term", PAIR_BYTES, group_bytes, replaced, ddl,
    )


def term_counts(pairs: DataFrame) -> DataFrame:
    """Occurrences and documents per term, from pairs."""
    return pairs.groupBy("term").agg(
        F.sum("tf").alias("cnt"), F.count(F.lit(1)).alias("df")
    )

"""Text preparation: from reviews to cleaned documents, their terms and the vocabulary."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.functions import text
from reviewmill.operators import coded, consolidate, terms, vectors, vocabulary
from reviewmill.operators.lookup import lookup
from reviewmill.session import materialise


def cleaned(reviews: DataFrame, stopwords: DataFrame, column: str = "review_text") -> DataFrame:
    """``(doc_id, tokens)`` without short words and stop words; no filter looks at the corpus."""
    return terms.drop_words(terms.keep_long(terms.tokenized(reviews, column)), stopwords)


@dataclass(frozen=True)
class Prepared:
    """The corpus after all filters.

    Each filter looks at a term only, so the terms left say all: ``coded`` and ``words`` hold every long enough token, written
    once (``coded.coded``), and a lookup of the words among ``terms`` filters them. ``common`` are all terms seen more than once.
    """

    reviews: DataFrame
    stopwords: DataFrame
    column: str
    top: int
    coded: DataFrame
    words: DataFrame
    terms: DataFrame
    common: DataFrame

    @cached_property
    def pairs(self) -> DataFrame:
        """``(doc_id, term, tf)`` of every long enough token, written."""
        every = self.words.select("part", "code", F.col("term").alias("value"))
        return materialise(coded.pairs_of(coded.recounted(self.coded, every), "term"), "token-pairs")

    @cached_property
    def documents(self) -> DataFrame:
        """``(doc_id, tokens)``: the surface forms left, by filters inside the rows."""
        documents = cleaned(self.reviews, self.stopwords, self.column)
        stats = materialise(terms.term_stats(documents), "terms")
        removed = terms.top_terms(stats.where("cnt > 1"), self.top)
        return terms.drop_top(terms.drop_singletons(documents, stats), removed)


def prepared(
    reviews: DataFrame, stopwords: DataFrame, column: str = "review_text", top: int = 20
) -> Prepared:
    """All four filters, on surface forms. The corpus is tokenised once, into coded documents and the words of their parts."""
    documents, words = coded.coded(reviews, column)
    word = F.col(stopwords.columns[0])
    listed = stopwords.select(word.alias("term")).where("term IS NOT NULL")
    sums = words.groupBy("term").agg(F.sum("cnt").alias("cnt"), F.sum("df").alias("df"))
    counted = sums.join(listed, "term", "left_anti")
    common = materialise(counted.where("cnt > 1"), "terms")
    removed = terms.top_terms(common, top)
    # At most `top` rows on the right.
    left = common.join(F.broadcast(removed.select("term")), "term", "left_anti").select("term")
    return Prepared(reviews, stopwords, column, top, documents, words, left, common.select("term"))


@dataclass(frozen=True)
class Stemmed:
    """The body after lemmas and stems: pairs, vocabulary, and the forms of all texts' terms.

    ``body_forms`` are those of the body's terms alone. The pairs are written when they are first asked for; the
    vocabulary and the titles do not need them.
    """

    corpus: Prepared
    forms: DataFrame
    body_forms: DataFrame
    vocabulary: DataFrame

    @cached_property
    def pairs(self) -> DataFrame:
        forms = coded.mapped(self.corpus.words, self.body_forms, "form")
        return materialise(coded.pairs_of(coded.recounted(self.corpus.coded, forms), "term"), "stemmed-pairs")

    @cached_property
    def index_of_words(self) -> DataFrame:
        """``(part, code, value)``: the vocabulary index of the words of every part, written."""
        return materialise(coded.mapped(self.corpus.words, self.indexed, "idx"), "indexed-words")

    @cached_property
    def lists(self) -> DataFrame:
        """``(part, doc_id, values, tfs)``: ``counts`` as a row per document, with ascending indexes."""
        return coded.recounted(self.corpus.coded, self.index_of_words)

    def lists_among(self, documents: DataFrame) -> DataFrame:
        some = documents.select("doc_id").distinct()
        return coded.recounted(self.corpus.coded.join(some, "doc_id", "left_semi"), self.index_of_words)

    @cached_property
    def counts(self) -> DataFrame:
        """``(doc_id, idx, tf)`` of the body over the vocabulary, straight from the terms."""
        return coded.pairs_of(self.lists, "idx")

    @cached_property
    def keyed(self) -> DataFrame:
        """``(doc_id, term, tf)`` of the body, written, with the vocabulary index as the term.

        Short keys of one size, for all that needs no name of a term.
        """
        return materialise(as_keys(self.counts), "keyed-pairs")

    @cached_property
    def indexed(self) -> DataFrame:
        """``(term, idx)``: the body's terms with the vocabulary index of their form."""
        return _indexed(self.body_forms, self.vocabulary)

    def pairs_of(self, documents: DataFrame) -> DataFrame:
        """``(doc_id, term, tf)`` of other token documents, under the same forms."""
        return materialise(
            consolidate.consolidated_pairs(vectors.term_pairs(documents), self.forms), "stemmed-pairs"
        )

    def counts_of(self, documents: DataFrame) -> DataFrame:
        return _indexed_counts(vectors.term_pairs(documents), _indexed(self.forms, self.vocabulary))

    def counts_among(self, documents: DataFrame) -> DataFrame:
        """``counts`` of the documents in a table, which need not be all that the vocabulary was made of."""
        return coded.pairs_of(self.lists_among(documents), "idx")

    def documents(self) -> DataFrame:
        """``(doc_id, tokens)`` of the body: every token left, in order, as its form."""
        corpus = self.corpus
        tokens = terms.keep_long(terms.tokenized(corpus.reviews, corpus.column))
        return consolidate.replaced_tokens(tokens, corpus.pairs, self.body_forms)


def as_keys(counts: DataFrame) -> DataFrame:
    return counts.select("doc_id", F.col("idx").alias("term"), "tf")


def _added(pairs: DataFrame, name: Column) -> DataFrame:
    return pairs.groupBy("doc_id", name).agg(F.sum("tf").alias("tf"))


def _indexed(forms: DataFrame, vocabulary: DataFrame) -> DataFrame:
    known = vocabulary.select(F.col("term").alias("form"), "idx")
    return materialise(forms.join(known, "form").select("term", "idx"), "indexed-terms")


def _indexed_counts(pairs: DataFrame, indexed: DataFrame) -> DataFrame:
    return _added(lookup(pairs, indexed, "term", "doc_id"), F.col("idx"))


def stemmed(
    corpus: Prepared, others: Sequence[DataFrame], rules: DataFrame, exceptions: DataFrame | None = None
) -> Stemmed:
    """Lemmas, then stems, over the distinct terms of the body and of ``others`` together.

    So a title's word counts under the body's stem, though the body may never have the word itself.
    The lemma lexicon is the body's terms seen more than once.
    """
    words = corpus.terms
    for documents in others:
        words = words.union(documents.select(F.explode("tokens").alias("term")))
    lexicon = corpus.common.select(F.col("term").alias("word"))
    forms = consolidate.written_form_map(
        materialise(words.distinct(), "all-terms"), rules, lexicon, exceptions
    )
    body_forms = materialise(corpus.terms.join(forms, "term"), "body-forms")
    known = body_forms.select(F.col("form").alias("term")).distinct()
    return Stemmed(corpus, forms, body_forms, vocabulary.build_vocabulary(known))


def processed_texts(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", text.joined(F.col("tokens")).alias("processed_text"))

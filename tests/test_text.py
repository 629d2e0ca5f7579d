import pytest
from pyspark.sql import functions as F

from reviewmill.functions import text
from reviewmill.functions.porter import porter_stem
from reviewmill.functions.stopwords import stopword_table
from reviewmill.operators import consolidate, terms, vectors, vocabulary
from reviewmill.plans import prepare
from reviewmill.plans.oracle import STOPWORDS

# Word pairs printed in Porter's paper.
PAPER = """
caresses caress ponies poni caress caress cats cat feed feed agreed agre plastered plaster bled bled
motoring motor sing sing conflated conflat troubled troubl sized size hopping hop tanned tan
falling fall hissing hiss fizzed fizz failing fail filing file happy happi sky sky relational relat
conditional condit rational ration valenci valenc hesitanci hesit digitizer digit
conformabli conform radicalli radic differentli differ vileli vile analogousli analog
vietnamization vietnam predication predic operator oper feudalism feudal decisiveness decis
hopefulness hope callousness callous formaliti formal sensitiviti sensit sensibiliti sensibl
triplicate triplic formative form formalize formal electriciti electr electrical electr hopeful hope
goodness good revival reviv allowance allow inference infer airliner airlin gyroscopic gyroscop
adjustable adjust defensible defens irritant irrit replacement replac adjustment adjust
dependent depend adoption adopt communism commun activate activ angulariti angular
homologous homolog effective effect bowdlerize bowdler probate probat rate rate cease ceas
controll control roll roll
""".split()


def documents(spark, *texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, review_text string")


def tokens_of(spark, *texts):
    rows = terms.tokenized(documents(spark, *texts)).orderBy("doc_id").collect()
    return [r["tokens"] for r in rows]


def test_tokenize(spark):
    assert tokens_of(
        spark,
        "This anti-aging cream! I don't.",
        "A-B-C o'neil's 12ab",
        None,
        "",
        "Kelvin İx",
    ) == [
        ["this", "anti-aging", "cream", "i", "don't"],
        ["a-b", "c", "o'neil", "s", "ab"],
        [],
        [],
        ["elvin", "x"],
    ]


def test_default_stopwords_are_those_of_the_oracle(spark):
    assert sorted(r["word"] for r in stopword_table(spark).collect()) == sorted(STOPWORDS)


def test_filters_keep_duplicates_and_order(spark):
    table = terms.tokenized(documents(spark, "aa bb aa cc", "bb bb", None))
    words = spark.createDataFrame([("bb",), (None,), ("bb",)], "word string")
    rows = {r["doc_id"]: r["tokens"] for r in terms.drop_words(table, words).collect()}
    assert rows == {0: ["aa", "aa", "cc"], 1: [], 2: []}


@pytest.mark.parametrize("list_bytes", [terms.LIST_BYTES, 20_000])
def test_long_list_keeps_columns_and_repeated_rows(spark, list_bytes):
    rows = [(1, ["w1", "aa", "w5999"], "x"), (1, ["bb", "w17"], "y"), (2, [], "z")]
    table = spark.createDataFrame(rows, "doc_id bigint, tokens array<string>, extra string")
    words = spark.createDataFrame([(f"w{i}",) for i in range(6000)] + [(None,)], "word string")
    kept = terms.drop_words(table, words, list_bytes)
    assert kept.columns == table.columns
    assert sorted(map(tuple, kept.collect())) == [(1, ["aa"], "x"), (1, ["bb"], "y"), (2, [], "z")]


def test_singletons_and_top_terms(spark):
    table = terms.tokenized(documents(spark, "one two two three", "three four", "four four", ""))
    stats = terms.term_stats(table)
    counted = {r["term"]: (r["cnt"], r["df"]) for r in stats.collect()}
    assert counted == {"one": (1, 1), "two": (2, 1), "three": (2, 2), "four": (3, 2)}
    kept = terms.drop_singletons(table, stats)
    rows = {r["doc_id"]: r["tokens"] for r in kept.collect()}
    assert rows == {0: ["two", "two", "three"], 1: ["three", "four"], 2: ["four", "four"], 3: []}
    top = terms.top_terms(stats.where("cnt > 1"), 1)
    assert [r["term"] for r in top.collect()] == ["four"]
    rows = {r["doc_id"]: r["tokens"] for r in terms.drop_top(kept, top).collect()}
    assert rows == {0: ["two", "two", "three"], 1: ["three"], 2: [], 3: []}


def test_stage_totals_fall_by_what_is_removed(spark):
    reviews = documents(spark, "The cream is a good cream", "good cream good skin x", "rare", None)
    rows = terms.stage_summary(reviews, stopword_table(spark), 1).orderBy("step_no").collect()
    assert [r["total_tokens"] for r in rows] == [12, 10, 8, 6, 3]
    for before, after in zip(rows, rows[1:]):
        assert after["tokens_removed"] == before["total_tokens"] - after["total_tokens"]
    assert rows[-1]["percent_remaining"] == 25.0


def test_stems_are_shared_by_body_and_titles(spark):
    reviews = documents(spark, "creams cream lotion bottles", "bottle bottles creams lotion", "alpha alpha")
    titles = terms.tokenized(documents(spark, "creams", "lotions", "unseen words"))
    corpus = prepare.prepared(reviews, stopword_table(spark), top=1)
    words = prepare.stemmed(corpus, [titles], consolidate.noun_rules(spark))
    body = consolidate.consolidated_documents(corpus.documents, words.forms)
    # 'bottles', 'creams' and 'lotion' are in two documents each; the first by name is the top term.
    assert {r["doc_id"]: r["tokens"] for r in body.collect()} == {
        0: ["cream", "lotion"], 1: ["cream", "lotion"], 2: ["alpha", "alpha"],
    }
    known = words.vocabulary.orderBy("idx").collect()
    assert [(r["term"], r["idx"]) for r in known] == [("alpha", 0), ("cream", 1), ("lotion", 2)]
    found = vectors.count_vectors(words.pairs_of(titles), words.vocabulary).collect()
    assert sorted(map(tuple, found)) == [(0, 1, 1), (1, 2, 1)]


@pytest.mark.parametrize("extended", [True, False])
def test_porter_examples(extended):
    pairs = list(zip(PAPER[::2], PAPER[1::2]))
    assert [(w, porter_stem(w, extended)) for w, _ in pairs] == pairs


def test_porter_additions():
    words = "skies dying ties tied using geology easily university difference".split()
    stems = "sky die tie tie use geolog easili univers differ".split()
    assert [porter_stem(w) for w in words] == stems
    assert [porter_stem(w) for w in ("works", "claims", "results")] == ["work", "claim", "result"]


def test_lemma_rules(spark):
    words = spark.createDataFrame([("creams",), ("bodies",), ("glass",), ("feet",)], "term string")
    rules = spark.createDataFrame([("s", ""), ("ies", "y")], "suffix string, replacement string")
    lexicon = spark.createDataFrame([("cream",), ("body",)], "word string")
    special = spark.createDataFrame([("feet", "foot")], "term string, lemma string")
    found = consolidate.lemma_map(words, rules, lexicon, special).collect()
    assert {r["term"]: r["lemma"] for r in found} == {
        "creams": "cream",
        "bodies": "body",
        "glass": "glass",
        "feet": "foot",
    }


def test_vocabulary_order_and_check(many_partitions):
    spark = many_partitions
    words = spark.createDataFrame([(w,) for w in ("b", "a's", "a-b", "ab", "b")], "term string")
    known = vocabulary.build_vocabulary(words.distinct())
    assert {r["term"]: r["idx"] for r in known.collect()} == {"a's": 0, "a-b": 1, "ab": 2, "b": 3}
    assert vocabulary.check_vocabulary(known).first()["valid"]
    shifted = known.withColumn("idx", (F.col("idx") + 1) % 4)
    report = vocabulary.check_vocabulary(shifted).first()
    assert report["out_of_order"] == 1 and not report["valid"]


def test_split_tokens(spark):
    row = spark.createDataFrame([(" a  b ", "", None)], "x string, y string, z string").select(
        *[text.split_tokens(F.col(c)).alias(c) for c in "xyz"]
    )
    assert row.first().asDict() == {"x": ["a", "b"], "y": [], "z": []}

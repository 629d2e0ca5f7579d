"""Held-out quality of the learned operators, and their edge cases."""

import random

import fixtures
import numpy as np
import pytest

from reviewmill.llm import language_id, quality_classifier, queries, toxicity

SF = "/root/testdata/sf0.01"


def auc(scores, labels):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(1, len(scores) + 1)
    ones = labels.sum()
    return (ranks[labels == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(labels) - ones))


@pytest.mark.parametrize(("name", "label", "least"), [("op6_quality_classifier", "quality", 0.97), ("op7_toxicity", "toxic", 0.8)])
def test_held_out(spark, name, label, least):
    result = queries.REGISTERED[name](spark, SF)
    docs = queries.table(spark, SF, "documents")
    assert result.count() == docs.count()
    held = result.where("held_out").join(queries.table(spark, SF, "labels"), "doc_id").toPandas()
    assert auc(held["score"].to_numpy(), held[label].to_numpy()) >= least
    assert ((held["score"] >= 0.3) == (held["predicted"] == 1)).all()
    assert held["score"].between(0, 1).all()


def test_language_held_out(spark):
    result = queries.REGISTERED["op10_language_id"](spark, SF)
    docs = queries.table(spark, SF, "documents").select("doc_id", "lang")
    held = result.where("held_out").join(docs, "doc_id").toPandas()
    assert (held["lang"] == held["lang_pred"]).mean() >= 0.97


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_edge_cases(spark):
    docs = fixtures.documents(spark)
    marked = labels(spark, [(1, 1, 0), (2, 1, 0), (14, 0, 1), (17, 0, 1), (4, 1, 0), (None, 1, 1), (9, None, None), (99, 1, 1)])
    model = quality_classifier.fit(docs, marked, "quality")
    rows = quality_classifier.scored(docs, model).collect()
    assert len(rows) == len(fixtures.rows()) and all(0 <= r["score"] <= 1 for r in rows)
    scores = {r["doc_id"]: r["score"] for r in rows}
    assert scores[14] < scores[1] and scores[5] == scores[6] == scores[7]
    fitted = toxicity.fit(docs, marked, "toxic")
    rows = toxicity.passages(docs, fitted).collect()
    assert len(rows) == len(fixtures.rows()) and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["doc_id"]: r["passages"] for r in rows}[5] == []


def test_without_labels(spark):
    docs = fixtures.documents(spark)
    for marked, quality, toxic in ((labels(spark, []), 0.5, 0.0), (labels(spark, [(1, 1, 0), (2, 1, 0)]), 1.0, 0.0)):
        rows = quality_classifier.scored(docs, quality_classifier.fit(docs, marked)).collect()
        assert all(abs(r["score"] - quality) < 0.01 for r in rows)
        rows = toxicity.passages(docs, toxicity.fit(docs, marked)).collect()
        assert all(abs(r["score"] - toxic) < 0.01 and r["passages"] == [] for r in rows)


def test_empty_tables(spark):
    none = fixtures.empty(spark)
    marked = labels(spark, [(1, 1, 0), (2, 0, 1)])
    assert quality_classifier.scored(none, quality_classifier.fit(none, marked)).collect() == []
    assert toxicity.passages(none, toxicity.fit(none, marked)).collect() == []
    assert language_id.identified(none, language_id.fit(none)).collect() == []


# Toxic passages ------------------------------------------------------------------------------------


def brute_segments(scores):
    """Maximal scoring segments by their definition: positive, and not extendable to a better one."""
    if not len(scores):
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    best, found = 0.0, None
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            if total[j] - total[i] > best + 1e-12:
                best, found = total[j] - total[i], (i, j)
    if found is None:
        return []
    i, j = found
    after = [(a + j, b + j, s) for a, b, s in brute_segments(scores[j:])]
    return [*brute_segments(scores[:i]), (i, j - 1, best), *after]


@pytest.mark.parametrize("seed", range(40))
def test_maximal_segments(seed):
    rng = np.random.default_rng(seed)
    scores = np.round(rng.normal(-0.3, 1, rng.integers(1, 40)), 3)
    upto = np.concatenate([[0.0], np.cumsum(scores)])
    found = toxicity.maximal_segments(np.flatnonzero(scores > 0).tolist(), upto, 0)
    expected = brute_segments(scores)
    assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in expected]
    assert np.allclose([s for _, _, s in found], [s for _, _, s in expected])


def test_planted_passages_are_found(spark):
    rng = random.Random(4)
    bad = ["grokk", "blarg", "snerx"]
    rows, marked = [], []
    for d in range(300):
        words = fixtures.words(d, 80).split(" ")
        if d % 3 == 0:
            at = rng.randrange(60)
            words[at : at + 4] = [rng.choice(bad) for _ in range(4)]
        rows.append((d, " ".join(words)))
        marked.append((d, 1, int(d % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    model = toxicity.fit(docs, labels(spark, marked), "toxic")
    for r in toxicity.passages(docs, model).collect():
        assert (r["score"] >= 0.3) == (r["doc_id"] % 3 == 0)
        for p in r["passages"]:
            words = rows[r["doc_id"]][1].split(" ")[p["first_word"] : p["last_word"] + 1]
            # A new word has the odds of its beginning.
            assert {words[0][:3], words[-1][:3]} <= {w[:3] for w in bad}


# Language identification -----------------------------------------------------------------------


def test_language_edge_cases(spark):
    rows = [(i, f"the house and the {fixtures.words(i, 20, 'thandeo')}", "aa") for i in range(30)]
    rows += [(100 + i, f"der weg und {fixtures.words(i, 20, 'zxqüßck')}", "bb") for i in range(30)]
    rows += [(200, None, "aa"), (201, "", None), (202, "123 456", "aa"), (203, "— ! 12", None)]
    rows += [(None, "the house and the deo", "aa"), (204, " ".join(["the house and"] * 3000), None)]
    switched = " ".join([r[1] for r in rows[:3]] + [rows[30][1]])
    rows += [(205, switched, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.fit(docs)
    found = {r["doc_id"]: r for r in language_id.identified(docs, model).collect()}
    assert len(found) == len(rows)
    for d in (200, 201, 202, 203):
        assert (found[d]["lang_pred"], found[d]["score"]) == ("und", 0.0)
    assert found[0]["lang_pred"] == found[204]["lang_pred"] == found[None]["lang_pred"] == "aa"
    assert found[100]["lang_pred"] == "bb"
    shares = found[205]["shares"]
    assert 0.6 < shares["aa"] < 0.9 and abs(sum(shares.values()) - 1) < 1e-6


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(2)
    lengths, n = [5, 3, 1], 3
    words = [rng.random((k, n)) + 0.1 for k in lengths]
    step = rng.random((n, n)) + 0.1
    potential = [np.stack([w[t] for w in words if len(w) > t]) for t in range(5)]
    found = language_id.marginals(potential, step)[2]
    for i, w in enumerate(words):
        exact = np.zeros((len(w), n))
        for path in np.ndindex(*[n] * len(w)):
            p = np.prod([w[t, y] for t, y in enumerate(path)]) * np.prod([step[a, b] for a, b in zip(path, path[1:])])
            for t, y in enumerate(path):
                exact[t, y] += p
        exact /= exact.sum(axis=1, keepdims=True)
        assert np.allclose([found[t][i] for t in range(len(w))], exact)


def test_lanes_of_long_texts_agree_with_one_lane(spark, monkeypatch):
    rows = [(i, fixtures.words(i, 40, "thandeo"), "aa") for i in range(20)]
    rows += [(100 + i, fixtures.words(i, 40, "zxqck"), "bb") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language_id.fit(docs)
    import pyarrow as pa

    from reviewmill.llm import arrays

    text = " ".join(r[1] for r in rows)
    some = next(arrays.slices(pa.array([text, "", text[:50]])))
    whole = language_id.Labeller(model).sums(some)
    for lane in (200, 37, 7, 1):
        monkeypatch.setattr(language_id, "LANE", lane)
        lanes = language_id.Labeller(model).sums(some)
        assert np.allclose(whole[0], lanes[0], rtol=0, atol=1e-9) and (whole[1] == lanes[1]).all()


def test_messages_at_lane_borders_equal_enumeration():
    rng = np.random.default_rng(5)
    n, words, step = 3, rng.random((6, 3)) + 0.1, rng.random((3, 3)) + 0.1
    exact = language_id.marginals([w[None] for w in words], step)[2]
    # Lanes of 3, 2 and 1 words of one row, longest first.
    parts = [words[:3], words[3:5], words[5:]]
    steps = [np.stack([p[t] for p in parts if len(p) > t]) for t in range(3)]
    matrices = language_id.products(steps, step, np.array([True, False, False]))
    borders = language_id.border_messages(matrices, step, [np.arange(3)])
    found = language_id.marginals(steps, step, *borders)[2]
    got = [found[t][i] for i, p in enumerate(parts) for t in range(len(p))]
    assert np.allclose(got, [e[0] for e in exact], rtol=0, atol=1e-12)


def test_sampled_rows_are_learned_from_their_first_to_their_last_word(spark):
    rows = [(i, " ".join(["zzyzx"] * 3000 + [fixtures.words(i, 3, "abc"), "qqvist"]), "aa") for i in range(4)]
    rows += [(10 + i, fixtures.words(i, 30, "def"), "bb") for i in range(4)]
    model = language_id.fit(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    import pyarrow as pa

    from reviewmill.llm import arrays
    from reviewmill.llm.decontamination import words_of

    last = words_of(next(arrays.slices(pa.array(["qqvist"]))))[4]
    assert np.isin(last, model.lexicon).all()

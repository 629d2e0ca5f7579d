import random
import re

import fixtures
import pytest

from reviewmill.llm import passage_dedup, queries


def split(text):
    return [w for w in re.split("[ \t-\r]+", text or "") if w]


def brute(texts, window=20):
    """Words, removed words and the rest of each text; rows of one id and one text are one document."""
    order = {}
    first = {}
    hashed = {}
    for doc, text, tie in texts:
        order[doc is None, doc or 0, tie] = split(text)
        hashed[doc, text] = (doc is None, doc or 0, tie)
    for key in sorted(order):
        words = order[key]
        for p in range(len(words) - window + 1):
            first.setdefault(tuple(words[p : p + window]), (key, p))
    out = []
    for doc, text, _ in texts:
        words, gone = split(text), set()
        for p in range(len(words) - window + 1):
            if first[tuple(words[p : p + window])] != (hashed[doc, text], p):
                gone.update(range(p, p + window))
        out.append((str(doc), len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return sorted(out)


def check(spark, docs, window=20):
    keys = docs.selectExpr("doc_id", "text", "xxhash64(doc_id IS NULL, text) AS tie").collect()
    rows = passage_dedup.deduplicated(docs, window, made="s").collect()
    got = sorted((str(r["doc_id"]), r["s"]["n_words"], r["s"]["n_removed"], r["s"]["kept"]) for r in rows)
    assert got == brute([tuple(k) for k in keys], window)
    return got


def test_edge_cases(spark):
    docs = fixtures.documents(spark)
    check(spark, docs)
    assert passage_dedup.deduplicated(docs, made="s").columns == [*docs.columns, "s"]


def test_repeated_and_missing_ids(spark):
    text = fixtures.words(1, 60)
    other = fixtures.words(2, 15) + " " + text
    texts = [(None, text), (None, other), (None, text + " x"), (7, text), (7, other), (7, other), ((1 << 63) - 1, text)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    got = check(spark, docs)
    assert sum(n - gone for _, n, gone, _ in got) < sum(n for _, n, _, _ in got)


def test_empty_table(spark):
    assert passage_dedup.deduplicated(fixtures.empty(spark)).collect() == []


def near_copies(n, seed):
    rng = random.Random(seed)
    base = split(fixtures.words(30, 80))
    out = []
    for d in range(n):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = rng.choice("XYZ")
        cut = rng.randrange(len(words))
        out.append((d, " \n".join(words[cut:] + split(fixtures.words(d % 7, 20)) + words[:cut])))
    return out


@pytest.mark.parametrize("group, shard", [(passage_dedup.GROUP, passage_dedup.SHARD_WORDS), (3, 200)])
def test_near_copies(spark, monkeypatch, group, shard):
    monkeypatch.setattr(passage_dedup, "GROUP", group)
    monkeypatch.setattr(passage_dedup, "SHARD_WORDS", shard)
    monkeypatch.setattr(passage_dedup, "CHUNK_WORDS", 300)
    texts = near_copies(60, 1) + [(100, "la " * 3000), (101, fixtures.words(15, 900) + " é" * 90)]
    check(spark, spark.createDataFrame(texts, "doc_id bigint, text string").repartition(5))


def test_matching_statistics():
    rng = random.Random(5)
    sequences = [[rng.choice("abc") for _ in range(rng.randint(1, 40))] for _ in range(30)]
    automaton, at, joined = passage_dedup.Automaton(), 0, []
    for sequence in sequences:
        automaton.add(sequence, at)
        joined.append((at, "".join(sequence)))
        at += len(sequence)
    for most in (3, 6, 50):
        text = "".join(rng.choice("abcd") for _ in range(200))
        lengths, firsts = automaton.statistics(text, most)
        for i in range(len(text)):
            n = max(n for n in range(min(most, i + 1) + 1) if any(text[i + 1 - n : i + 1] in s for _, s in joined))
            assert lengths[i] == n
            if n:
                want = text[i + 1 - n : i + 1]
                assert firsts[i] == min(a + s.index(want) + n - 1 for a, s in joined if want in s)


def test_query_equals_brute_force(spark):
    check(spark, queries.table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text"))

import hashlib
import random

import fixtures
import pytest

from reviewmill.llm import queries, substring_dedup

LAST = substring_dedup.LAST_ID


def brute(texts, ties=None, length=100):
    """Bytes, removed bytes, runs and the rest of each text, window by window.

    ``ties`` orders different texts of one id; rows of one id and one text are one document.
    """
    key = {(d, t): (LAST if d is None else d, d is None, (ties or {}).get((d, t), 0)) for d, t in texts}
    first = {}
    for (d, t), place in sorted(key.items(), key=lambda x: (x[1][0], x[1][2])):
        text = (t or "").encode()
        for p in range(len(text) - length + 1):
            first.setdefault(text[p : p + length], (place, p))
    out = []
    for doc, text in texts:
        data, gone = (text or "").encode(), set()
        upto = 0
        for p in range(len(data) - length + 1):
            if first[data[p : p + length]] != (key[doc, text], p):
                gone.update(range(max(p, upto), p + length))
                upto = p + length
        runs = sum(1 for p in gone if p - 1 not in gone)
        kept = bytes(c for p, c in enumerate(data) if p not in gone)
        out.append((str(doc), len(data), len(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(docs, **how):
    rows = substring_dedup.deduplicated(docs, made="s", **how).collect()
    return sorted(
        (str(r["doc_id"]), r["s"]["n_bytes"], r["s"]["n_removed"], r["s"]["n_spans"], hashlib.sha256(r["s"]["kept"]).hexdigest())
        for r in rows
    )


def test_edge_cases(spark):
    docs = fixtures.documents(spark)
    assert found(docs) == brute(fixtures.texts())
    assert substring_dedup.deduplicated(docs, made="s").columns == [*docs.columns, "s"]


def test_repeated_and_missing_ids(spark):
    text = fixtures.words(1, 60)
    other = fixtures.words(2, 15) + " " + text
    texts = [(None, text), (None, other), (None, text + " x"), (7, text), (7, other), (7, other), (LAST, text)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(3)
    ties = {(r[0], r[1]): r[2] for r in docs.selectExpr("doc_id", "text", "xxhash64(doc_id IS NULL, text)").collect()}
    assert found(docs) == brute(texts, ties)


def test_empty_table(spark):
    assert substring_dedup.deduplicated(fixtures.empty(spark)).collect() == []


def near_copies(n, seed):
    rng = random.Random(seed)
    base = fixtures.words(30, 150)
    out = []
    for d in range(n):
        text = list(base)
        for _ in range(rng.randint(0, 12)):
            text[rng.randrange(len(text))] = rng.choice("XYZ")
        cut = rng.randrange(len(text))
        out.append((d, "".join(text[cut:]) + fixtures.words(d % 7, 20) + "".join(text[:cut])))
    return out


@pytest.mark.parametrize("group", [substring_dedup.GROUP, 5])
def test_near_copies(spark, monkeypatch, group):
    monkeypatch.setattr(substring_dedup, "GROUP", group)
    texts = near_copies(60, 1)
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(5)
    assert found(docs) == brute(texts)


def test_long_texts_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CHUNK", 1000)
    texts = near_copies(8, 2) + [(100, "la " * 2000), (101, fixtures.words(15, 900) + "é" * 300)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert found(docs) == brute(texts)


def test_lengths_at_the_threshold(spark):
    a, b = fixtures.words(40, 30)[:100], fixtures.words(41, 30)[:99]
    texts = [(1, "x" + a + "y"), (2, "z" + a + "w"), (3, "q" + b + "r"), (4, "s" + b + "t"), (5, a), (6, a + a)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    result = found(docs)
    assert result == brute(texts)
    assert [r[2] for r in result] == [0, 100, 0, 0, 100, 200]


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = [(r["doc_id"], r["text"]) for r in queries.table(spark, sf, "documents").collect()]
    rows = queries.REGISTERED["op9_substring_dedup"](spark, sf).collect()
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows)
    assert got == brute(texts)

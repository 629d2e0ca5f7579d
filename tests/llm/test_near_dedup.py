import random
import re

import fixtures
import pytest

from reviewmill.llm import graph, near_dedup, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(size))))


def brute(texts, size, percent=80):
    """Component and set size of each document, by comparing all pairs."""
    sets = {d: shingle_set(t, size) for d, t in texts}
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            one, other = sets[a], sets[b]
            if not one or not other or 100 * min(len(one), len(other)) < percent * max(len(one), len(other)):
                continue
            both = len(one & other)
            if 100 * both >= percent * (len(one) + len(other) - both):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d)) for d in ids}


def found(rows):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows.collect()}


@pytest.mark.parametrize("size", [2, 5])
def test_edge_cases(spark, size):
    docs = fixtures.documents(spark)
    result = near_dedup.components(docs, size)
    rows = result.collect()
    assert len(rows) == len(fixtures.rows())
    named = [(d, t) for d, t in fixtures.texts() if d is not None]
    expected = brute(named, size)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows if r["doc_id"] is not None} == expected
    for r in rows:
        assert r["kept"] == (r["doc_id"] == r["component_id"])
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None]


def test_empty_table(spark):
    assert near_dedup.components(fixtures.empty(spark)).collect() == []


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = [(r["doc_id"], r["text"]) for r in queries.table(spark, sf, "documents").collect()]
    assert found(queries.REGISTERED["op1_minhash_near_dedup"](spark, sf)) == brute(texts, 2)


def test_large_group_of_near_copies_in_blocks(spark, monkeypatch):
    """Copies of one text with more and more changes, compared in several blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rng = random.Random(5)
    base = fixtures.words(20, 90).split(" ")
    texts = []
    for d in range(150):
        copy = list(base)
        for _ in range(rng.randint(0, 16)):
            copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
        texts.append((d, " ".join(copy)))
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert found(near_dedup.components(docs, 2)) == brute(texts, 2)


def test_chain_of_links_is_one_component(spark):
    base = fixtures.words(21, 100).split(" ")
    texts = []
    for d in range(12):
        copy = list(base)
        for k in range(5 * d):
            copy[k] = f"x{k}"
        texts.append((d, " ".join(copy)))
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert {c for _, c in found(near_dedup.components(docs, 2)).values()} == {0}


def test_least_matches():
    for n, least in near_dedup.least_matches(80, 160, 1e-5):
        # Far below the expected 0.8 n, and growing with n.
        assert 0 < least < 0.8 * n
    assert [m for _, m in near_dedup.least_matches(80, 160, 1e-5)] == sorted(
        m for _, m in near_dedup.least_matches(80, 160, 1e-5)
    )


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (200, 201), (201, 200)]
    rows = graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    roots = {r["node"]: r["root"] for r in rows}
    assert roots == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)} | {200: 200, 201: 200}

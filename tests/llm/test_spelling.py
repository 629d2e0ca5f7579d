import random
import re
import zlib
from collections import Counter

import fixtures
import numpy as np
import pytest

from reviewmill.llm import queries, spelling

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def words_of(texts):
    counts = Counter()
    for doc, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]+", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 97 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            counts[word] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def brute(counts):
    """Every pair by its deletions: words are near if equal after one deletion at fitting places."""
    cut = {}
    for w in counts:
        for i in range(len(w)):
            cut.setdefault((w[:i], w[i + 1 :]), set()).add(w)
    near = {w: set() for w in counts}
    for (a, b), group in cut.items():
        for w in group:
            near[w] |= group - {w}
        if a + b in counts:
            near[a + b] |= group
            for w in group:
                near[w].add(a + b)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def found(frame):
    return sorted(tuple(r) for r in frame.select(*COLUMNS).collect())


def variants_of(n, seed):
    """Words that are one edit, an anagram or a swap away from each other, with accents and a long one."""
    rng = random.Random(seed)
    letters = "abcdeé÷ÿ"
    words = set()
    while len(words) < n:
        word = "".join(rng.choice(letters) for _ in range(rng.randint(5, 9)))
        words.add(word)
        i = rng.randrange(len(word))
        words |= {word[:i] + rng.choice(letters) + word[i + 1 :], word[:i] + word[i + 1 :] + word[i : i + 1], word[:i] + "a" + word[i:]}
    long = "".join(rng.choice(letters) for _ in range(3000))
    return {w: rng.randint(3, 60) for w in words if len(w) >= 5} | {long: 9, long[:77] + long[78:]: 4, "a" * 300: 7, "a" * 299 + "b": 3}


@pytest.mark.parametrize("cell, size", [(spelling.CELL, 1 << 22), (40, 1 << 22), (40, 100)])
def test_groups(spark, monkeypatch, cell, size):
    monkeypatch.setattr(spelling, "CELL_BYTES", size)
    monkeypatch.setattr(spelling.near_words, "__defaults__", (cell, 300))
    counts = variants_of(600, 1)
    rows = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(3)
    assert found(spelling.grouped(rows)) == brute(counts)


def test_points_find_all_in_reach():
    words = [w.encode("latin-1") for w in variants_of(900, 2) if len(w) == 7]
    points, vectors = spelling.Points(words), spelling._vectors(words)
    apart = np.abs(vectors[:, None].astype(int) - vectors[None].astype(int)).sum(axis=2)
    for radius in (0, 1, 2):
        met = {(int(a), int(b)) for v, w in points.within(vectors, radius) for a, b in zip(v, w)}
        assert met == set(zip(*(x.tolist() for x in np.nonzero(apart <= radius))))


def test_words_of_fixtures(spark):
    texts = [*fixtures.texts(), (30, "Ärger ärger ÉTÉÉÉ étéÉÉ straße strasse naïve×÷ " + "z" * 5000), (None, "slips " * 4)]
    texts += [(i, "Colour colour colours color " + "y" * 700) for i in range(400, 700)]
    docs = spark.createDataFrame([(i, t, 1, "a") for i, t in texts], "doc_id bigint, text string, n int, word string").repartition(4)
    assert found(spelling.variants(docs)) == brute(words_of(texts))


def test_empty_table(spark):
    assert spelling.variants(fixtures.empty(spark)).collect() == []


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = [(r["doc_id"], r["text"]) for r in queries.table(spark, sf, "documents").collect()]
    rows = queries.REGISTERED["op11_spelling_variants"](spark, sf)
    assert rows.columns == COLUMNS
    assert found(rows) == brute(words_of(texts))

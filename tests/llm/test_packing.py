import zlib
from collections import Counter

import fixtures
import numpy as np
import pytest
from tokenizers import Tokenizer

from reviewmill.llm import packing, queries


@pytest.fixture(scope="module")
def encode():
    tokenizer = Tokenizer.from_file(queries.tokenizer()[0])
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


def check(rows, texts, encode, capacity=packing.CAPACITY):
    """Pieces rebuild the documents' ids, sequences are full from 0 without gaps, and few."""
    expected = []
    for doc, text in texts:
        ids = [*encode(text), 2]
        short = len(ids) - (-(-len(ids) // capacity) - 1) * capacity
        cuts = [0, *range(short, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            data = np.array(ids[a:b], "<u4").tobytes()
            expected.append((doc, piece, a, b - a, zlib.crc32(data)))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert Counter(got) == Counter(expected)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_query(spark, encode):
    sf = "/root/testdata/sf0.001"
    texts = [(r["doc_id"], r["text"]) for r in queries.table(spark, sf, "documents").collect()]
    rows = queries.REGISTERED["op2_best_fit_packing"](spark, sf).collect()
    n = check(rows, texts, encode)
    assert n <= 1.02 * sum(r["length"] for r in rows) / packing.CAPACITY + 2


def test_edge_cases(spark, encode):
    rows = packing.packed(fixtures.documents(spark), *queries.tokenizer()).collect()
    check(rows, fixtures.texts(), encode)


def test_empty_table(spark):
    assert packing.packed(fixtures.empty(spark), *queries.tokenizer()).collect() == []


def best(counts, capacity):
    """The fewest bins, by trying all packings."""
    items = sorted((n for n, c in counts.items() for _ in range(c)), reverse=True)
    least = [len(items)]

    def go(i, gaps):
        if len(gaps) >= least[0]:
            return
        if i == len(items):
            least[0] = len(gaps)
            return
        for g in {g for g in gaps if g >= items[i]}:
            rest = list(gaps)
            rest.remove(g)
            go(i + 1, [*rest, g - items[i]])
        go(i + 1, [*gaps, capacity - items[i]])

    go(0, [])
    return least[0]


@pytest.mark.parametrize("seed", range(30))
def test_plan(seed):
    rng = np.random.default_rng(seed)
    capacity = 24
    counts = Counter(rng.integers(1, capacity + 1, 9).tolist())
    stretches = packing.plan(counts, capacity)
    bins, ranks = {}, {}
    for length, rank, n, sequence, offset in stretches:
        for k in range(n):
            bins.setdefault(sequence + k, []).append((offset, length))
            ranks.setdefault(length, []).append(rank + k)
    assert {length: len(r) for length, r in ranks.items()} == dict(counts)
    assert all(sorted(r) == list(range(len(r))) for r in ranks.values())
    for parts in bins.values():
        ends = [o + n for o, n in sorted(parts)]
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= capacity
        assert sum(n > capacity // 3 for _, n in parts) <= 2
    assert len(bins) <= best(counts, capacity) + 1


def test_plan_of_many_pieces_is_small():
    rng = np.random.default_rng(1)
    counts = {n: int(c) for n, c in enumerate(rng.integers(0, 10**9, 1025)) if n}
    stretches = packing.plan(counts, 1024)
    used = max(s.sequence + s.n for s in stretches)
    assert len(stretches) < 20_000
    large = sum(c for n, c in counts.items() if n > 512)
    assert used <= 1.01 * max(large, sum(n * c for n, c in counts.items()) / 1024)

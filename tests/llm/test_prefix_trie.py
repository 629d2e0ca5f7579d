import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from reviewmill.llm import prefix_trie, queries

SCHEMA = "conv_id bigint, turn int, role string, text string, depth string, owner int, shared string"


def brute(convs):
    """Every node of the trie of ``{conv_id: [(role, text), ...]}``."""
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(convs, key=lambda c: (c is None, c or 0)):
        turns = convs[c]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, ids in members.items():
        own = (len(ids) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += own
    said = lambda ids: hashlib.sha256(",".join("null" if c is None else str(c) for c in ids).encode()).hexdigest()
    return sorted(
        (
            (ids[0], len(node), members[node[:-1]][0] if node else None, len(ids), children[node], leaves[node], saved[node], said(ends[node]))
            for node, ids in members.items()
        ),
        key=str,
    )


def rebuilt(rows):
    """The conversations of the query, from (conv_id, turn, role, text)."""
    turns = defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        turns[c].append((role or "", text or ""))
    out = {}
    for c, own in turns.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 6
        out[c] = (turns.get(c - c % 100, [])[:h] if c is not None else []) + own[h:]
    return out


def found(frame):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert frame.columns == columns
    return sorted((tuple(r) for r in frame.collect()), key=str)


def planted():
    rng = random.Random(3)
    rows = []
    for c in range(90):
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "bb", "ccc"])))
    rows += [(200 + c, t, "user", "the same") for c in range(20) for t in range(3)]
    rows += [(300, None, None, "null first"), (300, 1, "user", None), (300, 1, "user", None), (300, 1, "a", "tie")]
    rows += [(301, t, "user", f"turn {t}") for t in range(500)] + [(401, 0, "user", "x" * 100000)]
    rows += [(None, 0, "user", "no id"), (None, 1, "user", "a"), (-7, 0, "user", "the same"), (10**15, 0, "", "")]
    return rows


def frame_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(4)


@pytest.mark.parametrize("bits", [prefix_trie.LEAST_BITS, 2])
def test_nodes(spark, monkeypatch, bits):
    # A sketch of four counters proves nothing; the result is the same.
    monkeypatch.setattr(prefix_trie, "LEAST_BITS", bits)
    monkeypatch.setattr(prefix_trie, "MOST_BITS", bits)
    monkeypatch.setattr(prefix_trie, "RUN_IDS", 7)
    rows = planted()
    convs = prefix_trie.conversations(frame_of(spark, rows))
    turns = defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        turns[c].append((role or "", text or ""))
    assert found(prefix_trie.nodes(convs)) == brute(turns)


def test_empty_table(spark):
    convs = prefix_trie.conversations(spark.createDataFrame([], SCHEMA))
    assert prefix_trie.nodes(convs).collect() == []


def test_sketch_never_counts_too_little(spark):
    convs = prefix_trie.conversations(frame_of(spark, planted()))
    prefixes = prefix_trie._prefixes(convs)
    digests = [d for r in prefixes.collect() for d in r["digests"]]
    true = defaultdict(int)
    for d in digests:
        true[bytes(d)] += 1
    for bits in (6, 12):
        counters = prefix_trie.sketch(prefixes, bits)
        keys = list(true)
        slots = prefix_trie._slots(keys, bits)
        estimate = [min(int(counters[k][slots[k][i]]) for k in range(prefix_trie.ROWS)) for i in range(len(keys))]
        assert all(e >= min(true[k], 2) for e, k in zip(estimate, keys))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, sf):
    sf = f"/root/testdata/{sf}"
    rows = [tuple(r) for r in queries.table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.REGISTERED["op13_prefix_trie"](spark, sf)) == brute(rebuilt(rows))

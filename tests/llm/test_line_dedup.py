import fixtures
import numpy as np

from reviewmill.llm import line_dedup
from reviewmill.llm.arrays import U64

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LAST = line_dedup.LAST_ID


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def brute(texts):
    holders = {}
    for doc, text in texts:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders.setdefault(key(line), set()).add(LAST if doc is None else doc)
    out = []
    for doc, text in texts:
        lines = (text or "").split("\n")
        gone = [
            len(holders.get(key(x), ())) > 1 and min(holders[key(x)]) != (LAST if doc is None else doc) for x in lines
        ]
        out.append((str(doc), len(lines), sum(gone), "\n".join(x for x, g in zip(lines, gone) if not g)))
    return sorted(out)


def found(rows):
    return sorted((str(r["doc_id"]), r["d"]["n_lines"], r["d"]["n_dropped"], r["d"]["kept"]) for r in rows.collect())


def test_edge_cases(spark):
    docs = fixtures.documents(spark)
    result = line_dedup.deduplicated(docs, made="d")
    assert result.columns == [*docs.columns, "d"]
    assert found(result) == brute(fixtures.texts())


def test_hot_line_in_many_groups(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "GROUP_PROBES", 7)
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 5)
    texts = [
        (d, f"the very same first line\nline of group {d % 9} of several\n{fixtures.words(d, 6)}") for d in range(200)
    ] + [(None, "the very same first line"), (3, "the very same first line\nline of group 3 of several")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert found(line_dedup.deduplicated(docs, made="d")) == brute(texts)


def test_empty_table(spark):
    assert line_dedup.deduplicated(fixtures.empty(spark), made="d").collect() == []


def test_perfect_hash_is_minimal_and_rejects_strangers():
    rng = np.random.default_rng(3)
    h, f = rng.integers(0, 1 << 64, (2, 30_000), dtype=U64)
    first, count = np.arange(20_000), np.arange(20_000) % 50 + 2
    shard = line_dedup.build(h[:20_000], f[:20_000], first, count)
    assert len(shard["fingerprints"]) == 4 * 20_000
    known, firsts, counts = line_dedup.probe(shard, h, f)
    assert known[:20_000].all() and not known[20_000:].any()
    assert (firsts[:20_000] == first).all() and (counts[:20_000] == count).all()
    none = line_dedup.build(h[:0], f[:0], first[:0], count[:0])
    assert not line_dedup.probe(none, h, f)[0].any()


def test_keys_that_share_half_their_bits_are_told_apart(spark, monkeypatch):
    f = np.arange(5_000, dtype=U64)
    h = np.full(5_000, 77, U64)
    for one, other in ((h, f), (f, h)):
        shard = line_dedup.build(one, other, np.arange(5_000), np.arange(5_000) + 1)
        known, firsts, counts = line_dedup.probe(shard, one, other)
        assert known.all() and (firsts == np.arange(5_000)).all() and (counts == np.arange(5_000) + 1).all()
    # All lines of the table in one shard and with one half.
    lines_of = line_dedup.lines_of

    def one_half(some):
        starts, ends, first, h, f, has_key = lines_of(some)
        return starts, ends, first, h * U64(0) + U64(5), f, has_key

    monkeypatch.setattr(line_dedup, "lines_of", one_half)
    texts = [(d, f"line of group {d % 9} of several\n{fixtures.words(d, 6)}") for d in range(60)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert found(line_dedup.deduplicated(docs, made="d")) == brute(texts)


def test_every_distinct_line_is_indexed(spark, monkeypatch):
    sizes = spark.sparkContext.accumulator(0)
    shards_of = line_dedup.shards_of

    def seen(distinct, n_shards):
        sizes.add(distinct.count())
        return shards_of(distinct, n_shards)

    monkeypatch.setattr(line_dedup, "shards_of", seen)
    texts = [(d, f"the line that all share\nthe line of {d} alone") for d in range(20)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    assert found(line_dedup.deduplicated(docs, made="d")) == brute(texts)
    assert sizes.value == 21

import hashlib
import re

import fixtures

from reviewmill.llm import decontamination

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def items():
    return [
        (1, fixtures.words(3, 30)),
        (2, "Two WORDS"),
        (3, "word"),
        (10, fixtures.words(3, 30).upper()),
        (4, None),
        (5, ""),
        (6, "... !!"),
        (None, "la " * 12),
        (7, "日本語 テキスト"),
        (7, "日本語 テキスト"),
        (8, fixtures.words(77, 25)),
    ]


def brute(text, benchmark, size=10):
    words = tokens(text)
    hit, met = set(), set()
    for item, body in benchmark:
        own = tokens(body)
        n = min(size, len(own))
        wanted = {tuple(own[k : k + n]) for k in range(len(own) - n + 1)} if own else set()
        for k in range(len(words) - n + 1):
            if tuple(words[k : k + n]) in wanted:
                hit.update(range(k, k + n))
                met.add(None if item is None else str(item))
    listed = sorted("" if item is None else item for item in met)
    return len(words), len(hit), len(met), hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit)


def result(rows):
    return sorted(
        (str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows
    )


def expected():
    return sorted((str(d), *brute(t, items())) for d, t in fixtures.texts())


def benchmark(spark):
    return spark.createDataFrame(items(), "item_id bigint, text string")


def test_edge_cases(spark):
    found = decontamination.matched(fixtures.documents(spark), benchmark(spark))
    assert result(decontamination.verdicts(found).collect()) == expected()


def test_many_blocks(spark):
    found = decontamination.matched(fixtures.documents(spark), benchmark(spark), block_bytes=2000)
    assert result(decontamination.verdicts(found).collect()) == expected()


def test_clean_keeps_columns(spark):
    docs = fixtures.documents(spark)
    kept = decontamination.clean(docs, benchmark(spark))
    assert kept.columns == docs.columns
    clean = [d for d, t in fixtures.texts() if not brute(t, items())[-1]]
    assert sorted(map(str, clean)) == sorted(str(r["doc_id"]) for r in kept.collect())


def test_clean_in_many_blocks(spark):
    docs = fixtures.documents(spark)
    kept = decontamination.clean(docs, benchmark(spark), block_bytes=500)
    assert kept.columns == docs.columns
    clean = [d for d, t in fixtures.texts() if not brute(t, items())[-1]]
    assert sorted(map(str, clean)) == sorted(str(r["doc_id"]) for r in kept.collect())


def test_null_and_empty_item_ids(spark):
    """A null id and an empty id are two items; a window that many items share names them all."""
    passage = fixtures.words(3, 30)
    shared = [(None, passage), ("", passage), *((str(i), passage) for i in range(300))]
    found = decontamination.verdicts(
        decontamination.matched(
            fixtures.documents(spark), spark.createDataFrame(shared, "item_id string, text string"), block_bytes=1500
        )
    )
    assert result(found.collect()) == sorted((str(d), *brute(t, shared)) for d, t in fixtures.texts())


def test_blocks_run_apart(spark):
    """However many blocks there are, the result's plan has no Python stage left: their hits are written."""
    found = decontamination.matched(fixtures.documents(spark), benchmark(spark), block_bytes=200)
    assert "MapInArrow" not in found._jdf.queryExecution().toString()


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.matched(fixtures.empty(spark), benchmark(spark)).collect() == []
    rows = decontamination.verdicts(decontamination.matched(fixtures.documents(spark), none)).collect()
    assert len(rows) == len(fixtures.rows()) and not any(r["contaminated"] for r in rows)

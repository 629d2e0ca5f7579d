"""Each stage against a brute-force version on its own input."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import fixtures
import test_decontamination as leaks
import test_line_dedup as lines
import test_near_dedup as near
import test_packing as packs
from tokenizers import Tokenizer

import corpus_pipeline
from reviewmill.llm import queries
from reviewmill.session import materialise

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The input of the first stage and the output of each, written as the pipeline does."""
    docs = queries.table(spark, SF, "documents")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(materialise(stage(spark, out[-1], SF)))
    return out


def texts(rows):
    return [(r["doc_id"], r["text"]) for r in rows.select("doc_id", "text").collect()]


def test_stages_keep_the_columns(stages):
    for rows in stages[:-1]:
        assert rows.columns == stages[0].columns and dict(rows.dtypes) == dict(stages[0].dtypes)


def test_quality(spark, stages):
    marked = {r["doc_id"]: r["quality"] for r in queries.table(spark, SF, "labels").collect()}
    kept = {d for d, _ in texts(stages[1])}
    good = [d for d, y in marked.items() if y == 1]
    bad = [d for d, y in marked.items() if y == 0]
    assert sum(d in kept for d in good) >= 0.98 * len(good)
    assert sum(d in kept for d in bad) <= 0.3 * len(bad)


def test_lines(stages):
    expected = [(d, kept) for d, _, _, kept in lines.brute(texts(stages[1]))]
    assert sorted((str(d), t) for d, t in texts(stages[2])) == expected
    assert stages[2].where("n_chars <> char_length(text)").count() == 0


def test_near_copies(stages):
    parts = near.brute(texts(stages[2]), 5)
    assert sorted(d for d, _ in texts(stages[3])) == sorted(d for d, (_, root) in parts.items() if d == root)


def test_benchmark(spark, stages):
    items = [(r["item_id"], r["text"]) for r in queries.table(spark, SF, "benchmark").collect()]
    clean = [d for d, t in texts(stages[3]) if not leaks.brute(t, items)[-1]]
    assert sorted(d for d, _ in texts(stages[4])) == sorted(clean)


def test_packing(stages):
    tokenizer = Tokenizer.from_file(queries.tokenizer()[0])
    tokenizer.encode_special_tokens = True
    packs.check(
        stages[5].collect(), texts(stages[4]), lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids
    )


def test_run_gives_the_last_stage(spark, stages):
    keep = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(corpus_pipeline.run(spark, SF).select(keep).collect()) == sorted(stages[-1].select(keep).collect())


def test_edge_cases_and_empty_table(spark):
    for docs in (fixtures.documents(spark), fixtures.empty(spark)):
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = materialise(stage(spark, docs, SF))
            assert docs.columns == columns
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()

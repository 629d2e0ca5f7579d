import re

import fixtures

from reviewmill.llm import quality_rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    repeated = {k + j for k, w in enumerate(windows) if seen[w] > 1 for j in range(8)}
    full = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(full) - len(set(full)),
        len(repeated),
    )


def test_measures(spark):
    rows = quality_rules.judged(fixtures.documents(spark)).collect()
    got = sorted(
        (str(r["doc_id"]), r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in rows
    )
    assert got == sorted((str(d), *brute(t)) for d, t in fixtures.texts())
    for r in rows:
        failed = r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]
        assert r["base_failed"] == failed
        assert r["kept"] == (not failed and r["host_passed"])


def test_bad_host_is_rejected_and_small_host_is_not_judged_on_luck(spark):
    good, bad = fixtures.words(1, 60), "a b"
    rows = [(i, fixtures.words(i, 60) if i % 10 else bad, f"good{i % 5}") for i in range(200)]
    rows += [(1000 + i, bad if i % 10 else good, "bad") for i in range(60)]
    rows += [(2000, bad, "tiny"), (2001, good, "tiny")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    hosts = {r["host"]: r["host_passed"] for r in quality_rules.judged(docs).collect()}
    assert not hosts["bad"] and all(passed for host, passed in hosts.items() if host != "bad")


def test_no_python_in_the_plan(spark):
    plan = quality_rules.measured(fixtures.documents(spark))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark):
    assert quality_rules.judged(fixtures.empty(spark)).collect() == []


def test_beta_prior():
    assert quality_rules.beta_prior(None, None) == (1.0, 1.0)
    alpha, beta = quality_rules.beta_prior(0.2, 0.01)
    assert abs(alpha / (alpha + beta) - 0.2) < 1e-9 and abs(alpha + beta - 15) < 1e-9

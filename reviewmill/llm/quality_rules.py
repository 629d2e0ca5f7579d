"""Quality rules with verdicts on hosts, in Spark expressions only.

Each document is measured; each rule it fails counts against its host. A host's failure rate of a
rule is shrunk towards the rate of all hosts with a beta prior, whose two parameters are fitted to
the hosts' rates by moments, so a host with few documents is not judged on luck. A document is kept
if it passes the base rules and its host's shrunk rate is at most ``HOST_LIMIT`` for every rule.

Null texts have no words; a null host is a host; repeated rows each count and each get a row; other
columns are left out; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.session import materialise

SPACE = " \t\n\x0b\x0c\r"
SHORT_WORDS = 20
REPEAT_PERCENT = 30
WINDOW = 8
HOST_LIMIT = 0.5


def rules() -> dict[str, Column]:
    """The rules whose failures count against a host; the first two are the base rules."""
    n = F.col("n_words")
    return {
        "short": n < SHORT_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > REPEAT_PERCENT * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "dup_lines": 100 * F.col("n_dup_lines") > REPEAT_PERCENT * F.col("n_full_lines"),
        "word_length": (F.col("word_chars") < 3 * n) | (F.col("word_chars") > 10 * n),
    }


def _let(value: Column, body) -> Column:
    """``body`` over a value that is computed once, as the bound variable of a one-element array."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of ``WINDOW`` words found twice or more in the text."""

    def of_windows(windows: Column) -> Column:
        places = F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i")))

        def of_sorted(ordered: Column) -> Column:
            def is_repeated(entry: Column, k: Column) -> Column:
                return F.coalesce(
                    (F.get(ordered, k - 1)["w"] == entry["w"]) & (k > 0), F.lit(False)
                ) | F.coalesce(F.get(ordered, k + 1)["w"] == entry["w"], F.lit(False))

            starts = F.array_sort(
                F.transform(F.filter(ordered, is_repeated), lambda entry: entry["i"])
            )
            # Each start covers up to the next start, and a whole window at most.
            return _let(
                starts,
                lambda s: F.aggregate(
                    F.transform(
                        s,
                        lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(s, k + 1) - x, F.lit(WINDOW))),
                    ),
                    F.lit(0).cast("bigint"),
                    lambda total, x: total + x,
                ),
            )

        return F.when(
            F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("bigint")
        ).otherwise(_let(F.sort_array(places), of_sorted))

    def of_hashes(hashes: Column) -> Column:
        last = F.size(hashes) - WINDOW
        windows = F.transform(
            F.sequence(F.lit(0), last),
            lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]),
        )
        return F.when(last < 0, F.lit(0).cast("bigint")).otherwise(_let(windows, of_windows))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def measured(docs: DataFrame, id_col="doc_id", text_col="text", host_col="source") -> DataFrame:
    """One row per row of ``docs``: its id, host and the measures that the rules are about."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(host_col).alias("host"),
        text.alias("body"),
        F.btrim(text, F.lit(SPACE)).alias("trimmed"),
    )
    words = F.when(F.col("trimmed") == "", F.array().cast("array<string>")).otherwise(
        F.split("trimmed", r"[ \t-\r]+")
    )
    lines = F.filter(F.split("body", "\n"), lambda line: F.btrim(line, F.lit(SPACE)) != "")

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.char_length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            repeated_words(w).alias("n_repeat_words"),
        )

    def of_lines(full: Column) -> Column:
        return F.struct(
            F.size(full).cast("bigint").alias("n_full_lines"),
            (F.size(full) - F.size(F.array_distinct(full))).cast("bigint").alias("n_dup_lines"),
        )

    symbols = F.regexp_replace("body", r"[^#*$%&|<>]+", "")
    return base.select(
        "doc_id",
        "host",
        F.char_length(symbols).cast("bigint").alias("n_symbols"),
        F.inline(F.array(F.struct(_let(words, of_words).alias("w"), _let(lines, of_lines).alias("l")))),
    ).select("doc_id", "host", "w.*", "l.*", "n_symbols")


def host_verdicts(measures: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """``(host, host_docs, rate_<rule>..., host_passed)``: each host's shrunk failure rates."""
    failures = rules()
    counts = materialise(
        measures.groupBy("host").agg(
            F.count(F.lit(1)).alias("host_docs"),
            *[F.sum(rule.cast("bigint")).alias(f"failed_{name}") for name, rule in failures.items()],
        ),
        "host-counts",
    )
    moments = counts.agg(
        *[F.avg(F.col(f"failed_{n}") / F.col("host_docs")).alias(f"mean_{n}") for n in failures],
        *[F.var_pop(F.col(f"failed_{n}") / F.col("host_docs")).alias(f"var_{n}") for n in failures],
    ).first()
    rates = {}
    for name in failures:
        alpha, beta = beta_prior(moments[f"mean_{name}"], moments[f"var_{name}"])
        rates[f"rate_{name}"] = (F.col(f"failed_{name}") + alpha) / (
            F.col("host_docs") + (alpha + beta)
        )
    passed = F.lit(True)
    for name in rates:
        passed = passed & (F.col(name) <= limit)
    return (
        counts.withColumns(rates)
        .withColumn("host_passed", passed)
        .select("host", "host_docs", *rates, "host_passed")
    )


def beta_prior(mean: float | None, variance: float | None) -> tuple[float, float]:
    """The beta distribution with these moments; no wider than uniform, no narrower than 1,000 counts."""
    if mean is None:
        return 1.0, 1.0
    strength = mean * (1 - mean) / variance - 1 if variance else 1000.0
    strength = min(max(strength, 2.0), 1000.0)
    mean = min(max(mean, 0.5 / strength), 1 - 0.5 / strength)
    return mean * strength, (1 - mean) * strength


def judged(docs: DataFrame, id_col="doc_id", text_col="text", host_col="source") -> DataFrame:
    """The measures of each document, ``base_failed``, its host's verdict, and ``kept``."""
    measures = materialise(measured(docs, id_col, text_col, host_col), "measures")
    verdicts = host_verdicts(measures).withColumnRenamed("host", "judged_host")
    failures = rules()
    return (
        measures.join(verdicts, F.col("host").eqNullSafe(F.col("judged_host")), "left")
        .withColumn("base_failed", failures["short"] | failures["repeats"])
        .withColumn("kept", ~F.col("base_failed") & F.col("host_passed"))
        .drop("judged_host")
    )

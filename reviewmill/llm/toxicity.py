"""Toxic passages as maximum-scoring segments of token log-odds, with extreme-value calibration.

Tokens are lower-cased words. A word's odds of standing in a toxic document come from labelled rows
with Dirichlet priors in a chain: the corpus' odds are the prior of three-byte beginnings, those of
four-byte ones, those of five-byte ones, those of words; so a new word gets the odds of its beginning.
A word scores its log-odds less ``DRIFT``, at least ``-DRIFT``. A text's maximal scoring segments are
found in one scan from left to right, each positive word entering once. By the theory of
such segments, text of n words without toxic passages has K n exp(-lambda s) segments of score s or
more; lambda solves sum p exp(lambda s) = 1 over the scores of clean words and K follows from the
segments of clean rows. A segment is significant if that number is below ``SIGNIFICANT``. A
document's evidence is the sum of -log of it over its significant segments, on a log scale, and two
numbers fitted on the sample turn evidence into a probability.

Learned from at most about ``SAMPLE`` labelled rows per label, chosen by a hash of the id; clean rows
count for those left out. Only beginnings and words that score above zero, and exceptions below them, are
kept, so the table's size is bounded by the sample's. Null and empty texts have no evidence. Rows with a
null id or label are not learned from; without labels of both kinds the score is their share (0 without
any). Each row gets a row; other columns are left out.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import arrays
from reviewmill.llm.arrays import U64
from reviewmill.llm.decontamination import words_of
from reviewmill.llm.quality_classifier import learning_sample
from reviewmill.session import materialise

SAMPLE = 20_000
BEGINNINGS = (3, 4, 5)  # bytes
PRIOR = 10.0
DRIFT = 2.0
HIGHEST = 6.0
SIGNIFICANT = 0.05

_KINDS = arrays.mixed(np.arange(101, 110, dtype=U64))


class Model(NamedTuple):
    tokens: np.ndarray  # sorted hashes
    scores: np.ndarray
    decay: float  # lambda
    scale: float  # K
    slope: float
    bias: float


def token_levels(data, starts, ends, hashes):
    """Per level the hash of each word's token; a word that is no longer than a beginning has none (0)."""
    rolling = arrays.Rolling(data)
    for k, size in enumerate(BEGINNINGS):
        long = ends - starts > size
        out = np.zeros(len(starts), U64)
        out[long] = rolling.of(starts[long], starts[long] + size) ^ _KINDS[k]
        yield out
    yield hashes ^ _KINDS[len(BEGINNINGS)]


def _count(batches, schema):
    """Counts of all tokens by level in the rows of a batch, by label, with the next shorter token."""
    for rows in batches:
        toxic_rows = rows.column("label").to_numpy(zero_copy_only=False)
        for some in arrays.slices(rows.column("text")):
            data, starts, ends, first, hashes = words_of(some)
            row = np.searchsorted(first, np.arange(len(starts)), "right") - 1 + some.first
            toxic = toxic_rows[row] == 1
            parent = np.zeros(len(starts), U64)
            for level, tokens in enumerate(token_levels(data, starts, ends, hashes)):
                there = tokens != 0
                token, at, which = np.unique(tokens[there], return_index=True, return_inverse=True)
                yield arrays.batch(
                    schema,
                    {
                        "level": np.full(len(token), level),
                        "token": arrays.signed(token),
                        "parent": arrays.signed(parent[there][at]),
                        "toxic": np.bincount(which, toxic[there], len(token)),
                        "clean": np.bincount(which, ~toxic[there], len(token)),
                    },
                )
                parent = np.where(there, tokens, parent)


def _odds_table(rows: DataFrame, weights: dict[int, float]) -> DataFrame:
    """``(token, score, parent_score)`` for all tokens of the sample, level by level."""
    counts = materialise(
        arrays.over(
            rows, _count,
            "level int, token bigint, parent bigint, toxic double, clean double", ["label", "text"],
        )
        .groupBy("level", "token", "parent")
        .agg(
            (F.sum("toxic") * weights.get(1, 1.0)).alias("toxic"),
            (F.sum("clean") * weights.get(0, 1.0)).alias("clean"),
        ),
        "token-counts",
    )
    words = len(BEGINNINGS)
    total = counts.where(F.col("level") == words).agg(F.sum("toxic"), F.sum("clean")).first()
    toxic, clean = max(total[0] or 0.0, 0.5), max(total[1] or 0.0, 0.5)
    base = toxic / (toxic + clean)
    offset = float(np.log(base / (1 - base)))

    def score(share: Column) -> Column:
        odds = F.log(share / (1 - share)) - offset
        return F.greatest(F.lit(-DRIFT), F.least(F.lit(HIGHEST), odds) - DRIFT)

    known, parts = None, []
    for level in range(words + 1):
        own = counts.where(F.col("level") == level)
        if known is None:
            own = own.withColumn("prior", F.lit(base))
        else:
            shares = known.select(F.col("token").alias("parent"), F.col("share").alias("prior"))
            own = own.join(shares, "parent", "left").withColumn("prior", F.coalesce("prior", F.lit(base)))
        own = own.withColumn(
            "share",
            (F.col("toxic") + PRIOR * F.col("prior")) / (F.col("toxic") + F.col("clean") + PRIOR),
        )
        parts.append(own.select("token", score(F.col("share")).alias("score"), score(F.col("prior")).alias("parent_score")))
        # Words of one beginning can follow several shorter ones only if those are missing.
        step = own.select("token", "share")
        known = step if known is None else known.unionByName(step)
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return table


def fit(
    docs: DataFrame, labels: DataFrame, label="toxic", may_learn: Column | None = None, sample: int = SAMPLE
) -> Model:
    chosen, counts = learning_sample(
        docs, labels, label, F.lit(True) if may_learn is None else may_learn, sample
    )
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    none = np.zeros(0, U64), np.zeros(0)
    if len(counts) < 2:
        edge = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
        return Model(*none, 1.0, 1.0, 0.0, float(edge))
    rows = materialise(
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(
            F.broadcast(chosen), "doc_id"
        ),
        "toxicity-sample",
    )
    weights = {y: max(1.0, n / sample) for y, n in counts.items()}
    table = (
        _odds_table(rows, weights)
        .where((F.col("score") > 0) | (F.col("parent_score") > 0))
        .groupBy("token")
        .agg(F.max("score").alias("score"))
        .toArrow()
    )
    tokens = table["token"].to_numpy().view(U64)
    order = np.argsort(tokens)
    model = Model(tokens[order], table["score"].to_numpy()[order], 1.0, 1.0, 0.0, 0.0)
    return _calibrated(rows, model, weights)


class Scanner:
    """Scores words and finds the maximal segments of the rows of a slice."""

    def __init__(self, model: Model):
        self.model = model
        self.known = arrays.Numbering(max(4, int(len(model.tokens) * 2 + 1).bit_length() + 1))
        self.known.add(model.tokens)

    def word_scores(self, some: arrays.Slice):
        data, starts, ends, first, hashes = words_of(some)
        scores = np.full(len(starts), -DRIFT)
        if len(self.model.tokens):
            for tokens in token_levels(data, starts, ends, hashes):
                number = self.known.find(tokens)
                scores = np.where(number >= 0, self.model.scores[number], scores)
        return scores, first

    def segments(self, some: arrays.Slice):
        """Number of words of each row, word scores, and per row (first word, last word, score)."""
        scores, first = self.word_scores(some)
        upto = np.concatenate([[0.0], np.cumsum(scores)])
        good = np.flatnonzero(scores > 0)
        bounds = np.searchsorted(good, first)
        found = [
            maximal_segments(good[a:b].tolist(), upto, int(start)) if b > a else []
            for a, b, start in zip(bounds[:-1], bounds[1:], first[:-1])
        ]
        return np.diff(first), scores, found


def maximal_segments(good: list[int], upto: np.ndarray, start: int) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of one row; ``good`` are its words with a positive score.

    Each segment is (first word, last word, score), words counted from ``start``.
    """
    found: list[list] = []  # [first, last, total before, total after, index of the last smaller one]
    for word in good:
        new = [word, word, float(upto[word]), float(upto[word + 1])]
        while True:
            # The last segment that starts lower; each one points to the one it would have asked next.
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= new[3]:
                found.append([*new, j])
                break
            new = [found[j][0], new[1], found[j][2], new[3]]
            del found[j:]
    return [(f - start, l - start, after - before) for f, l, before, after, _ in found]


def expected(model: Model, n_words, score):
    """How many segments of this score or more a clean text of so many words has."""
    return model.scale * np.maximum(1, n_words) * np.exp(-model.decay * np.asarray(score))


def evidence(model: Model, n_words: int, segments: list) -> float:
    """log(1 + sum of -log of the expected number over the significant segments)."""
    e = expected(model, n_words, [s for _, _, s in segments]) if segments else np.ones(0)
    return float(np.log1p(-np.log(np.maximum(e[e < SIGNIFICANT], 1e-300)).sum()))


def _calibrated(rows: DataFrame, model: Model, weights: dict[int, float]) -> Model:
    get = arrays.sent(rows.sparkSession, model)

    def scan(batches, schema):
        scanner = Scanner(get())
        for batch in batches:
            n_words, segments, bins = [], [], []
            for some in arrays.slices(batch.column("text")):
                n, scores, found = scanner.segments(some)
                n_words.append(n)
                segments += [[s for _, _, s in f] for f in found]
                row = np.repeat(np.arange(len(n)), n)
                tenth = np.round((scores + DRIFT) * 10).astype(np.int64)
                wide = int((HIGHEST + DRIFT) * 10) + 1
                counts = np.bincount(row * wide + tenth, minlength=len(n) * wide).reshape(-1, wide)
                bins += [c[: np.flatnonzero(c)[-1] + 1] if c.any() else c[:0] for c in counts]
            yield arrays.batch(
                schema,
                {
                    "label": batch.column("label"),
                    "n_words": np.concatenate(n_words) if n_words else [],
                    "segments": segments,
                    "bins": bins,
                },
            )

    scanned = materialise(
        arrays.over(
            rows, scan, "label int, n_words bigint, segments array<double>, bins array<bigint>",
            ["label", "text"],
        ),
        "toxicity-scan",
    )
    histogram = (
        scanned.where("label = 0")
        .select(F.posexplode("bins").alias("bin", "n"))
        .groupBy("bin")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    decay = _decay({r["bin"] / 10 - DRIFT: r["n"] for r in histogram})
    # Bounded by the sample.
    seen = scanned.select("label", "n_words", "segments").toArrow()
    y, n_words = seen["label"].to_numpy(), seen["n_words"].to_numpy()
    segments = [[(0, 0, s) for s in x.as_py()] for x in seen["segments"]]
    clean = [s for label, found in zip(y, segments) if label == 0 for _, _, s in found]
    least = 0.5
    above = sum(s >= least for s in clean) + 0.5
    scale = above / max(1, n_words[y == 0].sum()) * np.exp(decay * least)
    model = model._replace(decay=decay, scale=float(scale))
    x = np.array([evidence(model, n, found) for n, found in zip(n_words.tolist(), segments)])
    slope, bias = _logistic(x, y, np.array([weights.get(int(v), 1.0) for v in y]))
    return model._replace(slope=slope, bias=bias)


def _decay(counts: dict[float, int]) -> float:
    """The positive solution of sum p exp(lambda s) = 1, with half a word added at the highest score."""
    scores = np.array([*counts, HIGHEST - DRIFT])
    p = np.array([*counts.values(), 0.5], float)
    p /= p.sum()
    low, high = 1e-6, 50.0
    if (p * scores).sum() >= 0:
        return low
    for _ in range(100):
        middle = (low + high) / 2
        if (p * np.exp(middle * scores)).sum() < 1:
            low = middle
        else:
            high = middle
    return low


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression on one number, with a small ridge, by Newton steps."""
    design = np.stack([x, np.ones_like(x)], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (weight * (y - p)) - 1e-3 * beta
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        beta = beta + np.clip(np.linalg.solve(curve, gradient), -5, 5)
    return max(0.0, float(beta[0])), float(beta[1])


def passages(docs: DataFrame, model: Model, id_col="doc_id", text_col="text") -> DataFrame:
    """``(doc_id, score, passages)``: the probability, and the significant segments in text order.

    A passage has its first and last word (counted from 0), its score and the expected number of such.
    """
    get = arrays.sent(docs.sparkSession, model)

    def scan(batches, schema):
        fitted = get()
        scanner = Scanner(fitted)
        kind = schema.field("passages").type
        for batch in batches:
            x, found_all = [], []
            for some in arrays.slices(batch.column("text")):
                n_words, _, found = scanner.segments(some)
                for n, segments in zip(n_words.tolist(), found):
                    x.append(evidence(fitted, n, segments))
                    e = expected(fitted, n, [s for _, _, s in segments])
                    found_all.append(
                        [
                            {"first_word": a, "last_word": b, "score": s, "expected": float(v)}
                            for (a, b, s), v in zip(segments, e)
                            if v < SIGNIFICANT
                        ]
                    )
            logit = fitted.bias + fitted.slope * np.array(x, float)
            yield arrays.batch(
                schema,
                {
                    "doc_id": batch.column("doc_id"),
                    "score": 1 / (1 + np.exp(-np.clip(logit, -500, 500))),
                    "passages": pa.array(found_all, kind),
                },
            )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return arrays.over(
        rows, scan,
        "doc_id bigint, score double, passages array<struct<first_word: int, last_word: int, "
        "score: double, expected: double>>",
        ["doc_id", "text"],
    )

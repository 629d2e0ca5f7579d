"""Quality classifier: learned vectors of hashed words and character n-grams, averaged, with softmax.

A document's features are its words, their character n-grams (with marked word ends), neighbouring
word pairs, and whether a word repeats the one before; each is hashed to one of ``BUCKETS`` vectors.
The mean of the vectors goes through a softmax layer; both are trained by stochastic gradient descent
in NumPy on a sample of labelled rows of bounded size (``SAMPLE`` per label, chosen by a hash of
the id; features are made on the executors). To score, a bucket's vector is folded with the softmax
weights into one number, so a document costs a lookup per word, and each distinct word is cut into
n-grams once per worker.

Null and empty texts have no features and get the score of the labels' shares. Rows with a null id or
label are not learned from, ids with several labels count with each. Without labels of both kinds every
score is the share of label 1 (a half if there are no labels). Each row gets a row; other columns go.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import arrays
from reviewmill.llm.arrays import U64

BUCKETS = 1 << 16
GRAMS = (2, 3, 4)
SAMPLE = 1500
DIMENSIONS = 8
EPOCHS = 6
RATE = 1.0
SEED = 7

_KINDS = arrays.mixed(np.arange(1, 16, dtype=U64))
_WORD, _PAIR, _AGAIN = 0, 1, 2


class Model(NamedTuple):
    """``weights``: log-odds of label 1 for each bucket; ``bias``: those without any feature."""

    weights: np.ndarray
    bias: float


def _bucket(hashes: np.ndarray, kind: int) -> np.ndarray:
    return (arrays.mixed(hashes ^ _KINDS[kind]) & U64(BUCKETS - 1)).astype(np.int64)


def word_buckets(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray):
    """The buckets of each word itself and its n-grams: word numbers and buckets."""
    rolling = arrays.Rolling(data)
    words, buckets = [np.arange(len(starts))], [_bucket(hashes, _WORD)]
    for size in GRAMS:
        n = np.maximum(0, ends - starts - size + 1)
        at = arrays.gathered(starts, n)
        word = np.repeat(np.arange(len(starts)), n)
        first, last = at == starts[word], at + size == ends[word]
        kind = 3 + 2 * first + last
        words.append(word)
        buckets.append(
            (arrays.mixed(rolling.of(at, at + size) ^ _KINDS[kind]) & U64(BUCKETS - 1)).astype(np.int64)
        )
    return np.concatenate(words), np.concatenate(buckets)


def pair_buckets(hashes: np.ndarray) -> np.ndarray:
    """The bucket of each pair of neighbours; all pairs of equal words share one."""
    same = hashes[1:] == hashes[:-1]
    return np.where(same, _bucket(np.zeros(1, U64), _AGAIN), _bucket(arrays.chained(hashes, 2), _PAIR))


def inside_rows(first: np.ndarray, n_words: int) -> np.ndarray:
    """Which of the neighbouring word pairs lie in one row."""
    inside = np.ones(max(0, n_words - 1), dtype=bool)
    breaks = first[(first > 0) & (first < n_words)]
    inside[breaks - 1] = False
    return inside


def _features(batches, schema):
    """A row per labelled document: its buckets and how many of its features each holds."""
    for rows in batches:
        buckets, counts = [], []
        for some in arrays.slices(rows.column("text")):
            starts, ends, first = arrays.spans(some.data, some.bounds, arrays.NOT_SPACE)
            hashes = arrays.Rolling(some.data).of(starts, ends)
            word, bucket = word_buckets(some.data, starts, ends, hashes)
            at = np.flatnonzero(inside_rows(first, len(starts)))
            word = np.concatenate([word, at])
            bucket = np.concatenate([bucket, pair_buckets(hashes)[at] if len(hashes) > 1 else at])
            row = np.searchsorted(first, word, "right") - 1
            key, n = np.unique(row * BUCKETS + bucket, return_counts=True)
            bounds = np.searchsorted(key, np.arange(some.last - some.first + 1) * BUCKETS)
            for a, b in zip(bounds[:-1], bounds[1:]):
                buckets.append((key[a:b] % BUCKETS).astype(np.int32))
                counts.append(n[a:b].astype(np.float32))
        yield arrays.batch(
            schema, {"label": rows.column("label"), "buckets": buckets, "counts": counts}
        )


def learning_sample(
    docs: DataFrame, labels: DataFrame, label: str, may_learn: Column, sample: int
) -> tuple[DataFrame, dict[int, int]]:
    """``(doc_id, label)`` of about ``sample`` rows per label, and how many rows each label has."""
    known = labels.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label")
    ).where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & may_learn)
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for value, n in counts.items():
        share = F.when(F.col("label") == value, F.lit(sample / n)).otherwise(share)
    place = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return known.where(place < share), counts


def crc_part(id_col: str, parts: int) -> Column:
    """The remainder that splits documents into folds: of the CRC-32 of the id as text."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % parts


def fit(
    docs: DataFrame, labels: DataFrame, label="quality", may_learn: Column | None = None, sample: int = SAMPLE
) -> Model:
    """Train on labelled rows; ``may_learn`` is a condition on ``doc_id``."""
    chosen, counts = learning_sample(
        docs, labels, label, F.lit(True) if may_learn is None else may_learn, sample
    )
    share = np.clip(counts.get(1, 0) / max(1, sum(counts.values())), 1e-3, 1 - 1e-3) if counts else 0.5
    bias = float(np.log(share / (1 - share)))
    if len(counts) < 2:
        return Model(np.zeros(BUCKETS, np.float32), bias)
    # Bounded: about `sample` rows per label.
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(
        F.broadcast(chosen), "doc_id"
    )
    features = arrays.over(
        rows, _features, "label int, buckets array<int>, counts array<float>", ["label", "text"]
    ).toArrow()
    y = features["label"].to_numpy()
    return Model(
        train(
            y,
            [x.values.to_numpy() for x in features["buckets"]],
            [x.values.to_numpy() for x in features["counts"]],
        ),
        bias,
    )


def train(y: np.ndarray, buckets: list[np.ndarray], counts: list[np.ndarray]) -> np.ndarray:
    """Stochastic gradient descent over the documents; gives each bucket's log-odds of label 1.

    The two labels have equal weight, so that their shares come in through the bias alone.
    """
    random = np.random.default_rng(SEED)
    vectors = random.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    layer = random.uniform(-1, 1, (DIMENSIONS, 2)).astype(np.float32) / DIMENSIONS
    weight = len(y) / 2 / np.maximum(1, np.bincount(y, minlength=2))
    order = np.lexsort(([x.sum() for x in counts], [len(x) for x in buckets], y))
    total, done = EPOCHS * len(y), 0
    for _ in range(EPOCHS):
        for i in order[random.permutation(len(order))]:
            rate = RATE * (1 - done / total)
            done += 1
            if not len(buckets[i]):
                continue
            at, share = buckets[i], counts[i] / counts[i].sum()
            mean = share @ vectors[at]
            logits = mean @ layer
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[y[i]] -= 1
            p *= weight[y[i]]
            back = layer @ p
            layer -= rate * np.outer(mean, p).astype(np.float32)
            # The mean spreads its gradient thinly; a bucket moves by its share, scaled up.
            vectors[at] -= (rate * len(at) ** 0.5) * np.outer(share, back).astype(np.float32)
    return (vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32)


class Scorer:
    """Scores the rows of slices; keeps the sums of the words it has met."""

    def __init__(self, model: Model):
        self.weights, self.bias = model
        self.known = arrays.Numbering(20)
        self.sums, self.sizes = np.zeros(1 << 19), np.zeros(1 << 19)

    def _words(self, some: arrays.Slice, starts, ends, hashes):
        """The sum of weights and the number of features of each word."""
        number = self.known.find(hashes)
        new = np.flatnonzero(number < 0)
        if len(new):
            if self.known.full(len(new)):
                self.known.clear()
                new = np.arange(len(hashes))
            distinct, at = np.unique(hashes[new], return_index=True)
            at = new[at]
            if self.known.full(len(distinct)):  # one text with very many words: room for it alone
                self.known = arrays.Numbering(int(len(distinct) * 2).bit_length() + 1)
            before = self.known.size
            self.known.add(distinct)
            word, bucket = word_buckets(some.data, starts[at], ends[at], distinct)
            while len(self.sums) < self.known.size:
                self.sums = np.append(self.sums, np.zeros_like(self.sums))
                self.sizes = np.append(self.sizes, np.zeros_like(self.sizes))
            self.sums[before : self.known.size] = np.bincount(word, self.weights[bucket], len(at))
            self.sizes[before : self.known.size] = np.bincount(word, minlength=len(at))
            number = self.known.find(hashes)
        return self.sums[number], self.sizes[number]

    def scores(self, some: arrays.Slice) -> np.ndarray:
        starts, ends, first = arrays.spans(some.data, some.bounds, arrays.NOT_SPACE)
        hashes = arrays.Rolling(some.data).of(starts, ends)
        total, size = (
            np.diff(np.concatenate([[0], np.cumsum(x)])[first])
            for x in self._words(some, starts, ends, hashes)
        )
        if len(hashes) > 1:
            pairs = np.where(inside_rows(first, len(hashes)), self.weights[pair_buckets(hashes)], 0)
            # upto[k]: the pairs whose second word comes before word k.
            upto = np.concatenate([[0, 0], np.cumsum(pairs, dtype=np.float64)])
            total += upto[first[1:]] - upto[np.minimum(first[:-1] + 1, first[1:])]
            size += np.maximum(0, np.diff(first) - 1)
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(size, 1) + self.bias, -500, 500)))


def score_column(docs: DataFrame, model: Model, text_col="text") -> Column:
    """The probability of label 1 as a column over ``docs``."""
    arrays.bounded_batches(docs.sparkSession)
    get = arrays.sent(docs.sparkSession, model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(get())
        for texts in batches:
            parts = [scorer.scores(some) for some in arrays.slices(texts)]
            yield pa.array(np.concatenate(parts) if parts else [], pa.float64())

    return score(F.col(text_col))


def scored(docs: DataFrame, model: Model, id_col="doc_id", text_col="text") -> DataFrame:
    """``(doc_id, score)``: the probability of label 1 for each row."""
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        score_column(docs, model, text_col).alias("score"),
    )

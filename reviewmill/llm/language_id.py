"""Language of whole texts by a linear-chain conditional random field over their words.

Every word gets a distribution over the languages, so code-switched text is labelled word by
word. A word's features are its beginnings and endings, its character n-grams (hashed to ``BUCKETS``
weights per language) and the languages whose list of frequent words holds it; transitions between
the languages of neighbouring words are learned too. Forward-backward gives the words'
marginals; a document's language is the one with the largest sum of them and its score their mean.

Learning takes the whole texts of at most about ``SAMPLE`` rows per language, chosen by a hash of the id.
As rows have one language each, stretches of several are strung together, so that switches are seen; a stretch
may start at any word, and every row is as likely to give it. NumPy gradient steps, at most ``STEPS``, maximise
the likelihood. Scoring takes whole texts: rows of over ``LANE`` words run as several lanes in step, with the
exact messages at their borders, which the products of the lanes' step matrices give beforehand.

Texts that are null or hold no letter are ``und`` with score 0, and so is everything if there is nothing to
learn from. Words without letters carry no label weight. Null languages and ids are not learned from.
Each row gets a row; other columns are left out.
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

BUCKETS = 1 << 15
SAMPLE = 250
STRETCH = 40
LEXICON = 300
EPOCHS = 3
STEPS = 1500
RATE = 0.5
SWITCH = 15  # mean words between switches in the strung sequences
LANE = 1024
SEED = 11

_KINDS = arrays.mixed(np.arange(201, 220, dtype=U64))


class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray  # bucket x language
    transitions: np.ndarray  # language x language, log weights
    lexicon: np.ndarray  # sorted word hashes
    listed: np.ndarray  # lexicon word x language: whether the list holds it
    lexical: np.ndarray  # list x language weights


def word_features(data, starts, ends):
    """Word numbers and buckets of the affixes and n-grams of words."""
    rolling = arrays.Rolling(data)
    words, buckets = [], []

    def add(word, at, to, kind):
        words.append(word)
        hashed = arrays.mixed(rolling.of(at, to) ^ _KINDS[kind])
        buckets.append((hashed & U64(BUCKETS - 1)).astype(np.int64))

    every = np.arange(len(starts))
    for size in (1, 2, 3, 4):
        long = every[ends - starts >= size]
        add(long, starts[long], starts[long] + size, size)
        add(long, ends[long] - size, ends[long], 4 + size)
    for size in (2, 3):
        n = np.maximum(0, ends - starts - size + 1)
        at = arrays.gathered(starts, n)
        add(np.repeat(every, n), at, at + size, 8 + size)
    return np.concatenate(words), np.concatenate(buckets)


def emissions(model: Model, data, starts, ends, hashes) -> np.ndarray:
    """Log weights of the languages for each word."""
    word, bucket = word_features(data, starts, ends)
    out = np.stack(
        [np.bincount(word, w[bucket], len(starts)) for w in model.weights.T], axis=1
    )
    if len(model.lexicon):
        at = np.searchsorted(model.lexicon, hashes).clip(0, len(model.lexicon) - 1)
        out += (model.listed[at] * (model.lexicon[at] == hashes)[:, None]) @ model.lexical
    return out


def has_letter(data, starts, ends) -> np.ndarray:
    """Whether words hold more than digits."""
    upto = np.concatenate([[0], np.cumsum(data >= 0x61)])
    return upto[ends] > upto[starts]


def marginals(
    potential: list[np.ndarray], transitions: np.ndarray, entering=None, leaving=None
) -> tuple[list, list, list]:
    """Forward and backward messages and marginals of lanes in step.

    ``potential[t]`` holds the word weights (not logs) at step t for the lanes that have so many words,
    which are the first so many lanes. Lanes that go on from others or are gone on with have their messages
    in ``entering`` (to the first word, transition included) and ``leaving`` (back to the last word); else
    these are ones.
    """
    forward, backward = [], [None] * len(potential)
    for t, p in enumerate(potential):
        if t == 0:
            a = p if entering is None else entering * p
        else:
            a = (forward[-1][: len(p)] @ transitions) * p
        forward.append(a / a.sum(axis=1, keepdims=True))
    for t in range(len(potential) - 1, -1, -1):
        b = np.ones_like(potential[t]) if leaving is None else leaving[: len(potential[t])].copy()
        if t + 1 < len(potential):
            go_on = len(potential[t + 1])
            later = (potential[t + 1] * backward[t + 1]) @ transitions.T
            b[:go_on] = later / later.sum(axis=1, keepdims=True)
        backward[t] = b
    both = [f * b for f, b in zip(forward, backward)]
    return forward, backward, [m / m.sum(axis=1, keepdims=True) for m in both]


def products(potential: list[np.ndarray], transitions: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """Of each lane the product of its step matrices, scaled; ``opens`` marks lanes that begin a row."""
    n_lanes, n = len(opens), len(transitions)
    out = np.empty((n_lanes, n, n))
    out[:] = np.where(opens[:, None, None], np.eye(n), transitions) * potential[0][:, None, :]
    for p in potential[1:]:
        go_on = (out[: len(p)].reshape(-1, n) @ transitions).reshape(-1, n, n) * p[:, None, :]
        out[: len(p)] = go_on / go_on.max(axis=(1, 2), keepdims=True)
    return out


def border_messages(matrices: np.ndarray, transitions: np.ndarray, lanes: list[np.ndarray]):
    """``entering`` and ``leaving`` of all lanes, given for each row its lanes in the order of its text."""
    entering, leaving = np.ones((2, len(matrices), len(transitions)))
    for row in lanes:
        a = np.ones(len(transitions))
        for before, lane in zip(row[:-1], row[1:]):
            a = a @ matrices[before]
            a /= a.sum()
            entering[lane] = a @ transitions
        b = np.ones(len(transitions))
        for lane, after in zip(row[-2::-1], row[:0:-1]):
            b = matrices[after] @ b
            b /= b.sum()
            leaving[lane] = b
    return entering, leaving


# Learning --------------------------------------------------------------------------------------


def fit(docs: DataFrame, may_learn: Column | None = None, sample: int = SAMPLE) -> Model | None:
    """Learn from ``(doc_id, text, lang)``; ``may_learn`` is a condition on ``doc_id``."""
    known = docs.where(
        F.col("doc_id").isNotNull()
        & F.col("lang").isNotNull()
        & (F.lit(True) if may_learn is None else may_learn)
    )
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    place = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.lit(0.0)
    for lang, n in sorted(counts.items()):
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, sample / n))).otherwise(share)
    # Bounded by `sample`: so many rows of each language, as whole texts.
    arrays.bounded_batches(docs.sparkSession)
    seen = known.where(place < share).select("lang", F.coalesce("text", F.lit("")).alias("text")).toArrow()
    languages = sorted(counts)
    return train(languages, seen["lang"].to_pylist(), seen["text"].combine_chunks())


def train(languages: list[str], langs: list[str], texts: pa.Array) -> Model:
    n_lang = len(languages)
    number = {lang: i for i, lang in enumerate(languages)}
    order = pa.array(np.lexsort([texts.to_pylist(), langs]))
    texts, langs = texts.take(order), [langs[i] for i in order.to_pylist()]
    some = next(arrays.slices(texts, 1 << 62), None)
    empty = Model(
        languages, np.zeros((BUCKETS, n_lang)), np.zeros((n_lang, n_lang)), np.zeros(0, U64),
        np.zeros((0, n_lang)), np.zeros((n_lang, n_lang)),
    )
    if some is None or not len(some.data):
        return empty
    data, starts, ends, first, hashes = words_of(some)
    row_label = np.array([number[x] for x in langs])
    label, row = np.repeat(row_label, np.diff(first)), np.repeat(np.arange(len(langs)), np.diff(first))
    distinct, at, which = np.unique(hashes, return_index=True, return_inverse=True)
    lists = []
    in_row = np.unique(row * len(distinct) + which)  # rows count, so that no long text fills the list
    row_of, word_of = in_row // len(distinct), in_row % len(distinct)
    for k in range(n_lang):
        n = np.bincount(word_of[row_label[row_of] == k], minlength=len(distinct))
        top = np.lexsort((distinct, -n))[:LEXICON]
        lists.append(top[n[top] > 1])
    lexicon = np.unique(np.concatenate(lists))
    listed = np.stack([np.isin(lexicon, x) for x in lists], axis=1).astype(float)
    word, bucket = word_features(data, starts[at], ends[at])
    by_word = np.argsort(word, kind="stable")
    bucket, bounds = bucket[by_word], np.searchsorted(word[by_word], np.arange(len(at) + 1))
    in_lists = np.zeros((len(distinct), n_lang))
    in_lists[lexicon] = listed
    model = empty._replace(lexicon=distinct[lexicon], listed=listed)
    if n_lang == 1:
        return model
    random = np.random.default_rng(SEED)
    weights, transitions, lexical = model.weights, model.transitions, model.lexical
    squares = [np.full(x.shape, 1e-4) for x in (weights, transitions, lexical)]
    pool = [np.flatnonzero(label == k) for k in range(n_lang)]
    # Where the rows of a language begin in its pool, and how many words they have.
    sizes = [np.diff(first)[row_label == k] for k in range(n_lang)]
    sizes = [n[n > 0] for n in sizes]
    begins = [np.cumsum(n) - n for n in sizes]
    longest = max(map(len, pool))
    batch = 48
    for _ in range(min(STEPS, EPOCHS * max(1, longest * n_lang // (batch * STRETCH)))):
        # Sequences of STRETCH places; at each place the language may switch.
        switch = random.random((STRETCH, batch)) < 1 / SWITCH
        drawn = random.integers(0, n_lang, (STRETCH, batch))
        truth = drawn.copy()
        source = np.empty((STRETCH, batch), np.int64)
        for t in range(STRETCH):
            if t:
                truth[t] = np.where(switch[t], drawn[t], truth[t - 1])
            jump = np.ones(batch, bool) if t == 0 else truth[t] != truth[t - 1]
            for k in range(n_lang):
                here = truth[t] == k
                if not here.any() or not len(pool[k]):
                    continue
                one = random.integers(0, len(sizes[k]), batch)
                new = begins[k][one] + (random.random(batch) * sizes[k][one]).astype(np.int64)
                if t:
                    new = np.where(jump, new, (source[t - 1] + 1) % len(pool[k]))
                source[t, here] = new[here]
        words = np.empty((STRETCH, batch), np.int64)
        for k in range(n_lang):
            here = truth == k
            if len(pool[k]):
                words[here] = which[pool[k][source[here]]]
            else:
                words[here] = 0
        flat = words.ravel()
        n = bounds[flat + 1] - bounds[flat]
        positions = arrays.gathered(bounds[flat], n)
        owner, used = np.repeat(np.arange(len(flat)), n), bucket[positions]
        logits = np.stack([np.bincount(owner, weights[used, k], len(flat)) for k in range(n_lang)], axis=1)
        logits += in_lists[flat] @ lexical
        potential = np.exp(logits - logits.max(axis=1, keepdims=True)).reshape(STRETCH, batch, n_lang)
        step = np.exp(transitions)
        forward, backward, m = marginals(list(potential), step)
        wrong = np.stack(m)
        np.put_along_axis(
            wrong, truth[..., None], np.take_along_axis(wrong, truth[..., None], 2) - 1, 2
        )
        wrong = wrong.reshape(len(flat), n_lang)
        scale = 1 / batch
        gradient = np.stack([np.bincount(used, wrong[owner, k], BUCKETS) for k in range(n_lang)], axis=1)
        pairs = np.zeros((n_lang, n_lang))
        for t in range(STRETCH - 1):
            joint = forward[t][:, :, None] * step * (potential[t + 1] * backward[t + 1])[:, None, :]
            pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        np.subtract.at(pairs, (truth[:-1].ravel(), truth[1:].ravel()), 1)
        for value, slope, square in zip(
            (weights, transitions, lexical),
            (gradient * scale, pairs * scale, in_lists[flat].T @ wrong * scale),
            squares,
        ):
            slope = slope + 1e-5 * value
            square += slope**2
            value -= RATE * 0.2 * slope / np.sqrt(square)
    return model


# Labelling ---------------------------------------------------------------------------------------


class Labeller:
    """Sums of word marginals of the rows of a slice; keeps the weights of words it has met."""

    def __init__(self, model: Model):
        self.model = model
        self.step = np.exp(model.transitions)
        self.known = arrays.Numbering(19)
        self.kept = np.zeros((1 << 18, len(model.languages)))

    def potentials(self, data, starts, ends, hashes) -> np.ndarray:
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
                self.kept = np.zeros((self.known.keys.size // 2, self.kept.shape[1]))
            before = self.known.size
            self.known.add(distinct)
            logits = emissions(self.model, data, starts[at], ends[at], distinct)
            logits *= has_letter(data, starts[at], ends[at])[:, None]
            self.kept[before : self.known.size] = np.exp(
                np.maximum(logits - logits.max(axis=1, keepdims=True), -50)
            )
            number = self.known.find(hashes)
        return self.kept[number]

    @staticmethod
    def _steps(potential, low, high) -> list[np.ndarray]:
        """The potentials of lanes, longest first, step by step."""
        active = np.searchsorted(low - high, -np.arange(int((high - low).max())), "left")
        return [potential[low[:n] + t] for t, n in enumerate(active)]

    def sums(self, some: arrays.Slice):
        """Per row the sum of the marginals and the number of words with letters."""
        data, starts, ends, first, hashes = words_of(some)
        n_lang, n_rows = len(self.model.languages), some.last - some.first
        total, n_words = np.zeros((n_rows, n_lang)), np.zeros(n_rows)
        if not len(starts):
            return total, n_words
        potential = self.potentials(data, starts, ends, hashes)
        counts = has_letter(data, starts, ends).astype(float)
        n_lanes = -(-np.diff(first) // LANE)
        row = np.repeat(np.arange(n_rows), n_lanes)
        part = arrays.gathered(np.zeros(n_rows, np.int64), n_lanes)
        low = first[row] + part * LANE
        high = np.minimum(low + LANE, first[row + 1])
        order = np.argsort(low - high, kind="stable")  # longest first
        row, part, low, high = (x[order] for x in (row, part, low, high))
        steps = self._steps(potential, low, high)
        entering = leaving = None
        split = np.flatnonzero(n_lanes[row] > 1)
        if len(split):
            matrices = products(self._steps(potential, low[split], high[split]), self.step, part[split] == 0)
            in_order = np.lexsort((part[split], row[split]))
            parts_of = np.split(in_order, np.flatnonzero(np.diff(row[split][in_order])) + 1)
            entering, leaving = np.ones((2, len(row), n_lang))
            entering[split], leaving[split] = border_messages(matrices, self.step, parts_of)
        found = marginals(steps, self.step, entering, leaving)[2]
        lanes = np.zeros((len(row), n_lang))
        for t, m in enumerate(found):
            lanes[: len(m)] += m * counts[low[: len(m)] + t][:, None]
        for k in range(n_lang):
            total[:, k] = np.bincount(row, lanes[:, k], n_rows)
        return total, np.diff(np.concatenate([[0], np.cumsum(counts)])[first])


def identified(docs: DataFrame, model: Model | None, id_col="doc_id", text_col="text") -> DataFrame:
    """``(doc_id, lang_pred, score, shares)``: shares of the languages in a text's words."""
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(text_col).alias("text"),
        F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("has_letter"),
    )
    if model is None:
        return rows.select(
            "doc_id", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"),
            F.create_map().cast("map<string, double>").alias("shares"),
        )
    get = arrays.sent(docs.sparkSession, model)

    def label(batches, schema):
        fitted = get()
        labeller = Labeller(fitted)
        for batch in batches:
            named = batch.column("has_letter").to_numpy(zero_copy_only=False)
            parts = [labeller.sums(some) for some in arrays.slices(batch.column("text"))]
            total = np.concatenate([p[0] for p in parts]) if parts else np.zeros((0, len(fitted.languages)))
            n_words = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0)
            share = total / np.maximum(n_words, 1)[:, None]
            best = share.argmax(axis=1)
            named = named & (n_words > 0)
            yield arrays.batch(
                schema,
                {
                    "doc_id": batch.column("doc_id"),
                    "lang_pred": [fitted.languages[b] if ok else "und" for b, ok in zip(best, named)],
                    "score": np.where(named, share.max(axis=1).clip(0, 1), 0.0),
                    "shares": pa.array(
                        [[*zip(fitted.languages, s)] if ok else [] for s, ok in zip(share.tolist(), named)],
                        schema.field("shares").type,
                    ),
                },
            )

    return arrays.over(
        rows, label,
        "doc_id bigint, lang_pred string, score double, shares map<string, double>",
        ["doc_id", "text", "has_letter"],
    )

"""Removal of every word that lies in a run of ``WINDOW`` words which also starts earlier.

Suffix automata of reference shards. The text that can repeat is found first, so that the automata need not
hold the rest: positions are sampled by content (of the ``GRAM``-word strings inside a window the one with
the smallest hash is the window's anchor, so equal windows have equal anchors at equal places), and
anchors that occur once are done. The stretch that the windows of one anchor cover is its segment. The
different segments of the anchors that are left are the reference; they are dealt by anchor into shards of a
bounded number of words. Per shard a suffix automaton over words is built, its segments in corpus order,
so that every state knows where its words end first. The segments are then streamed through the automaton
for their matching statistics: the state of the last ``WINDOW`` words says where they were met first, and
every other place is removed. Of a segment that occurs several times one copy is streamed; all
copies but the first are removed as a whole.

An anchor with more than ``GROUP`` different segments would outgrow a shard. Its segments are cut
into their windows, which enter as anchors and segments of their own.

Words are runs of bytes without ASCII white space, compared unchanged; null texts have none. Windows are judged
on the input and lie inside one text. A null id counts as the largest. Rows with one id and one text are one
document (all are cut alike); rows with one id and different texts are documents of their own, ordered by
a hash of the text. Other columns are kept, whatever their names; an empty table stays empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import arrays
from reviewmill.llm.arrays import U64
from reviewmill.llm.joins import join_counted
from reviewmill.session import forget, materialise

WINDOW = 20
GRAM = 5
GROUP = 2048
SHARD_WORDS = 1 << 16
CHUNK_WORDS = 1 << 17
LAST_ID = (1 << 63) - 1

_PLACE = (U64(1) << U64(24)) - U64(1)


class Automaton:
    """The suffix automaton of several sequences; each state keeps the first place its strings end at."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.size = [0]
        self.first = [-1]

    def _split(self, before: int, symbol, state: int) -> int:
        """A copy of ``state`` for its strings that are one symbol longer than those of ``before``."""
        copy = len(self.next)
        self.next.append(dict(self.next[state]))
        self.size.append(self.size[before] + 1)
        self.link.append(self.link[state])
        self.first.append(self.first[state])
        self.link[state] = copy
        while before >= 0 and self.next[before].get(symbol) == state:
            self.next[before][symbol] = copy
            before = self.link[before]
        return copy

    def add(self, symbols, at: int) -> None:
        """Add a sequence whose symbols have the places ``at``, ``at + 1``, ... beyond all places so far."""
        next_, link, size, first = self.next, self.link, self.size, self.first
        last = 0
        for place, symbol in enumerate(symbols, at):
            known = next_[last].get(symbol)
            if known is not None:
                last = known if size[known] == size[last] + 1 else self._split(last, symbol, known)
                continue
            made = len(next_)
            next_.append({})
            size.append(size[last] + 1)
            link.append(0)
            first.append(place)
            before, last = last, made
            while before >= 0 and symbol not in next_[before]:
                next_[before][symbol] = made
                before = link[before]
            if before >= 0:
                known = next_[before][symbol]
                link[made] = known if size[known] == size[before] + 1 else self._split(before, symbol, known)

    def statistics(self, symbols, most: int):
        """For each place of a sequence: the length of the longest known string that ends there, ``most`` at
        most, and the first place it ends at."""
        next_, link, size, first = self.next, self.link, self.size, self.first
        state = length = 0
        lengths, firsts = [], []
        for symbol in symbols:
            while state and symbol not in next_[state]:
                state = link[state]
                length = size[state]
            known = next_[state].get(symbol)
            if known is not None:
                state, length = known, length + 1
                if length > most:
                    length = most
                while size[link[state]] >= length:  # the root has size 0 and length is positive
                    state = link[state]
            lengths.append(length)
            firsts.append(first[state])
        return lengths, firsts


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of ``width`` values."""
    return np.lib.stride_tricks.sliding_window_view(values, width).min(axis=1)


def _stretch_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash for each stretch of an array of hashes; order and length count."""
    powers = np.full(len(hashes) + 1, U64(0x9E3779B97F4A7C17))
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    inverse = np.full(len(hashes) + 1, U64(pow(0x9E3779B97F4A7C17, -1, 1 << 64)))
    inverse[0] = 1
    np.multiply.accumulate(inverse, out=inverse)
    sums = np.zeros(len(hashes) + 1, U64)
    np.cumsum(hashes * powers[:-1], out=sums[1:])
    return arrays.mixed((sums[ends] - sums[starts]) * inverse[starts] ^ (ends - starts).astype(U64))


def anchors_of(words: np.ndarray, first: np.ndarray, window: int, gram: int):
    """Row, anchor rank, segment rank, first window, number of windows and place of the anchor after the
    first window, for each anchor; ``words`` are hashes, row i's are those from first[i] to first[i + 1]."""
    none = np.zeros(0, np.int64)
    if len(words) < window:
        return none, none.view(U64), none.view(U64), none, none, none
    grams = arrays.chained(words, gram)
    # Hash in the high bits, place in the low ones: the smallest is the leftmost of equal hashes.
    keyed = (grams & ~_PLACE) | np.arange(len(grams), dtype=U64)
    best = _window_minima(keyed, window - gram + 1) & _PLACE
    inside = np.zeros(len(words) + 1, np.int64)
    long = np.diff(first) >= window
    np.add.at(inside, first[:-1][long], 1)
    np.add.at(inside, first[1:][long] - window + 1, -1)
    windows = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    anchor = best[windows].astype(np.int64)
    new = np.ones(len(windows), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (windows[1:] != windows[:-1] + 1)
    at = np.flatnonzero(new)
    low, n = windows[at], np.diff(np.append(at, len(windows)))
    anchor = anchor[at]
    segment = _stretch_hashes(words, low, low + n + window - 1)
    segment = arrays.mixed(segment ^ arrays.mixed((anchor - low).astype(U64)))
    row = np.searchsorted(first, low, "right") - 1
    return row, grams[anchor], segment, low - first[row], n, anchor - low


def _word_chunks(words: np.ndarray, first: np.ndarray, window: int):
    """Whole rows, or overlapping parts of the only row: (hashes, first word of each row, place in the row)."""
    if len(words) <= CHUNK_WORDS + window or len(first) > 2:
        yield words, first, 0
        return
    for at in range(0, len(words) - window + 1, CHUNK_WORDS):
        part = words[at : at + CHUNK_WORDS + window - 1]
        yield part, np.array([0, len(part)]), at


ANCHORS = "doc bigint, tie bigint, rank bigint, segment bigint, low int, n int, lead int"


def anchors(docs: DataFrame, window: int, gram: int) -> DataFrame:
    def sample(batches, schema):
        for rows in batches:
            keys = {c: rows.column(c).to_numpy() for c in ("doc", "tie")}
            for some in arrays.slices(rows.column("text")):
                starts, ends, first = arrays.spans(some.data, some.bounds, arrays.NOT_SPACE)
                words = arrays.Rolling(some.data).of(starts, ends)
                for part, firsts, at in _word_chunks(words, first, window):
                    row, rank, segment, low, n, lead = anchors_of(part, firsts, window, gram)
                    yield arrays.batch(
                        schema,
                        {
                            "doc": keys["doc"][some.first + row],
                            "tie": keys["tie"][some.first + row],
                            "rank": arrays.signed(rank),
                            "segment": arrays.signed(segment),
                            "low": low + at,
                            "n": n,
                            "lead": lead,
                        },
                    )

    return arrays.over(docs, sample, ANCHORS, ["doc", "tie", "text"])


def _bodies(docs: DataFrame, kinds: DataFrame, window: int) -> DataFrame:
    """``kinds`` with the text of their first segments, from its first word to its last."""
    asked = kinds.groupBy("doc", "tie").agg(F.collect_list(F.struct("rank", "low", "n", "lead", "split")).alias("asked"))

    def cut(batches, schema):
        for rows in batches:
            lists = rows.column("asked")
            flat = lists.flatten()
            rank, low, n, lead, split = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(5))
            counts = pc.list_value_length(lists).to_numpy()
            bounds = np.concatenate([[0], np.cumsum(counts)])
            for some in arrays.slices(rows.column("text")):
                starts, ends, first = arrays.spans(some.data, some.bounds, arrays.NOT_SPACE)
                a, b = bounds[some.first], bounds[some.last]
                row = np.repeat(np.arange(some.last - some.first), counts[some.first : some.last])
                word = first[row] + low[a:b]
                start, end = starts[word], ends[word + n[a:b] + window - 2]
                edges = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int32)
                yield arrays.batch(
                    schema,
                    {
                        "rank": rank[a:b],
                        "doc": rows.column("doc").to_numpy()[some.first + row],
                        "tie": rows.column("tie").to_numpy()[some.first + row],
                        "low": low[a:b],
                        "lead": lead[a:b],
                        "split": split[a:b],
                        "body": pa.Array.from_buffers(
                            pa.binary(),
                            len(row),
                            [None, pa.py_buffer(edges), pa.py_buffer(some.data[arrays.gathered(start, end - start)])],
                        ),
                    },
                )

    return arrays.over(
        docs.join(asked, ["doc", "tie"]), cut,
        "rank bigint, doc bigint, tie bigint, low int, lead int, split boolean, body binary",
        ["doc", "tie", "text", "asked"],
    )


def _single_windows(bodies: DataFrame, window: int) -> DataFrame:
    """The windows of ``bodies`` as segments of their own, ranked by their words."""

    def cut(batches, schema):
        for rows in batches:
            doc, tie, low, lead, rank = (
                rows.column(c).to_numpy() for c in ("doc", "tie", "low", "lead", "rank")
            )
            for some in arrays.slices(rows.column("body").cast(pa.large_binary()).cast(pa.large_string())):
                starts, ends, first = arrays.spans(some.data, some.bounds, arrays.NOT_SPACE)
                words = arrays.Rolling(some.data).of(starts, ends)
                n = np.diff(first) - window + 1
                at = arrays.gathered(first[:-1], n)
                row = np.repeat(np.arange(len(n)), n)
                place, of = at - first[row], some.first + row
                name = _stretch_hashes(words, at, at + window)
                name = arrays.mixed(name ^ arrays.mixed(rank[of].view(U64) + (lead[of] - place).astype(U64)))
                body_start, body_end = starts[at], ends[at + window - 1]
                edges = np.concatenate([[0], np.cumsum(body_end - body_start)]).astype(np.int32)
                yield arrays.batch(
                    schema,
                    {
                        "rank": arrays.signed(name),
                        "doc": doc[of],
                        "tie": tie[of],
                        "low": low[of] + place,
                        "body": pa.Array.from_buffers(
                            pa.binary(), len(row),
                            [None, pa.py_buffer(edges),
                             pa.py_buffer(some.data[arrays.gathered(body_start, body_end - body_start)])],
                        ),
                    },
                )

    return arrays.over(
        bodies, cut, "rank bigint, doc bigint, tie bigint, low int, body binary",
        ["rank", "doc", "tie", "low", "lead", "body"],
    )


def _repeated_in_shards(segments: DataFrame, shards: int, window: int) -> DataFrame:
    """``(doc, tie, start, end)``: runs of words of ``segments`` whose windows are met before in their shard."""
    shard = F.pmod(F.xxhash64("rank"), F.lit(shards)).cast("int")
    order = ["shard", "doc", "tie", "low"]
    dealt = (
        segments.select(shard.alias("shard"), "doc", "tie", "low", "body")
        .repartition("shard")
        .sortWithinPartitions(*order)
    )

    def resolve(rows: list, schema):
        ids: dict[bytes, int] = {}
        automaton, sequences, at = Automaton(), [], 0
        for *_, body in rows:
            sequence = [ids.setdefault(word, len(ids)) for word in body.split()]
            automaton.add(sequence, at)
            sequences.append(sequence)
            at += len(sequence)
        out, at = [], 0
        for (doc, tie, low, _), sequence in zip(rows, sequences):
            lengths, firsts = automaton.statistics(sequence, window)
            upto = -1
            for place in range(window - 1, len(sequence)):
                if lengths[place] == window and firsts[place] != at + place:
                    start, end = low + place - window + 1, low + place + 1
                    if start <= upto:
                        out[-1][3] = end
                    else:
                        out.append([doc, tie, start, end])
                    upto = end
            at += len(sequence)
        if out:
            yield arrays.batch(schema, dict(zip(("doc", "tie", "start", "end"), map(list, zip(*out)))))

    def run(batches, schema):
        waiting, current = [], None
        for rows in batches:
            columns = (rows.column(c).to_pylist() for c in ("shard", "doc", "tie", "low", "body"))
            for shard, *row in zip(*columns):
                if shard != current and waiting:
                    yield from resolve(waiting, schema)
                    waiting = []
                current = shard
                waiting.append(row)
        if waiting:
            yield from resolve(waiting, schema)

    return arrays.over(
        dealt, run, "doc bigint, tie bigint, start int, end int", ["shard", "doc", "tie", "low", "body"]
    )


def _shards(rows: DataFrame, words) -> int:
    return max(1, -(-int(rows.agg(F.sum(words)).first()[0] or 0) // SHARD_WORDS))


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """``(doc, tie, spans)`` of ``(doc, tie, text)``: runs of words that go, which may overlap."""
    where = ["doc", "tie", "low"]
    sampled = materialise(anchors(docs, window, gram), "word-anchors")
    shared = materialise(
        sampled.groupBy("rank").agg(F.count(F.lit(1)).alias("met")).where("met > 1"), "shared-ranks"
    )
    alive = materialise(join_counted(sampled, shared, ["rank"], "met").drop("met"), "shared-word-anchors")
    forget(sampled, shared)

    def firsts(rows: DataFrame, kind: list[str], *others) -> DataFrame:
        first = F.min(F.struct(*where)).alias("first")
        return rows.groupBy(*kind).agg(first, F.count(F.lit(1)).alias("met"), *others)

    def copies(rows: DataFrame, kinds: DataFrame, kind: list[str], n) -> DataFrame:
        """Whole segments beyond the first of their kind."""
        leaders = kinds.where("met > 1").select(*kind, F.struct(*where).alias("first"), "met")
        later = join_counted(rows, leaders, kind, "met").where(F.struct(*where) != F.col("first"))
        start = F.col("low")
        return later.select("doc", "tie", start.alias("start"), (start + n + (window - 1)).alias("end"))

    kinds = materialise(
        firsts(alive, ["rank", "segment"], F.min("n").alias("n"), F.min("lead").alias("lead")).select(
            "rank", "segment", "first.*", "n", "lead", "met"
        ),
        "segments",
    )
    whole = copies(alive, kinds, ["rank", "segment"], F.col("n"))
    hot = materialise(
        kinds.groupBy("rank").agg(F.count(F.lit(1)).alias("kinds")).where(F.col("kinds") > GROUP).select("rank", F.lit(True).alias("hot")),
        "hot-ranks",
    )
    marked = kinds.join(hot, "rank", "left").select("*", F.coalesce("hot", F.lit(False)).alias("split"))
    bodies = materialise(_bodies(docs, marked, window), "segment-texts")
    cold = _repeated_in_shards(
        bodies.where("NOT split"), _shards(kinds, F.col("n") + (window - 1)), window
    )
    # The windows of hot anchors: one text per rank, so all but the first go; the firsts are the reference.
    split = bodies.where("split")
    if split.isEmpty():
        found = whole.unionByName(cold)
    else:
        windows = materialise(_single_windows(split, window), "single-windows")
        met = firsts(windows, ["rank"], F.min_by("body", F.struct(*where)).alias("body"))
        met = materialise(met.where("met > 1").select("rank", "first.*", "body", "met"), "window-firsts")
        found = (
            whole.unionByName(cold)
            .unionByName(copies(windows.drop("body"), met, ["rank"], F.lit(1)))
            .unionByName(_repeated_in_shards(met, _shards(met, F.lit(window)), window))
        )
    spans = materialise(
        found.groupBy("doc", "tie").agg(F.collect_list(F.struct("start", "end")).alias("spans")), "word-spans"
    )
    forget(alive, kinds, bodies)
    return spans


def deduplicated(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col="doc_id", text_col="text", made="passage_dedup"
) -> DataFrame:
    """``docs`` with a column ``made``: ``n_words``, ``n_removed``, and ``kept``, the words left joined by spaces."""
    arrays.bounded_batches(docs.sparkSession)
    doc = F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST_ID))
    tie = F.xxhash64(F.col(id_col).isNull(), F.col(text_col))
    keyed = docs.select(doc.alias("doc"), tie.alias("tie"), F.col(text_col).alias("text"))
    # Repeated rows are one document.
    again = keyed.groupBy("doc", "tie").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1)
    spans = repeated_spans(
        keyed if again.isEmpty() else keyed.dropDuplicates(["doc", "tie"]), window, gram
    )
    names = {c: arrays.fresh([*docs.columns, made], f"pd_{c}") for c in ("doc", "tie", "spans")}
    spans = spans.select(*(F.col(c).alias(name) for c, name in names.items()))

    @F.arrow_udf("struct<n_words: bigint, n_removed: bigint, kept: string>")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        n_words, n_removed, kept = [], [], []
        for some in arrays.slices(texts):
            starts, ends, first = arrays.spans(some.data, some.bounds, arrays.NOT_SPACE)
            n = np.diff(first)
            mine = spans.slice(some.first, some.last - some.first)
            counts = pc.fill_null(pc.list_value_length(mine), 0).to_numpy()
            flat = mine.flatten()
            row = np.repeat(np.arange(len(n)), counts)
            change = np.zeros(len(starts) + 1, np.int64)
            if len(row):
                np.add.at(change, first[row] + flat.field(0).to_numpy(), 1)
                np.add.at(change, first[row] + flat.field(1).to_numpy(), -1)
            stays = np.cumsum(change[:-1]) == 0
            upto = np.concatenate([[0], np.cumsum(stays)])
            left = upto[first[1:]] - upto[first[:-1]]
            start, size = starts[stays], (ends - starts)[stays] + 1
            # Every word with the byte behind it, which becomes a space; the last one goes.
            data = np.append(some.data, np.uint8(32))
            joined = data[arrays.gathered(start, size)]
            edges = np.concatenate([[0], np.cumsum(size)])
            joined[edges[1:] - 1] = 32
            row_edges = edges[upto[first]]
            view = joined.tobytes()
            for i in range(len(n)):
                kept.append(view[row_edges[i] : max(row_edges[i], row_edges[i + 1] - 1)])
            n_words += n.tolist()
            n_removed += (n - left).tolist()
        return pa.StructArray.from_arrays(
            [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
            ["n_words", "n_removed", "kept"],
        )

    same = (doc == F.col(names["doc"])) & (tie == F.col(names["tie"]))
    return (
        docs.join(spans, same, "left")
        .withColumn(made, cut(F.col(text_col), F.col(names["spans"])))
        .drop(*names.values())
    )

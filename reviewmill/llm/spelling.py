"""Grouping of spelling variants: words that one inserted, deleted or replaced letter turns into each other.

K-d trees over letter-count vectors. One edit changes a word's letter counts by at most two in the L1
distance (one for an insertion, exactly two for a replacement), so near words are found by range searches
among the words of the same length (radius two) and of the next length (radius one). Per length the words are
dealt into the cells of a k-d tree whose splits come from a bounded sample; the splits decide balance, never
results. A word is sent to every cell whose box lies within the radius. Inside a cell a second k-d tree with
tight boxes is searched for all its visitors at once; for what is in reach, the order of the letters decides.
A cell with too many words is cut into pieces that all its visitors go to.

A word's form is its most frequent near word (ties: the first in code-point order), if that is at least
``RATIO`` times as frequent as the word itself. Frequencies grow along forms, so following them ends; the last one
is the word's root, found by doubling the steps.

Letters are A-Z, a-z and U+00C0 to U+00FF; words are maximal runs, of which only A-Z are lower-cased. Null
texts have no words, an id of null is written as nothing. Repeated rows count again, other columns play no
part, an empty table gives no word.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import arrays
from reviewmill.session import forget, materialise

EVERY = 97  # of so many runs one has a typing slip
LEAST_LETTERS = 5
LEAST_COUNT = 3
RATIO = 2
CELL = 4096  # words
CELL_BYTES = 4 << 20
SAMPLE = 100_000  # words that the splits come from
LEAF = 24
SPANS = 1 << 16
PAIRS = 1 << 19  # of visitors and boxes that are looked at together
DIMENSIONS = 32
MOST = 100  # counts beyond are equal; that only brings vectors closer

_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LEAD = 0xC3  # first byte of U+00C0 to U+00FF

# a-z have a dimension each, all other letters share the rest, which only brings vectors closer.
_DIMENSION = np.zeros(256, np.int64)
_DIMENSION[97:123] = np.arange(26)
_DIMENSION[192:256] = 26 + np.arange(64) % 6
_DIMENSION[65:91] = 26 + np.arange(26) % 6


# --- words and their counts


def _crc_steps(length: int) -> np.ndarray:
    """Tables [k, b]: what ``length`` zero bytes make of a CRC-32 state with the byte b at place k."""
    kept = arrays.process_cache().setdefault("crc-steps", [])
    if not kept:
        byte = np.arange(256, dtype=np.uint32)
        kept.append(np.stack([byte << np.uint32(8 * k) for k in range(4)]))
    one = np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], np.uint32)
    while len(kept) <= length:
        state = kept[-1]
        kept.append(one[state & np.uint32(255)] ^ (state >> np.uint32(8)))
    return kept[length]


def _after_prefix(prefix: np.ndarray, word: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of a prefix and a word behind it, from both alone: ``prefix`` are CRCs, ``word`` the states
    that the words' bytes leave from a state of zero."""
    state = prefix ^ np.uint32(0xFFFFFFFF)
    out = np.empty_like(state)
    order = np.argsort(lengths, kind="stable")
    edges = np.flatnonzero(np.diff(lengths[order], prepend=-1))
    for a, b in zip(edges, np.append(edges[1:], len(order))):
        at = order[a:b]
        step = _crc_steps(int(lengths[at[0]]))
        moved = state[at]
        out[at] = (
            step[0][moved & np.uint32(255)]
            ^ step[1][(moved >> np.uint32(8)) & np.uint32(255)]
            ^ step[2][(moved >> np.uint32(16)) & np.uint32(255)]
            ^ step[3][moved >> np.uint32(24)]
        )
    return out ^ word ^ np.uint32(0xFFFFFFFF)


class _Words:
    """Counts words of bounded number; what is full is handed on and begun again."""

    LONGEST = 200  # bytes of a word whose CRC is put together from tables

    def __init__(self):
        self.numbers = arrays.Numbering(18)
        self.clear()

    def clear(self) -> None:
        self.numbers.clear()
        self.words: list[bytes] = []
        self.states = np.zeros(1 << 17, np.uint32)
        self.counts = np.zeros(1 << 17, np.int64)
        self.slips: Counter = Counter()

    def _learn(self, hashes, starts, ends, data: bytes) -> None:
        known = self.numbers.find(hashes)
        new, where = np.unique(hashes[known < 0], return_index=True)
        at = np.flatnonzero(known < 0)[where]
        n = len(self.words)
        for s, e in zip(starts[at].tolist(), ends[at].tolist()):
            self.words.append(data[s:e])
        crcs = (zlib.crc32(w, 0xFFFFFFFF) ^ 0xFFFFFFFF for w in self.words[n:])
        self.states[n : len(self.words)] = np.fromiter(crcs, np.uint32, len(self.words) - n)
        self.numbers.add(new)

    def add(self, data: bytes, hashes, starts, ends, row, ids: list[bytes]) -> None:
        """Count one occurrence per run; ``ids`` are the rows' ids as text, with the colon."""
        self._learn(hashes, starts, ends, data)
        number = self.numbers.find(hashes).astype(np.int64)
        pairs, counts = np.unique(row << 20 | number, return_counts=True)
        row, number = pairs >> 20, pairs & ((1 << 20) - 1)
        lengths = np.fromiter(map(len, self.words), np.int64, len(self.words))[number]
        prefixes = np.fromiter(map(zlib.crc32, ids), np.uint32, len(ids))
        crc = np.empty(len(row), np.uint32)
        short = lengths <= self.LONGEST
        crc[short] = _after_prefix(prefixes[row[short]], self.states[number[short]], lengths[short])
        for i in np.flatnonzero(~short):
            crc[i] = zlib.crc32(self.words[number[i]], int(prefixes[row[i]]))
        slipped = crc % np.uint32(EVERY) == 0
        np.add.at(self.counts, number[~slipped], counts[~slipped])
        for i in np.flatnonzero(slipped):
            word = self.words[number[i]].decode()
            gone = int(crc[i]) % len(word)
            self.slips[word[:gone] + word[gone + 1 :]] += int(counts[i])

    def rows(self, least: int) -> dict:
        words = [w.decode() for w in self.words]
        found = [(w, n) for w, n in zip(words, self.counts.tolist()) if n and len(w) >= least]
        found += [(w, n) for w, n in self.slips.items() if len(w) >= least]
        return {"word": [w for w, _ in found], "n": [n for _, n in found]}


def word_counts(docs: DataFrame, least: int = LEAST_LETTERS) -> DataFrame:
    """``(word, n)`` of ``(doc_id, text)``: the words of at least ``least`` letters, slips included."""

    def count(batches, schema):
        held = _Words()
        for rows in batches:
            ids = [f"{'' if i is None else i}:".encode() for i in rows.column("doc_id").to_pylist()]
            for some in arrays.slices(rows.column("text")):
                lead = some.data == _LEAD
                inside = _LETTER[some.data] | lead
                inside[1:] |= lead[:-1]
                # One where a letter's byte is, as `spans` wants values to look up.
                starts, ends, first = arrays.spans(inside.view(np.uint8), some.bounds, np.array([False, True]))
                data = arrays.LOWER[some.data]
                hashes = arrays.Rolling(data).of(starts, ends)
                row = np.repeat(np.arange(len(first) - 1), np.diff(first))
                kept = ends - starts >= least  # a letter has at least a byte
                starts, ends, hashes, row = (x[kept] for x in (starts, ends, hashes, row))
                plain, mine = data.tobytes(), ids[some.first : some.last]
                for a in range(0, len(starts), SPANS):
                    part = slice(a, a + SPANS)
                    if held.numbers.full(len(starts[part])):
                        yield arrays.batch(schema, held.rows(least))
                        held.clear()
                    held.add(plain, hashes[part], starts[part], ends[part], row[part], mine)
        if held.words:
            yield arrays.batch(schema, held.rows(least))

    partial = arrays.over(docs, count, "word string, n bigint", ["doc_id", "text"])
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


# --- cells


def _vectors(words: list[bytes]) -> np.ndarray:
    """Letter counts of Latin-1 words, a row each."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.frombuffer(b"".join(words), np.uint8)
    row = np.repeat(np.arange(len(words)), lengths)
    counts = np.bincount(row * DIMENSIONS + _DIMENSION[letters], minlength=len(words) * DIMENSIONS)
    return np.minimum(counts, MOST).astype(np.uint8).reshape(-1, DIMENSIONS)


def _latin(words: pa.Array) -> list[bytes]:
    return [w.encode("latin-1") for w in words.to_pylist()]


def _median_split(points: np.ndarray) -> tuple[int, int] | None:
    """The dimension of the most even split and the largest value of its lower half."""
    best = None
    for d in np.argsort(-points.astype(np.float32).var(axis=0))[:8]:
        column = points[:, d]
        for value in {int(np.median(column)), int(np.median(column)) - 1}:
            lower = int((column <= value).sum())
            even = min(lower, len(points) - lower)
            if even > 0 and (best is None or even > best[0]):
                best = (even, int(d), value)
    return best and best[1:]


class Cells:
    """The k-d tree over the words of one length: splits, and the box of each node."""

    def __init__(self, sample: np.ndarray, leaves: int):
        self.low, self.high = [np.zeros(DIMENSIONS, np.uint8)], [np.full(DIMENSIONS, 255, np.uint8)]
        self.split: list[tuple[int, int]] = [(-1, 0)]
        self.child: list[int] = [0]  # the lower one; the upper one follows
        waiting = [(0, sample, leaves)]
        while waiting:
            node, points, parts = waiting.pop()
            found = _median_split(points) if parts > 1 and len(points) > 1 else None
            if found is None:
                continue
            d, value = found
            self.split[node], self.child[node] = found, len(self.low)
            upper = points[:, d] > value
            for side, its in ((False, points[~upper]), (True, points[upper])):
                low, high = self.low[node].copy(), self.high[node].copy()
                if side:
                    low[d] = value + 1
                else:
                    high[d] = value
                waiting.append((len(self.low), its, (parts + 1) // 2))
                self.low.append(low)
                self.high.append(high)
                self.split.append((-1, 0))
                self.child.append(0)
        self.low, self.high = np.stack(self.low), np.stack(self.high)
        self.split, self.child = np.array(self.split), np.array(self.child)

    def home(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point."""
        node = np.zeros(len(points), np.int64)
        open_ = np.flatnonzero(self.split[node, 0] >= 0)
        while len(open_):
            at = node[open_]
            d, value = self.split[at, 0], self.split[at, 1]
            node[open_] = self.child[at] + (points[open_, d] > value)
            open_ = open_[self.split[node[open_], 0] >= 0]
        return node

    def near(self, points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Point and leaf, where the leaf's box is within ``radius`` of the point."""
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        point, node = np.arange(len(points)), np.zeros(len(points), np.int64)
        while len(point):
            leaf = self.split[node, 0] < 0
            found.append((point[leaf], node[leaf]))
            point, node = point[~leaf], self.child[node[~leaf]]
            point, node = np.concatenate([point, point]), np.concatenate([node, node + 1])
            near = _box_distance(points[point], self.low[node], self.high[node]) <= radius
            point, node = point[near], node[near]
        return tuple(np.concatenate(x) for x in zip(*found))


def _box_distance(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """L1 distance of points to boxes, row by row."""
    below = np.maximum(low, points) - points
    above = np.maximum(points, high) - high
    return (below + above).sum(axis=1, dtype=np.int32)


def _trees(words: DataFrame, cell: int, sample: int) -> dict[int, Cells]:
    """A tree per length with more words than a cell holds, so there are at most as many as there are cells."""
    length = F.char_length("word")
    sizes = words.groupBy(length.alias("length")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell).collect()
    if not sizes:
        return {}
    total = sum(r["n"] for r in sizes)
    lengths = [r["length"] for r in sizes]
    share = min(1.0, sample / total)
    # By hash, so that a task that runs again takes the same words.
    taken = (F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1) & length.isin(lengths)
    rows = words.where(taken).select("word").toArrow()["word"].combine_chunks()
    known = sorted(_latin(rows))
    by_length: dict[int, list[bytes]] = {}
    for word in known:
        by_length.setdefault(len(word), []).append(word)
    return {
        r["length"]: Cells(_vectors(by_length[r["length"]]), -(-r["n"] // cell))
        for r in sizes
        if r["length"] in by_length
    }


# --- search inside a cell


class Points:
    """Words of one length with a k-d tree of tight boxes over their letter counts."""

    def __init__(self, words: list[bytes]):
        vectors = _vectors(words)
        order, low, high, spans, child = np.arange(len(words)), [], [], [], []
        waiting = [(0, len(words))]
        while waiting:
            # All nodes of a level, so that the children of a node are neighbours.
            following = []
            for a, b in waiting:
                its = vectors[order[a:b]]
                low.append(its.min(axis=0))
                high.append(its.max(axis=0))
                spans.append((a, b))
                d = int(np.argmax(high[-1] - low[-1]))
                if b - a <= LEAF or high[-1][d] == low[-1][d]:
                    child.append(-1)
                    continue
                d = int(np.argmax(its.astype(np.float32).var(axis=0)))
                value = np.median(its[:, d])
                upper = its[:, d] > value if (its[:, d] > value).any() else its[:, d] >= value
                order[a:b] = np.concatenate([order[a:b][~upper], order[a:b][upper]])
                middle = a + int((~upper).sum())
                child.append(0)
                following += [(a, middle), (middle, b)]
            waiting = following
        # Nodes are numbered level by level, children in the order of their parents.
        self.order, self.child = order, np.array(child)
        inner = np.flatnonzero(self.child == 0)
        self.child[inner] = 1 + 2 * np.arange(len(inner))
        self.low, self.high, self.spans = np.stack(low), np.stack(high), np.array(spans)
        self.vectors = vectors
        self.letters = np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)

    def within(self, vectors: np.ndarray, radius: int):
        """Visitor and word, where the letter counts are at most ``radius`` apart; in blocks."""
        waiting = [(np.arange(len(vectors)), np.zeros(len(vectors), np.int64))]
        while waiting:
            point, node = waiting.pop()
            if len(point) > PAIRS:
                half = len(point) // 2
                waiting += [(point[:half], node[:half]), (point[half:], node[half:])]
                continue
            near = _box_distance(vectors[point], self.low[node], self.high[node]) <= radius
            point, node = point[near], node[near]
            leaf = self.child[node] < 0
            if leaf.any():
                start, end = self.spans[node[leaf]].T
                for a, b in _blocks(end - start, PAIRS):
                    visitor = np.repeat(point[leaf][a:b], (end - start)[a:b])
                    word = self.order[arrays.gathered(start[a:b], (end - start)[a:b])]
                    mine, its = vectors[visitor], self.vectors[word]
                    apart = (np.maximum(mine, its) - np.minimum(mine, its)).sum(axis=1, dtype=np.int32)
                    yield visitor[apart <= radius], word[apart <= radius]
            point, node = point[~leaf], self.child[node[~leaf]]
            if len(point):
                waiting.append((np.concatenate([point, point]), np.concatenate([node, node + 1])))


def _blocks(sizes: np.ndarray, limit: int):
    """Runs of neighbours of at most ``limit`` in sum, or one larger one."""
    ends = np.cumsum(sizes)
    a = 0
    while a < len(sizes):
        b = int(np.searchsorted(ends, (ends[a - 1] if a else 0) + limit, "right"))
        b = max(b, a + 1)
        yield a, b
        a = b


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words of one length, a row each, differ in exactly one letter."""
    return (a != b).sum(axis=1) == 1


def one_inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Whether one letter less makes ``long`` the word ``short``, row by row."""
    before = np.logical_and.accumulate(short == long[:, :-1], axis=1).sum(axis=1)
    behind = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(axis=1)
    return before + behind >= short.shape[1]


def _near_in_cell(points: Points, visitors: list[bytes]):
    """Visitors and words of a cell that are near, in blocks."""
    vectors = _vectors(visitors)
    letters = np.frombuffer(b"".join(visitors), np.uint8).reshape(len(visitors), -1)
    same = letters.shape[1] == points.letters.shape[1]
    step = max(1, (PAIRS << 5) // points.letters.shape[1])
    for visitor, word in points.within(vectors, 2 if same else 1):
        for a in range(0, len(visitor), step):
            v, w = visitor[a : a + step], word[a : a + step]
            test = one_replaced if same else one_inserted
            near = test(letters[v], points.letters[w])
            yield v[near], w[near]


MET = "word string, n bigint, n_near bigint, best_n bigint, best string"


def _best(schema, words: list[str], n: np.ndarray, others: list[str], other_n: np.ndarray, near: tuple):
    """The batch of ``MET`` for pairs of positions in ``words`` and ``others``: one row per word."""
    mine, its = near
    # By frequency of the other, then its code points.
    met, at = np.unique(its, return_inverse=True)
    rank = np.empty(len(met), np.int64)
    rank[np.lexsort((np.array([others[i] for i in met]), -other_n[met]))] = np.arange(len(met))
    order = np.lexsort((rank[at], mine))
    mine, its = mine[order], its[order]
    first = np.flatnonzero(np.diff(mine, prepend=-1))
    count = np.diff(np.append(first, len(mine)))
    return arrays.batch(
        schema,
        {
            "word": [words[i] for i in mine[first]],
            "n": n[mine[first]],
            "n_near": count,
            "best_n": other_n[its[first]],
            "best": [others[i] for i in its[first]],
        },
    )


def near_words(words: DataFrame, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """``(word, n_near, best_n, best)`` of ``(word, n)``, for the words that have a near word."""
    get = arrays.sent(words.sparkSession, _trees(words, cell, sample))

    def by_length(rows):
        text, n = rows.column("word").to_pylist(), rows.column("n").to_numpy()
        encoded = [w.encode("latin-1") for w in text]
        lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
        for length in np.unique(lengths):
            at = np.flatnonzero(lengths == length)
            yield int(length), [text[i] for i in at], [encoded[i] for i in at], n[at]

    def settle(batches, schema):
        trees = get()
        for rows in batches:
            for length, text, encoded, n in by_length(rows):
                home = trees[length].home(_vectors(encoded)) if length in trees else np.zeros(len(text), np.int64)
                yield arrays.batch(
                    schema, {"word": text, "n": n, "length": np.full(len(text), length), "home": home}
                )

    settled = materialise(
        arrays.over(words, settle, "word string, n bigint, length int, home int", ["word", "n"]), "settled-words"
    )
    # Cells are full where the sample misled, or letter counts are alike; there are no more such cells than
    # words divided by the size of a cell.
    size = F.greatest(F.ceil(F.col("n") / (2 * cell)), F.ceil(F.col("n") * F.col("length") / CELL_BYTES))
    full = (
        settled.groupBy("length", "home").agg(F.count(F.lit(1)).alias("n"))
        .select("length", "home", size.cast("int").alias("pieces")).where("pieces > 1").collect()
    )
    pieces = {(r["length"], r["home"]): r["pieces"] for r in full}

    def visits(batches, schema):
        trees = get()
        for rows in batches:
            for length, text, encoded, n in by_length(rows):
                vectors = _vectors(encoded)
                own = trees[length].home(vectors) if length in trees else np.zeros(len(text), np.int64)
                for other, radius in ((length, 2), (length + 1, 1)):
                    if other in trees:
                        who, where = trees[other].near(vectors, radius)
                    else:
                        who, where = np.arange(len(text)), np.zeros(len(text), np.int64)
                    if other == length:
                        # Of two cells of one length the words of the first visit the second.
                        forward = where >= own[who]
                        who, where = who[forward], where[forward]
                    cuts = np.array([pieces.get((other, int(c)), 1) for c in where], np.int64)
                    piece = arrays.gathered(np.zeros(len(cuts), np.int64), cuts)
                    who, where = np.repeat(who, cuts), np.repeat(where, cuts)
                    # 1: a shorter guest; 2: a guest of this length; 3: at home, where both words of a pair visit.
                    visit = np.where(other != length, 1, np.where(where == own[who], 3, 2))
                    for a in range(0, len(who), 1 << 14):
                        part = slice(a, a + (1 << 14))
                        yield arrays.batch(
                            schema,
                            {
                                "length": np.full(len(who[part]), other),
                                "home": where[part],
                                "piece": piece[part],
                                "visit": visit[part],
                                "word": [text[i] for i in who[part]],
                                "n": n[who[part]],
                            },
                        )

    of_cell = F.lit(1)
    if pieces:
        cuts = [F.lit(x) for (length, home), p in pieces.items() for x in (f"{length}:{home}", p)]
        of_cell = F.coalesce(F.create_map(*cuts)[F.concat_ws(":", "length", "home")], F.lit(1))
    citizens = settled.select(
        "length", "home", F.pmod(F.xxhash64("word"), of_cell).cast("int").alias("piece"), F.lit(0).alias("visit"), "word", "n"
    )
    key = ["length", "home", "piece"]
    # A length without a word has no cell to visit, but its visitors cost a row at most twice.
    coming = arrays.over(settled, visits, "length int, home int, piece int, visit int, word string, n bigint", ["word", "n"])
    dealt = citizens.unionByName(coming).repartition(*key).sortWithinPartitions(*key, "visit")

    def meet(batches, schema):
        current, text, n, points = None, [], [], None
        for rows in batches:
            keys = np.stack([rows.column(c).to_numpy() for c in (*key, "visit")])
            edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            words_, ns = rows.column("word").to_pylist(), rows.column("n").to_numpy()
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(words_)]):
                if a == b:
                    continue
                cell_key, visit = tuple(keys[:3, a]), keys[3, a]
                if cell_key != current:
                    current, text, n, points = cell_key, [], [], None
                if visit == 0:
                    text += words_[a:b]
                    n += ns[a:b].tolist()
                    continue
                if not text:
                    continue
                if points is None:
                    points, its_n = Points([w.encode("latin-1") for w in text]), np.array(n)
                step = max(1, CELL_BYTES // len(words_[a]))
                for c in range(a, b, step):
                    visitors, visitor_n = words_[c : min(b, c + step)], ns[c : min(b, c + step)]
                    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
                    found += _near_in_cell(points, [w.encode("latin-1") for w in visitors])
                    v, w = (np.concatenate(x) for x in zip(*found))
                    if visit == 3:
                        keep = [visitors[i] < text[j] for i, j in zip(v.tolist(), w.tolist())]
                        v, w = v[np.array(keep, bool)], w[np.array(keep, bool)]
                    if len(v):
                        yield _best(schema, visitors, visitor_n, text, its_n, (v, w))
                        yield _best(schema, text, its_n, visitors, visitor_n, (w, v))

    met = arrays.over(dealt, meet, MET, [*key, "visit", "word", "n"])
    out = met.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), "best")).alias("first")
    )
    return out.select("word", "n_near", (-F.col("first.n")).alias("best_n"), "first.best")


# --- forms and roots


def grouped(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of ``(word, n)`` with distinct words."""
    near = near_words(words)
    follows = F.col("best_n") >= ratio * F.col("n")
    formed = materialise(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(follows, F.col("best")).alias("form"), F.when(follows, F.col("best_n")).alias("form_n"),
        ),
        "forms",
    )
    # Only words with a form have a way to go; each round doubles the steps behind them.
    ways = materialise(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "ways")
    while True:
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = ways.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")
        )
        moved = materialise(stepped, "ways")
        forget(ways)
        ways = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return formed.join(ways, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def variants(docs: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT) -> DataFrame:
    """The words of ``(doc_id, text)`` with at least ``least_count`` occurrences, grouped."""
    words = word_counts(docs, least_letters).where(F.col("n") >= least_count)
    return grouped(materialise(words, "words"))

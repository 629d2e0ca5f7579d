"""Near-duplicate documents: MinHash bands, sequential Bayesian verification, exact check.

1. Each document becomes its set of distinct word shingles (64-bit hashes), a 128-bit key of the set, a
   MinHash signature and the signature's bands. Documents with one set are one text from here on.
2. Texts that share a band with the band's first text are candidates. Signatures are compared in
   batches: after each, given m equal of n values, the similarity has a beta posterior, and the pair is dropped
   when the probability that it reaches the threshold is below ``MISS``.
3. Of each text's candidates the most similar one is verified on the full sets, and the links found make
   components. A band's first text is the one that shares most bands, so that the text a group was
   copied from links most of the group at once.
4. A band whose texts are still in several components holds pairs nobody has compared. All texts of a band
   outside its largest component are compared with all its texts in other components by signature, in
   blocks of ``BLOCK`` by ``BLOCK`` texts that are compared inside a task; what leaves the task is not the
   pairs but which texts hang together. In these groups, again in blocks, the same pairs are verified on
   the full sets, and links between components leave the task. A pair is left out only if both are in
   one component, so no link between components is lost.

Null and empty texts have no shingles and are linked with nothing. A text with fewer words than a
shingle has the sequence of them as its only shingle. A row with a null id is linked with nothing, its
component is null, and it is kept. Repeated rows are in one component and get a row each. Other columns are
left out.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import arrays, graph
from reviewmill.llm.arrays import U64
from reviewmill.llm.joins import join_counted
from reviewmill.session import materialise

SHINGLE = 5
PERCENT = 80
BANDS = 32
BAND_ROWS = 5
BATCH = 32
MISS = 1e-5
BLOCK = 512

_random = np.random.default_rng(42)
_TIMES = _random.integers(0, 1 << 64, BANDS * BAND_ROWS, dtype=U64) | U64(1)
_PLUS = _random.integers(0, 1 << 64, BANDS * BAND_ROWS, dtype=U64)
_BAND_KINDS = arrays.mixed(np.arange(301, 301 + BANDS, dtype=U64))
_OTHER = U64(0x8CB92BA72F3D8DD7)


def shingles(some: arrays.Slice, size: int):
    """Sorted distinct shingle hashes of the rows, one after the other, and where each row's start."""
    data = arrays.LOWER[some.data]
    starts, ends, first = arrays.spans(data, some.bounds, arrays.NOT_SPACE)
    words = arrays.Rolling(data).of(starts, ends)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    hashes = arrays.chained(words, size)
    inside = np.arange(len(hashes)) + size <= first[row[: len(hashes)] + 1]
    hashes, row = hashes[inside], row[: len(inside)][inside]
    n = np.diff(first)
    short = np.flatnonzero((n > 0) & (n < size))
    if len(short):
        whole = [arrays.chained(words[first[i] : first[i + 1]], int(n[i]))[0] ^ U64(n[i]) for i in short]
        hashes = np.concatenate([hashes, np.array(whole, U64)])
        row = np.concatenate([row, short])
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    new = np.ones(len(hashes), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    hashes, row = hashes[new], row[new]
    return hashes, np.searchsorted(row, np.arange(len(first)))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([np.zeros(1, U64), np.cumsum(values, dtype=U64)])[bounds])


def _sketch(size: int):
    def sketch(batches, schema):
        for rows in batches:
            for some in arrays.slices(rows.column("text")):
                hashes, bounds = shingles(some, size)
                n = np.diff(bounds)
                full = np.flatnonzero(n > 0)
                least = np.zeros((len(_TIMES), len(full)), U64)
                if len(full):
                    at = bounds[full]
                    for k in range(len(_TIMES)):
                        least[k] = np.minimum.reduceat(hashes * _TIMES[k] + _PLUS[k], at)
                bands = np.zeros((len(full), BANDS), U64)
                for b in range(BANDS):
                    value = np.full(len(full), _BAND_KINDS[b], U64)
                    for k in range(b * BAND_ROWS, (b + 1) * BAND_ROWS):
                        value = arrays.mixed(value ^ least[k])
                    bands[:, b] = value
                # The first value of every band first, so that a batch draws on all bands.
                order = np.arange(len(_TIMES)).reshape(BANDS, BAND_ROWS).T.ravel()
                bytes_of = (arrays.mixed(least[order]) & U64(255)).astype(np.uint8).T
                signature = [b""] * len(n)
                band_lists = [[]] * len(n)
                for i, s, b in zip(full.tolist(), bytes_of, arrays.signed(bands)):
                    signature[i], band_lists[i] = s.tobytes(), b
                yield arrays.batch(
                    schema,
                    {
                        "doc": rows.column("doc").slice(some.first, some.last - some.first),
                        "n": n,
                        "key1": arrays.signed(_sums(arrays.mixed(hashes), bounds)),
                        "key2": arrays.signed(_sums(arrays.mixed(hashes ^ _OTHER), bounds)),
                        "signature": signature,
                        "bands": band_lists,
                    },
                )

    return sketch


def least_matches(percent: int, n_values: int, miss: float) -> list[tuple[int, int]]:
    """After how many values how many must be equal for a pair to stay.

    With a uniform prior, m equal values of n give the similarity a Beta(m + 1, n - m + 1) posterior,
    whose tail above t is the chance of at most m successes in n + 1 trials of chance t.
    """
    t, out = percent / 100, []
    for n in range(BATCH, n_values + 1, BATCH):
        tail, m = 0.0, -1
        while m < n:
            tail += comb(n + 1, m + 1) * t ** (m + 1) * (1 - t) ** (n - m)
            m += 1
            if tail >= miss:
                break
        out.append((n, m))
    return out


def plausible(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """``(a, b, equal)``: pairs whose signatures do not rule the threshold out, with equal values."""
    sides = [
        texts.select(F.col("doc").alias(side), F.col("signature").alias(f"signature_{side}"))
        for side in ("a", "b")
    ]
    bounds = least_matches(percent, BANDS * BAND_ROWS, MISS)

    @F.arrow_udf("int")
    def equal(left: pa.Array, right: pa.Array) -> pa.Array:
        width = BANDS * BAND_ROWS
        one, other = (
            np.frombuffer(b"".join(x.to_pylist()), np.uint8).reshape(-1, width) for x in (left, right)
        )
        matches = np.zeros(len(one), np.int32)
        alive = np.arange(len(one))
        for n, least in bounds:
            same = one[alive, n - BATCH : n] == other[alive, n - BATCH : n]
            matches[alive] += same.sum(axis=1, dtype=np.int32)
            dropped = matches[alive] < least
            matches[alive[dropped]] = -1
            alive = alive[~dropped]
        return pa.array(matches, pa.int32())

    return (
        pairs.join(sides[0], "a")
        .join(sides[1], "b")
        .select("a", "b", equal("signature_a", "signature_b").alias("equal"))
        .where("equal >= 0")
    )


def full_sets(docs: DataFrame, asked: DataFrame, size: int) -> DataFrame:
    """``(doc, hashes)``: the sorted shingle hashes of the asked documents."""

    def made(batches, schema):
        for rows in batches:
            for some in arrays.slices(rows.column("text")):
                hashes, bounds = shingles(some, size)
                yield arrays.batch(
                    schema,
                    {
                        "doc": rows.column("doc").slice(some.first, some.last - some.first),
                        "hashes": [
                            hashes[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())
                        ],
                    },
                )

    wanted = docs.join(asked, "doc", "left_semi")
    return materialise(
        arrays.over(wanted, made, "doc bigint, hashes binary", ["doc", "text"]).dropDuplicates(["doc"]),
        "full-sets",
    )


def verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The ``(a, b)`` whose full shingle sets reach the threshold."""
    asked = pairs.select(F.col("a").alias("doc")).union(pairs.select("b")).distinct()
    sets = full_sets(docs, asked, size)
    sides = [sets.select(F.col("doc").alias(s), F.col("hashes").alias(f"set_{s}")) for s in ("a", "b")]

    @F.arrow_udf("boolean")
    def similar(left: pa.Array, right: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(left, right):
            one, other = (np.frombuffer(v.as_buffer(), U64) for v in (x, y))
            both = len(np.intersect1d(one, other, assume_unique=True))
            out.append(100 * both >= percent * (len(one) + len(other) - both))
        return pa.array(out, pa.bool_())

    return (
        pairs.select("a", "b")
        .join(sides[1], "b")
        .join(sides[0], "a")
        .where(similar("set_a", "set_b"))
        .select("a", "b")
    )


# Groups in blocks --------------------------------------------------------------------------------


def _near_size(n: str, m: str, percent: int) -> str:
    return f"100 * least({n}, {m}) >= {percent} * greatest({n}, {m})"


def open_groups(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows ``(group, doc, ...)`` of the groups in several components, with ``root`` and ``outside``.

    ``outside`` marks texts outside the group's largest component; ``all_blocks`` and ``outside_blocks``
    say into how many blocks the group's texts and those outside have to be dealt.
    """
    named = rows.join(roots.withColumnRenamed("node", "doc"), "doc", "left").withColumn(
        "root", F.coalesce("root", "doc")
    )
    per_group = (
        named.groupBy("group", "root")
        .agg(F.count(F.lit(1)).alias("texts"))
        .groupBy("group")
        .agg(
            F.sum("texts").alias("texts"),
            F.max("texts").alias("most"),
            F.max_by("root", F.struct("texts", "root")).alias("main"),
        )
        .where("texts > most")
        .select(
            "group",
            "main",
            F.ceil(F.col("texts") / BLOCK).cast("int").alias("all_blocks"),
            F.ceil((F.col("texts") - F.col("most")) / BLOCK).cast("int").alias("outside_blocks"),
        )
    )
    return (
        named.join(per_group, "group").withColumn("outside", F.col("root") != F.col("main")).drop("main")
    )


def in_blocks(marked: DataFrame, compare, ddl: str) -> DataFrame:
    """``compare`` over every block of texts outside with every block of texts of their group.

    ``compare(tile)`` gets an Arrow table with a column ``role`` (0: compare with, 1: compare, 2: both)
    and returns links as a list of pairs.
    """
    block = F.pmod(F.xxhash64("doc"), F.col("all_blocks")).cast("int")
    own = F.pmod(F.xxhash64("doc", F.lit(1)), F.col("outside_blocks")).cast("int")

    def place(i, k, role):
        return F.struct(i.alias("i"), k.alias("k"), role.alias("role"))

    zero = F.lit(0)
    alone = F.array(place(zero, zero, F.when(F.col("outside"), 2).otherwise(0)))
    as_one_of_all = F.transform(
        F.sequence(zero, F.col("outside_blocks") - 1), lambda i: place(i, block, zero)
    )
    as_outside = F.transform(
        F.sequence(zero, F.col("all_blocks") - 1), lambda k: place(own, k, F.lit(1))
    )
    places = F.when((F.col("all_blocks") == 1) & (F.col("outside_blocks") == 1), alone).otherwise(
        F.when(F.col("outside"), F.concat(as_one_of_all, as_outside)).otherwise(as_one_of_all)
    )
    dealt = marked.withColumn("place", F.explode(places)).select(
        "group", "place.*", *[c for c in marked.columns if c not in ("group", "all_blocks", "outside_blocks", "outside")]
    )
    key = ["group", "i", "k"]
    sorted_rows = dealt.repartition(*key).sortWithinPartitions(*key)

    def tiles(batches):
        waiting: list[pa.RecordBatch] = []
        last = None
        for rows in batches:
            if not len(rows):
                continue
            keys = np.stack([rows.column(c).to_numpy() for c in key])
            change = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            edges = [0, *change.tolist(), len(rows)]
            for a, b in zip(edges[:-1], edges[1:]):
                this = tuple(keys[:, a].tolist())
                if waiting and this != last:
                    yield pa.Table.from_batches(waiting)
                    waiting = []
                last = this
                waiting.append(rows.slice(a, b - a))
        if waiting:
            yield pa.Table.from_batches(waiting)

    def run(batches, schema):
        found: list[tuple[int, int]] = []
        for tile in tiles(batches):
            found += compare(tile)
            if len(found) >= 10_000:
                yield arrays.batch(schema, {"a": [a for a, _ in found], "b": [b for _, b in found]})
                found = []
        yield arrays.batch(schema, {"a": [a for a, _ in found], "b": [b for _, b in found]})

    return arrays.over(sorted_rows, run, ddl, dealt.columns)


class _Joined:
    """Which values hang together, by links added one by one."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _likely_in(tile: pa.Table, percent: int, bounds: list[tuple[int, int]]):
    """Each text to compare, with the texts of other components that its signature does not rule out."""
    role, doc, root, n = (tile[c].to_numpy() for c in ("role", "doc", "root", "n"))
    width = BANDS * BAND_ROWS
    signature = np.frombuffer(b"".join(tile["signature"].to_pylist()), np.uint8).reshape(-1, width)
    asks, others = np.flatnonzero(role > 0), np.flatnonzero(role != 1)
    step = max(1, (1 << 22) // max(1, len(others) * BATCH))
    for at in range(0, len(asks), step):
        mine = asks[at : at + step]
        fits = (root[mine][:, None] != root[others][None]) & (
            100 * np.minimum(n[mine][:, None], n[others][None])
            >= percent * np.maximum(n[mine][:, None], n[others][None])
        )
        one, other = np.nonzero(fits)
        one, other = mine[one], others[other]
        equal = np.zeros(len(one), np.int64)
        for upto, least in bounds:
            equal += (
                signature[one, upto - BATCH : upto] == signature[other, upto - BATCH : upto]
            ).sum(axis=1)
            stays = equal >= least
            one, other, equal = one[stays], other[stays], equal[stays]
        edges = np.searchsorted(one, mine, "left"), np.searchsorted(one, mine, "right")
        for i, a, b in zip(mine.tolist(), *(e.tolist() for e in edges)):
            if b > a:
                # The most similar first.
                yield i, other[a:b][np.argsort(-equal[a:b], kind="stable")]


def _hang_together(percent: int):
    bounds = least_matches(percent, BANDS * BAND_ROWS, MISS)

    def compare(tile: pa.Table) -> list[tuple[int, int]]:
        doc, joined, out = tile["doc"].to_numpy(), _Joined(), []
        for one, others in _likely_in(tile, percent, bounds):
            a = int(doc[one])
            out += [(a, b) for b in doc[others].tolist() if joined.join(a, b)]
        return out

    return compare


def _linked(percent: int):
    bounds = least_matches(percent, BANDS * BAND_ROWS, MISS)

    def compare(tile: pa.Table) -> list[tuple[int, int]]:
        doc, root = tile["doc"].to_numpy(), tile["root"].to_numpy()
        sets = [np.frombuffer(x.as_buffer(), U64) for x in tile["hashes"].combine_chunks()]
        joined, out = _Joined(), []
        for one, others in _likely_in(tile, percent, bounds):
            mine = sets[one]
            for at in range(0, len(others), 64):
                # Components that have met meanwhile need no further link.
                some = [
                    i for i in others[at : at + 64].tolist()
                    if joined.root(int(root[one])) != joined.root(int(root[i]))
                ]
                if not some:
                    continue
                sizes = np.array([len(sets[i]) for i in some])
                every = np.concatenate([sets[i] for i in some])
                place = np.searchsorted(mine, every).clip(0, len(mine) - 1)
                both = np.add.reduceat(mine[place] == every, np.cumsum(sizes) - sizes, dtype=np.int64)
                good = 100 * both >= percent * (sizes + len(mine) - both)
                out += [
                    (int(doc[one]), int(doc[i]))
                    for i, ok in zip(some, good.tolist())
                    if ok and joined.join(int(root[one]), int(root[i]))
                ]
        return out

    return compare


def components(
    docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, id_col="doc_id", text_col="text"
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for each row of ``docs``."""
    arrays.bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).alias("text"))
    sketches = materialise(
        arrays.over(
            texts, _sketch(size),
            "doc bigint, n bigint, key1 bigint, key2 bigint, signature binary, bands array<bigint>",
            ["doc", "text"],
        ),
        "sketches",
    )
    key = ["key1", "key2", "n"]
    first = materialise(
        sketches.where("n > 0 AND doc IS NOT NULL").groupBy(*key).agg(
            F.min("doc").alias("first"), F.count(F.lit(1)).alias("met")
        ),
        "first-texts",
    )
    members = materialise(
        join_counted(sketches.select("doc", *key), first, key, "met", "left").select("doc", "n", F.expr("if(doc IS NULL, NULL, coalesce(first, doc))").alias("first")),
        "members",
    )
    firsts = members.where("doc = first AND n > 0").select("doc").distinct()
    distinct = materialise(
        sketches.select("doc", "n", "signature", "bands").join(firsts, "doc", "left_semi").dropDuplicates(["doc"]),
        "distinct-texts",
    )

    banded = distinct.select("doc", "n", F.explode("bands").alias("band"))
    sizes = materialise(banded.groupBy("band").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1"), "band-sizes")
    # Only bands that several texts share go on.
    shared = materialise(join_counted(banded, sizes, ["band"], "texts"), "shared-bands")
    company = shared.groupBy("doc").agg(F.sum("texts").alias("company"))
    shared = materialise(shared.drop("texts").join(company, "doc"), "shared-bands")
    heads = shared.groupBy("band").agg(
        F.max(F.struct("company", (-F.col("doc")).alias("less"), "n")).alias("head"), F.count(F.lit(1)).alias("texts")
    )
    star = (
        join_counted(shared, materialise(heads, "band-heads"), ["band"], "texts")
        .select("doc", (-F.col("head.less")).alias("hub"), "n", F.col("head.n").alias("m"))
        .where("doc <> hub AND " + _near_size("n", "m", percent))
        .select(F.col("hub").alias("a"), F.col("doc").alias("b"))
        .distinct()
    )
    likely = plausible(star, distinct, percent)
    best = materialise(
        likely.groupBy("b").agg(F.max_by("a", F.struct("equal", "a")).alias("a")).select("a", "b"), "best"
    )
    links = materialise(verified(best, texts, size, percent), "links")
    roots = materialise(graph.components(links), "roots")

    marked = open_groups(shared.select(F.col("band").alias("group"), "doc", "n"), roots)
    signatures = distinct.select("doc", "signature")
    together = materialise(
        in_blocks(marked.join(signatures, "doc"), _hang_together(percent), "a bigint, b bigint"), "together"
    )
    if not together.isEmpty():
        groups = graph.components(together).select(F.col("root").alias("group"), F.col("node").alias("doc"))
        asked = materialise(groups, "groups")
        sets = full_sets(texts, asked.select("doc"), size)
        marked = open_groups(asked.join(distinct.select("doc", "n", "signature"), "doc"), roots)
        more = materialise(
            in_blocks(marked.join(sets, "doc"), _linked(percent), "a bigint, b bigint"), "links"
        )
        roots = graph.components(links.union(more))

    named = members.join(roots.withColumnRenamed("node", "first"), "first", "left")
    return named.select(
        F.col("doc").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.coalesce("root", "first").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))

"""Removal of lines that an earlier document holds, by probing sharded perfect-hash arrays.

A line's key is the line without white space at its ends, A-Z in lower case; keys of at least
``MIN_CHARS`` code points found in two documents or more lose their lines everywhere but in the
document with the smallest id. All distinct keys are dealt into shards by hash; a task builds for each shard a minimal
perfect hash and, in its order, arrays of fingerprints, first documents and counts. The documents' keys
(16 bytes each, one per document and key) are dealt to the shards, probe the arrays, and what they read
there decides. A shard that very many keys probe, as one line may be held by a third
of all documents, is copied, and each copy gets a bounded share of the probes.

Null and empty texts are one empty line. Rows with one id are one document; a null id is a document
after all others. Keys are 128-bit hashes, all of whose bits place a key, so that lines with one 64-bit half
are told apart. Other columns are kept, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import arrays
from reviewmill.llm.arrays import U64
from reviewmill.session import materialise

MIN_CHARS = 10
SHARD_KEYS = 50_000
GROUP_PROBES = 50_000
LAST_ID = (1 << 63) - 1  # stands for a null id

_FIRST_LEVEL = U64(0xD6E8FEB86659FD93)


def lines_of(some: arrays.Slice):
    """Starts, ends, first line of each row, and the 128-bit keys of the lines.

    Lines without a key (too short) have ``has_key`` false.
    """
    data, bounds = some.data, some.bounds
    breaks = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([bounds[:-1], breaks + 1]), kind="stable")
    ends = np.sort(np.concatenate([bounds[1:], breaks]), kind="stable")
    n_breaks = np.searchsorted(breaks, bounds)
    first = n_breaks + np.arange(len(bounds))
    full = np.flatnonzero(arrays.NOT_SPACE[data])
    low, high = np.searchsorted(full, starts), np.searchsorted(full, ends)
    some_full = high > low
    full = np.append(full, 0)
    key_starts = np.where(some_full, full[np.minimum(low, len(full) - 1)], starts)
    key_ends = np.where(some_full, full[high - 1] + 1, starts)
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    has_key = chars[key_ends] - chars[key_starts] >= MIN_CHARS
    lower = arrays.LOWER[data]
    h = arrays.Rolling(lower).of(key_starts, key_ends)
    f = arrays.Rolling(lower, 1).of(key_starts, key_ends)
    return starts, ends, first, h, f, has_key


def line_keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(h, f, doc)``: each document's distinct line keys."""

    def keys(batches, schema):
        for rows in batches:
            ids = rows.column(0).to_numpy()
            for some in arrays.slices(rows.column(1)):
                _, _, first, h, f, has_key = lines_of(some)
                row = np.repeat(np.arange(some.first, some.last), np.diff(first))
                h, f, row = h[has_key], f[has_key], row[has_key]
                order = np.lexsort((f, h, row))
                h, f, row = h[order], f[order], row[order]
                new = np.ones(len(h), dtype=bool)
                new[1:] = (h[1:] != h[:-1]) | (f[1:] != f[:-1]) | (row[1:] != row[:-1])
                yield arrays.batch(
                    schema,
                    {"h": arrays.signed(h[new]), "f": arrays.signed(f[new]), "doc": ids[row[new]]},
                )

    base = docs.select(_document(id_col).alias("doc"), F.col(text_col).alias("text"))
    return arrays.over(base, keys, "h bigint, f bigint, doc bigint", ["doc", "text"])


def _document(id_col: str):
    return F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST_ID))


# A shard: minimal perfect hash, fingerprints, first documents, counts ------------------------


def _hash(h: np.ndarray, f: np.ndarray, level: int) -> np.ndarray:
    return arrays.mixed(h ^ arrays.mixed(f + np.full(1, level + 1, U64) * _FIRST_LEVEL))


def _fingerprint(h: np.ndarray, f: np.ndarray) -> np.ndarray:
    return (arrays.mixed(h + f) >> U64(32)).astype("<u4")


def build(h: np.ndarray, f: np.ndarray, first: np.ndarray, count: np.ndarray) -> dict:
    """The arrays of one shard, given distinct keys.

    Each level is a bit array with two bits for each key that is left; keys alone on their bit stay
    there, the others go on to the next level. A key's number is the rank of its bit.
    """
    left, levels, bits = np.arange(len(h)), [], []
    numbers = np.empty(len(h), np.int64)
    numbered = 0
    while len(left):
        size = max(8, 2 * len(left))
        place = (_hash(h[left], f[left], len(levels)) % U64(size)).astype(np.int64)
        alone = np.bincount(place, minlength=size) == 1
        stays = alone[place]
        rank = np.cumsum(alone) - 1
        numbers[left[stays]] = numbered + rank[place[stays]]
        numbered += int(alone.sum())
        levels.append(size)
        bits.append(alone)
        left = left[~stays]
        if len(levels) > 200:
            raise ValueError("a key was given twice")
    order = np.empty(len(h), np.int64)
    order[numbers] = np.arange(len(h))
    return {
        "levels": levels,
        "bits": np.packbits(np.concatenate(bits)).tobytes() if bits else b"",
        "fingerprints": _fingerprint(h, f)[order].tobytes(),
        "firsts": first[order].astype("<i8").tobytes(),
        "counts": count[order].astype("<i8").tobytes(),
    }


def probe(shard: dict, h: np.ndarray, f: np.ndarray):
    """Whether each key is in the shard, and its first document and count if so."""
    firsts = np.frombuffer(shard["firsts"], "<i8")
    counts = np.frombuffer(shard["counts"], "<i8")
    fingerprints = np.frombuffer(shard["fingerprints"], "<u4")
    levels = list(shard["levels"])
    bits = np.unpackbits(np.frombuffer(shard["bits"], np.uint8))[: sum(levels)]
    ranks = np.cumsum(bits, dtype=np.int64) - 1
    number = np.full(len(h), -1, np.int64)
    left, base = np.arange(len(h)), 0
    for level, size in enumerate(levels):
        place = base + (_hash(h[left], f[left], level) % U64(size)).astype(np.int64)
        hit = bits[place] == 1
        number[left[hit]] = ranks[place[hit]]
        left = left[~hit]
        base += size
    known = number >= 0
    known[known] = fingerprints[number[known]] == _fingerprint(h[known], f[known])
    at = np.where(known, number, 0)
    return known, firsts[at] if len(firsts) else at, counts[at] if len(counts) else at


SHARD = "shard bigint, levels array<bigint>, bits binary, fingerprints binary, firsts binary, counts binary"


def shards_of(distinct: DataFrame, n_shards: int) -> DataFrame:
    def one(table: pa.Table) -> pa.Table:
        h, f = (table[c].to_numpy().view(U64) for c in ("h", "f"))
        made = build(h, f, table["first"].to_numpy(), table["n"].to_numpy())
        return pa.table(
            {
                "shard": pa.array([table["shard"][0].as_py()], pa.int64()),
                "levels": pa.array([made["levels"]], pa.list_(pa.int64())),
                **{c: pa.array([made[c]], pa.binary()) for c in ("bits", "fingerprints", "firsts", "counts")},
            }
        )

    shard = F.pmod("h", F.lit(n_shards))
    return distinct.withColumn("shard", shard).groupBy("shard").applyInArrow(one, SHARD)


def dropped_keys(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """``(doc, drops)``: the keys whose lines a document loses, for documents that lose any."""
    keys = materialise(line_keys(docs, id_col, text_col), "line-keys")
    # Partial sums before the shuffle: a key that all documents hold is a row per task.
    distinct = materialise(
        keys.groupBy("h", "f").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("n")),
        "distinct-lines",
    )
    n_shards = max(1, -(-distinct.count() // SHARD_KEYS))
    shards = materialise(shards_of(distinct, n_shards), "shards")
    dealt = keys.withColumn("shard", F.pmod("h", F.lit(n_shards)))
    # One row per shard.
    copies = dealt.groupBy("shard").agg(
        F.ceil(F.count(F.lit(1)) / GROUP_PROBES).cast("int").alias("copies")
    )
    copied = shards.join(copies, "shard").withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1))
    )
    probes = dealt.join(copies, "shard").withColumn(
        "copy", F.pmod(F.xxhash64("doc", "h"), F.col("copies")).cast("int")
    )

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return left.select(["doc", "h", "f"]).slice(0, 0)
        h, f, doc = (left[c].to_numpy() for c in ("h", "f", "doc"))
        known, first, count = probe(right.to_pylist()[0], h.view(U64), f.view(U64))
        return left.select(["doc", "h", "f"]).filter(pa.array(known & (count > 1) & (first != doc)))

    drops = (
        probes.groupBy("shard", "copy")
        .cogroup(copied.drop("copies").groupBy("shard", "copy"))
        .applyInArrow(look_up, "doc bigint, h bigint, f bigint")
    )
    return drops.groupBy("doc").agg(F.collect_list(F.struct("h", "f")).alias("drops"))


def deduplicated(docs: DataFrame, id_col="doc_id", text_col="text", made="line_dedup") -> DataFrame:
    """``docs`` with a column ``made``: a struct of ``n_lines``, ``n_dropped`` and ``kept``, the text left."""
    arrays.bounded_batches(docs.sparkSession)
    drops = materialise(dropped_keys(docs, id_col, text_col), "line-drops")
    drops = drops.select(F.col("doc").alias(f"{made}_doc"), F.col("drops").alias(f"{made}_drops"))
    joined = docs.join(drops, _document(id_col) == F.col(f"{made}_doc"), "left")

    @F.arrow_udf("struct<n_lines: bigint, n_dropped: bigint, kept: string>")
    def cut(texts: pa.Array, drops: pa.Array) -> pa.Array:
        n_lines, n_dropped, kept = [], [], []
        for some in arrays.slices(texts):
            starts, ends, first, h, f, has_key = lines_of(some)
            view = memoryview(np.ascontiguousarray(some.data))
            for i in range(some.last - some.first):
                a, b = int(first[i]), int(first[i + 1])
                gone = drops[some.first + i]
                n_lines.append(b - a)
                if not gone.is_valid or not len(gone.values):
                    n_dropped.append(0)
                    kept.append(str(view[some.bounds[i] : some.bounds[i + 1]], "utf-8"))
                    continue
                gone = gone.values.flatten()
                gone = {*zip(gone[0].to_numpy().tolist(), gone[1].to_numpy().tolist())}
                keys = zip(arrays.signed(h[a:b]).tolist(), arrays.signed(f[a:b]).tolist())
                stays = [not k or pair not in gone for k, pair in zip(has_key[a:b].tolist(), keys)]
                n_dropped.append(stays.count(False))
                kept.append(
                    "\n".join(
                        str(view[s:e], "utf-8")
                        for s, e, stay in zip(starts[a:b].tolist(), ends[a:b].tolist(), stays)
                        if stay
                    )
                )
        return pa.StructArray.from_arrays(
            [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(kept, pa.string())],
            ["n_lines", "n_dropped", "kept"],
        )

    return joined.withColumn(made, cut(F.col(text_col), F.col(f"{made}_drops"))).drop(
        f"{made}_doc", f"{made}_drops"
    )

"""Packing of tokenised documents into sequences of a fixed capacity.

Documents longer than the capacity are cut into full pieces, with the shorter rest first. What is
left is a bin packing of lengths 1 to capacity, so its plan depends on how many pieces there are of
each length and on nothing else: a table with a row per length, whatever the corpus. Pieces above
a third of the capacity pair at most twice per sequence, the longest with the longest that fits;
smaller ones, long to short, go where they leave the smallest gap. The plan is a list of stretches:
the r-th piece of a length goes to this sequence at this offset. Spark numbers the pieces of each
length (by the part they were made in, then by place in it) and looks them up.

Null texts are empty and an empty text is the end token alone. Repeated rows are packed each, a null
id is carried like any other, other columns are left out, and an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm import arrays, tokens
from reviewmill.session import materialise

CAPACITY = 1024
END_ID = 2

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, nth bigint"
PACKED = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, "
    "sequence_id bigint, offset bigint"
)


class Stretch(NamedTuple):
    """Pieces of ``length`` numbered from ``rank``, one in each of ``n`` sequences from ``sequence``."""

    length: int
    rank: int
    n: int
    sequence: int
    offset: int


def plan(counts: dict[int, int], capacity: int) -> list[Stretch]:
    """Where the pieces go, given how many there are of each length."""
    left = [0] * (capacity + 1)
    for length, n in counts.items():
        left[length] = n
    rank = [0] * (capacity + 1)
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # (first sequence, how many)
    stretches: list[Stretch] = []
    sequences = 0

    def place(length: int, n: int, sequence: int, offset: int) -> None:
        stretches.append(Stretch(length, rank[length], n, sequence, offset))
        rank[length] += n
        left[length] -= n

    large = capacity // 3 + 1
    partner = capacity
    for length in range(capacity, large - 1, -1):
        while left[length]:
            partner = min(length, capacity - length)
            while partner >= large and left[partner] < 1 + (partner == length):
                partner -= 1
            if partner < large:
                n, used = left[length], length
                place(length, n, sequences, 0)
            else:
                n = left[length] // 2 if partner == length else min(left[length], left[partner])
                place(length, n, sequences, 0)
                place(partner, n, sequences, length)
                used = length + partner
            gaps[capacity - used].append((sequences, n))
            sequences += n

    def fill(length: int, sequence: int, n: int, gap: int) -> None:
        """Put as many pieces as fit into ``n`` sequences with this gap; what is left over stays."""
        most = gap // length
        whole, rest = min(n, left[length] // most), 0
        for k in range(most if whole else 0):
            place(length, whole, sequence, capacity - gap + k * length)
        if whole:
            gaps[gap - most * length].append((sequence, whole))
        if whole < n:
            rest = left[length]
            for k in range(rest):
                place(length, 1, sequence + whole, capacity - gap + k * length)
            if rest:
                gaps[gap - rest * length].append((sequence + whole, 1))
            if whole + bool(rest) < n:
                gaps[gap].append((sequence + whole + bool(rest), n - whole - bool(rest)))

    for length in range(large - 1, 0, -1):
        gap = length
        while left[length] and gap <= capacity:
            if gaps[gap]:
                fill(length, *gaps[gap].pop(), gap)
            else:
                gap += 1
        if left[length]:
            need = -(-left[length] // (capacity // length))
            first, sequences = sequences, sequences + need
            fill(length, first, need, capacity)
    return stretches


def pieces(
    docs: DataFrame, path: str, pattern: str, capacity=CAPACITY, end_id=END_ID,
    id_col="doc_id", text_col="text",
) -> DataFrame:
    """The pieces of all documents, numbered within their part and length by ``nth``."""

    def cut(batches, schema):
        coder = tokens.coder(path, pattern)
        part = TaskContext.get().partitionId()
        met = np.zeros(capacity + 1, np.int64)
        for rows in batches:
            for some in arrays.slices(rows.column(1)):
                ids, bounds = coder.encode(some.data, some.bounds)
                ends = bounds + np.arange(len(bounds))
                ids = np.insert(ids, bounds[1:], end_id).astype("<u4")
                totals = np.diff(ends)
                n_pieces = -(-totals // capacity)
                row = np.repeat(np.arange(len(totals)), n_pieces)
                piece = arrays.gathered(np.zeros(len(totals), np.int64), n_pieces)
                short = totals - (n_pieces - 1) * capacity
                start = np.where(piece == 0, 0, short[row] + (piece - 1) * capacity)
                length = np.where(piece == 0, short[row], capacity)
                at = ends[row] + start
                view = memoryview(ids).cast("B")
                sums = [
                    zlib.crc32(view[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())
                ]
                order = np.argsort(length, kind="stable")
                sorted_lengths = length[order]
                first = np.searchsorted(sorted_lengths, sorted_lengths)
                nth = np.empty(len(length), np.int64)
                nth[order] = met[sorted_lengths] + np.arange(len(order)) - first
                met += np.bincount(length, minlength=capacity + 1)
                yield arrays.batch(
                    schema,
                    {
                        "doc_id": rows.column(0).slice(some.first, some.last - some.first).take(pa.array(row)),
                        "piece": piece,
                        "start": start,
                        "length": length,
                        "ids_crc32": sums,
                        "part": np.full(len(row), part),
                        "nth": nth,
                    },
                )

    return arrays.over(
        docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")),
        cut, PIECES, ["doc_id", "text"],
    )


def packed(
    docs: DataFrame, path: str, pattern: str, capacity=CAPACITY, end_id=END_ID,
    id_col="doc_id", text_col="text",
) -> DataFrame:
    """Each piece with its sequence and its offset there."""
    made = materialise(pieces(docs, path, pattern, capacity, end_id, id_col, text_col), "pieces")
    spans = materialise(made.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "spans")
    # One row per length, so at most ``capacity`` rows.
    counts = {r["length"]: r["n"] for r in spans.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    stretches = sorted(plan(counts, capacity))
    table = np.array(stretches, dtype=np.int64).reshape(-1, 5).T
    earlier = (
        Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = spans.select(
        "part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift")
    )

    def placed(batches, schema):
        lengths, ranks, _, sequences, offsets = table
        keys = (lengths << 48) + ranks
        for rows in batches:
            length = rows.column("length").to_numpy()
            rank = rows.column("rank").to_numpy()
            at = np.searchsorted(keys, (length << 48) + rank, "right") - 1
            yield arrays.batch(
                schema,
                {name: rows.column(name) for name in schema.names if name in rows.schema.names}
                | {"sequence_id": sequences[at] + rank - ranks[at], "offset": offsets[at]},
            )

    numbered = made.join(shifts, ["part", "length"]).withColumn("rank", F.col("nth") + F.col("shift"))
    return arrays.over(
        numbered, placed, PACKED,
        ["doc_id", "piece", "start", "length", "ids_crc32", "rank"],
    )

"""Texts of an Arrow column as flat NumPy arrays: words, hashes of any stretch, and their rows.

Everything works on UTF-8 bytes of a bounded slice of rows at a time (a single longer text makes a
slice of its own), so a task's memory does not follow the size of its partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
U64 = np.uint64

# A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Bytes of words that white space (space, tab to carriage return) separates.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[32, *range(9, 14)]] = False

_BASE = 0x9E3779B97F4A7C15 | 3  # 3 modulo 4, so that its powers differ in all but two bits
_INVERSE = pow(_BASE, -1, 1 << 64)
# One family of letter values for each independent hash.
_LETTERS = np.random.default_rng(20240501).integers(0, 1 << 64, (2, 256), dtype=U64)


class Slice(NamedTuple):
    """Rows ``first`` to ``last`` (exclusive) of a column; row i's bytes lie at bounds[i:i+2]."""

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Runs of whole rows with at most ``limit`` bytes, or one longer row. Null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type):
        width = np.int64
    else:
        column, width = column.cast(pa.string()), np.int32
    if len(column) == 0:
        return
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1]
    bounds = bounds.astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield Slice(
            first, last, flat[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        )
        first = last


def spans(data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray):
    """Starts and ends of the maximal runs of word bytes inside rows, and each row's first run.

    The third array has one entry more than there are rows: row i's runs are [first[i], first[i+1]).
    """
    inside = is_word[data]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    after = np.empty_like(inside)
    after[:-1] = inside[1:]
    if len(data):
        edges = bounds[:-1][bounds[:-1] < len(data)]
        before[edges] = False
        edges = bounds[1:][bounds[1:] > 0]
        after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def _power(name: str, base: int, n: int) -> np.ndarray:
    # Not in a variable of this module, which would travel with every function.
    kept = process_cache()
    known = kept.get(name)
    if known is None or len(known) < n:
        known = np.full(max(n, SLICE_BYTES + 1), base, U64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        kept[name] = known
    return known[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit numbers over all others (the finaliser of a public-domain generator)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Rolling:
    """64-bit hashes of any stretches of a byte array: equal bytes, equal hash."""

    def __init__(self, data: np.ndarray, family: int = 0):
        n = len(data)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(_LETTERS[family][data] * _power("up", _BASE, n), out=self.sums[1:])
        self.down = _power("down", _INVERSE, n + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.down[starts]
        return mixed(raw ^ (ends - starts).astype(U64))

    def every(self, size: int) -> np.ndarray:
        """The hash of the ``size`` bytes from each place on, where so many follow."""
        if len(self.sums) <= size:
            return np.zeros(0, U64)
        return mixed((self.sums[size:] - self.sums[:-size]) * self.down[: len(self.sums) - size])


def chained(hashes: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of ``size`` neighbouring hashes; the order counts."""
    n = max(0, len(hashes) - size + 1)
    out = np.full(n, 0x2545F4914F6CDD1D, U64)
    for k in range(size):
        out = mixed(out * U64(0x9E3779B97F4A7C15) + hashes[k : k + n])
    return out


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's long."""
    return x.view(np.int64)


def batch(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            columns[f.name].cast(f.type)
            if isinstance(columns[f.name], pa.Array)
            else pa.array(columns[f.name], type=f.type)
            for f in schema
        ],
        schema=schema,
    )


def over(rows, function, ddl: str, columns: list[str]):
    """``mapInArrow`` over the named columns alone, with the output columns as DDL.

    ``function(batches, schema)`` gets the iterator of batches and the Arrow schema of its output.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    bounded_batches(rows.sparkSession)
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches):
        yield from function(batches, schema)
        give_back()

    return rows.select(*columns).mapInArrow(run, ddl)


class Numbering:
    """Numbers 64-bit hashes 0, 1, 2, ... as they are added: an open-addressing table in arrays.

    Holds up to half as many hashes as it has slots; the caller clears it when ``full``.
    """

    def __init__(self, bits: int = 20):
        self.bits = bits
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(1 << self.bits, U64)
        self.numbers = np.full(1 << self.bits, -1, np.int32)
        self.size = 0

    def full(self, more: int) -> bool:
        return self.size + more > 1 << (self.bits - 1)

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> U64(64 - self.bits)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 for those not added."""
        slots = self._slots(hashes)
        out = self.numbers[slots]
        left = np.flatnonzero((out >= 0) & (self.keys[slots] != hashes))
        while len(left):
            slots[left] = (slots[left] + 1) & ((1 << self.bits) - 1)
            out[left] = self.numbers[slots[left]]
            left = left[(out[left] >= 0) & (self.keys[slots[left]] != hashes[left])]
        return out

    def add(self, hashes: np.ndarray) -> None:
        """Number distinct hashes that are not in the table yet, in the given order."""
        numbers = np.arange(self.size, self.size + len(hashes), dtype=np.int32)
        self.size += len(hashes)
        slots, left = self._slots(hashes), np.arange(len(hashes))
        while len(left):
            at = slots[left]
            free = left[self.numbers[at] < 0]
            self.numbers[slots[free]] = numbers[free]  # of several the last one stays
            won = self.numbers[slots[free]] == numbers[free]
            self.keys[slots[free[won]]] = hashes[free[won]]
            left = left[self.numbers[slots[left]] != numbers[left]]
            slots[left] = (slots[left] + 1) & ((1 << self.bits) - 1)


def give_back() -> None:
    """Return memory that is free in this worker to the machine, as the worker outlives its task."""
    import ctypes

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def process_cache() -> dict:
    """A dictionary that lives as long as the worker process, across tasks."""
    import sys

    return sys.__dict__.setdefault("_reviewmill_worker_cache", {})


def gathered(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of all stretches, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


class sent:
    """Broadcast a value of bounded size; the result, called inside a task, gives the value."""

    def __init__(self, spark, value):
        from pyspark import cloudpickle

        # Pickled here, so that classes of these modules go along with it.
        self.packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    def __call__(self):
        import pickle

        return pickle.loads(self.packed.value)

    def destroy(self) -> None:
        """Free it everywhere, once no job needs it, not even to run a lost task again."""
        self.packed.destroy()


def fresh(columns: list[str], name: str) -> str:
    """A column name that is not taken."""
    taken = {c.lower() for c in columns}
    while any(c.startswith(name) for c in taken):
        name = f"_{name}"
    return name


def bounded_batches(spark) -> None:
    """Fewer rows per Arrow batch than Spark's default, as the rows are whole texts.

    A batch is held several times over, outside the heap and in the worker. A setting of the user's stays.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, "1000")

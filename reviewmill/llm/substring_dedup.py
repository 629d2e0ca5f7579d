"""Removal of every byte that lies in a string of ``LENGTH`` bytes which also starts earlier.

Prefix doubling over sampled positions. Ranking all byte positions in each round would sort many
times the corpus, so positions are sampled by content: of the ``GRAM``-byte strings inside a window of
``LENGTH`` bytes the one with the smallest hash is the window's anchor, so equal windows have equal
anchors at equal offsets. Neighbouring windows mostly share their anchor; the stretch of text that
the windows of one anchor cover is its segment. The rank of a stretch of bytes is its 64-bit hash.

1. Anchors are ranked by their ``GRAM`` bytes; those with a unique rank are done.
2. The others are ranked by the pair of that rank and the rank of the longer segment. All but the
   first segment of a rank are repeated as a whole.
3. First segments whose anchor rank still has several segment ranks are ranked window by window, by the
   pair of anchor rank and rank of the ``LENGTH`` bytes, which is past the threshold. All but the first
   window of a rank are repeated.

Anchor ranks with more than ``GROUP`` different segments are dealt into pieces; a piece removes what it
can, and its first windows go on, at first not one by one: of ``STEP`` windows at neighbouring offsets from the
anchor only the bytes they all share are ranked, and where that rank is unique, so are the windows. The
windows of the rest are then compared across pieces.

Texts are UTF-8 bytes, null texts are empty, matches lie inside one text. Strings are judged on the
input. A null id counts as the largest. Rows with one id and one text are one document (all are cut alike); rows
with one id and different texts are documents of their own, ordered by a hash of the text. Other columns are
kept, whatever their names.
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

LENGTH = 100
GRAM = 32
GROUP = 4096
STEP = 8
CHUNK = 1 << 19
LAST_ID = (1 << 63) - 1

_PLACE_BITS = U64(24)  # of a place in a chunk
_PLACE = (U64(1) << _PLACE_BITS) - U64(1)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each run of ``width`` values."""
    reach, out = 1, values
    while 2 * reach <= width:
        out = np.minimum(out[: len(out) - reach], out[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _chunks(some: arrays.Slice, length: int):
    """The slice, or parts of its only row if that is longer than a chunk: (part, place in the row)."""
    if len(some.data) <= CHUNK + length:
        yield some, 0
        return
    for at in range(0, len(some.data) - length + 1, CHUNK):
        part = some.data[at : at + CHUNK + length - 1]
        yield arrays.Slice(some.first, some.last, part, np.array([0, len(part)])), at


def anchors_of(some: arrays.Slice, length: int, gram: int):
    """Row, anchor rank, segment rank, first window, number of windows, and place of the anchor
    after the first window, for each anchor."""
    data, bounds = some.data, some.bounds
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none.view(U64), none.view(U64), none, none, none
    rolling = arrays.Rolling(data)
    grams = rolling.every(gram)
    # Hash in the high bits, place in the low ones: the smallest is the leftmost of equal hashes.
    keyed = (grams & ~_PLACE) | np.arange(len(grams), dtype=U64)
    best = _sliding_min(keyed, length - gram + 1) & _PLACE
    inside = np.zeros(len(data) + 1, np.int64)
    long = np.diff(bounds) >= length
    np.add.at(inside, bounds[:-1][long], 1)
    np.add.at(inside, bounds[1:][long] - length + 1, -1)
    windows = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    anchor = best[windows].astype(np.int64)
    new = np.ones(len(windows), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (windows[1:] != windows[:-1] + 1)
    # Windows of neighbouring rows may follow on each other, but have no anchor in common.
    at = np.flatnonzero(new)
    low, n = windows[at], np.diff(np.append(at, len(windows)))
    anchor = anchor[at]
    segment = arrays.mixed(rolling.of(low, low + n + length - 1) + (anchor - low).astype(U64))
    row = np.searchsorted(bounds, low, "right") - 1
    return row, grams[anchor], segment, low - bounds[row], n, anchor - low


def anchors(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def sample(batches, schema):
        for rows in batches:
            doc, tie = rows.column("doc").to_numpy(), rows.column("tie").to_numpy()
            for some in arrays.slices(rows.column("text"), CHUNK):
                for part, at in _chunks(some, length):
                    row, rank, segment, low, n, lead = anchors_of(part, length, gram)
                    yield arrays.batch(
                        schema,
                        {
                            "doc": doc[some.first + row],
                            "tie": tie[some.first + row],
                            "rank": arrays.signed(rank),
                            "segment": arrays.signed(segment),
                            "low": low + at,
                            "n": n,
                            "lead": lead,
                        },
                    )

    return arrays.over(
        docs, sample, "doc bigint, tie bigint, rank bigint, segment bigint, low int, n int, lead int",
        ["doc", "tie", "text"],
    )


def _texts_of(docs: DataFrame, firsts: DataFrame, length: int) -> DataFrame:
    """``firsts`` with the bytes of their segments."""
    asked = firsts.groupBy("doc", "tie").agg(F.collect_list(F.struct("rank", "low", "n", "lead", "kinds")).alias("asked"))

    def cut(batches, schema):
        for rows in batches:
            lists = rows.column("asked")
            flat = lists.flatten()
            rank, low, n, lead, kinds = (flat.field(k).to_numpy() for k in range(5))
            counts = pc.list_value_length(lists).to_numpy()
            bounds = np.concatenate([[0], np.cumsum(counts)])
            for some in arrays.slices(rows.column("text")):
                a, b = bounds[some.first], bounds[some.last]
                row = np.repeat(np.arange(some.last - some.first), counts[some.first : some.last])
                start, size = some.bounds[row] + low[a:b], n[a:b] + length - 1
                flat_bytes = some.data[arrays.gathered(start, size)]
                edges = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                yield arrays.batch(
                    schema,
                    {
                        "rank": rank[a:b],
                        "kinds": kinds[a:b],
                        "doc": rows.column("doc").to_numpy()[some.first + row],
                        "tie": rows.column("tie").to_numpy()[some.first + row],
                        "low": low[a:b],
                        "lead": lead[a:b],
                        "body": pa.Array.from_buffers(
                            pa.binary(), len(row), [None, pa.py_buffer(edges), pa.py_buffer(flat_bytes)]
                        ),
                    },
                )

    return arrays.over(
        docs.join(asked, ["doc", "tie"]), cut,
        "rank bigint, kinds bigint, doc bigint, tie bigint, low int, lead int, body binary",
        ["doc", "tie", "text", "asked"],
    )


def _flat(bodies: pa.Array):
    """The bytes of a binary column and where each row's start."""
    bodies = bodies.combine_chunks() if isinstance(bodies, pa.ChunkedArray) else bodies
    _, offsets, data = bodies.buffers()
    edges = np.frombuffer(offsets, np.int32)[bodies.offset : bodies.offset + len(bodies) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[edges[0] : edges[-1]], edges - edges[0]


def _binary(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Stretches of a byte array as a binary column."""
    edges = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int32)
    joined = data[arrays.gathered(start, end - start)]
    return pa.Array.from_buffers(
        pa.binary(), len(start), [None, pa.py_buffer(edges), pa.py_buffer(joined)]
    )


FOUND = "doc bigint, tie bigint, start int, end int, rank bigint, core bigint, body binary"


def _repeated_windows(segments: DataFrame, length: int, step: int) -> DataFrame:
    """``FOUND``: repeated stretches, and (with a core) what pieces pass on."""
    pieces = F.ceil(F.col("kinds") / GROUP)
    dealt = segments.withColumn("pieces", pieces.cast("int")).withColumn(
        "piece", F.pmod(F.xxhash64("doc", "tie", "low"), F.col("pieces")).cast("int")
    )
    key = ["rank", "piece"]
    columns = [*key, "pieces", "doc", "tie", "low", "lead", "body"]
    ordered = dealt.select(*columns).repartition(*key).sortWithinPartitions(*key)

    def resolve(rows: pa.Table, schema):
        rank, piece, pieces, doc, tie, low, lead = (
            rows[c].to_numpy() for c in ("rank", "piece", "pieces", "doc", "tie", "low", "lead")
        )
        data, edges = _flat(rows["body"])
        n = np.diff(edges) - length + 1
        start = arrays.gathered(edges[:-1], n)
        row = np.repeat(np.arange(len(n)), n)
        rolling = arrays.Rolling(data)
        name = rolling.of(start, start + length)
        place = low[row] + (start - edges[row])
        order = np.lexsort((place, tie[row], doc[row], name, piece[row], rank[row]))
        r, q, w, p = rank[row][order], piece[row][order], name[order], place[order]
        d, e = doc[row][order], tie[row][order]
        opens = np.ones(len(order), dtype=bool)
        opens[1:] = (r[1:] != r[:-1]) | (q[1:] != q[:-1]) | (w[1:] != w[:-1])
        first = np.flatnonzero(opens)[np.cumsum(opens) - 1]
        later = (d != d[first]) | (e != e[first]) | (p != p[first])
        # Neighbouring repeated windows of one segment make one stretch.
        gone = np.zeros(len(order), dtype=bool)
        gone[order] = later
        at = np.flatnonzero(gone)
        new = np.ones(len(at), dtype=bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (row[at[1:]] != row[at[:-1]])
        from_ = at[new]
        upto = at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)] if len(at) else at
        yield arrays.batch(
            schema,
            {
                "doc": doc[row[from_]],
                "tie": tie[row[from_]],
                "start": place[from_],
                "end": place[upto] + length,
                "rank": pa.nulls(len(from_), pa.int64()),
                "core": pa.nulls(len(from_), pa.int64()),
                "body": pa.nulls(len(from_), pa.binary()),
            },
        )
        passed = np.zeros(len(order), dtype=bool)
        passed[order] = opens & (pieces[row[order]] > 1)
        block = (lead[row] - (start - edges[row])) // step
        at = np.flatnonzero(passed)
        if not len(at):
            return
        new = np.ones(len(at), dtype=bool)
        new[1:] = (row[at[1:]] != row[at[:-1]]) | (block[at[1:]] != block[at[:-1]])
        from_, upto = at[new], at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)]
        # The bytes in all windows of the block, wherever the segment's own windows begin or end.
        core = edges[row[from_]] + lead[row[from_]] - block[from_] * step
        hashed = rolling.of(core, core + length - step + 1)
        yield arrays.batch(
            schema,
            {
                "doc": doc[row[from_]],
                "tie": tie[row[from_]],
                "start": place[from_],
                "end": place[upto] + length,
                "rank": rank[row[from_]],
                "core": arrays.signed(arrays.mixed(hashed + block[from_].astype(U64))),
                "body": _binary(data, start[from_], start[upto] + length),
            },
        )

    def run(batches, schema):
        waiting: list[pa.RecordBatch] = []
        size = 0
        for rows in batches:
            if not len(rows):
                continue
            keys = np.stack([rows.column(c).to_numpy() for c in key])
            change = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            if waiting and any(
                waiting[-1].column(c)[len(waiting[-1]) - 1].as_py() != rows.column(c)[0].as_py() for c in key
            ):
                change = np.append(0, change)
            if len(change) and (change[-1] > 0 or waiting):
                # Whole groups only: what follows the last change waits.
                waiting.append(rows.slice(0, int(change[-1])))
                yield from resolve(pa.Table.from_batches(waiting), schema)
                waiting, size = [], 0
                rows = rows.slice(int(change[-1]))
            waiting.append(rows)
            size += len(rows)
        if waiting:
            yield from resolve(pa.Table.from_batches(waiting), schema)

    return arrays.over(ordered, run, FOUND, columns)


def _windows(blocks: DataFrame, length: int) -> DataFrame:
    """``(rank, name, doc, tie, start)``: every window of the blocks."""

    def cut(batches, schema):
        for rows in batches:
            if not len(rows):
                continue
            data, edges = _flat(rows.column("body"))
            n = np.diff(edges) - length + 1
            start = arrays.gathered(edges[:-1], n)
            row = np.repeat(np.arange(len(n)), n)
            yield arrays.batch(
                schema,
                {
                    "rank": rows.column("rank").to_numpy()[row],
                    "name": arrays.signed(arrays.Rolling(data).of(start, start + length)),
                    "doc": rows.column("doc").to_numpy()[row],
                    "tie": rows.column("tie").to_numpy()[row],
                    "start": rows.column("start").to_numpy()[row] + (start - edges[row]),
                },
            )

    return arrays.over(
        blocks, cut, "rank bigint, name bigint, doc bigint, tie bigint, start int",
        ["rank", "doc", "tie", "start", "body"],
    )


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``(doc, tie, spans)`` of ``(doc, tie, text)``: repeated stretches of bytes, which may overlap."""
    count = F.count(F.lit(1))
    sampled = materialise(anchors(docs, length, gram), "anchors")
    shared = materialise(sampled.groupBy("rank").agg(count.alias("met")).where("met > 1"), "shared-ranks")
    alive = materialise(join_counted(sampled, shared, ["rank"], "met").drop("met"), "shared-anchors")
    forget(sampled, shared)
    kind, place = ["rank", "segment", "n", "lead"], F.struct("doc", "tie", "low")
    firsts = materialise(
        alive.groupBy(*kind).agg(F.min(place).alias("first"), count.alias("met")), "first-segments"
    )
    whole = (
        join_counted(alive, firsts.where("met > 1"), kind, "met")
        .where(place != F.col("first"))
        .select("doc", "tie", F.col("low").alias("start"), (F.col("low") + F.col("n") + length - 1).alias("end"))
    )
    several = materialise(firsts.groupBy("rank").agg(count.alias("kinds")).where("kinds > 1"), "several")
    open_segments = join_counted(firsts.drop("met"), several, ["rank"], "kinds").select(
        "rank", "first.doc", "first.tie", "first.low", "n", "lead", "kinds"
    )
    segments = materialise(_texts_of(docs, open_segments, length), "segments")
    found = materialise(_repeated_windows(segments, length, STEP), "windows")
    forget(segments)
    passed = found.where("core IS NOT NULL").select("rank", "core", "doc", "tie", "start", "body")
    met_again = materialise(
        passed.groupBy("rank", "core").agg(count.alias("met")).where("met > 1"), "shared-cores"
    )
    again = join_counted(passed, met_again, ["rank", "core"], "met")
    names = materialise(_windows(again, length), "window-names")
    begin = F.struct("doc", "tie", "start")
    leaders = materialise(
        names.groupBy("rank", "name").agg(F.min(begin).alias("first"), count.alias("met")).where("met > 1"),
        "window-leaders",
    )
    across = (
        join_counted(names, leaders, ["rank", "name"], "met")
        .where(begin != F.col("first"))
        .select("doc", "tie", "start", (F.col("start") + length).alias("end"))
    )
    found_spans = found.where("core IS NULL").select("doc", "tie", "start", "end")
    spans = whole.unionByName(found_spans).unionByName(across)
    out = materialise(
        spans.groupBy("doc", "tie").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "spans"
    )
    forget(alive, firsts, found, names)
    return out


def deduplicated(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col="doc_id", text_col="text",
    made="substring_dedup",
) -> DataFrame:
    """``docs`` with a column ``made``: ``n_bytes``, ``n_removed``, ``n_spans``, and ``kept``, the bytes left."""
    arrays.bounded_batches(docs.sparkSession)
    document = F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST_ID))
    tie = F.xxhash64(F.col(id_col).isNull(), F.col(text_col))
    keyed = docs.select(document.alias("doc"), tie.alias("tie"), F.col(text_col).alias("text"))
    # Repeated rows are one document.
    again = keyed.groupBy("doc", "tie").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1)
    spans = repeated_spans(keyed if again.isEmpty() else keyed.dropDuplicates(["doc", "tie"]), length, gram)
    names = {c: arrays.fresh([*docs.columns, made], f"sd_{c}") for c in ("doc", "tie", "spans")}
    spans = spans.select(*(F.col(c).alias(name) for c, name in names.items()))

    @F.arrow_udf("struct<n_bytes: bigint, n_removed: bigint, n_spans: bigint, kept: binary>")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        n_bytes, n_removed, n_spans, kept = [], [], [], []
        for some in arrays.slices(texts):
            view = memoryview(np.ascontiguousarray(some.data))
            for i in range(some.last - some.first):
                a, b = int(some.bounds[i]), int(some.bounds[i + 1])
                mine = spans[some.first + i]
                parts, upto, removed, runs = [], 0, 0, 0
                if mine.is_valid and len(mine.values):
                    start, end = (x.to_numpy() for x in mine.values.flatten())
                    order = np.argsort(start, kind="stable")
                    start, end = start[order], np.maximum.accumulate(end[order])
                    opens = np.ones(len(start), dtype=bool)
                    opens[1:] = start[1:] > end[:-1]
                    first = start[opens]
                    last = end[np.append(np.flatnonzero(opens)[1:] - 1, len(end) - 1)]
                    runs, removed = len(first), int((last - first).sum())
                    for s, e in zip(first.tolist(), last.tolist()):
                        parts.append(view[a + upto : a + s])
                        upto = e
                parts.append(view[a + upto : b])
                n_bytes.append(b - a)
                n_removed.append(removed)
                n_spans.append(runs)
                kept.append(b"".join(parts))
        return pa.StructArray.from_arrays(
            [*(pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)), pa.array(kept, pa.binary())],
            ["n_bytes", "n_removed", "n_spans", "kept"],
        )

    same = (document == F.col(names["doc"])) & (tie == F.col(names["tie"]))
    joined = docs.join(spans, same, "left")
    return joined.withColumn(made, cut(F.col(text_col), F.col(names["spans"]))).drop(*names.values())

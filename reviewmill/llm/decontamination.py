"""Benchmark decontamination by a prefix-filtered join of item windows with documents.

A window is ``WINDOW`` consecutive words of a benchmark item, or a shorter item whole. As containment
must be complete, a window's necessary prefix is one token: the rarest of its word pairs (of its words
if it has one) by their counts in the whole corpus. Documents look up their pairs among those
tokens; a hit at some place gives the one place where the window can start, which must lie in the
document with the window's whole length; there the words are compared, first as hashes and then as text.

Windows are broadcast in blocks of at most about ``BLOCK_BYTES``, so a benchmark of any size is
covered, each block by a pass over the documents. The hits of a block are written and its broadcast is
destroyed before the next one; texts are never shuffled to be searched. The items of a window stay in a table
and are joined to the sets of windows that were hit.

Words are runs of ASCII letters, digits and bytes beyond ASCII, A-Z in lower case. Null and empty
texts have no words; an item without words has no window; a null item id is an item of its own, written as
an empty string; each row gets a row, whatever its id (rows are told apart by id and a 64-bit hash of the text,
rows equal in both have equal hits); other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import arrays
from reviewmill.llm.arrays import U64
from reviewmill.llm.joins import join_counted, join_salted
from reviewmill.session import materialise

WINDOW = 10
BLOCK_BYTES = 32 << 20

_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_SINGLE = U64(0xA24BAED4963EE407)


def words_of(some: arrays.Slice):
    """Lower-cased bytes, word starts and ends, each row's first word, and the words' hashes."""
    data = arrays.LOWER[some.data]
    starts, ends, first = arrays.spans(data, some.bounds, _ALNUM)
    return data, starts, ends, first, arrays.Rolling(data).of(starts, ends)


def windows(benchmark: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """``(text, item)``: each item's distinct windows as words with single spaces."""

    def cut(batches, schema):
        for rows in batches:
            ids = rows.column(0)
            for some in arrays.slices(rows.column(1)):
                data, starts, ends, first, _ = words_of(some)
                items, texts = [], []
                for i in range(some.last - some.first):
                    a, b = int(first[i]), int(first[i + 1])
                    words = [data[s:e].tobytes() for s, e in zip(starts[a:b], ends[a:b])]
                    for k in range(max(1, len(words) - size + 1) if words else 0):
                        items.append(some.first + i)
                        texts.append(b" ".join(words[k : k + size]).decode())
                yield arrays.batch(
                    schema, {"item": ids.take(pa.array(items, pa.int64())), "text": texts}
                )

    items = benchmark.select(
        F.col(id_col).cast("string").alias("item"),
        F.col(text_col).alias("body"),
    )
    return arrays.over(items, cut, "item string, text string", ["item", "body"]).distinct()


class Block:
    """A bounded number of windows, ready to be found in documents."""

    def __init__(self, rows: list, size: int):
        self.texts = [r["text"].encode() for r in rows]
        self.ids = np.array([r["window"] for r in rows], np.int64)
        column = pa.array([r["text"] for r in rows], pa.string())
        self.length = np.zeros(len(rows), np.int64)
        self.words = np.zeros((len(rows), size), U64)
        for some in arrays.slices(column, 1 << 62):
            _, _, _, first, hashes = words_of(some)
            self.length = np.diff(first)
            row = np.repeat(np.arange(len(rows)), self.length)
            self.words[row, np.arange(len(hashes)) - first[row]] = hashes
        # All pairs of each window; for windows of one word, the word.
        pairs = np.zeros((len(rows), size), U64)
        if size > 1 and len(rows):
            pairs.ravel()[:-1] = arrays.chained(self.words.ravel(), 2)
        pairs = pairs[:, : max(1, size - 1)]
        one = self.length == 1
        pairs = np.where(one[:, None], arrays.mixed(self.words[:, :1] ^ _SINGLE), pairs)
        self.pairs = pairs
        self.valid = np.arange(pairs.shape[1]) < np.maximum(1, self.length - 1)[:, None]
        self.tokens = np.unique(pairs[self.valid])
        self.has_single, self.has_pairs = bool(one.any()), bool((~one).any())

    def choose(self, counts: np.ndarray) -> None:
        """Fix each window's prefix token, given the corpus count of each of ``tokens``."""
        seen = counts[np.searchsorted(self.tokens, self.pairs).clip(0, len(self.tokens) - 1)]
        seen = np.where(self.valid, seen, np.iinfo(np.int64).max)
        self.at = np.argmin(seen, axis=1)
        prefix = self.pairs[np.arange(len(self.pairs)), self.at]
        self.order = np.argsort(prefix, kind="stable")
        self.prefix, self.first = np.unique(prefix[self.order], return_index=True)
        self.first = np.append(self.first, len(prefix))

    def _keys(self, hashes: np.ndarray):
        """The kinds of token that documents have to look up."""
        if self.has_pairs and len(hashes) > 1:
            yield arrays.chained(hashes, 2)
        if self.has_single:
            yield arrays.mixed(hashes ^ _SINGLE)

    def count_in(self, some: arrays.Slice, counts: np.ndarray) -> None:
        """Add the slice's occurrences of ``tokens``; pairs across rows only shift the order."""
        hashes = words_of(some)[4]
        known = self._known(self.tokens)
        for keys in self._keys(hashes):
            found = known.find(keys)
            counts += np.bincount(found[found >= 0], minlength=len(counts))

    def _known(self, keys: np.ndarray) -> arrays.Numbering:
        """A table of sorted distinct keys, whose numbers are their places."""
        if getattr(self, "_table_of", None) is not keys:
            self._table = arrays.Numbering(max(4, int(len(keys) * 2 + 1).bit_length() + 1))
            self._table.add(keys)
            self._table_of = keys
        return self._table

    def find(self, some: arrays.Slice):
        """Each row's number of words, and the hits: row, window, first word in the row."""
        data, starts, ends, first, hashes = words_of(some)
        known = self._known(self.prefix)
        rows, found_windows, places = [], [], []
        for keys in self._keys(hashes):
            found = known.find(keys)
            at = np.flatnonzero(found >= 0)
            token = found[at]
            n = self.first[token + 1] - self.first[token]
            window = self.order[arrays.gathered(self.first[token], n)]
            place = np.repeat(at, n) - self.at[window]
            row = np.searchsorted(first, np.repeat(at, n), "right") - 1
            # Positional and length bounds.
            fits = (place >= first[row]) & (place + self.length[window] <= first[row + 1])
            window, place, row = window[fits], place[fits], row[fits]
            span = np.arange(self.words.shape[1])
            inside = span < self.length[window][:, None]
            at_words = np.minimum(place[:, None] + span, len(hashes) - 1)
            same = ((hashes[at_words] == self.words[window]) | ~inside).all(axis=1)
            window, place, row = window[same], place[same], row[same]
            exact = np.fromiter(
                (
                    b" ".join(
                        [data[s:e].tobytes() for s, e in zip(starts[p : p + n], ends[p : p + n])]
                    )
                    == self.texts[w]
                    for w, p, n in zip(window.tolist(), place.tolist(), self.length[window].tolist())
                ),
                bool,
                len(window),
            )
            rows.append(row[exact])
            found_windows.append(window[exact])
            places.append(place[exact] - first[row[exact]])
        if not rows:
            rows = found_windows = places = [np.zeros(0, np.int64)]
        rows, found_windows, places = map(np.concatenate, (rows, found_windows, places))
        return np.diff(first), rows, found_windows, places


def matched(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, id_col="doc_id", text_col="text",
    item_col="item_id", item_text_col="text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``(doc_id, n_words, starts, ends, items)``: the hit word ranges of each row and their items."""
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text_col).alias("tie"), F.col(text_col).alias("text")
    )
    held = materialise(windows(benchmark, size, item_col, item_text_col), "item-windows")
    known = numbered(held)
    parts = []
    for get, _ in blocks(texts, known, block_bytes):
        found = arrays.over(
            texts, _finder(get, every=not parts),
            "doc_id bigint, tie bigint, n_words bigint, starts array<int>, ends array<int>, windows array<bigint>",
            ["doc_id", "tie", "text"],
        )
        parts.append(materialise(found, "hits"))
        get.destroy()
    # The first pass wrote every row, the others those with hits. Repeated rows have the same hits.
    some = [part.drop("n_words").where(F.size("windows") > 0).distinct() for part in parts]
    met = materialise(
        reduce(DataFrame.unionByName, some).groupBy("doc_id", "tie").agg(
            *(F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends")),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("windows")))).alias("windows"),
        ),
        "hit-rows",
    )
    named = materialise(
        join_counted(met, items_of(met, held, known), ["windows"], "rows")
        .select(F.col("doc_id").alias("hit_id"), F.col("tie").alias("hit_tie"), "starts", "ends", "items"),
        "hit-items",
    )
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("tie") == F.col("hit_tie"))
    none = F.array()
    return parts[0].select("doc_id", "tie", "n_words").join(named, same, "left").select(
        "doc_id",
        "n_words",
        *(F.coalesce(c, none.cast("array<int>")).alias(c) for c in ("starts", "ends")),
        F.coalesce("items", none.cast("array<string>")).alias("items"),
    )


def numbered(held: DataFrame) -> DataFrame:
    """``(text, met, window)``: the distinct windows with the number of their items, and a number each."""
    distinct = held.groupBy("text").agg(F.count(F.lit(1)).alias("met"))
    return materialise(distinct.withColumn("window", F.monotonically_increasing_id()), "windows")


def items_of(met: DataFrame, held: DataFrame, known: DataFrame) -> DataFrame:
    """``(windows, rows, items)``: the distinct items of each set of windows that some row has."""
    sets = materialise(met.groupBy("windows").agg(F.count(F.lit(1)).alias("rows")), "window-sets")
    one = materialise(sets.select("windows", F.explode("windows").alias("window")), "set-windows")
    # Items of windows that nobody has stay behind.
    items = join_counted(held, known, ["text"], "met").select("window", "item")
    named = join_salted(one, items.join(one.select("window").distinct(), "window", "left_semi"), "window", "windows")
    # As structs, since a null item counts.
    lists = named.groupBy("windows").agg(F.collect_set(F.struct("item")).alias("items"))
    texts = F.transform("items", lambda i: F.coalesce(i["item"], F.lit("")))
    return materialise(
        sets.join(lists, "windows").select("windows", "rows", F.array_sort(texts).alias("items")), "set-items"
    )


def blocks(texts: DataFrame, known: DataFrame, block_bytes: int):
    """The windows in broadcast blocks with their prefixes chosen, and the number of blocks; destroy each after use."""
    weight = F.octet_length("text") + 200
    total = known.agg(F.sum(weight.cast("bigint"))).first()[0] or 0
    n_blocks = max(1, -(-total // block_bytes))
    for number in range(n_blocks):
        # Bounded: a share of the windows whose expected size is the block size.
        some = known.where(F.pmod(F.xxhash64("text"), F.lit(n_blocks)) == number).select("text", "window").collect()
        block = Block(some, size=max([1, *(r["text"].count(" ") + 1 for r in some)]))
        block.choose(_counts(texts.select("text"), block))
        yield arrays.sent(texts.sparkSession, block), n_blocks


def clean(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, text_col="text", item_col="item_id",
    item_text_col="text", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no window of the benchmark.

    One block filters the rows where they are. Of several, each writes the hashes of the texts that it meets, and
    the rows with such texts are left out in one join.
    """
    arrays.bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(text_col).alias("text"))
    known = numbered(materialise(windows(benchmark, size, item_col, item_text_col), "item-windows"))
    keys = [arrays.fresh(docs.columns, f"text_key{i}") for i in (1, 2)]
    hashes = [F.xxhash64(F.lit(i), F.col(text_col)).alias(key) for i, key in enumerate(keys)]
    hit = []
    for get, n_blocks in blocks(texts, known, block_bytes):
        holds_none = _is_clean(get)(F.col(text_col))
        if n_blocks == 1:
            return docs.where(holds_none)
        counted = docs.where(~holds_none).select(*hashes).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
        hit.append(materialise(counted, "hit-texts"))
        get.destroy()
    rows = arrays.fresh(docs.columns, "rows_hit")
    bad = materialise(
        reduce(DataFrame.unionByName, hit).groupBy(*keys).agg(F.max("rows").alias(rows)), "hit-texts"
    )
    return (
        join_counted(docs.select("*", *hashes), bad, keys, rows, "left").where(F.col(rows).isNull()).select(*docs.columns)
    )


def _is_clean(get):
    @F.arrow_udf("boolean")
    def is_clean(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        block = get()
        for texts in batches:
            kept = []
            for some in arrays.slices(texts):
                _, row, _, _ = block.find(some)
                mine = np.ones(some.last - some.first, dtype=bool)
                mine[row] = False
                kept.append(mine)
            yield pa.array(np.concatenate(kept) if kept else [], pa.bool_())

    return is_clean


def _counts(texts: DataFrame, block: Block) -> np.ndarray:
    """How often the corpus holds each token of the block."""
    counts = np.zeros(len(block.tokens), np.int64)
    if not len(block.tokens):
        return counts
    shared = arrays.sent(texts.sparkSession, block)

    def count(batches, schema):
        mine_of = shared()
        mine = np.zeros(len(mine_of.tokens), np.int64)
        for rows in batches:
            for some in arrays.slices(rows.column(0)):
                mine_of.count_in(some, mine)
        seen = np.flatnonzero(mine)
        yield arrays.batch(schema, {"token": seen, "n": mine[seen]})

    found = arrays.over(texts, count, "token bigint, n bigint", ["text"])
    for r in found.groupBy("token").agg(F.sum("n").alias("n")).collect():
        counts[r["token"]] = r["n"]
    shared.destroy()
    return counts


def _finder(shared, every: bool):
    """Rows with their hits in a block: every row, or only those with hits."""

    def find(batches, schema):
        block = shared()
        for rows in batches:
            out = {"row": [], "n_words": [], "starts": [], "ends": [], "windows": []}
            for some in arrays.slices(rows.column("text")):
                counts, row, window, place = block.find(some)
                order = np.argsort(row, kind="stable")
                row, window, place = row[order], window[order], place[order]
                mine = np.arange(len(counts)) if every else np.unique(row)
                edges = np.searchsorted(row, np.append(mine, len(counts)))
                out["row"].append(some.first + mine)
                out["n_words"].append(counts[mine])
                offsets = pa.array(np.append(edges[:-1], len(row)), pa.int32())
                for name, values, kind in (
                    ("starts", place, pa.int32()),
                    ("ends", place + block.length[window], pa.int32()),
                    ("windows", block.ids[window], pa.int64()),
                ):
                    out[name].append(pa.ListArray.from_arrays(offsets, pa.array(values, kind)))
            if not out["row"]:
                continue
            at = pa.array(np.concatenate(out["row"]), pa.int64())
            yield arrays.batch(
                schema,
                {
                    "doc_id": rows.column("doc_id").take(at),
                    "tie": rows.column("tie").take(at),
                    "n_words": np.concatenate(out["n_words"]),
                    **{name: pa.concat_arrays(out[name]) for name in ("starts", "ends", "windows")},
                },
            )

    return find


def verdicts(matches: DataFrame) -> DataFrame:
    """Per row of ``matched``: words, hit words, items, and whether it is contaminated."""
    ranges = F.array_sort(F.array_distinct(F.arrays_zip("starts", "ends")))
    covered = F.aggregate(
        ranges,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto")),
        lambda done, r: F.struct(
            (done["n"] + F.greatest(F.lit(0), r["ends"] - F.greatest(done["upto"], r["starts"]))).alias("n"),
            F.greatest(done["upto"], r["ends"]).alias("upto"),
        ),
        lambda done: done["n"].cast("bigint"),
    )
    return matches.select(
        "doc_id",
        "n_words",
        covered.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
    ).withColumn("contaminated", F.col("n_hit") > 0)

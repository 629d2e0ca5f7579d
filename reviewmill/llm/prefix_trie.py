"""The trie of conversation prefixes: what conversations share from their first turn on.

Each conversation is a sequence of turns (role, text); its prefix of d turns is named by a 128-bit digest
chained over the turns. Count-min screening: all digests are counted in a sketch of a few rows of counters of
bounded width that saturate at two. A counter never holds less than the true count, so an
estimate of one proves that a prefix has one member. Counts fall with depth; from its first proven singleton on, a
conversation's prefixes are a chain of its own and are emitted where the conversation lies. Only the prefixes
above are shuffled, counted exactly by digest, and linked to their parents. Where the sketch is too full it
proves less and more is shuffled; the result is the same.

Sums over subtrees need no walk by levels: a node belongs to its smallest member, whose prefixes are its
ancestors. So a conversation adds up what its own nodes hold from the deepest to the root, and one
aggregation by digest gives every subtree's total.

Turns are ordered by number (null first), then role, then text; null roles and texts are empty; repeated rows are
turns of their own. The turns of a null conversation are one conversation, whose id is written ``null`` and
counts as the largest. An empty table has no node, not even a root. Other columns go.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewmill.llm import arrays
from reviewmill.session import forget, materialise

ROWS = 3
LEAST_BITS, MOST_BITS = 16, 24  # of a sketch row's width; three rows of 2^24 one-byte counters are 48 MB
BLOCK_BITS = 14
RUN_IDS = 1 << 14
DIGEST = 16


def conversations(turns: DataFrame) -> DataFrame:
    """``(conv_id, turns)``: the ordered turns of each conversation as an array of (role, text)."""
    told = F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(told)).alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["role"], t["text"])).alias("turns")
    )


def with_shared_heads(convs: DataFrame, base: Column, length: Column, most: int) -> DataFrame:
    """Conversations whose first ``length`` turns (``most`` at most) are those of conversation ``base``.

    Of a base that is shorter all turns are taken, of one that does not exist none.
    """
    heads = convs.select(F.col("conv_id").alias("_base"), F.slice("turns", 1, most).alias("_head"))
    asked = convs.withColumn("_base", base).withColumn("_length", length)
    bases = asked.select("_base").distinct()
    # Only the first turns of conversations that are a base travel.
    heads = materialise(heads.join(bases, "_base", "left_semi"), "heads")
    joined = asked.join(heads, "_base", "left")
    head = F.slice(F.coalesce("_head", F.array().cast(convs.schema["turns"].dataType)), F.lit(1), F.col("_length"))
    rest = F.slice("turns", F.col("_length") + 1, F.greatest(F.size("turns") - F.col("_length"), F.lit(0)))
    return joined.select("conv_id", F.concat(head, rest).alias("turns"))


def _prefixes(convs: DataFrame) -> DataFrame:
    """``(conv_id, digests, sizes)``: of each prefix, from the empty one on, its digest and the code points of
    its last text."""

    def chain(batches, schema):
        for rows in batches:
            lists = rows.column("turns")
            flat = lists.flatten()
            roles, texts = flat.field(0).to_pylist(), flat.field(1).to_pylist()
            counts = np.asarray(lists.value_lengths())
            digests, sizes, at = [], [], 0
            for n in counts:
                digest, mine, long = bytes(DIGEST), [bytes(DIGEST)], [0]
                for role, text in zip(roles[at : at + n], texts[at : at + n]):
                    role, said = role.encode(), text.encode()
                    size = len(role).to_bytes(8, "little")
                    digest = hashlib.blake2b(digest + size + role + said, digest_size=DIGEST).digest()
                    mine.append(digest)
                    long.append(len(text))
                digests.append(mine)
                sizes.append(long)
                at += n
            yield arrays.batch(
                schema,
                {"conv_id": rows.column("conv_id"), "digests": digests, "sizes": sizes},
            )

    return arrays.over(
        convs, chain, "conv_id bigint, digests array<binary>, sizes array<bigint>", ["conv_id", "turns"]
    )


def _slots(digests: list[bytes], bits: int) -> np.ndarray:
    """For each digest its counter in each row of the sketch."""
    halves = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
    rows = [
        arrays.mixed(halves[:, 0] + np.uint64(k) * halves[:, 1]) >> np.uint64(64 - bits) for k in range(ROWS)
    ]
    return np.stack(rows).astype(np.int64) if digests else np.zeros((ROWS, 0), np.int64)


def sketch(prefixes: DataFrame, bits: int) -> np.ndarray:
    """The count-min sketch of all prefixes, ``ROWS`` x 2^bits counters of one byte that stop at two.

    Each task counts for itself; the blocks it has touched are added up by Spark.
    """
    block = min(bits, BLOCK_BITS)

    def count(batches, schema):
        mine = np.zeros(ROWS << bits, np.uint8)
        for rows in batches:
            slots = _slots(rows.column("digests").flatten().to_pylist(), bits)
            for k in range(ROWS):
                touched, n = np.unique((k << bits) + slots[k], return_counts=True)
                mine[touched] = np.minimum(mine[touched] + np.minimum(n, 2), 2)
        blocks = mine.reshape(-1, 1 << block)
        at = np.flatnonzero(blocks.any(axis=1))
        if len(at):
            yield arrays.batch(schema, {"block": at, "counts": [blocks[i].tobytes() for i in at]})

    def add(batches, schema):
        current, total = None, None
        for rows in batches:
            for at, counts in zip(rows.column("block").to_pylist(), rows.column("counts").to_pylist()):
                if at != current:
                    if current is not None:
                        yield arrays.batch(schema, {"block": [current], "counts": [total.tobytes()]})
                    current, total = at, np.zeros(1 << block, np.uint8)
                total = np.minimum(total + np.frombuffer(counts, np.uint8), 2)
        if current is not None:
            yield arrays.batch(schema, {"block": [current], "counts": [total.tobytes()]})

    kind = "block int, counts binary"
    partial = arrays.over(prefixes, count, kind, ["digests"])
    blocks = arrays.over(
        partial.repartition("block").sortWithinPartitions("block"), add, kind, ["block", "counts"]
    )
    out = np.zeros((ROWS << bits >> block, 1 << block), np.uint8)
    for row in blocks.collect():  # as many bytes as the sketch has
        out[row["block"]] = np.frombuffer(row["counts"], np.uint8)
    return out.reshape(ROWS, 1 << bits)


def _screened(prefixes: DataFrame, counters: np.ndarray, bits: int) -> DataFrame:
    """``prefixes`` with ``shared``: how many prefixes, from the empty one on, may have more than one member.

    The empty prefix always counts as shared.
    """
    get = arrays.sent(prefixes.sparkSession, counters)

    def screen(batches, schema):
        counted = get()
        for rows in batches:
            lists = rows.column("digests")
            slots = _slots(lists.flatten().to_pylist(), bits)
            single = np.min([counted[k][slots[k]] for k in range(ROWS)], axis=0) == 1
            n = np.asarray(lists.value_lengths())
            starts = np.cumsum(n) - n
            single[starts] = False
            place = np.arange(len(single)) - np.repeat(starts, n)
            none = np.repeat(n, n)
            shared = np.minimum.reduceat(np.where(single, place, none), starts) if len(n) else n
            yield arrays.batch(
                schema,
                {**{c: rows.column(c) for c in ("conv_id", "digests", "sizes")}, "shared": shared},
            )

    return arrays.over(
        prefixes, screen, "conv_id bigint, digests array<binary>, sizes array<bigint>, shared int",
        ["conv_id", "digests", "sizes"],
    )


def _end_lists(ends: DataFrame) -> DataFrame:
    """``(digest, ends_sha256)``: the SHA-256 of the ids that end at a prefix, in order, joined by commas.

    Sorted ids are joined to runs of text first, so the task that hashes a prefix's list reads few rows.
    """

    def run(schema, digest, ids):
        text = ",".join("null" if i is None else str(i) for i in ids)
        return arrays.batch(schema, {"digest": [digest], "first": ids[:1], "ids": [text]})

    def runs(batches, schema):
        digest, ids = None, []
        for rows in batches:
            for d, c in zip(rows.column("digest").to_pylist(), rows.column("conv_id").to_pylist()):
                if ids and (d != digest or len(ids) == RUN_IDS):
                    yield run(schema, digest, ids)
                    ids = []
                digest = d
                ids.append(c)
        if ids:
            yield run(schema, digest, ids)

    def hashed(batches, schema):
        digest, sha = None, None
        for rows in batches:
            for d, ids in zip(rows.column("digest").to_pylist(), rows.column("ids").to_pylist()):
                if d != digest:
                    if digest is not None:
                        yield arrays.batch(schema, {"digest": [digest], "ends_sha256": [sha.hexdigest()]})
                    digest, sha = d, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.encode())
        if digest is not None:
            yield arrays.batch(schema, {"digest": [digest], "ends_sha256": [sha.hexdigest()]})

    order = ["digest", F.asc_nulls_last("conv_id")]
    parts = arrays.over(
        ends.repartitionByRange(*order).sortWithinPartitions(*order), runs,
        "digest binary, first bigint, ids string", ["digest", "conv_id"],
    )
    together = parts.repartition("digest").sortWithinPartitions("digest", F.asc_nulls_last("first"))
    return arrays.over(together, hashed, "digest binary, ends_sha256 string", ["digest", "ids"])


def nodes(convs: DataFrame) -> DataFrame:
    """One row per distinct prefix of ``(conv_id, turns)``: ``conv_id`` (the smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.
    """
    spark = convs.sparkSession
    prefixes = materialise(_prefixes(convs), "prefixes")
    total = prefixes.agg(F.sum(F.size("digests"))).first()[0] or 0
    bits = min(max(LEAST_BITS, int(4 * total).bit_length()), MOST_BITS)
    screened = materialise(_screened(prefixes, sketch(prefixes, bits), bits), "screened")
    forget(prefixes)

    last = F.size("digests") - 1
    rows = screened.select(
        "conv_id", last.alias("length"), "shared",
        F.posexplode(
            F.arrays_zip(
                F.slice("digests", F.lit(1), F.col("shared")).alias("digest"),
                F.slice("sizes", F.lit(1), F.col("shared")).alias("size"),
                F.slice(F.concat(F.array(F.lit(None).cast("binary")), "digests"), F.lit(1), F.col("shared")).alias("parent"),
            )
        ).alias("depth", "at"),
    ).select(
        "conv_id", "depth", "at.digest", "at.size", "at.parent",
        (F.col("depth") == F.col("length")).alias("is_end"),
        ((F.col("depth") == F.col("shared") - 1) & (F.col("length") >= F.col("shared"))).alias("has_tail"),
        (F.col("length") == F.col("shared")).alias("tail_ends"),
    )
    rows = materialise(rows, "shared-prefixes")

    counted = materialise(
        # Depth, size and parent follow from the digest.
        rows.groupBy("digest", "depth", "size", "parent").agg(
            F.min("conv_id").alias("owner"),
            F.count(F.lit(1)).alias("n_convs"),
            F.count_if("has_tail").alias("tails"),
        ),
        "nodes",
    )
    below = counted.where("parent IS NOT NULL").groupBy(F.col("parent").alias("digest")).agg(F.count(F.lit(1)).alias("inner"))
    counted_all = materialise(
        counted.join(materialise(below, "children"), "digest", "left").select(
            "digest", "owner", "depth", "n_convs",
            ((F.col("n_convs") - 1) * F.col("size")).alias("saved"),
            (F.coalesce("inner", F.lit(0)) + F.col("tails")).alias("n_children"),
        ),
        "linked-nodes",
    )
    forget(counted)

    # Each conversation with what is known of its prefixes; a hot prefix is split, as both sides are read from storage.
    known = rows.join(counted_all.drop("depth"), "digest").withColumn("own", F.col("owner").eqNullSafe(F.col("conv_id")))
    by_depth = Window.partitionBy("conv_id").orderBy("depth")
    from_below = Window.partitionBy("conv_id").orderBy(F.desc("depth"))
    leaf = F.col("has_tail") | (F.col("is_end") & (F.col("n_children") == 0) & F.col("own"))
    traced = materialise(
        known.select(
            "conv_id", "depth", "digest", "own", "has_tail", "tail_ends", "owner",
            F.lag("owner").over(by_depth).alias("parent_conv_id"),
            F.sum(F.when(F.col("own"), F.col("saved")).otherwise(0)).over(from_below).alias("saved"),
            F.max(leaf.cast("int")).over(from_below).alias("leaves"),
        ),
        "traced",
    )
    totals = traced.where("own OR saved > 0 OR leaves > 0").groupBy("digest").agg(
        F.sum("saved").alias("saved_tokens"),
        F.sum("leaves").cast("bigint").alias("n_leaves"),
        F.max(F.when(F.col("own"), F.col("parent_conv_id"))).alias("parent_conv_id"),
    )
    empty = hashlib.sha256().hexdigest()
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    inner = (
        counted_all.drop("saved")
        .join(materialise(totals, "totals"), "digest")
        .join(materialise(_end_lists(rows.where("is_end").select("digest", "conv_id")), "ends"), "digest", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(empty)))
        .withColumnRenamed("owner", "conv_id")
        .withColumn("depth", F.col("depth").cast("bigint"))
        .select(*columns)
    )

    def chain(conv: Column, depth: Column, parent: Column, ends: Column) -> list[Column]:
        own = F.sha2(F.coalesce(conv.cast("string"), F.lit("null")), 256)
        return [
            conv.alias("conv_id"), depth.cast("bigint").alias("depth"), parent.alias("parent_conv_id"), F.lit(1).cast("bigint").alias("n_convs"),
            F.when(ends, 0).otherwise(1).cast("bigint").alias("n_children"), F.lit(1).cast("bigint").alias("n_leaves"), F.lit(0).cast("bigint").alias("saved_tokens"),
            F.when(ends, own).otherwise(F.lit(empty)).alias("ends_sha256"),
        ]

    # The first node of a tail hangs on a counted one, whose owner its own conversation knows.
    tops = traced.where("has_tail").select(
        *chain(F.col("conv_id"), F.col("depth") + 1, F.col("owner"), F.col("tail_ends"))
    )
    deeper = screened.where(last > F.col("shared")).select(
        "conv_id", last.alias("length"), F.explode(F.sequence(F.col("shared") + 1, last)).alias("depth")
    )
    tails = deeper.select(
        *chain(F.col("conv_id"), F.col("depth"), F.col("conv_id"), F.col("depth") == F.col("length"))
    )
    return inner.unionByName(tops).unionByName(tails)

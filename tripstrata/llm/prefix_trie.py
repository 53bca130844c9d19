"""Prefix trie of conversations by fixed-length block hashing.

A node stands for a distinct sequence of first turns; conversations that start with it
are its members.  Shared prefixes are what a training run could compute once.

1. Turns become digests at once; texts are never shuffled or sorted.
2. Turns form blocks of ``BLOCK`` turns.  A running digest over the blocks of a
   conversation names what it has said up to the end of each, so conversations are
   grouped by successive block digests, without a level-by-level loop.
3. Where all conversations that enter a block together leave it together, one of them
   speaks for all: its turns, weighted by their number, are the nodes in the block.
   Only where siblings diverge are the turns of every member refined.  A large group of
   copies is thus one row for each block after its first.
4. A node belongs to its smallest member.  What a subtree holds is the sum, over its
   members, of what they own from there on, which is a running sum along each
   conversation.  So subtrees need no recursion, however deep the trie is.

Conversations may have any number of turns: running values come from ``scan``, which
lets a conversation span tasks.  Groups are combined inside tasks before they shuffle;
the joins with a hot key have one row on the other side, and adaptive execution splits
them.  The ids that end in a node are digested from bounded pieces, in order, so a node
where a third of all conversations ends is streamed and never gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstrata.llm.common import importable_in_tasks, slices, text_of, tidy
from tripstrata.llm.scan import running
from tripstrata.sources.scratch import scratch_dir
from tripstrata.sources.writers import stage

BLOCK = 4
PIECE_IDS = 1 << 15
NODE = ("depth", "k1", "k2")


def number_turns(conversations: DataFrame, key: str = "conv_id") -> DataFrame:
    """``conv, pos, digest, n_bytes``: turns in order, numbered from 1.

    Null turns come first, null role or text is empty.  Rows that repeat a turn are
    turns of their own, by role and then digest of the text.  Rows of no conversation
    (a null key) take no part.
    """
    role, text = text_of("role"), text_of("text")
    said = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.filter(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("conv"),
        F.col("turn").alias("turn"),
        role.alias("role"),
        F.substring(F.sha2(said, 256), 1, 32).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    return running(rows, "conv", ["turn", "role", "digest"], count="pos").select("conv", "pos", "digest", "n_bytes")


def share_heads(turns: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """``conv, total, pos, digest, n_bytes``: every conversation with a borrowed head.

    Of the turns of a conversation the first h are replaced by the first h of the one
    whose id is the next lower multiple of ``family``; h is a checksum of the id,
    modulo ``most``.  A conversation left without turns has one row with a null ``pos``.
    """
    spark = turns.sparkSession
    path = scratch_dir(spark, "heads")
    lengths = turns.groupBy("conv").agg(F.max("pos").alias("own"))
    head = F.array_sort(F.collect_list(F.struct("pos", "digest", "n_bytes")))  # fewer than ``most``
    heads = (
        turns.filter((F.pmod("conv", F.lit(family)) == 0) & (F.col("pos") < most))
        .groupBy(F.col("conv").alias("base"))
        .agg(head.alias("lent"))
    )
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % most).cast("int")
    plan = (
        lengths.withColumn("h", h)
        .withColumn("base", F.col("conv") - F.pmod("conv", F.lit(family)))
        .join(heads, "base", "left")
        .withColumn("head", F.when(F.col("h") > 0, F.slice("lent", 1, F.col("h"))))
        .withColumn("lent", F.coalesce(F.size("head"), F.lit(0)).cast("long"))
        .withColumn("lent", F.greatest("lent", F.lit(0)))
        .withColumn("total", F.col("lent") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
        .select("conv", "h", "lent", "total", "head")
    )
    plan = stage(plan, path)
    first = plan.filter("lent > 0").select("conv", "total", F.inline("head"))
    none = plan.filter("total = 0").select(
        "conv", "total", F.lit(None).cast("long").alias("pos"), F.lit(None).cast("string").alias("digest"),
        F.lit(None).cast("long").alias("n_bytes"),
    )
    rest = (
        turns.join(plan.select("conv", "h", "lent", "total"), "conv")
        .filter("pos > h")
        .select("conv", "total", (F.col("pos") - F.col("h") + F.col("lent")).alias("pos"), "digest", "n_bytes")
    )
    return first.unionByName(rest).unionByName(none)


def as_they_are(turns: DataFrame) -> DataFrame:
    """The same columns as ``share_heads``, nothing borrowed."""
    total = turns.groupBy("conv").agg(F.max("pos").alias("total"))
    return turns.join(total, "conv").select("conv", "total", "pos", "digest", "n_bytes")


def _two(*parts: Column) -> tuple[Column, Column]:
    return F.xxhash64(*parts), F.xxhash64(F.lit(11400714819), *parts)


def _blocks(turns: DataFrame, block: int) -> DataFrame:
    """``conv, b, total, turns, s1, s2, e1, e2``: digests before and after each block."""
    listed = F.array_sort(F.collect_list(F.struct("pos", "digest", "n_bytes")))  # ``block`` turns
    rows = (
        turns.filter("pos IS NOT NULL")
        .groupBy("conv", F.floor((F.col("pos") - 1) / block).alias("b"))
        .agg(F.max("total").alias("total"), listed.alias("turns"))
    )
    z1, z2 = _two(F.col("b"), F.array_join("turns.digest", ""))
    rows = running(rows.withColumn("z1", z1).withColumn("z2", z2), "conv", ["b"], xors={"z1": "e1", "z2": "e2"})
    return rows.select(
        "conv", "b", "total", "turns",
        F.col("e1").bitwiseXOR(F.col("z1")).alias("s1"), F.col("e2").bitwiseXOR(F.col("z2")).alias("s2"), "e1", "e2",
    )


def _keys(block: int) -> Column:
    """Keys of the nodes at the turns of a block; the last of a whole block is its end."""
    digests = F.col("turns.digest")

    def one(place: Column) -> Column:
        inside = _two(F.col("s1"), F.col("s2"), place, F.array_join(F.slice(digests, F.lit(1), place), ""))
        return F.struct(
            F.when(place == block, F.col("e1")).otherwise(inside[0]).alias("k1"),
            F.when(place == block, F.col("e2")).otherwise(inside[1]).alias("k2"),
        )

    return F.transform(F.sequence(F.lit(1), F.size("turns")), one)


def _turn_rows(tracks: DataFrame, block: int, *more: str) -> DataFrame:
    """One row for each turn of a track, with the keys of its node and of the parent."""
    rows = tracks.withColumn("keys", _keys(block)).select(
        "conv", "b", "s1", "s2", "keys", *more, F.posexplode("turns").alias("i", "turn")
    )
    own, parent = F.get("keys", F.col("i")), F.get("keys", F.col("i") - 1)
    return rows.select(
        "conv", "b", "i", *more,
        F.col("turn.pos").alias("depth"), own.getField("k1").alias("k1"), own.getField("k2").alias("k2"),
        F.when(F.col("i") == 0, F.col("s1")).otherwise(parent.getField("k1")).alias("p1"),
        F.when(F.col("i") == 0, F.col("s2")).otherwise(parent.getField("k2")).alias("p2"),
        F.col("turn.digest").alias("digest"), F.col("turn.n_bytes").alias("n_bytes"),
    )


def _end_digests(ends: DataFrame) -> DataFrame:
    """``depth, k1, k2, ends_sha256`` from rows ``depth, k1, k2, conv``."""
    importable_in_tasks(ends.sparkSession)
    keys = [pa.int64()] * 3

    def join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def piece(node: tuple, ids: list[int]) -> pa.RecordBatch:
            values = [*node, ids[0], ",".join(map(str, ids))]
            types = [*keys, pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(values, types, strict=True)], names=[*NODE, "first", "ids"]
            )

        def pieces() -> Iterator[pa.RecordBatch]:
            held, ids = None, []
            for batch in batches:
                for part in slices(batch, 4096):
                    for *node, conv in zip(*[c.to_pylist() for c in part.columns], strict=True):
                        if node != held or len(ids) >= PIECE_IDS:
                            if ids:
                                yield piece(held, ids)
                            held, ids = node, []
                        ids.append(conv)
            if ids:
                yield piece(held, ids)

        yield from _gathered(pieces())

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(node: tuple, sha) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [*[pa.array([v], pa.int64()) for v in node], pa.array([sha.hexdigest()])], names=[*NODE, "ends_sha256"]
            )

        def nodes() -> Iterator[pa.RecordBatch]:
            held, sha = None, None
            for batch in batches:
                for part in slices(batch, 16):
                    for *node, _, ids in zip(*[c.to_pylist() for c in part.columns], strict=True):
                        if node == held:
                            sha.update(b",")
                        else:
                            if sha:
                                yield done(held, sha)
                            held, sha = node, hashlib.sha256()
                        sha.update(ids.encode())
            if sha:
                yield done(held, sha)

        yield from _gathered(nodes())

    tasks = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = ends.select(*NODE, "conv").repartitionByRange(tasks, *NODE, "conv").sortWithinPartitions(*NODE, "conv")
    schema = "depth long, k1 long, k2 long"
    joined = ordered.mapInArrow(tidy(join_ids), f"{schema}, first long, ids string")
    together = joined.repartition(tasks, *NODE).sortWithinPartitions(*NODE, "first")
    return together.mapInArrow(tidy(digest), f"{schema}, ends_sha256 string")


def _gathered(rows: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Batches of one row put together, up to some bytes each."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += row.nbytes
        if size >= most or len(held) >= 4096:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def build_trie(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """The nodes of the trie over ``conv, total, pos, digest, n_bytes``.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (smallest member of the
    parent), ``n_convs`` (members), ``n_children``, ``n_leaves`` (nodes without children in
    the subtree, the node included), ``saved_tokens`` (over the subtree, the bytes of
    each last turn times its members but one) and ``ends_sha256`` (of the ids that
    end here, in order, joined by commas).  The root has depth 0 and no parent.  No
    conversations give no nodes.
    """
    spark = turns.sparkSession
    path = scratch_dir(spark, "trie")
    turns = stage(turns, f"{path}/turns")
    blocks = stage(_blocks(turns, block), f"{path}/blocks")
    start = ["b", "s1", "s2"]

    # Which groups leave a block as they entered it.
    groups = blocks.groupBy(*start).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("conv").alias("one"),
        ((F.min("e1") == F.max("e1")) & (F.min("e2") == F.max("e2"))).alias("together"),
    )
    # Of a group that stays together one row, else all; ``cnt`` members each.
    cnt = F.when(F.col("together"), F.col("n")).otherwise(F.lit(1).cast("long"))
    tracks = blocks.join(groups, start).filter("NOT together OR conv = one").withColumn("cnt", cnt)
    tracks = stage(tracks.drop("n", "one"), f"{path}/tracks")

    found = _turn_rows(tracks, block, "cnt").groupBy(*NODE).agg(
        F.sum("cnt").alias("n_convs"), F.min("conv").alias("conv_id"), F.max("n_bytes").alias("n_bytes"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"),
        (
            (F.min("digest") != F.max("digest")) | (F.min("p1") != F.max("p1")) | (F.min("p2") != F.max("p2"))
        ).alias("mixed"),
    )
    none = F.lit(None).cast("long")
    convs = turns.filter("pos IS NULL OR pos = 1")  # one row each
    root = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id")).filter("n_convs > 0").select(
        F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("k1"), F.lit(0).cast("long").alias("k2"),
        "n_convs", "conv_id", F.lit(0).cast("long").alias("n_bytes"), none.alias("p1"), none.alias("p2"),
        F.lit(False).alias("mixed"),
    )
    nodes = stage(found.unionByName(root), f"{path}/nodes")
    if not nodes.filter("mixed").isEmpty():
        raise RuntimeError("two different prefixes have the same 128-bit digest")
    children = (
        nodes.filter("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"))
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    nodes = nodes.join(children, list(NODE), "left").select(
        *NODE, "p1", "p2", "conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("weight"),
    )
    nodes = stage(nodes, f"{path}/weighed")

    # What each conversation owns in its blocks, and from each block on.
    owned = (
        nodes.filter("depth > 0")
        .groupBy(F.col("conv_id").alias("conv"), F.floor((F.col("depth") - 1) / block).alias("b"))
        .agg(F.sum("weight").alias("weight"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"))
    )
    along = blocks.select("conv", "b", "s1", "s2").join(owned, ["conv", "b"], "left").fillna(0, ["weight", "leaves"])
    along = running(
        along.withColumn("back", -F.col("b")), "conv", ["back"], sums={"weight": "weight_on", "leaves": "leaves_on"}
    ).select("conv", "b", "s1", "s2", "weight_on", "leaves_on")
    of_group = along.groupBy(*start).agg(F.sum("weight_on").alias("group_weight"), F.sum("leaves_on").alias("group_leaves"))
    together = tracks.filter("together").join(of_group, start).withColumnsRenamed(
        {"group_weight": "weight_on", "group_leaves": "leaves_on"}
    )
    apart = tracks.filter("NOT together").join(along.drop("s1", "s2"), ["conv", "b"])
    rows = _turn_rows(together.unionByName(apart), block, "weight_on", "leaves_on")

    # A node of a track holds what the track has left there.
    mine = nodes.select(*NODE, F.col("conv_id").alias("conv"), "weight")
    rows = rows.join(mine, [*NODE, "conv"], "left")
    before = Window.partitionBy("conv", "b").orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    passed = F.coalesce(F.sum("weight").over(before), F.lit(0))
    held = rows.withColumn("left", F.col("weight_on") - passed).groupBy(*NODE).agg(
        F.sum("left").alias("saved_tokens"), F.sum("leaves_on").alias("n_leaves")
    )
    all_ = nodes.agg(
        F.sum("weight").alias("saved_tokens"), F.sum((F.col("n_children") == 0).cast("long")).alias("n_leaves")
    ).select(*[F.lit(0).cast("long").alias(k) for k in NODE], "saved_tokens", "n_leaves")
    held = held.unionByName(all_)

    last = F.element_at(_keys(block), -1)
    ends = blocks.filter(F.element_at("turns", -1).getField("pos") == F.col("total")).select(
        F.col("total").alias("depth"), last.getField("k1").alias("k1"), last.getField("k2").alias("k2"), "conv"
    )
    silent = turns.filter("pos IS NULL").select(*[F.lit(0).cast("long").alias(k) for k in NODE], "conv")
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    return (
        nodes.join(held, list(NODE))
        .join(_end_digests(ends.unionByName(silent)), list(NODE), "left")
        .join(parents, ["depth", "p1", "p2"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )

"""Trie of conversations that share their first turns, by digests of blocks of turns.

Each conversation is cut into blocks of a fixed number of turns, and a block is known by the digest of everything up to
its end. Conversations are grouped by these digests first. Where all that follows one prefix is a single block, its turns
are nodes as they are; only blocks with siblings are opened, once each however many conversations share them, and their
turns are grouped again to find where they part.

A node belongs to the smallest of its conversations. What one conversation owns is the end of its path, so the trie is a
tree of such paths, and sums over subtrees are sums along paths plus those of the paths that hang from them. Paths pass
their sums up by 1, 2, 4, ... steps, so the number of rounds is the logarithm of how deep paths hang from each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartspark.llm.common import stored

BLOCK_TURNS = 4
# Digests are the first bytes of SHA-256; the conversation without turns has the digest ROOT.
DIGEST_BYTES = 16
ROOT = bytes(DIGEST_BYTES)
# Blocks of a batch, and ids that are joined into one piece before they are hashed.
BATCH = 4_000
PIECE = 4_000


def turn_digests(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, digest of role and text, and n_bytes of the text in UTF-8; null role and text are empty."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    both = F.concat(F.length(role).cast("string"), F.lit("\n"), role, text)
    digest = F.unhex(F.substring(F.sha2(both.cast("binary"), 256), 1, 2 * DIGEST_BYTES))
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes")
    )


def _blocks(turns: DataFrame, size: int) -> DataFrame:
    """Blocks of every conversation; rows of one conversation pass one by one, however many it has."""
    binary = pa.binary()
    schema = pa.schema(
        [
            ("conv_id", pa.int64()), ("depth", pa.int64()), ("before", binary), ("end", binary), ("ends", pa.bool_()),
            ("digests", pa.list_(binary)), ("sizes", pa.list_(pa.int64())),
        ]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "digest", "n_bytes")), strict=True)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for conv_id, turns_of in groupby(rows(batches), key=lambda row: row[0]):
            depth, before, digests, sizes = 0, ROOT, [], []
            at = ROOT
            for _, digest, n_bytes in turns_of:
                if len(digests) == size:
                    yield conv_id, depth, before, at, False, digests, sizes
                    depth, before, digests, sizes = depth + size, at, [], []
                at = hashlib.sha256(at + digest).digest()[:DIGEST_BYTES]
                digests.append(at)
                sizes.append(n_bytes)
            yield conv_id, depth, before, at, True, digests, sizes

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for block in blocks(batches):
            out.append(block)
            if len(out) == BATCH:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    ordered = turns.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "digest")
    return ordered.select("conv_id", "digest", "n_bytes").mapInArrow(
        chain,
        "conv_id long, depth long, before binary, end binary, ends boolean, digests array<binary>, sizes array<bigint>",
    )


def _nodes(blocks: DataFrame) -> DataFrame:
    """node, before (its parent), depth, n_bytes, n_convs and owner of every prefix but the empty one."""
    distinct = blocks.groupBy("end").agg(
        F.first("before").alias("before"),
        F.first("depth").alias("depth"),
        F.count(F.lit(1)).alias("n_convs"),
        F.min("conv_id").alias("owner"),
        F.first("digests").alias("digests"),
        F.first("sizes").alias("sizes"),
    )
    distinct = stored(distinct, "trie-blocks-distinct")
    siblings = distinct.groupBy("before").agg(F.count(F.lit(1)).alias("siblings"))
    opened = distinct.join(siblings, "before").select(
        "siblings",
        "depth",
        "n_convs",
        "owner",
        F.posexplode(
            F.arrays_zip(
                F.col("digests").alias("node"),
                F.concat(F.array("before"), F.slice("digests", F.lit(1), F.size("digests") - 1)).alias("before"),
                F.col("sizes").alias("n_bytes"),
            )
        ).alias("place", "turn"),
    )
    turns = opened.select(
        "siblings", "turn.node", "turn.before", (F.col("depth") + F.col("place") + 1).alias("depth"), "turn.n_bytes", "n_convs", "owner"
    )
    alone = turns.where("siblings = 1").drop("siblings")
    parted = turns.where("siblings > 1").groupBy("node").agg(
        F.first("before").alias("before"),
        F.first("depth").alias("depth"),
        F.first("n_bytes").alias("n_bytes"),
        F.sum("n_convs").alias("n_convs"),
        F.min("owner").alias("owner"),
    )
    return alone.unionByName(parted)


def _end_digests(ends: DataFrame) -> DataFrame:
    """node and the digest of its conv_ids, ascending and comma-joined.

    Ids are sorted over all partitions and joined in pieces there, so the one task that must hash a node's ids in order
    reads a few long pieces, one by one.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_node, ids = None, []
        out: list[tuple] = []
        for batch in batches:
            for node, conv_id in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if ids and (node != open_node or len(ids) == PIECE):
                    out.append((open_node, ids[0], ",".join(map(str, ids))))
                    ids = []
                open_node = node
                ids.append(conv_id)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["node", "first", "ids"])
                out = []
        if ids:
            last = [(open_node, ids[0], ",".join(map(str, ids)))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*last)], names=["node", "first", "ids"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for node, parts in groupby(rows(batches), key=lambda row: row[0]):
            sha = hashlib.sha256()
            for i, (_, ids) in enumerate(parts):
                sha.update((b"," if i else b"") + ids.encode())
            out.append((node, sha.hexdigest()))
            if len(out) == BATCH:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["node", "ends_sha256"])
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["node", "ends_sha256"])

    ordered = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    joined = ordered.mapInArrow(pieces, "node binary, first long, ids string")
    by_node = joined.repartition("node").sortWithinPartitions("node", "first").select("node", "ids")
    return by_node.mapInArrow(digest, "node binary, ends_sha256 string")


def _passed_up(paths: DataFrame) -> DataFrame:
    """owner, leaves and saved of every path with all that hang from it, directly or not."""
    state = stored(paths.select("owner", "parent", "leaves", "saved"), "trie-sums")
    while state.where("parent IS NOT NULL").limit(1).count():
        given = state.where("parent IS NOT NULL").groupBy(F.col("parent").alias("to")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
        )
        # What is summed up to 2**k - 1 steps below reaches up 2**k steps; then each looks twice as far.
        step = state.select(F.col("owner").alias("via"), F.col("parent").alias("next"))
        state = stored(
            state.join(given, F.col("owner") == F.col("to"), "left")
            .join(step, F.col("parent") == F.col("via"), "left")
            .select(
                "owner",
                F.col("next").alias("parent"),
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            ),
            "trie-sums",
        )
    return state.drop("parent")


def prefix_trie(turns: DataFrame, conversations: DataFrame | None = None, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row for each distinct sequence of first turns that conversations have, the empty one included.

    ``turns`` has conv_id (an integer), turn, digest and n_bytes, as turn_digests gives them; a conversation's turns are
    ordered by turn (null first), then digest; repeated rows are turns of their own. ``conversations`` may name, in
    conv_id, conversations without turns. Rows with a null conv_id belong to no conversation. Extra columns are not read;
    without any conversation there are no rows.

    Returns conv_id (smallest member), depth, parent_conv_id (its parent's conv_id, null for the root), n_convs (members:
    conversations that begin with the sequence), n_children, n_leaves (childless nodes of the subtree), saved_tokens
    (over the subtree, (n_convs - 1) times the bytes of the node's last text) and ends_sha256 (digest of the ascending,
    comma-joined ids of members without further turns).
    """
    turns = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "digest", "n_bytes").where("conv_id IS NOT NULL")
    blocks = stored(_blocks(turns, block_turns), "trie-blocks")
    named = blocks.where("depth = 0").select("conv_id")
    ends = blocks.where("ends").select(F.col("end").alias("node"), "conv_id")
    root = F.lit(ROOT)
    if conversations is not None:
        given = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).where("conv_id IS NOT NULL").distinct()
        silent = stored(given.join(named, "conv_id", "left_anti"), "trie-silent")
        named = named.unionByName(silent)
        ends = ends.unionByName(silent.select(root.alias("node"), "conv_id"))
    top = named.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("owner")).where("n_convs > 0").select(
        root.alias("node"), F.lit(None).cast("binary").alias("before"), F.lit(0).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("n_bytes"), "n_convs", "owner",
    )
    nodes = stored(_nodes(blocks).unionByName(top), "trie-nodes")
    saved = (F.col("n_convs") - 1) * F.col("n_bytes")

    paths = nodes.groupBy("owner").agg(
        F.min(F.struct("depth", "before")).alias("top"), F.max("depth").alias("deepest"), F.sum(saved).alias("saved")
    )
    # Two lookups by digest in one join: whose node a path hangs from, and whose node has ends.
    asked = paths.select(
        F.col("top.before").alias("node"), "owner", F.col("top.depth").alias("top"), "deepest", "saved",
        F.lit(None).cast("string").alias("ends_sha256"),
    ).unionByName(_end_digests(ends), allowMissingColumns=True)
    holders = nodes.select(F.col("node").alias("held"), F.col("owner").alias("holder"), F.col("depth").alias("at"))
    answered = stored(asked.join(holders, F.col("node") == F.col("held"), "left").drop("node", "held"), "trie-lookups")
    paths = answered.where("owner IS NOT NULL").select("owner", "top", "deepest", "saved", F.col("holder").alias("parent"))

    hanging = paths.where("parent IS NOT NULL").groupBy("parent", (F.col("top") - 1).alias("at")).agg(
        F.count(F.lit(1)).alias("hung")
    ).withColumnRenamed("parent", "from")
    own = paths.join(hanging, (F.col("owner") == F.col("from")) & (F.col("deepest") == F.col("at")), "left").select(
        "owner", "parent", F.when(F.col("hung").isNull(), 1).otherwise(0).cast("long").alias("leaves"), "saved"
    )
    sums = _passed_up(own)
    inflow = paths.where("parent IS NOT NULL").select("owner", "parent", "top").join(sums, "owner").groupBy(
        F.col("parent").alias("owner"), (F.col("top") - 1).alias("depth")
    ).agg(F.count(F.lit(1)).alias("hung"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))

    parts = nodes.select("owner", "depth", "n_convs", saved.alias("saved"))
    for more in (
        inflow,
        paths.select("owner", F.col("top").alias("depth"), "parent"),
        answered.where("owner IS NULL").select(F.col("holder").alias("owner"), F.col("at").alias("depth"), "ends_sha256"),
    ):
        parts = parts.unionByName(more, allowMissingColumns=True)
    whole = parts.repartition("owner").groupBy("owner", "depth").agg(
        F.max("n_convs").alias("n_convs"),
        F.sum("saved").alias("saved"),
        F.sum("hung").alias("hung"),
        F.sum("leaves").alias("leaves"),
        F.max("parent").alias("parent"),
        F.max("ends_sha256").alias("ends_sha256"),
    )
    upward = Window.partitionBy("owner").orderBy(F.col("depth").desc())
    so_far = upward.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    n_children = F.coalesce("hung", F.lit(0)) + F.when(F.lag("depth").over(upward).isNotNull(), 1).otherwise(0)
    whole = whole.withColumn("n_children", n_children).withColumn("above", F.lead("depth").over(upward))
    leaves = F.coalesce("leaves", F.lit(0)) + _zero(F.col("n_children"))
    return whole.select(
        F.col("owner").alias("conv_id"),
        "depth",
        F.when(F.col("above").isNotNull(), F.col("owner")).otherwise(F.col("parent")).alias("parent_conv_id"),
        "n_convs",
        F.col("n_children").cast("long").alias("n_children"),
        F.sum(leaves).over(so_far).cast("long").alias("n_leaves"),
        F.sum("saved").over(so_far).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def _zero(count: Column) -> Column:
    return F.when(count == 0, 1).otherwise(0)

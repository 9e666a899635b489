r"""The trie of conversations that begin alike: members, children, leaves and tokens saved of every shared beginning.

Method: mergeable partial tries. A turn's node is the hash of its conversation's turns up to it: a sum of hashes of
(place, turn), so prefix sums over blocks of turns give it without any task that holds a conversation. Partitions
combine their nodes, tables of nodes that are keyed by hash are merged twice (by shard of members, then whole), summing
members and taking the least; lists of ends are merged in blocks of ids. Then the rollup goes up from the leaves: the
nodes of one least member are a chain, chains hang on nodes of other chains, and their sums reach all chains above in
rounds that double their reach, so that rounds grow with the logarithm of how chains hang on chains, not with turns.
Within a chain, sums from below are running sums.

Defined cases: turns are ordered by turn, null first; those of one turn by role, then by the text's hash; rows alike in
all are turns of their own. Null roles and texts are empty. Rows with a null conv_id belong to no conversation and are
left out. An empty table gives no rows. Texts of any length are hashed whole (128 bits for a beginning; two beginnings
that share them would be one node). Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.scan import running_sums
from .common import drop_written, written

#: Shards of the first merge of a node, ids in a block of its ends.
SHARDS, ENDS = 16, 1 << 12
LOW = (1 << 32) - 1


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv, nth from 1, a, b, bytes) of every turn; a and b: hashes of role and text, bytes: of the text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.xxhash64(role, text).alias("a"), F.xxhash64(F.lit("b"), role, text).alias("b"), F.octet_length(text).cast("long").alias("bytes"),
    )
    return running_sums(turns, ["conv"], "turn", {"nth": F.lit(1)}, ["role", "a", "b"]).select("conv", F.col("nth").cast("long").alias("nth"), "a", "b", "bytes")


def rebuilt(turns: DataFrame, heads: int = 9, group: int = 5) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations): every conversation begins with the first h turns of the first one of its group instead of
    its own; h: crc32 of its id, modulo heads. Turns are numbered; conversations have their number of turns."""
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % heads
    base = F.col("conv") - F.col("conv") % group
    length = turns.groupBy("conv").agg(F.max("nth").alias("own"))
    of_base = length.select(F.col("conv").alias("base"), F.least("own", F.lit(heads - 1).cast("long")).alias("has"))
    convs = length.select("conv", "own", h.alias("h"), base.alias("base")).join(of_base, "base", "left")
    convs = convs.select("conv", "base", "own", "h", F.least("h", F.coalesce("has", F.lit(0))).alias("lent"))
    size = F.col("lent") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    kept = turns.join(convs.where("own > h").select("conv", "h", "lent"), "conv").where("nth > h").withColumn("nth", F.col("nth") - F.col("h") + F.col("lent")).drop("h", "lent")
    first = turns.where(F.col("nth") < heads).withColumnRenamed("conv", "base")
    # at most heads - 1 turns, for the few conversations of a group
    lent = convs.where("lent > 0").select("conv", "base", "lent").join(first, "base").where("nth <= lent").drop("base", "lent")
    return kept.unionByName(lent), convs.select("conv", size.cast("long").alias("turns"))


def _key(depth: Column, sums: list[Column]) -> list[Column]:
    return [F.xxhash64(depth, *sums), F.xxhash64(*reversed(sums), depth)]


def beginnings(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, depth, k1, k2, p1, p2, bytes, is_end): the node of each turn and its parent's; the root, of each conversation."""
    depth = F.col("nth").cast("long")
    x, y = F.xxhash64("nth", "a", "b"), F.xxhash64("b", "nth", "a")
    # sums of 32 bits each, so that none overflows
    parts = [x.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(x, 32), y.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(y, 32)]
    summed = running_sums(turns.withColumns({f"v{i}": p for i, p in enumerate(parts)}), ["conv"], "nth", {f"s{i}": F.col(f"v{i}") for i in range(4)})
    k1, k2 = _key(depth, [F.col(f"s{i}") for i in range(4)])
    p1, p2 = _key(depth - 1, [F.col(f"s{i}") - F.col(f"v{i}") for i in range(4)])
    nodes = summed.select("conv", depth.alias("depth"), k1.alias("k1"), k2.alias("k2"), p1.alias("p1"), p2.alias("p2"), "bytes")
    none = [F.lit(0).cast("long")] * 4
    r1, r2 = _key(F.lit(0).cast("long"), none)
    null = F.lit(None).cast("long")
    ends = convs.select("conv", F.col("turns").alias("depth"), F.lit(True).alias("is_end"))
    inner = nodes.join(ends, ["conv", "depth"], "left")
    root = convs.select("conv", F.lit(0).cast("long").alias("depth"), r1.alias("k1"), r2.alias("k2"), null.alias("p1"), null.alias("p2"), F.lit(0).cast("long").alias("bytes"), F.when(F.col("turns") == 0, True).alias("is_end"))
    return inner.unionByName(root)


def merged_nodes(rows: DataFrame) -> DataFrame:
    """(k1, k2, conv, depth, p1, p2, n_convs, saved): partial tries by shard of members, then whole."""
    shard = F.pmod(F.xxhash64("conv"), F.lit(SHARDS)).alias("shard")
    same = [F.any_value(c).alias(c) for c in ("depth", "p1", "p2", "bytes")]
    partial = rows.groupBy("k1", "k2", shard).agg(*same, F.count("*").alias("n_convs"), F.min("conv").alias("conv"))
    whole = partial.groupBy("k1", "k2").agg(*same, F.sum("n_convs").alias("n_convs"), F.min("conv").alias("conv"))
    return whole.select("k1", "k2", "conv", "depth", "p1", "p2", "n_convs", ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))


def end_digests(rows: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256): ids that end in a node, ascending, joined by commas, hashed as they stream by."""
    block = F.floor(F.col("conv") / ENDS).alias("block")
    blocks = rows.where("is_end").groupBy("k1", "k2", block).agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    ordered = blocks.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "block").select("k1", "k2", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, None
        for batch in batches:
            done = []
            for k1, k2, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if (k1, k2) != key:
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = (k1, k2), hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(("k1", "k2", "ends_sha256"), x)) for x in done], SCHEMA)
        if key is not None:
            yield pa.RecordBatch.from_pylist([{"k1": key[0], "k2": key[1], "ends_sha256": digest.hexdigest()}], SCHEMA)

    return ordered.mapInArrow(run, "k1 long, k2 long, ends_sha256 string")


SCHEMA = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])


def chains_of(nodes: DataFrame) -> DataFrame:
    """(chain, first, last, parent, n_leaves, saved): the nodes of each least member, from depth first to last, the chain
    on which it hangs (null: none), whether its end is a leaf, and its own nodes' sum."""
    own = nodes.groupBy("conv").agg(F.min("depth").alias("first"), F.max("depth").alias("last"), F.min_by(F.struct("p1", "p2"), "depth").alias("p"), F.sum("saved").alias("saved"))
    parents = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("parent"))
    hung = own.select(F.col("conv").alias("chain"), "first", "last", "p.p1", "p.p2", "saved").join(parents, ["p1", "p2"], "left").drop("p1", "p2")
    at = hung.where("parent is not null").select(F.col("parent").alias("chain"), (F.col("first") - 1).alias("last"), F.lit(1).alias("hangs")).distinct()
    return hung.join(at, ["chain", "last"], "left").select("chain", "first", "last", "parent", F.when(F.col("hangs").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"), "saved")


def rolled_up(chains: DataFrame) -> DataFrame:
    """(chain, above, n_leaves, saved) with the sums of all chains that hang on it, at once or through others."""
    sums = written(chains.select("chain", F.col("parent").alias("above"), "n_leaves", "saved"), "sums")
    while not sums.where("above is not null").isEmpty():
        # sums reach twice as far up as before
        add = sums.where("above is not null").groupBy(F.col("above").alias("chain")).agg(F.sum("n_leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        further = sums.where("above is not null").select(F.col("chain").alias("above"), F.col("above").alias("next"))
        total = lambda c, more: (F.col(c) + F.coalesce(more, F.lit(0))).alias(c)
        out = sums.join(add, "chain", "left").join(further, "above", "left").select("chain", F.col("next").alias("above"), total("n_leaves", "more_leaves"), total("saved", "more_saved"))
        last, sums = sums, written(out, "sums")
        drop_written(last)
    return sums


def conversation_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the trie of conversations (conv, turns: how many), whose turns are (conv, nth, a, b, bytes).

    conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    rows = written(beginnings(turns, convs), "beginnings")
    nodes = written(merged_nodes(rows), "nodes")
    chains = written(chains_of(nodes), "chains")
    sums = rolled_up(chains)
    # what happens at a node: chains hang on it, a chain begins there, a chain ends there
    below = chains.where("parent is not null").select("chain", "parent", "first").join(sums.select("chain", F.col("n_leaves").alias("leaves"), F.col("saved").alias("more")), "chain").select(F.col("parent").alias("conv"), (F.col("first") - 1).alias("depth"), "leaves", "more", F.lit(1).alias("hangs"))
    begun = chains.select(F.col("chain").alias("conv"), F.col("first").alias("depth"), "parent", F.lit(1).alias("begins"))
    ended = chains.select(F.col("chain").alias("conv"), F.col("last").alias("depth"), F.col("n_leaves").alias("leaves"), F.lit(1).alias("ends"))
    events = below.unionByName(begun, allowMissingColumns=True).unionByName(ended, allowMissingColumns=True)
    # chains that hang on one node may be many: they are summed before they meet
    marks = events.groupBy("conv", "depth").agg(*(F.sum(c).alias(c) for c in ("leaves", "more", "hangs", "begins", "ends")), F.max("parent").alias("parent"))
    marked = nodes.select("k1", "k2", "conv", "depth", "n_convs", "saved").join(marks, ["conv", "depth"], "left").withColumn("up", -F.col("depth"))
    rolled = running_sums(marked, ["conv"], "up", {"n_leaves": F.col("leaves"), "saved_tokens": F.col("saved") + F.coalesce("more", F.lit(0))})
    # the chain's next node is a child too
    children = F.coalesce("hangs", F.lit(0)) + F.when(F.col("ends").isNull(), 1).otherwise(0)
    out = rolled.join(end_digests(rows), ["k1", "k2"], "left")
    trie = out.select(
        F.col("conv").alias("conv_id"), "depth", F.when(F.col("begins").isNull(), F.col("conv")).otherwise(F.col("parent")).alias("parent_conv_id"),
        "n_convs", children.cast("long").alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
    last = written(trie, "trie")
    drop_written(rows, nodes, chains, sums)
    return last


def trie_report(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    turns = written(numbered(conversations), "turns")
    trie = conversation_trie(*rebuilt(turns))
    drop_written(turns)
    return trie

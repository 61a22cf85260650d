"""Conversation prefix trie by the Euler-tour technique.

A node of depth d is a distinct sequence of the first d turns, given by its
smallest member conversation and d.

1. Turns are numbered inside their conversation, and each prefix gets a name:
   the sum of turn digests times powers of a fixed base modulo 2**127 - 1.
   Sums go on across tasks, so a conversation with a third of all rows is sorted
   and summed by many tasks; a range of rows only needs the sums before it.
   Two of n different sequences share a name with a chance of about
   n * n * length / 2**127.
2. Rows of one name are one node, combined before the shuffle.  Nodes are
   numbered so that the children of a node are neighbours, the smallest first.
3. The tour has an enter and an exit arc per node.  An arc's successor follows
   from the node's first child, its next sibling and its parent.
4. The tour is list-ranked: in each round arcs toss coins, and one whose coin is
   1 is spliced out if its predecessor's is 0, a quarter of the arcs on average;
   the predecessor takes over its sums.  When at most ``LAST_ARCS`` are left, one
   task walks them; then the rounds are undone in reverse order.  All
   rounds together move about four times the arcs, and no group exceeds two rows.
5. Each arc knows the leaves and savings before it in the tour, so a subtree's
   are the difference between its exit and its enter arc.
6. The members that end at a node are sorted by range and joined to chunks of
   text; only the chunks of a node meet in one task, which digests them in order.

Null roles and texts are empty; rows without a ``conv_id`` belong to no
conversation.  Turns are ordered by turn (null first), then role and text, so
ties and repeated rows have a fixed order; repeated rows are turns of their own.
Very long texts are digested where they are read and never travel beyond the
first sort.  An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_hot, numbered, partitions, stage, words_of

MODULUS = (1 << 127) - 1
BASE = 0x2545F4914F6CDD1D9E3779B97F4A7C15
ROOT = bytes(16)
LAST_ARCS = 20_000
CHUNK_CHARS = 60_000


def running(rows: DataFrame, key: str, order: list[Column], keep: list[str],
            value: Callable[[dict], int], name: str) -> DataFrame:
    """Columns ``keep`` and the sum of ``value`` modulo 2**127 - 1 over the rows
    of the same ``key`` up to this one (``name``, 16 bytes), without one task per key.

    Rows are dealt by range of (key, order) and summed inside each range; the sum
    of a key that goes on from an earlier range is added then.  One row per range
    reaches the driver.  Equal rows are told apart by their place in the input,
    so that they can be dealt apart.
    """
    dealt = rows.withColumn("_place", F.monotonically_increasing_id())
    by = [F.col(key), *order, F.col("_place")]
    dealt = dealt.repartitionByRange(partitions(rows.sparkSession), *by).sortWithinPartitions(*by).select(*keep)
    at = keep.index(key)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema)

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, own, total, n = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            sums = []
            for k, row in zip(batch.column(at).to_pylist(), batch.to_pylist()):
                if k != own:
                    own, total = k, 0
                total = (total + value(row)) % MODULUS
                sums.append(total.to_bytes(16, "big"))
            m = batch.num_rows
            yield pa.record_batch(
                [*batch.columns, pa.array(sums, pa.binary()), pa.array([part] * m, pa.int32()),
                 pa.array(range(n, n + m), pa.int64())], names=[*keep, name, "_part", "_i"])
            n += m

    staged = stage(dealt.mapInArrow(inside, f"{schema}, {name} binary, _part int, _i long"), "running")
    ends = (staged.groupBy("_part").agg(F.min(key).alias("first"), F.max_by(F.struct(key, name), "_i").alias("last"))
            .orderBy("_part").collect())
    before: dict[int, tuple[int, int]] = {}
    own, total = None, 0
    for r in ends:
        if own is not None and r["first"] == own:
            before[r["_part"]] = own, total
        more = int.from_bytes(r["last"][name], "big")
        own, total = r["last"][key], (more + (total if r["last"][key] == own == r["first"] else 0)) % MODULUS

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums, parts = batch.column(len(keep)).to_pylist(), batch.column(len(keep) + 1).to_pylist()
            for i, (k, p) in enumerate(zip(batch.column(at).to_pylist(), parts)):
                if p in before and before[p][0] == k:
                    sums[i] = ((int.from_bytes(sums[i], "big") + before[p][1]) % MODULUS).to_bytes(16, "big")
            yield pa.record_batch([*batch.columns[:len(keep)], pa.array(sums, pa.binary())], names=[*keep, name])

    return staged.mapInArrow(across, f"{schema}, {name} binary")


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, d, digest, words): the turns of each conversation from 1."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    rows = rows.withColumns({
        "digest": F.substring(F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)), 1, 16),
        "words": F.size(words_of(F.col("text"))).cast("long")})
    out = running(rows, "conv_id", [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")],
                  ["conv_id", "digest", "words"], lambda row: 1, "at")
    return stage(out.select("conv_id", F.conv(F.hex("at"), 16, 10).cast("long").alias("d"), "digest", "words"), "turns")


def rebuilt(turns: DataFrame, every: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """The turns of conversations that share heads, and all their ids: c begins
    with the first h turns of c - c % ``every`` (those there are), h being the
    crc32 of c in decimal modulo ``heads``, and goes on with its own after h."""
    c = F.col("conv_id")
    h = F.crc32(c.cast("string").cast("binary")) % heads
    ids = stage(turns.select("conv_id").distinct(), "conversations")
    first = stage(turns.where((c % every == 0) & (F.col("d") < heads)), "heads")
    length = first.groupBy(c.alias("base")).agg(F.max("d").alias("length"))
    taken = stage(ids.withColumn("base", c - c % every).join(length, "base", "left")
                  .select("conv_id", "base", F.least(h, F.coalesce("length", F.lit(0))).alias("taken")), "taken")
    head = (taken.where("taken > 0").join(first.withColumnRenamed("conv_id", "base"), "base")
            .where("d <= taken").select("conv_id", "d", "digest", "words"))
    own = join_hot(turns.where(F.col("d") > h), taken.select("conv_id", "taken"), "conv_id")
    tail = own.select("conv_id", (F.col("taken") + F.col("d") - h).alias("d"), "digest", "words")
    return stage(head.unionByName(tail), "rebuilt"), ids


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, d, words, node, parent): the name of every prefix and of the one before it."""
    def term(row: dict) -> int:
        return int.from_bytes(row["digest"], "big") * pow(BASE, row["d"], MODULUS) % MODULUS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parent = [((int.from_bytes(r["node"], "big") - term(r)) % MODULUS).to_bytes(16, "big")
                      for r in batch.to_pylist()]
            yield pa.record_batch([*(batch.column(i) for i in (0, 1, 3, 4)), pa.array(parent, pa.binary())],
                                  names=["conv_id", "d", "words", "node", "parent"])

    named = running(turns, "conv_id", [F.col("d")], ["conv_id", "d", "digest", "words"], term, "node")
    return stage(named.mapInArrow(run, "conv_id long, d long, words long, node binary, parent binary"), "prefixes")


def ends_digest(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of (node, conv_id): the ids in order, comma-joined."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, held, size = None, 0, [], 0
        out: list[tuple] = []
        for batch in batches:
            for n, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if n != node or size > CHUNK_CHARS:
                    if held:
                        out.append((node, first, ",".join(held)))
                    node, first, held, size = n, c, [], 0
                held.append(str(c))
                size += len(held[-1]) + 1
            if out:
                yield pa.record_batch([pa.array(x) for x in zip(*out)], names=["node", "first", "ids"])
                out = []
        if held:
            yield pa.record_batch([pa.array([x]) for x in (node, first, ",".join(held))], names=["node", "first", "ids"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        out: list[tuple] = []
        for batch in batches:
            for n, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if n == node:
                    sha.update(b",")
                else:
                    if sha:
                        out.append((node, sha.hexdigest()))
                    node, sha = n, hashlib.sha256()
                sha.update(ids.encode())
            if out:
                yield pa.record_batch([pa.array(x) for x in zip(*out)], names=["node", "ends_sha256"])
                out = []
        if sha:
            yield pa.record_batch([pa.array([node]), pa.array([sha.hexdigest()])], names=["node", "ends_sha256"])

    return (ends.repartitionByRange(partitions(ends.sparkSession), "node", "conv_id")
            .sortWithinPartitions("node", "conv_id").mapInArrow(chunks, "node binary, first long, ids string")
            .repartition("node").sortWithinPartitions("node", "first")
            .mapInArrow(whole, "node binary, ends_sha256 string"))


def list_rank(arcs: DataFrame, sums: list[str], head: int = 0) -> DataFrame:
    """(id, ``sums``) of a linked list (id, next, ``sums``): the sums over all
    arcs before each.  ``next`` is null at the end; the list begins at ``head``."""
    total = [F.col(f"p.{c}") + F.col(f"s.{c}") for c in sums]
    rest, undone, tosses = stage(arcs.select("id", "next", *sums), "arcs"), [], 0
    while rest.count() > LAST_ARCS:
        tosses += 1
        coin = lambda c: F.xxhash64(F.col(c), F.lit(tosses)).bitwiseAND(F.lit(1)) == 1
        takes = ~coin("id") & F.coalesce(coin("next") & F.col("next").isNotNull(), F.lit(False))
        p, s = rest.where(takes).alias("p"), rest.where(coin("id")).alias("s")
        hit = F.col("p.id").isNotNull()
        stays = F.struct(F.lit(True).alias("in"), F.when(hit, F.col("p.id")).otherwise(F.col("s.id")).alias("id"),
                         F.col("s.next").alias("next"),
                         *(F.when(hit, t).otherwise(F.col(f"s.{c}")).alias(c) for t, c in zip(total, sums)))
        goes = F.struct(F.lit(False).alias("in"), F.col("s.id").alias("id"), F.col("p.id").alias("next"),
                        *(F.col(f"p.{c}").alias(c) for c in sums))
        spliced = s.join(p, F.col("p.next") == F.col("s.id"), "left").select(
            F.explode(F.when(hit, F.array(stays, goes)).otherwise(F.array(stays))).alias("e")).select("e.*")
        both = stage(spliced.unionByName(rest.where(~coin("id") & ~takes).withColumn("in", F.lit(True))), "spliced")
        undone.append(both.where(~F.col("in")).drop("in"))
        rest = both.where("in").drop("in")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        after: dict[int, tuple] = {}
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                after[row[0]] = row[1:]
        out, own, upto = [], head if after else None, [0] * len(sums)
        while own is not None:
            out.append((own, *upto))
            own, *more = after[own]
            upto = [a + b for a, b in zip(upto, more)]
        yield pa.record_batch([pa.array([r[i] for r in out], pa.int64()) for i in range(len(sums) + 1)],
                              names=["id", *sums])

    # at most LAST_ARCS rows
    known = stage(rest.repartition(1).mapInArrow(walk, "id long, " + ", ".join(f"{c} long" for c in sums)), "ranked")
    for gone in reversed(undone):
        found = gone.alias("g").join(known.alias("k"), F.col("g.next") == F.col("k.id")).select(
            F.col("g.id").alias("id"), *((F.col(f"g.{c}") + F.col(f"k.{c}")).alias(c) for c in sums))
        known = stage(known.unionByName(found), "ranked")
    return known


def prefix_trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per node of the trie of (conv_id, d, digest, words): conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256.  ``ids`` are all conversations, those without turns too."""
    rows = prefixes(turns)
    root = (ids.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
            .select(F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"),
                    F.lit(0).cast("long").alias("depth"), "n_convs", "conv_id", F.lit(0).cast("long").alias("words")))
    nodes = (rows.groupBy("node", "parent", F.col("d").alias("depth"))
             .agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("words").alias("words")))
    nodes = stage(numbered(root.unionByName(nodes), F.col("parent").asc_nulls_first(), F.col("conv_id")), "nodes")
    family = (nodes.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node"))
              .agg(F.count(F.lit(1)).alias("n_children"), F.min("no").alias("first")))
    nodes = stage(nodes.join(family, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "family")
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"),
                         F.col("no").alias("parent_no"), (F.col("first") + F.col("n_children") - 1).alias("last"))
    nodes = stage(join_hot(nodes, above, "parent"), "nodes-above")

    own = 2 * F.col("no")
    leaf = F.col("n_children") == 0
    zero = F.lit(0).cast("long")
    enter = F.struct(own.alias("id"), F.when(leaf, own + 1).otherwise(2 * F.col("first")).alias("next"),
                     leaf.cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"))
    leave = F.struct((own + 1).alias("id"),  # null after the root's
                     F.when(F.col("no") < F.col("last"), own + 2).otherwise(2 * F.col("parent_no") + 1).alias("next"),
                     zero.alias("leaves"), zero.alias("saved"))
    arcs = nodes.select(F.explode(F.array(enter, leave)).alias("a")).select("a.*")
    subtree = list_rank(arcs, ["leaves", "saved"]).groupBy(F.shiftright("id", 1).alias("no")).agg(
        *((F.max(c) - F.min(c)).alias(c) for c in ("leaves", "saved")))

    last = rows.groupBy("conv_id").agg(F.max_by("node", "d").alias("node"))
    ends = stage(ids.join(last, "conv_id", "left").select(F.coalesce("node", F.lit(ROOT)).alias("node"), "conv_id"), "ends")
    return (nodes.join(subtree, "no").join(ends_digest(ends), "node", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
                    F.col("saved").alias("saved_tokens"),
                    F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")))

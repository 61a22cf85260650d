"""SimHash near-duplicates by a Gray-order hierarchical index.

1. A document's fingerprint is the bitwise majority over the XXH64 hashes of
   its word shingles; each text is hashed in one pass inside a task.
2. Fingerprints that differ in at most three bits agree on one of four 16-bit
   bands, and then on one of four 12-bit parts of the rest.  So the distinct
   fingerprints are dealt into 16 tables of 28-bit keys, and every link meets
   in at least one bucket.
3. Inside a bucket, fingerprints are sorted by Gray rank, so that neighbours
   share bits.  Groups of eight make nodes, groups of nodes upper nodes: a node
   holds the bits all its members share (mask and pattern).  Two nodes are
   compared on the bits both share; a difference counted at an upper node is
   carried down, only newly shared bits are counted, and a pair of groups goes
   as soon as its differences exceed the distance.  So do pairs of groups that
   are already in one component.
4. A task keeps a bucket's links as a forest (fewer links than members), and
   the forests are joined into components over all tables.

Buckets of more than ``BLOCK`` fingerprints are split into blocks, and each
pair of blocks is a bucket of its own, so no task holds an unbounded group and
no link is lost.  Exact copies have one fingerprint and cost one row.

Null texts count as empty; texts without words have fingerprint zero, linked
like any other.  Repeated rows share a component.  A null ``doc_id`` is never
the smallest, unless its whole component has null ids.  An empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage
from .components import components

BITS = 64
BANDS, BAND = 4, 16
PARTS, PART = 4, 12
FAN = 8
#: Most fingerprints of a bucket that one task compares at once.
BLOCK = 1 << 15
#: Node pairs that are expanded at a time.
SLICE = 1 << 18


# ------------------------------------------------------------- fingerprints
def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """The unsigned fingerprint of one text (UTF-8)."""
    words = text.lower().split()  # bytes: lowers A-Z only, splits at the six ASCII blanks
    if not words:
        return 0
    whole = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    n = max(len(words) - shingle + 1, 1)
    starts, stops = (ends - size)[:n].tolist(), ends[min(shingle, len(words)) - 1:].tolist()
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter((h(whole[a:b], seed) for a, b in zip(starts, stops)), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 14):
        part = hashes[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, key: str | None = None) -> DataFrame:
    """doc_id, fp (the 64 bits as a long) for every row, and its ``key`` (text) if named."""
    also = [key] if key else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint((t.as_py() or "").encode(), shingle, seed)
                               for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.record_batch([batch.column(0), pa.array(fps.view(np.int64)), *batch.columns[2:]],
                                  names=["doc_id", "fp", *also])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *also).mapInArrow(
        run, ", ".join(["doc_id long, fp long", *(f"{c} string" for c in also)]))


# -------------------------------------------------------------------- index
def gray_rank(fp: np.ndarray) -> np.ndarray:
    """The position of each word in the reflected Gray code."""
    out = fp.astype(np.uint64)
    for step in (1, 2, 4, 8, 16, 32):
        out = out ^ (out >> np.uint64(step))
    return out


class GrayIndex:
    """Nodes over fingerprints that are sorted by (bucket, Gray rank).

    Level 0 are the fingerprints; a node of the next level spans ``FAN``
    neighbours of the same bucket; the top level has one node per bucket.
    """

    def __init__(self, fp: np.ndarray, bucket: np.ndarray) -> None:
        self.pattern, self.mask = [fp], [np.full(len(fp), ~np.uint64(0))]
        self.first: list[np.ndarray] = []  # first child of each node, per upper level
        self.count: list[np.ndarray] = []
        any_, all_, own = fp, fp, bucket
        while True:
            head = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
            size = np.diff(np.append(head, len(own)))
            if self.first and (size == 1).all():
                break
            inside = np.arange(len(own)) - np.repeat(head, size)
            start = np.flatnonzero(inside % FAN == 0)
            self.first.append(start)
            self.count.append(np.diff(np.append(start, len(own))))
            any_ = np.bitwise_or.reduceat(any_, start)
            all_ = np.bitwise_and.reduceat(all_, start)
            own = own[start]
            self.mask.append(~(any_ ^ all_))
            self.pattern.append(all_)

    def _children(self, level: int, a: np.ndarray, b: np.ndarray):
        """All pairs of children of node pairs; each unordered pair once."""
        first, count = self.first[level - 1], self.count[level - 1]
        na, nb = count[a], count[b]
        n = na * nb
        pair = np.repeat(np.arange(len(a)), n)
        k = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        x, y = first[a][pair] + k // nb[pair], first[b][pair] + k % nb[pair]
        keep = (x < y) if level == 1 else (x <= y)
        keep |= (a != b)[pair]
        return pair[keep], x[keep], y[keep]

    def links(self, most: int, label: np.ndarray) -> None:
        """Unite in ``label`` (smallest index of each component) all
        fingerprints of a bucket that differ in at most ``most`` bits."""
        top = len(self.first)
        nodes = np.arange(len(self.pattern[top]))
        zero = np.zeros(len(nodes), np.int64)
        todo = [(top, nodes, nodes, zero, np.zeros(len(nodes), np.uint64))]
        while todo:
            level, a, b, far, seen = todo.pop()
            if len(a) > SLICE:
                half = len(a) // 2
                todo.append((level, a[half:], b[half:], far[half:], seen[half:]))
                todo.append((level, a[:half], b[:half], far[:half], seen[:half]))
                continue
            pair, x, y = self._children(level, a, b)
            below = level - 1
            shared = self.mask[below][x] & self.mask[below][y]
            new = shared & ~seen[pair]  # bits that the parents did not share
            far = far[pair] + np.bitwise_count((self.pattern[below][x] ^ self.pattern[below][y]) & new)
            keep = far <= most
            x, y, far, shared = x[keep], y[keep], far[keep], shared[keep]
            if not len(x):
                continue
            if below == 0:
                unite(label, x, y)
                continue
            low, high = self._labels(below, label)
            apart = ~((low[x] == high[x]) & (low[y] == high[y]) & (low[x] == low[y]))
            todo.append((below, x[apart], y[apart], far[apart], shared[apart]))

    def _labels(self, level: int, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = high = label
        for start in self.first[:level]:
            low, high = np.minimum.reduceat(low, start), np.maximum.reduceat(high, start)
        return low, high


def unite(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Unite the components of x[i] and y[i] in place."""
    while True:
        a, b = label[x], label[y]
        differ = a != b
        if not differ.any():
            return
        x, y, a, b = x[differ], y[differ], a[differ], b[differ]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def forest(fp: np.ndarray, bucket: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, its component's representative) of whole buckets."""
    head = np.concatenate([[True], bucket[1:] != bucket[:-1]])
    size = np.diff(np.append(np.flatnonzero(head), len(bucket)))
    several = np.repeat(size > 1, size)  # a bucket of one has no links
    fp, bucket = fp[several], bucket[several]
    if not len(fp):
        return fp, fp
    order = np.lexsort((gray_rank(fp), bucket))
    fp, bucket = fp[order], bucket[order]
    label = np.arange(len(fp))
    GrayIndex(fp, bucket).links(most, label)
    linked = np.flatnonzero(label != np.arange(len(fp)))
    return fp[linked], fp[label[linked]]


# --------------------------------------------------------------- whole corpus
def _keys(fp: Column) -> Column:
    """The 16 bucket keys of a fingerprint: table, band, part of the rest."""
    out = []
    for band in range(BANDS):
        at = band * BAND
        own = F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << BAND) - 1))
        low = fp.bitwiseAND(F.lit((1 << at) - 1)) if at else F.lit(0).cast("long")
        rest = F.shiftleft(F.shiftrightunsigned(fp, at + BAND), at) if at + BAND < BITS else F.lit(0).cast("long")
        rest = rest.bitwiseOR(low)
        for part in range(PARTS):
            piece = F.shiftrightunsigned(rest, part * PART).bitwiseAND(F.lit((1 << PART) - 1))
            out.append(F.shiftleft(F.lit(band * PARTS + part).cast("long"), BAND + PART)
                       .bitwiseOR(F.shiftleft(own, PART)).bitwiseOR(piece))
    return F.array(*out)


def _dealt(fps: DataFrame) -> DataFrame:
    """(key, sub, fp): the buckets, with large ones split into pairs of blocks."""
    rows = fps.select("fp", F.explode(_keys(F.col("fp"))).alias("key"))
    large = stage(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
                  .select(F.col("key").alias("_key"), F.ceil(2 * F.col("n") / BLOCK).alias("m")),
                  "large-buckets")
    if large.isEmpty():
        return rows.select("key", F.lit(0).cast("long").alias("sub"), "fp")
    rows = rows.join(large, F.col("key") == F.col("_key"), "left")
    own = F.pmod(F.xxhash64("fp"), F.col("m"))
    blocks = F.transform(F.sequence(F.lit(0).cast("long"), F.col("m") - 1),
                         lambda j: F.least(own, j) * F.col("m") + F.greatest(own, j))
    return rows.select("key", F.explode(F.coalesce(F.array_distinct(blocks), F.array(F.lit(0).cast("long"))))
                       .alias("sub"), "fp")


def links(fps: DataFrame, most: int = 3) -> DataFrame:
    """Links (u, v) whose components are those of all pairs of distinct
    fingerprints ``fp`` that differ in at most ``most`` bits."""
    if most > 3:
        raise ValueError("the tables of this index find links of up to three bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def solved(rows: np.ndarray) -> pa.RecordBatch:
            new = (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])
            bucket = np.concatenate([[0], np.cumsum(new)])
            u, v = forest(rows[:, 2].view(np.uint64), bucket, most)
            return pa.record_batch([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        for batch in batches:
            rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], 1)
            held.append(rows)
            if sum(map(len, held)) < 1 << 18:
                continue
            rows = np.concatenate(held)
            # the last bucket may go on in the next batch
            last = np.flatnonzero((rows[:, 0] != rows[-1, 0]) | (rows[:, 1] != rows[-1, 1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield solved(rows[:cut])
            held = [rows[cut:]]
        if held and sum(map(len, held)):
            yield solved(np.concatenate(held))

    return (_dealt(fps).repartition("key", "sub").sortWithinPartitions("key", "sub")
            .mapInArrow(run, "u long, v long"))


def _rooted(fps: DataFrame, most: int) -> DataFrame:
    """``fps`` (distinct fp) with root, the fingerprint that stands for its component."""
    roots = components(links(fps.select("fp"), most)).select(F.col("node").alias("fp"), "root")
    return fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, shingle: int = 3, most: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fp, component_id (the smallest doc_id of the component) per row."""
    rows = stage(fingerprints(docs, shingle, seed), "fingerprints")
    fps = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    rooted = _rooted(fps, most)
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    return rows.join(rooted.join(smallest, "root").select("fp", "component_id"), "fp").select(
        "doc_id", "fp", "component_id")


def representatives(docs: DataFrame, key: str, shingle: int = 3, most: int = 3, seed: int = 42) -> DataFrame:
    """The ``key`` (text) of one row per component: of those with the smallest
    ``doc_id`` (null if there is no other) the smallest key."""
    rows = stage(fingerprints(docs, shingle, seed, key), "fingerprints")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", key))
    fps = stage(rows.groupBy("fp").agg(least.alias("first")), "distinct-fingerprints")
    return _rooted(fps, most).groupBy("root").agg(F.min("first").alias("first")).select(f"first.{key}")

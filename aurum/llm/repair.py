"""Token ids in compressed files: Re-Pair grammars per shard, random access.

Documents are sorted by ``doc_id`` over range partitions.  Each task streams
its documents, encodes them, and closes a shard whenever it holds at least
``shard_tokens`` ids.  A shard is one grammar: the most frequent neighbouring
pairs of symbols become new symbols, round by round, until no pair is frequent
enough or the rounds are used up.  In one round all frequent pairs are replaced
whose left symbols differ from their right symbols, so no two replacements
overlap and a round is a few array operations.

A file is Parquet, one row per shard: the part (range partition), the shard's
first position in its part, the documents and their numbers of ids, and a
payload.  The payload holds the rules, the length each symbol expands to, and
the final symbols.  ``parts`` beside it has the ids per part (one row a task),
so positions over the whole corpus need no global pass over the documents.

Nulls and empty texts hold the end id alone; a null ``doc_id`` sorts first;
rows that repeat a ``doc_id`` are kept, ordered by their text.  An empty table
gives an empty file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tokens

MAGIC = b"AUPR0001"
FILE = ("part int, shard long, start long, n_tokens long, doc_ids array<long>, "
        "doc_tokens array<long>, payload binary")


def _pairs(seq: np.ndarray, size: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent neighbouring pairs as left * size + right, most frequent first, and counts."""
    key = np.sort(seq[:-1] * size + seq[1:])
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    n = np.diff(np.append(at, len(key)))
    often = np.flatnonzero(n >= least)
    order = often[np.lexsort((key[at[often]], -n[often]))]
    return key[at[order]], n[order]


def _choose(keys: np.ndarray, size: int, most: int) -> list[int]:
    """Pairs in order of frequency, as long as no symbol stands on both sides."""
    side: dict[int, bool] = {}
    out = []
    for key in keys[:most].tolist():
        a, b = divmod(key, size)
        if a != b and not side.get(a, False) and side.get(b, True):
            side[a], side[b] = False, True
            out.append(key)
    return out


def compress(ids: np.ndarray, least: int = 16, rounds: int = 6, most: int = 4096) -> bytes:
    """A Re-Pair grammar of ``ids`` as bytes (see ``expand``)."""
    seq = ids.astype(np.int64)
    base = int(seq.max()) + 1 if len(seq) else 0
    rules = np.zeros((0, 2), np.int64)
    length = np.ones(base, np.int64)
    for _ in range(rounds):
        if len(seq) < 2 * least:
            break
        size = base + len(rules) + 1
        chosen = _choose(_pairs(seq, size, least)[0], size, most)
        if not chosen:
            break
        keys = np.sort(np.array(chosen, np.int64))
        a, b = keys // size, keys % size
        # a table of left by right symbols holds the rule of each chosen pair: at most (most / 2) ** 2 cells
        left, right = np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        sides = np.unique(a), np.unique(b)
        left[sides[0]] = np.arange(len(sides[0])) * len(sides[1])
        right[sides[1]] = np.arange(len(sides[1]))
        rule_of = np.full(len(sides[0]) * len(sides[1]), -1, np.int32)
        rule_of[left[a] + right[b]] = np.arange(len(keys))
        row, column = left[seq[:-1]], right[seq[1:]]
        at = np.flatnonzero((row | column) >= 0)
        rule = rule_of[row[at] + column[at]]
        hit = rule >= 0
        at, rule = at[hit], rule[hit]
        seq[at] = base + len(rules) + rule
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq = seq[keep]
        rules = np.concatenate([rules, np.stack([a, b], 1)])
        length = np.concatenate([length, length[a] + length[b]])  # a rule uses earlier symbols only
    wide = 3 if base + len(rules) < 1 << 24 else 4
    # the symbols byte by byte, high bytes last: they compress well in the file
    packed = seq.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :wide].T.tobytes()
    return b"".join([MAGIC, struct.pack("<IIQB", base, len(rules), len(seq), wide),
                     rules.astype("<u4").tobytes(), length[base:].astype("<u4").tobytes(), packed])


def _open(payload: bytes) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    if payload[:8] != MAGIC:
        raise ValueError("not a shard of this file format")
    base, n, m, wide = struct.unpack_from("<IIQB", payload, 8)
    at = 8 + struct.calcsize("<IIQB")
    rules = np.frombuffer(payload, "<u4", 2 * n, at).reshape(-1, 2)
    length = np.frombuffer(payload, "<u4", n, at + 8 * n)
    raw = np.frombuffer(payload, np.uint8, m * wide, at + 12 * n).reshape(wide, m)
    seq = raw[0].astype(np.uint32)
    for j in range(1, wide):
        seq |= raw[j].astype(np.uint32) << np.uint32(8 * j)
    return base, rules, length, seq


def expand(payload: bytes, start: int = 0, count: int | None = None) -> np.ndarray:
    """The ids [start, start + count) of a shard.  Expansion lengths tell which
    symbols cover them, so only those are expanded."""
    base, rules, length, seq = _open(payload)
    size = np.concatenate([np.ones(base, np.int64), length.astype(np.int64)])
    upto = np.concatenate([[0], np.cumsum(size[seq])])
    stop = int(upto[-1]) if count is None else min(start + count, int(upto[-1]))
    if stop <= start:
        return np.zeros(0, np.uint32)
    a = int(np.searchsorted(upto, start, "right")) - 1
    b = int(np.searchsorted(upto, stop, "left"))
    seq = seq[a:b]
    used = np.zeros(len(rules), bool)
    used[seq[seq >= base] - base] = True
    own = np.flatnonzero(used) + base
    flat = _by_levels(own, base, rules)  # each symbol that occurs is expanded once
    first = np.arange(base + len(rules), dtype=np.int64) + len(flat)  # ids stand behind the expansions
    first[own] = np.cumsum(size[own]) - size[own]
    n = size[seq]
    from_ = np.repeat(first[seq] - (np.cumsum(n) - n), n)
    from_ += np.arange(len(from_))
    out = np.concatenate([flat, np.arange(base, dtype=np.uint32)])[from_]
    return out[start - int(upto[a]):stop - int(upto[a])]


def _by_levels(symbols: np.ndarray, base: int, rules: np.ndarray) -> np.ndarray:
    """The ids that symbols expand to, one level of rules at a time."""
    out = symbols
    while (rule := out >= base).any():
        at = np.cumsum(1 + rule) - (1 + rule)
        wider = np.empty(len(out) + int(rule.sum()), np.int64)
        pair = rules[out[rule] - base]
        wider[at[~rule]] = out[~rule]
        wider[at[rule]], wider[at[rule] + 1] = pair[:, 0], pair[:, 1]
        out = wider
    return out.astype(np.uint32)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int,
          shard_tokens: int = 1 << 19) -> None:
    """Encode ``docs`` (doc_id, text) and write the compressed file at ``path``."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(tokenizer)
        part, shard, start = TaskContext.get().partitionId(), 0, 0
        held: list[np.ndarray] = []
        ids_of: list[int | None] = []
        n_of: list[int] = []

        def close() -> pa.RecordBatch:
            nonlocal shard, start
            ids = np.concatenate(held)
            row = pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int64()),
                 "start": pa.array([start], pa.int64()),
                 "n_tokens": pa.array([len(ids)], pa.int64()),
                 "doc_ids": pa.array([ids_of], pa.list_(pa.int64())),
                 "doc_tokens": pa.array([n_of], pa.list_(pa.int64())),
                 "payload": pa.array([compress(ids)], pa.binary())})
            shard, start = shard + 1, start + len(ids)
            held.clear(), ids_of.clear(), n_of.clear()
            return row

        size = 0
        for batch in batches:
            for a, b in tokens.slices(batch.column(1), 5_000_000):  # fewer look-ups than by small slices
                texts, doc_ids = batch.column(1).slice(a, b - a), batch.column(0).slice(a, b - a)
                ids, n = enc.encode(texts)
                upto = np.concatenate([[0], np.cumsum(n)])
                for c, d in tokens.slices(texts, min(3_000_000, 6 * shard_tokens)):
                    # the end id after each document
                    held.append(np.insert(ids[upto[c]:upto[d]], upto[c + 1:d + 1] - upto[c], end_id))
                    ids_of.extend(doc_ids.slice(c, d - c).to_pylist())
                    n_of.extend((n[c:d] + 1).tolist())
                    size += len(held[-1])
                    if size >= shard_tokens:
                        yield close()
                        size = 0
        if n_of:
            yield close()

    (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                 F.coalesce("text", F.lit("")).alias("text"))
     .repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
     .mapInArrow(shards, FILE).write.parquet(path))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``first``, the position of each one in the whole corpus."""
    files = spark.read.schema(FILE).parquet(path)
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per part, that is, per task of the write: a bounded table
    parts = (files.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
             .select(F.col("part").alias("_part"),
                     F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_first")))
    return (files.join(F.broadcast(parts), F.col("part") == F.col("_part"))
            .withColumn("first", F.col("_first") + F.col("start")).drop("_part", "_first"))


def documents(shards: DataFrame, with_ids: bool = False) -> DataFrame:
    """Decode every document: doc_id, start, n_tokens, ids_crc32 (and ids)."""
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, doc_ids, n, payload in zip(*(batch.column(i) for i in range(4))):
                ids = expand(payload.as_py()).astype("<u4")
                n = np.array(n.as_py(), np.int64)
                ends = np.cumsum(n)
                raw = memoryview(ids).cast("B")
                crcs = [zlib.crc32(raw[4 * (e - k):4 * e]) for e, k in zip(ends.tolist(), n.tolist())]
                out = [doc_ids.values, pa.array(first.as_py() + ends - n, pa.int64()),
                       pa.array(n, pa.int64()), pa.array(crcs, pa.int64())]
                if with_ids:
                    out.append(pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids, pa.uint32()).cast(pa.int64())))
                yield pa.record_batch(out, names=[*names, *["ids"] * with_ids])

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return shards.select("first", "doc_ids", "doc_tokens", "payload").mapInArrow(decode, schema)


def tokens_at(shards: DataFrame, start: int, count: int) -> list[int]:
    """Random access: ``count`` ids from ``start`` on.  Only the shards that
    hold them are read, and only the covering symbols are expanded."""
    rows = (shards.where((F.col("first") < start + count)
                         & (F.col("first") + F.col("n_tokens") > start))
            .select("first", "payload").orderBy("first").collect())  # bounded by count
    out: list[int] = []
    for r in rows:
        at = max(0, start - r["first"])
        out += expand(bytes(r["payload"]), at, start + count - r["first"] - at).tolist()
    return out

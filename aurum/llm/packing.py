"""Packing token sequences by shortest-pack-first over the length histogram.

1. Each document's ids (its end id included) are cut into full pieces of
   ``max_len`` and one rest.  A piece is one row: no ids move after that.
2. The histogram of piece lengths (at most ``max_len`` numbers) decides the
   packs on the driver: lengths go longest first, each into the emptiest open
   packs that still have room, whole groups of equal packs at a time.  The
   work follows ``max_len``, not the corpus.
3. A pattern is a list of lengths with a number of packs.  Pieces of a length
   are numbered (split by buckets, see ``common.ranked``), and each pattern
   takes a range of numbers, so a piece finds its pack by a join on its length
   and its number against the bounded table of ranges.
4. With a ``place`` column (a whole number from 0 that orders the documents, as
   the mixture's), pieces of a length are numbered in that order, so the packs
   of a pattern take them in it, and sequence ids follow the smallest (place,
   start) in each sequence.  Buckets are then ranges of places.

Nulls and empty texts give the end id alone.  Repeated rows are packed one by
one.  A null ``doc_id`` is carried along.  An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tokens
from .common import ranked, stage

BUCKETS = 256


def plan_packs(histogram: dict[int, int], max_len: int) -> list[tuple[list[int], int]]:
    """[(lengths of a pack, number of such packs)] by shortest-pack-first."""
    room: dict[int, list[list]] = defaultdict(list)  # free places -> [[lengths, packs], ...]
    for length in sorted((n for n in histogram if histogram[n]), reverse=True):
        left = histogram[length]
        grown: list[tuple[int, list]] = []
        for free in range(max_len, length - 1, -1):
            while left and room.get(free):
                lengths, packs = room[free].pop()
                used = min(left, packs)
                if used < packs:
                    room[free].append([lengths, packs - used])
                grown.append((free - length, [[*lengths, length], used]))
                left -= used
            if not left:
                break
        # a pack may take the same length again as long as it has room
        while grown and left:
            free, (lengths, packs) = grown.pop(0)
            if free < length:
                room[free].append([lengths, packs])
                continue
            used = min(left, packs)
            if used < packs:
                room[free].append([lengths, packs - used])
            grown.append((free - length, [[*lengths, length], used]))
            left -= used
        for free, pack in grown:
            room[free].append(pack)
        if left:
            each = max_len // length
            if left // each:
                room[max_len - each * length].append([[length] * each, left // each])
            if left % each:
                room[max_len - left % each * length].append([[length] * (left % each), 1])
    return [(lengths, packs) for free in sorted(room) for lengths, packs in room[free]]


def _ranges(packs: list[tuple[list[int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first number, end number, first sequence, pieces per pack, offset)."""
    taken: dict[int, int] = defaultdict(int)
    out, sequence = [], 0
    for lengths, n in packs:
        offset = 0
        for length in sorted(set(lengths), reverse=True):
            per = lengths.count(length)
            out.append((length, taken[length], taken[length] + n * per, sequence, per, offset))
            taken[length] += n * per
            offset += per * length
        sequence += n
    return out


PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    T.StructField("doc_tokens", T.LongType())])


def pieces(docs: DataFrame, tokenizer: str, max_len: int, end_id: int, place: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, and _place
    if ``place`` names the column of the documents' places."""
    schema = T.StructType([*PIECES, T.StructField("_place", T.LongType())]) if place else PIECES

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(tokenizer)
        for batch in batches:
            for a, b in tokens.slices(batch.column(1)):
                ids, n = enc.encode(batch.column(1).slice(a, b - a))
                ids = ids.astype("<u4")
                rows, starts, lengths, crcs, totals = [], [], [], [], []
                at = 0
                for row, k in enumerate(n.tolist()):
                    own = memoryview(np.append(ids[at:at + k], np.uint32(end_id))).cast("B")
                    at += k
                    for s in range(0, k + 1, max_len):
                        e = min(s + max_len, k + 1)
                        rows.append(a + row)
                        starts.append(s)
                        lengths.append(e - s)
                        crcs.append(zlib.crc32(own[4 * s:4 * e]))
                        totals.append(k + 1)
                at_rows = pa.array(rows, pa.int64())
                yield pa.record_batch([batch.column(0).take(at_rows),
                                       *(pa.array(x, pa.int64()) for x in (starts, lengths, crcs, totals)),
                                       *(c.take(at_rows) for c in batch.columns[2:])],
                                      names=schema.names)

    places = [F.coalesce(F.col(place).cast("long"), F.lit(0).cast("long")).alias("_place")] if place else []
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), *places).mapInArrow(cut, schema)


def _range(place: Column, most: int) -> Column:
    """The bucket of a place: one of ``BUCKETS`` ranges up to the largest place."""
    return F.floor(place / F.lit(most // BUCKETS + 1)).cast("long")


def pack(docs: DataFrame, tokenizer: str, max_len: int = 1024, end_id: int = 0,
         place: str | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.  The pieces of a sequence fill it from offset 0 without
    gaps; what is left up to ``max_len`` is padding.  ``place`` names a column of
    ``docs`` whose order pieces and sequences follow."""
    spark = docs.sparkSession
    cut = stage(pieces(docs, tokenizer, max_len, end_id, place), "pieces")
    most = F.max("_place") if place else F.lit(0)
    found = cut.groupBy("length").agg(F.count(F.lit(1)).alias("n"), most.alias("most")).collect()  # max_len rows at most
    histogram = {r["length"]: r["n"] for r in found}
    most = max((r["most"] for r in found), default=0)
    ranges = spark.createDataFrame(
        _ranges(plan_packs(histogram, max_len)),
        "_length long, _from long, _to long, _sequence long, _per long, _offset long")
    order = [F.col(c) for c in ("doc_id", "start", "ids_crc32", "doc_tokens")]
    bucket = F.pmod(F.xxhash64("doc_id", "start"), F.lit(BUCKETS))
    if place:
        order, bucket = [F.col("_place"), F.col("start"), *order], _range(F.col("_place"), most)
    numbered = ranked(cut, F.col("length"), bucket, order)
    within = F.col("rank") - F.col("_from")
    # the ranges follow max_len (a few thousand rows), so each task gets them whole
    packed = (numbered.join(F.broadcast(ranges), (F.col("length") == F.col("_length"))
                            & (F.col("rank") >= F.col("_from")) & (F.col("rank") < F.col("_to")))
              .select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                      (F.col("_sequence") + F.expr("(rank - _from) div _per")).alias("sequence_id"),
                      (F.col("_offset") + within % F.col("_per") * F.col("length")).alias("offset"),
                      *(["_place"] if place else [])))
    return _in_order(stage(packed, "packed"), most) if place else packed


def _in_order(packed: DataFrame, most: int) -> DataFrame:
    """Number the sequences by the smallest (place, start) of their pieces."""
    first = packed.groupBy(F.col("sequence_id").alias("_own")).agg(
        F.min(F.struct("_place", "start")).alias("_least"))
    numbers = ranked(first, F.lit(0), _range(F.col("_least._place"), most),
                     [F.col("_least"), F.col("_own")], "_number")
    return (packed.join(numbers, F.col("sequence_id") == F.col("_own"))
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                    F.col("_number").alias("sequence_id"), "offset"))

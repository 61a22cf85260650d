"""Counting helpers of the word-based operators: words of Arrow batches, and
bit filters of a fixed size."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import slices

SLICE_BITS = 20

#: A-Z to lower case, the marks that end a piece to \n, tab to space.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[65:91] += 32
_PLAIN[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = 10
_PLAIN[9] = 32


class Pieces:
    """The words of a batch of texts, in order.

    ``words[own[i]]`` is the i-th word and ``langs[own[i]]`` its language;
    ``tied[i]`` says that word i + 1 follows it in the same piece.
    """

    def __init__(self, langs: pa.Array, texts: pa.Array) -> None:
        texts = pc.fill_null(texts, "")
        at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
        data = texts.buffers()[2]
        plain = _PLAIN[np.frombuffer(data, np.uint8)[at[0]:at[-1]]] if data is not None else np.zeros(0, np.uint8)
        at = at - at[0]
        flat = pa.StringArray.from_buffers(len(texts), pa.py_buffer(at), pa.py_buffer(plain.tobytes()))
        words = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(flat)).flatten()
        words = words.filter(pc.greater(pc.binary_length(words), 0))
        blank = (plain == 32) | (plain == 10)
        opens = ~blank
        opens[1:] &= blank[:-1]
        if len(plain):
            edges = at[:-1][at[:-1] < len(plain)]
            opens[edges] |= ~blank[edges]
        start = np.flatnonzero(opens)
        doc = np.searchsorted(at, start, "right") - 1
        piece = np.cumsum(plain == 10)[start] if len(start) else start
        self.tied = (piece[1:] == piece[:-1]) & (doc[1:] == doc[:-1])
        spoken = pc.fill_null(langs, "und").dictionary_encode()
        lang = spoken.indices.to_numpy()[doc].astype(np.int64)
        coded = words.dictionary_encode()
        both = lang * max(1, len(coded.dictionary)) + coded.indices.to_numpy()
        distinct, self.own, self.count = np.unique(both, return_inverse=True, return_counts=True)
        self.words = coded.dictionary.take(pa.array(distinct % max(1, len(coded.dictionary))))
        self.langs = spoken.dictionary.take(pa.array(distinct // max(1, len(coded.dictionary))))

    def hashes(self, seed: int) -> np.ndarray:
        """As ``word_hash`` of each distinct (language, word)."""
        h = xxhash.xxh64_intdigest
        first = h(str(seed), 42)
        own = {lang: h(lang, first) for lang in self.langs.unique().to_pylist()}
        return np.fromiter((h(w, own[x]) for w, x in zip(self.words.to_pylist(), self.langs.to_pylist())),
                           np.uint64, len(self.words))


def word_hash(seed: int):
    """The hash of ``Pieces.hashes`` as a column of (lang, word)."""
    return F.xxhash64(F.lit(str(seed)), F.col("lang"), F.col("word"))


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[Pieces]:
    """Words of (lang, text) batches, a few megabytes of text at a time."""
    for batch in batches:
        for a, b in slices(batch.column(1)):
            part = batch.slice(a, b - a)
            yield Pieces(part.column(0), part.column(1))


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, f): occurrences of every word by language, combined in each
    batch, in each task and after one shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in pieces(batches):
            yield pa.record_batch([p.langs, p.words, pa.array(p.count.astype(np.int64))], names=["lang", "word", "f"])

    return (docs.select("lang", "text").mapInArrow(run, "lang string, word string, f long")
            .groupBy("lang", "word").agg(F.sum("f").alias("f")))


def mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A 64-bit hash of pairs of 64-bit hashes."""
    x = first * np.uint64(0x9E3779B97F4A7C15) + second
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class BitFilter:
    """A set of 64-bit hashes as a bit array of a fixed size, given to every task.
    Hashes that are not in the set may be reported; none of the set is missed."""

    def __init__(self, keys: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], bits: int) -> None:
        self.bits = bits

        def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.record_batch([pa.array((hashes(batch) >> np.uint64(64 - bits)).astype(np.int64))], names=["at"])

        def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: dict[int, np.ndarray] = {}
            for batch in batches:
                at = batch.column(0).to_numpy()
                own = at >> SLICE_BITS
                for k in np.unique(own).tolist():
                    part = found.setdefault(k, np.zeros(1 << SLICE_BITS, bool))
                    part[at[own == k] & ((1 << SLICE_BITS) - 1)] = True
            for k, part in found.items():
                yield pa.record_batch([pa.array([k]), pa.array([zlib.compress(np.packbits(part).tobytes(), 1)])],
                                      names=["k", "bits"])

        size = 1 << SLICE_BITS - 3
        whole = np.zeros(1 << bits - 3, np.uint8)
        for r in (keys.mapInArrow(places, "at long").repartition(F.shiftright("at", SLICE_BITS))
                  .mapInArrow(parts, "k long, bits binary").collect()):  # the filter's fixed size at most
            whole[r["k"] * size:(r["k"] + 1) * size] = np.frombuffer(zlib.decompress(r["bits"]), np.uint8)
        self.whole: Broadcast = keys.sparkSession.sparkContext.broadcast(whole)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> np.uint64(64 - self.bits)
        return (self.whole.value[at >> np.uint64(3)] >> (7 - (at & np.uint64(7))).astype(np.uint8) & 1).astype(bool)

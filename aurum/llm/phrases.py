"""Repeated passages by phrase automata.

A window is ``WINDOW`` consecutive words.  A word goes if a window over it also
starts in a document with a smaller id.

1. Confirm.  Each window has one anchor, the phrase of ``ANCHOR`` words in it
   with the smallest hash, so equal windows have equal anchors and neighbouring
   windows mostly share one.  The documents of each anchor are counted over the
   corpus; anchors of two or more set a bit in a filter of fixed size (``FILTER_BITS``), which
   every task gets.  A bit set by chance costs time later, never a result.
2. Deal.  The stretches of words over windows with a recurring anchor go to
   shards by anchor: all occurrences of a window meet in one shard, and the
   number of shards grows with the input.
3. Compile and stream.  A shard takes its anchors in chunks of whole anchors.
   The passages that several documents have, and the windows that different
   passages share, are compiled to an Aho-Corasick automaton whose hits give
   the smallest document; then the stretches of all documents stream through it.  A word is written in the automaton as a few
   digits of base 64, so that no node has many children.  Matching is on the
   words themselves, so hashes decide nothing.
4. Anchors with over ``HOT`` stretches (a licence line in a third of all
   documents) meet in no single shard.  Their recurring windows are found by a
   combined count first, dealt to automata of about ``HOT`` windows by a second
   hash, and each automaton is given to as many tasks as its stretches need.
5. The hits, as ranges of words, go back to their documents.

A task's memory is bounded by ``CHUNK`` + ``HOT`` stretches and by the longest
text, however many documents share a passage.  The driver and each worker hold
the filters, 34 MB whatever the input.

Null texts have no words; texts shorter than a window lose none;
a very long text is one document like any other and leaves a task only as its
recurring stretches.  Documents
that share a ``doc_id`` do not remove each other's words, and keep their own
rows.  A null ``doc_id`` counts as larger than any other.  An empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage
from .tokens import slices

WINDOW = 13
ANCHOR = 6
FILTER_BITS = 28
SLICE_BITS = 20
#: The filter of hot anchors has fewer bits; a bit set by chance costs time only.
HOT_BITS = FILTER_BITS - 4
#: Stretches that a shard compiles at a time.
CHUNK = 20_000
#: Stretches of one anchor that one task may hold.
HOT = 50_000
#: Stands for a missing document id, which is larger than any other.
LAST = (1 << 63) - 1
#: Digits of the words' numbers in an automaton; each place has its own letters,
#: so a hit can only begin and end with a word.
BASE = 64


class Words:
    """The words of a batch of texts, and its stretches of windows by anchor."""

    def __init__(self, texts: pa.Array) -> None:
        flat = pc.ascii_trim_whitespace(pc.fill_null(texts, ""))
        lists = pc.ascii_split_whitespace(flat)
        self.n = np.diff(lists.offsets.to_numpy())
        words = lists.flatten()
        if (empty := pc.equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)).any():
            self.n[empty] = 0
            words = words.filter(pc.greater(pc.binary_length(words), 0))
        self.first = np.cumsum(self.n) - self.n
        d = words.dictionary_encode()
        self.code = d.indices.to_numpy()
        self.word = d.dictionary.to_numpy(zero_copy_only=False)

    def stretches(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first window, number of windows, anchor's hash) per stretch; the
        first window as its first word's position in the batch."""
        total = len(self.code)
        if total < WINDOW:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        h = xxhash.xxh64_intdigest
        w = np.fromiter(map(h, self.word), np.uint64, len(self.word))[self.code]
        odd, g = np.uint64(0x9E3779B97F4A7C15), w[:total - ANCHOR + 1].copy()
        for j in range(1, ANCHOR):
            g = g * odd + w[j:total - ANCHOR + 1 + j]
        g = (g ^ (g >> np.uint64(33))) * np.uint64(0xC2B2AE3D27D4EB4F)
        g ^= g >> np.uint64(29)
        # where the smallest hash of each window's phrases stands, leftmost first
        at, width, most = np.arange(len(g)), 1, WINDOW - ANCHOR + 1
        while width < most:
            step = min(width, most - width)
            a, b = at[:-step], at[step:]
            at = np.where(g[a] <= g[b], a, b)
            width += step
        doc = np.repeat(np.arange(len(self.n)), self.n)
        start = np.flatnonzero(doc[:total - WINDOW + 1] == doc[WINDOW - 1:])
        own = at[start]
        head = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else own
        return start[head], np.diff(np.append(head, len(own))), g[own[head]]


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b in slices(batch.column(batch.num_columns - 1)):
            yield batch.slice(a, b - a)


def recurring(docs: DataFrame) -> tuple[Broadcast, Broadcast | None, int]:
    """The filters of anchors that occur in several documents, and of those with
    over ``HOT`` stretches (None if there are none), as bit arrays, and the
    number of the latter's stretches."""

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _each(batches):
            words = Words(batch.column(0))
            start, _, h = words.stretches()
            # once per document, so that the count is that of documents
            row = np.searchsorted(words.first + words.n, start, "right")
            order = np.lexsort((h, row))
            h, row = h[order], row[order]
            head = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])])
                                  if len(h) else row)
            yield pa.record_batch([pa.array(h[head].view(np.int64)),
                                   pa.array(np.diff(np.append(head, len(h))).astype(np.int32))], names=["h", "m"])

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        total: dict[int, int] = {}
        for batch in batches:
            at, m = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            hot = m > HOT
            own, place = at >> SLICE_BITS, at & ((1 << SLICE_BITS) - 1)
            for k in np.unique(own).tolist():
                often, much = found.setdefault(k, (np.zeros(1 << SLICE_BITS, bool),
                                                   np.zeros(1 << SLICE_BITS - FILTER_BITS + HOT_BITS, bool)))
                often[place[own == k]] = True
                much[place[(own == k) & hot] >> FILTER_BITS - HOT_BITS] = True
                total[k] = total.get(k, 0) + int(m[(own == k) & hot].sum())
        for k, (often, much) in found.items():
            yield pa.record_batch(
                [pa.array([k]), pa.array([zlib.compress(np.packbits(often).tobytes(), 1)]),
                 pa.array([zlib.compress(np.packbits(much).tobytes(), 1) if total[k] else None], pa.binary()),
                 pa.array([total[k]], pa.int64())],
                names=["k", "often", "hot", "rows"])

    often = (docs.select("text").mapInArrow(anchors, "h long, m int")
             .groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.sum("m").alias("m")).where("n > 1")
             .select(F.shiftrightunsigned("h", 64 - FILTER_BITS).alias("at"), "m"))
    parts = (often.repartition(F.shiftright("at", SLICE_BITS))
             .mapInArrow(bits, "k long, often binary, hot binary, rows long").collect())  # the filters' fixed size at most

    def whole(name: str, total: int) -> Broadcast:
        size = 1 << SLICE_BITS - FILTER_BITS + total - 3
        out = np.zeros(1 << total - 3, np.uint8)
        for r in parts:
            if r[name] is not None:
                out[r["k"] * size:(r["k"] + 1) * size] = np.frombuffer(zlib.decompress(r[name]), np.uint8)
        return docs.sparkSession.sparkContext.broadcast(out)

    rows = sum(r["rows"] for r in parts)
    return whole("often", FILTER_BITS), whole("hot", HOT_BITS) if rows else None, rows


def _set(filter: Broadcast, at: np.ndarray) -> np.ndarray:
    return (filter.value[at >> np.uint64(3)] >> (7 - (at & np.uint64(7))).astype(np.uint8) & 1).astype(bool)


def _second(window: str) -> int:
    """The second hash of a window, which deals it to a hot shard."""
    return xxhash.xxh64_intdigest(window, 1)


def hot_phrases(docs: DataFrame, hot: Broadcast) -> DataFrame:
    """(passage, doc_id, n, w): the windows of hot anchors that several documents
    have, their smallest document, their occurrences and their second hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _each(batches):
            words = Words(batch.column(1))
            start, n, h = words.stretches()
            hit = _set(hot, h >> np.uint64(64 - HOT_BITS))
            start, n = start[hit], n[hit]
            text = words.word[words.code] if len(start) else None
            ids = batch.column(0).to_pylist()
            found: dict[str, list[int]] = {}
            for r, a, k in zip(np.searchsorted(words.first + words.n, start, "right").tolist(),
                               start.tolist(), n.tolist()):
                doc = LAST if ids[r] is None else ids[r]
                for i in range(a, a + k):
                    own = found.setdefault(" ".join(text[i:i + WINDOW]), [doc, doc, 0])
                    own[:] = min(own[0], doc), max(own[1], doc), own[2] + 1
            yield pa.record_batch([pa.array(found, pa.string()),
                                   *(pa.array((v[i] for v in found.values()), pa.int64()) for i in range(3))],
                                  names=["passage", "least", "most", "n"])

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = np.fromiter(map(_second, batch.column(0).to_pylist()), np.uint64, batch.num_rows)
            yield pa.record_batch([*batch.columns, pa.array(w.view(np.int64))], names=["passage", "doc_id", "n", "w"])

    return (_keyed(docs).select("doc_id", "text").mapInArrow(run, "passage string, least long, most long, n long")
            .groupBy("passage").agg(F.min("least").alias("doc_id"), F.max("most").alias("most"),
                                    F.sum("n").alias("n"))
            .where("doc_id < most").drop("most")
            .mapInArrow(second, "passage string, doc_id long, n long, w long"))


def _deal(shard: int, share: int) -> int:
    return xxhash.xxh64_intdigest(shard.to_bytes(8, "little") + share.to_bytes(8, "little"), 2) - (1 << 63)


DEALT = "h long, kind int, doc_id long, key long, places string, passage string"


def dealt(docs: DataFrame, often: Broadcast, hot: Broadcast | None = None, shares: list[int] = ()) -> DataFrame:
    """(h, kind, doc_id, key, places, passage): the stretches with a recurring
    anchor, and the numbers of the words at which a document has each,
    comma-joined.  Kind 0 is dealt by anchor.  Stretches of hot anchors (kind 2)
    go to the shards of their windows, in each to one of its ``shares``."""

    def shards(passage: str) -> list[int]:
        if len(shares) == 1:
            return [0]
        w = passage.split(" ")
        return sorted({_second(" ".join(w[i:i + WINDOW])) % len(shares) for i in range(len(w) - WINDOW + 1)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _each(batches):
            words = Words(batch.column(2))
            start, n, h = words.stretches()
            hit = _set(often, h >> np.uint64(64 - FILTER_BITS))
            start, n, h = start[hit], n[hit], h[hit]
            much = np.zeros(len(h), bool) if hot is None else _set(hot, h >> np.uint64(64 - HOT_BITS))
            text = words.word[words.code] if len(start) else None
            row = np.searchsorted(words.first + words.n, start, "right")
            # a stretch that a document repeats is one row with several places
            places: dict[tuple[int, str], str] = {}
            kept: list[int] = []
            for i, (r, p, a, b) in enumerate(zip(row.tolist(), (start - words.first[row]).tolist(),
                                                 start.tolist(), (start + n + WINDOW - 1).tolist())):
                own = (r, " ".join(text[a:b]))
                if own in places:
                    places[own] += f",{p}"
                else:
                    places[own] = str(p)
                    kept.append(i)
            rows, h, much = row[kept], h.view(np.int64)[kept], much[kept]
            at, passages = pa.array(places.values(), pa.string()), pa.array((t for _, t in places), pa.string())
            kind = np.zeros(len(rows), np.int32)
            if much.any():
                own = list(places)
                copies = [(i, _deal(s, (r * 0x9E3779B1 + s) % shares[s]))
                          for i in np.flatnonzero(much).tolist()
                          for r in [xxhash.xxh32_intdigest(f"{batch.column(0)[int(rows[i])]} {places[own[i]]}")]
                          for s in shards(passages[i].as_py())]
                cold = np.flatnonzero(~much)
                take = np.concatenate([cold, np.array([i for i, _ in copies], np.int64)])
                h = np.concatenate([h[cold], np.array([d for _, d in copies], np.int64)])
                kind = np.concatenate([kind[cold], np.full(len(copies), 2, np.int32)])
                rows, at, passages = rows[take], at.take(pa.array(take)), passages.take(pa.array(take))
            rows = pa.array(rows)
            yield pa.record_batch([pa.array(h), pa.array(kind), batch.column(0).take(rows),
                                   batch.column(1).take(rows), at, passages],
                                  names=["h", "kind", "doc_id", "key", "places", "passage"])

    return _keyed(docs).mapInArrow(run, DEALT)


def hot_shards(phrases: DataFrame, stretches: int) -> list[int]:
    """How many tasks each hot shard is given to: shards of about ``HOT`` windows,
    as many shares as the stretches with its windows need.  Windows that do not
    recur lead their stretches to all shards alike."""
    count = max(1, -(-phrases.count() // HOT))
    others = stretches * min(count, WINDOW - ANCHOR + 1) // count
    shard = F.expr(f"CAST((CAST(w AS DECIMAL(20,0)) + IF(w < 0, 18446744073709551616BD, 0BD)) % {count}BD AS LONG)")
    rows = {r["s"]: r["rows"] for r in phrases.groupBy(shard.alias("s")).agg(F.sum("n").alias("rows")).collect()}
    return [1 + ((rows.get(s, 0) if count > 1 else 0) + others) // HOT for s in range(count)]


def hot_dealt(phrases: DataFrame, shares: list[int]) -> DataFrame:
    """The windows of hot anchors (kind 1), to every share of their shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard = (batch.column(3).to_numpy().view(np.uint64) % np.uint64(len(shares))).astype(np.int64)
            for a in range(0, batch.num_rows, 1000):
                own = shard[a:a + 1000].tolist()
                at = pa.array([a + i for i, s in enumerate(own) for _ in range(shares[s])], pa.int64())
                yield pa.record_batch(
                    [pa.array([_deal(s, k) for s in own for k in range(shares[s])], pa.int64()),
                     pa.array(np.ones(len(at), np.int32)), batch.column(1).take(at), pa.nulls(len(at), pa.int64()),
                     pa.nulls(len(at), pa.string()), batch.column(0).take(at)],
                    names=["h", "kind", "doc_id", "key", "places", "passage"])

    return phrases.mapInArrow(run, DEALT)


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, key (tells rows with one doc_id apart by their text), text."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(text).alias("key"), text.alias("text"))


class Automaton:
    """Finds windows in passages.  A word is its number's digits, each place of
    the number with letters of its own, so the nodes stay small."""

    def __init__(self, windows: Iterator[tuple[str, int]]) -> None:
        self.code: dict[str, str] = {}
        self.found = ahocorasick.Automaton()
        for window, first in windows:
            self.found.add_word("".join([self.code.get(w) or self._new(w) for w in window.split(" ")]), first)
        if self.code:
            self.found.make_automaton()

    def _new(self, word: str) -> str:
        n = len(self.code)
        own = self.code[word] = "".join(chr(33 + BASE * k + n // BASE ** k % BASE) for k in range(4))
        return own

    def spans(self, passage: str, doc: int) -> list[tuple[int, int]]:
        """Ranges of the passage's words under windows that a smaller document has."""
        out: list[tuple[int, int]] = []
        if self.code:
            # words that are in no window cannot be in a hit
            seq = "".join([self.code.get(w, "    ") for w in passage.split(" ")])
            for end, first in self.found.iter(seq):
                if first < doc:
                    b = (end + 1) // 4
                    if out and b - WINDOW <= out[-1][1]:
                        out[-1] = (out[-1][0], b)
                    else:
                        out.append((b - WINDOW, b))
        return out


def _order(rows: pa.Table) -> np.ndarray:
    return pc.fill_null(rows["doc_id"], LAST).to_numpy()


def _spans(rows: pa.Table, found: Iterator[tuple[int, list[tuple[int, int]]]]) -> pa.RecordBatch:
    """The ranges found in passages as ranges of their documents."""
    places = rows["places"].to_pylist()
    out = [(i, int(p) + a, int(p) + b) for i, ranges in found for p in places[i].split(",") for a, b in ranges]
    at = pa.array([i for i, _, _ in out], pa.int64())
    return pa.record_batch(
        [rows["doc_id"].combine_chunks().take(at), rows["key"].combine_chunks().take(at),
         pa.array([s for _, s, _ in out], pa.int64()), pa.array([e for _, _, e in out], pa.int64())],
        names=["doc_id", "key", "a", "b"])


def _in_digits(passages: pa.Array) -> tuple[list[str], int]:
    """Passages with each word as so many letters, numbers of words in digits."""
    lists = pc.split_pattern(passages, " ")
    words = lists.flatten().dictionary_encode()
    width, base = (3, BASE) if len(words.dictionary) <= BASE ** 3 else (4, 55)  # all below 256
    n, at = words.indices.to_numpy(), lists.offsets.to_numpy() * width
    digits = np.empty((len(n), width), np.uint8)
    for k in range(width):
        digits[:, k] = 33 + base * k + n // base ** k % base
    text = digits.tobytes().decode("latin-1")
    return [text[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())], width


def _mixed(group: list[tuple[str, int]], size: int, phrases: dict[str, int]) -> None:
    """Phrases of an anchor with different passages, (passage, document) in
    ascending order of documents: passages that several documents have as they
    are, and windows that several passages have."""
    first: dict[str, int] = {}
    window_of: dict[str, tuple[str, int]] = {}
    for passage, doc in group:
        if passage in first:
            if first[passage] != doc:
                phrases.setdefault(passage, first[passage])
            continue
        first[passage] = doc
        for k in range(0, len(passage) - WINDOW * size + size, size):
            window = passage[k:k + WINDOW * size]
            own, least = window_of.setdefault(window, (passage, doc))
            if own != passage:
                phrases[window] = min(phrases.get(window, least), least)


def _by_anchor(rows: pa.Table) -> pa.RecordBatch:
    """Whole anchors, sorted by (h, doc_id): recurring passages are compiled, and
    all passages stream through.  A hit says that a document has those words;
    every window that a smaller document has lies in such a hit."""
    h, doc = rows["h"].to_numpy(), _order(rows)
    coded = rows["passage"].combine_chunks().dictionary_encode()
    code = coded.indices.to_numpy()
    head = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    end = np.append(head[1:], len(h))
    recurs = doc[head] != doc[end - 1]  # in one document, nothing recurs across documents
    alike = np.minimum.reduceat(code, head) == np.maximum.reduceat(code, head)
    which = np.flatnonzero(np.repeat(recurs, end - head))
    used, own = np.unique(code[which], return_inverse=True)
    texts, size = _in_digits(coded.dictionary.take(pa.array(used)))
    at = np.zeros(len(code), np.int64)
    at[which] = own
    phrases = {texts[i]: d for i, d in zip(at[head[recurs & alike]].tolist(), doc[head[recurs & alike]].tolist())}
    for a, b in zip(head[recurs & ~alike].tolist(), end[recurs & ~alike].tolist()):
        _mixed([(texts[i], d) for i, d in zip(at[a:b].tolist(), doc[a:b].tolist())], size, phrases)
    automaton = ahocorasick.Automaton()
    for phrase, first in phrases.items():
        automaton.add_word(phrase, (first, len(phrase) // size))
    if phrases:
        automaton.make_automaton()
    hits = [[((e + 1) // size - n, (e + 1) // size, first) for e, (first, n) in automaton.iter(t)] if phrases else []
            for t in texts]

    def found() -> Iterator[tuple[int, list[tuple[int, int]]]]:
        for i, k, d in zip(which.tolist(), own.tolist(), doc[which].tolist()):
            if ranges := [(a, b) for a, b, first in hits[k] if first < d]:
                yield i, ranges

    return _spans(rows, found())


def occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, key, a, b): ranges of words that go, per stretch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # stretches of whole anchors, and of one that may go on
        n = 0
        deal, windows, automaton = None, [], None  # of the hot share at hand
        for batch in batches:
            kind, h = batch.column(1).to_numpy(), batch.column(0).to_numpy()
            # runs of one kind and, for hot shares, of one share
            cut = np.flatnonzero((kind[1:] != kind[:-1]) | (h[1:] != h[:-1]) & (kind[1:] > 0)) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(kind)]):
                part = batch.slice(a, b - a)
                if kind[a] == 0:
                    held.append(part)
                    n += b - a
                    while n >= CHUNK:
                        rows = pa.Table.from_batches(held)
                        own = rows["h"].to_numpy()
                        # up to the last anchor, which may go on (it has few rows: it is not hot)
                        end = int(np.argmax(own == own[-1]))
                        if not end:
                            break
                        yield _by_anchor(rows.slice(0, end))
                        held, n = rows.slice(end).to_batches(), n - end
                    continue
                if h[a] != deal:
                    deal, windows, automaton = h[a], [], None
                if kind[a] == 1:
                    windows += zip(part.column(5).to_pylist(), part.column(2).to_pylist())
                else:
                    if automaton is None:
                        automaton, windows = Automaton(windows), []
                    rows = pa.Table.from_batches([part])
                    yield _spans(rows, ((i, automaton.spans(p, d)) for i, (p, d) in enumerate(
                        zip(part.column(5).to_pylist(), _order(rows).tolist()))))
        if n:
            yield _by_anchor(pa.Table.from_batches(held))

    often, hot, stretches = recurring(docs)
    if hot is None:
        rows = dealt(docs, often)
    else:
        phrases = stage(hot_phrases(docs, hot), "hot-phrases")
        shares = hot_shards(phrases, stretches)
        rows = dealt(docs, often, hot, shares).unionByName(hot_dealt(phrases, shares))
    return (rows.repartition("h")
            .sortWithinPartitions(F.col("kind") > 0, F.col("h"), F.col("kind"), F.col("doc_id").asc_nulls_last())
            .mapInArrow(run, "doc_id long, key long, a long, b long"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and the kept text) per row."""
    # what goes from a document is bounded by its own words
    ranges = occurrences(docs).groupBy(F.col("doc_id").alias("_doc_id"), F.col("key").alias("_key")).agg(
        F.collect_list("a").alias("a"), F.collect_list("b").alias("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, removed, sha, kept = [], [], [], []
            for text, a, b in zip(batch.column(1), batch.column(2), batch.column(3)):
                words = text.as_py().encode().split()  # bytes split at the six ASCII blanks
                keep = words
                if a.is_valid:
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, a.values.to_numpy(), 1)
                    np.add.at(edge, b.values.to_numpy(), -1)
                    keep = [w for w, k in zip(words, np.cumsum(edge[:-1]).tolist()) if not k]
                n.append(len(words))
                removed.append(len(words) - len(keep))
                out = b" ".join(keep)
                sha.append(hashlib.sha256(out).hexdigest())
                kept.append(out.decode())
            yield pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                                   pa.array(sha, pa.string()), pa.array(kept, pa.string())],
                                  names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    joined = _keyed(docs).join(ranges, F.col("doc_id").eqNullSafe(F.col("_doc_id"))
                               & (F.col("key") == F.col("_key")), "left")
    return joined.select("doc_id", "text", "a", "b").mapInArrow(
        run, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")

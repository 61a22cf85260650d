"""Quality by perplexity: an interpolated modified Kneser-Ney n-gram model.

This is the form with a fixed alphabet, for small models that fit in memory; the
query uses ``ngrams``, whose vocabulary is open and whose counts are joined.

The model is over characters, folded to ``SYMBOLS`` symbols, with ``ORDER``
symbols a gram, one model for each listed language and one for all others.  It
is trained on all text of documents labelled as trusted.

1. Counts.  Tasks count grams in arrays; the counts travel as shards of the gram
   numbers and are joined shard by shard, so no task sees more than its shard.
2. Model.  A language's counts are at most SYMBOLS ** ORDER numbers.  Discounts
   come from the counts of counts of each order; lower orders use continuation
   counts; every order interpolates with the one below, down to uniform.
3. Scores.  The models are at most languages x SYMBOLS ** ORDER numbers of four
   bytes, a bound that no input exceeds and that is checked, so every task gets
   them, and no text is shuffled to be scored.  A document's score is its
   perplexity per character.
4. Threshold.  Per language, ``QUANTILE`` of the perplexities of all trusted
   documents, times ``MARGIN``.  A document above it goes.

Null text counts as empty.  Documents of fewer than ``MIN_CHARS`` characters and
languages without any trusted document are kept.  A null language is one of
the others.  Rows that repeat a ``doc_id`` are scored one by one; a ``doc_id``
is trusted if any label says so, and null never is.  Without documents there
are no rows, without trusted ones all are kept.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage
from .tokens import slices

ORDER = 4
SYMBOLS = 40
GRAMS = SYMBOLS ** ORDER
SHARD = SYMBOLS ** (ORDER - 1) // 2
LANGUAGES = ("en", "de", "fr", "es")
OTHERS = "*"
MAX_BROADCAST = (len(LANGUAGES) + 1) * GRAMS * 4
QUANTILE = 0.99
MARGIN = 1.1
MIN_CHARS = 200


def _fold() -> np.ndarray:
    """Code point -> symbol: letters, eight groups of other letters, digits,
    blanks, sentence marks, brackets and quotes, other ASCII signs, the rest."""
    table = np.full(1 << 16, 39, np.uint8)
    for c in range(1 << 16):
        low = chr(c).lower()
        if len(low) == 1 and "a" <= low <= "z":
            table[c] = ord(low) - 97
        elif chr(c).isalpha():
            table[c] = 26 + ord(low[0]) % 8
        elif chr(c).isdigit():
            table[c] = 34
        elif chr(c).isspace():
            table[c] = 35
        elif chr(c) in ".,;:!?":
            table[c] = 36
        elif chr(c) in "'\"-()":
            table[c] = 37
        elif c < 128:
            table[c] = 38
    return table


_TABLE: list[np.ndarray] = []
_BLANK = 35


def symbols(text: str) -> bytes:
    """The symbols of a text, a byte for each character."""
    if not _TABLE:
        _TABLE.append(_fold())
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return _TABLE[0][np.minimum(points, 0xFFFF)].tobytes()


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``grams_of`` for texts."""
    whole, n = symbols("".join(texts)), [*map(len, texts)]
    ends = np.cumsum([0, *n]).tolist()
    return grams_of([whole[a:b] for a, b in zip(ends, ends[1:])])


def grams_of(folded: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(gram numbers of all texts, number of grams per text): one gram for each
    symbol, with blanks before the text as its first context."""
    pad = bytes([_BLANK]) * (ORDER - 1)
    symbol = np.frombuffer(pad + pad.join(folded), np.uint8).astype(np.int64)
    n = np.fromiter(map(len, folded), np.int64, len(folded))
    gram = np.zeros(len(symbol), np.int64)
    for j in range(ORDER):  # the gram that ends at each place
        gram[ORDER - 1:] = gram[ORDER - 1:] * SYMBOLS + symbol[j:len(symbol) - ORDER + 1 + j]
    first = np.cumsum(n + ORDER - 1) - n
    at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    return gram[at], n


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    for a, b in slices(batch.column(column), 2_000_000):
        yield batch.slice(a, b - a)


def trusted(docs: DataFrame, good: DataFrame) -> DataFrame:
    """(lang, folded): the symbols, packed, of the documents whose id is in ``good``.
    Documents travel as packed symbols, about half the size of their text, and
    by the same kind of join at every size."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1, write_checksum=False).compress
        for batch in batches:
            for part in _slices(batch, 2):
                yield pa.record_batch(
                    [part.column(0), part.column(1),
                     pa.array([pack(symbols(t or "")) for t in part.column(2).to_pylist()], pa.binary())],
                    names=["doc_id", "lang", "folded"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _lang().alias("lang"), "text").mapInArrow(
        fold, "doc_id long, lang string, folded binary")
    return rows.join(good.hint("merge"), "doc_id", "left_semi").select("lang", "folded")


def counts(trusted: DataFrame) -> DataFrame:
    """(lang, shard, counts): gram counts of all trusted text, by shard."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for part in _slices(batch, 1):
                gram, n = grams_of([unpack(x) for x in part.column(1).to_pylist()])
                lang = np.array(part.column(0).to_pylist(), object)
                of = np.repeat(lang, n)
                for own in set(lang.tolist()):
                    more = np.bincount(gram[of == own], minlength=GRAMS)
                    total[own] = more + total[own] if own in total else more
        for own, n in total.items():
            for k in range(0, GRAMS, SHARD):
                if n[k:k + SHARD].any():
                    yield pa.record_batch([pa.array([own]), pa.array([k // SHARD], pa.int32()), pa.array(
                        [zlib.compress(n[k:k + SHARD].astype("<i8").tobytes(), 1)])], names=["lang", "shard", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = None, None

        def close() -> pa.RecordBatch:
            return pa.record_batch([pa.array([own[0]]), pa.array([own[1]], pa.int32()),
                                    pa.array([zlib.compress(total.tobytes(), 1)])], names=["lang", "shard", "counts"])

        for batch in batches:
            for lang, shard, packed in zip(*(c.to_pylist() for c in batch.columns)):
                n = np.frombuffer(zlib.decompress(packed), "<i8")
                if own != (lang, shard):
                    if own is not None:
                        yield close()
                    own, total = (lang, shard), n.copy()
                else:
                    total += n
        if own is not None:
            yield close()

    schema = "lang string, shard int, counts binary"
    return (trusted.select("lang", "folded").mapInArrow(count, schema)
            .repartition("lang", "shard").sortWithinPartitions("lang", "shard").mapInArrow(add, schema))


def _discounts(c: np.ndarray) -> np.ndarray:
    """Discounts for counts 0, 1, 2 and from 3 on, from the counts of counts."""
    n = [float((c == k).sum()) for k in range(5)]
    y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0.0
    out = [0.0]
    for k in (1, 2, 3):
        d = k - (k + 1) * y * n[k + 1] / n[k] if n[k] else k / 2
        out.append(min(max(d, 0.05), k - 0.05))
    return np.array(out)


def model(c: np.ndarray) -> np.ndarray:
    """log p(last symbol | symbols before) for every gram, from gram counts."""
    by_order = [c]
    for _ in range(ORDER - 1):  # how many different symbols stand before each shorter gram
        by_order.append((by_order[-1].reshape(SYMBOLS, -1) > 0).sum(0))
    p = np.full(1, 1.0 / SYMBOLS)
    for own in reversed(by_order):
        own = own.reshape(-1, SYMBOLS)
        lower = np.tile(p.reshape(-1, SYMBOLS) if p.size > 1 else np.full((1, SYMBOLS), p[0]),
                        (max(1, own.shape[0] // max(1, p.size // SYMBOLS)), 1))
        d = _discounts(own)[np.minimum(own, 3)]
        total = own.sum(1, keepdims=True)
        seen = np.maximum(total, 1)
        p = np.where(total > 0, (own - d) / seen + d.sum(1, keepdims=True) / seen * lower, lower).reshape(-1)
    return np.log(p)


def models(shards: DataFrame) -> Broadcast:
    """The models of all languages as {lang: log probabilities}."""

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, c = None, None
        for batch in batches:
            for lang, shard, packed in zip(*(x.to_pylist() for x in batch.columns)):
                if lang != own:
                    if own is not None:
                        yield _model_row(own, c)
                    own, c = lang, np.zeros(GRAMS, np.int64)
                c[shard * SHARD:(shard + 1) * SHARD] = np.frombuffer(zlib.decompress(packed), "<i8")
        if own is not None:
            yield _model_row(own, c)

    rows = (shards.repartition("lang").sortWithinPartitions("lang")
            .mapInArrow(fit, "lang string, logp binary").collect())  # MAX_BROADCAST bytes at most
    out = {r["lang"]: np.frombuffer(zlib.decompress(r["logp"]), "<f4") for r in rows}
    if sum(x.nbytes for x in out.values()) > MAX_BROADCAST:
        raise ValueError("more models than languages")
    return shards.sparkSession.sparkContext.broadcast(out)


def _model_row(lang: str, c: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array([lang]), pa.array([zlib.compress(model(c).astype("<f4").tobytes(), 1)])],
                           names=["lang", "logp"])


def _lang() -> Column:
    return F.when(F.col("lang").isin(list(LANGUAGES)), F.col("lang")).otherwise(F.lit(OTHERS))


def scored(docs: DataFrame, logp: Broadcast) -> DataFrame:
    """doc_id, lang (of the model), n_chars, perplexity (null without text or model)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, 2):
                gram, n = grams([t or "" for t in part.column(2).to_pylist()])
                langs = part.column(1).to_pylist()
                out: list[float | None] = []
                at = 0
                for lang, k in zip(langs, n.tolist()):
                    table = logp.value.get(lang)
                    out.append(None if table is None or not k else
                               float(np.exp(-table[gram[at:at + k]].mean(dtype=np.float64))))
                    at += k
                yield pa.record_batch([part.column(0), part.column(1), pa.array(n), pa.array(out, pa.float64())],
                                      names=["doc_id", "lang", "n_chars", "perplexity"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _lang().alias("lang"), "text").mapInArrow(
        run, "doc_id long, lang string, n_chars long, perplexity double")


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, n_chars, perplexity, threshold, kept for every document.
    ``labels`` (doc_id, quality) names the trusted documents: quality 1."""
    good = labels.where("quality = 1").select("doc_id").distinct()
    rows = stage(scored(docs, models(counts(trusted(docs, good)))), "perplexity")
    limits = (rows.where(F.col("n_chars") >= MIN_CHARS).join(good.hint("merge"), "doc_id", "left_semi")
              .groupBy(F.col("lang").alias("_lang"))
              .agg((F.percentile_approx("perplexity", QUANTILE, 10000) * MARGIN).alias("threshold")))
    # one row for each listed language and one for the others
    out = rows.join(F.broadcast(limits), F.col("lang") == F.col("_lang"), "left")
    far = (F.col("n_chars") >= MIN_CHARS) & (F.col("perplexity") > F.col("threshold"))
    return out.select("doc_id", "lang", "n_chars", "perplexity", "threshold",
                      (~F.coalesce(far, F.lit(False))).alias("kept"))

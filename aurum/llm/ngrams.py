"""Quality by perplexity: interpolated modified Kneser-Ney over code points.

The vocabulary is open: every code point counts as it is, with no folding, and
each value of ``lang`` has a model and a threshold of its own (null: ``und``).
Tables hold whatever the trusted text holds and grow with it; only one row a
language (discounts, thresholds) is broadcast, and scores come from joins.

1. Dealing.  Documents are dealt to parts by ``doc_id`` (of about ``PART_BYTES``
   or less), texts packed.  A part gives its distinct grams of ``ORDER`` code
   points with their number in its trusted documents, 0 if there are none.
2. Counts.  Grams are added up by a shuffle on language and gram.  A lower
   order's counts are the different code points that stand before its gram in
   trusted text; each order is a grouping of the one above.
3. Model.  Discounts come from the counts of counts of each language and order.
   Every order interpolates with the one below by a join on the shorter gram,
   down to uniform over the language's trusted code points and one for all
   others.  Grams that only other documents hold are rows with count 0.
4. Scores.  The grams of the parts are joined with their probabilities, which
   meet the part's texts again.  A document's score is its perplexity per
   code point, with blanks before the text as its first context.
5. Threshold.  Per language, ``QUANTILE`` of the perplexities of its trusted
   documents, times ``MARGIN``.  A document above it goes.

Null text counts as empty.  Documents of fewer than ``MIN_CHARS`` characters and
languages without any trusted document are kept.  Rows that repeat a ``doc_id``
are scored one by one; a ``doc_id`` is trusted if any label says so, and null
never is.  Without documents there are no rows, without trusted ones all are
kept.  A long text is read by one task, ``PIECE`` characters at a time or the
whole text if it is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import partitions, stage
from .tokens import slices

ORDER = 4  # a gram is a context of three code points, which fill 63 bits, and one more
BITS = 21
QUANTILE = 0.99
MARGIN = 1.1
MIN_CHARS = 200
PART_BYTES = 16_000_000
PIECE = 1_000_000
#: Above this many cells, distinct keys are found by sorting.
CELLS = 1 << 25
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _distinct(key: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, ascending, and the place of each key among them."""
    if size > CELLS:
        return np.unique(key, return_inverse=True)
    seen = np.zeros(size, bool)
    seen[key] = True
    return np.flatnonzero(seen), (np.cumsum(seen, dtype=np.int32) - 1)[key]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(contexts, last code points) of the distinct grams of texts, ascending;
    the gram at each character of all texts; the characters of each text."""
    pad = " " * (ORDER - 1)
    points = np.frombuffer((pad + pad.join(texts)).encode("utf-32-le"), np.uint32)
    n = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.cumsum(n + ORDER - 1) - n
    at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    letters, one = _distinct(points, 0x110000)
    gram, value = one, letters
    for _ in range(ORDER - 2):  # contexts, one code point longer each time, by their last place
        key = gram[:-1].astype(np.int64) * len(letters) + one[len(one) - len(gram) + 1:]
        keys, gram = _distinct(key, len(value) * len(letters))
        value = value[keys // len(letters)] << BITS | letters[keys % len(letters)]
    key = gram[at - (ORDER - 1)].astype(np.int64) * len(letters) + one[at]
    keys, gram = _distinct(key, len(value) * len(letters))
    return value[keys // len(letters)], letters[keys % len(letters)].astype(np.int32), gram, n


def _part(doc_id: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(parts)).cast("int")


def dealt(docs: DataFrame, parts: int) -> DataFrame:
    """(part, doc_ids, langs, sizes, texts): documents by part, texts as bytes one
    after another, packed.  Null ids are dealt by their text."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=6, write_checksum=False).compress
        for batch in batches:
            for a, b in slices(batch.column(3), 8_000_000):
                own = batch.slice(a, b - a)
                part = own.column(0).to_numpy()
                order = np.argsort(part, kind="stable")
                part = part[order]
                _, ids, langs, texts = (c.take(pa.array(order)) for c in own.columns)
                sizes = pc.binary_length(texts).cast(pa.int32())
                cut = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]]).tolist()
                offsets = pa.array(cut, pa.int32())
                yield pa.record_batch(
                    [pa.array(part[cut[:-1]], pa.int32()), *(pa.ListArray.from_arrays(offsets, c) for c in (ids, langs, sizes)),
                     pa.array([press("".join(texts.slice(x, y - x).to_pylist()).encode()) for x, y in zip(cut, cut[1:])],
                              pa.binary())], names=["part", "doc_ids", "langs", "sizes", "texts"])

    key = F.col("doc_id").cast("long")
    part = F.when(key.isNull(), _part(F.col("text"), parts)).otherwise(_part(key, parts))
    rows = docs.select(part.alias("part"), key.alias("doc_id"), F.coalesce("lang", F.lit("und")).alias("lang"),
                       F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(pack, "part int, doc_ids array<long>, langs array<string>, sizes array<int>, texts binary")


def _pieces(part: pa.Table) -> Iterator[tuple[str, list[int | None], list[str]]]:
    """(lang, doc_ids, texts) of a part's documents, about PIECE characters at a time."""
    unpack = zstandard.ZstdDecompressor().decompress
    held: dict[str, tuple[list[int | None], list[str], list[int]]] = {}
    for ids, langs, sizes, texts in zip(*(part.column(c).to_pylist() for c in ("doc_ids", "langs", "sizes", "texts"))):
        raw, at = unpack(texts), 0
        for doc_id, lang, size in zip(ids, langs, sizes):
            own = held.setdefault(lang, ([], [], [0]))
            own[0].append(doc_id)
            own[1].append(raw[at:at + size].decode())
            own[2][0] += size
            at += size
            if own[2][0] >= PIECE:
                yield lang, *held.pop(lang)[:2]
    for lang, own in held.items():
        yield lang, *own[:2]


def requested(docs: DataFrame, good: DataFrame, parts: int) -> DataFrame:
    """(part, lang, ctx, w, n): the distinct grams of every part, and their
    number in its documents whose id is in ``good``."""

    def count(part: pa.Table, good: pa.Table) -> pa.Table:
        trusted = set(good.column("doc_id").to_pylist())
        out = []
        for lang, ids, texts in _pieces(part):
            ctx, w, gram, n = grams(texts)
            of = np.repeat(np.array([i is not None and i in trusted for i in ids], bool), n)
            out.append(pa.table({"lang": pa.array([lang]).take(pa.array(np.zeros(len(w), np.int32))), "ctx": pa.array(ctx, pa.int64()),
                                 "w": w, "n": np.bincount(gram[of], minlength=len(w)).astype(np.int64)}))
        if not out:
            return names.empty_table()
        all_ = pa.concat_tables(out).group_by(["lang", "ctx", "w"]).aggregate([("n", "sum")]).rename_columns(
            ["lang", "ctx", "w", "n"]).sort_by([("lang", "ascending"), ("ctx", "ascending"), ("w", "ascending")])
        own = pa.array(np.full(len(all_), part.column("part")[0].as_py(), np.int32))
        return all_.add_column(0, "part", own)

    names = pa.schema([("part", pa.int32()), ("lang", pa.string()), ("ctx", pa.int64()), ("w", pa.int32()), ("n", pa.int64())])
    ids = good.select(_part(F.col("doc_id"), parts).alias("part"), "doc_id")
    return (dealt(docs, parts).groupBy("part").cogroup(ids.groupBy("part"))
            .applyInArrow(count, "part int, lang string, ctx long, w int, n long"))


def _shorter(order: int) -> Column:
    """The context of ``order`` - 1 code points at the end of ``ctx``."""
    return F.col("ctx").bitwiseAND(F.lit((1 << BITS * (order - 1)) - 1).cast("long"))


def lower_counts(above: DataFrame, order: int) -> DataFrame:
    """(lang, ctx, w, n): how many code points stand before each gram of ``order`` in trusted text."""
    return above.groupBy("lang", _shorter(order).alias("ctx"), "w").agg(
        F.sum(F.when(F.col("n") > 0, 1).otherwise(0)).cast("long").alias("n"))


def discounts(counts: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3, seen): discounts for counts 1, 2 and from 3 on, from the
    counts of counts, and the number of grams, for languages with trusted text."""
    c = counts.where("n > 0").groupBy("lang").agg(
        F.count(F.lit(1)).alias("seen"), *(F.count_if(F.col("n") == k).cast("double").alias(f"c{k}") for k in (1, 2, 3, 4)))
    y = F.when(F.col("c1") > 0, F.col("c1") / (F.col("c1") + 2 * F.col("c2"))).otherwise(0.0)

    def d(k: int) -> Column:
        raw = F.when(F.col(f"c{k}") > 0, k - (k + 1) * y * F.col(f"c{k + 1}") / F.col(f"c{k}")).otherwise(k / 2)
        return F.least(F.greatest(raw, F.lit(0.05)), F.lit(k - 0.05)).alias(f"d{k}")

    return c.select("lang", d(1), d(2), d(3), "seen")


def probabilities(counts: DataFrame) -> DataFrame:
    """(lang, ctx, w, p): the probability of ``w`` after ``ctx`` for all rows of
    ``counts`` (lang, ctx, w, n; staged) in languages with trusted text."""
    by_order = {ORDER: counts}
    for k in range(ORDER - 1, 0, -1):
        by_order[k] = stage(lower_counts(by_order[k + 1], k), "grams")
    p = None
    for k in range(1, ORDER + 1):
        n, own = F.col("n"), Window.partitionBy("lang", "ctx")
        taken = F.when(n == 0, 0.0).when(n == 1, F.col("d1")).when(n == 2, F.col("d2")).otherwise(F.col("d3"))
        # one row a language; dealt by language, a common one would fill one task
        rows = by_order[k].join(F.broadcast(discounts(by_order[k])), "lang").withColumn("taken", taken)
        rows = rows.withColumns({"total": F.sum("n").over(own), "free": F.sum("taken").over(own)})
        if p is None:
            rows = rows.withColumn("lower", 1 / (F.col("seen") + 1))
        else:
            below = p.select("lang", F.col("ctx").alias("_ctx"), "w", F.col("p").alias("lower"))
            rows = rows.withColumn("_ctx", _shorter(k - 1)).join(below, ["lang", "_ctx", "w"])
        mixed = (n - F.col("taken")) / F.col("total") + F.col("free") / F.col("total") * F.col("lower")
        p = rows.select("lang", "ctx", "w", F.when(F.col("total") > 0, mixed).otherwise(F.col("lower")).alias("p"))
    return p


def scored(docs: DataFrame, answers: DataFrame, parts: int) -> DataFrame:
    """doc_id, lang, n_chars, perplexity (null without text or model), from
    ``answers`` (part, lang, ctx, w, logp): the grams of every part."""

    def score(part: pa.Table, answers: pa.Table) -> pa.Table:
        known = {}
        langs = answers.column("lang")
        for name in langs.unique().to_pylist():
            rows = answers.filter(pc.equal(langs, name))
            ctx, w = rows.column("ctx").to_numpy(), rows.column("w").to_numpy().astype(np.int64)
            contexts, at = np.unique(ctx, return_inverse=True)
            key = at << BITS | w
            order = np.argsort(key)
            known[name] = contexts, key[order], rows.column("logp").to_numpy()[order]
        out = []
        for name, ids, texts in _pieces(part):
            ctx, w, gram, n = grams(texts)
            score = np.full(len(n), np.nan)
            if name in known and len(gram):
                contexts, key, logp = known[name]
                own = np.searchsorted(contexts, ctx) << BITS | w
                at = np.searchsorted(key, own)
                if not np.array_equal(key[np.minimum(at, len(key) - 1)], own):
                    raise ValueError("grams without an answer: the documents changed between two reads")
                upto = np.concatenate([[0.0], np.cumsum(logp[at].astype(np.float64)[gram])])
                ends = np.cumsum(n)
                full = n > 0
                score[full] = np.exp(-(upto[ends] - upto[ends - n])[full] / n[full])
            out.append(pa.table({"doc_id": pa.array(ids, pa.int64()), "lang": pa.array([name] * len(ids), pa.string()), "n_chars": n,
                                 "perplexity": pa.array(score, pa.float64(), mask=np.isnan(score))}))
        return pa.concat_tables(out) if out else names.empty_table()

    names = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("n_chars", pa.int64()), ("perplexity", pa.float64())])
    return (dealt(docs, parts).groupBy("part").cogroup(answers.groupBy("part"))
            .applyInArrow(score, "doc_id long, lang string, n_chars long, perplexity double"))


def _stage_and_drop_shuffles(df: DataFrame, name: str) -> DataFrame:
    """``stage``, with the job's shuffle files dropped at its end, not at some later garbage collection."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        return stage(df, name)
    finally:
        conf.set(CLEANUP, before)


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, n_chars, perplexity, threshold, kept for every document.
    ``labels`` (doc_id, quality) names the trusted documents: quality 1."""
    docs = docs.select("doc_id", "lang", "text")
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(partitions(docs.sparkSession), size // PART_BYTES + 1)
    asked = _stage_and_drop_shuffles(requested(docs, good, parts), "grams")
    counts = _stage_and_drop_shuffles(asked.groupBy("lang", "ctx", "w").agg(F.sum("n").alias("n")), "grams")
    answers = asked.drop("n").join(probabilities(counts), ["lang", "ctx", "w"]).select(
        "part", "lang", "ctx", "w", F.log("p").cast("float").alias("logp"))
    rows = stage(scored(docs, answers, parts), "perplexity")
    limits = (rows.where(F.col("n_chars") >= MIN_CHARS).join(good.hint("merge"), "doc_id", "left_semi")
              .groupBy(F.col("lang").alias("_lang"))
              .agg((F.percentile_approx("perplexity", QUANTILE, 10000) * MARGIN).alias("threshold")))
    out = rows.join(F.broadcast(limits), F.col("lang") == F.col("_lang"), "left")
    far = (F.col("n_chars") >= MIN_CHARS) & (F.col("perplexity") > F.col("threshold"))
    return out.select("doc_id", "lang", "n_chars", "perplexity", "threshold",
                      (~F.coalesce(far, F.lit(False))).alias("kept"))

"""Phrase collocations by best-first branch and bound.

A phrase of two or three words that occurs ``least`` times or more scores
floor(1000000 a a / (l r)) at its worst cut, with its count a and the counts l
and r of the two parts; phrases mostly inside one longer phrase go.  Each
language's ``top`` best are returned.

The search is a tree: a word grows to pairs, a pair to triples.

1. Words are counted, then the pairs of frequent words (a phrase is no more
   frequent than any part).
2. Prefix counts bound what a pair x y can grow to: a triple x y z occurs no
   more often than x y, nor than the most frequent pair that begins with y, and
   its worst cut scores no more than that count over the count of x.  Flooring
   keeps the bound admissible.
3. Best first: each language has a limit, at first the score at rank ``2 top``
   of its pairs.  Pairs whose bound reaches the limit grow; pairs whose own
   score reaches it are settled too, by the triples that begin or end with them
   (whether they go depends on those).  Nothing that could reach the limit is
   left out, so the survivors at or above it are final, ties included.
4. A language with fewer than ``top`` of them lowers its limit to the score at
   eight times the rank and its frontier grows on, each pair once; at limit 0
   the tree is exhausted.  Branches below the limit are never counted.

Counts are combined in each batch and task before the one shuffle of a level.
Tasks know the frontier by bit filters of a fixed size: a pair let through by
chance costs time, its triples have right counts like any other.  Words travel
as 64-bit hashes of (language, word); that no other word of the corpus shares a
frequent word's hash is checked, else another seed is taken, so results are exact.

Null texts are empty, a null language is ``und``; texts without phrases, very
long texts (cut nowhere but at piece ends), repeated rows and repeated ids all
count as they are.  Ties are ordered by count and phrase.  An empty table gives
no rows; columns other than ``text`` and ``lang`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage
from .wordcount import BitFilter, mixed, pieces, word_counts, word_hash

FILTER_BITS = 27
#: How far a language's rank goes on when its survivors are too few.
STEP = 8


def _floored(over: Column, under: Column) -> Column:
    """floor(1000000 over / under) of whole decimals, exact far beyond 64 bits."""
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * over, under).cast("long")


def _score(a: Column, l: Column, r: Column) -> Column:
    a, l, r = (c.cast("decimal(18,0)") for c in (a, l, r))
    return _floored(a * a, l * r)


def _hash(column: str):
    return lambda batch: batch.column(batch.schema.get_field_index(column)).to_numpy().view(np.uint64)


def _pair(batch: pa.RecordBatch) -> np.ndarray:
    return mixed(batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy().view(np.uint64))


def frequent_words(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame, int]:
    """(lang, word, f, h) of words that occur often enough, (lang, n) of all
    words, and the seed of their hashes."""
    words, seed = stage(word_counts(docs), "words"), 0
    while True:
        shared = (words.groupBy(word_hash(seed).alias("h")).agg(F.count(F.lit(1)).alias("n"), F.max("f").alias("f"))
                  .where((F.col("n") > 1) & (F.col("f") >= least)))
        if shared.isEmpty():
            break
        seed += 1
    often = stage(words.where(F.col("f") >= least).withColumn("h", word_hash(seed)), "frequent-words")
    return often, words.groupBy("lang").agg(F.sum("f").alias("n")), seed


def pair_counts(docs: DataFrame, often: DataFrame, seed: int, least: int) -> DataFrame:
    """(h1, h2, a): pairs that occur often enough."""
    known = BitFilter(often.select("h"), _hash("h"), FILTER_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in pieces(batches):
            h = p.hashes(seed)
            own = p.own
            good = known.has(h)[own] if len(own) else np.zeros(0, bool)
            at = np.flatnonzero(p.tied & good[:-1] & good[1:]) if len(own) else np.zeros(0, np.int64)
            both, n = np.unique(own[at] * len(h) + own[at + 1], return_counts=True)
            yield pa.record_batch([pa.array(h[both // max(1, len(h))].view(np.int64)),
                                   pa.array(h[both % max(1, len(h))].view(np.int64)),
                                   pa.array(n.astype(np.int64))], names=["h1", "h2", "a"])

    return (docs.select("lang", "text").mapInArrow(run, "h1 long, h2 long, a long")
            .groupBy("h1", "h2").agg(F.sum("a").alias("a")).where(F.col("a") >= least))


def triple_counts(docs: DataFrame, pairs: BitFilter, grow: DataFrame, settle: DataFrame, seed: int,
                  least: int) -> DataFrame:
    """(h1, h2, h3, a): frequent triples whose first pair grows, or whose first
    or last pair is to be settled."""
    first = BitFilter(grow.select("h1", "h2").unionByName(settle.select("h1", "h2")), _pair, FILTER_BITS)
    last = BitFilter(settle.select("h1", "h2"), _pair, FILTER_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in pieces(batches):
            h, own = p.hashes(seed), p.own
            at = np.flatnonzero(p.tied)
            if not len(at):
                continue
            both, pair = np.unique(own[at] * len(h) + own[at + 1], return_inverse=True)
            m = mixed(h[both // len(h)], h[both % len(h)])
            good, begins, ends = pairs.has(m), first.has(m), last.has(m)
            # pairs i and i + 1 that share their middle word
            next_ = np.flatnonzero(at[1:] == at[:-1] + 1)
            x, y = pair[next_], pair[next_ + 1]
            hit = good[x] & good[y] & (begins[x] | ends[y])
            x, y = x[hit], y[hit]
            three, n = np.unique(x * len(both) + y, return_counts=True)
            x, y = both[three // max(1, len(both))], both[three % max(1, len(both))]
            yield pa.record_batch([pa.array(h[v].view(np.int64)) for v in (x // len(h), x % len(h), y % len(h))]
                                  + [pa.array(n.astype(np.int64))], names=["h1", "h2", "h3", "a"])

    return (docs.select("lang", "text").mapInArrow(run, "h1 long, h2 long, h3 long, a long")
            .groupBy("h1", "h2", "h3").agg(F.sum("a").alias("a")).where(F.col("a") >= least))


def _scored_pairs(pairs: DataFrame, often: DataFrame) -> DataFrame:
    """(lang, h1, h2, a, l, r, score, bound)."""
    grown = pairs.groupBy(F.col("h1").alias("h2")).agg(F.max("a").alias("next"))
    left = often.select("lang", F.col("h").alias("h1"), F.col("f").alias("l"))
    right = often.select(F.col("h").alias("h2"), F.col("f").alias("r"))
    most = F.least("a", F.coalesce("next", F.lit(0)))
    return (pairs.join(left, "h1").join(right, "h2").join(grown, "h2", "left")
            .select("lang", "h1", "h2", "a", "l", "r", _score(F.col("a"), F.col("l"), F.col("r")).alias("score"),
                    _floored(most.cast("decimal(18,0)"), F.col("l").cast("decimal(18,0)")).alias("bound")))


def _scored_triples(triples: DataFrame, pairs: DataFrame, often: DataFrame) -> DataFrame:
    """(lang, h1, h2, h3, a, l, r, score) at the lowest cut, the first of equals."""
    word = often.select(F.col("h").alias("h1"), F.col("f").alias("f1"), "lang")
    last = often.select(F.col("h").alias("h3"), F.col("f").alias("f3"))
    head = pairs.select("h1", "h2", F.col("a").alias("f12"))
    tail = pairs.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("a").alias("f23"))
    t = triples.join(head, ["h1", "h2"]).join(tail, ["h2", "h3"]).join(word, "h1").join(last, "h3")
    t = t.withColumns({"s1": _score(F.col("a"), F.col("f1"), F.col("f23")),
                       "s2": _score(F.col("a"), F.col("f12"), F.col("f3"))})
    early = F.col("s1") <= F.col("s2")
    return t.select("lang", "h1", "h2", "h3", "a", F.when(early, F.col("f1")).otherwise(F.col("f12")).alias("l"),
                    F.when(early, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("s1", "s2").alias("score"))


def collocations(docs: DataFrame, top: int = 2000, least: int = 10, share: int = 50) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, and words (their number).  A phrase
    goes if a longer one with it has at least ``share`` per cent of its count."""
    often, totals, seed = frequent_words(docs, least)
    pairs = stage(_scored_pairs(stage(pair_counts(docs, often, seed, least), "pairs"), often), "scored-pairs")
    known = BitFilter(pairs.select("h1", "h2"), _pair, FILTER_BITS)

    # at most a million scores a language
    scores = stage(pairs.groupBy("lang", "score").agg(F.count(F.lit(1)).alias("n")), "scores")
    upto = F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("score")))

    def limits(rank: int) -> DataFrame:
        """(lang, low): the score at a rank, 0 if there are fewer pairs."""
        return (scores.select("lang", "score", upto.alias("upto")).groupBy("lang")
                .agg(F.coalesce(F.max(F.when(F.col("upto") >= rank, F.col("score"))), F.lit(0)).alias("low")))

    rank, triples, open_ = 2 * top, None, stage(
        limits(2 * top).withColumn("high", F.lit(None).cast("long")), "limits")
    done: list[DataFrame] = []
    while True:
        at_hand = pairs.join(open_, "lang")
        fresh = lambda c: (F.col(c) >= F.col("low")) & F.coalesce(F.col(c) < F.col("high"), F.lit(True))
        counted = triple_counts(docs, known, at_hand.where(fresh("bound")), at_hand.where(fresh("score")), seed, least)
        triples = stage(counted if triples is None else triples.unionByName(counted).distinct(), "triples")
        inside = triples.select(F.explode(F.array(
            F.struct("h1", "h2", F.col("a").alias("f")),
            F.struct(F.col("h2").alias("h1"), F.col("h3").alias("h2"), F.col("a").alias("f")))).alias("e"))
        longest = inside.groupBy("e.h1", "e.h2").agg(F.max("e.f").alias("longer"))
        two = (at_hand.where(F.col("score") >= F.col("low")).join(longest, ["h1", "h2"], "left")
               .where(~F.coalesce(100 * F.col("longer") >= share * F.col("a"), F.lit(False)))
               .select("lang", "h1", "h2", F.lit(None).cast("long").alias("h3"), "a", "l", "r", "score"))
        three = (_scored_triples(triples, pairs, often).join(open_.select("lang", "low"), "lang")
                 .where(F.col("score") >= F.col("low")).drop("low"))
        best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
        found = stage(two.unionByName(three).withColumn("i", F.rank().over(best)).where(F.col("i") <= top), "found")
        have = found.groupBy("lang").agg(F.count(F.lit(1)).alias("have"))
        state = open_.join(have, "lang", "left").withColumn(
            "settled", (F.coalesce("have", F.lit(0)) >= top) | (F.col("low") == 0))
        done.append(found.join(state.where("settled").select("lang"), "lang", "left_semi"))
        rank *= STEP
        rest = state.where(~F.col("settled")).select("lang", F.col("low").alias("high"))
        if rest.isEmpty():
            break
        open_ = stage(rest.join(limits(rank), "lang"), "limits")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    for i in (1, 2, 3):
        out = out.join(often.select(F.col("h").alias(f"h{i}"), F.col("word").alias(f"w{i}")), f"h{i}",
                       "left" if i == 3 else "inner")
    first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (out.withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3"))
            .withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top)
            .join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score",
                    F.when(F.col("h3").isNull(), 2).otherwise(3).alias("words")))

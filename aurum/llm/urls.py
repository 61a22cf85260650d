"""URL filter: rules first, then naive Bayes over segmented names.

1. Host and path are cut from the url.  A rule (verdict, host, path) fits its host and
   all subdomains if the path starts with its own; of several the longest
   (host and path together) decides, of equally long ones the first given.
2. Names run words together, so each run of letters in a host or path is split
   by a unigram Viterbi: the words of a corpus, counted over all its documents,
   cost ln(N / n), an unknown piece of k letters ln(N / 10) + k ln 10.  A run meets the
   counts by a join of its pieces (of at most ``LONGEST`` letters).  Of equal
   splits the one with fewer words wins, then the one with the longer last word.
   Runs of digits become one token that tells their length.
3. A multinomial naive Bayes, trained on all pages that a rule decides (their
   verdict is the label), scores the host and path tokens of every page.  A page
   without a rule is blocked if its score is above 0.

Pages are scored by run: the score of a run is the sum of its words' scores, so a
page row meets one row per run.  Frequent runs, tokens and pieces ("com") are
joined by broadcast under a bound (``join_hot``).  Costs and scores are whole
millionths, so sums do not depend on their order.

A null url, or one without ``://``, has an empty host and path and is judged by the
prior alone.  Runs of more than ``RUN`` letters are split in blocks of ``RUN``, so very
long urls need no more memory.  Repeated rows and ids are judged one by one.  With
no rule-decided page nothing is blocked; an empty corpus splits runs into
letters.  An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_hot, stage

#: (verdict, host, path)
Rule = tuple[str, str, str]
LONGEST = 24
RUN = 256
MILLION = 1_000_000


def parsed(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    rest = F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"\A([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def ruled(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """(rule, verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, own, start in reversed(sorted(rules, key=lambda r: -len(r[1] + r[2]))):
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(own + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def vocabulary(corpus: DataFrame) -> DataFrame:
    """(piece, n): the words of all texts, of at most ``LONGEST`` letters."""
    word = F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), r"\P{L}+"))
    return (corpus.select(word.alias("piece")).where(F.length("piece").between(1, LONGEST))
            .groupBy("piece").agg(F.count(F.lit(1)).alias("n")))


def split(run: str, known: dict[tuple[int, int], int], total: int) -> list[str]:
    """The cheapest split of a run; ``known`` has the counts of its pieces by
    (start, length)."""
    unit = math.log(max(total, 1) / 10)
    best: list[tuple[int, int, int]] = [(0, 0, 0)]  # cost, words, start of the last word
    for end in range(1, len(run) + 1):
        options = []
        for start in range(max(0, end - LONGEST), end):
            n = known.get((start, end - start))
            cost = math.log(total / n) if n else unit + (end - start) * math.log(10)
            options.append((best[start][0] + round(MILLION * cost), best[start][1] + 1, start))
        best.append(min(options))
    out, end = [], len(run)
    while end:
        start = best[end][2]
        out.append(run[start:end])
        end = start
    return out[::-1]


def segmented(runs: DataFrame, words: DataFrame) -> DataFrame:
    """(run, words) of distinct ``run``s of letters."""
    total = words.agg(F.sum("n")).first()[0] or 0
    cut = runs.select("run", F.explode(F.sequence(F.lit(1), F.length("run"))).alias("start"))
    cut = cut.select("run", "start", F.explode(F.sequence(
        F.lit(1), F.least(F.lit(LONGEST), F.length("run") - F.col("start") + 1))).alias("length"))
    pieces = stage(cut.withColumn("piece", F.substr("run", "start", "length")), "pieces")
    # of one run at most RUN x LONGEST pieces
    found = (join_hot(pieces, words, "piece").groupBy("run")
             .agg(F.collect_list(F.when(F.col("n").isNotNull(), F.struct("start", "length", "n"))).alias("known")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [split(r, {(k["start"] - 1, k["length"]): k["n"] for k in known}, total)
                   for r, known in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.record_batch([batch.column(0), pa.array(out, pa.list_(pa.string()))], names=["run", "words"])

    return found.mapInArrow(run, "run string, words array<string>")


def judged(pages: DataFrame, corpus: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """page_id, host, path, rule, verdict and score (millionths of the log odds
    of blocking) of every row of ``pages``."""
    host, path = parsed(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"), F.monotonically_increasing_id().alias("row"))
    rows = stage(rows.withColumn("r", ruled(rules, F.col("host"), F.col("path"))).select("*", "r.*").drop("r"), "pages")

    pattern = F.lit(rf"\p{{L}}{{1,{RUN}}}|\p{{Nd}}{{1,{RUN}}}")
    in_field = lambda name: F.transform(F.regexp_extract_all(F.lower(name), pattern, 0),
                                        lambda r: F.concat(F.lit(name[0]), r))
    # a run with the first letter of its field
    runs = stage(rows.select("row", "verdict", F.explode(F.concat(in_field("host"), in_field("path"))).alias("key")), "runs")
    block, allow = (F.count(F.when(F.col("verdict") == v, 1)).alias(v) for v in ("block", "allow"))
    counted = stage(runs.groupBy("key").agg(block, allow).withColumn("run", F.expr("substring(key, 2)")), "run-counts")

    letters = F.col("run").rlike(r"\A\p{L}")
    words = stage(vocabulary(corpus), "vocabulary")
    known = segmented(counted.where(letters).select("run").distinct(), words)
    number = F.array(F.concat(F.lit("#"), F.length("run").cast("string")))
    tokens = stage(counted.join(known, "run", "left").select("key", "block", "allow", F.explode(
        F.coalesce("words", number)).alias("word")).withColumn("token", F.concat(F.substring("key", 1, 1), "word")), "tokens")

    model = stage(tokens.groupBy("token").agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"))
                  .where("block + allow > 0"), "model")
    n = model.agg(F.sum("block").alias("block"), F.sum("allow").alias("allow"), F.count(F.lit(1)).alias("v")).first()
    docs = rows.agg(block, allow).first()
    in_block, in_allow = ((n[c] or 0) + n["v"] + 1 for c in ("block", "allow"))
    millionths = lambda c: F.round(MILLION * c).cast("long")
    odds = lambda b, a: millionths(F.log((b + 1) / F.lit(in_block)) - F.log((a + 1) / F.lit(in_allow)))
    unseen = odds(F.lit(0), F.lit(0))
    prior = round(MILLION * math.log((docs["block"] + 1) / (docs["allow"] + 1)))

    by_run = join_hot(tokens.select("key", "token"),
                      model.select("token", odds(F.col("block"), F.col("allow")).alias("odds")), "token")
    by_run = by_run.groupBy("key").agg(F.sum(F.coalesce("odds", unseen)).alias("odds"))
    by_page = join_hot(runs.select("row", "key"), by_run, "key").groupBy("row").agg(F.sum("odds").alias("odds"))
    score = F.lit(prior) + F.coalesce("odds", F.lit(0))
    return (rows.join(by_page, "row", "left").withColumn("score", score.cast("long"))
            .select("page_id", "host", "path", "rule",
                    F.coalesce("verdict", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"), "score"))

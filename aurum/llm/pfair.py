"""Mixing sources to target weights by Pfair scheduling.

Sources are pools with integer shares (sources that are not listed form one
pool).  A pool's documents are numbered and cut into blocks of ``block_docs``.
Within a round each pool i places a_i blocks, its share, or what it has left;
all a_i make P slots.  Block k of the round is released at floor(k P / a_i) and
due at ceil((k + 1) P / a_i); each slot goes to the released block that is due
first.  The schedule of a round repeats as long as the a_i stay the same, and
they change at most twice per pool (its last, partial round, and its end), so a
few schedules of P slots place any number of blocks, and each pool is always
less than one block away from its part of the slots.  When a pool is used up,
the others go on by their shares: every document is placed exactly once.

The schedule is one expression over a table of as many rows as there are pools;
documents meet it by a join with this bounded table.  Numbering is split by
buckets of the id, so a pool may hold any part of the rows.

A null source belongs to the unlisted pool.  Null and repeated ``doc_id`` are
placed like others.  Texts are not read.  An empty table gives no rows; a
listed source without documents takes no slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, ranked, stage

BUCKETS = 1024
REST = "*"


def _round(pools: Column, number: Column) -> Column:
    """Blocks each pool places in a round."""
    return F.transform(pools, lambda p: F.greatest(F.lit(0).cast("long"), F.least(
        p["share"], p["blocks"] - number * p["share"])))


def _edf(blocks: Column) -> Column:
    """The slots of one round, earliest deadline first: array of (pool, k)."""

    def fold(total: Column) -> Column:
        start = F.struct(F.transform(blocks, lambda b: F.lit(0).cast("long")).alias("done"),
                         F.slice(F.array(F.struct(F.lit(0).alias("pool"), F.lit(0).cast("long").alias("k"))),
                                 1, 0).alias("out"))

        def step(s: Column, t: Column) -> Column:
            # floor(k P / a) <= t  and  ceil((k + 1) P / a), in whole numbers
            due = F.transform(blocks, lambda a, i: let(F.get(s["done"], i), lambda k: F.when(
                (k < a) & (F.floor(k * total / F.greatest(a, F.lit(1))) <= t),
                F.struct(F.ceil((k + 1) * total / a).alias("due"), i.alias("pool")))))
            return let(F.array_min(due)["pool"], lambda at: F.struct(
                F.transform(s["done"], lambda k, i: F.when(i == at, k + 1).otherwise(k)).alias("done"),
                F.concat(s["out"], F.array(F.struct(at.alias("pool"), F.get(s["done"], at).alias("k")))).alias("out")))

        return F.when(total > 0, F.aggregate(F.sequence(F.lit(0).cast("long"), total - 1), start, step)["out"])

    return let(F.aggregate(blocks, F.lit(0).cast("long"), lambda s, b: s + b), fold)


def schedule(pools: DataFrame) -> DataFrame:
    """For pools (pool, share, blocks): one row per slot of each different round:
    pool, k, slot, first_round, end_round, base (slots before first_round), slots."""
    one = pools.agg(F.sort_array(F.collect_list(F.struct("pool", F.col("share").cast("long").alias("share"),
                                                         F.col("blocks").cast("long").alias("blocks")))).alias("pools"))
    # rounds at which some pool places other than in the round before
    edges = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0).cast("long")), F.flatten(F.transform(
        "pools", lambda p: F.array(F.floor(p["blocks"] / p["share"]), F.ceil(p["blocks"] / p["share"])))))))
    rounds = (one.select("pools", edges.alias("edges"))
              .select("pools", "edges", F.posexplode("edges").alias("at", "first_round"))
              .withColumn("end_round", F.get("edges", F.col("at") + 1)).where("end_round IS NOT NULL")
              .withColumn("blocks", _round(F.col("pools"), F.col("first_round")))
              .withColumn("base", F.aggregate("pools", F.lit(0).cast("long"), lambda s, p: s + F.least(
                  p["blocks"], F.col("first_round") * p["share"])))
              .withColumn("slots", _edf(F.col("blocks"))))
    return rounds.select("pools", "first_round", "end_round", "base", F.size("slots").cast("long").alias("slots"),
                         F.posexplode("slots").alias("slot", "s")).select(
        F.get("pools", F.col("s.pool"))["pool"].alias("pool"), F.col("s.k").alias("k"),
        F.col("slot").cast("long").alias("slot"), "first_round", "end_round", "base", "slots")


def mixed(docs: DataFrame, shares: dict[str, int], rest: int, block_docs: int = 16,
          ties: tuple[Column, ...] = ()) -> DataFrame:
    """All columns of ``docs`` (doc_id, source and any others) with the struct
    ``_mix``: pool, block (its number in the pool), slot (the block's place in
    the mixture) and in_block (the document's place in the block).  ``ties``
    order rows of a pool that share a ``doc_id``."""
    known = F.create_map(*[x for s, n in sorted(shares.items()) for x in (F.lit(s), F.lit(s))]) if shares else None
    pool = F.coalesce(known[F.col("source")], F.lit(REST)) if shares else F.lit(REST)
    bucket = F.coalesce(F.pmod(F.col("doc_id"), F.lit(BUCKETS)), F.lit(0))
    numbered = ranked(docs.withColumn("_pool", pool), F.col("_pool"), bucket, [F.col("doc_id"), *ties], "_rank")
    share = F.create_map(*[x for s, n in [*sorted(shares.items()), (REST, rest)] for x in (F.lit(s), F.lit(n))])
    # a row per pool: as many as the mixture lists
    pools = (docs.select(pool.alias("pool")).groupBy("pool").agg(F.count(F.lit(1)).alias("n"))
             .select("pool", share[F.col("pool")].alias("share"), F.ceil(F.col("n") / block_docs).alias("blocks")))
    plan = stage(schedule(pools), "schedule")  # (2 pools + 1) rounds at most
    plan = plan.select(*[F.col(c).alias(f"_plan_{c}") for c in plan.columns])
    share_of = share[F.col("_pool")]
    blocks = (numbered.withColumn("_block", F.expr(f"_rank div {block_docs}"))
              .withColumn("_round", F.floor(F.col("_block") / share_of))
              .withColumn("_k", F.pmod("_block", share_of)))
    met = blocks.join(F.broadcast(plan), (F.col("_pool") == F.col("_plan_pool")) & (F.col("_k") == F.col("_plan_k"))
                      & (F.col("_round") >= F.col("_plan_first_round")) & (F.col("_round") < F.col("_plan_end_round")))
    slot = F.col("_plan_base") + (F.col("_round") - F.col("_plan_first_round")) * F.col("_plan_slots") + F.col("_plan_slot")
    return met.select(*[F.col(c) for c in docs.columns], F.struct(
        F.col("_pool").alias("pool"), F.col("_block").alias("block"), slot.alias("slot"),
        F.expr(f"_rank % {block_docs}").alias("in_block")).alias("_mix"))

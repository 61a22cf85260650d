"""Exact duplicates by deterministic block naming.

Every text is cut into blocks of ``block_chars`` characters.  All distinct
blocks are sorted into integer names; then the names of neighbouring blocks are
named in pairs, level by level, until each document has a single name.  Two
documents have the same (level, name) if and only if their texts are identical:
names are given to values, never to hashes.

The text moves once, as distinct blocks, combined before the shuffle; a hash of
the block only decides where it goes and finds its name again.  Where one hash
stands for several blocks, the blocks themselves are compared.  All else works
on numbers.  A group of copies is never gathered: class sizes are partial
counts, and rows find their class by a join that can be split.

Null texts count as empty, which is one class of its own.  Rows that repeat a
``doc_id`` are separate rows; of fully equal rows one is kept.  A null
``doc_id`` loses against any other.  An empty table gives no rows.  Other
columns of the input are not read.  A very long text is cut level by level, in
time about linear in its length, and its blocks lie in as many rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, text_or_empty


#: Parts of each level of ``_blocks``.
FAN = 64


def _cut(text: Column, size: int) -> Column:
    last = F.greatest(F.ceil(F.length(text) / size).cast("int") - 1, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last),
                       lambda i: F.substr(text, i * size + 1, F.lit(size)))


def _blocks(text: Column, size: int) -> Column:
    """The blocks of a text.  ``substr`` counts characters from the start, so a long text
    is cut into parts and these again: each level reads a character ``FAN`` times at
    most, but the first, whose parts have ``size * FAN ** 3`` characters at most.  Each
    level is a copy, so a text goes through no more of them than its length asks for."""
    def level(t: Column, n: int) -> Column:
        return F.flatten(F.transform(_cut(t, size * FAN ** n), lambda p: level(p, n - 1))) if n else _cut(t, size)

    out = F.when(F.length(text) <= size, F.array(text))
    for n in range(3):
        out = out.when(F.length(text) <= size * FAN ** (n + 1), level(text, n))
    return out.otherwise(level(text, 3))


def _numbered(distinct: DataFrame, *order: str) -> DataFrame:
    """Integer names from 1 in sort order (unique over all partitions)."""
    return distinct.sortWithinPartitions(*order).withColumn(
        "name", F.monotonically_increasing_id() + 1)


def block_names(docs: DataFrame, block_chars: int,
                hash_of: Callable[[Column], Column]) -> tuple[DataFrame, DataFrame | None]:
    """(hash -> name) where a hash stands for one block, and (hash, block -> name)
    for the others, if there are any."""
    blocks = (docs.select(F.explode(_blocks(text_or_empty(), block_chars)).alias("block"))
              .select(hash_of(F.col("block")).alias("h"), "block"))
    names = stage(_numbered(blocks.distinct(), "h", "block").select("h", "name"), "block-names")
    per_hash = names.groupBy("h").agg(F.count(F.lit(1)).alias("n"),
                                      F.sort_array(F.collect_list("name")).alias("names"))
    shared = stage(per_hash.where("n > 1"), "shared-hashes")  # blocks of one hash: as good as none
    if shared.isEmpty():
        return names, None
    by_block = Window.partitionBy("h").orderBy("block")
    exact = (blocks.join(shared, "h").distinct()
             .withColumn("at", F.row_number().over(by_block))
             .select("h", "block", F.element_at("names", F.col("at")).alias("name")))
    return names.join(shared, "h", "left_anti"), stage(exact, "exact-names")


def identities(docs: DataFrame, block_chars: int = 4096,
               hash_of: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per input row: rid, doc_id, text_sha256, level, name."""
    unique, exact = block_names(docs, block_chars, hash_of)
    text = text_or_empty()
    rows = (docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id"),
                        F.sha2(text, 256).alias("sha"), _blocks(text, block_chars).alias("blocks"))
            .select("rid", F.size("blocks").alias("n"), "doc_id", "sha", F.posexplode("blocks").alias("pos", "block"))
            .select("rid", "n", F.when(F.col("pos") == 0, F.col("doc_id")).alias("doc_id"),
                    F.when(F.col("pos") == 0, F.col("sha")).alias("sha"), "pos",
                    hash_of(F.col("block")).alias("h"), *(["block"] if exact is not None else [])))
    if exact is None:
        named = stage(rows, "blocks").join(unique, "h")
    else:
        named = rows.join(unique, "h").drop("block").unionByName(
            rows.join(exact, ["h", "block"]).drop("block"))
    # rid is fixed here: everything below reads this one table
    level = stage(named.drop("h"), "names")
    longest = level.agg(F.max("n")).first()[0] or 1
    done = level.where("n = 1").select("rid", "doc_id", "sha", F.lit(0).alias("level"), "name")
    depth = 0
    while longest > 1:  # halves each time: log2 of the longest document's blocks
        depth += 1
        pairs = (level.where("n > 1").groupBy("rid", F.expr("pos div 2").cast("int").alias("pos"))
                 .agg(F.max(F.expr("ceil(n / 2)")).cast("int").alias("n"),
                      F.max("doc_id").alias("doc_id"), F.max("sha").alias("sha"),
                      F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("l"),
                      F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))),
                                 F.lit(0)).alias("r")))
        pairs = stage(pairs, "pairs")
        names = stage(_numbered(pairs.select("l", "r").distinct(), "l", "r"), "pair-names")
        level = stage(pairs.join(names, ["l", "r"]).drop("l", "r"), "names")
        done = done.unionByName(level.where("n = 1").select(
            "rid", "doc_id", "sha", F.lit(depth).alias("level"), "name"))
        longest = (longest + 1) // 2
    return done


def duplicates(docs: DataFrame, block_chars: int = 4096,
               hash_of: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256,
    and rid, its number within this call.  The row with the largest ``doc_id``
    of equal texts stays."""
    rows = identities(docs, block_chars, hash_of)
    classes = rows.groupBy("level", "name").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.max(F.struct(F.col("doc_id"), (-F.col("rid")).alias("first"))).alias("keep"))
    return (rows.join(classes, ["level", "name"])
            .select("doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
                    (F.col("rid") == -F.col("keep.first")).alias("kept"),
                    F.col("sha").alias("text_sha256"), "rid"))

"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import fresh_dir, scratch_root

#: Word separators of the contracts: the six ASCII blanks, as a Java pattern.
BLANKS = r"[\x20\x09-\x0D]+"
#: A word is a longest run of other characters.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors' Python this package, once per application, as a user
    would with ``--py-files``."""
    sc = spark.sparkContext
    if not getattr(sc, "_aurum_shipped", False):
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        path = os.path.join(tempfile.mkdtemp(prefix="aurum-py-"), "aurum_llm.zip")
        with zipfile.ZipFile(path, "w") as z:
            for folder, _, names in os.walk(top):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(top)))
        sc.addPyFile(path)
        sc._aurum_shipped = True
    return spark


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text as an array (native, one split per text)."""
    return F.filter(F.split(text, BLANKS), lambda w: w != "")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared scratch folder and read it back.

    Cuts the lineage so that later steps neither recompute it nor depend on the
    executors that made it, and freezes anything a re-run could order otherwise.
    """
    spark = df.sparkSession
    scratch_root(spark)
    path = fresh_dir(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, key: Column, bucket: Column, order: list[Column],
           rank: str = "rank") -> DataFrame:
    """Number the rows of each key from 0, without one task per key.

    Rows are ordered by (bucket, order) inside the key.  They are split by
    (key, bucket); a count per (key, bucket), combined map-side, gives each
    bucket its first number.  ``bucket`` must have a fixed number of values, so
    the table of counts is bounded by keys x buckets.  Neither may be null: the
    rows are then dealt once, for the numbering and the join alike.
    """
    d = df.withColumns({"_key": key, "_bucket": bucket})
    counts = d.groupBy("_key", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(F.col("_key").alias("_k"), F.col("_bucket").alias("_b"),
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy("_key", "_bucket").orderBy(*order)
    return (d.withColumn("_row", F.row_number().over(inside).cast("long") - 1)
            .join(first, (F.col("_key") == F.col("_k")) & (F.col("_bucket") == F.col("_b")))
            .withColumn(rank, F.col("_first") + F.col("_row"))
            .drop("_key", "_bucket", "_k", "_b", "_first", "_row"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also where the body
    uses it inside a lambda (a plain column could be inlined there and be
    computed again for each element)."""
    return F.transform(F.array(value), body)[0]


def join_hot(rows: DataFrame, table: DataFrame, key: str, most: int = 1000) -> DataFrame:
    """``rows`` left-joined with ``table``, which is unique on ``key``, however
    many rows share a key.

    Keys with over 1 / ``most`` of the rows are fewer than ``most``: their rows of
    ``table`` are broadcast under that bound.  All others meet by shuffle, in
    groups of at most 1 / ``most``.  ``rows`` is read three times: stage it first.
    """
    total = rows.count()
    hot = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") * most > total).select(key)
    often = F.broadcast(table.join(F.broadcast(hot), key, "left_semi"))
    return (rows.join(F.broadcast(hot), key, "left_anti").join(table, key, "left")
            .unionByName(rows.join(F.broadcast(hot), key, "left_semi").join(often, key, "left")))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame, *order: Column, name: str = "no") -> DataFrame:
    """``df`` with dense numbers from 0 in the given order, which must be total.

    Rows are dealt by range and sorted; each range starts after the rows of the
    ranges before it (one count per range reaches the driver).
    """
    spark = df.sparkSession
    low = (1 << 33) - 1
    dealt = stage(df.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
                  .withColumn("_m", F.monotonically_increasing_id()), "numbered")
    counts = dealt.groupBy(F.shiftright("_m", 33).alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect()
    first, n = [], 0
    for r in counts:
        first.append((r["p"], n))
        n += r["n"]
    starts = F.broadcast(spark.createDataFrame(first, "_p long, _first long"))
    return (dealt.join(starts, F.shiftright("_m", 33) == F.col("_p"))
            .withColumn(name, F.col("_first") + F.col("_m").bitwiseAND(F.lit(low))).drop("_m", "_p", "_first"))

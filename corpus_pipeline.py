"""The corpus pipeline: quality rules, exact dedup, near dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again for the next one.  All but the last return the
columns of documents, whatever columns those are.  Documents are told apart by
``doc_id`` and text; rows that repeat an id are kept unless a stage's rule drops them.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aurum.llm import blocknames, packing, pfair, quality, simhash
from aurum.llm.common import read_table, ship, stage, text_or_empty
from aurum.llm.queries import BLOCK_DOCS, REST_SHARE, SHARES
from aurum.session import prepare


#: The columns that operators read; all others travel in one struct, whatever their names.
KNOWN = ("doc_id", "text", "lang", "source", "n_chars")
MORE, PLACE = "_more", "_place"
#: Marks the column of run() that holds the place in the mixture, null until mixing.
MARK = {"mixture_place": True}


def _place_of(docs: DataFrame) -> str | None:
    return next((f.name for f in docs.schema if f.metadata == MARK), None)


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _packed(docs: DataFrame) -> DataFrame:
    """The known columns, the place if there is one, and ``MORE`` with the rest."""
    place = _place_of(docs)
    rest = [c for c in docs.columns if c not in KNOWN and c != place]
    return docs.select(*[c for c in docs.columns if c in KNOWN],
                       *([_named(place).alias(PLACE)] if place else []),
                       F.struct(F.lit(0).alias("0"), *[_named(c).alias(f"c{i}") for i, c in enumerate(rest)]).alias(MORE))


def _unpacked(packed: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows of ``_packed`` with the columns of ``docs``."""
    place = _place_of(docs)
    at = {c: f"c{i}" for i, c in enumerate(c for c in docs.columns if c not in KNOWN and c != place)}
    return packed.select(*[F.col(c) if c in KNOWN else F.col(PLACE).alias(c, metadata=MARK) if c == place
                           else F.col(f"{MORE}.{at[c]}").alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    ship(prepare(spark))
    judged = quality.judged(stage(quality.measured(_packed(docs)), "measured"))
    return _unpacked(judged.where("_measures.kept"), docs)


def _key(text_hash: Column) -> Column:
    """A row's identity, of its id and text."""
    return F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), text_hash)


def _one_of_each(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """One row of ``docs`` (with ``_key``) for each ``_key`` in ``kept``: of rows
    equal in id and text, the first by all other columns."""
    rows = docs.join(kept, "_key", "left_semi")
    # rows equal in id and text are one key; the join has dealt them by it already
    others = [F.col(c) for c in rows.columns if c not in ("_key", "doc_id", "text", MORE)]
    first = Window.partitionBy("_key").orderBy(*others, F.to_json(MORE))
    return rows.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_key", "_n")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, one row of the largest ``doc_id`` stays."""
    ship(prepare(spark))
    kept = (blocknames.duplicates(docs.select("doc_id", "text")).where("kept")
            .select(_key(F.col("text_sha256")).alias("_key")))
    keyed = _packed(docs).withColumn("_key", _key(F.sha2(text_or_empty(), 256)))
    return _unpacked(_one_of_each(keyed, kept), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate component, one row stays: of the smallest id (null
    if there is no other), and among its texts that of the smallest hash."""
    ship(prepare(spark))
    keyed = _packed(docs).withColumn("_key", _key(F.sha2(text_or_empty(), 256)))
    return _unpacked(_one_of_each(keyed, simhash.representatives(keyed, "_key", shingle=3, most=3)), docs)


def _placed(packed: DataFrame) -> DataFrame:
    """With ``PLACE``: slot by slot, block by block.  Rows that repeat a
    ``doc_id`` are told apart by their text, so the places are always the same."""
    mixed = pfair.mixed(packed.drop(PLACE), SHARES, REST_SHARE, BLOCK_DOCS, (F.xxhash64(text_or_empty()),))
    return mixed.withColumn(PLACE, F.col("_mix.slot") * BLOCK_DOCS + F.col("_mix.in_block")).drop("_mix")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture; fills the place's column if there is one."""
    ship(prepare(spark))
    return _unpacked(_placed(_packed(docs)).orderBy(PLACE), docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences, which follow the
    mixture: by its place, or, in documents without it, by the same places anew."""
    ship(prepare(spark))
    packed = _packed(docs) if _place_of(docs) else _placed(_packed(docs))
    return packing.pack(packed, public_tokenizers.path("byte_bpe_50k.json"), 1024, 0, PLACE)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
    ("mixing", mixing), ("packing", pack)]

#: SQL cannot express the SimHash and token stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    # file order says nothing to a reader, so the mixture's decision goes in a column
    place = "_mixture_place"
    while place in docs.columns:
        place += "_"
    docs = docs.select("*", F.lit(None).cast("long").alias(place, metadata=MARK))
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

"""Message sources and sinks: Kafka (R1, T1), landing directory (R2).

The Kafka connector jar is not bundled; the reader/writer are plain option
sets and fail with a clear message when the connector is absent.  A landing
directory of JSON lines delivers the same ``value`` column and is what the
tests use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse


# A file stream ignores files older than ``maxFileAge`` before the newest one it
# has seen, 7 days by default, without an error.  Lateness is unlimited here, so
# the age is too (the source then remembers every file name it has read).
FILE_STREAM_OPTIONS = {"maxFileAge": "36500d"}


def kafka_options(bootstrap: str, topic: str, fail_on_data_loss: bool = False) -> dict[str, str]:
    """One topic, from the earliest offset on first start (later the
    checkpoint decides).  By default lost offsets are tolerated, as a topic
    with retention needs; ``fail_on_data_loss`` stops the query instead."""
    return {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": str(bool(fail_on_data_loss)).lower(),
    }


def read_kafka(spark: SparkSession, bootstrap: str, topic: str,
               max_offsets_per_trigger: int | None = 1_000_000,
               fail_on_data_loss: bool = False) -> DataFrame:
    """Streaming Kafka source -> (value STRING, source, src_offset).
    ``max_offsets_per_trigger`` bounds the micro-batch size (each batch is
    persisted once while it feeds bronze, silver and gold)."""
    opts = kafka_options(bootstrap, topic, fail_on_data_loss)
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_offsets_per_trigger))
    try:
        raw = spark.readStream.format("kafka").options(**opts).load()
    except Exception as exc:  # the connector is an optional jar
        raise RuntimeError("Kafka source unavailable: add the spark-sql-kafka "
                           "connector to the session") from exc
    return connector_rows(raw)


def connector_rows(raw: DataFrame) -> DataFrame:
    """Rows as the connector gives them (BINARY ``value``, ``topic``, ``partition``,
    ``offset``) -> (value, source, src_offset)."""
    return raw.select(
        parse.value_as_string(F.col("value")).alias("value"),
        F.concat_ws(":", F.col("topic"), F.col("partition").cast("string")).alias("source"),
        F.col("offset").alias("src_offset"),
    )


def read_landing(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                 glob: str | None = None) -> DataFrame:
    """R2: streaming text source over a landing directory and its sub-folders
    (one message per line) -> (value, source, src_time, src_block); ``placed``
    makes a batch's ``src_offset`` of the last one."""
    r = (spark.readStream.format("text").options(**FILE_STREAM_OPTIONS)
         .option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if glob:
        r = r.option("pathGlobFilter", glob)
    return _located(r.load(path))


def _located(df: DataFrame) -> DataFrame:
    meta = F.col("_metadata")
    return df.select(F.col("value"), meta["file_path"].alias("source"),
                     meta["file_modification_time"].alias("src_time"),
                     meta["file_block_start"].alias("src_block"))


def placed(batch: DataFrame) -> DataFrame:
    """Arrival order of landing messages (O7): ``src_offset`` grows along a file.  It
    is the start of the block that a task read plus the row's place in the task.  A
    block that is not a file's last fills a task alone, and has fewer rows than bytes,
    so the numbers of a file's next block are larger; a file's only or last block may
    share its task, where places still grow.  Numbers compare within one file
    (``source``); files compare by ``src_time``.  Batches only: streams cannot number
    rows.  Batches of other sources are left as they are."""
    if "src_block" not in batch.columns:
        return batch
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return batch.withColumn("src_offset", F.col("src_block") + place).drop("src_block")


def read_landing_batch(spark: SparkSession, path: str) -> DataFrame:
    """Batch read of a landing directory (backfills)."""
    return placed(_located(spark.read.format("text").option("recursiveFileLookup", "true").load(path)))


def write_messages(messages: DataFrame, path: str, partitions: int,
                   key_cols: list[str]) -> None:
    """T1 (offline form): keyed JSON lines.  Rows are hash-partitioned on the
    key so every copy of a key lands in the same file, as a keyed topic keeps
    one key in one partition."""
    (messages.repartition(partitions, *[F.col(c) for c in key_cols])
             .select("value").write.mode("append").text(path))


def write_kafka(messages: DataFrame, bootstrap: str, topic: str, key_col: str = "key") -> None:
    """Keyed message sink (key = the reading's key)."""
    (messages.select(F.col(key_col).cast("string").alias("key"), F.col("value"))
             .write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
             .option("topic", topic).save())

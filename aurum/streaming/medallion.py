"""Structured Streaming drivers of the medallion.

Two shapes over the same batch functions:

* ``start_medallion``: one query whose ``foreachBatch`` runs bronze -> silver
  -> gold for each micro-batch (X1).
* ``start_bronze`` / ``start_silver`` / ``start_gold``: three queries chained
  through tables, each with its own checkpoint and trigger (X3-X5):
  source -> bronze log (file sink, exactly once through its metadata log),
  bronze log -> silver (insert-if-absent), silver -> gold (touched buckets).

No batch is collected: only the touched day list (a handful of dates) and two
counts reach the driver.  Late rows are accepted without a watermark (X6); a
replayed batch leaves silver and gold unchanged (X7).
"""

from __future__ import annotations

import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import session
from ..functions import parse
from ..operators import backfill, incremental, merge, silver
from ..schemas import BRONZE_SCHEMA
from ..sources.store import MedallionStore
from ..sources.streams import FILE_STREAM_OPTIONS, placed

BRONZE_LOG = "bronze_log"  # bronze table of the three-query form (file sink)
BRONZE_LOG_SCHEMA = StructType([f for f in BRONZE_SCHEMA.fields if f.name != "batch_id"])


def _opt(batch: DataFrame, name: str, typ: str):
    return (F.col(name) if name in batch.columns else F.lit(None)).cast(typ).alias(name)


def bronze_rows(batch: DataFrame) -> DataFrame:
    """Every message as received; malformed ones are flagged, not lost.
    Accepts raw (``value``) or already decoded batches.  In a stream, rows of landing
    files have the start of their block as position: a block's rows lie in their order
    in one file of the log."""
    if "src_block" in batch.columns:
        batch = batch.withColumnRenamed("src_block", "src_offset")
    decoded = batch if "is_malformed" in batch.columns else parse.decode_json(batch, "value")
    return decoded.select(
        F.col("value").alias("raw_json"), _opt(decoded, "source", "string"),
        _opt(decoded, "src_offset", "bigint"), _opt(decoded, "src_time", "timestamp"), F.col("is_malformed"),
        F.current_timestamp().alias("ingested_at"))


def write_bronze(lake: MedallionStore, decoded: DataFrame, batch_id: int,
                 observation: Observation | None = None) -> None:
    """Bronze folder of this batch id; a replay of the batch rewrites it.
    ``observation`` collects the batch counts during the same write (A10).  Folders of
    days that have ended are merged."""
    rows = (bronze_rows(decoded).withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
            .withColumn("slice", F.lit(lake.bronze_slice(int(batch_id)))))
    if observation is not None:
        rows = rows.observe(observation, F.count(F.lit(1)).alias("n"),
                            F.count_if("is_malformed").alias("bad"))
    merge.write_partitioned(rows, lake.path("bronze"), "slice", "overwrite")
    lake.merge_bronze()


def silver_of(messages: DataFrame, lake: MedallionStore) -> DataFrame:
    return silver.to_silver(parse.parse_messages(messages, "value", lake.cfg), lake.cfg)


def process_batch(lake: MedallionStore, batch: DataFrame, batch_id: int,
                  gold_days: list | None = None) -> dict:
    """One micro-batch through all layers; returns the run-log row.
    The batch is persisted once, decoded and typed, and feeds bronze and silver, so
    each message is parsed and typed once per batch, in one pass."""
    decoded = parse.typed_beside(parse.decode_json(placed(batch), "value"), lake.cfg)
    decoded = decoded.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        obs = Observation(f"batch-{batch_id}")
        with session.plain_cache(batch.sparkSession):
            write_bronze(lake, decoded, batch_id, obs)
        m = obs.get
        row = {"batch_id": int(batch_id), "messages_in": int(m.get("n") or 0),
               "malformed": int(m.get("bad") or 0), "silver_rows": 0, "silver_inserted": 0,
               "touched_days": 0}
        if row["messages_in"] == 0:  # empty batch, nothing else to write
            return row
        sb = silver.to_silver(decoded.where(~F.col("is_malformed")).drop("is_malformed"), lake.cfg)
        sb = sb.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            summary = incremental.batch_summary(sb, lake.cfg)
            row["silver_rows"] = summary["rows"]
            if len(summary["days"]) > lake.cfg.max_touched_days:
                done = _backfill(lake, sb, "batch", batch_id, backfill.BOTH, gold_days)
                row["silver_inserted"], row["touched_days"] = done["inserted"], len(summary["days"])
            elif summary["rows"]:
                row["silver_inserted"] = incremental.write_silver(lake, sb, summary)
                if gold_days is None:
                    row["touched_days"] = incremental.refresh_gold(lake, sb, None, summary)
                else:
                    row["touched_days"] = incremental.refresh_gold(lake, sb, gold_days)
        finally:
            sb.unpersist()
        log_run(lake, row)
        return row
    finally:
        decoded.unpersist()


def _backfill(lake: MedallionStore, rows: DataFrame, tier: str, batch_id: int, steps: tuple[str, ...],
              gold_days: list | None = None) -> dict:
    """A batch of very many days in ranges; its replay goes on with the first range that is not done."""
    job = f"{tier}-{int(batch_id)}"
    if not session.path_exists(lake.spark, f"{lake.root}/backfill/{job}"):
        backfill.forget(lake, f"{tier}-")  # of earlier batches, which are never replayed again
    return backfill.run(lake, rows, job, steps=steps, gold_days=gold_days)


def log_run(lake: MedallionStore, row: dict) -> None:
    """A10: append one summary row per processed batch."""
    schema = lake.schema("runlog")
    names = [f.name for f in schema.fields if f.name != "logged_at"]
    df = lake.spark.createDataFrame(
        [tuple(row.get(n) for n in names)],
        StructType([f for f in schema.fields if f.name != "logged_at"]))
    (df.withColumn("logged_at", F.current_timestamp())
       .write.mode("append").parquet(lake.path("runlog")))


def _age(micros: int | None) -> float | None:
    return None if micros is None else round(time.time() - micros / 1e6, 3)


def _trigger(w, trigger: dict | None):
    return w.trigger(**(trigger or {"availableNow": True}))


def check_pairing(spark: SparkSession, checkpoint: str, output: str, sign: str | tuple[str, ...]) -> None:
    """Refuse a new checkpoint on an output that already holds batches (any
    entry that starts with ``sign``; the first batch may have been empty): batch
    ids restart at 0, so the bronze folders (or the file sink's log) of the
    old run would be overwritten or new input silently skipped."""
    held = any(n.startswith(sign) for n in session.child_names(spark, output))
    if held and not session.path_exists(spark, checkpoint):
        raise RuntimeError(f"{output} already holds data but checkpoint {checkpoint} is new; "
                           "reuse its checkpoint or write to a new table root")


def start_medallion(source: DataFrame, lake: MedallionStore, checkpoint: str,
                    trigger: dict | None = None, gold_days_fn=None):
    """X1 + T4: one streaming query with a fault-tolerant batch sink."""
    check_pairing(lake.spark, checkpoint, lake.path("bronze"), ("slice=", "batch_id="))
    lake.ensure_tables()
    lake.adopt_bronze()

    def run(df, bid):
        process_batch(lake, df, bid, gold_days_fn() if gold_days_fn else None)

    w = source.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def start_bronze(source: DataFrame, lake: MedallionStore, checkpoint: str,
                 trigger: dict | None = None):
    """Tier 1: source -> bronze log (append-only Parquet file sink)."""
    check_pairing(lake.spark, checkpoint, lake.path(BRONZE_LOG), "_spark_metadata")
    w = (bronze_rows(source).writeStream.format("parquet")
         .option("path", lake.path(BRONZE_LOG)).option("checkpointLocation", checkpoint))
    return _trigger(w, trigger).start()


def start_silver(spark: SparkSession, lake: MedallionStore, checkpoint: str,
                 trigger: dict | None = None, max_files_per_trigger: int | None = None):
    """Tier 2 (X4): new bronze files -> silver, insert-if-absent.  The stream
    checkpoint replaces the reference's ``processed`` flag (T6, F10).  Each batch
    logs its counts and lag (A10) before it is committed, so no run is lost with the
    driver, as an event to a listener would be."""
    lake.ensure_tables()
    r = spark.readStream.schema(BRONZE_LOG_SCHEMA).options(**FILE_STREAM_OPTIONS)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    src = r.parquet(lake.path(BRONZE_LOG)).select(
        F.col("raw_json").alias("value"), "source", "src_offset", "src_time", "is_malformed", "ingested_at",
        F.col("_metadata.row_index").alias("src_place"))

    def run(df, bid):
        obs = Observation(f"silver-{bid}")
        seen = df.observe(obs, F.count(F.lit(1)).alias("n"), F.count_if("is_malformed").alias("bad"),
                          F.unix_micros(F.max("ingested_at")).alias("newest"))
        good = seen.where(~F.col("is_malformed")).drop("is_malformed", "ingested_at")
        sb = silver_of(good, lake).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            summary = incremental.batch_summary(sb, lake.cfg)
            m = obs.get
            row = {"tier": "silver", "batch_id": int(bid), "messages_in": int(m.get("n") or 0),
                   "malformed": int(m.get("bad") or 0), "silver_rows": summary["rows"], "silver_inserted": 0,
                   "touched_days": len(summary["days"]), "lag_s": _age(m.get("newest"))}
            if len(summary["days"]) > lake.cfg.max_touched_days:
                row["silver_inserted"] = _backfill(lake, sb, "silver", bid, ("silver",))["inserted"]
            elif summary["rows"]:
                row["silver_inserted"] = incremental.write_silver(lake, sb, summary)
            log_run(lake, row)
        finally:
            sb.unpersist()

    w = src.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def start_gold(spark: SparkSession, lake: MedallionStore, checkpoint: str,
               trigger: dict | None = None, gold_days_fn=None):
    """Tier 3 (X5): new silver files -> gold refresh of the touched buckets.
    ``gold_days_fn()`` may return a day list to refresh (e.g. today only);
    default: every touched day, so late rows reach gold too."""
    lake.ensure_tables()
    src = (spark.readStream.schema(lake.schema("silver")).options(**FILE_STREAM_OPTIONS)
           .parquet(lake.path("silver")))

    def run(df, bid):
        df = df.persist(StorageLevel.MEMORY_AND_DISK)  # read once for the summary and the pairs
        try:
            summary = incremental.batch_summary(df, lake.cfg)
            newest = df.agg(F.unix_micros(F.max("ingested_at"))).first()[0]
            days, only = len(summary["days"]), gold_days_fn() if gold_days_fn else None
            if days > lake.cfg.max_touched_days:
                _backfill(lake, df, "gold", bid, ("gold",), only)
            else:
                days = incremental.refresh_gold(lake, df, only, summary)
            log_run(lake, {"tier": "gold", "batch_id": int(bid), "silver_rows": summary["rows"],
                           "touched_days": days, "lag_s": _age(newest)})
        finally:
            df.unpersist()

    w = src.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def run_tiers_available_now(spark: SparkSession, source: DataFrame, lake: MedallionStore,
                            checkpoint_root: str) -> None:
    """Drain the three tiers once, in order (backfills and tests)."""
    cp = checkpoint_root.rstrip("/")
    for q in (lambda: start_bronze(source, lake, f"{cp}/bronze"),
              lambda: start_silver(spark, lake, f"{cp}/silver"),
              lambda: start_gold(spark, lake, f"{cp}/gold")):
        query = q()
        query.awaitTermination()
        if query.exception():
            raise query.exception()

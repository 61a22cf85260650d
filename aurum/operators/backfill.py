"""Bounded backfills (X2, X6): a batch of many days, worked off in ranges of days.

The rows are staged once, in a folder for each range; the ranges then go through
silver and gold one after another, oldest first, and a numbered record beside them
says which are done.  A job that dies goes on with the first range that is not:
ranges are idempotent, so the one it died in is simply done again.  What a range
reads, broadcasts and rewrites follows its days and rows, not the batch's.

    backfill/<job>/rows/range=N/   silver rows of days [N * days, (N + 1) * days) since 1970
    backfill/<job>/_progress/      days of a range, rows inserted by each range done

A job that is called again after its end does nothing, whatever its rows.  Empty
batches and null days (which silver has none of) give no range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import session
from ..sources.store import MedallionStore
from ..sources.versioned import NumberedFile
from . import incremental, merge

#: Days of a range.
DAYS = 64
BOTH = ("silver", "gold")


def _record(lake: MedallionStore, job: str) -> NumberedFile:
    return NumberedFile(lake.spark, f"{lake.root}/backfill/{job}/_progress")


def _stage(lake: MedallionStore, rows: DataFrame, path: str, days: int) -> None:
    """Unless a whole copy is there from the run before."""
    if not session.path_exists(lake.spark, f"{path}/_SUCCESS"):
        session.delete(lake.spark, path)
        place = F.floor(F.datediff("day", F.lit("1970-01-01").cast("date")) / F.lit(days)).cast("int")
        rows = lake.conform("silver", rows).select(*lake.schema("silver").names)
        merge.write_partitioned(rows.where(F.col("day").isNotNull()).withColumn("range", place), path, "range", "error")


def run(lake: MedallionStore, silver_rows: DataFrame, job: str, days: int = DAYS,
        steps: tuple[str, ...] = BOTH, gold_days: list | None = None, most: int | None = None) -> dict:
    """Put ``silver_rows`` (unique on their key) into silver and gold, or one of the two
    (``steps``), in ranges of ``days`` days.  ``most`` ends this call after so many ranges;
    call again to go on.  ``gold_days`` limits the refresh.  Returns the job's ranges so
    far: ``done``, ``left``, and the rows ``inserted`` by calls that recorded their range."""
    spark, record = lake.spark, _record(lake, job)
    n, state = record.latest()
    if state is None:
        state = {"days": int(days), "done": {}, "finished": False}
        n = record.publish(n, state)
    rows, left = f"{lake.root}/backfill/{job}/rows", []
    if not state["finished"]:
        _stage(lake, silver_rows, rows, state["days"])
        found = (int(f[6:]) for f in session.child_names(spark, rows) if f.startswith("range="))
        left = sorted(r for r in found if str(r) not in state["done"])
        for r in left[:most]:
            part = spark.read.schema(lake.schema("silver")).parquet(f"{rows}/range={r}")
            summary, inserted = incremental.batch_summary(part, lake.cfg), 0
            if "silver" in steps:
                inserted = incremental.write_silver(lake, part, summary)
            if "gold" in steps:
                incremental.refresh_gold(lake, part, gold_days, None if gold_days else summary)
            state["done"][str(r)] = inserted
            n = record.publish(n, state)
        left = left[len(left[:most]):]
        if not left:
            state["finished"] = True
            record.publish(n, state)
            session.delete(spark, rows)
    return {"done": len(state["done"]), "left": len(left), "inserted": sum(state["done"].values())}


def forget(lake: MedallionStore, jobs: str) -> list[str]:
    """Remove the records of finished jobs whose names begin with ``jobs``."""
    gone = [j for j in session.child_names(lake.spark, f"{lake.root}/backfill")
            if j.startswith(jobs) and (_record(lake, j).latest()[1] or {}).get("finished")]
    for j in gone:
        session.delete(lake.spark, f"{lake.root}/backfill/{j}")
    return gone

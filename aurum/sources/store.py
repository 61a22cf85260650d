"""Path-based medallion tables: layout, set-up (T11), tolerant reads (R5),
touched-key scans (R4, R6), retention (T14) and catalog registration.

Tables live below one root on a shared file system:

    bronze/   raw messages, partitioned by slice: a micro-batch (replay-safe) or merged ones of a day
    silver/   clean readings, partitioned by ``day``
    latest/   one row per key, partitioned by ``bucket`` (hash of the key)
    hourly/   (key, hour) stats, partitioned by ``day``
    daily/    (key, day) stats, partitioned by ``day``
    runlog/   rows per processed micro-batch (``run_log`` gives the last one of each)
    partials/ mergeable states per (key, hour), partitioned by ``day``
    pending/  rows on their way into partials and silver, a folder for each insert
    late/     rows of days that retention has dropped, partitioned by ``day``
    *.v/      replaced and compacted partitions of a table, and which of them count
    _layout.d bucket count and zone the tables were written with, retention day
"""

from __future__ import annotations

import datetime as dt
import json
import re
import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from .. import schemas, session
from ..config import DEFAULT, Config
from .versioned import NumberedFile, Versioned

SPECS = {
    # name: (schema, partition column)
    "bronze": (schemas.BRONZE_SCHEMA, "slice"),
    "silver": (schemas.SILVER_SCHEMA, "day"),
    "latest": (schemas.LATEST_SCHEMA, "bucket"),
    "hourly": (schemas.HOURLY_SCHEMA, "day"),
    "daily": (schemas.DAILY_SCHEMA, "day"),
    "partials": (schemas.PARTIALS_SCHEMA, "day"),
    "late": (schemas.SILVER_SCHEMA, "day"),
    "runlog": (schemas.RUN_LOG_SCHEMA, None),
}


# --- fixed values: the warehouse's schema-qualified table names -------------
SQL_NAMES = {
    "bronze": "bronze.raw_messages",
    "silver": "silver.weather_readings",
    "latest": "gold.city_latest",
    "hourly": "gold.hourly_stats",
    "daily": "gold.daily_stats",
    "partials": "gold.partial_states",
    "late": "silver.late_readings",
    "runlog": "ops.run_log",
}
# ------------------------------------------------------------------------------


#: Tables that ``add_column`` takes; the others hold what the engine itself needs.
COLUMNS_MAY_BE_ADDED = ("silver", "latest", "hourly", "daily")


def _type_of(sql_type: str) -> DataType:
    return DataType.fromDDL(sql_type)


def _is_missing_path(exc: AnalysisException) -> bool:
    cond = exc.getCondition() if hasattr(exc, "getCondition") else exc.getErrorClass()
    return cond == "PATH_NOT_FOUND"


class MedallionStore:
    def __init__(self, spark: SparkSession, root: str, cfg: Config = DEFAULT):
        self.spark = spark
        self.root = root.rstrip("/")
        self.cfg = cfg
        self._columns: dict | None = None  # columns added to the stored tables
        session.prepare(spark)  # parsing and buckets need the clock pinned to UTC

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def schema(self, name: str) -> StructType:
        """The declared columns, those added to the stored table, the partition column."""
        base, part = SPECS[name]
        if self._columns is None:
            self._columns = (self._stored_layout()[1] or {}).get("columns", {})
        added = self._columns.get(name)
        if not added:
            return base
        # files without the column read as its default
        more = [StructField(c, _type_of(t), True, {"CURRENT_DEFAULT": d, "EXISTS_DEFAULT": d}) for c, t, d in added]
        return StructType([f for f in base if f.name != part] + more + [f for f in base if f.name == part])

    def conform(self, name: str, rows: DataFrame) -> DataFrame:
        """``rows`` with the columns added to the stored table, as their default where missing."""
        self.schema(name)
        return rows.withColumns({c: F.expr(f"CAST({d} AS {t})") for c, t, d in self._columns.get(name, [])
                                 if c not in rows.columns})

    def add_column(self, name: str, column: str, sql_type: str, default_sql: str = "NULL") -> bool:
        """Add a column to a stored table unless it has it.  The layout records it, so
        every reader and writer of the store has it from its next batch on; rows stored
        before, and rows written without it, have the default (a literal).  Rows of
        gold that a refresh replaces take the default again."""
        if name not in COLUMNS_MAY_BE_ADDED:
            raise ValueError(f"columns can be added to {', '.join(COLUMNS_MAY_BE_ADDED)}")
        self.layout()
        if column in self.schema(name).names:
            return False
        self.spark.range(1).select(F.expr(f"CAST({default_sql} AS {sql_type})")).collect()  # raises if it does not fit
        n, layout = self._stored_layout()
        columns = dict(layout.get("columns", {}))
        for table in ("silver", "late") if name == "silver" else (name,):  # late rows are silver's
            columns[table] = [*columns.get(table, []), [column, sql_type, default_sql]]
        self._layouts().publish(n, {**layout, "columns": columns})
        self._columns = columns
        return True

    def partition_col(self, name: str):
        return SPECS[name][1]

    def table(self, name: str) -> Versioned:
        """A partitioned table, with atomic replacement of its partitions."""
        return Versioned(self.spark, self.path(name), self.schema(name), self.partition_col(name))

    # ------------------------------------------------------------- layout
    def _layouts(self) -> NumberedFile:
        return NumberedFile(self.spark, f"{self.root}/_layout.d")

    def _stored_layout(self) -> tuple[int, dict | None]:
        n, layout = self._layouts().latest()
        if layout is None:  # as written by earlier versions
            text = session.read_small(self.spark, f"{self.root}/_layout")
            layout = json.loads(text) if text else None
        return n, layout

    def layout(self) -> dict:
        """Bucket count, zone and retention day of the stored tables, as they are
        now.  The first use fixes the first two; a configuration that differs later
        is refused, because stored rows would sit in buckets or days the new one
        does not visit (see ``rebucket``).  So are tables without a layout: what
        retention has dropped from them would be unknown."""
        n, layout = self._stored_layout()
        if layout is None:
            held = [name for name, (_, part) in SPECS.items() if part == "day" or name == "latest"
                    if any(c.startswith(f"{part}=") for c in session.child_names(self.spark, self.path(name)))
                    or self.table(name).manifest.numbers()]
            if held:
                raise RuntimeError(f"{self.root} holds {', '.join(held)} but no layout; restore _layout.d")
            layout = {"latest_buckets": self.cfg.latest_buckets, "tz": self.cfg.tz, "silver_from": None}
            self._layouts().publish(n, layout)
        if layout.get("unfinished"):
            raise RuntimeError(f"{self.root}: {layout['unfinished']} did not finish; run it again")
        self._columns = layout.get("columns", {})
        for key in ("latest_buckets", "tz"):
            if layout[key] != getattr(self.cfg, key):
                raise ValueError(f"{self.root} was written with {key}={layout[key]!r}, not "
                                 f"{getattr(self.cfg, key)!r}")
        return layout

    def rebucket(self) -> None:
        """Rewrite ``latest`` for this configuration's bucket count and record
        it.  The layout is marked first, so that no stream writes until the
        rows have been switched to; if the job dies in between, run it again
        (reads are right all the time)."""
        from ..operators import gold
        n, layout = self._stored_layout()
        layout = {**(layout or {"tz": self.cfg.tz, "silver_from": None}), "latest_buckets": self.cfg.latest_buckets}
        n = self._layouts().publish(n, {**layout, "unfinished": "rebucket"})
        old = self.read("latest").drop("bucket")
        self.table("latest").replace(gold.with_latest_bucket(old, self.cfg), None)
        self._layouts().publish(n, {k: v for k, v in layout.items() if k != "unfinished"})

    def silver_from(self) -> str | None:
        """The first day retention has kept, if it has dropped any.  Read from
        the store each time: another job may have run retention."""
        layout = self._stored_layout()[1]
        return layout.get("silver_from") if layout else None

    def run_log(self) -> DataFrame:
        """A10: one row per tier and batch, the last one logged (a replay logs again).  What
        the batch inserted is the sum over its runs: a replay inserts the rest."""
        keys = ["tier", "batch_id"]
        names = [c for c in self.schema("runlog").names if c not in (*keys, "silver_inserted")]
        last = F.max(F.struct("logged_at", *[c for c in names if c != "logged_at"])).alias("r")
        return (self.read("runlog").fillna("medallion", ["tier"]).groupBy(*keys)
                .agg(last, F.sum("silver_inserted").alias("silver_inserted"))
                .select(*keys, *[f"r.{c}" for c in names], "silver_inserted"))

    def run_gaps(self) -> DataFrame:
        """Batches between the first and last logged of a tier that are not in the log:
        (tier, after, missing).  Empty batches of the one-query form are not logged."""
        before = F.lag("batch_id").over(Window.partitionBy("tier").orderBy("batch_id"))
        return (self.run_log().select("tier", "batch_id", before.alias("after"))
                .where("batch_id > after + 1")
                .select("tier", "after", (F.col("batch_id") - F.col("after") - 1).alias("missing")))

    def ensure_tables(self) -> MedallionStore:
        """Create every table that does not exist yet (idempotent)."""
        self.layout()
        for name, (_, part) in SPECS.items():
            schema = self.schema(name)
            w = self.spark.createDataFrame([], schema).write.mode("ignore")
            if part:
                w = w.partitionBy(part)
            w.parquet(self.path(name))
        return self

    def read(self, name: str) -> DataFrame:
        """Typed read; a table that does not exist reads as empty.  Any
        other failure surfaces."""
        schema = self.schema(name)
        if name == "bronze":
            return self._bronze()
        try:
            if self.partition_col(name):
                return self.table(name).read()
            return self.spark.read.schema(schema).parquet(self.path(name))
        except AnalysisException as exc:
            if _is_missing_path(exc):
                return self.spark.createDataFrame([], schema)
            raise

    # ------------------------------------------------------------- bronze
    def _batches(self, names: list[str]) -> list[tuple[int, str]]:
        """(batch id, slice) of the batch folders among ``names``, in order of id."""
        found = (re.fullmatch(r"slice=(.*\.b(\d+))", n) for n in names)
        return sorted((int(m[2]), m[1]) for m in found if m)

    def _bronze(self, slices: list[str] | None = None) -> DataFrame:
        """Bronze rows of all or some slices; folders of stores that had one for each
        batch id (``batch_id=12``) are read with them."""
        table, names = self.table("bronze"), session.child_names(self.spark, self.path("bronze"))
        if slices is None:
            slices = sorted({f.split("=", 1)[1] for f in [*names, *table.state()[1]["parts"]] if f.startswith("slice=")})
        # rows of folders that were renamed have their batch id in the slice alone
        of_slice = F.regexp_extract("slice", r"\.b(\d+)$", 1)
        rows = table.read(slices).withColumn("batch_id", F.coalesce(
            "batch_id", F.when(of_slice != "", of_slice.cast("bigint")))).select(*table.schema.names)
        old = [f"{self.path('bronze')}/{n}" for n in names if n.startswith("batch_id=")]
        if old:
            kept = StructType([f for f in table.schema if f.name != "slice"])
            more = self.spark.read.schema(kept).option("basePath", self.path("bronze")).parquet(*old)
            day = F.date_format("ingested_at", "yyyy-MM-dd")
            rows = rows.unionByName(more.withColumn("slice", F.concat(day, F.lit(".b"), F.col("batch_id"))))
        return rows

    def adopt_bronze(self) -> int:
        """Rename the batch folders of an earlier version to slices of the day they were
        written on; returns their number.  Each is one rename: a job that dies goes on."""
        old = [n for n in session.child_names(self.spark, self.path("bronze")) if n.startswith("batch_id=")]
        for n in old:
            at = f"{self.path('bronze')}/{n}"
            day = dt.datetime.fromtimestamp(time.time() - session.age(self.spark, at), dt.timezone.utc).date()
            session.rename(self.spark, at, f"{self.path('bronze')}/slice={day}.b{n.split('=')[1]}")
        return len(old)

    def bronze_slice(self, batch_id: int, today: dt.date | None = None) -> str:
        """The slice of a batch: where an earlier delivery has put it, or a new one of
        today (UTC).  Only the newest batch can be replayed, and that is never merged."""
        held = dict(self._batches(session.child_names(self.spark, self.path("bronze"))))
        return held.get(batch_id) or f"{today or dt.datetime.now(dt.timezone.utc).date()}.b{batch_id}"

    def merge_bronze(self, force: bool = False) -> int:
        """Merge bronze's batch folders, but for the newest, into one slice a day, when
        a day has ended or ``Config.bronze_open_batches`` are open (or ``force``).  Each
        batch is rewritten once, so a day has a bounded number of folders whatever the
        trigger, and the merged files are as large as AQE makes them.  The switch is one
        manifest; merged folders go an hour later.  Returns the batches merged."""
        table = self.table("bronze")
        known = table.state()[1]["parts"]
        held = self._batches([n for n in session.child_names(self.spark, table.path) if n not in known])
        if not held or not (force or len(held) > self.cfg.bronze_open_batches or held[0][1][:10] < held[-1][1][:10]):
            return 0
        last = {s[:10]: b for b, s in held[:-1]}  # by day, its newest batch
        slices = [s for _, s in held[:-1]]
        if not slices:
            return 0
        names = F.create_map(*[F.lit(x) for d, b in last.items() for x in (d, f"{d}.m{b}")])
        rows = table.read(slices).withColumn("batch_id", F.coalesce(
            "batch_id", F.regexp_extract("slice", r"\.b(\d+)$", 1).cast("bigint")))
        table.replace(rows.withColumn("slice", names[F.substring("slice", 1, 10)]), slices,
                      order=["batch_id", "source", "src_offset"], forget=True)
        return len(slices)

    def silver_for_keys(self, touched: DataFrame, days: list | None = None,
                        broadcast: bool = False) -> DataFrame:
        """R4 + J3: every silver row of the touched (city, day) pairs; the day
        list, when given, prunes partitions at the scan.  ``broadcast`` only
        when the caller has bounded the number of pairs."""
        s = self.read("silver") if days is None else self.table("silver").read(days)
        pairs = touched.select("city", "day").distinct()
        return s.join(F.broadcast(pairs) if broadcast else pairs, ["city", "day"], "left_semi")

    def keys_on_day(self, day) -> DataFrame:
        """Distinct keys seen on a day."""
        return self.table("silver").read([day]).select("city").distinct()

    def drop_days_before(self, name: str, day) -> list[str]:
        """Retention by partition; deletes whole ``day=`` directories
        older than ``day`` and returns them.  Only directory names are listed,
        no data is read.  For silver the day is recorded in the store: rows of
        older days that arrive later go to ``late`` and leave gold as it is,
        since it could only be recomputed from them alone."""
        cutoff = str(day)
        if name == "silver":  # recorded before anything goes
            self.layout()
            n, layout = self._stored_layout()
            if layout["silver_from"] is None or layout["silver_from"] < cutoff:
                self._layouts().publish(n, {**layout, "silver_from": cutoff})
        table = self.table(name)
        # a slice of bronze begins with its day
        head = f"{table.part}="
        old = lambda names: {f for f in names if f.startswith(head) and f[len(head):][:10] < cutoff}
        if table.part not in ("day", "slice"):
            raise ValueError(f"{name} is not kept by day")
        in_place, versioned = old(session.child_names(self.spark, self.path(name))), old(table.state()[1]["parts"])
        for f in in_place:
            session.delete(self.spark, f"{self.path(name)}/{f}")
        table.drop(sorted(versioned))
        if name == "silver":  # their states can take up no more rows
            self.drop_days_before("partials", day)
        return sorted(f[len(head):] for f in in_place | versioned)

    def compact(self, name: str, values: list, by: str = "time") -> int:
        """Rewrite the given partitions (e.g. yesterday's silver day) into
        AQE-sized files; rows are unchanged.  Streaming appends leave at least
        one file per micro-batch and touched partition.  The new files lie
        beside the old ones and are switched to at once; rows appended to such a
        day later are read as well.  ``table(name).vacuum()`` removes the old files,
        when the gold stream has read them.  ``by="key"`` gives each file a range of
        keys, so that reads of one key open few row groups; late rows of such a day
        are compared with all its keys."""
        part = self.partition_col(name)
        if not part or not values:
            return 0
        table = self.table(name)
        parts = table.state()[1]["parts"]
        # rows go on being appended to these tables: name the files that the new ones stand for
        in_place = {f: sorted({*table._files(f), *((parts.get(f) or {}).get("without") or [])})
                    for f in map(table.folder, values)} if name in ("silver", "late") else None
        if by not in ("time", "key"):
            raise ValueError("by must be time or key")
        timed = next((c for c in ("event_time", "hour_start") if c in table.schema.names), None)
        cluster = ["city", *([timed] if timed else [])] if by == "key" else None
        order = ["event_time"] if name in ("silver", "late") else None
        table.replace(table.read(values), values, in_place, order, cluster=cluster)
        return len(values)

    def register_catalog(self, database: str = "weather", names: dict | None = None) -> None:
        """Expose the tables as external catalog tables for SQL users, as
        ``database.<table>`` or, with ``names``, under qualified names of
        their own (see ``SQL_NAMES``)."""
        for name, (_, part) in SPECS.items():
            schema = self.schema(name)
            qualified = (names or {}).get(name, f"{database}.{name}")
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {qualified.split('.')[0]}")
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + (
                f" DEFAULT {f.metadata['EXISTS_DEFAULT']}" if f.metadata else "") for f in schema.fields)
            parted = f" PARTITIONED BY ({part})" if part else ""
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {qualified} ({cols}) USING parquet"
                f"{parted} LOCATION '{self.path(name)}'")
            if part:
                self._recover(name, qualified)

    def _recover(self, name: str, qualified: str) -> None:
        """Catalog partitions as the table's folders and manifest have them.  A
        compacted silver day shows rows appended since when it is compacted again."""
        self.spark.sql(f"ALTER TABLE {qualified} RECOVER PARTITIONS")
        for folder, e in self.table(name).state()[1]["parts"].items():
            if e.get("since"):  # merged into another one
                key, value = folder.split("=", 1)
                self.spark.sql(f"ALTER TABLE {qualified} DROP IF EXISTS PARTITION ({key}='{value}')")
        for folder, where in self.table(name).locations().items():
            key, value = folder.split("=", 1)
            spec = f"PARTITION ({key}='{value}')"
            self.spark.sql(f"ALTER TABLE {qualified} ADD IF NOT EXISTS {spec} LOCATION '{where}'")
            self.spark.sql(f"ALTER TABLE {qualified} {spec} SET LOCATION '{where}'")

    def refresh_catalog(self, names: dict | None = None, database: str = "weather") -> None:
        """Pick up partitions written since registration."""
        for name, (_, part) in SPECS.items():
            qualified = (names or {}).get(name, f"{database}.{name}")
            if part:
                self._recover(name, qualified)
            self.spark.catalog.refreshTable(qualified)


def add_column_if_missing(spark: SparkSession, table: str, column: str, sql_type: str,
                          default_sql: str) -> bool:
    """Add a column with a default to a catalog table unless present; old
    rows read the default."""
    if column in spark.table(table).columns:
        return False
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({column} {sql_type} DEFAULT {default_sql})")
    return True

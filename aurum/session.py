"""Session helpers: a tuned local session for tests/bench, and a shared scratch
folder derived from ``spark.checkpoint.dir``.

On a cluster the checkpoint directory names a shared file system (HDFS, object
store); every table written by the library for lineage cutting or staging goes
below it.  Only when it is unset (tests, local runs) do we create one.
"""

from __future__ import annotations

import contextlib
import tempfile
import time
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession


def get_session(master: str = "local[*]", app: str = "aurum",
                shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session clock to UTC; all zone handling is explicit (Config.tz).
    Times are stored as 64-bit microseconds, which keep statistics per row group
    (the 96-bit form, Spark's default, has none)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    return spark


@contextlib.contextmanager
def plain_cache(spark: SparkSession) -> Iterator[None]:
    """Rows persisted and first read in here are kept uncompressed: for rows that are
    read two or three times, compressing them costs more time than it saves."""
    name = "spark.sql.inMemoryColumnarStorage.compressed"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for staged tables; read from the session, set only if unset."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder: staged "
                                   "tables must survive the loss of any one machine")
            root = tempfile.mkdtemp(prefix="aurum-ckpt-")  # local runs and tests only
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared scratch root (never reused)."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if it does not exist."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_small(spark: SparkSession, path: str) -> str | None:
    """A small text file as a string; None if it does not exist."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file that must not exist: beside it, then renamed, so
    that no reader ever sees a part of it."""
    fs, p = _fs(spark, path)
    beside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(p) or not fs.rename(beside, p):
        raise OSError(f"could not write {path}")


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file or folder to a name that must not exist."""
    fs, p = _fs(spark, path)
    target = _fs(spark, to)[1]
    if fs.exists(target) or not fs.rename(p, target):
        raise OSError(f"could not rename {path} to {to}")


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def total_size(spark: SparkSession, files: list[str]) -> int:
    """Bytes of some files, named as URIs; each folder is listed once."""
    uri = spark.sparkContext._jvm.java.net.URI
    names: dict[str, set[str]] = {}
    for f in files:
        folder, name = f.rsplit("/", 1)
        names.setdefault(folder, set()).add(name)
    total = 0
    for folder, held in names.items():
        fs, p = _fs(spark, uri(folder))
        total += sum(s.getLen() for s in fs.listStatus(p) if s.getPath().toUri().getRawPath().rsplit("/", 1)[-1] in held)
    return total


def age(spark: SparkSession, path: str) -> float:
    """Seconds since a file or folder was last changed."""
    fs, p = _fs(spark, path)
    return time.time() - fs.getFileStatus(p).getModificationTime() / 1000


def set_age(spark: SparkSession, folder: str, days: int) -> None:
    """Date the files below a folder back, as a copy that keeps old dates does."""
    fs, p = _fs(spark, folder)
    then = int((time.time() - days * 86_400) * 1000)
    for s in fs.listStatus(p):
        if s.isFile():
            fs.setTimes(s.getPath(), then, -1)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check on any Hadoop file system (local, HDFS, object store)."""
    fs, p = _fs(spark, path)
    return fs.exists(p)

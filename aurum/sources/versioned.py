"""Atomic partition replacement for path tables.

A partitioned Parquet table at ``path`` may have a folder ``path.v`` beside it:

    path/day=D/*.parquet              rows appended in place
    path.v/ver=.../day=D/*.parquet    rows of one replacement
    path.v/_manifest/000000007.json   which partition is read from where

A replacement writes its partitions into a folder of its own and then publishes
the next manifest, by one rename of a file that is already whole.  A reader takes
the newest manifest; a partition that it names is read from its version, all
others from ``path``.  A job that dies before the rename leaves the table as it
was, one that dies after it leaves it replaced; there is no state in between.
Folders that no manifest names are removed by ``vacuum``.

Replaced folders stay for ``keep_s`` seconds, for readers that had begun.  One
writer per table: a second one that publishes the same number is refused.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import session

KEEP_S = 3600
#: Manifests that stay readable behind the newest one.
KEEP_MANIFESTS = 10


class ConcurrentWrite(RuntimeError):
    """Another writer has published in the meantime."""


class NumberedFile:
    """A small JSON value in a folder of numbered files; the newest one counts.
    Each is renamed into place when whole, and never changed."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in session.child_names(self.spark, self.folder)
                      if n.endswith(".json") and n[:-5].isdigit())

    def latest(self) -> tuple[int, dict | None]:
        for n in reversed(self.numbers()):
            text = session.read_small(self.spark, f"{self.folder}/{n:09d}.json")
            if text is not None:  # else removed as too old since the listing
                return n, json.loads(text)
        return 0, None

    def publish(self, after: int, value: dict) -> int:
        """Write number ``after`` + 1; refused if it exists."""
        numbers = self.numbers()
        if numbers and numbers[-1] != after:
            raise ConcurrentWrite(f"{self.folder} is at {numbers[-1]}, not {after}")
        session.write_small(self.spark, f"{self.folder}/{after + 1:09d}.json", json.dumps(value))
        for n in numbers:
            if n <= after - KEEP_MANIFESTS:
                session.delete(self.spark, f"{self.folder}/{n:09d}.json")
        return after + 1


class Versioned:
    """A partitioned path table with atomic replacement of partitions."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, part: str):
        self.spark, self.path, self.schema, self.part = spark, path.rstrip("/"), schema, part
        self.beside = f"{self.path}.v"
        self.manifest = NumberedFile(spark, f"{self.beside}/_manifest")

    # --------------------------------------------------------------- reading
    def state(self) -> tuple[int, dict]:
        """The newest manifest's number and content: ``parts`` maps a partition
        folder to its version (null: it has no rows) and, where rows may still be
        appended in place, the files in place that the version stands for;
        ``sizes`` has the partitions of each version; ``whole`` says that nothing
        in place counts."""
        n, state = self.manifest.latest()
        return n, state or {"parts": {}, "sizes": {}, "old": [], "whole": False}

    def folder(self, value) -> str:
        return f"{self.part}={value}"

    def read(self, values: list | None = None) -> DataFrame:
        """All rows, or those of some partitions, whose folders are read by path
        without listing the others."""
        out = self.stored(values)
        return out if out is not None else self.spark.createDataFrame([], self.schema)

    def stored(self, values: list | None = None) -> DataFrame | None:
        """``read``, or None if there is nothing to read: merges into partitions that
        are new then need no join."""
        n, state = self.state()
        if not n and values is None:
            return self.spark.read.schema(self.schema).parquet(self.path)
        parts, names = state["parts"], None if values is None else [self.folder(v) for v in values]
        at = {f: e["ver"] for f, e in parts.items() if e["ver"] and (names is None or f in set(names))}
        used: dict[str, list[str]] = {}
        for f, ver in at.items():
            used.setdefault(ver, []).append(f)
        # a version that is read in full is one path
        versions = [p for ver, fs in sorted(used.items()) for p in (
            [f"{self.beside}/{ver}"] if len(fs) == state["sizes"].get(ver)
            else [f"{self.beside}/{ver}/{f}" for f in sorted(fs)])]
        out = self._load(versions, self.beside)
        if not state["whole"]:
            out = self._union(out, self._load(self._in_place(parts, names), self.path))
        return out

    def _in_place(self, parts: dict, names: list[str] | None) -> list[str]:
        present = session.child_names(self.spark, self.path) if names is None or len(names) > 20 else [
            f for f in names if session.path_exists(self.spark, f"{self.path}/{f}")]
        paths = []
        for f in present:
            if not f.startswith(f"{self.part}=") or (names is not None and f not in names):
                continue
            entry = parts.get(f)
            if entry is None:
                paths.append(f"{self.path}/{f}")
            elif entry.get("without") is not None:
                gone = set(entry["without"])
                paths += [f"{self.path}/{f}/{x}" for x in self._files(f) if x not in gone]
        return paths

    def _files(self, folder: str) -> list[str]:
        return [x for x in session.child_names(self.spark, f"{self.path}/{folder}") if x[0] not in "._"]

    def _load(self, paths: list[str], base: str) -> DataFrame | None:
        if not paths:
            return None
        return (self.spark.read.schema(self.schema).option("basePath", base).parquet(*paths)
                .select(*self.schema.names))

    @staticmethod
    def _union(a: DataFrame | None, b: DataFrame | None) -> DataFrame | None:
        return a if b is None else b if a is None else a.unionByName(b)

    # --------------------------------------------------------------- writing
    def replace(self, rows: DataFrame, values: list | None, without: dict[str, list[str]] | None = None,
                order: list[str] | None = None, note: dict | None = None,
                cluster: list[str] | None = None, forget: bool = False) -> None:
        """Publish ``rows`` as all rows of the partitions ``values``, or, if None,
        of the table.  ``without``: by partition folder, the files in place that
        the rows stand for (default: all that are or will be there).  ``order``
        sorts the rows of each file; ``note`` is kept in the manifest, so it is
        switched to together with the rows.  ``cluster`` gives each file a range of
        these columns instead, so that a read of one value opens few row groups.
        ``forget``: partitions of ``values`` that get no rows are never written
        again; their folders go when readers that had begun are done."""
        n, state = self.state()
        ver = f"ver={n + 1:09d}-{uuid.uuid4().hex[:8]}"
        rows = rows.select(*self.schema.names)
        rows = rows.repartitionByRange(self.part, *cluster) if cluster else rows.hint("rebalance", self.part)
        if cluster or order:
            rows = rows.sortWithinPartitions(self.part, *(cluster or order))
        rows.write.partitionBy(self.part).parquet(f"{self.beside}/{ver}")
        written = [f for f in session.child_names(self.spark, f"{self.beside}/{ver}") if f.startswith(f"{self.part}=")]
        touched = set(written) | {self.folder(v) for v in values or []}
        before = state["parts"]
        parts = {} if values is None else {f: e for f, e in before.items() if f not in touched}
        for f in touched:
            parts[f] = {"ver": ver if f in written else None, "without": (without or {}).get(f)}
            if forget and f not in written:
                parts[f]["since"] = time.time()
        gone = [f"{e['ver']}/{f}" for f, e in before.items() if e["ver"] and parts.get(f, {}).get("ver") != e["ver"]]
        self._publish(n, state, parts, {**state["sizes"], ver: len(written)}, gone,
                      state["whole"] or values is None, note)

    def drop(self, folders: list[str]) -> None:
        """Publish the table without some versioned partitions (those in place are the caller's)."""
        n, state = self.state()
        gone = [f"{e['ver']}/{f}" for f, e in state["parts"].items() if f in folders and e["ver"]]
        if n and any(f in state["parts"] for f in folders):
            parts = {f: e for f, e in state["parts"].items() if f not in folders}
            self._publish(n, state, parts, state["sizes"], gone, state["whole"])

    def _publish(self, n: int, state: dict, parts: dict, sizes: dict, gone: list[str], whole: bool,
                 note: dict | None = None) -> None:
        live = {e["ver"] for e in parts.values() if e["ver"]}
        now = time.time()
        # first the folder, then its entry: without the entry its rows would count again.
        # Only entries that have been published: before that the rows are nowhere else
        for f in [f for f, e in state["parts"].items() if e.get("since") and now - e["since"] >= KEEP_S]:
            session.delete(self.spark, f"{self.path}/{f}")
            parts = {k: e for k, e in parts.items() if k != f}
        old = [*state["old"], *([f, now] for f in gone)]
        self.manifest.publish(n, {"parts": parts, "sizes": {v: s for v, s in sizes.items() if v in live},
                                  "old": [o for o in old if now - o[1] < KEEP_S], "whole": whole,
                                  "note": state.get("note") if note is None else note})
        # after the switch: what has been out of use for long
        for f, since in old:
            if now - since >= KEEP_S:
                session.delete(self.spark, f"{self.beside}/{f}")

    def vacuum(self, keep_s: float = KEEP_S) -> list[str]:
        """Remove what no reader can need: folders that no manifest names (left by
        jobs that died), replaced ones, and files in place that a version stands
        for, if untouched for ``keep_s`` seconds.  Run it when streams that follow
        the table have read its files in place."""
        n, state = self.state()
        live = {f"{e['ver']}/{f}" for f, e in state["parts"].items() if e["ver"]}
        removed = []
        for ver in session.child_names(self.spark, self.beside):
            if not ver.startswith("ver=") or session.age(self.spark, f"{self.beside}/{ver}") < keep_s:
                continue
            for f in session.child_names(self.spark, f"{self.beside}/{ver}"):
                if f"{ver}/{f}" not in live and f[0] not in "._":
                    removed.append(f"{self.beside}/{ver}/{f}")
            if not any(x.startswith(f"{ver}/") for x in live):
                removed.append(f"{self.beside}/{ver}")
        for f, e in state["parts"].items():
            if session.path_exists(self.spark, f"{self.path}/{f}"):
                names = self._files(f) if e.get("without") is None else e["without"]
                removed += [p for p in (f"{self.path}/{f}/{x}" for x in names)
                            if session.path_exists(self.spark, p) and session.age(self.spark, p) >= keep_s]
        for p in removed:
            session.delete(self.spark, p)
        return removed

    def locations(self) -> dict[str, str]:
        """Partition folder -> where its version lies (for catalog partitions)."""
        return {f: f"{self.beside}/{e['ver']}/{f}" for f, e in self.state()[1]["parts"].items() if e["ver"]}

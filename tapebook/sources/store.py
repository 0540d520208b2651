"""Versioned Parquet snapshots of the declared tables.

Layout under the root folder::

    data/<table>/<folder>/             files written by one stage, a folder of its own
    commits/<version>.json             table -> {partition: folder}, written last

A commit names, for each table, the folder that holds its current rows; tables laid out by
month keep one entry per month. Readers see the newest commit file. A commit that replaces a
table which changed since its ``base`` was read is refused, so no update is lost; the run log is
carried over to whatever commit is the newest, so runs may overlap.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TABLES, Table
from ..session import Observed

WHOLE = ""
NO_MONTH = "none"
STREAMS = "_streams"


def month_of(column: str) -> Column:
    """Partition value of a date: ``2024-01``, or ``none`` for a missing date."""
    return F.coalesce(F.date_format(column, "yyyy-MM"), F.lit(NO_MONTH))


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, relative: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{relative}" if relative else self.root)

    def _names(self, relative: str) -> list[str]:
        path = self._path(relative)
        if not self._fs.exists(path):
            return []
        return [status.getPath().getName() for status in self._fs.listStatus(path)]

    def version(self) -> int:
        """Number of the newest commit; 0 for an empty store."""
        done = [n[: -len(".json")] for n in self._names("commits") if n.endswith(".json")]
        return max((int(n) for n in done if n.isdigit()), default=0)

    def manifest(self, version: int | None = None) -> dict[str, dict[str, str]]:
        version = self.version() if version is None else version
        if version == 0:
            return {}
        stream = self._fs.open(self._path(f"commits/{version:010d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, version: int, manifest: dict[str, dict[str, str]]) -> bool:
        """Make a manifest the given version; False if another writer has taken it. Each writer has a
        draft of its own, and the rename never replaces a file."""
        draft = self._path(f"commits/_{version:010d}-{uuid.uuid4().hex}.tmp")
        stream = self._fs.create(draft, False)
        stream.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        stream.close()
        keep = self.spark.sparkContext._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._fs.getConf())
        try:
            files.rename(draft, self._path(f"commits/{version:010d}.json"), keep)
        except Py4JJavaError as error:
            self._fs.delete(draft, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                return False
            raise
        return True

    def tables(self) -> list[str]:
        return list(TABLES)

    def _folder(self, table: Table, part: str, folder: str) -> str:
        return f"{self.root}/data/{table.name}/{folder}" + (f"/month={part}" if part != WHOLE else "")

    def read(self, name: str, months: Iterable[str] | None = None, manifest: dict | None = None) -> DataFrame:
        """Current rows of a table (or those of a manifest); ``months`` limits a month-laid table to those folders."""
        table = TABLES[name]
        parts = (self.manifest() if manifest is None else manifest).get(name, {})
        if months is not None:
            wanted = set(months)
            parts = {p: v for p, v in parts.items() if p in wanted}
        if not parts:
            return table.empty(self.spark)
        folders = [self._folder(table, p, v) for p, v in sorted(parts.items())]
        return self.spark.read.schema(table.schema).parquet(*folders)

    def months_in(self, name: str, batch: DataFrame) -> list[str]:
        """Months a batch touches: a short list of calendar months, whatever the batch size."""
        column = TABLES[name].month_of
        return [r[0] for r in batch.select(month_of(column).alias("m")).distinct().collect()]

    def stage(self, name: str, rows: DataFrame, observed: Observed | None = None) -> tuple[dict[str, str], DataFrame]:
        """Write rows for a coming commit; returns its manifest entry and the written rows. ``observed``
        takes numbers from them on the way."""
        table = TABLES[name]
        shaped = table.conform(rows)
        folder = f"{self.version() + 1:010d}-{uuid.uuid4().hex[:12]}"
        base = self._folder(table, WHOLE, folder)
        if table.month_of is None:
            (observed.over(shaped) if observed else shaped).write.parquet(base)
            return {WHOLE: folder}, self.spark.read.schema(table.schema).parquet(base)
        # The rebalance hint gathers a month into few files and splits a month that is too large.
        laid_out = shaped.withColumn("month", month_of(table.month_of)).hint("rebalance", "month")
        (observed.over(laid_out) if observed else laid_out).write.partitionBy("month").parquet(base)
        parts = [n.split("=", 1)[1] for n in self._names(f"data/{name}/{folder}") if n.startswith("month=")]
        folders = [self._folder(table, p, folder) for p in sorted(parts)]
        written = self.spark.read.schema(table.schema).parquet(*folders) if parts else table.empty(self.spark)
        return dict.fromkeys(parts, folder), written

    def create_tables(self) -> None:
        """Publish every declared table that does not exist yet, empty. Safe to repeat."""
        known = self.manifest()
        absent = {n: t.empty(self.spark) for n, t in TABLES.items() if n not in known}
        if absent:
            self.commit(absent)

    def commit(self, changes: dict[str, DataFrame], base: dict | None = None, streams: dict | None = None) -> int:
        """Write several tables and publish them together."""
        base = self.manifest() if base is None else base
        return self.publish({n: self.stage(n, df)[0] for n, df in changes.items()}, base, streams)

    def publish(
        self, entries: dict[str, dict[str, str]], base: dict, streams: dict | None = None, log: Callable[[DataFrame], DataFrame] | None = None
    ) -> int:
        """Make staged entries current. A whole table is replaced, months are replaced one by one.
        ``base`` is the manifest from before the tables were read; ``streams`` are batch ids to keep.

        ``log`` gives the new run log from the one that the commit replaces. A commit that another writer
        overtakes is tried again on top of it, unless that one changed a table of this one.
        """
        while True:
            version = self.version()
            manifest = self.manifest(version)
            changed = [n for n in entries if manifest.get(n) != base.get(n)]
            if changed:
                raise RuntimeError(f"{', '.join(changed)} changed since it was read; run the job again")
            entries_now = dict(entries)
            if log is not None:
                entries_now["runs"] = self.stage("runs", log(self.read("runs", manifest=manifest)))[0]
            for name, entry in entries_now.items():
                manifest[name] = entry if TABLES[name].month_of is None else manifest.get(name, {}) | entry
            if streams:
                manifest[STREAMS] = manifest.get(STREAMS, {}) | streams
            if self._publish(version + 1, manifest):
                return version + 1

    def last_batch(self, stream: str) -> int:
        """Number of the last micro-batch of a stream that a commit holds; -1 for none."""
        return int(self.manifest().get(STREAMS, {}).get(stream, -1))

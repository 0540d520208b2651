"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid
from collections import Counter

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def build_session(app: str = "tapebook", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this library expects; the cluster's own settings win."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, fallback: str) -> str:
    """Folder for intermediate tables: the cluster's checkpoint folder, or ``fallback`` if unset."""
    return spark.conf.get("spark.checkpoint.dir", None) or fallback


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables of a query that belongs to no store: the cluster's checkpoint
    folder. A session on one machine (tests) may do without and gets a temporary one; a cluster may not,
    since its executors would each write to a disk of their own."""
    if spark.conf.get("spark.checkpoint.dir", None) is None and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return shared_folder(spark, tempfile.gettempdir())


class Observed:
    """Numbers taken from rows while they are written, so that nothing is read again to count it.

    A write observes them in its last stage, where each task counts once however often it runs.
    A number over no rows is 0.
    """

    def __init__(self, **numbers: Column):
        self._numbers = numbers
        self._seen = Observation()

    def over(self, df: DataFrame) -> DataFrame:
        return df.observe(self._seen, *[number.alias(name) for name, number in self._numbers.items()])

    def __getitem__(self, name: str) -> int:
        """Known once the write is done."""
        return int(self._seen.get.get(name) or 0)


class Scratch:
    """Intermediate tables of one job, in the shared folder, removed when the job ends.

    Reading them back cuts the lineage: a lost executor costs a re-read of files, not a
    re-parse of the landing data. Later steps read only the columns they need, and the
    planner knows their size.
    """

    def __init__(self, spark: SparkSession, fallback: str):
        self.spark = spark
        self.root = f"{shared_folder(spark, fallback).rstrip('/')}/tapebook/{uuid.uuid4().hex}"
        self._written: Counter[str] = Counter()

    def write(self, df: DataFrame, name: str, observed: Observed | None = None) -> DataFrame:
        self._written[name] += 1
        path = f"{self.root}/{name}" + (f"~{self._written[name]}" if self._written[name] > 1 else "")
        (observed.over(df) if observed else df).write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

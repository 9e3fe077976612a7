"""Which folders a table written by a stream consists of, and the days each of them has.

A table is a folder with ``data`` (a folder per micro-batch or compaction, split by day) and ``_manifest``,
numbered JSON files of which the last one counts. A batch's rows are part of the table once a manifest
names their folder; a batch that is named already is not written again when the query replays it. Readers
open the folders of the days they want and list nothing. A compaction puts folders together and swaps
them for the new one in one manifest. One query writes to a table at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DAY = "event_date"
#: Older manifests that readers may still hold.
KEPT_VERSIONS = 10


class Manifest:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._jvm = spark.sparkContext._jvm
        self._home = self._at("_manifest")
        self._fs = self._home.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def _versions(self) -> list[int]:
        if not self._fs.exists(self._home):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(self._home)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("."))

    def read(self) -> tuple[int, list[dict]]:
        """The number of the last manifest and its folders: name, days, query and epoch they hold."""
        versions = self._versions()
        if not versions:
            return 0, []
        lines = self.spark.read.text(f"{self.path}/_manifest/{versions[-1]}.json", wholetext=True).first()
        return versions[-1], json.loads(lines[0])

    def holds(self, query: str, epoch: int) -> bool:
        return any(e["last"].get(query, -1) >= epoch for e in self.read()[1])

    def days_of(self, folder: str) -> list[str]:
        """The days that a written folder has."""
        names = [s.getPath().getName() for s in self._fs.listStatus(self._at("data", folder))]
        return sorted(n.removeprefix(f"{DAY}=") for n in names if n.startswith(f"{DAY}="))

    def commit(self, entry: dict, instead_of: frozenset[str] = frozenset()) -> None:
        version, entries = self.read()
        kept = [e for e in entries if e["folder"] not in instead_of | {entry["folder"]}]
        draft = self._at("_manifest", f".{version + 1}.draft")
        out = self._fs.create(draft, True)
        out.write(bytearray(json.dumps([*kept, entry]).encode()))
        out.close()
        if not self._fs.rename(draft, self._at("_manifest", f"{version + 1}.json")):
            raise OSError(f"manifest {version + 1} of {self.path} is there already")
        for old in self._versions()[:-KEPT_VERSIONS]:
            self._fs.delete(self._at("_manifest", f"{old}.json"), False)

    def paths(self, start: date | None = None, end: date | None = None) -> list[str]:
        """The day folders between two days, both included."""
        low, high = start.isoformat() if start else "", end.isoformat() if end else "~"
        return [
            f"{self.path}/data/{e['folder']}/{DAY}={d}" for e in self.read()[1] for d in e["days"] if low <= d <= high
        ]


def write_batch(batch: DataFrame, epoch: int, path: str, day: Column) -> bool:
    """Adds a micro-batch to the table; False where it is part of it already."""
    spark = batch.sparkSession
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
    manifest = Manifest(spark, path)
    if manifest.holds(query, epoch):
        return False
    folder = f"{query}-{epoch}"
    dated = batch.withColumn(DAY, F.coalesce(day.cast("date").cast("string"), F.lit("none")))
    dated.hint("rebalance", F.col(DAY)).write.mode("overwrite").partitionBy(DAY).parquet(f"{path}/data/{folder}")
    days = manifest.days_of(folder)
    manifest.commit({"folder": folder, "days": days, "last": {query: epoch}})
    return True


def read(spark: SparkSession, path: str, schema, start: date | None = None, end: date | None = None) -> DataFrame:
    """The table's rows, or those of the days between two days; ``schema`` is that of the batches."""
    folders = Manifest(spark, path).paths(start, end)
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def compact(spark: SparkSession, path: str, schema, fold: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """Writes the folders of the table into one and swaps the manifest; ``fold`` may drop replaced rows. The
    old folders stay for readers of the last manifest until ``vacuum``."""
    manifest = Manifest(spark, path)
    version, entries = manifest.read()
    if len(entries) < 2:
        return
    folder = f"compact-{version}"
    paths = [f"{path}/data/{e['folder']}/{DAY}={d}" for e in entries for d in e["days"]]
    if paths:
        day = F.regexp_extract(F.input_file_name(), f"{DAY}=([^/]+)", 1)
        rows = spark.read.schema(schema).parquet(*paths).withColumn(DAY, day)
        whole = fold(rows) if fold else rows
        whole.hint("rebalance", F.col(DAY)).write.mode("overwrite").partitionBy(DAY).parquet(f"{path}/data/{folder}")
    last: dict[str, int] = {}
    for e in entries:
        for query, epoch in e["last"].items():
            last[query] = max(epoch, last.get(query, -1))
    days = manifest.days_of(folder) if paths else []
    manifest.commit({"folder": folder, "days": days, "last": last}, frozenset(e["folder"] for e in entries))


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Deletes the folders that the last manifest does not name."""
    manifest = Manifest(spark, path)
    named = {e["folder"] for e in manifest.read()[1]}
    gone = [s.getPath().getName() for s in manifest._fs.listStatus(manifest._at("data")) if s.getPath().getName() not in named]
    for folder in gone:
        manifest._fs.delete(manifest._at("data", folder), True)
    return gone

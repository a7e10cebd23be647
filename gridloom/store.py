"""The published tables: layout, snapshots and what a reader sees.

``data/snapshot=S/dataset=D/geography=G/year=Y`` holds partitions, ``combined/snapshot=S/dataset=D/geography=G`` all years of a
level, ``lookups``, ``crosswalks`` and ``boundaries`` what goes with them.  A refresh writes to folders of its own snapshot
and then one small file in ``commits``, whose number must be new: what it names becomes visible at once or not at all.
A snapshot's manifest names the live folders, so what did not change is not copied, and readers never list or read
what a failed refresh left behind.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from .sinks import write_sorted

PARTITION = ["dataset", "geography", "year"]


def write_partitions(df: DataFrame, path: str, dims: list[str]) -> None:
    """K1: rows (dataset, geography, year, geo_id, dims, measures) in folders of dataset, geography and year, each sorted by unit in small row groups."""
    write_sorted(df, path, ["geo_id", *dims], PARTITION)


def write_combined(df: DataFrame, path: str, dims: list[str]) -> None:
    """K2: all years of a dataset and geography together, sorted by unit and year, so that a unit's series lies in few row groups."""
    write_sorted(df, path, ["geo_id", "year", *dims], PARTITION[:2])


def scan(spark: SparkSession, path: str, dataset: str | None = None, geography: str | None = None, year: int | None = None) -> DataFrame:
    """S5, P3: a partitioned table, of one dataset, geography and year if given; these are partition filters, so other folders are not read."""
    df = spark.read.parquet(path)
    for column, value in (("dataset", dataset), ("geography", geography), ("year", year)):
        if value is not None:
            df = df.where(F.col(column) == value)
    return df


def newest(df: DataFrame, years: DataFrame) -> DataFrame:
    """Rows of each dataset's default year (dataset, year): the join's years prune the folders when the query runs."""
    return df.join(F.broadcast(years.select("dataset", "year")), ["dataset", "year"], "left_semi")  # a row for each dataset


# --- snapshots


def _hadoop(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


@dataclass
class Snapshot:
    """What a commit names: number, folder name, manifest and the live folders (kind -> paths)."""

    root: str
    number: int
    name: str
    live: dict[str, list[str]] = field(default_factory=dict)

    def path(self, kind: str) -> str:
        return f"{self.root}/{kind}/snapshot={self.name}"


def commits(spark: SparkSession, root: str) -> list[int]:
    fs, at = _hadoop(spark, f"{root}/commits")
    names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:-5].isdigit())


def current(spark: SparkSession, root: str) -> Snapshot | None:
    """The newest whole commit; one that was cut off while it was written does not parse and is passed over."""
    for number in reversed(commits(spark, root)):
        text = "\n".join(r.value for r in spark.read.text(f"{root}/commits/{number:08d}.json").collect())  # a small file
        try:
            said = json.loads(text)
            return Snapshot(root, number, said["name"], said["live"])
        except (ValueError, KeyError):
            continue
    return None


def begin(spark: SparkSession, root: str) -> Snapshot:
    """A new snapshot after the current one, with its live folders; its own folder's name is new even if an earlier try failed."""
    last, taken = current(spark, root), commits(spark, root)
    return Snapshot(root, (taken[-1] if taken else 0) + 1, f"{(taken[-1] if taken else 0) + 1:08d}-{uuid.uuid4().hex[:8]}", dict(last.live) if last else {})


def commit(spark: SparkSession, snapshot: Snapshot) -> None:
    """Make the snapshot current.  Of two refreshes that began from one snapshot the second fails here, since its number is taken."""
    fs, at = _hadoop(spark, f"{snapshot.root}/commits/{snapshot.number:08d}.json")
    out = fs.create(at, False)
    try:
        out.write(bytearray(json.dumps({"name": snapshot.name, "live": snapshot.live}).encode()))
    finally:
        out.close()


def read(spark: SparkSession, snapshot: Snapshot, kind: str, dataset: str | None = None) -> DataFrame:
    """A live table of the snapshot, of one dataset if given (datasets differ in their columns); folder names below ``kind`` are columns, but for the snapshot's."""
    paths = [p for p in snapshot.live[kind] if dataset is None or f"/dataset={dataset}/" in f"{p}/"]
    return spark.read.option("basePath", f"{snapshot.root}/{kind}").parquet(*paths).drop("snapshot")


def read_text(spark: SparkSession, snapshot: Snapshot, kind: str) -> DataFrame:
    """Live JSON lines (value, and the folder names as columns)."""
    return spark.read.option("basePath", f"{snapshot.root}/{kind}").text(snapshot.live[kind]).drop("snapshot")


def vacuum(spark: SparkSession, root: str) -> list[str]:
    """Delete the folders of snapshots that no live folder of the current one lies in; returns them.  Not to be run beside a refresh or readers of older snapshots."""
    now = current(spark, root)
    if now is None:
        return []
    keep, gone = {p.split("/snapshot=")[1].split("/")[0] for paths in now.live.values() for p in paths}, []
    for kind in now.live:
        fs, at = _hadoop(spark, f"{root}/{kind}")
        for f in fs.listStatus(at):
            if f.getPath().getName().removeprefix("snapshot=") not in keep:
                gone.append(f.getPath().toString())
                fs.delete(f.getPath(), True)
    return gone

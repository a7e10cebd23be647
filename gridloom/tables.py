"""Working tables in the folder that the cluster shares."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Rows, at most, of a table that is broadcast.
FEW = 1 << 16


def work_path(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; where that is unset and the master is local (tests on one machine), below a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is unset: a folder that all machines share is needed")
        folder = tempfile.mkdtemp(prefix="spark-gridloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/gridloom/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends here."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, rows: int | None = None) -> DataFrame:
    """One side of a join, broadcast if it has at most ``FEW`` rows (``rows``, or as many as it is found to have), else merged with the other side; that one is never broadcast.

    By itself Spark goes by the bytes of Parquet files, but rows that are sorted or exploded from others take many times as many
    in the driver's memory, where a broadcast is built.
    """
    return df.hint("broadcast" if (df.count() if rows is None else rows) <= FEW else "merge")

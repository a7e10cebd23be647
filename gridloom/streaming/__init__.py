"""Incremental roll-ups of source files as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..functions import year_of_path
from ..operators.aggregate import aggregate
from ..registry import source_schema
from ..sinks import write_sorted
from ..sources import file_manifest, scan_source, with_year


def newest_files(spark: SparkSession, folder: str, years: list[int]) -> list[str]:
    """The file of each of these years that was modified last (of several at once the last by name), as the folder is now."""
    files = file_manifest(spark, folder).withColumn("year", year_of_path(F.col("path"))).where(F.col("year").isin(years))
    return [r.path for r in files.groupBy("year").agg(F.max(F.struct("modified", "path")).getField("path").alias("path")).collect()]  # one for each year


def follow(spark: SparkSession, folder: str, crosswalk: DataFrame, dims: tuple[str, ...], out: str, checkpoint: str) -> StreamingQuery:
    """Roll up each year of which a source file (in a folder of its year) arrives, and replace that year's partition.

    A year is one file.  A re-published one arrives as a new file; whichever files of a year a batch brings, in whatever
    order they came, its newest file in the folder counts alone.  So no state is kept, and a repeated batch or two versions
    in one give the same partition.
    """
    source = with_year(spark.readStream.schema(source_schema(dims)).option("recursiveFileLookup", True).parquet(folder))

    def publish(batch: DataFrame, _: int) -> None:
        years = [r.year for r in batch.select("year").distinct().collect()]
        if years:
            rows = with_year(scan_source(spark, newest_files(spark, folder, years), dims))
            write_sorted(aggregate(rows, crosswalk, list(dims), ["year"]), out, ["geo_id", *dims], ["year"])

    return source.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

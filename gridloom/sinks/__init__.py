"""Writers: partitions, published crosswalks, lookups and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

ROW_GROUP, CROSSWALK_ROW_GROUP = 8_000, 100_000
#: First characters that the ids of a run of a lookup document share.
RUN = 4


def write_sorted(df: DataFrame, path: str, order: list[str], partitions: list[str] = [], row_group: int = ROW_GROUP, mode: str = "overwrite") -> None:  # noqa: B006
    """ZSTD Parquet in range-sorted files of small row groups, so that one unit's rows lie in few of them.

    Partition folders are replaced one by one; rows are dealt by range over all sort columns, never to a single task.
    """
    # a partition column that is a literal would be left out of the sort, and the writer would then sort anew by folders only
    df = df.withColumns({c: F.when(F.monotonically_increasing_id() >= 0, F.col(c)) for c in partitions})
    sorted_ = df.repartitionByRange(*partitions, *order).sortWithinPartitions(*partitions, *order)
    writer = sorted_.write.mode(mode).option("compression", "zstd").option("parquet.block.row.count.limit", str(row_group)).option("partitionOverwriteMode", "dynamic")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def lookup_json(rows: DataFrame, value: str, order: tuple[str, ...] = ()) -> DataFrame:
    """(geography, json): one JSON object of ``value`` by geo_id for each geography, keys sorted; rows that share an id all stay, in order of the columns ``order`` and then of their text.

    Ids that begin with the same characters are put together first, so only their joined texts come to the task that makes the object.
    """
    one = F.to_json(F.create_map("geo_id", value))
    entry = F.struct("geo_id", *order, F.substring(one, F.lit(2), F.length(one) - 2).alias("text"))
    joined = lambda parts: F.array_join(F.transform(F.sort_array(F.collect_list(parts)), lambda p: p.text), ",")
    runs = rows.groupBy("geography", F.substring("geo_id", 1, RUN).alias("start")).agg(joined(entry).alias("text"))
    return runs.groupBy("geography").agg(F.concat(F.lit("{"), joined(F.struct("start", "text")), F.lit("}")).alias("json"))


def features_json(vertices: DataFrame) -> DataFrame:
    """(geo_id, json): a GeoJSON feature of each unit; rings are closed, those of fewer than four points go.

    Rings become text first, so a task holds the points of one ring, and of a unit its text only.
    """
    points = vertices.groupBy("geo_id", "part", "ring").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "x", "y"))), lambda p: F.array(p.x, p.y)).alias("points"))
    closed = F.when(F.element_at("points", 1) == F.element_at("points", -1), F.col("points")).otherwise(F.concat("points", F.slice("points", 1, 1)))
    rings = points.withColumn("points", closed).where(F.size("points") >= 4).select("geo_id", "part", "ring", F.to_json("points").alias("text"))
    listed = lambda key: F.concat(F.lit("["), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(key, "text"))), lambda r: r.text), ","), F.lit("]")).alias("text")
    shapes = rings.groupBy("geo_id", "part").agg(listed("ring")).groupBy("geo_id").agg(listed("part"))
    return shapes.select("geo_id", F.concat(F.lit('{"type":"Feature","properties":'), F.to_json(F.struct("geo_id")), F.lit(',"geometry":{"type":"MultiPolygon","coordinates":'), "text", F.lit("}}")).alias("json"))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def append_ledger(records: DataFrame, path: str) -> None:
    records.write.mode("append").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)

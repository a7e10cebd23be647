"""Readers: source grids, lookups, boundaries, files and their statistics."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from ..functions import pad_id, year_of_path
from ..registry import CELL, source_schema

#: Files up to so many bytes are read as one row.
WHOLE = 1 << 27


def scan_source(spark: SparkSession, paths: str | list[str], dims: tuple[str, ...]) -> DataFrame:
    """Source files by their contract: no schema inference, columns pruned by what the plan uses."""
    return spark.read.schema(source_schema(dims)).parquet(*([paths] if isinstance(paths, str) else paths))


def with_year(df: DataFrame) -> DataFrame:
    """A scan with the year of each row's file."""
    return df.withColumn("year", year_of_path(F.col("_metadata.file_path")))


def cell_union(*grids: DataFrame) -> DataFrame:
    """The distinct cells of all grids; each grid is reduced on the map side before the shuffle."""
    cells = grids[0].select(*CELL)
    for g in grids[1:]:
        cells = cells.unionByName(g.select(*CELL))
    return cells.distinct()


def read_id_crosswalk(spark: SparkSession, path: str, parent: str, child: str, name: str) -> DataFrame:
    """(parent_id, child_id, name) from a CSV with a numeric child id, padded to the longest."""
    return id_crosswalk(spark.read.option("header", True).csv(path).select(F.col(parent).alias("parent_id"), F.col(child).cast("double").alias("child"), F.col(name).alias("name")))


def id_crosswalk(rows: DataFrame) -> DataFrame:
    width = rows.agg(F.max(F.length(F.col("child").cast("long").cast("string")))).first()[0] or 1
    return rows.select("parent_id", pad_id(F.col("child"), width).alias("child_id"), "name")


def read_boundaries(spark: SparkSession, path: str, id_field: str, name_field: str, collection: bool = False) -> DataFrame:
    """(geo_id, name, part, ring, seq, x, y): vertices of GeoJSON polygons in lon/lat degrees, one feature a line.

    collection: each file is one FeatureCollection instead, which a single task has to read whole.
    """
    text = spark.read.text(path, wholetext=collection)
    feature = text.select(F.explode(F.from_json("value", "features array<string>")["features"]).alias("f")) if collection else text.select(F.col("value").alias("f"))
    parts = feature.select(
        F.get_json_object("f", f"$.properties.{id_field}").alias("geo_id"), F.get_json_object("f", f"$.properties.{name_field}").alias("name"),
        F.when(F.get_json_object("f", "$.geometry.type") == "Polygon", F.concat(F.lit("["), F.get_json_object("f", "$.geometry.coordinates"), F.lit("]"))).otherwise(F.get_json_object("f", "$.geometry.coordinates")).alias("c"),
    )
    # the parts of a feature stay text until each is a row of its own
    texts = parts.select("geo_id", "name", F.posexplode(F.from_json("c", "array<string>")).alias("part", "text"))
    rings = texts.select("geo_id", "name", "part", F.posexplode(F.from_json("text", "array<array<array<double>>>")).alias("ring", "points"))
    return rings.select("geo_id", "name", "part", "ring", F.posexplode("points").alias("seq", "p")).select("geo_id", "name", "part", "ring", "seq", F.col("p")[0].alias("x"), F.col("p")[1].alias("y"))


def boundary_edges(vertices: DataFrame) -> DataFrame:
    """(geo_id, x1, y1, x2, y2): each vertex to the next of its ring, the last to the first; edges without length go."""
    ring = W.partitionBy("geo_id", "part", "ring")
    follows = ring.orderBy("seq")
    first = ring.orderBy("seq").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    nxt = lambda c: F.coalesce(F.lead(c).over(follows), F.first(c).over(first))
    e = vertices.select("geo_id", F.col("x").alias("x1"), F.col("y").alias("y1"), nxt("x").alias("x2"), nxt("y").alias("y2"))
    return e.where("x1 <> x2 or y1 <> y2")


def read_state_layers(spark: SparkSession, root: str, states_with_data: DataFrame) -> DataFrame:
    """Layers of one state each, in the folders ``state=<id>`` below root, as one: those of states that have data and a folder; columns missing in some are filled with null."""
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    have = {f.getPath().getName().removeprefix("state=") for f in at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at) if f.isDirectory()}
    wanted = sorted(have & {r.state for r in states_with_data.select("state").distinct().collect()})  # some tens of states
    if not wanted:
        raise ValueError("no state with data has a layer")
    schema = T.StructType([*spark.read.option("mergeSchema", True).parquet(*[f"{root}/state={s}" for s in wanted]).schema, T.StructField("state", T.StringType())])
    return spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/state={s}" for s in wanted])


def lookup_rows(documents: DataFrame, value_type: str = "string") -> DataFrame:
    """(geography, geo_id, value) of lookup documents (geography, json), JSON objects of values by id."""
    return documents.select("geography", F.explode(F.from_json("json", f"map<string,{value_type}>")).alias("geo_id", "value"))


def schema_rows(df: DataFrame, contract: T.StructType) -> DataFrame:
    """(column, found, declared, status): a missing or differing column is an error, one more a warning."""
    found, wanted = {f.name: f.dataType.simpleString() for f in df.schema}, {f.name: f.dataType.simpleString() for f in contract}
    rows = [(c, found.get(c), wanted.get(c), "ok" if found.get(c) == wanted.get(c) else "warning" if c not in wanted else "error") for c in sorted(found.keys() | wanted.keys())]
    return df.sparkSession.createDataFrame(rows, "column string, found string, declared string, status string")


def schema_by_path(spark: SparkSession, paths: list[str], contract: T.StructType) -> DataFrame:
    """(path, column, found, declared, status) of every path by itself, from its files' footers, so that drift in one year is not merged away."""
    found = []
    for path in paths:  # metadata of a few paths: datasets times years
        have, wanted = ({f.name: f.dataType.simpleString() for f in schema} for schema in (spark.read.parquet(path).schema, contract))
        found += [(path, c, have.get(c), wanted.get(c), "ok" if have.get(c) == wanted.get(c) else "warning" if c not in wanted else "error") for c in sorted(have.keys() | wanted.keys())]
    return spark.createDataFrame(found, "path string, column string, found string, declared string, status string")


def file_manifest(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, bytes, modified) of the files below path; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return files.select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def file_checksums(spark: SparkSession, path: str, pattern: str = "*.parquet", whole: int = WHOLE) -> DataFrame:
    """(path, bytes, sha256) of the files below path, from the bytes read.

    A file that can't be read, since the file system's own checksums don't fit, has no row.
    A file of at most ``whole`` bytes is read by Spark as a row; a longer one by a task of its own in pieces, through Arrow's
    file systems, so that no file is ever held whole beyond that size.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).option("ignoreCorruptFiles", True).load(path)
    small = files.where(F.col("length") <= whole).select("path", F.length("content").cast("long").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    large = files.where(F.col("length") > whole).select("path")

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for at in batch["path"]:
                fs, name = pafs.FileSystem.from_uri(at if "://" in at else at.replace("file:/", "file:///", 1))
                h, n = hashlib.sha256(), 0
                with fs.open_input_stream(unquote(name)) as f:
                    while piece := f.read(1 << 24):
                        h.update(piece)
                        n += len(piece)
                found.append((at, n, h.hexdigest()))
            yield pd.DataFrame(found, columns=["path", "bytes", "sha256"])

    return small.unionByName(large.repartition("path").mapInPandas(digest, "path string, bytes long, sha256 string"))


def row_groups(spark: SparkSession, path: str, column: str, size: int) -> DataFrame:
    """(path, row_group, rows, least, most): what a column holds in each row group of ``size`` rows of the Parquet files below path."""
    rows = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("path"), F.floor(F.col("_metadata.row_index") / size).cast("int").alias("row_group"), column)
    return rows.groupBy("path", "row_group").agg(F.count("*").alias("rows"), F.min(column).alias("least"), F.max(column).alias("most"))


def scan_metrics(df: DataFrame) -> list[tuple[str, int, int]]:
    """Run a query of few rows and say of each of its file scans (description, rows handed on, files read), from Spark's own metrics: what partition filters and row-group statistics left."""
    df.collect()
    found, left = [], [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            left.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            left.append(node.plan())
        elif kind == "FileSourceScanExec":
            found.append((node.verboseStringWithOperatorId(), node.metrics().apply("numOutputRows").value(), node.metrics().apply("numFiles").value()))
        else:
            children = node.children()
            left += [children.apply(k) for k in range(children.size())]
    return found


def ledger_latest(ledger: DataFrame, version: str | None = None) -> DataFrame:
    """The newest record of each (dataset, geography, year), of one pipeline version if given."""
    ledger = ledger if version is None else ledger.where(F.col("pipeline_version") == version)
    columns = [c for c in ledger.columns if c not in ("dataset", "geography", "year")]
    newest = ledger.groupBy("dataset", "geography", "year").agg(F.max_by(F.struct(*columns), "built_at").alias("r"))
    return newest.select("dataset", "geography", "year", *[F.col(f"r.{c}").alias(c) for c in columns])

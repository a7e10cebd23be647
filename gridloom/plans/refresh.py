"""The refresh job: what changed is rebuilt beside the published snapshot, which one commit at the end replaces."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import registry, sinks, sources, store
from ..operators import aggregate as agg, crosswalk as cw, rings
from ..registry import CELL, MEASURES, source_schema
from ..store import PARTITION, Snapshot
from . import catalog_json, due, upsert


@dataclass
class Inputs:
    """What a refresh works on.

    source: folder of files below ``<dataset>/<year>/``; dims: the dimensions of each dataset; plan: (dataset, geography, year,
    preliminary) that are wanted; crosswalks: (cell, geo_id, snapped) of each level, coarse to fine; units: (geography, geo_id,
    name, namelsad, aland_m2, awater_m2); states: (geo_id, stusps); edges: directed edges of the levels that are drawn.
    rows: least and most rows of a source year.
    """

    source: str
    dims: dict[str, tuple[str, ...]]
    plan: DataFrame
    crosswalks: dict[str, DataFrame]
    units: DataFrame
    states: DataFrame
    edges: dict[str, DataFrame] = field(default_factory=dict)
    tolerance: float = 0.005
    rows: tuple[int, int] = (1, 1 << 62)
    version: str = "1"


@dataclass
class Refresh:
    spark: SparkSession
    inputs: Inputs
    snapshot: Snapshot
    ledger: DataFrame | None
    due: DataFrame
    log: list[str] = field(default_factory=list)

    def keep(self, kind: str, folders: list[str]) -> None:
        """These folders of the new snapshot are live, in place of those of the same name of older ones."""
        fresh = [f"{self.snapshot.path(kind)}/{f}".rstrip("/") for f in folders]
        names = {p.split("/snapshot=")[1].partition("/")[2] for p in fresh}
        self.snapshot.live[kind] = sorted([p for p in self.snapshot.live.get(kind, []) if p.split("/snapshot=")[1].partition("/")[2] not in names] + fresh)

    def years(self, dataset: str) -> list[int]:
        return sorted(r.year for r in self.due.where(F.col("dataset") == dataset).select("year").distinct().collect())

    def changed(self, *columns: str) -> list[tuple]:
        """Distinct keys of what is due: a row for each partition at most."""
        return sorted(tuple(r) for r in self.due.select(*columns).distinct().collect())


def source_state(spark: SparkSession, folder: str) -> DataFrame:
    """(dataset, year, source_bytes, source_modified): what the file system says of each year's files; contents are not read."""
    at = F.regexp_extract("path", r"/([^/]+)/(\d{4})/[^/]+$", 1), F.regexp_extract("path", r"/([^/]+)/(\d{4})/[^/]+$", 2).try_cast("int")
    return sources.file_manifest(spark, folder).groupBy(at[0].alias("dataset"), at[1].alias("year")).agg(F.sum("bytes").alias("source_bytes"), F.max("modified").alias("source_modified"))


def crosswalk_state(crosswalks: dict[str, DataFrame]) -> DataFrame:
    """(geography, crosswalk_digest): number of cells and sum of their hashes, whatever their order."""
    out = None
    for level, xw in crosswalks.items():
        one = xw.agg(F.concat_ws("-", F.count("*"), F.coalesce(F.sum(F.xxhash64(*CELL, "geo_id", "snapped").cast("decimal(38,0)")), F.lit(0))).alias("crosswalk_digest")).select(F.lit(level).alias("geography"), "crosswalk_digest")
        out = one if out is None else out.unionByName(one)
    return out


def validate(job: Refresh) -> None:
    """Columns of every year's files and rows of every year within bounds, before anything is written."""
    spark, inputs, problems = job.spark, job.inputs, []
    for dataset, dims in inputs.dims.items():
        years = job.years(dataset)
        paths = [f"{inputs.source}/{dataset}/{y}" for y in years]
        problems += [f"{r.path.rsplit('/', 2)[-2:]}: {r.column} is {r.found}, not {r.declared}" for r in sources.schema_by_path(spark, paths, source_schema(dims)).where("status = 'error'").collect()] if paths else []
        if paths and not problems:
            counts = {r.year: r["count"] for r in sources.with_year(sources.scan_source(spark, paths, dims)).groupBy("year").count().collect()}
            problems += [f"{dataset} {y}: {counts.get(y, 0)} rows" for y in years if not inputs.rows[0] <= counts.get(y, 0) <= inputs.rows[1]]
    if problems:
        raise ValueError("; ".join(problems))


def build(job: Refresh) -> None:
    """Partitions that are due, all levels of a dataset from one read of the years concerned."""
    for dataset, dims in job.inputs.dims.items():
        years = job.years(dataset)
        if not years:
            continue
        levels = {r.geography for r in job.due.where(F.col("dataset") == dataset).select("geography").distinct().collect()}
        source = sources.with_year(sources.scan_source(job.spark, [f"{job.inputs.source}/{dataset}/{y}" for y in years], dims))
        wide = agg.widen({g: xw for g, xw in job.inputs.crosswalks.items() if g in levels})
        rows = agg.aggregate_levels(source, wide, list(dims), ["year"]).withColumnRenamed("level", "geography").withColumn("dataset", F.lit(dataset))
        store.write_partitions(rows.join(job.due.select(*PARTITION), PARTITION, "left_semi"), job.snapshot.path("data"), list(dims))


def record(job: Refresh) -> None:
    """Ledger rows of what was built, with bytes and digests of the files."""
    spark, path = job.spark, job.snapshot.path("data")
    if not job.changed("dataset"):
        job.ledger.write.parquet(job.snapshot.path("ledger")) if job.ledger is not None else None
        return
    key = [F.regexp_extract("path", f"/{c}=([^/]+)/", 1).alias(c) for c in PARTITION]
    files = sources.file_checksums(spark, path).select("path", "bytes", "sha256", *key).withColumn("year", F.col("year").cast("int"))
    files.write.partitionBy("dataset").parquet(job.snapshot.path("files"))
    files = spark.read.parquet(job.snapshot.path("files"))
    sizes = files.groupBy(*PARTITION).agg(F.sum("bytes").alias("bytes"), F.sha2(F.array_join(F.array_sort(F.collect_list("sha256")), "\n"), 256).alias("sha256"))  # the files of one partition
    totals = spark.read.parquet(path).groupBy(*PARTITION).agg(F.count("*").alias("rows"), F.countDistinct("geo_id").alias("geo_units"), F.round(F.sum(MEASURES[0]), 1).alias("total_raw"), F.round(F.sum(MEASURES[1]), 1).alias("total_postprocessed"))
    built = job.due.drop("reason").join(totals, PARTITION, "left").join(sizes, PARTITION, "left").fillna(0, ["rows", "geo_units", "bytes"])
    built = built.withColumns({"path": F.concat_ws("/", F.lit(f"data/snapshot={job.snapshot.name}"), *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in PARTITION]), "pipeline_version": F.lit(job.inputs.version), "built_at": F.lit(job.snapshot.number)})
    whole = built if job.ledger is None else upsert(job.ledger, built, PARTITION)
    whole.write.parquet(job.snapshot.path("ledger"))
    written = spark.read.parquet(job.snapshot.path("ledger")).where((F.col("built_at") == job.snapshot.number) & (F.col("rows") > 0)).select(*PARTITION).collect()
    job.keep("data", [f"dataset={r.dataset}/geography={r.geography}/year={r.year}" for r in written])
    job.keep("files", sorted({f"dataset={r.dataset}" for r in written}))


def names(job: Refresh) -> None:
    found = None
    for level, xw in job.inputs.crosswalks.items():
        named = cw.names(job.inputs.units.where(F.col("geography") == level), job.inputs.states, xw, state_level=level in ("nation", "state")).select(F.lit(level).alias("geography"), "geo_id", "name")
        found = named if found is None else found.unionByName(named)
    sinks.lookup_json(found, "name").write.partitionBy("geography").text(job.snapshot.path("names"))
    job.snapshot.live["names"] = [job.snapshot.path("names")]


def areas(job: Refresh) -> None:
    """Land and water of the units with data; a unit without land area is an error."""
    have = None
    for level, xw in job.inputs.crosswalks.items():
        units = xw.select(F.lit(level).alias("geography"), "geo_id").distinct()
        have = units if have is None else have.unionByName(units)
    found = job.inputs.units.select("geography", "geo_id", "aland_m2", "awater_m2").dropDuplicates(["geography", "geo_id"]).join(have, ["geography", "geo_id"], "left_semi")
    lost = found.where("aland_m2 is null").count()
    if lost:
        raise ValueError(f"{lost} units have no land area")
    sinks.lookup_json(found.select("geography", "geo_id", F.struct("aland_m2", "awater_m2").alias("area")), "area").write.partitionBy("geography").text(job.snapshot.path("areas"))
    job.snapshot.live["areas"] = [job.snapshot.path("areas")]


def crosswalks(job: Refresh) -> None:
    """Crosswalks of the levels whose own changed."""
    before = {} if job.ledger is None else {r.geography: r.crosswalk_digest for r in job.ledger.groupBy("geography").agg(F.max_by("crosswalk_digest", "built_at").alias("crosswalk_digest")).collect()}
    for r in crosswalk_state(job.inputs.crosswalks).collect():
        if before.get(r.geography) != r.crosswalk_digest:
            sinks.write_sorted(job.inputs.crosswalks[r.geography], f"{job.snapshot.path('crosswalks')}/geography={r.geography}", ["geo_id", *CELL], row_group=sinks.CROSSWALK_ROW_GROUP)
            job.keep("crosswalks", [f"geography={r.geography}"])


def boundaries(job: Refresh) -> None:
    """Features of the levels that are drawn, without territories; levels that are not mapped are passed over."""
    for level, edges in job.inputs.edges.items():
        if not registry.level(level).mapped:
            job.log.append(f"{level} has no map")
            continue
        drawn = rings.features(rings.simplified_edges(agg.without_territories(edges), job.inputs.tolerance))
        sinks.features_json(drawn).select("json").write.text(f"{job.snapshot.path('boundaries')}/geography={level}")
        job.keep("boundaries", [f"geography={level}"])


def combine(job: Refresh) -> None:
    """All years of each dataset and level that has a new partition, from the live ones."""
    for dataset, dims in job.inputs.dims.items():
        levels = [g for d, g in job.changed("dataset", "geography") if d == dataset]
        if levels and any(f"/dataset={dataset}/" in p for p in job.snapshot.live.get("data", [])):
            live = store.read(job.spark, job.snapshot, "data", dataset).where(F.col("geography").isin(levels))
            store.write_combined(live, job.snapshot.path("combined"), list(dims))
            written = job.spark.read.parquet(job.snapshot.path("combined")).where(F.col("dataset") == dataset).select("geography").distinct().collect()
            job.keep("combined", [f"dataset={dataset}/geography={r.geography}" for r in written])


def catalog(job: Refresh) -> None:
    job.snapshot.live["ledger"] = [job.snapshot.path("ledger")]
    catalog_json(job.spark.read.parquet(job.snapshot.path("ledger"))).select("json").write.text(job.snapshot.path("catalog"))
    job.snapshot.live["catalog"] = [job.snapshot.path("catalog")]


STAGES: tuple[tuple[str, Callable[[Refresh], None]], ...] = (
    ("validate", validate), ("build", build), ("record", record), ("names", names), ("areas", areas), ("crosswalks", crosswalks), ("boundaries", boundaries), ("combine", combine), ("catalog", catalog),
)


def refresh(spark: SparkSession, root: str, inputs: Inputs, stages: tuple[tuple[str, Callable[[Refresh], None]], ...] = STAGES) -> Refresh | None:
    """Bring what is published below root up to date with the inputs; None if nothing is due.

    Nothing that readers see changes until all stages have ended: they write to folders of a new snapshot, which the commit
    names.  A stage that raises ends the job and leaves the old snapshot as it was.
    """
    last = store.current(spark, root)
    ledger = store.read(spark, last, "ledger") if last else None
    state = inputs.plan.join(source_state(spark, inputs.source), ["dataset", "year"]).join(crosswalk_state(inputs.crosswalks), "geography")
    path = f"{root}/due/{store.begin(spark, root).name}"
    due(state, ledger, inputs.version).write.parquet(path)
    job = Refresh(spark, inputs, store.begin(spark, root), ledger, spark.read.parquet(path))
    if last and job.due.isEmpty():
        return None
    for _, stage in stages:
        stage(job)
    store.commit(spark, job.snapshot)
    return job

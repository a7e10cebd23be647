"""Build plans, the catalog, and whole jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..registry import dataset, level


def build_plan(spark: SparkSession, datasets: list[str], levels: list[str], years: list[int] | None = None, done: DataFrame | None = None, version: str | None = None) -> DataFrame:
    """(dataset, geography, year, preliminary) to build: all final and preliminary years, or those given.

    An excluded year is rejected with its reason, an unknown one or a disabled level too.  Partitions that ``done`` has
    (dataset, geography, year, pipeline_version) at this version are left out.
    """
    known = [dataset(d) for d in datasets]
    for y in years or []:
        for d in known:
            if y in d.excluded:
                raise ValueError(f"{d.name} {y}: {d.excluded[y]}")
            if not d.first <= y <= d.last and y not in d.preliminary:
                raise ValueError(f"{d.name} has no year {y}")
    spans = spark.createDataFrame([(d.name, d.first, d.last, list(d.preliminary), sorted(d.excluded), [level(g).name for g in levels]) for d in known], "dataset string, first int, last int, extra array<int>, excluded array<int>, levels array<string>")
    wanted = spans.select("dataset", "extra", "excluded", "levels", F.explode(F.array_union(F.sequence("first", "last"), "extra")).alias("year")).where("not array_contains(excluded, year)")
    if years:
        wanted = wanted.where(F.col("year").isin(*years))
    plan = wanted.select("dataset", F.explode("levels").alias("geography"), "year", F.expr("array_contains(extra, year)").alias("preliminary"))
    if done is not None:
        plan = plan.join(done.where(F.col("pipeline_version") == version), ["dataset", "geography", "year"], "left_anti")
    return plan


def due(state: DataFrame, ledger: DataFrame | None, version: str) -> DataFrame:
    """(… of state, reason): wanted partitions that the ledger lacks or has from other inputs; what is current is left out.

    state: (dataset, geography, year, and the fingerprint source_bytes, source_modified, crosswalk_digest) as things are; ledger: the
    same as they were when a partition was built, and its pipeline_version.  reason: missing, version, source or crosswalk,
    the first that holds.
    """
    if ledger is None:
        return state.withColumn("reason", F.lit("missing"))
    key, marks = ["dataset", "geography", "year"], ["source_bytes", "source_modified", "crosswalk_digest"]
    was = ledger.select(*key, F.struct("pipeline_version", *marks).alias("was"))
    changed = lambda c: ~F.col(c).eqNullSafe(F.col(f"was.{c}"))
    reason = F.when(F.col("was").isNull(), "missing").when(~F.col("was.pipeline_version").eqNullSafe(F.lit(version)), "version").when(changed("source_bytes") | changed("source_modified"), "source").when(changed("crosswalk_digest"), "crosswalk")
    return state.join(was, key, "left").withColumn("reason", reason).where("reason is not null").drop("was")


def upsert(published: DataFrame, fresh: DataFrame, key: list[str]) -> DataFrame:
    """Published entries without those that ``fresh`` has anew, and all of ``fresh``."""
    return published.join(fresh.select(*key).distinct(), key, "left_anti").unionByName(fresh, allowMissingColumns=True)


def catalog_datasets(entries: DataFrame) -> DataFrame:
    """Per dataset: final and preliminary years and levels, each sorted."""
    years = lambda cond: F.array_sort(F.collect_set(F.when(cond, F.col("year"))))
    return entries.groupBy("dataset").agg(years(~F.col("preliminary")).alias("years"), years(F.col("preliminary")).alias("preliminary_years"), F.array_sort(F.collect_set("geography")).alias("geographies"))


def catalog_json(entries: DataFrame) -> DataFrame:
    """(dataset, json): each dataset's entries as one JSON array in order of level and year, with path, bytes and sha256 where the entries have them."""
    more = [c for c in ("path", "bytes", "sha256", "preliminary", "geo_units") if c in entries.columns]
    items = F.array_sort(F.collect_list(F.struct("geography", "year", "rows", F.round("total_raw", 1).alias("total_raw"), F.round("total_postprocessed", 1).alias("total_postprocessed"), *more)))
    return entries.groupBy("dataset").agg(F.to_json(items).alias("json"))


def inventory(entries: DataFrame) -> DataFrame:
    return entries.groupBy("dataset", "geography").agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.count("*").alias("files"), F.sum("rows").alias("rows"))


def catalog_lookup(entries: DataFrame, name: str, geography: str) -> DataFrame:
    return entries.where((F.col("dataset") == name) & (F.col("geography") == geography)).select("year").distinct().orderBy("year")


def levels_with_data(entries: DataFrame, ranks: DataFrame) -> DataFrame:
    """(geography, rank): levels with data, coarse to fine, unknown ones behind by name."""
    have = entries.select("geography").distinct()
    return have.join(F.broadcast(ranks), "geography", "left").select("geography", F.coalesce("rank", F.lit(2**31 - 1)).alias("rank")).orderBy("rank", "geography")

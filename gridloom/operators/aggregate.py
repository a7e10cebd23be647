"""Roll-ups of the source grid to units."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import decile, percent
from ..registry import CELL, MEASURES, TERRITORIES


def _dims(dims: list[str]) -> list:
    return [decile(F.col(d)).alias(d) if d == "income_decile" else F.col(d) for d in dims]


def _sums() -> list:
    return [F.sum(m).alias(m) for m in MEASURES]


def aggregate(source: DataFrame, crosswalk: DataFrame, dims: list[str], by: list[str] = []) -> DataFrame:  # noqa: B006
    """Both measures and n_cells by geo_id, dims and ``by``; cells outside the crosswalk drop out."""
    slim = source.select(*CELL, *by, *_dims(dims), *MEASURES)
    return slim.join(crosswalk.select(*CELL, "geo_id"), CELL).groupBy(*by, "geo_id", *dims).agg(*_sums(), F.count("*").alias("n_cells"))


def widen(crosswalks: dict[str, DataFrame]) -> DataFrame:
    """(cell, ids): the units of a cell at all levels, as one array of (level, geo_id)."""
    long = None
    for level, xw in crosswalks.items():
        part = xw.select(*CELL, F.struct(F.lit(level).alias("level"), "geo_id").alias("id"))
        long = part if long is None else long.unionByName(part)
    return long.groupBy(*CELL).agg(F.array_sort(F.collect_list("id")).alias("ids"))


def aggregate_levels(source: DataFrame, wide: DataFrame, dims: list[str], by: list[str] = []) -> DataFrame:  # noqa: B006
    """All levels from one read and one join: cells that share all their units are summed before they are dealt to levels."""
    slim = source.select(*CELL, *by, *_dims(dims), *MEASURES)
    first = slim.join(wide, CELL).groupBy("ids", *by, *dims).agg(*_sums(), F.count("*").alias("n_cells"))
    return first.select(F.inline("ids"), *by, *dims, *MEASURES, "n_cells").groupBy("level", *by, "geo_id", *dims).agg(*_sums(), F.sum("n_cells").alias("n_cells"))


def combine(fresh: DataFrame, published: DataFrame, key: list[str]) -> DataFrame:
    """All rows of ``fresh``, and those of ``published`` whose key it lacks."""
    return published.join(fresh.select(*key).distinct(), key, "left_anti").unionByName(fresh)


def partition_summary(partition: DataFrame, by: list[str]) -> DataFrame:
    return partition.groupBy(*by).agg(F.count("*").alias("rows"), F.countDistinct("geo_id").alias("geo_units"), F.round(F.sum(MEASURES[0]), 1).alias("total_raw"), F.round(F.sum(MEASURES[1]), 1).alias("total_postprocessed"))


def level_agreement(by_level: DataFrame) -> DataFrame:
    """Rounded totals of each level, and whether all levels have one total."""
    totals = by_level.groupBy("level").agg(F.round(F.sum(MEASURES[0])).alias("total_raw"), F.round(F.sum(MEASURES[1])).alias("total_postprocessed"))
    same = totals.agg((F.countDistinct("total_raw", "total_postprocessed") == 1).alias("agree"))
    return totals.join(F.broadcast(same))  # one row


def combined_faithful(combined: DataFrame, yearly: DataFrame) -> DataFrame:
    """Per year: sums of the combined table and of the yearly ones, and whether they are equal."""
    side = lambda df, name: df.groupBy("year").agg(F.count("*").alias(f"rows_{name}"), F.round(F.sum(MEASURES[0]), 6).alias(f"raw_{name}"))
    both = side(combined, "combined").join(side(yearly, "yearly"), "year", "full_outer")
    return both.withColumn("equal", F.col("rows_combined").eqNullSafe(F.col("rows_yearly")) & F.col("raw_combined").eqNullSafe(F.col("raw_yearly")))


def age_shift(source: DataFrame, category: str) -> DataFrame:
    """By how much post-processing shifts a category's margin, as a share of the raw one."""
    s = source.where(F.col("age_group") == category).agg(*_sums())
    return s.select(F.lit(category).alias("age_group"), *MEASURES, F.round((F.col(MEASURES[1]) - F.col(MEASURES[0])) / F.col(MEASURES[0]), 6).alias("shift"))


def units_match(crosswalk: DataFrame, partition: DataFrame) -> DataFrame:
    a, b = crosswalk.select("geo_id").distinct().withColumn("x", F.lit(1)), partition.select("geo_id").distinct().withColumn("a", F.lit(1))
    return a.join(b, "geo_id", "full_outer").agg(F.count("x").alias("in_crosswalk"), F.count("a").alias("in_aggregate"), F.count_if(F.col("x").isNull() | F.col("a").isNull()).alias("differing"))


def prefix_presence(partition: DataFrame, floors: dict[str, float]) -> DataFrame:
    """Population of id prefixes and whether it is above each one's floor; a missing prefix counts as 0."""
    spark = partition.sparkSession
    wanted = spark.createDataFrame(sorted(floors.items()), "prefix string, floor double")
    have = partition.groupBy(F.substring("geo_id", 1, 2).alias("prefix")).agg(F.sum(MEASURES[1]).alias("population"))
    return wanted.join(have, "prefix", "left").select("prefix", "floor", F.coalesce("population", F.lit(0.0)).alias("population"), (F.coalesce("population", F.lit(0.0)) > F.col("floor")).alias("present"))


def reconcile(partition: DataFrame, expected: DataFrame, dim: str, measure: str) -> DataFrame:
    """got, expected and their difference for each category of a pinned margin."""
    got = partition.groupBy(dim).agg(F.sum(measure).alias("got"))
    return expected.join(got, dim, "left").select(dim, "expected", F.coalesce("got", F.lit(0.0)).alias("got")).withColumn("difference", F.col("got") - F.col("expected"))


def cells_and_density(crosswalk: DataFrame, partition: DataFrame, areas: DataFrame, measure: str) -> DataFrame:
    """True cells of each unit (from the crosswalk) and people per square kilometre of land."""
    cells = crosswalk.groupBy("geo_id").agg(F.count("*").alias("cells"))
    people = partition.groupBy("geo_id").agg(F.sum(measure).alias("population"))
    out = cells.join(people, "geo_id", "left").join(areas, "geo_id", "left")
    return out.select("geo_id", "cells", "population", F.round(percent(F.col("population"), F.col("aland_m2")) * 10_000, 6).alias("per_km2"))


def areas_rollup(areas: DataFrame, mapping: DataFrame) -> DataFrame:
    """Areas of child units from those of their parents (parent_id, child_id), and of the nation from all units; parents without an area are skipped."""
    add = [F.sum(c).cast("long").alias(c) for c in ("aland_m2", "awater_m2")]
    child = areas.join(mapping, F.col("geo_id") == F.col("parent_id")).groupBy(F.col("child_id").alias("geo_id")).agg(*add).select(F.lit("child").alias("geography"), "geo_id", "aland_m2", "awater_m2")
    whole = areas.agg(*add).select(F.lit("nation").alias("geography"), F.lit("US").alias("geo_id"), "aland_m2", "awater_m2")
    return child.unionByName(whole)


def without_territories(df: DataFrame) -> DataFrame:
    return df.where(~F.substring("geo_id", 1, 2).isin(*TERRITORIES))

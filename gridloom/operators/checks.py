"""Data checks as Spark jobs; each gives rows (check_id, subject, metric, value, expected, status)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import is_territory, millidegrees, on_lattice, percent
from ..registry import CELL, MEASURES, TERRITORIES

COLUMNS = "check_id string, subject string, metric string, value double, expected double, status string"


def rows(df: DataFrame, check_id: str, subject: Column, metrics: dict[str, tuple[Column, Column | None]], status: Column) -> DataFrame:
    """One row for each metric (value, expected) of each row of df."""
    items = F.array(*[F.struct(F.lit(name).alias("metric"), v.cast("double").alias("value"), (F.lit(None) if e is None else e).cast("double").alias("expected")) for name, (v, e) in metrics.items()])
    return df.select(F.lit(check_id).alias("check_id"), subject.cast("string").alias("subject"), F.inline(items), status.alias("_s")).withColumnRenamed("_s", "status")


def _fail(bad: Column, other: str = "pass") -> Column:
    return F.when(bad, "fail").otherwise(other)


def category_check(source: DataFrame, values: DataFrame, dims: list[str]) -> DataFrame:
    """(dim, code, problem): codes that no one declared (error), nulls (error), declared codes that are absent (warning); one pass over the source."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("code")) for d in dims])
    found = source.select(F.inline(F.array_distinct(pairs))).distinct()
    declared = values.where(F.col("dim").isin(*dims)).select("dim", F.col("code").alias("declared"))
    f = found.withColumn("seen", F.lit(True))
    both = f.join(declared, (f["dim"] == declared["dim"]) & (f["code"] == declared["declared"]), "full_outer")
    problem = F.when(F.col("seen").isNull(), "warning: absent").when(f["code"].isNull(), "error: null").when(F.col("declared").isNull(), "error: unknown")
    return both.select(F.coalesce(f["dim"], declared["dim"]).alias("dim"), F.coalesce(f["code"], declared["declared"]).alias("code"), problem.alias("problem")).where("problem is not null")


def invariants(source: DataFrame, by: list[str], low: float, high: float) -> DataFrame:
    """National totals within bounds and no negative post-processed count, for each file."""
    s = source.groupBy(*by).agg(F.sum(MEASURES[0]).alias("raw"), F.sum(MEASURES[1]).alias("post"), F.count_if(F.col(MEASURES[1]) < 0).alias("neg"), F.count_if(F.col(MEASURES[0]) < 0).alias("raw_neg"))
    return rows(s, "A3", F.concat_ws("/", *by), {"total_raw": (F.col("raw"), None), "total_postprocessed": (F.col("post"), None), "negative_postprocessed": (F.col("neg"), F.lit(0)), "negative_raw": (F.col("raw_neg"), None)}, _fail((F.col("neg") > 0) | ~F.col("post").between(low, high)))


def race_margins(source: DataFrame, by: list[str], tolerance: float) -> DataFrame:
    m = source.groupBy(*by, "race_ethnicity").agg(F.sum(MEASURES[0]).alias("raw"), F.sum(MEASURES[1]).alias("post"))
    return m.withColumn("difference", F.abs(F.col("raw") - F.col("post"))).where(F.col("difference") > tolerance)


def source_manifest(wanted: DataFrame, found: DataFrame) -> DataFrame:
    """A1: files and bytes of every (dataset, year) that is wanted, found: (dataset, year, files, bytes); one without files fails, the rest informs."""
    j = wanted.select("dataset", "year").distinct().join(found, ["dataset", "year"], "left")
    return rows(j, "A1", F.concat_ws("/", "dataset", "year"), {"files": (F.coalesce("files", F.lit(0)), None), "bytes": (F.coalesce("bytes", F.lit(0)), None)}, _fail(F.coalesce("files", F.lit(0)) == 0, "info"))


def source_contract(columns: DataFrame, counts: DataFrame, low: int, high: int) -> DataFrame:
    """A2: columns of every source (subject, status) that break the contract, and its rows (subject, rows) against their bounds."""
    c = columns.groupBy("subject").agg(F.count_if(F.col("status") == "error").alias("violations"), F.count_if(F.col("status") == "warning").alias("warnings"))
    j = c.join(counts, "subject", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    status = F.when((F.col("violations") > 0) | ~F.col("rows").between(low, high), "fail").when(F.col("warnings") > 0, "warn").otherwise("pass")
    return rows(j, "A2", F.col("subject"), {"rows": (F.col("rows"), None), "violations": (F.col("violations"), F.lit(0)), "warnings": (F.col("warnings"), None)}, status)


def catalog_sizes(catalog: DataFrame, manifest: DataFrame, subject: Column) -> DataFrame:
    """A4: the files that the catalog advertises (path, bytes) exist with that many bytes; subject puts files together."""
    j = catalog.withColumn("subject", subject).join(manifest.select("path", F.col("bytes").alias("actual")), "path", "left")
    t = j.groupBy("subject").agg(F.count_if(F.col("actual").isNull()).alias("missing"), F.count_if(F.col("actual") != F.col("bytes")).alias("differing"))
    return rows(t, "A4", F.col("subject"), {"missing": (F.col("missing"), F.lit(0)), "differing": (F.col("differing"), F.lit(0))}, _fail((F.col("missing") > 0) | (F.col("differing") > 0)))


def catalog_checksums(catalog: DataFrame, checksums: DataFrame, subject: Column) -> DataFrame:
    """A5: the bytes of the files that the catalog advertises (path, sha256) still have the digests of when they were written."""
    j = catalog.withColumn("subject", subject).join(checksums.select("path", F.col("sha256").alias("actual")), "path", "left")
    t = j.groupBy("subject").agg(F.count_if(~F.col("actual").eqNullSafe(F.col("sha256"))).alias("differing"))
    return rows(t, "A5", F.col("subject"), {"differing": (F.col("differing"), F.lit(0))}, _fail(F.col("differing") > 0))


def names_against_areas(names: DataFrame, areas: DataFrame, shown: int = 10) -> DataFrame:
    """B1: ids with a name but no area or the other way round, and areas that are not positive; the first ``shown`` of each problem with how many more there are."""
    key = ["level", "geo_id"]
    j = names.select(*key, F.lit(True).alias("named")).join(areas.select(*key, "aland_m2", F.lit(True).alias("measured")), key, "full_outer")
    problem = F.when(F.col("measured").isNull(), "no area").when(F.col("named").isNull(), "no name").when(F.col("aland_m2") <= 0, "area not positive")
    p = j.withColumn("problem", problem).where("problem is not null")
    each = W.partitionBy("level", "problem")
    return p.withColumns({"k": F.row_number().over(each.orderBy("geo_id")), "n": F.count("*").over(each)}).where(F.col("k") <= shown).select("level", "problem", "geo_id", F.greatest(F.lit(0), F.col("n") - shown).alias("more"))


def area_totals(areas: DataFrame, reference_km2: float, tolerance: float = 0.01) -> DataFrame:
    """B2: rounded land totals of complete levels are one and within tolerance of the reference."""
    t = areas.groupBy("level").agg(F.round(F.sum("aland_m2") / 1e6).alias("km2"))
    n = t.agg(F.countDistinct("km2").alias("totals"))
    j = t.join(F.broadcast(n))  # one row
    return rows(j, "B2", F.col("level"), {"land_km2": (F.col("km2"), F.lit(reference_km2)), "distinct_totals": (F.col("totals"), F.lit(1))}, _fail((F.col("totals") > 1) | (F.abs(F.col("km2") - reference_km2) > tolerance * reference_km2)))


def unmatched(source: DataFrame, crosswalk: DataFrame, by: list[str], measure: str, inside: DataFrame | None = None) -> DataFrame:
    """C1: cells and population without a unit, for each file.  inside: unmatched cells that snapping should have reached; any of them fails."""
    cell = source.groupBy(*by, *CELL).agg(F.sum(measure).alias("p"))
    j = cell.join(crosswalk.select(*CELL, F.lit(True).alias("hit")), CELL, "left")
    if inside is not None:
        j = j.join(inside.select(*CELL, F.lit(True).alias("near")), CELL, "left")
    near = F.count_if(F.col("near")) if inside is not None else F.lit(0)
    t = j.groupBy(*by).agg(F.count("*").alias("cells"), F.count_if(F.col("hit").isNull()).alias("lost"), F.sum(F.when(F.col("hit").isNull(), F.col("p")).otherwise(0.0)).alias("people"), near.alias("near"))
    return rows(t, "C1", F.concat_ws("/", *by), {"cells": (F.col("cells"), None), "unmatched_cells": (F.col("lost"), None), "unmatched_population": (F.col("people"), None), "inside_radius": (F.col("near"), F.lit(0))}, _fail(F.col("near") > 0))


def one_unit_per_cell(crosswalk: DataFrame) -> DataFrame:
    """C2: rows, distinct cells and cells with several units."""
    c = crosswalk.groupBy(*CELL).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("*").alias("cells"), F.count_if(F.col("n") > 1).alias("dup"))
    return rows(c, "C2", F.lit("crosswalk"), {"rows": (F.col("rows"), None), "cells": (F.col("cells"), None), "duplicates": (F.col("dup"), F.lit(0))}, _fail(F.col("dup") > 0))


def snapped(crosswalk: DataFrame, source: DataFrame, measure: str) -> DataFrame:
    """C3: snapped cells and their population (information)."""
    people = source.groupBy(*CELL).agg(F.sum(measure).alias("p"))
    s = crosswalk.join(people, CELL, "left").agg(F.count("*").alias("rows"), F.countDistinct("geo_id").alias("units"), F.count_if("snapped").alias("snapped"), F.sum(F.when(F.col("snapped"), F.col("p")).otherwise(0.0)).alias("people"))
    return rows(s, "C3", F.lit("crosswalk"), {"rows": (F.col("rows"), None), "units": (F.col("units"), None), "snapped_cells": (F.col("snapped"), None), "snapped_population": (F.col("people"), None)}, F.lit("info"))


def nesting(child: DataFrame, parent: DataFrame, width: int, conflicts: DataFrame | None = None) -> DataFrame:
    """C4: a child unit's id begins with its cell's parent unit; snapped cells and known conflicts between layers are counted apart."""
    j = child.select(*CELL, F.col("geo_id").alias("c"), F.col("snapped").alias("cs")).join(parent.select(*CELL, F.col("geo_id").alias("p"), F.col("snapped").alias("ps")), CELL)
    if conflicts is not None:
        j = j.join(conflicts.select(*CELL, F.lit(True).alias("known")), CELL, "left")
    known = F.coalesce(F.col("known"), F.lit(False)) if conflicts is not None else F.lit(False)
    bad, moved = F.substring("c", 1, width) != F.col("p"), F.col("cs") | F.col("ps")
    t = j.agg(F.count("*").alias("n"), F.count_if(bad & moved).alias("s"), F.count_if(bad & ~moved & known).alias("k"), F.count_if(bad & ~moved & ~known).alias("x"))
    return rows(t, "C4", F.lit("child in parent"), {"cells": (F.col("n"), None), "snapped": (F.col("s"), None), "layer_conflict": (F.col("k"), None), "unexplained": (F.col("x"), F.lit(0))}, _fail(F.col("x") > 0))


def cell_keys(crosswalk: DataFrame) -> DataFrame:
    """C5: keys on the lattice, their extents, and cells in territories; all from distinct cells."""
    lon, lat = F.col("grid_lon"), F.col("grid_lat")
    t = crosswalk.agg(
        F.count_if(~(on_lattice(lon) & on_lattice(lat))).alias("off"), F.count_if(is_territory(F.col("geo_id"), TERRITORIES)).alias("terr"), F.min(millidegrees(lon)).alias("w"), F.max(millidegrees(lon)).alias("e"), F.min(millidegrees(lat)).alias("s"), F.max(millidegrees(lat)).alias("n"),
    )
    return rows(t, "C5", F.lit("crosswalk"), {"off_lattice": (F.col("off"), F.lit(0)), "territory_cells": (F.col("terr"), F.lit(0)), "west": (F.col("w") / 1000, None), "east": (F.col("e") / 1000, None), "south": (F.col("s") / 1000, None), "north": (F.col("n") / 1000, None)}, _fail((F.col("off") > 0) | (F.col("terr") > 0)))


def cell_drift(source: DataFrame, reference: int) -> DataFrame:
    """C6: cells of each year that the reference year lacks, and the other way round, all years in one shuffle."""
    cells = source.select("year", *CELL).distinct().groupBy(*CELL).agg(F.collect_set("year").alias("years"), F.max((F.col("year") == reference).cast("int")).alias("ref"))
    have = cells.select(F.explode("years").alias("year"), "ref").groupBy("year").agg(F.count("*").alias("n"), F.count_if(F.col("ref") == 0).alias("gained"))
    size = cells.where("ref = 1").count()
    t = have.withColumn("gone", F.lit(size) - (F.col("n") - F.col("gained")))
    return rows(t, "C6", F.col("year"), {"only_here": (F.col("gained"), None), "only_reference": (F.col("gone"), None)}, F.lit("info"))


def union_covered(cells: DataFrame, crosswalk: DataFrame, inside: DataFrame | None = None) -> DataFrame:
    """C7: cells of all years without a unit; one that snapping should reach fails."""
    lost = cells.select(*CELL).join(crosswalk.select(*CELL), CELL, "left_anti")
    near = lost.join(inside.select(*CELL), CELL, "left_semi").count() if inside is not None else 0
    t = lost.agg(F.count("*").alias("lost"))
    return rows(t, "C7", F.lit("all years"), {"uncovered": (F.col("lost"), None), "inside_radius": (F.lit(near), F.lit(0))}, _fail(F.lit(near > 0)))


def dropped_by_state(lost: DataFrame, published: DataFrame, shown: int = 15) -> DataFrame:
    """C8: dropped population (state, lost) against published totals (geo_id, population), as a share of what would be there; the largest shares."""
    a = lost.groupBy("state").agg(F.count("*").alias("cells"), F.sum("lost").alias("lost"))
    j = a.join(published, a["state"] == published["geo_id"], "left")
    s = j.select("state", "cells", "lost", "population", F.round(percent(F.col("lost"), F.col("lost") + F.col("population")), 6).alias("share"))
    status = F.when(F.col("population").isNull(), "skip").when(F.col("cells") > 0, "fail").otherwise("pass")
    return s.withColumn("status", status).orderBy(F.desc_nulls_last("share"), "state").limit(shown)


def run_all(spark, checks: dict[str, Callable[[], DataFrame]]) -> DataFrame:
    """All checks' rows in order of section and number; a check that raises becomes a failed row and the others go on."""
    out = None
    for check_id in sorted(checks, key=lambda c: (c[0], int(c[1:]))):
        try:
            found = spark.createDataFrame(checks[check_id]().collect(), COLUMNS)  # a few metrics
        except Exception as e:  # noqa: BLE001  a broken check is a finding, not an end of the run
            found = spark.createDataFrame([(check_id, "check", type(e).__name__, None, None, "fail")], COLUMNS)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], COLUMNS)

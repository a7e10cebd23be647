"""Source grid, crosswalk, boundaries and lookups derived from the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .tables import settle

#: SQL that Spark and DuckDB both run; {lineitem} is the table.
GRID = """
SELECT
  concat('-', cast(cast(floor(mlon / 1000) AS int) AS string), '.', lpad(cast(mlon % 1000 AS string), 3, '0')) AS grid_lon,
  concat(cast(cast(floor(mlat / 1000) AS int) AS string), '.', lpad(cast(mlat % 1000 AS string), 3, '0')) AS grid_lat,
  CASE concat(l_returnflag, l_linestatus) WHEN 'AF' THEN 'White' WHEN 'AO' THEN 'Black' WHEN 'NF' THEN 'Hispanic' WHEN 'NO' THEN 'Asian' WHEN 'RF' THEN 'AIAN' ELSE 'Other/Unknown' END AS race_ethnicity,
  CASE l_linenumber % 4 WHEN 0 THEN 'Under 18' WHEN 1 THEN '19-65' WHEN 2 THEN 'Over 65' ELSE 'Missing Age' END AS age_group,
  CASE l_partkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'Missing Gender' END AS sex,
  cast(cast(l_quantity AS int) % 11 AS double) AS income_decile, cast(yr AS int) AS year,
  cast(l_quantity - 4 AS double) AS n_noise, cast(greatest(l_quantity - 4, 0) AS double) AS n_noise_postprocessed
FROM (SELECT *, 100000 - ix * 10 - 5 AS mlon, 30000 + iy * 10 + 5 AS mlat FROM (SELECT *, l_partkey % 100 AS ix, l_orderkey % 60 AS iy, year(l_shipdate) AS yr FROM {lineitem}) k
      WHERE (ix * 7 + iy * 13 + yr) % 11 <> 0) m"""

UNITS = """
SELECT grid_lon, grid_lat, CASE WHEN x < -99.5 THEN '01001' WHEN (y - 30.0) < (-99.0 - x) * 1.2 THEN '01003' WHEN y < 30.6 - (x + 99.5) * 0.1 THEN '02001' END AS geo_id, y > 30.59 AS snapped
FROM (SELECT DISTINCT grid_lon, grid_lat, cast(grid_lon AS double) AS x, cast(grid_lat AS double) AS y FROM {grid}) c"""

RINGS = {
    "01001": ((-100.0, 30.0), (-99.5, 30.0), (-99.5, 30.6), (-100.0, 30.6)),
    "01003": ((-99.5, 30.0), (-99.0, 30.0), (-99.5, 30.6)),
    "02001": ((-99.0, 30.0), (-99.0, 30.55), (-99.5, 30.6)),
}
#: Corners (ring, seq, dx, dy) of a parcel and of the hole in it; all coordinates are exact in binary.
CORNERS = tuple((ring, k, low + (high - low) * x, low + (high - low) * y) for ring, low, high in ((0, 0.0, 0.25), (1, 0.0625, 0.125)) for k, (x, y) in enumerate(((0, 0), (1, 0), (1, 1), (0, 1))))
NAMES = (("01001", "West", "West County"), ("01003", "South", "South County"), ("02001", "North", None))
STATES = (("01", "Alpha", "AA"), ("02", "Beta", "BB"))
ID_MAP = (("01001", 1.0, "One"), ("01003", 1.0, "One"), ("02001", 12.0, "Twelve"))
AREAS = (("01001", 3_200_000_000, 10_000_000), ("01003", 1_600_000_000, 0), ("02001", 1_500_000_000, 5_000_000))
DATASET = "ageracesex"
#: Snapping radius of the fixture, in hundred-thousandths of a degree.
RADIUS, SCALE = 1500.0, 100_000.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(GRID, lineitem=table(spark, sf_dir, "lineitem"))


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell of all years with its unit, null outside all of them."""
    return units_of(spark, grid(spark, sf_dir))


def units_of(spark: SparkSession, cells: DataFrame) -> DataFrame:
    """The cells (grid_lon, grid_lat) once each with their units, written, so that Spark knows how few they are and does not shuffle a grid to meet them."""
    return settle(spark.sql(UNITS, grid=cells), "units")


def county(spark: SparkSession, sf_dir: str) -> DataFrame:
    return units(spark, sf_dir).where("geo_id is not null")


def state_of(crosswalk: DataFrame) -> DataFrame:
    return crosswalk.withColumn("geo_id", F.substring("geo_id", 1, 2))


def vertices(spark: SparkSession) -> DataFrame:
    rows = [(g, 0, 0, k, x, y) for g, ring in RINGS.items() for k, (x, y) in enumerate(ring)]
    return spark.createDataFrame(rows, "geo_id string, part int, ring int, seq int, x double, y double")


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vertices (geo_id, part, ring, seq, x, y) of one parcel for each part: squares in rows of 400, those of every fourth size with a hole."""
    k = F.col("p_partkey")
    corners = F.array(*[F.struct(F.lit(ring).alias("ring"), F.lit(seq).alias("seq"), F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for ring, seq, dx, dy in CORNERS])
    squares = table(spark, sf_dir, "part").select(k.cast("string").alias("geo_id"), (k % 400 / 4 - 100).alias("x"), (F.floor(k / 400) / 4 + 30).alias("y"), (F.col("p_size") % 4 == 0).alias("hollow"), F.inline(corners))
    return squares.where("ring = 0 or hollow").select("geo_id", F.lit(0).alias("part"), "ring", "seq", (F.col("x") + F.col("dx")).alias("x"), (F.col("y") + F.col("dy")).alias("y"))


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(parent_id, child, name): the parcels' ids and their brands, numbered as doubles."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("parent_id"), F.regexp_extract("p_brand", "([0-9]+)", 1).cast("double").alias("child"), F.col("p_brand").alias("name"))


def names(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(NAMES), "geo_id string, name string, namelsad string")


def states(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(STATES), "geo_id string, name string, stusps string")


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One unit for each part: (part, geo_id, name, namelsad, aland_m2, awater_m2); two of three have a longer name.  geo_id has six digits, so parts from 1,000,000 on share theirs with others; part does not."""
    k = F.col("p_partkey")
    longer = F.when(k % 3 != 0, F.concat("p_name", F.lit(" "), F.lower("p_type")))
    return table(spark, sf_dir, "part").select(k.cast("string").alias("part"), F.lpad(k.cast("string"), 6, "0").alias("geo_id"), F.col("p_name").alias("name"), longer.alias("namelsad"), (F.col("p_size").cast("long") * 1_000_003).alias("aland_m2"), (k % 1000).cast("long").alias("awater_m2"))


def place_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first digits of the units' ids are the nations' keys."""
    return table(spark, sf_dir, "nation").select(F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("geo_id"), F.col("n_name").alias("name"), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("stusps"))


def place_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(geo_id) of the parts that were ever ordered in quantity: the units that have data."""
    return table(spark, sf_dir, "lineitem").where("l_quantity > 40").select(F.lpad(F.col("l_partkey").cast("string"), 6, "0").alias("geo_id")).distinct()


def areas(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(AREAS), "geo_id string, aland_m2 long, awater_m2 long")


def id_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(ID_MAP), "parent_id string, child double, name string")

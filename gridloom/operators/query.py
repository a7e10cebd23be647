"""The query layer: filter, group and sum one measure; rankings, series, shares, labels and map classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import default_measure, percent
from ..registry import DEFAULT_MEASURE, MEASURES, RAW_ABOVE
from ..sinks import ROW_GROUP, write_sorted
from ..tables import settle

SMALL, SHOWN, CLASSES = 100, 500, 7
#: Stands after the end of a name in the search index.
END = "\n"


def where_facets(df: DataFrame, facets: dict[str, list]) -> DataFrame:
    """dim IN codes for each facet; an empty list does not filter."""
    for dim, codes in facets.items():
        if codes:
            df = df.where(F.col(dim).isin(*codes))
    return df


def query(df: DataFrame, measure: str, group: list[str] = [], facets: dict[str, list] = {}, place: str | None = None, year: int | None = None, limit: int | None = None) -> DataFrame:  # noqa: B006
    """Sum of one measure as ``value`` by the group columns, or in one row; the largest ``limit`` if given."""
    if measure not in MEASURES:
        raise ValueError(f"unknown measure {measure}")
    if year is not None:
        df = df.where(F.col("year") == year)
    if place is not None:
        df = df.where(F.col("geo_id") == place)
    out = where_facets(df, facets).groupBy(*group).agg(F.sum(measure).alias("value"))
    return out if limit is None else out.orderBy(F.desc("value"), *group).limit(limit)


def grouping(geography: str, place: str | None, dims: list[str]) -> list[str]:
    """By dimension where one unit is looked at, else by unit."""
    return dims if place or geography == "nation" else ["geo_id"]


def share(df: DataFrame, measure: str, facets: dict[str, list]) -> DataFrame:
    """(geo_id, value, total, share): what the facets select, in percent of all, in one pass."""
    chosen = F.lit(True)
    for dim, codes in facets.items():
        if codes:
            chosen = chosen & F.col(dim).isin(*codes)
    s = df.groupBy("geo_id").agg(F.sum(F.when(chosen, F.col(measure))).alias("value"), F.sum(measure).alias("total"), F.count_if(chosen).alias("n")).where("n > 0").drop("n")
    return s.withColumn("share", F.round(percent(F.col("value"), F.col("total")), 6))


def labelled(df: DataFrame, dim: str, values: DataFrame) -> DataFrame:
    """df with ``<dim>_label`` (the code itself where none is declared) and ``<dim>_rank`` (unknown codes last)."""
    v = values.where(F.col("dim") == dim).select(F.col("code").alias("_code"), F.col("label").alias("_label"), F.col("ord").alias("_ord"))
    joined = df.join(v, df[dim].cast("string") == F.col("_code"), "left")
    return joined.withColumns({f"{dim}_label": F.coalesce("_label", F.col(dim).cast("string")), f"{dim}_rank": F.coalesce("_ord", F.lit(2**31 - 1))}).drop("_code", "_label", "_ord")


def table_view(result: DataFrame, dims: list[str], values: DataFrame, names: DataFrame | None = None, shown: int = SHOWN) -> DataFrame:
    """A result as a table: labels, unit names, a flag for small numbers; in declared order of the first dimension, else largest first; the first ``shown`` rows."""
    out = result
    for d in dims:
        out = labelled(out, d, values)
    if names is not None:
        out = out.join(names, "geo_id", "left").withColumn("name", F.coalesce("name", "geo_id"))
    out = out.withColumn("is_small", F.abs("value") < SMALL)
    rest = [c for c in ("geo_id", *dims) if c in out.columns]  # so that the rows shown are the same each time
    order: list[Column] = [x for d in dims for x in (F.col(f"{d}_rank"), F.asc_nulls_last(f"{d}_label"))] + [F.desc_nulls_last("value"), *rest]
    return out.orderBy(*order).limit(shown).drop(*[f"{d}_rank" for d in dims])


def export(result: DataFrame, dims: list[str], values: DataFrame) -> DataFrame:
    """Codes with a label column beside each dimension whose labels differ from its codes."""
    differing = {r[0] for r in values.where("code <> label").select("dim").distinct().collect()}
    for d in dims:
        if d in differing:
            result = labelled(result, d, values).drop(f"{d}_rank")
    return result


def at_ranks(values: DataFrame, ranks: list[int], bins: int = 1024) -> list[float]:
    """The sorted values (finite doubles, column value) at these places, counted from 0, by histogram refinement.

    Each pass counts the values of ``bins`` equal parts of the ranges in question and goes on with the parts that hold a wanted
    place, until a part has one value only.  All values are counted, at most ``bins`` counts for each place reach the
    driver, and no value is sorted or moved.  A few passes do: each narrows a range a thousandfold.
    """
    low, high = values.agg(F.min("value"), F.max("value")).first()
    open_: dict[tuple[float, float], list[tuple[int, int]]] = {(low, high): [(k, r) for k, r in enumerate(ranks)]}  # range -> (which, place in it)
    found: dict[int, float] = {}
    while open_:
        for (a, b), asked in list(open_.items()):
            if a == b:
                found |= {k: a for k, _ in asked}
                del open_[a, b]
        if not open_:
            break
        number, part = F.lit(None).cast("int"), F.lit(None).cast("double")
        for n, (a, b) in enumerate(open_):
            inside = F.col("value").between(a, b)
            number = F.when(inside, n).otherwise(number)
            part = F.when(inside, (F.col("value") / 2 - a / 2) / (b / 2 - a / 2)).otherwise(part)  # halves: a range may be wider than the greatest double
        counted = values.select("value", number.alias("n"), F.least(F.floor(part * bins), F.lit(bins - 1)).alias("bin")).where("n is not null")
        rows = counted.groupBy("n", "bin").agg(F.count("*").alias("k"), F.min("value").alias("a"), F.max("value").alias("b")).orderBy("n", "bin").collect()
        narrowed: dict[tuple[float, float], list[tuple[int, int]]] = {}
        for n, asked in enumerate(open_.values()):
            before = 0
            for r in (r for r in rows if r.n == n):
                here = [(k, place - before) for k, place in asked if before <= place < before + r.k]
                if here:
                    narrowed.setdefault((r.a, r.b), []).extend(here)
                before += r.k
        open_ = narrowed
    return [found[k] for k in range(len(ranks))]


def quantile_breaks(values: DataFrame, n: int = CLASSES) -> DataFrame:
    """(value) of the class breaks: the sorted value at index floor(i N / n) for i = 1 .. n - 1, once each; all distinct values if there are fewer than n."""
    v = settle(values.where("value is not null").select(F.col("value").cast("double")), "values")
    total = v.count()
    if total < n:
        return v.distinct().orderBy("value")
    return values.sparkSession.createDataFrame([(x,) for x in sorted(set(at_ranks(v, [i * total // n for i in range(1, n)])))], "value double")


def choropleth(values: DataFrame, breaks: DataFrame) -> DataFrame:
    """values (geo_id, value) with class: how many breaks are at or below the value; null without a value."""
    limits = F.array(*[F.lit(float(r[0])) for r in breaks.collect()]).cast("array<double>")  # n - 1 numbers
    return values.withColumn("class", F.when(F.col("value").isNotNull(), F.size(F.filter(limits, lambda b: b <= F.col("value")))))


def measure_advice(df: DataFrame, used: str) -> DataFrame:
    """Per unit: its total of the measure in use, which measure suits that total, and whether it is the one in use."""
    t = df.groupBy("geo_id").agg(F.sum(used).alias("total"))
    advised = default_measure(F.col("total"), RAW_ABOVE, MEASURES[0], DEFAULT_MEASURE)
    return t.withColumn("advised", advised).withColumn("fits", F.col("advised") == used)


def default_year(years: DataFrame) -> DataFrame:
    """Newest year by dataset that is not preliminary, else the newest."""
    return years.groupBy("dataset").agg(F.coalesce(F.max(F.when(~F.col("preliminary"), F.col("year"))), F.max("year")).alias("year"))


#: Units of a segment of a search index, about.
SEGMENT = 25_000


def write_search_index(names: DataFrame, path: str, segment: int = SEGMENT) -> None:
    """An inverted index of units (level_rank, geo_id, name): each under the runs of three characters of its name, the last two also with an end after them, and the first two of its id.

    ``postings`` has segments of about ``segment`` units, which a task each makes by itself, sorted by gram in small row groups, so
    that the units of one gram are read by equality and no posting is shuffled; ``grams`` holds how many postings each has.
    """
    units = settle(names.where("geo_id is not null"), "units")
    parts = max(1, -(-units.count() // segment))
    dealt, ids, unit = units.repartition(parts, "level_rank", "geo_id", "name"), F.lower("geo_id"), ["level_rank", "geo_id", "name"]
    text = dealt.withColumn("text", F.concat(F.lower("name"), F.lit(END))).where("length(text) > 2")
    named = text.select(F.explode(F.sequence(F.lit(1), F.length("text") - 2)).alias("at"), "text", *unit).select(F.substring("text", F.col("at"), F.lit(3)).alias("gram"), *unit)
    begun = dealt.where(F.length(ids) > 1).select(F.concat(F.lit("^"), F.substring(ids, 1, 2)).alias("gram"), *unit)
    named.unionByName(begun).sortWithinPartitions("gram").write.mode("overwrite").option("compression", "zstd").option("parquet.block.row.count.limit", str(ROW_GROUP)).parquet(f"{path}/postings")
    write_sorted(units.sparkSession.read.parquet(f"{path}/postings").groupBy("gram").agg(F.count("*").alias("units")), f"{path}/grams", ["gram"])


def place_search(spark: SparkSession, path: str, text: str, most: int = 8, labels: dict[str, str] | None = None, in_all: int = 10) -> DataFrame:
    """(kind, level_rank, geo_id, name) of what a text finds in an index: units whose name contains it or whose id begins with it, coarse levels first, then by name; then datasets whose label (labels: name -> label) contains it.

    The text is trimmed and case does not count; it needs two characters.  Of its runs of three characters the one with the
    fewest units is read (of a text of two: all runs that begin with it), and those are held against the whole text.
    """
    t = text.strip().lower()
    found = spark.createDataFrame([], "kind string, level_rank int, geo_id string, name string")
    if len(t) < 2:
        return found
    if len(t) == 2:
        asked = F.col("gram").isin(["^" + t]) | F.startswith("gram", F.lit(t))
    else:
        grams = sorted({t[k : k + 3] for k in range(len(t) - 2)})
        counts = {r.gram: r.units for r in spark.read.parquet(f"{path}/grams").where(F.col("gram").isin(grams)).collect()}  # as many as the text has grams
        asked = F.col("gram").isin(["^" + t[:2], *([min(grams, key=lambda g: (counts[g], g))] if len(counts) == len(grams) else [])])
    near = spark.read.parquet(f"{path}/postings").where(asked)
    named = F.contains(F.lower("name"), F.lit(t)) | F.startswith(F.lower("geo_id"), F.lit(t))
    places = near.where(named).select("level_rank", "geo_id", "name").distinct().orderBy("level_rank", "name", "geo_id").limit(most)
    found = places.select(F.lit("place").alias("kind"), "level_rank", "geo_id", "name")
    fit = [("dataset", None, name, label) for name, label in (labels or {}).items() if t in label.lower()]
    both = found.unionByName(spark.createDataFrame(fit, found.schema)) if fit else found
    return both.orderBy(F.desc("kind"), F.asc_nulls_last("level_rank"), "name", "geo_id").limit(in_all)

"""Point-in-polygon and nearest-polygon joins as equi-joins, and shapes of boundaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions import lattice
from ..tables import settle, sized

_UP = ("case when y1 <= y2 then x1 else x2 end as x1", "least(y1, y2) as y1", "case when y1 <= y2 then x2 else x1 end as x2", "greatest(y1, y2) as y2")


def _upward(edges: DataFrame) -> DataFrame:
    """Edges without the horizontal ones, drawn upwards, so that two neighbours compute the same crossing bit for bit."""
    return edges.where("y1 <> y2").selectExpr("geo_id", *_UP)


def _crossing(y: F.Column) -> F.Column:
    return F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))


def covered_cells(edges: DataFrame) -> DataFrame:
    """(row, col, geo_id): lattice points inside each unit, by scanlines at the centroids' latitudes.

    Left and lower borders are inside, right and upper ones outside, so a point on a shared border is in one unit.
    The cost follows the covered cells; no inequality join is made.
    """
    row = lambda y: F.ceil((F.col(y) * 1000 - 5) / 10).cast("int")
    spans = _upward(edges).withColumns({"low": row("y1"), "high": row("y2") - 1}).where("low <= high")
    lines = spans.select("geo_id", "x1", "y1", "x2", "y2", F.explode(F.sequence("low", "high")).alias("row"))
    y = (F.col("row") * 10 + 5) / 1000
    hits = lines.where((F.col("y1") <= y) & (F.col("y2") > y)).select("geo_id", "row", _crossing(y).alias("xi"))
    line = W.partitionBy("geo_id", "row").orderBy("xi")
    pairs = hits.select("geo_id", "row", "xi", F.lead("xi").over(line).alias("xe"), F.row_number().over(line).alias("k")).where("k % 2 = 1 and xe is not null")
    col = lambda x: F.ceil(F.round(F.col(x) * 1000 - 5, 6) / 10).cast("int")
    inside = pairs.withColumns({"from": col("xi"), "to": col("xe") - 1}).where("from <= to")
    return inside.select("row", F.explode(F.sequence("from", "to")).alias("col"), "geo_id")


def scanline_join(cells: DataFrame, edges: DataFrame) -> DataFrame:
    """cells (grid_lon, grid_lat) with the geo_id of the unit that holds the centroid (null: none); of several the least."""
    one = covered_cells(edges).groupBy("row", "col").agg(F.min("geo_id").alias("geo_id"))
    keyed = cells.withColumns({"row": lattice(F.col("grid_lat")), "col": lattice(F.col("grid_lon"))})
    return keyed.join(one, ["row", "col"], "left").drop("row", "col")


def tiled(segs: DataFrame, side: float, shift: float = 0.0) -> DataFrame:
    """Segments in every tile (tx, ty) that they pass: row by row the columns between where they enter and leave it.  Tiles begin at multiples of ``side`` less ``shift``."""
    number = lambda v: F.floor((v + shift) / side).cast("long")
    rows = segs.withColumn("ty", F.explode(F.sequence(number(F.least("y1", "y2")), number(F.greatest("y1", "y2")))))
    at = lambda y: F.greatest(F.lit(0.0), F.least(F.lit(1.0), (y - F.col("y1")) / (F.col("y2") - F.col("y1"))))
    flat = F.col("y1") == F.col("y2")
    x = [F.when(flat, F.col(f"x{k + 1}")).otherwise(F.col("x1") + at((F.col("ty") + k) * side - shift) * (F.col("x2") - F.col("x1"))) for k in (0, 1)]
    pad = 1e-9 * side
    return rows.withColumn("tx", F.explode(F.sequence(number(F.least(*x) - pad), number(F.greatest(*x) + pad))))


#: Tiles begin off the multiples of their side, so that corners of tiles and points of grids don't lie on each other's lines.
SHIFT = 0.3819660112501051
DEEPEST = 40


def covering(edges: DataFrame, side: float) -> tuple[DataFrame, DataFrame]:
    """(inner, border): a hierarchical covering of each unit by tiles.

    border (geo_id, tx, ty, low_in, x1, y1, x2, y2): the edges of each tile that a unit's border passes, and whether its lower
    right corner lies inside.  inner (geo_id, ty, level, part): tiles inside, put together along a row to the largest runs of
    2 ** level tiles that begin at a multiple of it; a unit has a few runs in each row however wide it is.
    """
    shift = side * SHIFT
    passed = settle(tiled(edges, side, shift), "border")
    tiles = passed.select("geo_id", "tx", "ty").distinct()
    # crossings of the rows' lower lines, by tile: how many lie to the right of a tile tells whether its corner is inside
    row = lambda y: F.ceil((F.col(y) + shift) / side).cast("long")
    spans = _upward(edges).withColumns({"a": row("y1"), "b": row("y2") - 1}).where("a <= b")
    lines = spans.select("geo_id", "x1", "y1", "x2", "y2", F.explode(F.sequence("a", "b")).alias("ty"))
    at = F.col("ty") * side - shift
    hits = lines.select("geo_id", "ty", F.floor((_crossing(at) + shift) / side).cast("long").alias("tx")).groupBy("geo_id", "ty", "tx").agg(F.count("*").alias("n"))
    along = W.partitionBy("geo_id", "ty").orderBy("tx")
    beyond = F.coalesce(F.sum(F.coalesce("n", F.lit(0))).over(W.partitionBy("geo_id", "ty").orderBy(F.desc("tx")).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    marked = tiles.join(hits, ["geo_id", "ty", "tx"], "full_outer").withColumn("low_in", beyond % 2 == 1)
    marked = settle(marked.select("geo_id", "tx", "ty", "low_in", (F.lead("tx").over(along) - 1).alias("until")), "corners")
    runs = marked.where("low_in and until > tx").select("geo_id", "ty", (F.col("tx") + 1).alias("a"), F.col("until").alias("b"))
    span = lambda k: F.shiftleft(F.lit(1).cast("long"), k)
    levels = runs.withColumn("level", F.explode(F.sequence(F.lit(0), F.least(F.lit(DEEPEST), F.floor(F.log2(F.col("b") - F.col("a") + 1)).cast("int")))))
    first, last = F.ceil(F.col("a") / F.expr("shiftleft(1L, level)")).cast("long"), (F.floor((F.col("b") + 1) / F.expr("shiftleft(1L, level)")) - 1).cast("long")
    ends = levels.withColumns({"p": first, "q": last}).where("p <= q").select("*", F.explode(F.array_distinct(F.array("p", "q"))).alias("part"))
    whole = F.expr("shiftleft(shiftright(part, 1), level + 1) >= a and shiftleft(shiftright(part, 1) + 1, level + 1) - 1 <= b")  # the run twice as long is inside too
    inner = ends.where(~whole).select("geo_id", "ty", "level", "part")
    border = passed.join(sized(marked.select("geo_id", "tx", "ty", "low_in"), marked.count()), ["geo_id", "tx", "ty"])
    return inner, sized(border, passed.count())


def parity_join(points: DataFrame, edges: DataFrame, keys: list[str], side: float | None = None) -> DataFrame:
    """points (keys, x, y) with the geo_id that holds them (null: none; of several the least), at any coordinates.

    By a :func:`covering`: a point in a tile inside a unit meets none of its edges, and one in a border tile only the edges of
    that tile: from the tile's lower right corner up along its right side, then left to the point, every edge that is
    crossed changes inside and outside.  The last part is the crossing rule of the scanlines: left and lower borders are in.
    side: of the tiles; by default four times the mean of the edges' lengths.
    """
    edges = edges.where("x1 <> x2 or y1 <> y2")
    side = side or 4 * (edges.agg(F.avg(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")))).first()[0] or 1.0)
    shift = side * SHIFT
    inner, border = covering(edges, side)
    number = lambda v: F.floor((F.col(v) + shift) / side).cast("long")
    placed = points.select(*keys, "x", "y", number("x").alias("tx"), number("y").alias("ty"))
    deepest, many = inner.agg(F.max("level"), F.count("*")).first()
    runs = placed.select(*keys, "ty", F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(deepest or 0)), lambda k: F.call_function("shiftright", F.col("tx"), k))).alias("level", "part"))
    inside = runs.join(sized(inner, many), ["ty", "level", "part"]).select(*keys, "geo_id")
    up = "(case when y1 <= y2 then x1 else x2 end) + try_divide((y - least(y1, y2)) * (case when y1 <= y2 then x2 - x1 else x1 - x2 end), abs(y2 - y1))"
    right, low = (F.col("tx") + 1) * side - shift, F.col("ty") * side - shift
    met = placed.join(border, ["tx", "ty"]).withColumns({"right": right, "low": low})
    level = F.expr("least(y1, y2) <= y and y < greatest(y1, y2)") & (F.col("x") < F.expr(up)) & (F.expr(up) < F.col("right"))
    climb = F.expr("y1 + try_divide((right - x1) * (y2 - y1), x2 - x1)")
    side_cut = F.expr("least(x1, x2) <= right and right < greatest(x1, x2)") & (climb >= F.col("low")) & (climb < F.col("y"))
    crossed = F.when(level, 1).otherwise(0) + F.when(side_cut, 1).otherwise(0)
    near = met.groupBy(*keys, "geo_id").agg(((F.sum(crossed) + F.max(F.col("low_in").cast("int"))) % 2).alias("odd")).where("odd = 1").select(*keys, "geo_id")
    best = inside.unionByName(near).groupBy(*keys).agg(F.min("geo_id").alias("geo_id"))
    return points.join(best.hint("merge"), keys, "left")  # neither side is bounded


def _distance() -> F.Column:
    """From point (x, y) to segment (x1, y1)-(x2, y2)."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((F.col("x") - F.col("x1")) * dx + (F.col("y") - F.col("y1")) * dy) / (dx * dx + dy * dy)))
    return F.sqrt((F.col("x") - F.col("x1") - t * dx) ** 2 + (F.col("y") - F.col("y1") - t * dy) ** 2)


def snap_nearest(points: DataFrame, edges: DataFrame, keys: list[str], radius: float) -> DataFrame:
    """(keys, geo_id, distance) of the nearest unit within ``radius``; coordinates are planar and in the radius's unit.

    Segments lie in every tile (of side radius) of their bounding box, points look into the 3 x 3 tiles around them; ties go to the least id.
    """
    tile = lambda c: F.floor(F.col(c) / radius).cast("long")
    span = lambda a, b: F.explode(F.sequence(F.least(tile(a), tile(b)), F.greatest(tile(a), tile(b))))
    tiled = edges.where("x1 <> x2 or y1 <> y2").withColumn("tx", span("x1", "x2")).withColumn("ty", span("y1", "y2"))
    near = lambda c: F.explode(F.sequence(tile(c) - 1, tile(c) + 1))
    asked = points.select(*keys, "x", "y").withColumn("tx", near("x")).withColumn("ty", near("y"))
    best = asked.join(tiled, ["tx", "ty"]).withColumn("d", _distance()).where(F.col("d") <= radius)
    best = best.groupBy(*keys).agg(F.min(F.struct("d", "geo_id")).alias("m"))
    return best.select(*keys, F.col("m.geo_id").alias("geo_id"), F.col("m.d").alias("distance"))


#: Tiles, at most, that are broadcast to the points.
CARRIED = 1 << 19


def nearest(points: DataFrame, edges: DataFrame, keys: list[str], side: float | None = None, carried: int = CARRIED) -> DataFrame:
    """(keys, geo_id, distance) of the nearest unit however far, ties to the least id.

    Tiles that edges pass are put together to tiles of twice the side, and so on up to a few that hold all.  Points go down
    from these: of the tiles still in question those are left whose nearest corner is no farther than the farthest corner of
    any other, since an edge passes each of them.  At the bottom a point meets the edges of the tiles that are left, so
    its distance and the number of edges elsewhere do not matter.  Only points without coordinates, or all points where
    there is no edge, stay out.  side: of the smallest tiles; by default twice the mean of the edges' lengths.

    Points are dealt and sorted by their keys once and go down the levels of at most ``carried`` tiles where they are, since
    these are broadcast.  Of a larger level the tiles below those that points have reached are broadcast, if they are so few;
    else points and tiles are shuffled.
    """
    edges = settle(edges.where("x1 <> x2 or y1 <> y2"), "edges")
    side = side or 2 * (edges.agg(F.avg(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")))).first()[0] or 1.0)
    lines = settle(tiled(edges, side), "tiled")
    tiles = settle(lines.select("tx", "ty").distinct(), "tiles")
    ends = tiles.agg(F.min("tx"), F.max("tx"), F.min("ty"), F.max("ty")).first()
    if ends[0] is None:
        return points.where("false").select(*keys, F.lit(None).cast(edges.schema["geo_id"].dataType).alias("geo_id"), F.lit(None).cast("double").alias("distance"))
    at = lambda df, k: df.select(F.shiftright("tx", k).alias("tx"), F.shiftright("ty", k).alias("ty"))
    levels, top = [tiles], 0
    while ((ends[1] >> top) - (ends[0] >> top) + 1) * ((ends[3] >> top) - (ends[2] >> top) + 1) > 4:
        levels.append(settle(at(levels[top], 1).distinct(), "tiles"))
        top += 1
    roots = [F.struct(F.lit(r.tx).alias("tx"), F.lit(r.ty).alias("ty")) for r in levels[top].collect()]  # four at most
    spark = edges.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    asked = points.where("x is not null and y is not null").select(*keys, "x", "y").repartition(parts, *keys).select(*keys, "x", "y", F.inline(F.array(*roots)))
    for k in range(top - 1, -1, -1):
        below, few = levels[k], levels[k].count() <= carried
        if not few:
            asked = settle(asked, "asked")
            reached = settle(asked.select(F.col("tx").alias("ux"), F.col("ty").alias("uy")).distinct(), "reached")
            few = 4 * reached.count() <= carried
            if few:
                below = levels[k].join(F.broadcast(reached), (F.shiftright("tx", 1) == F.col("ux")) & (F.shiftright("ty", 1) == F.col("uy")), "left_semi")
                asked = asked.repartition(parts, *keys)
        below = below.select(F.shiftright("tx", 1).alias("ux"), F.shiftright("ty", 1).alias("uy"), "tx", "ty")
        met = asked.withColumnsRenamed({"tx": "ux", "ty": "uy"}).join(F.broadcast(below) if few else below, ["ux", "uy"])
        box = side * 2**k
        off = [(F.col(t) * box - F.col(c), F.col(c) - (F.col(t) + 1) * box) for t, c in (("tx", "x"), ("ty", "y"))]
        least = F.hypot(*[F.greatest(F.lit(0.0), *o) for o in off])
        most = F.hypot(*[F.greatest(F.abs(a), F.abs(b)) for a, b in off])
        bound = met.select(*keys, "x", "y", "tx", "ty", least.alias("least"), F.min(most).over(W.partitionBy(*keys, "x", "y")).alias("most"))
        asked = bound.where("least <= most * (1 + 1e-9) + 1e-9").select(*keys, "x", "y", "tx", "ty")
    asked = settle(asked, "asked")
    reached = settle(asked.select("tx", "ty").distinct(), "reached")
    if reached.count() <= carried:  # edges of tiles that no point has reached do not move
        lines = lines.join(F.broadcast(reached), ["tx", "ty"], "left_semi")
    best = asked.join(lines, ["tx", "ty"]).withColumn("d", _distance()).groupBy(*keys).agg(F.min(F.struct("d", "geo_id")).alias("m"))
    return best.select(*keys, F.col("m.geo_id").alias("geo_id"), F.col("m.d").alias("distance"))


def adjudicate(points: DataFrame, edges: DataFrame, keys: list[str], radius: float) -> DataFrame:
    """(keys, distance, within): distance 0 inside a unit, else to the nearest; within tells whether snapping would reach it."""
    held = settle(parity_join(points, edges, keys), "held")
    inside = held.where("geo_id is not null").select(*keys, F.lit(0.0).alias("distance"))
    outside = nearest(held.where("geo_id is null"), edges, keys).select(*keys, "distance")
    return inside.unionByName(outside).withColumn("within", F.col("distance") <= radius)


def adjudication(judged: DataFrame) -> DataFrame:
    """(inside, outside, farthest): how many points snapping would reach, how many not, and the greatest distance of the former."""
    return judged.agg(F.count_if("within").alias("inside"), F.count_if(~F.col("within")).alias("outside"), F.max(F.when(F.col("within"), F.col("distance"))).alias("farthest"))


def dissolve(edges: DataFrame, target: DataFrame) -> DataFrame:
    """Outer edges of merged units: target maps geo_id to the unit it joins; an edge that two members share cancels out."""
    mapped = edges.join(target, "geo_id")
    one_way = mapped.selectExpr("target", *[f"if(struct(x1, y1) > struct(x2, y2), {a}, {b}) as {c}" for a, b, c in (("x2", "x1", "x1"), ("y2", "y1", "y1"), ("x1", "x2", "x2"), ("y1", "y2", "y2"))])
    return one_way.groupBy("target", "x1", "y1", "x2", "y2").agg(F.count("*").alias("n")).where("n % 2 = 1").drop("n").withColumnRenamed("target", "geo_id")


def dissolve_by_parent(edges: DataFrame, mapping: DataFrame) -> DataFrame:
    """Dissolve by (parent_id, child_id); a unit without a child id is an error."""
    mapping = sized(mapping, mapping.count())
    lost = edges.select("geo_id").distinct().join(mapping, F.col("geo_id") == F.col("parent_id"), "left_anti").count()
    if lost:
        raise ValueError(f"{lost} units have no id to be dissolved into")
    return dissolve(edges, mapping.select(F.col("parent_id").alias("geo_id"), F.col("child_id").alias("target")))


def unit_boxes(vertices: DataFrame) -> DataFrame:
    """Bounding box of each unit; one wider than 180 degrees crosses the antimeridian."""
    box = vertices.groupBy("geo_id").agg(F.min("x").alias("west"), F.min("y").alias("south"), F.max("x").alias("east"), F.max("y").alias("north"))
    return box.withColumn("wraps", F.col("east") - F.col("west") > 180)

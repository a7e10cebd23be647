"""Boundaries as features: directed edges, dissolving, simplification of shared arcs, ring assembly and holes.

Edges are directed so that their unit lies to the left: outer rings run counterclockwise, holes clockwise.  All steps are
joins, groupings and windows over edges; what one task holds is bounded by the edges at one point, or by the points of
one piece of an arc, not by a ring or a unit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..tables import settle, sized
from .chains import ranked
from .spatial import tiled

ENDS = ["x1", "y1", "x2", "y2"]
#: Points of an arc that one task thins at a time; the points between pieces stay.
PIECE = 1024


def directed_edges(vertices: DataFrame) -> DataFrame:
    """(geo_id, x1, y1, x2, y2) of rings (geo_id, part, ring, seq, x, y): ring 0 of a part counterclockwise, the others clockwise, whichever way they came."""
    each = ["geo_id", "part", "ring"]
    along, whole = W.partitionBy(*each).orderBy("seq"), W.partitionBy(*each)
    first = along.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    nxt = lambda c: F.coalesce(F.lead(c).over(along), F.first(c).over(first))
    e = vertices.select(*each, F.col("x").alias("x1"), F.col("y").alias("y1"), nxt("x").alias("x2"), nxt("y").alias("y2"))
    e = e.withColumn("area", F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")).over(whole)).where("x1 <> x2 or y1 <> y2")
    turn = (F.col("ring") == 0) != (F.col("area") > 0)
    return e.select("geo_id", *[F.when(turn, F.col(b)).otherwise(F.col(a)).alias(a) for a, b in zip(ENDS, ("x2", "y2", "x1", "y1"))])


def net(edges: DataFrame) -> DataFrame:
    """Edges that a unit has an odd number of times, in either direction, once: two that run against each other cancel out."""
    up = F.struct("x1", "y1") < F.struct("x2", "y2")
    low = [F.when(up, F.col(a)).otherwise(F.col(b)).alias(f"_{a}") for a, b in zip(ENDS, ("x2", "y2", "x1", "y1"))]
    one = edges.select("geo_id", *low, F.when(up, 1).otherwise(-1).alias("way"))
    left = one.groupBy("geo_id", *[f"_{c}" for c in ENDS]).agg(F.count("*").alias("n"), F.sum("way").alias("way")).where("n % 2 = 1")
    return left.select("geo_id", *[F.when(F.col("way") > 0, F.col(f"_{a}")).otherwise(F.col(f"_{b}")).alias(a) for a, b in zip(ENDS, ("x2", "y2", "x1", "y1"))])


def merged(edges: DataFrame, target: DataFrame) -> DataFrame:
    """Directed outer edges of merged units; target maps geo_id to the unit it joins (target).  A unit without one is an error."""
    target = sized(target.select("geo_id", "target"), target.count())
    lost = edges.select("geo_id").distinct().join(target, "geo_id", "left_anti").count()
    if lost:
        raise ValueError(f"{lost} units have no id to be dissolved into")
    return net(edges.join(target, "geo_id").select(F.col("target").alias("geo_id"), *ENDS))


# --- arcs and their simplification


def arcs(edges: DataFrame) -> DataFrame:
    """(sides, arc, k, x1, y1, x2, y2): each border once, with the units beside it, its arc and its place there, which counts up to 0.

    sides: array of (geo_id, forward) of the units whose edge it is, and whether theirs runs this way; the least unit's does.
    An arc is a run of edges with the same sides between junctions, points where other than two borders meet.
    """
    up = F.struct("x1", "y1") < F.struct("x2", "y2")
    low = [F.when(up, F.col(a)).otherwise(F.col(b)).alias(a) for a, b in zip(ENDS, ("x2", "y2", "x1", "y1"))]
    shared = edges.select(F.struct("geo_id", up.alias("forward")).alias("side"), *low).groupBy(*ENDS).agg(F.array_sort(F.collect_set("side")).alias("s"))  # the units at one edge
    turn = ~F.col("s")[0]["forward"]
    sides = F.transform("s", lambda x: F.struct(x["geo_id"].alias("geo_id"), (x["forward"] != turn).alias("forward")))
    one = shared.select(sides.alias("sides"), *[F.when(turn, F.col(b)).otherwise(F.col(a)).alias(a) for a, b in zip(ENDS, ("x2", "y2", "x1", "y1"))])
    one = settle(one.withColumn("e", F.xxhash64(*ENDS)), "borders")
    end = lambda k, c: one.select(F.col(f"x{k}").alias("x"), F.col(f"y{k}").alias("y"), F.to_json("sides").alias("key"), F.col("e").alias(c))
    met = end(2, "before").unionByName(end(1, "after"), allowMissingColumns=True).groupBy("x", "y").agg(F.count("*").alias("n"), F.min("key").alias("a"), F.max("key").alias("b"), F.max("before").alias("before"), F.max("after").alias("after"))
    follows = met.where("n = 2 and a = b and before is not null and after is not null").select(F.col("before").alias("e"), F.col("after").alias("nxt"))
    places = ranked(one.select("e").join(sized(follows, one.count()), "e", "left"))
    return one.join(sized(places, one.count()), "e").select("sides", F.col("chain").alias("arc"), F.col("rank").alias("k"), *ENDS)


def _kept(x: np.ndarray, y: np.ndarray, tolerance: float) -> np.ndarray:
    """Which points of a line stay (Douglas-Peucker): every other lies within tolerance of the segment that takes its place."""
    keep = np.zeros(len(x), bool)
    keep[[0, -1]] = True
    stack = [(0, len(x) - 1)]
    while stack:
        a, b = stack.pop()
        if b - a < 2:
            continue
        px, py, dx, dy = x[a + 1 : b] - x[a], y[a + 1 : b] - y[a], x[b] - x[a], y[b] - y[a]
        norm = dx * dx + dy * dy
        t = np.clip((px * dx + py * dy) / norm, 0, 1) if norm else np.zeros(len(px))
        d = np.hypot(px - t * dx, py - t * dy)
        far = int(d.argmax())
        if d[far] > tolerance:
            at = a + 1 + far
            keep[at] = True
            stack += [(a, at), (at, b)]
    return keep


def thinned(lines: DataFrame, tolerance: float, piece: int = PIECE) -> DataFrame:
    """Edges of :func:`arcs` with (piece, seg): seg is the k of the edge that begins the segment which takes their place.

    Pieces come to a task one after the other, so it holds one of them and a batch at a time, and short arcs, which most are,
    cost no call of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def dealt(t: pa.Table, ends: list[int]) -> pa.RecordBatch:
            x1, y1, x2, y2, k = (t.column(c).to_numpy() for c in (*ENDS, "k"))
            seg = k.copy()
            for a, b in zip([0, *ends], ends):
                if b - a > 1:
                    keep = _kept(np.append(x1[a:b], x2[b - 1]), np.append(y1[a:b], y2[b - 1]), tolerance)[:-1]
                    seg[a:b] = k[a:b][np.maximum.accumulate(np.where(keep, np.arange(b - a), 0))]
            return t.append_column("seg", pa.array(seg)).combine_chunks().to_batches()[0]

        left = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if left is None else pa.concat_tables([left, t]).combine_chunks()
            if not t.num_rows:
                continue
            arc, number = t.column("arc").to_numpy(), t.column("piece").to_numpy()
            ends = (np.flatnonzero((arc[1:] != arc[:-1]) | (number[1:] != number[:-1])) + 1).tolist()
            if ends:  # the last piece may go on in the next batch
                yield dealt(t.slice(0, ends[-1]), ends)
            left = t.slice(ends[-1] if ends else 0)
        if left is not None and left.num_rows:
            yield dealt(left, [left.num_rows])

    numbered = lines.select("arc", F.floor(-F.col("k") / piece).cast("long").alias("piece"), "k", *ENDS)
    return numbered.repartition("arc", "piece").sortWithinPartitions("arc", "piece", "k").mapInArrow(run, "arc long, piece long, k long, x1 double, y1 double, x2 double, y2 double, seg long")


def segments(edges: DataFrame) -> DataFrame:
    """(arc, piece, seg, n, x1, y1, x2, y2) of thinned edges; n: edges in whose place it is.  A segment without length is none."""
    s = edges.groupBy("arc", "piece", "seg").agg(F.count("*").alias("n"), F.min_by(F.struct("x1", "y1"), "k").alias("a"), F.max_by(F.struct("x2", "y2"), "k").alias("b"))
    return s.select("arc", "piece", "seg", "n", F.col("a.x1").alias("x1"), F.col("a.y1").alias("y1"), F.col("b.x2").alias("x2"), F.col("b.y2").alias("y2"))


def _turn(a: str, b: str, c: str) -> Column:
    """Side of c from the line a b: 1 left, -1 right, 0 on it but for rounding; names are prefixes of x and y."""
    dx, dy, px, py = F.col(f"{b}x") - F.col(f"{a}x"), F.col(f"{b}y") - F.col(f"{a}y"), F.col(f"{c}x") - F.col(f"{a}x"), F.col(f"{c}y") - F.col(f"{a}y")
    cross = dx * py - dy * px
    return F.when(F.abs(cross) <= 1e-12 * (F.abs(dx) + F.abs(dy)), 0).otherwise(F.signum(cross)).cast("int")


def conflicts(segs: DataFrame) -> DataFrame:
    """(arc, piece, seg) of the segments that cross, touch or overlap another elsewhere than at a common end, and have points to put back.

    Segments meet in the tiles they pass, whose side follows their mean length.
    """
    lengths, many = segs.agg(F.avg(F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))), F.count("*")).first()
    if not lengths:
        return segs.where("false").select("arc", "piece", "seg")
    own = tiled(segs.where("x1 <> x2 or y1 <> y2").withColumn("id", F.xxhash64("arc", "piece", "seg")), 2 * lengths)
    a = own.select("tx", "ty", F.col("id").alias("ida"), F.struct("arc", "piece", "seg", "n").alias("sa"), *[F.col(c).alias(n) for c, n in zip(ENDS, ("px", "py", "qx", "qy"))])
    b = own.select("tx", "ty", F.col("id").alias("idb"), F.struct("arc", "piece", "seg", "n").alias("sb"), *[F.col(c).alias(n) for c, n in zip(ENDS, ("rx", "ry", "sx", "sy"))])
    overlap = " and ".join(f"greatest(least(p{c}, q{c}), least(r{c}, s{c})) <= least(greatest(p{c}, q{c}), greatest(r{c}, s{c})) + 1e-12" for c in "xy")
    near = a.join(sized(b, many), ["tx", "ty"]).where(F.expr(f"ida < idb and (sa.n > 1 or sb.n > 1) and {overlap}"))
    near = near.withColumns({"o1": _turn("p", "q", "r"), "o2": _turn("p", "q", "s"), "o3": _turn("r", "s", "p"), "o4": _turn("r", "s", "q")})
    between = lambda z, u, v: F.expr(f"{z}x between least({u}x, {v}x) - 1e-12 and greatest({u}x, {v}x) + 1e-12 and {z}y between least({u}y, {v}y) - 1e-12 and greatest({u}y, {v}y) + 1e-12 and not ({z}x = {u}x and {z}y = {u}y) and not ({z}x = {v}x and {z}y = {v}y)")
    proper = (F.col("o1") * F.col("o2") < 0) & (F.col("o3") * F.col("o4") < 0)
    touch = ((F.col("o1") == 0) & between("r", "p", "q")) | ((F.col("o2") == 0) & between("s", "p", "q")) | ((F.col("o3") == 0) & between("p", "r", "s")) | ((F.col("o4") == 0) & between("q", "r", "s"))
    same = F.expr("(px = rx and py = ry and qx = sx and qy = sy) or (px = sx and py = sy and qx = rx and qy = ry)")
    hit = near.where(proper | touch | same)
    return hit.select(F.inline(F.array("sa", "sb"))).where("n > 1").select("arc", "piece", "seg").distinct()


def simplify(edges: DataFrame, tolerance: float, piece: int = PIECE) -> tuple[DataFrame, DataFrame]:
    """(lines, thin) of directed edges: the arcs, and their edges dealt to segments, of which none crosses another.

    Arcs are thinned in pieces of bounded size, each once for all units beside it, so that neighbours agree.  Segments that
    cross or touch others get all their points back, until there are none; a dropped point is within tolerance of its segment.
    """
    lines = settle(arcs(edges), "arcs")
    thin = settle(thinned(lines, tolerance, piece), "thinned")
    while True:
        bad = settle(conflicts(settle(segments(thin), "segments")), "conflicts")
        if bad.isEmpty():
            return lines, thin
        thin = settle(thin.join(sized(bad.withColumn("back", F.lit(True))), ["arc", "piece", "seg"], "left").withColumn("seg", F.when(F.col("back"), F.col("k")).otherwise(F.col("seg"))).drop("back"), "thinned")


def simplified_edges(edges: DataFrame, tolerance: float, piece: int = PIECE) -> DataFrame:
    """Directed edges of all units after :func:`simplify`."""
    lines, thin = simplify(edges, tolerance, piece)
    beside = lines.groupBy("arc").agg(F.first("sides").alias("sides"))  # the same on all edges of an arc
    s = segments(thin).where("x1 <> x2 or y1 <> y2").join(sized(beside, lines.count()), "arc").select(F.inline("sides"), *ENDS)
    return net(s.select("geo_id", *[F.when(F.col("forward"), F.col(a)).otherwise(F.col(b)).alias(a) for a, b in zip(ENDS, ("x2", "y2", "x1", "y1"))]))


def simplified_arcs(edges: DataFrame, tolerance: float, piece: int = PIECE) -> DataFrame:
    """(units, arc, seq, x, y): the points that are left of every arc, seq rising along it; units: the ids beside it, joined by ``|``."""
    lines, thin = simplify(edges, tolerance, piece)
    s = segments(thin).where("x1 <> x2 or y1 <> y2")
    ends = s.groupBy("arc").agg(F.max_by(F.struct(F.lit(1).cast("long").alias("seq"), F.col("x2").alias("x"), F.col("y2").alias("y")), "seg").alias("p")).select("arc", "p.*")
    points = s.select("arc", F.col("seg").alias("seq"), F.col("x1").alias("x"), F.col("y1").alias("y")).unionByName(ends)
    beside = lines.groupBy("arc").agg(F.array_join(F.transform(F.first("sides"), lambda x: x["geo_id"]), "|").alias("units"))
    return points.join(sized(beside, lines.count()), "arc").select("units", "arc", "seq", "x", "y")


# --- rings


def assembled(edges: DataFrame) -> DataFrame:
    """(geo_id, ring, k, x1, y1, x2, y2): directed edges of each unit in their closed rings, k in order.

    At a point where several rings of a unit meet, an edge is followed by the first one clockwise from where it came, so
    rings never cross.  Edges that do not close are an error.
    """
    own = settle(edges.withColumn("e", F.xxhash64("geo_id", *ENDS)), "outline")
    angle = lambda a, b: F.atan2(F.col(f"y{b}") - F.col(f"y{a}"), F.col(f"x{b}") - F.col(f"x{a}")).alias("angle")
    into = own.select("geo_id", F.col("x2").alias("x"), F.col("y2").alias("y"), angle(2, 1), F.col("e").alias("before"), F.lit(None).cast("long").alias("after"))
    out = own.select("geo_id", F.col("x1").alias("x"), F.col("y1").alias("y"), angle(1, 2), F.lit(None).cast("long").alias("before"), F.col("e").alias("after"))
    around = W.partitionBy("geo_id", "x", "y").orderBy("angle")
    clockwise = F.coalesce(F.last("after", True).over(around.rowsBetween(W.unboundedPreceding, -1)), F.last("after", True).over(around.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    follows = settle(into.unionByName(out).select("before", clockwise.alias("nxt")).where("before is not null"), "successors")
    odd = follows.agg(F.count("*") - F.countDistinct("nxt")).first()[0]
    if odd:
        raise ValueError(f"{odd} edges do not close to rings")
    places = ranked(follows.select(F.col("before").alias("e"), "nxt"))
    return own.join(sized(places, own.count()), "e").select("geo_id", F.col("chain").alias("ring"), F.col("rank").alias("k"), *ENDS)


def nested(edges: DataFrame) -> DataFrame:
    """(geo_id, ring, area, points, part) of assembled rings: a hole's part is the least outer ring of its unit around it, an outer ring's is itself.

    A hole is placed by the middle of one of its edges: the parity of crossings to its right with the outer rings' edges in
    its band.  Rings of fewer than four points (the first again at the end) or without area go.
    """
    rings = edges.groupBy("geo_id", "ring").agg((F.sum(F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")) / 2).alias("area"), (F.count("*") + 1).alias("points"), F.min_by(F.struct(((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2).alias("y")), "k").alias("at"))
    rings = settle(rings.where("points >= 4 and abs(area) > 1e-15"), "rings")
    many, hollow = rings.agg(F.count("*"), F.count_if(F.col("area") < 0)).first()
    height = (edges.agg(F.avg(F.abs(F.col("y2") - F.col("y1")))).first()[0] or 0.5) * 2
    band = lambda y: F.floor(y / height).cast("long")
    outer = rings.where("area > 0").select("geo_id", "ring", F.col("area").alias("around"))
    holes = rings.where("area < 0").select("geo_id", F.col("ring").alias("hole"), F.col("at.x").alias("x"), F.col("at.y").alias("y")).withColumn("band", band(F.col("y")))
    lines = edges.where("y1 <> y2").join(sized(outer, many), ["geo_id", "ring"]).join(sized(holes.select("geo_id").distinct()), "geo_id", "left_semi")
    lines = lines.withColumn("band", F.explode(F.sequence(band(F.least("y1", "y2")), band(F.greatest("y1", "y2")))))
    met = sized(holes, hollow).join(lines, ["geo_id", "band"]).where("least(y1, y2) <= y and y < greatest(y1, y2) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1)")
    inside = met.groupBy("geo_id", "hole", "ring", "around").agg(F.count("*").alias("n")).where("n % 2 = 1")
    held = inside.groupBy("geo_id", "hole").agg(F.min(F.struct("around", "ring")).getField("ring").alias("part"))
    placed = rings.join(sized(held.withColumnRenamed("hole", "ring"), hollow), ["geo_id", "ring"], "left")
    return placed.where("area > 0 or part is not null").select("geo_id", "ring", "area", "points", F.coalesce("part", "ring").alias("part"))


def features(edges: DataFrame) -> DataFrame:
    """(geo_id, part, ring, seq, x, y): vertices of the units' polygons from directed edges in any order; ring 0 is the outer one of its part, the others are holes."""
    e = settle(assembled(edges), "assembled")
    rings = nested(e)
    number = F.row_number().over(W.partitionBy("geo_id", "part").orderBy(F.col("area") < 0, "ring")) - 1
    named = rings.withColumns({"number": number, "place": F.col("part")}).select("geo_id", "ring", "number", "place")
    return e.join(sized(named, e.count()), ["geo_id", "ring"]).select("geo_id", F.col("place").alias("part"), F.col("number").alias("ring"), F.col("k").alias("seq"), F.col("x1").alias("x"), F.col("y1").alias("y"))

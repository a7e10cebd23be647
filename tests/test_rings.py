"""Boundary features: ring assembly, holes, dissolving and simplification, against plain geometry."""

import collections
import json

import numpy as np
import pytest

from gridloom import queries, sinks, tables
from gridloom.operators import chains, rings


def area(points):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(points, points[1:])) / 2


def inside(point, polygons):
    n = 0
    for ring in (r for p in polygons for r in p):
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 <= point[1]) != (y2 <= point[1]) and point[0] < x1 + (point[1] - y1) * (x2 - x1) / (y2 - y1):
                n += 1
    return n % 2 == 1


def shapes(vertices):
    return {r.geo_id: json.loads(r.json)["geometry"]["coordinates"] for r in sinks.features_json(vertices).collect()}


def squares(spark, cells, turned=False):
    """Vertices of unit squares (geo_id, column, row); every other one runs clockwise if turned."""
    rows = []
    for n, (g, i, j) in enumerate(cells):
        ring = [(i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1)]
        ring = ring[::-1] if turned and n % 2 else ring
        rows += [(f"{g}#{n}", 0, 0, k, float(x), float(y)) for k, (x, y) in enumerate(ring)]
    return spark.createDataFrame(rows, "geo_id string, part int, ring int, seq int, x double, y double")


def targets(spark, cells):
    return spark.createDataFrame([(f"{g}#{n}", g) for n, (g, *_) in enumerate(cells)], "geo_id string, target string")


def test_ranked_chains_and_cycles(spark):
    rng = np.random.default_rng(1)
    ids, links, want = rng.permutation(500).tolist(), {}, []
    at = 0
    for n, closed in ((1, False), (1, True), (2, True), (37, False), (100, True), (129, False), (230, True)):
        run = ids[at : at + n]
        at += n
        links |= {a: b for a, b in zip(run, run[1:])}
        links[run[-1]] = run[0] if closed else None
        want.append((run, closed))
    got = {r.e: r for r in chains.ranked(spark.createDataFrame(list(links.items()), "e long, nxt long")).collect()}
    assert len(got) == at
    for run, closed in want:
        assert {got[e].chain for e in run} == {min(run) if closed else run[-1]} and {got[e].closed for e in run} == {closed}
        order = sorted(run, key=lambda e: got[e].rank)
        assert [got[e].rank for e in order] == list(range(1 - len(run), 1))
        assert all(links[a] == b for a, b in zip(order, order[1:]))
    assert chains.ranked(spark.createDataFrame([], "e long, nxt long")).count() == 0


def test_merged_squares_become_rings_with_holes(spark):
    """Random units on a grid: holes in holes, touching corners, several parts; against areas and cell centres."""
    rng = np.random.default_rng(2)
    cells = [("abc"[rng.choice(3, p=[0.6, 0.25, 0.15])], i, j) for i in range(14) for j in range(11)]
    cells += [("ring", 20 + i, j) for i in range(7) for j in range(7) if max(abs(i - 3), abs(j - 3)) in (1, 3)] + [("island", 23, 3)]
    edges = rings.merged(rings.directed_edges(squares(spark, cells, turned=True)), targets(spark, cells))
    got = shapes(rings.features(edges))
    count = collections.Counter(g for g, *_ in cells)
    assert got.keys() == count.keys()
    for g, polygons in got.items():
        for outer, *holes in polygons:
            assert outer[0] == outer[-1] and area(outer) > 0 and all(h[0] == h[-1] and area(h) < 0 for h in holes)
            assert all(inside(((h[0][0] + h[1][0]) / 2, (h[0][1] + h[1][1]) / 2 + 1e-9), [[outer]]) or area(outer) > 1 for h in holes)
        assert sum(area(r) for p in polygons for r in p) == count[g]
        assert {(i, j) for _, i, j in cells if inside((i + 0.5, j + 0.5), polygons)} == {(i, j) for h, i, j in cells if h == g}
    assert sorted(len(p) for p in got["ring"]) == [2, 2]  # an outer ring with a hole, and another in that hole
    with pytest.raises(ValueError, match="no id"):
        rings.merged(rings.directed_edges(squares(spark, cells[:3])), targets(spark, cells[:2]))
    with pytest.raises(ValueError, match="do not close"):
        rings.features(edges.limit(5))
    assert rings.features(edges.limit(0)).count() == 0


def strips(spark, n, m, seed, wild=0.3):
    """n strips side by side whose common borders are jagged lines of m points."""
    rng = np.random.default_rng(seed)
    lines = [[(k + (0 if j in (0, m) or k in (0, n) else rng.uniform(-wild, wild) * 0.2 + 0.15 * np.sin(j / 9)), j * 8 / m) for j in range(m + 1)] for k in range(n + 1)]
    rows = []
    for k in range(n):
        ring = lines[k + 1] + lines[k][::-1]
        rows += [(f"s{k}", 0, 0, s, float(x), float(y)) for s, (x, y) in enumerate(ring)]
    return lines, spark.createDataFrame(rows, "geo_id string, part int, ring int, seq int, x double, y double")


def crossings(segs):
    def turn(a, b, c):
        v = (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])
        return 0 if abs(v) < 1e-12 else np.sign(v)

    return sum(turn(a, b, c) * turn(a, b, d) < 0 and turn(c, d, a) * turn(c, d, b) < 0 for k, (a, b) in enumerate(segs) for c, d in segs[:k])


@pytest.mark.parametrize("piece", [rings.PIECE, 16])
def test_simplified_borders_agree_and_never_cross(spark, piece):
    lines, vertices = strips(spark, 4, 120, 3)
    edges = rings.directed_edges(vertices)
    tolerance = 0.12
    arcs, thin = rings.simplify(edges, tolerance, piece)
    segs = [((r.x1, r.y1), (r.x2, r.y2)) for r in rings.segments(thin).collect()]
    assert len(segs) < 0.8 * arcs.count() and crossings(segs) == 0
    of = {(r.arc, r.piece, r.seg): ((r.x1, r.y1), (r.x2, r.y2)) for r in rings.segments(thin).collect()}
    for r in thin.collect():  # each dropped point is near the segment in its place
        a, b = (np.array(p) for p in of[r.arc, r.piece, r.seg])
        p = np.array((r.x1, r.y1))
        t = np.clip((p - a) @ (b - a) / max((b - a) @ (b - a), 1e-30), 0, 1)
        assert np.linalg.norm(p - a - t * (b - a)) <= tolerance + 1e-12
    got = shapes(rings.features(rings.simplified_edges(edges, tolerance, piece)))
    assert sorted(got) == [f"s{k}" for k in range(4)] and all(len(p) == 1 and len(p[0]) == 1 for p in got.values())
    assert sum(area(p[0][0]) for p in got.values()) == pytest.approx(32.0)
    whole = shapes(rings.features(edges))
    assert all(abs(area(whole[g][0][0]) - area(got[g][0][0])) < tolerance * 16 for g in got)


def test_points_come_back_where_lines_would_cross(spark):
    """A spike of one border reaches into a bend of another, which would be cut straight across it."""
    bend = [(0, 0), (2, 0), (4, 0), (4, 1), (2.2, 1), (2, 0.3), (1.8, 1), (0, 1)]
    spike = [(1.85, 1), (2, 0.45), (2.15, 1), (2.1, 2), (1.9, 2)]
    rows = [(g, 0, 0, k, float(x), float(y)) for g, r in (("bend", bend), ("spike", spike)) for k, (x, y) in enumerate(r)]
    edges = rings.directed_edges(spark.createDataFrame(rows, "geo_id string, part int, ring int, seq int, x double, y double"))
    _, thin = rings.simplify(edges, 0.75)
    segs = [((r.x1, r.y1), (r.x2, r.y2)) for r in rings.segments(thin).collect()]
    assert crossings(segs) == 0 and rings.conflicts(rings.segments(thin)).count() == 0
    plain = rings.segments(rings.thinned(rings.arcs(edges), 0.75))
    assert rings.conflicts(plain).count() > 0


def test_small_rings_collapse(spark):
    rows = [("a", 0, 0, k, x, y) for k, (x, y) in enumerate(((0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)))] + [("a", 1, 0, k, x, y) for k, (x, y) in enumerate(((5.0, 5.0), (5.01, 5.0), (5.005, 5.01)))]
    edges = rings.directed_edges(spark.createDataFrame(rows, "geo_id string, part int, ring int, seq int, x double, y double"))
    got = shapes(rings.features(rings.simplified_edges(edges, 0.1)))
    assert len(got["a"]) == 1 and area(got["a"][0][0]) == 1.0


def test_an_arc_is_dealt_to_many_tasks(spark):
    n = 20_000
    t = np.linspace(0, 2 * np.pi, n, endpoint=False)
    r = 1 + 0.01 * np.sin(400 * t)
    rows = list(zip(["c"] * n, [0] * n, [0] * n, range(n), (r * np.cos(t)).tolist(), (r * np.sin(t)).tolist()))
    edges = rings.directed_edges(spark.createDataFrame(rows, "geo_id string, part int, ring int, seq int, x double, y double"))
    _, thin = rings.simplify(edges, 0.001)
    sizes = thin.groupBy("arc", "piece").count().collect()
    assert len(sizes) == -(-n // rings.PIECE) and max(s["count"] for s in sizes) <= rings.PIECE
    assert rings.segments(thin).count() < n / 3


def test_features_are_texts_of_their_rings(spark):
    """The JSON is that of nested arrays, whatever the order of rows, and no aggregate holds the points of more than a ring."""
    rows = [(g, p, r, s, x + 0.1 * s, (1e-7 if s % 2 else 12345.678) + r) for g, x in (('a"b', 1.5), ("c", -3.0)) for p in (10, 9) for r in (0, 1) for s, _ in enumerate("abcd" if r == 0 else "abcde")]
    df = spark.createDataFrame(rows[::-1], "geo_id string, part int, ring int, seq int, x double, y double").repartition(5)
    found = sinks.features_json(df)
    want = {g: [[[*line, line[0]] for r in (0, 1) for line in [[[x, y] for g_, p_, r_, _, x, y in rows if (g_, p_, r_) == (g, p, r)]]] for p in (9, 10)] for g in ('a"b', "c")}
    for row in found.collect():
        said = json.loads(row.json)
        assert said == {"type": "Feature", "properties": {"geo_id": row.geo_id}, "geometry": {"type": "MultiPolygon", "coordinates": want[row.geo_id]}}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list(struct(part") == 1 and "array<array<array" not in plan and "rings#" not in plan


def broadcasts(spark, since):
    """Rows of each table that was broadcast in executions from number ``since`` on, and the number of the next one, from Spark's own metrics."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    store, found, last = spark._jsparkSession.sharedState().statusStore(), [], since
    runs = store.executionsList()
    for n in (runs.apply(k).executionId() for k in range(runs.size())):
        last = max(last, n + 1)
        nodes, values = store.planGraph(n).allNodes(), store.executionMetrics(n)
        for node in (nodes.apply(k) for k in range(nodes.size())) if n >= since else ():
            for m in (node.metrics().apply(k) for k in range(node.metrics().size())) if node.name() == "BroadcastExchange" else ():
                if m.name() == "number of output rows" and values.contains(m.accumulatorId()):
                    found.append(int(values.apply(m.accumulatorId()).replace(",", "")))
    return found, last


def test_only_small_tables_reach_the_driver(spark, monkeypatch):
    """No table of more than FEW rows is broadcast, however few bytes its files have: neither edges, points nor rings."""
    monkeypatch.setattr(tables, "FEW", 100, raising=False)
    _, start = broadcasts(spark, 0)
    assert queries.QUERIES["boundaries_geojson"](spark, "/root/testdata/sf0.001").count() == 25
    found, _ = broadcasts(spark, start)
    assert found and max(found) <= 100

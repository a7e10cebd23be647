"""Geometry on closed-form shapes, rules of the query layer, and failure cases."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from gridloom import plans, registry, sinks, sources
from gridloom.functions import albers, decile, on_lattice, pad_id
from gridloom.operators import aggregate, checks, components, crosswalk, query, rings, spatial


def cells(spark, xs, ys):
    rows = [(f"{x:.3f}", f"{y:.3f}") for x in xs for y in ys]
    return spark.createDataFrame(rows, "grid_lon string, grid_lat string")


def polygon(spark, shapes):
    rows = [(g, p, r, k, float(x), float(y)) for g, p, r, ring in shapes for k, (x, y) in enumerate(ring)]
    return sources.boundary_edges(spark.createDataFrame(rows, "geo_id string, part int, ring int, seq int, x double, y double"))


def placed(df):
    return {(r.grid_lon, r.grid_lat): r.geo_id for r in df.collect()}


SQUARE = [("a", 0, 0, [(0, 0), (0.1, 0), (0.1, 0.1), (0, 0.1)])]


def grid_points(spark, low=-2, high=12):
    axis = [k * 0.01 + 0.005 for k in range(low, high)]
    return cells(spark, axis, axis)


def test_hole_and_multipart(spark):
    shapes = SQUARE + [("a", 0, 1, [(0.02, 0.02), (0.05, 0.02), (0.05, 0.05), (0.02, 0.05)]), ("b", 0, 0, [(0.1, 0), (0.12, 0), (0.12, 0.02), (0.1, 0.02)]), ("b", 1, 0, [(0.02, 0.02), (0.05, 0.02), (0.05, 0.05), (0.02, 0.05)])]
    points, edges = grid_points(spark), polygon(spark, shapes)
    got = placed(spatial.scanline_join(points, edges))
    for (lon, lat), g in got.items():
        x, y = float(lon), float(lat)
        hole = 0.02 < x < 0.05 and 0.02 < y < 0.05
        want = "b" if hole or (0.1 < x < 0.12 and 0 < y < 0.02) else "a" if 0 < x < 0.1 and 0 < y < 0.1 else None
        assert g == want, (lon, lat)
    xy = points.withColumns({"x": F.col("grid_lon").cast("double"), "y": F.col("grid_lat").cast("double")})
    assert placed(spatial.parity_join(xy, edges, registry.CELL)) == got


def test_centroid_on_shared_edge_has_one_unit(spark):
    shapes = [("l", 0, 0, [(0, 0), (0.055, 0), (0.055, 0.1), (0, 0.1)]), ("r", 0, 0, [(0.055, 0), (0.1, 0), (0.1, 0.1), (0.055, 0.1)])]
    got = placed(spatial.scanline_join(cells(spark, [0.055], [0.005, 0.095]), polygon(spark, shapes)))
    assert set(got.values()) == {"r"}


def test_snap_and_adjudicate(spark):
    points = spark.createDataFrame([("in", 0.05, 0.05), ("near", 0.13, 0.05), ("far", 3.0, 0.05)], "k string, x double, y double")
    edges = polygon(spark, SQUARE)
    snapped = {r.k: round(r.distance, 6) for r in spatial.snap_nearest(points.where("k <> 'in'"), edges, ["k"], 0.04).collect()}
    assert snapped == {"near": 0.03}
    judged = {r.k: (round(r.distance, 6), r.within) for r in spatial.adjudicate(points, edges, ["k"], 0.04).collect()}
    assert judged == {"in": (0.0, True), "near": (0.03, True), "far": (2.9, False)}
    assert spatial.adjudication(spatial.adjudicate(points, edges, ["k"], 0.04)).select("inside", "outside", F.round("farthest", 6)).first() == (2, 1, 0.03)


def test_crosswalk_snaps_only_complete_levels(spark):
    points, edges = grid_points(spark), polygon(spark, SQUARE)
    partial, whole = crosswalk.build(points, edges, False, 0.011), crosswalk.build(points, edges, True, 0.011)
    assert partial.count() == 100 and partial.where("snapped").count() == 0
    assert whole.where("not snapped").count() == 100 and whole.where("snapped").count() == 44
    empty = spark.createDataFrame([], "geo_id string, x1 double, y1 double, x2 double, y2 double")
    assert crosswalk.build(points, empty, True, 0.011).count() == 0


def test_remap_fails_on_a_lost_unit(spark):
    xw = spark.createDataFrame([("1", "1", "a", False)], "grid_lon string, grid_lat string, geo_id string, snapped boolean")
    with pytest.raises(ValueError):
        crosswalk.remap(xw, spark.createDataFrame([("b", "1")], "parent_id string, child_id string"))


def test_second_year_with_other_cells(spark):
    """A crosswalk of one year loses another year's new cells; the union of years does not."""
    src = spark.createDataFrame([("0.005", "0.005", 1, 5.0, 5.0), ("0.015", "0.005", 2, 7.0, 7.0)], "grid_lon string, grid_lat string, year int, n_noise double, n_noise_postprocessed double")
    first = crosswalk.constant(sources.cell_union(src.where("year = 1")), "US")
    assert [(r.year, r.lost) for r in crosswalk.dropped_cells(src, first, ["year"], "n_noise").collect()] == [(2, 7.0)]
    assert crosswalk.dropped_cells(src, crosswalk.constant(sources.cell_union(src), "US"), ["year"], "n_noise").count() == 0
    wide = aggregate.widen({"nation": first, "zone": first})
    assert {(r.level, r.n_cells) for r in aggregate.aggregate_levels(src, wide, []).collect()} == {("nation", 1), ("zone", 1)}


def test_simplify_keeps_shared_borders(spark):
    wave = [(0.05 + 0.001 * (k % 2), k * 0.01) for k in range(11)]
    shapes = [("l", 0, 0, [(0, 0), *wave, (0, 0.1)]), ("r", 0, 0, [(0.1, 0), (0.1, 0.1), *wave[::-1]])]
    rows = rings.simplified_arcs(polygon(spark, shapes), 0.005).collect()
    shared = [(r.x, r.y) for r in rows if r.units == "l|r"]
    assert sorted(shared) == [(0.05, 0.0), (0.05, 0.1)]


def test_arcs_are_cut_at_junctions(spark):
    """Three units about one point, a ring that is alone, and two rings that touch in a point."""
    shapes = [
        ("a", 0, 0, [(0, 0), (2, 0), (2, 1), (1, 1), (1, 2), (0, 2)]), ("b", 0, 0, [(2, 0), (3, 0), (3, 2), (2, 2), (2, 1)]), ("c", 0, 0, [(1, 1), (2, 1), (2, 2), (1, 2)]),
        ("d", 0, 0, [(10, 0), (11, 0), (12, 1), (11, 1)]), ("e", 0, 0, [(20, 0), (21, 0), (21, 1), (20, 1)]), ("e", 1, 0, [(21, 1), (22, 1), (22, 2), (21, 2)]),
    ]
    lines = {}
    for r in sorted(rings.simplified_arcs(polygon(spark, shapes), 1e-9).collect()):
        lines.setdefault((r.units, r.arc), []).append((r.x, r.y))
    got = sorted((units, len(p), p[0] == p[-1]) for (units, _), p in lines.items())
    assert got == [("a", 4, False), ("a|b", 2, False), ("a|c", 3, False), ("b", 4, False), ("b|c", 2, False), ("c", 2, False), ("d", 5, True), ("e", 5, True), ("e", 5, True)]


def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (250, 2))] + [(400 + k, 401 + k) for k in range(60)]
    label = {k: k for p in pairs for k in p}
    for _ in range(len(label)):
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.component for r in components.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {k: v for k, v in label.items() if any(a != b and k in (a, b) for a, b in pairs)}


def test_nearest_has_no_last_round(spark):
    """A point a million radii away is found; points without coordinates and tables without edges end the search."""
    points = spark.createDataFrame([("far", 4e4, 0.05), ("none", None, None)], "k string, x double, y double")
    found = spatial.nearest(points, polygon(spark, SQUARE), ["k"]).collect()
    assert [(r.k, r.geo_id, round(r.distance, 3)) for r in found] == [("far", "a", 39999.9)]
    assert spatial.nearest(points, polygon(spark, SQUARE).limit(0), ["k"]).count() == 0


def test_nearest_and_covering_against_all_edges(spark):
    """Points near, far and very far; units of many sizes, with holes; tiles of several sizes."""
    rng = np.random.default_rng(7)
    shapes = []
    for n in range(40):
        x, y, r = rng.uniform(-50, 50), rng.uniform(-50, 50), 10.0 ** rng.uniform(-2, 1)
        t = np.sort(rng.uniform(0, 2 * np.pi, 12))
        ring = lambda f: [(x + r * f * np.cos(a), y + r * f * np.sin(a)) for a in t]  # noqa: B023, E731
        shapes.append((f"u{n:02d}", 0, 0, ring(1.0)))
        if n % 3 == 0:
            shapes.append((f"u{n:02d}", 0, 1, ring(0.4)))
    edges = polygon(spark, shapes)
    lines = [tuple(r) for r in edges.collect()]
    at = [(k, *map(float, rng.normal(0, s, 2))) for k, s in enumerate(rng.choice([20.0, 60.0, 4000.0], 300))] + [(300, *lines[0][1:3]), (301, *lines[5][1:3])]
    points = spark.createDataFrame(at, "k long, x double, y double")
    g, (x1, y1, x2, y2) = [r[0] for r in lines], np.array([r[1:] for r in lines]).T
    near, held = {}, {}
    for k, x, y in at:
        t = np.clip(((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1)) / ((x2 - x1) ** 2 + (y2 - y1) ** 2), 0, 1)
        near[k] = min(zip(np.sqrt((x - x1 - t * (x2 - x1)) ** 2 + (y - y1 - t * (y2 - y1)) ** 2).tolist(), g))
        with np.errstate(divide="ignore", invalid="ignore"):
            up = (np.minimum(y1, y2) <= y) & (y < np.maximum(y1, y2)) & (x < np.where(y1 <= y2, x1 + (y - y1) * (x2 - x1) / (y2 - y1), x2 + (y - y2) * (x1 - x2) / (y1 - y2)))
        odd = [u for u in sorted(set(g)) if sum(o for o, v in zip(up, g) if v == u) % 2]
        held[k] = odd[0] if odd else None
    for side in (None, 0.7, 300.0):
        got = {r.k: (r.distance, r.geo_id) for r in spatial.nearest(points, edges, ["k"], side).collect()}
        assert got.keys() == near.keys() and all(abs(got[k][0] - near[k][0]) < 1e-9 and (got[k][1] == near[k][1] or got[k][0] == near[k][0]) for k in got)
        assert {r.k: r.geo_id for r in spatial.parity_join(points, edges, ["k"], side).collect()} == held
    inner, _ = spatial.covering(edges, 0.05)
    assert inner.where("level >= 6").count() > 0 and spatial.parity_join(points.limit(0), edges, ["k"]).count() == 0


def test_layer_conflict_places_cells_anew(spark):
    """A cell that was snapped into its child disagrees with its parent, but is no conflict of the layers."""
    xw = lambda rows: spark.createDataFrame([(*r, False) for r in rows], "grid_lon string, grid_lat string, geo_id string, snapped boolean")
    parent, child = xw([("0.005", "0.005", "a"), ("0.095", "0.005", "a"), ("0.205", "0.005", "a")]), xw([("0.005", "0.005", "b1"), ("0.095", "0.005", "a1"), ("0.205", "0.005", "b1")])
    edges = [polygon(spark, [(g, 0, 0, [(0, 0), (0.1, 0), (0.1, 0.1), (0, 0.1)])]) for g in ("a", "b1")]
    assert crosswalk.layer_conflict(parent, child, 1).count() == 2
    assert [r.grid_lon for r in crosswalk.layer_conflict(parent, child, 1, *edges).collect()] == ["0.005"]


def test_boundaries_of_a_collection(spark, tmp_path):
    one = '{"type":"Feature","properties":{"id":"%s"},"geometry":{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}}'
    (tmp_path / "a").mkdir(), (tmp_path / "b").mkdir()
    (tmp_path / "a/lines.json").write_text(one % "x" + "\n" + one % "y" + "\n")
    (tmp_path / "b/whole.json").write_text('{"features":[' + one % "x" + "," + one % "y" + "]}")
    rows = [sorted(map(tuple, sources.read_boundaries(spark, str(tmp_path / d), "id", "id", collection=d == "b").collect())) for d in "ab"]
    assert rows[0] == rows[1] and len(rows[0]) == 8


def test_dissolve_cancels_inner_borders(spark):
    edges = polygon(spark, SQUARE + [("b", 0, 0, [(0.1, 0), (0.2, 0), (0.2, 0.1), (0.1, 0.1)])])
    target = spark.createDataFrame([("a", "x"), ("b", "x")], "geo_id string, target string")
    assert spatial.dissolve(edges, target).count() == 6


def test_quantiles(spark):
    v = spark.createDataFrame([(float(k),) for k in range(14)], "value double")
    assert [r.value for r in query.quantile_breaks(v, 7).collect()] == [2.0, 4.0, 6.0, 8.0, 10.0, 12.0]
    assert [r.value for r in query.quantile_breaks(v.limit(3), 7).collect()] == [0.0, 1.0, 2.0]
    c = query.choropleth(spark.createDataFrame([("a", 4.0), ("b", None)], "geo_id string, value double"), query.quantile_breaks(v, 7))
    assert {r.geo_id: r["class"] for r in c.collect()} == {"a": 2, "b": None}


def test_scalars(spark):
    row = spark.range(1).select(decile(F.lit(1.7)), decile(F.lit(2.5)), decile(F.lit(3.5)), pad_id(F.lit(7.0), 2), pad_id(F.lit(123.0), 2), on_lattice(F.lit("-99.505")), on_lattice(F.lit("x"))).first()
    assert list(row)[:6] == [2, 2, 4, "07", "123", True] and not row[6]
    x, y = spark.range(1).select(*albers(F.lit(-96.0), F.lit(23.0))).first()
    assert abs(x) < 1e-6 and abs(y) < 1e-6


def test_plan(spark):
    plan = plans.build_plan(spark, ["ageracesex"], ["county"])
    assert plan.count() == 26 and plan.where("preliminary").count() == 1 and plan.where("year = 1999").count() == 0
    with pytest.raises(ValueError, match="too few"):
        plans.build_plan(spark, ["ageracesex"], ["county"], [1999])
    with pytest.raises(ValueError):
        plans.build_plan(spark, ["ageracesex"], ["county"], [1980])
    with pytest.raises(ValueError, match="noise"):
        plans.build_plan(spark, ["ageracesex"], ["tract"])


def test_facets_of_two_datasets_are_refused():
    registry.check_facets("ageracesex", {"sex": ["F"], "race_ethnicity": []})
    with pytest.raises(ValueError, match="income_decile"):
        registry.check_facets("ageracesex", {"income_decile": ["3"]})


def test_runner_goes_on_after_an_error(spark):
    def broken():
        raise KeyError

    xw = spark.createDataFrame([("1", "1", "a", False), ("1", "1", "b", False)], "grid_lon string, grid_lat string, geo_id string, snapped boolean")
    rows = checks.run_all(spark, {"C10": broken, "C2": lambda: checks.one_unit_per_cell(xw)}).collect()
    assert [r.check_id for r in rows] == ["C2", "C2", "C2", "C10"] and {r.status for r in rows} == {"fail"}


def test_one_unit_touches_few_row_groups(spark, tmp_path):
    df = spark.range(4000).select(F.lpad((F.col("id") % 40).cast("string"), 2, "0").alias("geo_id"), "id")
    path = str(tmp_path / "p")
    sinks.write_sorted(df, path, ["geo_id", "id"], row_group=100)
    groups = {(r.path.split("/")[-1], r.row_group): (r.rows, r.least, r.most) for r in sources.row_groups(spark, path, "geo_id", 100).collect()}
    written = {}
    for file in (tmp_path / "p").glob("*.parquet"):  # what the footers say
        meta = pq.ParquetFile(file).metadata
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(0).statistics
            written[file.name, g] = (meta.row_group(g).num_rows, s.min, s.max)
    assert groups == written and len(groups) >= 40
    one = spark.read.parquet(path).where("geo_id = '07'")
    [(_, rows, _)] = sources.scan_metrics(one)
    assert one.count() == 100 and 100 <= rows <= 300  # of 4000


def test_stream_replaces_a_year(spark, tmp_path):
    """A new version replaces a year, and of two versions in one batch the newer counts alone."""
    import os

    from gridloom.streaming import follow

    xw = spark.createDataFrame([("0.005", "0.005", "a", False)], "grid_lon string, grid_lat string, geo_id string, snapped boolean")

    def publish(year, *counts):
        for n in counts:
            have = set((tmp_path / f"in/{year}").glob("*.parquet"))
            src = spark.createDataFrame([("0.005", "0.005", "White", n, n)], "grid_lon string, grid_lat string, race_ethnicity string, n_noise double, n_noise_postprocessed double")
            src.coalesce(1).write.mode("append").parquet(str(tmp_path / f"in/{year}"))
            for file in set((tmp_path / f"in/{year}").glob("*.parquet")) - have:
                os.utime(file, (1.7e9 + n, 1.7e9 + n))

    def run():
        follow(spark, str(tmp_path / "in"), xw, ("race_ethnicity",), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        return {(r.year, r.n_noise) for r in spark.read.parquet(str(tmp_path / "out")).collect()}

    publish(2001, 4.0, 5.0), publish(2002, 5.0)
    assert run() == {(2001, 5.0), (2002, 5.0)}
    publish(2001, 9.0)
    assert run() == {(2001, 9.0), (2002, 5.0)}
    publish(2001, 7.0)  # an older version that comes late
    assert run() == {(2001, 9.0), (2002, 5.0)}


def test_working_tables_need_a_shared_folder():
    from types import SimpleNamespace as N

    from gridloom.tables import work_path

    with pytest.raises(ValueError, match="share"):
        work_path(N(conf=N(get=lambda *_: None), sparkContext=N(master="spark://host:7077")), "x")


def test_c8_reads_the_table_once(spark, monkeypatch):
    """The grid is scanned for its cells' sums alone; what follows works on these."""
    from gridloom import fixtures, queries

    grids, whole = [], fixtures.grid
    monkeypatch.setattr(fixtures, "grid", lambda *a: grids.append(a) or whole(*a))
    df = queries.check_c8(spark, "/root/testdata/sf0.001")
    assert len(grids) == 1 and not [f for f in df.inputFiles() if "testdata" in f]
    assert df.count() == 1


def test_the_grid_is_not_shuffled_to_meet_a_few_cells(spark):
    """The crosswalk of some thousand cells goes to the grid's tasks, and no row of the grid moves for it."""
    from gridloom import queries

    for name in ("aggregate_county", "dropped_cells"):
        plan = queries.QUERIES[name](spark, "/root/testdata/sf0.01")._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1, plan


def test_nearest_whatever_is_broadcast(spark):
    """All levels broadcast, all shuffled, or the tiles that points have reached broadcast: the same, ties and points in one place included."""
    squares = [(f"s{i}-{j}", 0, 0, [(i, j), (i + 1, j), (i + 1, j + 1), (i, j + 1)]) for i in range(12) for j in range(12)]
    edges = polygon(spark, [(g, p, r, [(float(x), float(y)) for x, y in ring]) for g, p, r, ring in squares])
    at = [(k, k % 5 * 0.25 + k // 5, 40.0 - k % 7) for k in range(60)] + [(60, 3.5, 40.0), (61, 3.5, 40.0)]
    points = spark.createDataFrame(at, "k long, x double, y double")
    got = {n: {tuple(r) for r in spatial.nearest(points, edges, ["k"], 0.5, n).collect()} for n in (1 << 19, 100, 0)}
    assert len(got[0]) == 62 and got[0] == got[100] == got[1 << 19]


def test_points_go_down_the_pyramid_where_they_are(spark, monkeypatch):
    """Points are shuffled once for all levels that are broadcast, and written once."""
    edges = polygon(spark, [(f"s{i}", 0, 0, [(i, 0.0), (i + 1.0, 0.0), (i + 1.0, 1.0), (i, 1.0)]) for i in map(float, range(200))])
    points, plans, whole = spark.range(500).select(F.col("id").alias("k"), (F.col("id") % 97).cast("double").alias("x"), F.lit(9.0).alias("y")), [], spatial.settle

    def settle(df, name):
        if name == "asked":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return whole(df, name)

    monkeypatch.setattr(spatial, "settle", settle)
    assert spatial.nearest(points, edges, ["k"]).count() == 500
    assert len(plans) == 1 and plans[0].count("BroadcastHashJoin") > 4 and plans[0].count("Exchange hashpartitioning") == 1 and plans[0].count("Sort [") == 1, plans

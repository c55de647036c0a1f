import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skymart.functions import geometry as geo
from skymart.operators import spatial

SHAPES = "feature_id int, polygons array<array<array<array<double>>>>"
SQUARE = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 1.0], [0.0, 0.0]]
HOLE = [[0.4, 0.4], [0.6, 0.4], [0.6, 0.6], [0.4, 0.6], [0.4, 0.4]]
ELL = [[2.0, 0.0], [4.0, 0.0], [4.0, 1.0], [3.0, 1.0], [3.0, 2.0], [2.0, 2.0], [2.0, 0.0]]
TINY = [[9.0, 9.0], [9.01, 9.0], [9.01, 9.01], [9.0, 9.01], [9.0, 9.0]]


def crossings(x, y, ring):
    inside = False
    for (x1, y1), (x0, y0) in zip(ring, ring[-1:] + ring[:-1]):
        if (y1 > y) != (y0 > y) and x < (x0 - x1) * (y - y1) / (y0 - y1) + x1:
            inside = not inside
    return inside


@pytest.fixture(scope="module")
def shapes(spark):
    return spark.createDataFrame([(1, [[SQUARE, HOLE]]), (2, [[ELL], [TINY]])], SHAPES)


def test_bbox_and_centroid(shapes):
    assert tuple(spatial.bbox(shapes).first()) == (0.0, 9.01, 0.0, 9.01)
    wide = spatial.expand_bbox(spatial.bbox(shapes), 0.1).first()
    assert wide.min_lon == pytest.approx(-0.901) and wide.max_lat == pytest.approx(9.911)
    first = spatial.centroid(shapes.where("feature_id = 1")).first()
    points = SQUARE + HOLE
    assert first.lon == pytest.approx(sum(p[0] for p in points) / len(points))
    canvas = spatial.projected_centroid(shapes, spatial.bbox(shapes), 100, 100).orderBy("feature_id").first()
    assert 0 < canvas.x < 10 and 90 < canvas.y < 100


def test_projection_and_inverse(spark, shapes):
    box = spatial.bbox(shapes)
    points = spark.createDataFrame([(0.0, 0.0), (9.01, 9.01), (3.3, 5.5)], "lon double, lat double")
    got = spatial.mercator_project(points, box, 800, 600).collect()
    assert [(r.x, r.y) for r in got[:2]] == [(0.0, 600.0), (800.0, 0.0)]
    merc = lambda d: math.log(math.tan(math.pi / 4 + math.radians(d) / 2))
    assert got[2].y == pytest.approx((merc(9.01) - merc(5.5)) / merc(9.01) * 600, abs=0.005)
    xy = spark.createDataFrame([(got[2].x, got[2].y)], "x double, y double")
    back = spatial.mercator_unproject(xy, box, 800, 600).first()
    assert (back.lon, back.lat) == (pytest.approx(3.3, abs=1e-3), pytest.approx(5.5, abs=1e-3))


def test_points_in_polygons_equals_brute_force(spark, shapes):
    rng = np.random.default_rng(3)
    data = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-0.5, 4.5, (400, 2)))]
    data += [(1000, 9.005, 9.005), (1001, 0.5, 0.5), (1002, 8.999, 9.005)]
    points = spark.createDataFrame(data, "id int, lon double, lat double")
    got = {r.id: r.inside for r in spatial.flag_points(points, shapes, key="id").collect()}
    want = {i: any(crossings(x, y, ring) for ring in (SQUARE, ELL, TINY)) for i, x, y in data}
    assert got == want and want[1000] and want[1001] and not want[1002]


def test_cells_of_polygons_are_not_sent_to_all_tasks(spark, shapes):
    """A small table of outlines may have many cells, which its size doesn't tell."""
    points = spark.createDataFrame([(1, 0.5, 0.2)], "id int, lon double, lat double")
    found = spatial.points_in_polygons(points, shapes, key="id")
    assert [r.id for r in found.collect()] == [1]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_no_polygons(shapes):
    assert spatial.points_in_polygons(
        shapes.select(F.lit(1).alias("id"), F.lit(0.5).alias("lon"), F.lit(0.5).alias("lat")),
        shapes.limit(0), key="id").count() == 0


def crossed(x, y, ring):
    """The same rule for many points at once."""
    here, before = np.array(ring), np.array(ring[-1:] + ring[:-1])
    inside = np.zeros(len(x), bool)
    for (x1, y1), (x0, y0) in zip(here, before):
        if y1 != y0:
            inside ^= ((y1 > y) != (y0 > y)) & (x < (x0 - x1) * (y - y1) / (y0 - y1) + x1)
    return inside


def star(rng, n, x, y, size):
    angles = np.sort(rng.uniform(0, 2 * np.pi, n))
    radii = size * rng.uniform(0.2, 1.0, n)
    return np.stack([x + radii * np.cos(angles), y + radii * np.sin(angles)], axis=1).tolist()


def comb(n, x, y, size):
    """Long vertical edges only."""
    return [[x + size * i / n, y + (size if i % 4 in (1, 2) else 0.0)] for i in range(n)] + [[x + size, y - 0.5]]


def probes(rng, rings, n):
    """Points around the outlines, on them, at their vertices and on borders of cells."""
    spots = [rng.uniform(-1, 12, (n, 2))]
    for ring in rings:
        corners = np.array(ring)
        spots.append(corners[rng.integers(0, len(corners), n // 10)])
        spots.append(corners[rng.integers(0, len(corners), n // 10)] + rng.normal(0, 0.01, (n // 10, 2)))
    spots = np.concatenate(spots)
    spots[::7] = np.round(spots[::7] * 8) / 8
    return spots


def test_odd_outlines_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    rings = [star(rng, n, *rng.uniform(0, 10, 2), size) for n, size in ((3, 2), (9, 0.1), (60, 3), (700, 1.5))]
    rings += [comb(80, 4.0, 4.0, 2.0), SQUARE, ELL, [[1.0, 1.0]], [[2.0, 2.0], [3.0, 3.0]], []]
    rings += [[[float(p), 7.0 + q] for p, q in ((5, 0), (6, 0), (6, 1), (5, 1), (5, 0), (6, 0), (6, 2), (5, 2))]]
    shapes = spark.createDataFrame([(i, [[r]]) for i, r in enumerate(rings)], SHAPES)
    spots = probes(rng, [r for r in rings if r], 1_500)
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(spots)], "id int, lon double, lat double")
    want = np.any([crossed(spots[:, 0], spots[:, 1], r) for r in rings if r], axis=0)
    got = {r.id: r.inside for r in spatial.flag_points(points, shapes, key="id").collect()}
    wrong = [i for i, w in enumerate(want) if got[i] != w]
    assert not wrong, [(spots[i].tolist(), bool(want[i])) for i in wrong[:5]]
    for i, ring in enumerate(rings):  # and each alone, as a union can hide what one gets wrong
        if len(ring) > 2:
            one = spatial.flag_points(points, shapes.where(F.col("feature_id") == i), key="id")
            got = {r.id: r.inside for r in one.collect()}
            alone = crossed(spots[:, 0], spots[:, 1], ring)
            assert [got[j] for j in range(len(spots))] == alone.tolist()


def test_a_polygon_of_100_000_vertices(spark):
    rng = np.random.default_rng(5)
    n = 100_000
    angle = np.linspace(0, 2 * np.pi, n, endpoint=False)
    radius = 5 + 0.5 * np.sin(40 * angle) + rng.normal(0, 0.0005, n)
    outline = np.stack([radius * np.cos(angle), radius * np.sin(angle)], axis=1)
    shapes = spark.createDataFrame([(1, [[outline.tolist()]])], SHAPES)
    spots = np.concatenate([rng.uniform(-6, 6, (1_500, 2)), outline[::100] + rng.normal(0, 0.001, (1_000, 2))])
    points = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(spots)], "id int, lon double, lat double")
    got = {r.id for r in spatial.points_in_polygons(points, shapes, key="id").select("id").collect()}
    x1, y1 = outline.T
    x0, y0 = np.roll(x1, 1), np.roll(y1, 1)
    want = set()
    for i, (x, y) in enumerate(spots):
        spans = (y1 > y) != (y0 > y)
        at = (x0[spans] - x1[spans]) * (y - y1[spans]) / (y0[spans] - y1[spans]) + x1[spans]
        if (x < at).sum() % 2:
            want.add(i)
    assert got == want
    size = F.size("__local")
    cells = spatial.polygon_cells(shapes).agg(F.sum(size), F.max(size), F.count("*")).first()
    assert cells[0] < 4 * n and cells[1] < 500 and cells[2] < n


@pytest.mark.parametrize("n", [40, 400])
def test_long_edges_do_not_multiply(spark, n):
    shapes = spark.createDataFrame([(1, [[comb(n, 0.0, 0.0, 3.0)]])], SHAPES)
    held = spatial.polygon_cells(shapes).agg(F.sum(F.size("__local"))).first()[0]
    assert held <= 3 * spatial.ROWS_PER_EDGE * (n + 1) + 100


def test_hex_grid_equals_brute_force(spark, shapes):
    square = shapes.where("feature_id = 1")
    box = spatial.bbox(square)
    got = {(r.row, r.col): (r.cx, r.cy) for r in spatial.hex_grid(box, square, radius=7.0, width=100, height=80).collect()}
    merc = lambda d: math.log(math.tan(math.pi / 4 + math.radians(d) / 2))
    want, step_x, step_y = {}, 10.5, math.sqrt(3) * 7.0
    for row in range(-1, 20):
        for col in range(-1, 20):
            cx, cy = col * step_x + (step_x if row % 2 else 0.0), row * step_y
            lon = cx / 100
            lat = math.degrees(math.atan(math.sinh(merc(0) + (1 - cy / 80) * (merc(1) - merc(0)))))
            if cx <= 100 + step_x and cy <= 80 + step_y and crossings(lon, lat, SQUARE):
                want[row, col] = (cx, cy)
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_hex_grid_equals_testing_every_centre(spark):
    rng = np.random.default_rng(11)
    rings = [star(rng, 50, 4.0, 4.0, 3.0), star(rng, 30, 5.5, 4.5, 2.5), comb(40, 1.0, 7.0, 2.0), SQUARE]
    shapes = spark.createDataFrame([(1, [[r] for r in rings[:2]]), (2, [[r] for r in rings[2:]])], SHAPES)
    box = spatial.expand_bbox(spatial.bbox(shapes), 0.05)
    got = spatial.hex_grid(box, shapes, radius=5.0, width=300, height=200).collect()
    assert len({(r.row, r.col) for r in got}) == len(got) > 100
    corners = box.first()
    merc = lambda d: math.log(math.tan(math.pi / 4 + d * math.pi / 180 / 2))
    top, bottom = merc(corners.max_lat), merc(corners.min_lat)
    step_x, step_y, want = 7.5, math.sqrt(3) * 5.0, set()
    for row in range(-1, 30):
        for col in range(-1, 50):
            cx, cy = col * step_x + (step_x if row % 2 else 0.0), row * step_y
            lon = corners.min_lon + cx / 300 * (corners.max_lon - corners.min_lon)
            lat = math.atan(math.sinh(bottom + (1 - cy / 200) * (top - bottom))) * 180 / math.pi
            if cx <= 300 + step_x and cy <= 200 + step_y and any(crossings(lon, lat, r) for r in rings):
                want.add((row, col))
    assert {(r.row, r.col) for r in got} == want


def test_idw_in_blocks_of_any_size(spark):
    rng = np.random.default_rng(4)
    spots = [(i, float(x), float(y), float(v)) for i, (x, y, v) in enumerate(rng.uniform(0, 5, (37, 3)))]
    spots.append((99, spots[5][1], spots[5][2], 1000.0))  # same place, later in order
    goals = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(0, 5, (20, 2)))]
    goals.append((500, spots[5][1] + 5e-5, spots[5][2]))
    stations = spark.createDataFrame(spots, "seq int, lon double, lat double, value double")
    targets = spark.createDataFrame(goals, "id int, lon double, lat double")

    def definition(x, y):
        total = weight = 0.0
        for _, sx, sy, v in spots:
            d = math.hypot(x - sx, y - sy)
            if d < 1e-4:
                return v
            total, weight = total + v / d**2, weight + 1 / d**2
        return total / weight

    want = {i: definition(x, y) for i, x, y in goals}
    odd = spark.createDataFrame(
        [(-1, None, 1.0, 9.0), (-2, 1.0, None, 9.0), (-3, 1.0, 1.0, None)], stations.schema
    )
    more = targets.union(spark.createDataFrame([(600, None, 1.0), (601, 1.0, None)], targets.schema))
    for rows, pack in ((1_000_000, 1_000), (5, 7), (1, 1)):
        got = spatial.idw(more.union(targets), stations.union(odd), block_rows=rows, pack_rows=pack).collect()
        assert len(got) == 2 * len(goals) + 2
        assert {r.id: r.value for r in got if r.id < 600} == pytest.approx(want)
        assert [r.value for r in got if r.id >= 600] == [None, None]
    none = spatial.idw(more, odd).collect()
    assert {r.value for r in none if r.id < 600} == {0.0}


def test_idw_matrices_stay_in_cache(spark):
    """A part of the targets meets a block in one call, in small matrices, also at other powers."""
    rng = np.random.default_rng(5)
    x, y, v = rng.uniform(0, 3, (3, 9_000))
    x[8_500], y[8_500] = x[10], y[10]  # a second station too close, in a later matrix
    lon, lat = rng.uniform(0, 3, (2, 40))
    lon[7], lat[7] = x[10] + 5e-5, y[10]
    part = pa.table({"__id": np.arange(40), "lon": lon, "lat": lat})
    block = pa.table({"block": [3], "xs": [x], "ys": [y], "vs": [v]})
    for power in (2.0, 3.0):
        got = spatial._matrix_sums(power)(part, block).to_pandas()
        for i in range(40):
            d = np.hypot(lon[i] - x, lat[i] - y)
            weight = np.where(d < 1e-4, 1.0, 1 / d**power)
            assert (got["w"][i], got["wv"][i]) == pytest.approx((weight.sum(), weight @ v))
        assert got["hit"][7] == v[10] and got["hit"].drop(7).isna().all()
    assert spatial.MATRIX_TARGETS * spatial.MATRIX_STATIONS * 8 <= 1 << 20


def places(rng, kind, n):
    """Coordinates of n places: spread evenly, in clusters of many sizes, on a line, or few that repeat."""
    x, y = rng.uniform(0, 3, (2, n)) + [[98.0], [3.0]]
    if kind == "clusters":
        middle, size = rng.uniform(0, 50, (9, 2)), 10.0 ** np.arange(-6, 3)
        at = rng.integers(0, 9, n)
        x, y = (middle[at, i] + rng.normal(0, 1, n) * size[at] for i in (0, 1))
        x[0], y[0] = 4e6, -3e6
    elif kind == "line":
        y = np.full(n, 3.0)
    elif kind == "repeats":
        x, y = np.round(x, 1), np.round(y, 1)
    return x, y


def all_pairs(lon, lat, x, y, v, power):
    """Weights, weighted values and first station too close, of every pair."""
    w, wv, first = np.empty(len(lon)), np.empty(len(lon)), np.full(len(lon), np.nan)
    for i in range(len(lon)):
        d = np.hypot(lon[i] - x, lat[i] - y)
        close = d < 1e-4
        weight = np.where(close, 1.0, np.where(close, 1.0, d) ** -power)
        w[i], wv[i] = weight.sum(), weight @ v
        if close.any():
            first[i] = v[close.argmax()]
    return w, wv, first


@pytest.mark.parametrize("power", [1.0, 2.0, 3.0, 4.5])
@pytest.mark.parametrize("kind", ["even", "clusters", "line", "repeats"])
def test_idw_cells_equal_all_pairs(monkeypatch, kind, power):
    monkeypatch.setattr(spatial, "FEW_PAIRS", 0)
    monkeypatch.setattr(spatial, "NEAR_PAIRS", 300)
    monkeypatch.setattr(spatial, "FAR_PAIRS", 50)
    monkeypatch.setattr(spatial, "LEAF", 9)
    rng = np.random.default_rng(6)
    (x, y), (lon, lat) = places(rng, kind, 4_000), places(rng, kind, 1_500)
    lon[:50], lat[:50] = x[:50] + 5e-5, y[:50]
    v = rng.normal(0, 10, len(x))
    part = pa.table({"__id": np.arange(len(lon)), "lon": lon, "lat": lat})
    block = pa.table({"block": [3], "xs": [x], "ys": [y], "vs": [v]})
    got = spatial._matrix_sums(power)(part, block).to_pandas()
    w, wv, first = all_pairs(lon, lat, x, y, v, power)
    _, size, _ = all_pairs(lon, lat, x, y, np.abs(v), power)
    assert np.abs(got["w"] / w - 1).max() < 1e-13
    assert (np.abs(got["wv"] - wv) / size).max() < 1e-13
    np.testing.assert_array_equal(got["hit"], first)


def test_idw_pairs_do_not_multiply(monkeypatch):
    """Four times the targets and stations cost little more than four times the pairs, not sixteen times."""
    made, single = [0], spatial._pair_sums

    def counted(power):
        add = single(power)

        def count(lons, lats, xs, *rest):
            made[0] += len(lons) * len(xs)
            add(lons, lats, xs, *rest)

        return count

    monkeypatch.setattr(spatial, "FEW_PAIRS", 0)
    monkeypatch.setattr(spatial, "_pair_sums", counted)
    rng, pairs = np.random.default_rng(7), []
    for n in (10_000, 40_000):
        part = pa.table({"__id": np.arange(n), "lon": rng.uniform(0, 3, n), "lat": rng.uniform(0, 3, n)})
        block = pa.table({"block": [0], "xs": [rng.uniform(0, 3, n)], "ys": [rng.uniform(0, 3, n)], "vs": [rng.uniform(0, 3, n)]})
        made[0] = 0
        assert spatial._matrix_sums(2.0)(part, block).num_rows == n
        pairs.append(made[0])
    assert pairs[1] < 6 * pairs[0] and pairs[1] < 40_000**2 / 10


def test_idw_numbers_that_are_not_finite(monkeypatch):
    monkeypatch.setattr(spatial, "FEW_PAIRS", 0)
    rng = np.random.default_rng(9)
    (x, y), (lon, lat) = places(rng, "even", 3_000), places(rng, "even", 900)
    v, inf = rng.uniform(20, 35, len(x)), math.inf
    v[5], x[6], y[7] = inf, inf, -inf
    lon[0], lon[1], lat[2] = math.nan, inf, -inf
    lon[3], lat[3] = x[5], y[5]
    part = pa.table({"__id": np.arange(len(lon)), "lon": lon, "lat": lat})
    block = pa.table({"block": [3], "xs": [x], "ys": [y], "vs": [v]})
    got = spatial._matrix_sums(2.0)(part, block).to_pandas()
    with np.errstate(invalid="ignore"):
        w, wv, first = all_pairs(lon, lat, x, y, v, 2.0)
    np.testing.assert_allclose(got["w"], w, rtol=1e-12)
    np.testing.assert_allclose(got["wv"], wv, rtol=1e-12)
    np.testing.assert_array_equal(got["hit"], first)


def test_idw_parts_are_near_places_of_even_size(spark, monkeypatch):
    monkeypatch.setattr(spatial, "FEW_PAIRS", 0)
    monkeypatch.setattr(spatial, "NEAR_PAIRS", 100)
    monkeypatch.setattr(spatial, "FAR_PAIRS", 20)
    rng = np.random.default_rng(10)
    lon, lat = places(rng, "even", 3_000)
    lon[:1_000], lat[:1_000] = 99.0, 4.0  # a crowded place
    lon[1_000], lat[1_001] = math.inf, math.nan
    rows = [(i, float(a), float(b)) for i, (a, b) in enumerate(zip(lon, lat))]
    targets = spark.createDataFrame(rows, "__id long, lon double, lat double")
    part, parts = spatial._parts(targets, 200)
    sizes = {r.part: r.n for r in targets.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    assert set(sizes) == set(range(parts)) and sum(sizes.values()) == 3_000 and max(sizes.values()) < 300
    x, y = places(rng, "even", 700)
    v = rng.uniform(20, 35, 700)
    stations = spark.createDataFrame(
        [(i, float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(x, y, v))],
        "seq int, lon double, lat double, value double",
    )
    goals = targets.withColumnRenamed("__id", "id")
    w, wv, first = all_pairs(lon, lat, x, y, v, 2.0)
    with np.errstate(invalid="ignore"):
        want = np.where(np.isnan(first), np.where(w == 0, 0.0, wv / w), first)
    for rows in (1_000, 300):
        got = {r.id: r.value for r in spatial.idw(goals, stations, block_rows=rows, pack_rows=500).collect()}
        np.testing.assert_allclose([got[i] for i in range(3_000)], want, rtol=1e-12)


def test_round_2_rounds_half_up(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (2.675,)], "v double")
    assert [r[0] for r in df.select(geo.round_2(F.col("v"))).collect()] == [0.13, -0.12, 2.68]

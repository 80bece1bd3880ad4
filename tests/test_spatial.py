"""Distance joins against brute force, also where most of the data sits in one place."""

import math
import random

import pytest
from conftest import rows

from pyspark.sql import functions as F

from sightline.operators.neighbours import Tree, knn_join
from sightline.operators.spatial import _Grid, within_distance_join


def segment_distance2(p, a, b):
    ex, ey = b[0] - a[0], b[1] - a[1]
    length2 = ex * ex + ey * ey
    u = 0.0 if length2 == 0 else max(0.0, min(1.0, ((p[0] - a[0]) * ex + (p[1] - a[1]) * ey) / length2))
    qx, qy = a[0] + u * ex, a[1] + u * ey
    return (p[0] - qx) ** 2 + (p[1] - qy) ** 2


def brute_pairs(points, lines):
    out = []
    for mid, x, y, r in points:
        for sid, geom in lines:
            pieces = list(zip(geom, geom[1:])) or [(geom[0], geom[0])]
            if any(segment_distance2((x, y), a, b) <= r * r + 1e-9 for a, b in pieces):
                out.append((mid, sid))
    return sorted(out)


def join(spark, points, lines, **kw):
    pts = spark.createDataFrame([(m, float(x), float(y), float(r)) for m, x, y, r in points],
                                "mid BIGINT, x DOUBLE, y DOUBLE, radius DOUBLE")
    lns = spark.createDataFrame([(s, [(float(a), float(b)) for a, b in g]) for s, g in lines],
                                "sid BIGINT, geom ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>")
    return rows(within_distance_join(pts, lns, point_cols=["mid"], line_key=["sid"], **kw))


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rnd = random.Random(seed)
    # radii over several grid levels, lines from dots to crossing the whole map
    points = [(i, rnd.randint(-3000, 9000), rnd.randint(-3000, 9000), rnd.choice([0, 30, 210, 700, 3000]))
              for i in range(60)]
    lines = []
    for s in range(80):
        x, y = rnd.randint(-3000, 9000), rnd.randint(-3000, 9000)
        step = rnd.choice([0, 50, 400, 5000])
        lines.append((s, [(x + rnd.randint(-step, step), y + rnd.randint(-step, step))
                          for _ in range(rnd.randint(1, 5))]))
    assert join(spark, points, lines) == brute_pairs(points, lines)


def test_crowded_cell(spark):
    rnd = random.Random(7)
    points = [(i, rnd.randint(0, 300), rnd.randint(0, 300), 40) for i in range(80)]
    lines = [(s, [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(2)]) for s in range(80)]
    assert join(spark, points, lines) == brute_pairs(points, lines)


def test_tangent_counts(spark):
    assert join(spark, [(1, 0, 0, 300)], [(1, [(-500, 300), (500, 300)]), (2, [(-500, 301), (500, 301)])]) == [(1, 1)]
    # tangent exactly on a cell border
    assert join(spark, [(1, 212, 5, 300)], [(1, [(512, -900), (512, 900)])]) == [(1, 1)]


def test_equal_rows_each_count(spark):
    assert join(spark, [(1, 0, 0, 300), (1, 0, 0, 300)], [(5, [(0, 0), (900, 0)])]) == [(1, 5), (1, 5)]


def test_missing_places_match_nothing(spark):
    pts = spark.createDataFrame([(1, None, 0.0, 10.0)], "mid BIGINT, x DOUBLE, y DOUBLE, radius DOUBLE")
    lns = spark.createDataFrame([(1, [(0.0, 0.0)]), (2, []), (3, None)],
                                "sid BIGINT, geom ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>")
    assert rows(within_distance_join(pts, lns, point_cols=["mid"], line_key=["sid"])) == []


def test_lon_lat_metres(spark):
    # about 111.2 m north of the line; 0.001 degrees of longitude at 60 degrees north are about 55.6 m
    points = [(1, 14.0, 60.001, 120), (2, 14.0, 60.001, 100), (3, 14.001, 60.0, 60), (4, 14.001, 60.0, 50)]
    lines = [(1, [(13.99, 60.0), (14.0, 60.0)])]
    assert join(spark, points, lines, metric="metres") == [(1, 1), (3, 1)]


def on_sphere(lon, lat):
    a, b = math.radians(lon), math.radians(lat)
    return (math.cos(b) * math.cos(a), math.cos(b) * math.sin(a), math.sin(b))


def great_circle(p, q):
    return 2 * 6_371_008.8 * math.asin(min(1.0, math.dist(on_sphere(*p), on_sphere(*q)) / 2))


def arc_distance(p, a, b):
    """By ternary search along the arc."""
    u, v = on_sphere(*a), on_sphere(*b)

    def at(t):
        w = [x + t * (y - x) for x, y in zip(u, v)]
        n = math.hypot(*w)
        return 2 * 6_371_008.8 * math.asin(min(1.0, math.dist(on_sphere(*p), [c / n for c in w]) / 2))

    low, high = 0.0, 1.0
    for _ in range(100):
        x, y = low + (high - low) / 3, high - (high - low) / 3
        low, high = (low, y) if at(x) < at(y) else (x, high)
    return min(at(low), at(0.0), at(1.0))


def test_lon_lat_across_180_degrees_and_at_the_poles(spark):
    rnd = random.Random(11)
    places = [(179.99 + rnd.random() * 0.02, 60 + rnd.random() * 0.02) for _ in range(25)]
    places += [(rnd.random() * 360, 89.99 + rnd.random() * 0.01) for _ in range(20)] + [(0, 90), (77, -90), (10, 0)]
    places = [(lon - 360 if lon > 180 else lon, lat) for lon, lat in places]
    points = [(i, *p, rnd.choice([0, 120, 600, 3000])) for i, p in enumerate(places)]
    lines = [(s, [rnd.choice(places), rnd.choice(places[:25])] if s % 3 else [rnd.choice(places)]) for s in range(30)]
    want = []
    for i, lon, lat, r in points:
        for s, geom in lines:
            d = min(arc_distance((lon, lat), a, b) for a, b in (list(zip(geom, geom[1:])) or [(geom[0], geom[0])]))
            assert abs(d - r) > 1e-3 or r == 0
            if d <= r + 1e-6:
                want.append((i, s))
    got = join(spark, points, lines, metric="metres")
    assert [g for g in got if points[g[0]][3]] == sorted(w for w in want if points[w[0]][3])
    assert any(abs(points[i][1] - lines[s][1][0][0]) > 300 for i, s in got)  # across 180 degrees


def test_far_off_coordinate_costs_the_cells_of_the_panels_only(spark):
    points = [(i, 1000 * i, 500, 300) for i in range(20)]
    lines = [(1, [(-1e12, 400), (1e12, 400)]), (2, [(0, 500), (1e12, 1e12)]), (3, [(0, 1e12), (1e12, 1e12)])]
    assert join(spark, points, lines) == brute_pairs(points, lines)


def test_a_piece_of_a_line_is_one_row(spark):
    """Lines are mostly the larger side: they are not repeated in the cells around."""
    points = spark.createDataFrame([(1, 0.0, 0.0, 300.0), (2, 9000.0, 9000.0, 400.0)], "mid BIGINT, x DOUBLE, y DOUBLE, radius DOUBLE")
    near = [(s, [(300.0 * s, 500.0), (300.0 * s + 400, 800.0), (300.0 * s + 800, 300.0)]) for s in range(20)]
    lines = spark.createDataFrame([*near, (99, [(0.0, 0.0), (5120.0, 0.0)])], "sid BIGINT, geom ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>")
    grid = _Grid("planar", 512.0)
    cells = grid.segment_cells(lines, ["sid"], "geom", grid.reached(points)).groupBy("sid").count()
    assert rows(cells) == [*[(s, 2) for s in range(20)], (99, 10)]
    assert grid.point_cells(points, ["mid"]).groupBy("mid").count().agg(F.max("count")).first()[0] <= 16


# -- nearest neighbours --------------------------------------------------------
def brute_nearest(queries, cands, k, radius):
    out = []
    for q, qx, qy in queries:
        near = sorted((math.sqrt((qx - x) ** 2 + (qy - y) ** 2), c) for c, x, y in cands)
        near = [(d, c) for d, c in near if radius is None or d <= radius]
        out += [(q, c, i + 1) for i, (d, c) in enumerate(near[:k])]
    return sorted(out)


def nearest(spark, queries, cands, k, radius=None, **kw):
    q = spark.createDataFrame([(m, float(x), float(y)) for m, x, y in queries], "mid BIGINT, x DOUBLE, y DOUBLE")
    c = spark.createDataFrame([(m, float(x), float(y)) for m, x, y in cands], "near BIGINT, x DOUBLE, y DOUBLE")
    got = knn_join(q, c, k=k, query_key="mid", candidate_key="near", radius=radius, **kw)
    return rows(got, "mid", "near", "rank")


def scattered(rnd, n, size, start=0):
    return [(start + i, rnd.randint(0, size), rnd.randint(0, size)) for i in range(n)]


@pytest.mark.parametrize("radius", [None, 1500])
def test_nearest_of_scattered(spark, radius):
    rnd = random.Random(3)
    queries, cands = scattered(rnd, 40, 10000), scattered(rnd, 300, 10000, 1000)
    assert nearest(spark, queries, cands, 5, radius, leaf_size=8) == brute_nearest(queries, cands, 5, radius)


@pytest.mark.parametrize("radius", [None, 5000])
def test_nearest_with_most_candidates_in_one_spot_and_cluster(spark, radius):
    rnd = random.Random(4)
    cands = [(1000 + i, 5000, 5000) for i in range(150)]  # one spot
    cands += [(2000 + i, 5200 + rnd.randint(0, 60), 5200 + rnd.randint(0, 60)) for i in range(200)]  # a cluster
    cands += scattered(rnd, 60, 20000, 3000)
    queries = scattered(rnd, 20, 20000) + [(100, 5000, 5000), (101, 5230, 5230), (102, 4999, 5001), (103, -9000, -9000)]
    queries += [(200 + i, 5100, 5100) for i in range(30)]  # many queries in one spot
    assert nearest(spark, queries, cands, 20, radius, leaf_size=16) == brute_nearest(queries, cands, 20, radius)


def test_fewer_candidates_than_asked_for(spark):
    assert nearest(spark, [(1, 0, 0)], [(7, 3, 4), (8, 100, 0)], 20, 50) == [(1, 7, 1)]
    assert nearest(spark, [(1, 0, 0)], [], 20, 50) == []
    assert nearest(spark, [(1, 0, 0)], [], 20) == []


def test_own_entry_can_be_left_out(spark):
    cands = [(1, 0, 0), (1, 5, 0), (2, 9, 0), (3, 20, 0)]
    assert nearest(spark, [(1, 0, 0)], cands, 2, 100) == [(1, 1, 1), (1, 1, 2)]
    assert nearest(spark, [(1, 0, 0)], cands, 2, 100, exclude_self=True) == [(1, 2, 1), (1, 3, 2)]


def test_repeated_queries_share_one_ranking(spark):
    got = nearest(spark, [(1, 0, 0), (1, 0, 0)], [(5, 1, 0), (6, 2, 0), (7, 3, 0)], 4, 100)
    assert got == [(1, 5, 1), (1, 5, 2), (1, 6, 3), (1, 6, 4)]


def test_metres_shrink_longitude(spark):
    # in degrees the first is nearer, in metres at 60 degrees north the second is
    cands = [(1, 14.0, 60.0015), (2, 14.002, 60.0)]
    assert [r[1] for r in nearest(spark, [(9, 14.0, 60.0)], cands, 1)] == [1]
    assert [r[1] for r in nearest(spark, [(9, 14.0, 60.0)], cands, 1, 1000, metric="metres")] == [2]


def test_leaves_are_bounded_with_a_far_off_place_and_a_dense_town(spark):
    rnd = random.Random(8)
    cands = [(i, rnd.randint(0, 90) / 1e6, rnd.randint(0, 90) / 1e6) for i in range(1500)] + [(5000, 1e12, -1e12)]
    cands += [(6000 + i, 7.0, 7.0) for i in range(100)] + [(7000 + i, 8.0, float(i)) for i in range(100)]
    c = spark.createDataFrame(cands, "near BIGINT, x DOUBLE, y DOUBLE")
    tree = Tree(c, None, "planar", 16)
    sizes = [r for r in tree.leaves.groupBy("_node").agg(
        F.count("*").alias("n"), F.count_distinct("x", "y").alias("spots")).collect()]
    assert sum(r["n"] for r in sizes) == len(cands)
    assert all(r["n"] <= 16 or r["spots"] == 1 for r in sizes)
    assert len(tree.levels) < 8
    queries = [(1, 5e-5, 5e-5), (2, 1e12, 0), (3, 7, 7), (4, 8, 50)]
    assert nearest(spark, queries, cands, 20, leaf_size=16) == brute_nearest(queries, cands, 20, None)


@pytest.mark.parametrize("radius", [None, 900])
def test_nearest_on_the_globe(spark, radius):
    rnd = random.Random(9)

    def place():
        lon, lat = rnd.choice([(179.995, 60), (0, 89.995), (20, 0)])
        lon, lat = lon + rnd.random() * (0.01 if lat < 80 else 360), lat + rnd.random() * 0.005
        return (lon - 360 if lon > 180 else lon), lat

    queries, cands = [(i, *place()) for i in range(40)], [(1000 + i, *place()) for i in range(300)]
    want = []
    for q, *at in queries:
        near = sorted((round(great_circle(at, c[1:]), 3), c[0]) for c in cands)
        want += [(q, c, i + 1) for i, (d, c) in enumerate([n for n in near if radius is None or n[0] <= radius][:7])]
    assert nearest(spark, queries, cands, 7, radius, metric="metres", leaf_size=8) == sorted(want)


def test_lon_lat_join_is_compiled(spark):
    """Code over 64 KB is not compiled; Spark then interprets the rows, unless it may not fall back."""
    fallback = spark.conf.get("spark.sql.codegen.fallback")
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        points = [(1, 14.0, 60.001, 120), (2, 14.0, 60.001, 100), (3, 14.001, 60.0, 60)]
        lines = [(1, [(13.99, 60.0), (14.0, 60.0)]), (2, [(13.99, 60.0), (14.0, 60.0), (14.3, 60.2)])]
        assert join(spark, points, lines, metric="metres") == [(1, 1), (1, 2), (2, 2), (3, 1), (3, 2)]
    finally:
        spark.conf.set("spark.sql.codegen.fallback", fallback)


@pytest.mark.parametrize("radius", [None, 900.0])
def test_groups_of_queries_walk_together(spark, radius):
    """The bound of a query takes in its k nearest, and its leaves hold all candidates within."""
    rnd = random.Random(5)
    candidates = [(i, float(rnd.randint(0, 5000)), float(rnd.randint(0, 5000))) for i in range(400)]
    spots = sorted({(float(rnd.randint(-500, 5500)), float(rnd.randint(0, 5000))) for _ in range(150)})
    tree = Tree(spark.createDataFrame(candidates, "key INT, x DOUBLE, y DOUBLE"), radius, "planar", 8)
    walked = tree.walk(spark.createDataFrame(spots, "qx DOUBLE, qy DOUBLE"), 5)
    met = walked.join(tree.leaves, "_node").groupBy("qx", "qy").agg(
        F.first("_bound").alias("bound"), F.collect_set("key").alias("keys")).collect()
    found = {(r["qx"], r["qy"]): (r["bound"], set(r["keys"])) for r in met}
    for x, y in spots:
        away = sorted(((cx - x) ** 2 + (cy - y) ** 2, key) for key, cx, cy in candidates)
        wanted = [a for a in away[:5] if radius is None or a[0] <= radius * radius]
        bound, keys = found.get((x, y), (None, set()))
        assert {key for _, key in wanted} <= keys
        if bound is not None:
            assert all(a <= bound for a, _ in wanted)
    assert sum(len(keys) for _, keys in found.values()) < len(spots) * len(candidates) / 4

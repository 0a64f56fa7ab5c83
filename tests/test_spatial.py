from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from croplake.catalog import CATALOG
from croplake.functions import geo
from croplake.operators import spatial

SCHEMA = "geom_id long, kind string, rings array<array<struct<x:double,y:double>>>"


def ring(*points):
    return [{"x": float(x), "y": float(y)} for x, y in (*points, points[0])]


def shapes(spark, rows):
    return spark.createDataFrame([(i, kind, rings) for i, kind, rings in rows], SCHEMA)


def inside(x, y, rings):
    odd = False
    for g in rings:
        for a, b in zip(g, g[1:]):
            if (a["y"] > y) != (b["y"] > y) and x < (b["x"] - a["x"]) * (y - a["y"]) / (b["y"] - a["y"]) + a["x"]:
                odd = not odd
    return odd


def test_points_in_polygons_of_all_sizes(spark):
    rnd = random.Random(1)
    polys = []
    for i in range(60):
        cx, cy, r = rnd.uniform(-170, 170), rnd.uniform(-80, 80), 10 ** rnd.uniform(-2, 1.5)
        polys.append((i, "POLYGON", [ring((cx - r, cy), (cx, cy - r / 2), (cx + r, cy), (cx + r / 3, cy + r), (cx, cy + r / 4))]))
    pts = [(i, rnd.uniform(-179, 179), rnd.uniform(-85, 85)) for i in range(300)]
    pts += [(1000 + i, p[2][0][0]["x"] + 1e-3, p[2][0][0]["y"]) for i, p in enumerate(polys)]
    got = spatial.points_in_polygons(
        spark.createDataFrame(pts, "point_id long, lon double, lat double"), shapes(spark, polys)
    )
    want = {(p, i) for p, x, y in pts for i, _, g in polys if inside(x, y, g)}
    pairs = [(r.point_id, r.geom_id) for r in got.collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == want


def test_border_and_hole(spark):
    donut = shapes(spark, [(1, "POLYGON", [ring((0, 0), (4, 0), (4, 4), (0, 4)), ring((1, 1), (3, 1), (3, 3), (1, 3))])])
    pts = spark.createDataFrame([(1, 0.5, 0.5), (2, 2.0, 2.0), (3, 4.0, 2.0), (4, 1.0, 2.0), (5, 5.0, 2.0)],
                                "point_id int, lon double, lat double")
    assert sorted(r.point_id for r in spatial.points_in_polygons(pts, donut).collect()) == [1, 3, 4]
    c = donut.select(geo.centroid("rings", "kind").alias("c")).first().c
    assert (round(c.x, 9), round(c.y, 9)) == (2.0, 2.0)


def test_hole_moves_the_centroid_whatever_its_direction(spark):
    outer, hole = ring((0, 0), (4, 0), (4, 2), (0, 2)), ring((0.5, 0.5), (1.5, 0.5), (1.5, 1.5), (0.5, 1.5))
    rows = shapes(spark, [(1, "POLYGON", [outer, hole]), (2, "POLYGON", [outer[::-1], hole])])
    want = (8 * 2 - 1 * 1) / 7
    for r in rows.select(geo.centroid("rings", "kind").alias("c")).collect():
        assert round(r.c.x, 9) == round(want, 9) and round(r.c.y, 9) == 1.0


def test_centroid_of_lines_and_points(spark):
    line = [{"x": 0.0, "y": 0.0}, {"x": 2.0, "y": 0.0}, {"x": 2.0, "y": 2.0}]
    rows = shapes(spark, [(1, "LINESTRING", [line]), (2, "MULTIPOINT", [line]), (3, "POINT", [line[1:2]])])
    got = {r.geom_id: (r.c.x, r.c.y) for r in rows.select("geom_id", geo.centroid("rings", "kind").alias("c")).collect()}
    assert got[1] == (1.5, 0.5)
    assert got[3] == (2.0, 0.0)
    assert round(got[2][0], 9) == round(4 / 3, 9)


def test_spatial_join_gives_each_pair_once(spark):
    rnd = random.Random(2)

    def boxes(n, first):
        out = []
        for i in range(n):
            x, y, w, h = rnd.uniform(-50, 50), rnd.uniform(-50, 50), 10 ** rnd.uniform(-1, 1.3), 10 ** rnd.uniform(-1, 1.3)
            out.append((first + i, "POLYGON", [ring((x, y), (x + w, y), (x + w, y + h), (x, y + h))]))
        return out

    left, right = boxes(40, 0), boxes(40, 100)
    got = [(r.geom_id, r.geom_id_right) for r in spatial.spatial_join(shapes(spark, left), shapes(spark, right)).collect()]

    def meet(a, b):
        (ax0, ay0), (ax1, ay1) = (a[0]["x"], a[0]["y"]), (a[2]["x"], a[2]["y"])
        (bx0, by0), (bx1, by1) = (b[0]["x"], b[0]["y"]), (b[2]["x"], b[2]["y"])
        return ax0 <= bx1 and bx0 <= ax1 and ay0 <= by1 and by0 <= ay1

    want = {(i, j) for i, _, a in left for j, _, b in right if meet(a[0], b[0])}
    assert len(got) == len(set(got))
    assert set(got) == want


def test_canonical_ignores_drawing(spark):
    base = ring((0, 0), (2, 0), (2, 2), (0, 2))
    same = [base, base[::-1], ring((2, 2), (0, 2), (0, 0), (2, 0)), ring((0, 0), (1, 0), (2, 0), (2, 2), (0, 2)),
            ring((0.00000001, 0), (2, 0), (2, 2), (0, 2)), ring((0, 0), (0, 0), (2, 0), (2, 2), (0, 2))]
    other = [ring((0.000001, 0), (2, 0), (2, 2), (0, 2)), ring((0, 0), (2, 0), (2, 2))]
    rows = shapes(spark, [(i, "POLYGON", [g]) for i, g in enumerate(same + other)])
    hashes = [r[0] for r in rows.orderBy("geom_id").select(geo.canonical("rings", "kind")).collect()]
    assert len(set(hashes[: len(same)])) == 1
    assert len(set(hashes)) == 3


def test_geometry_insert_or_get(spark):
    square = ring((-93.2037, 44.9626), (-93.2, 44.9626), (-93.2, 44.965), (-93.2037, 44.965))
    asked = shapes(spark, [(1, "POLYGON", [square]), (2, "POLYGON", [square[::-1]]),
                           (3, "POINT", [[{"x": -93.203209, "y": 44.962470}]])]).withColumnRenamed("geom_id", "n")
    fresh, found = spatial.insert_or_get_geom(CATALOG["geom"].empty(spark), asked)
    ids = {r.n: r.geom_id for r in found.collect()}
    assert ids[1] == ids[2] != ids[3]
    assert fresh.count() == 2
    again, second = spatial.insert_or_get_geom(fresh, asked)
    assert again.isEmpty()
    assert {r.n: r.geom_id for r in second.collect()} == ids
    point = spatial.geometry_by_id(fresh, fresh.filter("kind = 'POINT'").select("geom_id")).first()
    assert (point.rings[0][0].x, point.rings[0][0].y) == (-93.203209, 44.962470)


def test_invalid_polygons(spark):
    rows = [
        (1, "POLYGON", [ring((0, 0), (2, 0), (2, 2), (0, 2))]),
        (2, "POLYGON", [ring((0, 0), (2, 2), (2, 0), (0, 2))]),
        (3, "POLYGON", [ring((0, 0), (2, 0), (2, 2), (0, 2))[:-1]]),
        (4, "POLYGON", [ring((0, 0), (float("nan"), 0), (2, 2))]),
        (5, "POLYGON", [ring((0, 0), (2, 0))]),
        (6, "POLYGON", [ring((0, 0), (4, 0), (4, 4), (2, 0), (0, 4))]),
        (7, "POLYGON", [ring((0, 0), (4, 0), (4, 4), (0, 4)), ring((1, 1), (5, 1), (3, 3))]),
        (8, "POLYGON", [ring((0, 0), (4, 0), (4, 4), (0, 4)), ring((0, 0), (2, 1), (1, 2))]),
        (9, "POLYGON", [ring((0, 0), (4, 0), (4, 4), (6, 4), (4, 4), (0, 4))]),
        (10, "LINESTRING", [[{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 1.0}]]),
        (11, "POLYGON", [ring((0, 0), (0, 0), (2, 0), (2, 2))]),
    ]
    got = {r.geom_id: r.reason for r in spatial.invalid_geometries(shapes(spark, rows)).collect()}
    assert got == {2: "crosses itself", 3: "not closed", 4: "not finite", 5: "too few points",
                   6: "crosses itself", 7: "crosses itself", 9: "crosses itself"}


def test_act_geometry_modes(spark):
    big, part, off = ring((0, 0), (4, 0), (4, 4), (0, 4)), ring((0, 0), (4.0000005, 0), (4, 4)), ring((3, 3), (5, 3), (5, 5))
    geom = shapes(spark, [(1, "POLYGON", [big]), (2, "POLYGON", [part]), (3, "POLYGON", [off])])
    field = spark.createDataFrame([(1, 1)], "field_id long, geom_id long")
    trial = spark.createDataFrame([(5, 1)], "field_trial_id long, field_id long")
    plot = spark.createDataFrame([(8, 5)], "plot_id long, field_trial_id long")
    act = spark.createDataFrame(
        [(1, 1, None, None, 2), (2, 1, None, None, 3), (3, None, 5, None, 2), (4, None, None, 8, 3),
         (5, 1, None, None, None)],
        "act_id long, field_id long, field_trial_id long, plot_id long, geom_id long",
    )
    bad = lambda mode: sorted(
        r.act_id for r in spatial.acts_outside_field(act, field, trial, plot, geom, mode).collect()
    )
    assert bad("resolved_owner") == [2, 4]
    assert bad("as_written") == [2, 3, 4]
    with pytest.raises(ValueError):
        bad("other")


def test_field_centroid(spark):
    geom = shapes(spark, [(1, "POLYGON", [ring((-65.4, -36.2), (-65.2, -36.2), (-65.2, -36.0), (-65.4, -36.0))])])
    field = spark.createDataFrame([(9, 1, datetime(2020, 1, 1))], "field_id long, geom_id long, d timestamp_ntz")
    row = spatial.field_centroids(field, geom).select(F.round("lon", 9), F.round("lat", 9)).first()
    assert tuple(row) == (-65.3, -36.1)


def test_shapes_of_parts_and_points_join(spark):
    square = [ring((0, 0), (10, 0), (10, 10), (0, 10))]
    left = shapes(spark, [
        (1, "MULTIPOLYGON", [ring((50, 50), (51, 50), (51, 51)), ring((4, 4), (5, 4), (5, 5))]),
        (2, "POINT", [[{"x": 3.0, "y": 3.0}]]),
        (3, "MULTIPOINT", [[{"x": 70.0, "y": 7.0}], [{"x": 10.0, "y": 5.0}]]),
        (4, "POINT", [[{"x": 30.0, "y": 3.0}]]),
    ])
    right = shapes(spark, [(9, "POLYGON", square), (8, "POINT", [[{"x": 30.0, "y": 3.0}]])])
    pairs = {(r["geom_id"], r["geom_id_right"]) for r in spatial.spatial_join(left, right).collect()}
    assert pairs == {(1, 9), (2, 9), (3, 9), (4, 8)}
    turned = {(r["geom_id_right"], r["geom_id"]) for r in spatial.spatial_join(right, left).collect()}
    assert turned == pairs


def test_bar_over_a_notch_is_not_covered(spark):
    u = [ring((0, 0), (9, 0), (9, 9), (6, 9), (6, 3), (3, 3), (3, 9), (0, 9))]
    bars = {1: ring((1, 6), (8, 6), (8, 7), (1, 7)), 2: ring((1, 1), (8, 1), (8, 2), (1, 2)), 3: ring((0, 0), (9, 0), (9, 3), (0, 3))}
    rows = [(i, "POLYGON", [g]) for i, g in bars.items()]
    inner, outer = spatial.outline(shapes(spark, rows), "_in"), spatial.outline(shapes(spark, [(9, "POLYGON", u)]), "_out")
    got = inner.join(outer, F.lit(True)).select("_in_id", spatial.covered("_out", "_in").alias("ok")).collect()
    assert {r["_in_id"]: r["ok"] for r in got} == {1: False, 2: True, 3: True}


def test_a_hole_inside_the_inner_shape_is_seen(spark):
    square, hole = ring((0, 0), (9, 0), (9, 9), (0, 9)), ring((3, 3), (3, 6), (6, 6), (6, 3))
    touching = ring((0, 0), (3, 1), (1, 3))  # a hole that touches the border in a corner
    rows = [
        (1, "POLYGON", [square]), (2, "POLYGON", [square, hole]), (3, "POLYGON", [ring((1, 1), (2, 1), (2, 8), (1, 8))]),
        (4, "POLYGON", [hole]), (5, "POLYGON", [ring((2, 2), (7, 2), (7, 7), (2, 7))]),
        (6, "POLYGON", [ring((2, 2), (7, 2), (7, 7), (2, 7)), hole]), (7, "POLYGON", [square, touching]),
        (8, "MULTIPOLYGON", [ring((0, 0), (4, 0), (4, 9), (0, 9)), ring((5, 0), (9, 0), (9, 9), (5, 9))]),
        (9, "POINT", [[{"x": 4.5, "y": 4.5}]]), (10, "LINESTRING", [[{"x": 1.0, "y": 1.0}, {"x": 2.0, "y": 8.0}]]),
        (11, "LINESTRING", [[{"x": 1.0, "y": 1.0}, {"x": 8.0, "y": 8.0}]]), (12, "POINT", [[{"x": 1.0, "y": 1.0}]]),
    ]
    pairs = spark.createDataFrame([(i, o) for i in range(1, 13) for o in range(1, 13)] * 2, "inner_id long, outer_id long")
    got = {(r.inner_id, r.outer_id) for r in spatial.covered_pairs(pairs, shapes(spark, rows)).collect()}
    want = {(i, i) for i in range(1, 13)} | {(i, 1) for i in range(1, 13)}
    want |= {(3, 2), (6, 2), (10, 2), (12, 2), (6, 5), (4, 5), (9, 5), (9, 4), (4, 7), (5, 7), (6, 7), (9, 7)}
    want |= {(3, 8), (10, 8), (12, 8), (12, 10), (12, 11), (9, 11), (10, 3), (12, 3)}
    # a polygon that fills the hole has its whole border on the outer one: (4, 2), (4, 6) are none; (1, 1) lies in the touching hole
    assert got == want

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from croplake.functions import utm
from croplake.operators import grid


def test_known_point(spark):
    points = spark.createDataFrame([(-93.12345, 44.67890)], "lon double, lat double")
    row = grid.cells_of_points(points).first()
    assert (row.world_utm_id, row.rast_col, row.rast_row, row.cell_id) == (917, 50, 104, 17211907)
    assert (row.lng_centroid, row.lat_centroid) == (-93.10847, 44.66063)
    assert (row.utm_zone, row.utm_row, row.utc_offset_seconds) == (15, "T", -21600)


def test_polygons(spark):
    world = grid.world_utm(spark)
    assert world.count() == 1201
    by_id = {r.world_utm_id: r for r in world.collect()}
    assert (by_id[1].row, by_id[1].zone, by_id[1].utc_offset_seconds) == ("A", 0, -21600)
    assert (by_id[1201].row, by_id[1201].utc_offset_seconds) == ("Z", 21600)
    assert by_id[917].n_cells == 17343
    # the five polygons before and with 917 share one run of ids
    assert by_id[917].first_cell_id + by_id[917].n_cells - 1 == 17218910
    last = 0
    for i in sorted(by_id):
        assert by_id[i].first_cell_id > last
        last = by_id[i].first_cell_id + by_id[i].n_cells - 1


def test_projection_round_trip():
    for lon, lat in ((-2.9, 0.5), (2.9, 47.0), (1.0, 83.9), (5.9, 60.0)):
        east, north = utm.forward(lon, lat)
        xi, eta = utm.unproject(east, north, utm.NumpyMath)
        m = utm.NumpyMath
        chi = m.asin(m.sin(xi) / m.cosh(eta))
        assert abs(m.degrees(utm.latitude(chi, m)) - lat) < 1e-9
        assert abs(m.degrees(m.atan2(m.sinh(eta), m.cos(xi))) - lon) < 1e-9


def test_cells_find_themselves(spark):
    """Centres of cells, all kinds of polygons: centre -> cell -> centre is the identity."""
    polygons = spark.createDataFrame([(1,), (5,), (330,), (1055,), (1150,), (1201,)], "world_utm_id int")
    cells = grid.grid_cells(spark, polygons).filter(F.col("cell_id") % 97 == 0)
    info = grid.cell_info(cells.select("cell_id", F.col("rast_col").alias("c"), F.col("rast_row").alias("r")))
    assert info.count() == cells.count()
    assert info.filter("c <> rast_col or r <> rast_row").isEmpty()
    centres = cells.select("cell_id", F.col("lng_centroid").alias("lon"), F.col("lat_centroid").alias("lat"),
                           "world_utm_id")
    back = grid.cells_of_points(centres.withColumnsRenamed({"cell_id": "want", "world_utm_id": "polygon"}))
    # border cells may have their centre in the neighbour polygon
    inside = back.filter("world_utm_id = polygon")
    assert inside.count() > 100
    assert inside.filter("want <> cell_id").isEmpty()


@pytest.mark.parametrize("lon, lat, zone, row", [
    (-96.0, 44.0, 14, "T"), (-93.0, 48.0, 15, "T"), (3.0, 60.0, 31, "V"), (3.1, 60.0, 32, "V"),
    (0.0, 60.0, 30, "V"), (9.0, 75.0, 31, "X"), (21.5, 75.0, 35, "X"), (42.0, 75.0, 37, "X"),
    (180.0, 10.0, 60, "P"), (-180.0, 10.0, 1, "P"), (10.0, -80.0, 0, "B"), (10.0, 84.0, 32, "X"),
    (-10.0, 84.1, 0, "Y"), (34.0, 75.0, 37, "X"),
])
def test_border_belongs_to_the_smaller_id(spark, lon, lat, zone, row):
    points = spark.createDataFrame([(lon, lat)], "lon double, lat double")
    got = grid.cells_of_points(points).first()
    if (lon, row) == (10.0, "X"):
        zone = 33
    assert (got.utm_zone, got.utm_row) == (zone, row)
    assert got.cell_id is not None


def test_metadata_and_missing_polygons(spark):
    meta = grid.grid_metadata(spark).filter("world_utm_id = 917").first().rast_metadata
    assert '"crs":"EPSG:32615"' in meta and '"width":103' in meta
    known, missing = grid.polygon_info(spark.createDataFrame([(917,), (5000,)], "world_utm_id int"))
    assert known.first().utm_row == "T"
    assert [r[0] for r in missing.collect()] == [5000]

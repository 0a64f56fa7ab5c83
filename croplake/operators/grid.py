"""The worldwide 5 km grid: polygons, cells, and the assignment of points to cells.

A polygon is a UTM zone × latitude band (or half a polar cap). It has its own plane and its own
raster of 5 km cells; the cells its area touches are numbered row by row, away from the equator,
and numbers go on from polygon to polygon by (row letter, zone). Polygons of one band have the
same outline, so the touched cells are described once per outline, as runs of columns per raster
row. These two tables are constants of the world (1,201 polygons, about 4,000 runs): they are sent
to every task, and assigning a point is arithmetic without a shuffle.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from croplake.catalog import UTM_ROWS
from croplake.functions import utm

CELL = 5000.0
BAND_LETTERS = UTM_ROWS[2:-2]
#: fixed values: zones of the two bands with other widths, as (zone, west, east)
ODD_ZONES = {
    "V": {31: (0, 3), 32: (3, 12)},
    "X": {31: (0, 9), 33: (9, 21), 35: (21, 33), 37: (33, 42)},
}
ABSENT = {("X", 32), ("X", 34), ("X", 36)}
#: fixed value: ids set aside for the two southern polar polygons together
SOUTH_POLAR_IDS = 156905
RUN_BUCKET = 64
ID_BLOCK = 4096


def _band_bounds(letter: str) -> tuple[int, int]:
    i = BAND_LETTERS.index(letter)
    return -80 + 8 * i, (84 if letter == "X" else -72 + 8 * i)


def _solve(f, lo: float, hi: float, targets: np.ndarray) -> np.ndarray:
    """Where the rising function ``f`` takes each of ``targets``, by bisection."""
    low, high = np.full_like(targets, lo), np.full_like(targets, hi)
    for _ in range(50):
        mid = (low + high) / 2
        below = f(mid) < targets
        low, high = np.where(below, mid, low), np.where(below, high, mid)
    return (low + high) / 2


def _band_runs(west: float, east: float, near: float, far: float) -> list[tuple[int, int, int]]:
    """Runs (row, first column, cells) of the cells a zone outline touches.

    ``west`` and ``east`` count from the central meridian; ``near`` and ``far`` are sizes of
    latitude. The near parallel sags towards the equator at the central meridian and the far one
    too, so the last rows can have two runs, one at each corner.
    """
    e0, n0, top = utm.forward(west, near)[0], utm.forward(0.0, near)[1], utm.forward(0.0, far)[1]
    n1 = max(utm.forward(west, far)[1], utm.forward(east, far)[1])
    row = np.arange(math.ceil((n1 - n0) / CELL))
    lo, hi = n0 + row * CELL, n0 + (row + 1) * CELL
    outer, inner, present = [], [], []
    for edge in (west, east):
        low_corner, high_corner = utm.forward(edge, near)[1], utm.forward(edge, far)[1]
        on_near = utm.forward(_solve(lambda s, e=edge: utm.forward(s * e, near)[1], 0.0, 1.0, hi) * edge, near)[0]
        on_side = utm.forward(edge, _solve(lambda p, e=edge: utm.forward(e, p)[1], near, far, lo))[0]
        on_far = utm.forward(_solve(lambda s, e=edge: utm.forward(s * e, far)[1], 0.0, 1.0, lo) * edge, far)[0]
        corner = utm.forward(edge, near)[0]
        outer.append(np.where(hi < low_corner, on_near, np.where(lo <= low_corner, corner, on_side)))
        inner.append(on_far)
        present.append(lo <= high_corner)
    runs: list[tuple[int, int, int]] = []
    for r in row:
        if lo[r] <= top:
            spans = [(outer[0][r], outer[1][r])]
        else:
            spans = [(outer[0][r], inner[0][r])] if present[0][r] else []
            spans += [(inner[1][r], outer[1][r])] if present[1][r] else []
        columns = [(int((a - e0) // CELL), int((b - e0) // CELL)) for a, b in spans]
        if len(columns) == 2 and columns[1][0] <= columns[0][1]:
            columns = [(columns[0][0], columns[1][1])]
        runs += [(int(r), a, b - a + 1) for a, b in columns]
    return runs


def _polar_runs(edge_lat: float) -> list[tuple[int, int, int]]:
    """Runs of half a polar cap: columns count from the dividing meridian outwards."""
    radius = float(utm.polar_rho(edge_lat, utm.NumpyMath))
    runs = []
    for r in range(math.ceil(2 * radius / CELL)):
        lo, hi = -radius + r * CELL, -radius + (r + 1) * CELL
        y = 0.0 if lo <= 0 <= hi else min(abs(lo), abs(hi))
        runs.append((r, 0, int(math.sqrt(max(radius * radius - y * y, 0.0)) // CELL) + 1))
    return runs


@lru_cache(maxsize=1)
def _world() -> tuple[list[tuple], list[tuple]]:
    """Rows of the polygon table and of the run table."""
    outlines: dict[tuple, int] = {}
    runs_of: list[list[tuple[int, int, int]]] = []

    def outline(key: tuple, make) -> int:
        if key not in outlines:
            outlines[key] = len(runs_of)
            runs_of.append(make())
        return outlines[key]

    polygons = []
    for letter in UTM_ROWS:
        if letter in "ABYZ":
            north, west = letter in "YZ", letter in "AY"
            edge = 84.0 if north else 80.0
            shape = outline(("polar", edge), lambda e=edge: _polar_runs(e))
            radius = float(utm.polar_rho(edge, utm.NumpyMath))
            polygons.append(dict(
                zone=0, row=letter, west=-180.0 if west else 0.0, east=0.0 if west else 180.0,
                south=84.0 if north else -90.0, north=90.0 if north else -80.0, meridian=0.0,
                offset=-21600 if west else 21600, epsg=32661 if north else 32761, shape=shape,
                e0=utm.POLAR_FALSE, n0=utm.POLAR_FALSE - radius, dx=-1 if west else 1, dy=1,
            ))
            continue
        south, north = _band_bounds(letter)
        for zone in range(1, 61):
            if (letter, zone) in ABSENT:
                continue
            meridian = zone * 6 - 183
            west, east = ODD_ZONES.get(letter, {}).get(zone, (meridian - 3, meridian + 3))
            near, far = sorted((float(abs(south)), float(abs(north))))
            key = (float(west - meridian), float(east - meridian), near, far)
            shape = outline(key, lambda k=key: _band_runs(*k))
            up = north > 0
            e0 = float(utm.forward(key[0], near)[0])
            n0 = float(utm.forward(0.0, near)[1])
            polygons.append(dict(
                zone=zone, row=letter, west=float(west), east=float(east), south=float(south),
                north=float(north), meridian=float(meridian),
                offset=round(meridian / 15) * 3600, epsg=(32600 if up else 32700) + zone,
                shape=shape, e0=e0, n0=n0 if up else utm.FALSE_NORTHING_SOUTH - n0,
                dx=1, dy=1 if up else -1,
            ))
    counts = [sum(n for _, _, n in runs) for runs in runs_of]
    rows, first = [], 1
    for i, p in enumerate(polygons, start=1):
        n = counts[p["shape"]]
        n_rows = max(r for r, _, _ in runs_of[p["shape"]]) + 1
        n_cols = max(c + k for _, c, k in runs_of[p["shape"]])
        rows.append((
            i, p["zone"], p["row"], p["offset"], p["epsg"], p["west"], p["south"], p["east"],
            p["north"], p["meridian"], p["shape"], p["e0"], p["n0"], p["dx"], p["dy"], first, n,
            n_cols, n_rows,
        ))
        first += n
        if p["row"] == "B":
            first = SOUTH_POLAR_IDS + 1
    runs_out = []
    for shape, runs in enumerate(runs_of):
        before = 0
        for r, c, n in runs:
            runs_out.append((shape, r, c, n, before))
            before += n
    return rows, runs_out


_POLYGON_SCHEMA = (
    "world_utm_id int, zone int, row string, utc_offset_seconds int, raster_epsg int, west double, "
    "south double, east double, north double, meridian double, shape_id int, origin_x double, "
    "origin_y double, step_x int, step_y int, first_cell_id long, n_cells int, n_cols int, n_rows int"
)


def world_utm(spark: SparkSession) -> DataFrame:
    """The 1,201 polygons with bounds, offset, plane, raster origin and first cell id."""
    return spark.createDataFrame(_world()[0], _POLYGON_SCHEMA)


def grid_runs(spark: SparkSession) -> DataFrame:
    """Touched cells per outline: raster row, first column, cells, and cells before the run."""
    return spark.createDataFrame(
        _world()[1], "shape_id int, grid_row int, col_start int, n int, before int"
    )


def grid_metadata(spark: SparkSession) -> DataFrame:
    """Raster description per polygon."""
    return world_utm(spark).select(
        "world_utm_id",
        F.to_json(
            F.struct(
                F.concat(F.lit("EPSG:"), F.col("raster_epsg")).alias("crs"),
                F.lit("uint32").alias("dtype"), F.lit(1).alias("count"),
                F.col("n_cols").alias("width"), F.col("n_rows").alias("height"),
                F.array(
                    "origin_x", F.col("step_x") * CELL, F.lit(0.0), "origin_y", F.lit(0.0),
                    F.col("step_y") * CELL,
                ).alias("transform"),
            )
        ).alias("rast_metadata"),
    )


def _solid(value: Column) -> Column:
    """``value``, NaN for null: arithmetic on it needs no null checks, which keeps the generated
    code of the long series small enough to be compiled."""
    return F.coalesce(value, F.lit(float("nan")))


def _centre_columns(df: DataFrame) -> DataFrame:
    """Adds lng_centroid and lat_centroid of (grid_col, grid_row) in the row's polygon plane."""
    x = F.col("origin_x") + (F.col("grid_col") + 0.5) * CELL * F.col("step_x")
    y = F.col("origin_y") + (F.col("grid_row") + 0.5) * CELL * F.col("step_y")
    south = F.col("raster_epsg").between(32701, 32760)
    polar = F.col("zone") == 0
    planed = df.withColumn("_x", _solid(x)).withColumn(
        "_y", _solid(F.when(south, y - utm.FALSE_NORTHING_SOUTH).otherwise(y))
    )
    xi, eta = utm.unproject(F.col("_x"), F.col("_y"), F)
    planed = planed.withColumn("_xi", xi).withColumn("_eta", eta)
    planed = planed.withColumn(
        "_px", F.col("_x") - utm.POLAR_FALSE
    ).withColumn("_py", F.col("_y") - utm.POLAR_FALSE)
    rho = F.sqrt(F.col("_px") * F.col("_px") + F.col("_py") * F.col("_py"))
    north_pole = F.col("raster_epsg") == 32661
    chi = F.when(polar, utm.polar_chi(rho, F)).otherwise(
        F.asin(F.sin("_xi") / F.cosh("_eta"))
    )
    planed = planed.withColumn("_chi", chi)
    lat = F.degrees(utm.latitude(F.col("_chi"), F))
    lon = F.when(
        polar,
        F.degrees(F.atan2(F.col("_px"), F.when(north_pole, -F.col("_py")).otherwise(F.col("_py")))),
    ).otherwise(F.col("meridian") + F.degrees(F.atan2(F.sinh("_eta"), F.cos("_xi"))))
    return (
        planed.withColumn("lng_centroid", F.round(lon, 5))
        .withColumn(
            "lat_centroid",
            F.round(F.when(polar & ~north_pole, -lat).otherwise(lat), 5),
        )
        .drop("_x", "_y", "_xi", "_eta", "_px", "_py", "_chi")
    )


def grid_cells(spark: SparkSession, polygons: DataFrame | None = None) -> DataFrame:
    """Every cell of the given polygons (or of the world): ids, column, row, centre.

    Cells come out of the runs by ``explode``; nothing is counted or ranked over cells.
    """
    wanted = world_utm(spark)
    if polygons is not None:
        wanted = wanted.join(polygons.select("world_utm_id").distinct(), "world_utm_id", "left_semi")
    # one row per polygon and raster row, dealt out so that many tasks blow them up
    strips = wanted.join(F.broadcast(grid_runs(spark)), "shape_id").repartition("world_utm_id", "grid_row")
    cells = strips.select(
        "*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("_i")
    ).withColumn("grid_col", F.col("col_start") + F.col("_i")).withColumn(
        "cell_id", F.col("first_cell_id") + F.col("before") + F.col("_i")
    )
    return _centre_columns(cells).select(
        "world_utm_id", "zone", "row", "cell_id", (F.col("grid_col") + 1).alias("rast_col"),
        (F.col("grid_row") + 1).alias("rast_row"), "lng_centroid", "lat_centroid",
    )


def zone_of(lon: Column, lat: Column) -> tuple[Column, Column]:
    """(zone, row letter) of a point; on a border the polygon with the smaller ids."""
    band = F.least(F.greatest(F.ceil((lat + 80) / 8), F.lit(1)), F.lit(20)).cast("int")
    letters = F.array(*[F.lit(c) for c in BAND_LETTERS])
    polar = F.when(lat <= -80, F.when(lon <= 0, "A").otherwise("B")).when(
        lat > 84, F.when(lon <= 0, "Y").otherwise("Z")
    )
    # never null, so that no null filter repeats these expressions below the join that uses them
    letter = F.coalesce(polar, F.element_at(letters, band), F.lit(""))
    zone = F.least(F.greatest(F.ceil((lon + 180) / 6), F.lit(1)), F.lit(60)).cast("int")
    for band_letter, zones in ODD_ZONES.items():
        lo = min(w for w, _ in zones.values())
        hi = max(e for _, e in zones.values())
        odd = F.lit(None).cast("int")
        for z, (w, e) in sorted(zones.items(), reverse=True):
            odd = F.when(lon <= e, F.lit(z)).otherwise(odd)
        # the western border belongs to the zone before
        zone = F.when((letter == band_letter) & (lon > lo) & (lon <= hi), odd).otherwise(zone)
    return F.coalesce(F.when(polar.isNotNull(), F.lit(0)).otherwise(zone), F.lit(-1)), letter


def cells_of_points(points: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """``points`` plus world_utm_id, rast_col, rast_row, cell_id and the cell's centre.

    Columns and rows count from 1. Both joins send a world constant to the tasks; the points are
    not shuffled.
    """
    spark = points.sparkSession
    zone, letter = zone_of(F.col(lon), F.col(lat))
    polygons = world_utm(spark).select(
        F.col("zone"), F.col("row").alias("utm_row"), "world_utm_id", "utc_offset_seconds",
        "raster_epsg", "meridian", "shape_id", "origin_x", "origin_y", "step_x", "step_y",
        "first_cell_id",
    )
    runs = grid_runs(spark).select(
        F.col("shape_id").alias("_shape"), F.col("grid_row").alias("_row"), "col_start", "n",
        "before",
    )
    placed = points.withColumn("zone", zone).withColumn("utm_row", letter).join(
        F.broadcast(polygons), ["zone", "utm_row"]
    )
    polar = F.col("zone") == 0
    t = utm.conformal(F.radians(_solid(F.col(lat))), F)
    placed = placed.withColumn("_t", t).withColumn(
        "_dl", F.radians(_solid(F.col(lon) - F.col("meridian")))
    )
    xi, eta = utm.spherical(F.col("_dl"), F.col("_t"), F)
    placed = placed.withColumn("_xi", xi).withColumn("_eta", eta)
    placed = placed.withColumn("_east", utm.easting(F.col("_xi"), F.col("_eta"), F)).withColumn(
        "_north", utm.northing(F.col("_xi"), F.col("_eta"), F)
    ).withColumn("_rho", utm.polar_rho(F.abs(_solid(F.col(lat))), F))
    rho = F.col("_rho")
    south = F.col("raster_epsg").between(32701, 32760)
    north_pole = F.col("raster_epsg") == 32661
    x = F.when(polar, F.lit(utm.POLAR_FALSE) + rho * F.sin(F.radians(lon))).otherwise(F.col("_east"))
    y_polar = rho * F.cos(F.radians(lon))
    y = F.when(polar & north_pole, F.lit(utm.POLAR_FALSE) - y_polar).when(
        polar, F.lit(utm.POLAR_FALSE) + y_polar
    ).otherwise(
        F.col("_north") + F.when(south, F.lit(utm.FALSE_NORTHING_SOUTH)).otherwise(F.lit(0.0))
    )
    placed = placed.withColumn("_x", x).withColumn("_y", y)
    placed = placed.withColumn(
        "grid_col", F.floor((F.col("_x") - F.col("origin_x")) * F.col("step_x") / CELL).cast("int")
    ).withColumn(
        "grid_row", F.floor((F.col("_y") - F.col("origin_y")) * F.col("step_y") / CELL).cast("int")
    )
    found = placed.join(
        F.broadcast(runs),
        (F.col("shape_id") == F.col("_shape")) & (F.col("grid_row") == F.col("_row"))
        & F.col("grid_col").between(F.col("col_start"), F.col("col_start") + F.col("n") - 1),
        "left",
    )
    return _centre_columns(found).select(
        *points.columns, "world_utm_id", F.col("zone").alias("utm_zone"), "utm_row",
        "utc_offset_seconds",
        (F.col("grid_col") + 1).alias("rast_col"), (F.col("grid_row") + 1).alias("rast_row"),
        (F.col("first_cell_id") + F.col("before") + F.col("grid_col") - F.col("col_start"))
        .alias("cell_id"),
        "lng_centroid", "lat_centroid",
    )


def cell_info(cells: DataFrame) -> DataFrame:
    """Rows of ``cells`` (cell_id) with polygon, zone, row, offset, raster position and centre.

    Ids of a polygon are consecutive, so a cell finds its polygon through a short table of id
    blocks and its raster row through one of run blocks; unknown ids drop.
    """
    spark = cells.sparkSession
    last = F.col("first_cell_id") + F.col("n_cells") - 1
    blocks = world_utm(spark).withColumn(
        "_block",
        F.explode(F.sequence(F.floor(F.col("first_cell_id") / ID_BLOCK), F.floor(last / ID_BLOCK))),
    )
    runs = grid_runs(spark).withColumn(
        "_piece",
        F.explode(
            F.sequence(
                F.floor(F.col("before") / RUN_BUCKET),
                F.floor((F.col("before") + F.col("n") - 1) / RUN_BUCKET),
            )
        ),
    ).withColumnRenamed("shape_id", "_shape").withColumnRenamed("n", "_n")
    keep = [F.col(c) for c in cells.columns]
    with_polygon = cells.withColumn("_b", F.floor(F.col("cell_id") / ID_BLOCK)).join(
        F.broadcast(blocks.drop("cell_id", *[c for c in cells.columns if c != "cell_id"])),
        (F.col("_b") == F.col("_block")) & F.col("cell_id").between(F.col("first_cell_id"), last),
    ).withColumn("_local", F.col("cell_id") - F.col("first_cell_id"))
    found = with_polygon.withColumn("_p", F.floor(F.col("_local") / RUN_BUCKET)).join(
        F.broadcast(runs),
        (F.col("shape_id") == F.col("_shape")) & (F.col("_p") == F.col("_piece"))
        & F.col("_local").between(F.col("before"), F.col("before") + F.col("_n") - 1),
    ).withColumn("grid_col", (F.col("col_start") + F.col("_local") - F.col("before")).cast("int"))
    return _centre_columns(found).select(
        *keep, "world_utm_id", F.col("zone").alias("utm_zone"), F.col("row").alias("utm_row"),
        "utc_offset_seconds", (F.col("grid_col") + 1).alias("rast_col"),
        (F.col("grid_row") + 1).alias("rast_row"), "lng_centroid", "lat_centroid",
    )


def polygon_info(polygons: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(offset, zone and row of the wanted polygons, wanted ids that do not exist)``."""
    world = world_utm(polygons.sparkSession)
    wanted = polygons.select("world_utm_id").distinct()
    known = world.join(wanted, "world_utm_id", "left_semi").select(
        "world_utm_id", "utc_offset_seconds", F.col("zone").alias("utm_zone"),
        F.col("row").alias("utm_row"),
    )
    return known, wanted.join(F.broadcast(world), "world_utm_id", "left_anti")


def points_on_land(points: DataFrame, land_cells: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Points whose grid cell is in a table of land cells."""
    placed = cells_of_points(points, lon, lat)
    return placed.join(land_cells.select("cell_id"), "cell_id", "left_semi").select(*points.columns)

"""Joins and checks on geometry, through tiles: an equi-join first, the exact test after."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from croplake.catalog import CATALOG
from croplake.functions import geo
from croplake.operators import keyed
from croplake.operators.ranking import null_safe_join
from croplake.operators.views import owner_field
from croplake.session import cut_lineage, dealt, shuffled

MAX_LEVEL = 24
COVER_TOLERANCE = 1e-6


def _level(box: str) -> Column:
    """The finest tile level whose tiles are no smaller than the box, so it covers four at most."""
    extent = F.greatest(F.expr(f"{box}.x1 - {box}.x0"), F.expr(f"{box}.y1 - {box}.y0"))
    fit = F.floor(F.log2(F.lit(360.0) / F.greatest(extent, F.lit(1e-9)))).cast("int")
    return F.least(F.greatest(fit, F.lit(0)), F.lit(MAX_LEVEL))


def _tile(value: Column, origin: float, level: Column) -> Column:
    return F.floor((value + F.lit(origin)) * F.pow(F.lit(2.0), level) / F.lit(360.0)).cast("long")


def _with_levels(df: DataFrame, own: str, levels: Column, only_coarser: bool) -> DataFrame:
    """One row per level of ``levels`` the row takes part in."""
    spread = df.withColumn("_lv", F.explode(levels))
    return spread.filter(F.col("_lv") <= F.col(own)) if only_coarser else spread


def _tiles_of_box(df: DataFrame, box: str) -> DataFrame:
    lv = F.col("_lv")
    xs = F.sequence(_tile(F.col(f"{box}.x0"), 180.0, lv), _tile(F.col(f"{box}.x1"), 180.0, lv))
    ys = F.sequence(_tile(F.col(f"{box}.y0"), 180.0, lv), _tile(F.col(f"{box}.y1"), 180.0, lv))
    return df.withColumn("_tx", F.explode(xs)).withColumn("_ty", F.explode(ys))


def _levels_used(*frames: tuple[DataFrame, str]) -> Column:
    """The levels that occur, as one array (at most 25 numbers)."""
    columns = [df.select(F.col(c).alias("_lv")) for df, c in frames]
    every = columns[0]
    for more in columns[1:]:
        every = every.unionByName(more)
    return every.agg(F.collect_set("_lv")).scalar()


def points_in_polygons(
    points: DataFrame, polygons: DataFrame, lon: str = "lon", lat: str = "lat"
) -> DataFrame:
    """Every point with every polygon (``rings``) it lies in or on the border of.

    A polygon sits in at most four tiles of the level that fits its size, a point in one tile per
    level that occurs; they meet on the tile and are then tested exactly. Big polygons therefore
    do not blow up into small tiles, and a crowded tile can be split by the join like any hot key.
    """
    shaped = polygons.withColumn("_box", geo.bbox("rings")).withColumn("_own", _level("_box"))
    tiled = _tiles_of_box(shaped.withColumn("_lv", F.col("_own")), "_box").withColumn(
        "_edges", geo.edges("rings")
    ).drop("_own")
    levels = _levels_used((shaped, "_own"))
    placed = _with_levels(points, lon, levels, False).withColumn(
        "_tx", _tile(F.col(lon), 180.0, F.col("_lv"))
    ).withColumn("_ty", _tile(F.col(lat), 180.0, F.col("_lv")))
    x, y = f"`{lon}`", f"`{lat}`"
    in_box = F.expr(
        f"{x} between _box.x0 and _box.x1 and {y} between _box.y0 and _box.y1"
    )
    return (
        placed.join(tiled, ["_lv", "_tx", "_ty"])
        .filter(in_box)
        .filter(geo.point_in_edges(x, y, "_edges"))
        .drop("_lv", "_tx", "_ty", "_box", "_edges")
    )


def spatial_join(left: DataFrame, right: DataFrame, suffix: str = "_right") -> DataFrame:
    """Rows of two tables with ``rings`` whose shapes intersect, touching included.

    Shapes may have several parts, holes, and rings of a single point. Without edges that meet,
    a ring lies wholly inside or outside the other shape, so one point of every ring decides.
    Columns of the right side that the left has too get ``suffix``. Two shapes meet on the tiles
    of the coarser of their levels; a pair that shares several tiles is taken in the one tile that
    holds the lower left corner of what their boxes share, so no pair is made twice.
    """
    renamed = {c: f"{c}{suffix}" if c in left.columns else c for c in right.columns}
    r_out = right.select(*[F.col(c).alias(n) for c, n in renamed.items()])
    r_rings = renamed["rings"]
    lt = left.withColumn("_lbox", geo.bbox("rings")).withColumn("_lown", _level("_lbox"))
    rt = r_out.withColumn("_rbox", geo.bbox(f"`{r_rings}`")).withColumn("_rown", _level("_rbox"))
    levels = _levels_used((lt, "_lown"), (rt, "_rown"))
    lt = _tiles_of_box(_with_levels(lt, "_lown", levels, True), "_lbox").withColumn(
        "_ledges", geo.edges("rings")
    ).withColumn("_lheads", geo.heads("rings"))
    rt = _tiles_of_box(_with_levels(rt, "_rown", levels, True), "_rbox").withColumn(
        "_redges", geo.edges(f"`{r_rings}`")
    ).withColumn("_rheads", geo.heads(f"`{r_rings}`"))
    shared_x = F.expr("greatest(_lbox.x0, _rbox.x0)")
    shared_y = F.expr("greatest(_lbox.y0, _rbox.y0)")
    boxes_meet = F.expr(
        "_lbox.x0 <= _rbox.x1 and _rbox.x0 <= _lbox.x1 and "
        "_lbox.y0 <= _rbox.y1 and _rbox.y0 <= _lbox.y1"
    )
    at_own_level = F.col("_lv") == F.least("_lown", "_rown")
    here = (_tile(shared_x, 180.0, F.col("_lv")) == F.col("_tx")) & (
        _tile(shared_y, 180.0, F.col("_lv")) == F.col("_ty")
    )
    meets = (
        geo.edges_meet("_ledges", "_redges")
        | geo.some_point_in_edges("_lheads", "_redges")
        | geo.some_point_in_edges("_rheads", "_ledges")
        | F.arrays_overlap("_lheads", "_rheads")
    )
    return (
        lt.join(shuffled(rt), ["_lv", "_tx", "_ty"])
        .filter(at_own_level & boxes_meet & here)
        .filter(meets)
        .select(*left.columns, *renamed.values())
    )


def field_centroids(field: DataFrame, geom: DataFrame) -> DataFrame:
    """(field_id, lon, lat) of each field's geometry."""
    shapes = geom.select("geom_id", geo.centroid("rings", "kind").alias("_c"))
    return field.select("field_id", "geom_id").join(shapes, "geom_id").select(
        "field_id", F.col("_c.x").alias("lon"), F.col("_c.y").alias("lat")
    )


# ---- geometry table -------------------------------------------------------------------------
def with_canonical(shapes: DataFrame) -> DataFrame:
    """Shapes rounded to the stored decimals, with the hash they are compared by."""
    return shapes.withColumn("canonical", geo.canonical("rings", "kind")).withColumn(
        "rings", geo.rounded("rings", geo.STORED_DECIMALS)
    )


def insert_or_get_geom(geom: DataFrame, shapes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(geometry rows to append, shapes with their geom_id)``; equal shapes share one row."""
    return keyed.insert_or_get(geom, with_canonical(shapes), CATALOG["geom"])


def geometry_by_id(geom: DataFrame, ids: DataFrame) -> DataFrame:
    """Geometries of the given ids, rounded to the compared decimals."""
    return ids.select("geom_id").join(geom, "geom_id").withColumn(
        "rings", geo.rounded("rings", geo.COMPARED_DECIMALS)
    )


def repeated_geometries(geom: DataFrame) -> DataFrame:
    """Geometry rows that equal another one in shape."""
    shaped = geom if "canonical" in geom.columns else with_canonical(geom)
    again = shaped.groupBy("canonical").agg(F.count("*").alias("n_rows")).filter("n_rows > 1")
    return null_safe_join(shaped, again, ["canonical"])


#: sides of the tiles that a shape's own edges meet on, as halvings of its extent
EDGE_LEVELS = 20


def _tiled_edges(polygons: DataFrame) -> DataFrame:
    """(geom_id, lv, tx, ty, no, e) of all edges, e being {ring, place, n, a, b, own}.

    ``own`` is the level whose tiles are no smaller than the edge, so that it lies in four at most;
    an edge stands on the tiles of its own level and of every coarser one that the shape has.
    """
    of_ring = (
        "transform(array(filter(transform(slice(g, 2, greatest(size(g) - 1, 0)), "
        "(p, i) -> named_struct('a', g[i], 'b', p)), e -> e.a <> e.b)), es -> transform(es, (e, i) -> "
        "named_struct('ring', r, 'place', i, 'n', size(es), 'a', e.a, 'b', e.b, 'own', cast(least("
        f"{EDGE_LEVELS}, floor(log2(ext / greatest(abs(e.a.x - e.b.x), abs(e.a.y - e.b.y))))) as int))))[0]"
    )
    boxed = polygons.select("geom_id", "rings", geo.bbox("rings").alias("box")).withColumn(
        "ext", F.expr("greatest(box.x1 - box.x0, box.y1 - box.y0)")
    )
    listed = boxed.withColumn("es", F.expr(f"flatten(transform(rings, (g, r) -> {of_ring}))"))
    levels = F.expr("array_distinct(transform(es, e -> e.own))")
    rows = listed.select("geom_id", "box", "ext", levels.alias("levels"), F.posexplode("es").alias("no", "e"))
    rows = rows.withColumn("lv", F.explode(F.expr("filter(levels, l -> l <= e.own)")))

    def tiles(axis: str) -> Column:
        low, high = f"least(e.a.{axis}, e.b.{axis})", f"greatest(e.a.{axis}, e.b.{axis})"
        at = "cast(floor(({v} - box.{o}) * power(2D, lv) / ext) as int)"
        return F.expr(f"sequence({at.format(v=low, o=axis + '0')}, {at.format(v=high, o=axis + '0')})")

    return rows.withColumn("tx", F.explode(tiles("x"))).withColumn("ty", F.explode(tiles("y"))).select(
        "geom_id", "lv", "tx", "ty", "no", "e"
    )


def _edges_cross() -> str:
    """Condition on edges e and d of one shape: the border crosses, overlaps or touches itself there."""
    def turn(p: str, q: str, r: str) -> str:
        return f"signum(({q}.x - {p}.x) * ({r}.y - {p}.y) - ({q}.y - {p}.y) * ({r}.x - {p}.x))"

    def low(k: str, c: str) -> str:
        return f"least({k}.a.{c}, {k}.b.{c})"

    def high(k: str, c: str) -> str:
        return f"greatest({k}.a.{c}, {k}.b.{c})"

    t1, t2 = turn("e.a", "e.b", "d.a"), turn("e.a", "e.b", "d.b")
    t3, t4 = turn("d.a", "d.b", "e.a"), turn("d.a", "d.b", "e.b")
    boxes = " and ".join(
        f"{low('e', c)} <= {high('d', c)} and {low('d', c)} <= {high('e', c)}" for c in "xy"
    )
    step = "abs(e.place - d.place)"
    neighbour = f"(e.ring = d.ring and ({step} = 1 or {step} = e.n - 1))"
    flat = f"({t1} = 0 and {t2} = 0)"
    meet = f"({t1} * {t2} <= 0 and {t3} * {t4} <= 0)"
    proper = f"({t1} * {t2} < 0 and {t3} * {t4} < 0)"
    # edges in a row share an end; that is fine unless one folds back over the other
    back = "(e.b.x - e.a.x) * (d.b.x - d.a.x) + (e.b.y - e.a.y) * (d.b.y - d.a.y) < 0"
    # two rings may touch at a point but not cross or share a stretch
    stretch = " or ".join(f"least({high('e', c)}, {high('d', c)}) > greatest({low('e', c)}, {low('d', c)})" for c in "xy")
    return (
        f"{boxes} and (({neighbour} and {flat} and {back}) or ({meet} and e.ring = d.ring and not {neighbour}) "
        f"or ({meet} and e.ring <> d.ring and ({proper} or ({flat} and ({stretch})))))"
    )


def self_crossing(polygons: DataFrame) -> DataFrame:
    """geom_id of the polygons whose border crosses or overlaps itself.

    Edges of a shape meet on tiles of the coarser of their levels; a shape of many edges is thus
    spread over as many tasks as it needs.
    """
    edges = cut_lineage(_tiled_edges(polygons))  # read for both sides
    other = edges.select("geom_id", "lv", "tx", "ty", F.col("no").alias("other"), F.col("e").alias("d"))
    pairs = edges.join(shuffled(other), ["geom_id", "lv", "tx", "ty"]).filter("no < other and lv = least(e.own, d.own)")
    return pairs.filter(F.expr(_edges_cross())).select("geom_id").distinct()


def invalid_geometries(geom: DataFrame) -> DataFrame:
    """Polygons that are no valid area, with ``reason``.

    Open, short or non-finite rings are found in the row; only what passes those is looked at for
    crossings.
    """
    reason = F.expr(
        "case when size(rings) = 0 or exists(rings, g -> size(g) < 4) then 'too few points' "
        "when exists(flatten(rings), p -> p.x is null or p.y is null or isnan(p.x) or isnan(p.y) "
        "or abs(p.x) = double('infinity') or abs(p.y) = double('infinity')) "
        "then 'not finite' "
        "when exists(rings, g -> g[0] <> g[size(g) - 1]) then 'not closed' end"
    )
    # dealt out and written before any row is judged: a filter on the reason would go below the deal and judge in the
    # few tasks that read the table
    judged = cut_lineage(dealt(geom.filter(F.col("kind").endswith("POLYGON")), "geom_id").withColumn("reason", reason))
    crossing = self_crossing(judged.filter("reason is null")).withColumnRenamed("geom_id", "_crossing")
    rows = judged.join(shuffled(crossing), F.col("geom_id") == F.col("_crossing"), "left")
    return rows.withColumn(
        "reason", F.coalesce("reason", F.when(F.col("_crossing").isNotNull(), F.lit("crosses itself")))
    ).filter("reason is not null").drop("_crossing")


def outline(geom: DataFrame, prefix: str, tol: float = COVER_TOLERANCE) -> DataFrame:
    """What cover tests need of each geometry, worked out once per shape.

    ``_edges`` are its border, ``_area`` the edges of polygons (none of lines and points), ``_points``
    its points, ``_marks`` the ends and middles of its border and ``_inside`` points just within it.
    """
    none = F.array().cast("array<struct<a:struct<x:double,y:double>,b:struct<x:double,y:double>>>")
    shaped = geom.select(
        F.col("geom_id").alias(f"{prefix}_id"), geo.border("rings").alias(f"{prefix}_edges"),
        geo.vertices("rings").alias(f"{prefix}_points"), "kind",
    )
    area = F.when(F.col("kind").endswith("POLYGON"), F.col(f"{prefix}_edges")).otherwise(none)
    return shaped.withColumn(f"{prefix}_area", area).select(
        "*", geo.marks(f"{prefix}_edges").alias(f"{prefix}_marks"),
        geo.just_inside(f"{prefix}_area", 4 * tol).alias(f"{prefix}_inside"),
    ).drop("kind")


def covered(outer: str, inner: str, tol: float = COVER_TOLERANCE) -> Column:
    """Condition: the shape of outline ``inner`` lies in that of ``outer`` or within ``tol`` of its border.

    All points, all edges between them and the points just inside do (the last where both borders
    are the same, as of a hole and what fills it), and no border of the outer shape lies within the
    inner area: as no edge crosses, a ring of the outer shape is wholly on one side, so a hole there
    shows by any of its points. A line or a point covers what lies on it.
    """
    return (
        geo.points_covered(f"{inner}_points", f"{outer}_area", f"{outer}_edges", tol)
        & geo.points_covered(f"{inner}_inside", f"{outer}_area", f"{outer}_edges", tol)
        & geo.edges_covered(f"{inner}_edges", f"{outer}_area", f"{outer}_edges", tol)
        & ~geo.some_point_within(f"{outer}_marks", f"{inner}_area", tol)
    )


def covered_pairs(pairs: DataFrame, geom: DataFrame, tol: float = COVER_TOLERANCE) -> DataFrame:
    """The distinct (inner_id, outer_id) of ``pairs`` whose outer geometry covers the inner one."""
    def of(ids: str) -> DataFrame:
        # only shapes that are asked for, dealt out before their outlines are made: few bytes of keys, much work
        wanted = pairs.select(F.col(ids).alias("geom_id")).distinct()
        return geom.join(shuffled(wanted), "geom_id", "left_semi").repartition("geom_id")

    inner = outline(of("inner_id"), "_in", tol).drop("_in_marks")
    outer = outline(of("outer_id"), "_out", tol).drop("_out_points", "_out_inside")
    return (
        pairs.select("inner_id", "outer_id").distinct()
        .join(shuffled(inner), F.col("inner_id") == F.col("_in_id"))
        .join(shuffled(outer), F.col("outer_id") == F.col("_out_id"))
        .filter(covered("_out", "_in", tol)).select("inner_id", "outer_id")
    )


def acts_outside_field(
    act: DataFrame, field: DataFrame, field_trial: DataFrame, plot: DataFrame, geom: DataFrame,
    mode: str = "resolved_owner", tol: float = COVER_TOLERANCE,
) -> DataFrame:
    """Acts with a geometry that their field's does not cover.

    ``mode="resolved_owner"`` takes the owning field; ``"as_written"`` the act's own field_id, so
    that every act on a trial or plot with a geometry is reported. Each pair of geometries is tested
    once, however many acts share it; a geometry covers itself.
    """
    if mode not in ("resolved_owner", "as_written"):
        raise ValueError('mode must be "resolved_owner" or "as_written"')
    shaped = act.filter(F.col("geom_id").isNotNull())
    if mode == "resolved_owner":
        shaped = owner_field(shaped, field_trial, plot)
    else:
        shaped = shaped.withColumn("owner_field_id", F.col("field_id"))
    outer = field.select(F.col("field_id").alias("_f"), F.col("geom_id").alias("outer_id"))
    placed = shaped.join(shuffled(outer), F.col("owner_field_id") == F.col("_f"), "left")
    # read for the pairs and for the acts
    other = cut_lineage(placed.filter(~F.coalesce(F.col("geom_id") == F.col("outer_id"), F.lit(False))))
    pairs = other.filter("outer_id is not null").select(F.col("geom_id").alias("inner_id"), "outer_id")
    fine = covered_pairs(pairs, geom, tol)
    same = (F.col("geom_id") == F.col("inner_id")) & (other["outer_id"] == fine["outer_id"])
    return other.join(shuffled(fine), same, "left_anti").select(*act.columns, "owner_field_id")

"""Column expressions over rings: arrays of closed rings of points {x, y}, in degrees.

Area questions use the even-odd rule over all rings, so holes and several parts need no nesting.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STORED_DECIMALS, COMPARED_DECIMALS = 9, 7

_EDGES = (
    "flatten(transform({r}, g -> transform(slice(g, 2, greatest(size(g) - 1, 0)), "
    "(p, i) -> named_struct('a', g[i], 'b', p))))"
)


def edges(rings: str) -> Column:
    """All edges {a, b}; a ring of one point has none."""
    return F.expr(_EDGES.format(r=rings))


def border(rings: str) -> Column:
    """All edges {a, b}, and for every ring of one point an edge from that point to itself."""
    alone = f"transform(filter({rings}, g -> size(g) = 1), g -> named_struct('a', g[0], 'b', g[0]))"
    return F.expr(f"concat({_EDGES.format(r=rings)}, {alone})")


def marks(edge_list: str) -> Column:
    """The ends and middles of edges."""
    middle = "named_struct('x', (e.a.x + e.b.x) / 2, 'y', (e.a.y + e.b.y) / 2)"
    return F.expr(f"flatten(transform({edge_list}, e -> array(e.a, {middle})))")


def just_inside(area: str, gap: float) -> Column:
    """Points of an area at a distance of ``gap`` from the middle of each of its edges."""
    dx, dy = "(e.b.x - e.a.x)", "(e.b.y - e.a.y)"
    length = f"nullif(sqrt({dx} * {dx} + {dy} * {dy}), 0D)"
    side = (
        "named_struct('x', (e.a.x + e.b.x) / 2 {s} {g}D * " + dy + " / " + length
        + ", 'y', (e.a.y + e.b.y) / 2 {t} {g}D * " + dx + " / " + length + ")"
    )
    both = f"array({side.format(s='+', t='-', g=repr(gap))}, {side.format(s='-', t='+', g=repr(gap))})"
    return F.expr(
        f"filter(flatten(transform({area}, e -> {both})), q -> q.x is not null and ({_inside('q.x', 'q.y', area)}))"
    )


def vertices(rings: str) -> Column:
    return F.flatten(rings)


def heads(rings: str) -> Column:
    """One point of every ring; rings without points have none."""
    return F.expr(f"transform(filter({rings}, g -> size(g) > 0), g -> g[0])")


def bbox(rings: str) -> Column:
    """{x0, y0, x1, y1}."""
    return F.expr(
        f"named_struct('x0', array_min(transform(flatten({rings}), p -> p.x)), "
        f"'y0', array_min(transform(flatten({rings}), p -> p.y)), "
        f"'x1', array_max(transform(flatten({rings}), p -> p.x)), "
        f"'y1', array_max(transform(flatten({rings}), p -> p.y)))"
    )


def _inside(x: str, y: str, edge_list: str) -> str:
    return (
        f"size(filter({edge_list}, e -> (e.a.y > {y}) <> (e.b.y > {y}) and "
        f"{x} < (e.b.x - e.a.x) * ({y} - e.a.y) / (e.b.y - e.a.y) + e.a.x)) % 2 = 1"
    )


def _near_edge(x: str, y: str, edge_list: str, tol: str) -> str:
    """Within ``tol`` of an edge: squared distance to the nearest point of the segment."""
    dx, dy = "(e.b.x - e.a.x)", "(e.b.y - e.a.y)"
    length = f"({dx} * {dx} + {dy} * {dy})"
    along = (
        f"(case when {length} = 0 then 0D else least(1D, greatest(0D, "
        f"(({x} - e.a.x) * {dx} + ({y} - e.a.y) * {dy}) / {length})) end)"
    )
    gap_x, gap_y = f"({x} - e.a.x - {along} * {dx})", f"({y} - e.a.y - {along} * {dy})"
    return (
        f"exists({edge_list}, e -> {gap_x} * {gap_x} + {gap_y} * {gap_y} <= {tol} * {tol})"
    )


def _on_edge(x: str, y: str, edge_list: str) -> str:
    """Exactly on an edge."""
    return (
        f"exists({edge_list}, e -> (e.b.x - e.a.x) * ({y} - e.a.y) = (e.b.y - e.a.y) * ({x} - e.a.x) "
        f"and {x} between least(e.a.x, e.b.x) and greatest(e.a.x, e.b.x) "
        f"and {y} between least(e.a.y, e.b.y) and greatest(e.a.y, e.b.y))"
    )


def point_in_edges(x: str, y: str, edge_list: str) -> Column:
    """Point inside or on the border of the area bounded by ``edge_list``."""
    return F.expr(f"({_inside(x, y, edge_list)}) or {_on_edge(x, y, edge_list)}")


def some_point_in_edges(points: str, edge_list: str) -> Column:
    """Some point of an array inside or on the border of the area bounded by ``edge_list``."""
    return F.expr(
        f"exists({points}, q -> ({_inside('q.x', 'q.y', edge_list)}) or {_on_edge('q.x', 'q.y', edge_list)})"
    )


def points_covered(points: str, area: str, edge_list: str, tol: float) -> Column:
    """Every point of an array inside the area bounded by ``area`` or within ``tol`` of ``edge_list``."""
    return F.expr(
        f"forall({points}, q -> ({_inside('q.x', 'q.y', area)}) or "
        f"{_near_edge('q.x', 'q.y', edge_list, f'{tol!r}D')})"
    )


def some_point_within(points: str, area: str, tol: float) -> Column:
    """Some point of an array inside the area bounded by ``area``, farther than ``tol`` from its border."""
    return F.expr(
        f"exists({points}, q -> ({_inside('q.x', 'q.y', area)}) and "
        f"not {_near_edge('q.x', 'q.y', area, f'{tol!r}D')})"
    )


def edges_covered(inner: str, area: str, outer: str, tol: float) -> Column:
    """Every edge of ``inner`` inside the area bounded by ``area`` or within ``tol`` of ``outer``.

    An edge is cut where it meets outer edges; each piece lies on one side, so its middle decides.
    """
    nx, ny, dx, dy = "(n.b.x - n.a.x)", "(n.b.y - n.a.y)", "(d.b.x - d.a.x)", "(d.b.y - d.a.y)"
    den = f"nullif({nx} * {dy} - {ny} * {dx}, 0D)"
    gx, gy = "(d.a.x - n.a.x)", "(d.a.y - n.a.y)"
    at, on = f"(({gx} * {dy} - {gy} * {dx}) / {den})", f"(({gx} * {ny} - {gy} * {nx}) / {den})"
    cuts = (
        f"array_sort(concat(array(0D, 1D), transform(filter({outer}, d -> coalesce({at} between 0 and 1 "
        f"and {on} between 0 and 1, false)), d -> {at})))"
    )
    x, y = f"(n.a.x + m * {nx})", f"(n.a.y + m * {ny})"
    fine = f"({_inside(x, y, area)}) or {_near_edge(x, y, outer, f'{tol!r}D')}"
    middles = "transform(slice(ts, 2, size(ts) - 1), (t, i) -> (t + ts[i]) / 2)"
    return F.expr(f"forall({inner}, n -> forall(array({cuts}), ts -> forall({middles}, m -> {fine})))")


def edges_meet(left: str, right: str) -> Column:
    """Some edge of one list meets some edge of the other, touching included."""
    def side(p: str, a: str, b: str) -> str:
        return f"sign(({b}.x - {a}.x) * ({p}.y - {a}.y) - ({b}.y - {a}.y) * ({p}.x - {a}.x))"

    boxes = (
        "least(e.a.x, e.b.x) <= greatest(d.a.x, d.b.x) and least(d.a.x, d.b.x) <= "
        "greatest(e.a.x, e.b.x) and least(e.a.y, e.b.y) <= greatest(d.a.y, d.b.y) and "
        "least(d.a.y, d.b.y) <= greatest(e.a.y, e.b.y)"
    )
    apart = (
        f"{side('e.a', 'd.a', 'd.b')} * {side('e.b', 'd.a', 'd.b')} <= 0 and "
        f"{side('d.a', 'e.a', 'e.b')} * {side('d.b', 'e.a', 'e.b')} <= 0"
    )
    return F.expr(f"exists({left}, e -> exists({right}, d -> {boxes} and {apart}))")


def rounded(rings: str, decimals: int) -> Column:
    """Every coordinate rounded."""
    return F.expr(
        f"transform({rings}, g -> transform(g, p -> named_struct('x', round(p.x, {decimals}), "
        f"'y', round(p.y, {decimals}))))"
    )


def centroid(rings: str, kind: str) -> Column:
    """{x, y}: area centroid of polygons, length centroid of lines, mean of points.

    A ring counts with its area, taken away where it lies inside an odd number of other rings.
    Coordinates are taken from the first point, so that small fields far from (0, 0) keep digits.
    """
    ox, oy = f"{rings}[0][0].x", f"{rings}[0][0].y"

    def cross(a: str, b: str) -> str:
        return f"(({a}.x - {ox}) * ({b}.y - {oy}) - ({b}.x - {ox}) * ({a}.y - {oy}))"

    term = cross("g[i - 1]", "g[i]")
    other = "size(filter(e2, e -> (e.a.y > g[0].y) <> (e.b.y > g[0].y) and g[0].x < " \
            "(e.b.x - e.a.x) * (g[0].y - e.a.y) / (e.b.y - e.a.y) + e.a.x)) % 2"
    holed = (
        f"size(filter({rings}, (o, k) -> k <> j and ("
        + other.replace("e2", "transform(sequence(1, size(o) - 1), "
                              "n -> named_struct('a', o[n - 1], 'b', o[n]))")
        + ") = 1)) % 2 = 1"
    )
    sums = (
        "aggregate(sequence(1, size(g) - 1), named_struct('a', 0D, 'x', 0D, 'y', 0D), (s, i) -> "
        f"named_struct('a', s.a + {term}, "
        f"'x', s.x + {term} * (g[i - 1].x + g[i].x - 2 * {ox}), "
        f"'y', s.y + {term} * (g[i - 1].y + g[i].y - 2 * {oy})))"
    )
    per_ring = f"transform({rings}, (g, j) -> named_struct('s', {sums}, 'hole', {holed}))"
    total = (
        f"aggregate({per_ring}, named_struct('a', 0D, 'x', 0D, 'y', 0D), (t, r) -> named_struct("
        "'a', t.a + sign(r.s.a) * if(r.hole, -1, 1) * r.s.a, "
        "'x', t.x + sign(r.s.a) * if(r.hole, -1, 1) * r.s.x, "
        "'y', t.y + sign(r.s.a) * if(r.hole, -1, 1) * r.s.y), "
        f"t -> named_struct('x', {ox} + t.x / (3 * t.a), 'y', {oy} + t.y / (3 * t.a)))"
    )
    line = (
        f"aggregate({_EDGES.format(r=rings)}, named_struct('l', 0D, 'x', 0D, 'y', 0D), (s, e) -> "
        "named_struct('l', s.l + sqrt(pow(e.b.x - e.a.x, 2) + pow(e.b.y - e.a.y, 2)), "
        "'x', s.x + sqrt(pow(e.b.x - e.a.x, 2) + pow(e.b.y - e.a.y, 2)) * (e.a.x + e.b.x) / 2, "
        "'y', s.y + sqrt(pow(e.b.x - e.a.x, 2) + pow(e.b.y - e.a.y, 2)) * (e.a.y + e.b.y) / 2), "
        "s -> named_struct('x', s.x / s.l, 'y', s.y / s.l))"
    )
    points = (
        f"aggregate(flatten({rings}), named_struct('x', 0D, 'y', 0D), "
        "(s, p) -> named_struct('x', s.x + p.x, 'y', s.y + p.y), "
        f"s -> named_struct('x', s.x / size(flatten({rings})), 'y', s.y / size(flatten({rings}))))"
    )
    return F.expr(
        f"case when {kind} like '%POLYGON' then {total} "
        f"when {kind} like '%LINESTRING' then {line} else {points} end"
    )


def canonical(rings: str, kind: str, decimals: int = COMPARED_DECIMALS) -> Column:
    """A hash equal for equal shapes: where a ring starts, its direction, points in the middle of
    straight edges and digits past ``decimals`` make no difference.
    """
    scale = f"{10.0 ** decimals!r}D"
    snapped = (
        f"transform({rings}, g -> transform(g, p -> named_struct("
        f"'x', cast(round(p.x * {scale}) as bigint), 'y', cast(round(p.y * {scale}) as bigint))))"
    )
    # rings without their closing point, without repeats of the point before
    opened = (
        f"transform({snapped}, g -> filter(slice(g, 1, size(g) - 1), "
        "(p, i) -> i = 0 or p <> g[i - 1]))"
    )

    def wide(a: str, b: str) -> str:
        return f"cast({a} - {b} as decimal(19,0))"

    before, after = "g[(i + size(g) - 1) % size(g)]", "g[(i + 1) % size(g)]"
    bend = (
        f"{wide('p.x', before + '.x')} * {wide(after + '.y', 'p.y')} <> "
        f"{wide('p.y', before + '.y')} * {wide(after + '.x', 'p.x')}"
    )
    corners = f"transform({opened}, g -> filter(g, (p, i) -> {bend}))"
    area = (
        "aggregate(sequence(0, size(g) - 1), cast(0 as decimal(38,0)), (s, i) -> cast(s + "
        f"cast(g[i].x as decimal(19,0)) * cast({after}.y as decimal(19,0)) - "
        f"cast({after}.x as decimal(19,0)) * cast(g[i].y as decimal(19,0)) as decimal(38,0)))"
    )
    turned = f"transform({corners}, g -> if(size(g) > 0 and {area} < 0, reverse(g), g))"
    start = "cast(array_position(g, array_min(g)) as int)"
    rotated = (
        f"array_sort(transform({turned}, g -> if(size(g) = 0, g, "
        f"concat(slice(g, {start}, size(g)), slice(g, 1, {start} - 1)))))"
    )
    lines = f"array_sort(transform({snapped}, g -> least(g, reverse(g))))"
    shape = f"case when {kind} like '%POLYGON' then {rotated} else {lines} end"
    return F.sha2(F.concat_ws("|", F.expr(kind), F.to_json(F.expr(shape))), 256)

"""Independent SQL for the registered queries, over the same input tables (DuckDB dialect)."""

from __future__ import annotations

import math

from croplake.fixtures import NOW, NUTRIENT_DIVISORS, SQUARE
from croplake.catalog import DAILY_WEATHER_TYPES, NUTRIENTS

_SHARES = ", ".join(
    f"{'0.0' if d == 0 else f'p_size::double / {float(d)}'} AS {n}"
    for n, d in zip(NUTRIENTS, NUTRIENT_DIVISORS)
)
_SEG = ("CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 1 WHEN 'BUILDING' THEN 2 WHEN 'FURNITURE' THEN 3 "
        "WHEN 'HOUSEHOLD' THEN 4 WHEN 'MACHINERY' THEN 5 END")
_EV = ("CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3 "
       "WHEN 'signup' THEN 4 WHEN 'view' THEN 5 END::bigint")
_UNIT = "(regexp_extract(props, '([0-9]+)', 1)::bigint % 3)"
_NOW = f"TIMESTAMP '{NOW}'"
#: last date of the forecast for NOW: today (12:00 is past) plus 7 days
_LAST = "DATE '2024-02-06'"

#: pairs of shapes: cells that are the same or touch, a point at a corner of a cell, or the same point
_SHAPE_PAIRS = (
    "SELECT DISTINCT a.geom_id, b.geom_id AS {out} FROM (SELECT geom_id, x + unnest([-1, 0, 1]) AS x, y FROM {a}) a "
    "JOIN {b} b ON a.x = b.x AND b.y BETWEEN a.y - 1 AND a.y + 1 "
    "UNION SELECT p.geom_id, c.geom_id FROM {pa} p JOIN {b} c ON c.x IN (p.x - 1, p.x) AND c.y IN (p.y - 1, p.y) "
    "UNION SELECT c.geom_id, p.geom_id FROM {pb} p JOIN {a} c ON c.x IN (p.x - 1, p.x) AND c.y IN (p.y - 1, p.y) "
    "UNION SELECT p.geom_id, q.geom_id FROM {pa} p JOIN {pb} q ON p.x = q.x AND p.y = q.y"
)

#: model tables as common table expressions; a table may use those above it
CTES: dict[str, str] = {
    "organization": "SELECT r_regionkey::bigint AS organization_id, r_name AS name FROM region",
    "cust": "SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey",
    "grouper": f"""
        SELECT r_regionkey::bigint AS grouper_id, r_name AS name,
               r_regionkey::bigint AS organization_id, NULL::bigint AS parent_grouper_id FROM region
        UNION ALL
        SELECT 100 + n_nationkey, n_name, n_regionkey, n_regionkey FROM nation
        UNION ALL
        SELECT DISTINCT 1000 + n_nationkey * 10 + {_SEG}, c_mktsegment, n_regionkey,
               100 + n_nationkey FROM cust""",
    "field": f"""
        SELECT c_custkey AS field_id, c_name AS name, TIMESTAMP '1995-01-01' AS date_start,
               TIMESTAMP '2000-12-31' AS date_end, c_custkey AS geom_id,
               n_regionkey::bigint AS organization_id,
               (1000 + n_nationkey * 10 + {_SEG})::bigint AS grouper_id FROM cust""",
    "field_trial": """
        SELECT o_orderkey AS field_trial_id, 'T' || o_orderkey AS name, o_custkey AS field_id,
               o_orderdate AS date_start, o_orderdate + INTERVAL 180 DAY AS date_end FROM orders""",
    "plot": """
        SELECT DISTINCT l_orderkey * 10 + l_linenumber AS plot_id, 'P' || l_linenumber AS name,
               o_custkey AS field_id, l_orderkey AS field_trial_id, l_linenumber % 4 AS treatment_id,
               l_linenumber % 2 AS block_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "points": """
        SELECT c_custkey AS point_id, -96.0::double + 6.0::double * ((c_custkey * 37) % 1500) / 1500.0::double AS lon,
               40.0::double + 8.0::double * ((c_custkey * 91) % 1500) / 1500.0::double AS lat FROM customer""",
    # the shapes as sets of cells of a lattice; points as corners
    "shape_grid": """
        SELECT shape, cx, cy FROM (SELECT unnest(range(9)) AS shape), (SELECT unnest(range(4)) AS cx), (SELECT unnest(range(4)) AS cy)
        WHERE CASE shape WHEN 0 THEN true WHEN 1 THEN cx = 0 OR cy = 0 WHEN 2 THEN cy = 0 OR cx IN (0, 3) WHEN 3 THEN cx <> 1
            WHEN 4 THEN NOT (cx IN (1, 2) AND cy IN (1, 2)) WHEN 6 THEN cx IN (1, 2) AND cy IN (1, 2) WHEN 7 THEN cx + cy = 0
            WHEN 8 THEN cx IN (1, 2) ELSE false END""",
    "shape_cells": """
        SELECT c_custkey AS geom_id, 3 * (c_custkey % 900) + cx AS x, 3 * (c_custkey // 900) + cy AS y
        FROM customer JOIN shape_grid ON shape = c_custkey % 6""",
    "supplier_cells": """
        SELECT s_suppkey AS geom_id, 3 * (s_suppkey % 900) + cx AS x, 3 * (s_suppkey // 900) + cy AS y
        FROM supplier JOIN shape_grid ON shape = (s_suppkey + 2) % 6""",
    "shape_points": "SELECT c_custkey AS geom_id, 3 * (c_custkey % 900) + 2 AS x, 3 * (c_custkey // 900) + 2 AS y FROM customer WHERE c_custkey % 6 = 5",
    "supplier_points": "SELECT s_suppkey AS geom_id, 3 * (s_suppkey % 900) + 2 AS x, 3 * (s_suppkey // 900) + 2 AS y FROM supplier WHERE (s_suppkey + 2) % 6 = 5",
    "half_points": """
        SELECT c_custkey AS point_id, 3 * (c_custkey % 900) + (c_custkey * 7 % 9) / 2.0::double AS px,
               3 * (c_custkey // 900) + (c_custkey * 5 % 9) / 2.0::double AS py FROM customer""",
    "crop_type": """
        SELECT DISTINCT substr(o_orderpriority, 1, 1)::bigint AS crop_type_id,
               upper(substr(o_orderpriority, 3)) AS crop FROM orders""",
    "act": """
        SELECT o_orderkey * 2 + (s.act_type = 'HARVEST')::int AS act_id, s.act_type,
               CASE WHEN s.act_type = 'PLANT' THEN o_orderdate
                    ELSE o_orderdate + INTERVAL 120 DAY END AS date_performed,
               CASE WHEN o_orderkey % 83 <> 0 THEN substr(o_orderpriority, 1, 1)::bigint END AS crop_type_id,
               CASE WHEN o_orderkey % 3 = 0 THEN o_custkey END AS field_id,
               CASE WHEN o_orderkey % 3 = 1 THEN o_orderkey END AS field_trial_id,
               CASE WHEN o_orderkey % 3 = 2 THEN o_orderkey * 10 + 1 END AS plot_id
        FROM orders JOIN (VALUES ('PLANT'), ('HARVEST')) s(act_type)
          ON s.act_type = 'PLANT' OR o_orderstatus IN ('O', 'F')
        WHERE o_orderkey % 3 <> 2
           OR EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber = 1)""",
    "nutrient_source": f"""
        SELECT p_partkey * 10 + r_regionkey AS nutrient_source_id, p_name || '-' || p_partkey AS nutrient,
               r_regionkey::bigint AS organization_id, {_SHARES} FROM part, region""",
    "app": """
        SELECT ('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)), 1, 15))::bigint AS app_id,
               'FERTILIZER' AS app_type, l_shipdate AS date_applied, l_quantity AS rate,
               l_partkey * 10 + n_regionkey AS nutrient_source_id,
               CASE WHEN l_linenumber % 3 = 2 THEN o_custkey END AS field_id,
               CASE WHEN l_linenumber % 3 = 1 THEN l_orderkey END AS field_trial_id,
               CASE WHEN l_linenumber % 3 = 0 THEN l_orderkey * 10 + l_linenumber END AS plot_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN cust ON o_custkey = c_custkey""",
    "owned_act": """
        SELECT a.*, coalesce(a.field_id, t.field_id, t2.field_id) AS owner_field_id
        FROM act a LEFT JOIN field_trial t ON a.field_trial_id = t.field_trial_id
        LEFT JOIN plot p ON a.plot_id = p.plot_id
        LEFT JOIN field_trial t2 ON p.field_trial_id = t2.field_trial_id""",
    "s3": """
        SELECT s_suppkey AS s3_id, 's3://files/' || s_name || '.' || e AS s3_url,
               CASE WHEN s_suppkey % 7 = 0 THEN 'CSV' ELSE upper(e) END AS file_format, e AS ending,
               CASE WHEN s_suppkey % 11 = 0 THEN 'OTHER' WHEN s_suppkey % 2 = 0 THEN 'SOIL' END AS category
        FROM (SELECT *, CASE s_suppkey % 5 WHEN 0 THEN 'csv' WHEN 1 THEN 'json' WHEN 2 THEN 'tif'
                        WHEN 3 THEN 'geojson' ELSE 'parquet' END AS e FROM supplier)""",
    "observation_type": f"""
        SELECT DISTINCT {_EV} AS observation_type_id, upper(event_type) AS observation_type_name,
               CASE WHEN event_type <> 'view' THEN 'SENSOR' END AS category FROM events""",
    "unit_type": f"""
        SELECT DISTINCT {_EV} * 10 + {_UNIT} AS unit_type_id, 'U' || {_UNIT} AS unit_name,
               {_EV} AS observation_type_id FROM events""",
    "observation": f"""
        SELECT event_id AS observation_id, user_id AS field_id, {_EV} * 10 + {_UNIT} AS unit_type_id,
               {_EV} AS observation_type_id, floor(value / 10) * 10 AS value_observed, ts AS date_observed,
               user_id AS geom_id,
               CASE WHEN event_id % 4 <> 0 THEN event_id % 4 END AS observation_grouper_id FROM events""",
    "feature_base": """
        SELECT o.*, u.unit_name, t.observation_type_name
        FROM observation o JOIN field USING (field_id) JOIN unit_type u USING (unit_type_id)
        JOIN observation_type t ON t.observation_type_id = u.observation_type_id
        WHERE date_observed > TIMESTAMP '2000-01-01'""",
    "feature_time": """
        SELECT observation_type_id, unit_type_id, date_observed,
               row_number() OVER (PARTITION BY observation_type_id, unit_type_id ORDER BY date_observed) AS time_id
        FROM (SELECT DISTINCT observation_type_id, unit_type_id, date_observed FROM feature_base)""",
    "feature_kept": """
        SELECT * FROM (
          SELECT *, lag(date_observed) OVER (PARTITION BY field_id, observation_type_id, unit_type_id,
                                             value_observed ORDER BY date_observed) AS prev
          FROM (SELECT * FROM feature_base QUALIFY row_number() OVER (
                  PARTITION BY field_id, observation_type_id, unit_type_id, value_observed, date_observed
                  ORDER BY observation_id) = 1))
        WHERE prev IS NULL OR date_observed - prev > INTERVAL 18 HOUR""",
    "daily": f"""
        SELECT event_id AS daily_id, user_id % 40 % 4 AS world_utm_id, user_id % 40 AS cell_id,
               (ts::date - (event_id % 5)::int)::date AS date, {_EV} AS weather_type_id, event_type || '_24h' AS parameter,
               value::real AS value, ts AS date_requested FROM events""",
    "utm": """
        SELECT DISTINCT world_utm_id, world_utm_id + 14 AS utm_zone,
               world_utm_id * 10800 - 21600 AS utc_offset_seconds FROM daily""",
    "last_req": """
        SELECT world_utm_id, cell_id, min(m) AS date_last_requested FROM (
          SELECT world_utm_id, cell_id, weather_type_id, max(date_requested) AS m FROM daily GROUP BY ALL)
        GROUP BY ALL""",
    "need": f"""
        SELECT DISTINCT c % 4 + 14 AS utm_zone, c % 4 * 10800 - 21600 AS utc_offset_seconds,
               c % 4 AS world_utm_id, c AS cell_id, make_date(2019 + c % 7, 1, 1) AS date_first,
               {_LAST} AS date_last
        FROM (SELECT c_custkey % 60 AS c FROM customer) WHERE c % 4 <> 3 OR c >= 40""",
    "need_daily": f"""
        SELECT utm_zone, utc_offset_seconds, world_utm_id, cell_id,
               make_date(year(min(date)), 1, 1) AS date_first, {_LAST} AS date_last
        FROM daily JOIN utm USING (world_utm_id) GROUP BY ALL""",
    "need_all": """
        SELECT * FROM (SELECT * FROM need UNION ALL SELECT * FROM need_daily)
        QUALIFY row_number() OVER (PARTITION BY cell_id ORDER BY date_first DESC) = 1""",
    "update_need": f"""
        SELECT utm_zone, utc_offset_seconds, world_utm_id, cell_id,
               (date_last_requested + to_seconds(utc_offset_seconds) - INTERVAL 1 DAY)::date AS date_first,
               {_LAST} AS date_last
        FROM last_req JOIN utm USING (world_utm_id)
        WHERE date_last_requested::date < {_NOW}::date""",
    "add_need": """
        SELECT utm_zone, utc_offset_seconds, world_utm_id, cell_id, date_first,
               coalesce(make_date(fy - 1, 12, 31), date_last) AS date_last
        FROM need LEFT JOIN (SELECT cell_id, year(min(date)) AS fy FROM daily GROUP BY cell_id) USING (cell_id)
        WHERE fy IS NULL OR date_first < make_date(fy, 1, 1)""",
    "newest": """
        SELECT * FROM daily QUALIFY row_number() OVER (
          PARTITION BY cell_id, weather_type_id, date ORDER BY date_requested DESC, daily_id DESC) = 1""",
    "gaps": f"""
        SELECT n.utm_zone, n.utc_offset_seconds, n.world_utm_id, n.cell_id, d.date::date AS date, p.parameter
        FROM (SELECT *, unnest(generate_series(date_first::timestamp, {_LAST}::timestamp, INTERVAL 1 DAY)) AS date FROM need_all) d
        JOIN need_all n ON n.cell_id = d.cell_id
        JOIN (SELECT DISTINCT weather_type_id, parameter FROM daily) p ON true
        WHERE NOT EXISTS (
          SELECT 1 FROM newest w JOIN utm u ON u.world_utm_id = w.world_utm_id
          WHERE w.cell_id = n.cell_id AND w.date = d.date::date AND w.weather_type_id = p.weather_type_id
            AND ((w.date_requested + to_seconds(n.utc_offset_seconds) - INTERVAL 1 DAY)::date > w.date
                 OR w.date > ({_NOW} + to_seconds(n.utc_offset_seconds) - INTERVAL 1 DAY)::date - 1))""",
    "request": """
        SELECT o_orderkey AS request_id, (o_custkey % 60 + 1)::int AS zone, o_orderkey % 4 + 1 AS n_coords,
               o_orderkey % 3 + 1 AS n_params, o_orderdate AS startdate,
               o_orderdate + to_days((o_orderkey % 30)::int) AS enddate,
               CASE WHEN o_orderstatus = 'P' THEN 'FAIL' ELSE 'SUCCESS' END AS status,
               CASE WHEN o_orderstatus <> 'P' THEN 0 WHEN o_orderkey % 4 = 0 THEN -404
                    WHEN o_orderkey % 4 = 1 THEN -429 WHEN o_orderkey % 4 = 2 THEN -500 ELSE -408 END AS code,
               o_orderdate AS date_requested
        FROM orders""",
    "execution": "SELECT o_orderkey AS execution_id, o_custkey % 7 AS function_id FROM orders",
    "s3_in": """
        SELECT function_id, execution_id, l_partkey % 3 AS s3_type_id, l_partkey % 20 AS s3_object_id
        FROM lineitem JOIN execution ON l_orderkey = execution_id""",
    "s3_out": """
        SELECT function_id, execution_id, l_suppkey AS s3_object_id
        FROM lineitem JOIN execution ON l_orderkey = execution_id WHERE l_returnflag = 'R'""",
    "s3_out_typed": """
        SELECT execution_id, l_suppkey % 3 AS s3_type_id, l_suppkey AS s3_object_id
        FROM lineitem JOIN execution ON l_orderkey = execution_id WHERE l_returnflag = 'R'""",
}


def sql(body: str) -> str:
    """``body`` with the common tables it uses, directly or through others, put before it."""
    import re

    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
                needed.add(name)
                visit(CTES[name])

    visit(body)
    with_parts = [f"{n} AS ({CTES[n]})" for n in CTES if n in needed]
    if not with_parts:
        return body
    lead = f"WITH {', '.join(with_parts)}"
    return f"{lead}, {body[5:]}" if body.startswith("WITH ") else f"{lead} {body}"


_IDS = "field_id, field_trial_id, plot_id"


def _app_rows() -> str:
    rates = ", ".join(f"a.rate * (n.{n} / 100) AS rate_{n}" for n in NUTRIENTS)
    parts = " UNION ALL ".join(
        f"SELECT pd.organization_id, pd.plot_id, a.app_id, a.nutrient_source_id, a.rate AS rate_product, {rates} "
        f"FROM pd JOIN app a ON a.{k} = pd.{k} JOIN nutrient_source n "
        "ON n.nutrient_source_id = a.nutrient_source_id AND n.organization_id = pd.organization_id"
        for k in ("field_id", "field_trial_id", "plot_id")
    )
    return parts


_PD = ("(SELECT f.organization_id, f.field_id, t.field_trial_id, p.plot_id FROM plot p "
       "JOIN field_trial t ON p.field_trial_id = t.field_trial_id JOIN field f ON f.field_id = t.field_id)")


def _totals() -> str:
    rates = ", ".join(f"round(sum(rate_{n}), 6) AS rate_{n}" for n in NUTRIENTS)
    return (
        f"SELECT organization_id, plot_id, nutrient_source_id, count(*) AS n_apps, "
        f"round(sum(rate_product), 6) AS rate_product, {rates} FROM ({_app_rows().replace('FROM pd ', f'FROM {_PD} pd ')}) "
        "GROUP BY ALL"
    )


def _season() -> str:
    base = ("SELECT f.organization_id, p.field_id, p.field_trial_id, p.plot_id, p.date_performed AS date_plant, "
            "h.date_performed AS date_harvest, date_diff('day', p.date_performed, h.date_performed)::int AS season_days "
            "FROM act p JOIN act h ON p.act_type = 'PLANT' AND h.act_type = 'HARVEST' AND p.{k} = h.{k} {more} ")
    owner = {
        "field_id": "JOIN field f ON f.field_id = p.field_id",
        "field_trial_id": "JOIN field_trial t ON t.field_trial_id = p.field_trial_id JOIN field f ON f.field_id = t.field_id",
        "plot_id": "JOIN plot q ON q.plot_id = p.plot_id JOIN field_trial t ON t.field_trial_id = q.field_trial_id "
                   "JOIN field f ON f.field_id = t.field_id",
    }
    return " UNION ALL ".join(base.format(k=k, more=m) for k, m in owner.items())


# ---- grid arithmetic, written out again for the oracle -----------------------------------------
_F = 1 / 298.257223563
_E = math.sqrt(_F * (2 - _F))
_T = _F / (2 - _F)
_A = 6378137.0 / (1 + _T) * (1 + _T**2 / 4 + _T**4 / 64) * 0.9996
_AL = [_T / 2 - 2 * _T**2 / 3 + 5 * _T**3 / 16 + 41 * _T**4 / 180,
       13 * _T**2 / 48 - 3 * _T**3 / 5 + 557 * _T**4 / 1440,
       61 * _T**3 / 240 - 103 * _T**4 / 140, 49561 * _T**4 / 161280]
_BE = [_T / 2 - 2 * _T**2 / 3 + 37 * _T**3 / 96 - _T**4 / 360, _T**2 / 48 + _T**3 / 15 - 437 * _T**4 / 1440,
       17 * _T**3 / 480 - 37 * _T**4 / 840, 4397 * _T**4 / 161280]
_DE = [2 * _T - 2 * _T**2 / 3 - 2 * _T**3 + 116 * _T**4 / 45, 7 * _T**2 / 3 - 8 * _T**3 / 5 - 227 * _T**4 / 45,
       56 * _T**3 / 15 - 136 * _T**4 / 35, 4279 * _T**4 / 630]


def _fwd_t(lat: str) -> str:
    return f"sinh(atanh(sin(radians({lat}))) - {_E!r}::double * atanh({_E!r}::double * sin(radians({lat}))))"


def _plus(op: str, coef: list[float], trig1: str, trig2: str, u: str, v: str) -> str:
    return " ".join(
        f"{op} ({c!r}::double * {trig1}({2 * j} * {u}) * {trig2}({2 * j} * {v}))" for j, c in enumerate(coef, 1)
    )


def _lat_of(chi: str) -> str:
    return f"degrees({chi} {' '.join(f'+ {d!r}::double * sin({2 * j} * {chi})' for j, d in enumerate(_DE, 1))})"


def _cells_sql() -> str:
    """Cells of the points' polygons (north, regular zones), found by trying every cell.

    A cell is touched when one of its corners, or the point of its lower or upper side nearest the
    central meridian, lies in the polygon, or a corner or lowest point of the polygon in the cell.
    """
    return f"""
      WITH p AS (SELECT DISTINCT least(greatest(ceil((lon + 180) / 6), 1), 60)::int AS zone,
                 least(greatest(ceil((lat + 80) / 8), 1), 20)::int AS band FROM ({CTES['points']})),
      g AS (SELECT zone, band, zone * 6 - 183 AS cm, (-88 + 8 * band)::double AS lat0, (-80 + 8 * band)::double AS lat1 FROM p),
      k AS (SELECT g.*, k.id, radians(k.l::double) AS dl, CASE WHEN k.far THEN {_fwd_t('lat1')} ELSE {_fwd_t('lat0')} END AS t
            FROM g, (VALUES (1, -3, false), (2, 3, false), (3, 0, false), (4, -3, true), (5, 3, true)) k(id, l, far)),
      x AS (SELECT *, atan2(t, cos(dl)) AS xi, atanh(sin(dl) / sqrt(1 + t * t)) AS eta FROM k),
      c AS (SELECT zone, band, cm, lat0, lat1, id, 500000 + {_A!r}::double * (eta {_plus('+', _AL, 'cos', 'sinh', 'xi', 'eta')}) AS e,
                   {_A!r}::double * (xi {_plus('+', _AL, 'sin', 'cosh', 'xi', 'eta')}) AS n FROM x),
      o AS (SELECT zone, band, cm, lat0, lat1, max(e) FILTER (id = 1) AS e0, max(n) FILTER (id = 3) AS n0 FROM c GROUP BY ALL),
      cell AS (SELECT o.*, col, rw, e0 + col * 5000 AS x0, n0 + rw * 5000 AS y0 FROM o,
               (SELECT unnest(generate_series(0, 140)) AS col) a, (SELECT unnest(generate_series(0, 190)) AS rw) b),
      s AS (SELECT cell.*, j, CASE j % 3 WHEN 0 THEN x0 WHEN 1 THEN x0 + 5000 ELSE least(greatest(500000, x0), x0 + 5000) END AS sx,
                   y0 + CASE WHEN j >= 3 AND j < 6 THEN 5000 ELSE 0 END + CASE WHEN j = 6 THEN 2500 ELSE 0 END AS sy0 FROM cell, (SELECT unnest(generate_series(0, 6)) AS j) q),
      q AS (SELECT *, (sy0) / {_A!r}::double AS u, (CASE WHEN j = 6 THEN x0 + 2500 ELSE sx END - 500000) / {_A!r}::double AS v FROM s),
      r AS (SELECT *, u {_plus('-', _BE, 'sin', 'cosh', 'u', 'v')} AS up, v {_plus('-', _BE, 'cos', 'sinh', 'u', 'v')} AS vp FROM q),
      w AS (SELECT *, asin(sin(up) / cosh(vp)) AS chi, degrees(atan2(sinh(vp), cos(up))) AS dlon FROM r),
      l AS (SELECT *, {_lat_of('chi')} AS lat FROM w),
      t AS (SELECT zone, band, col, rw, bool_or(j < 6 AND dlon BETWEEN -3 AND 3 AND lat BETWEEN lat0 AND lat1) AS hit,
                   max(dlon + cm) FILTER (j = 6) AS lng, max(lat) FILTER (j = 6) AS lat FROM l GROUP BY ALL)
      SELECT t.zone, substr('CDEFGHJKLMNPQRSTUVWX', t.band, 1) AS row, (col + 1)::int AS rast_col, (rw + 1)::int AS rast_row,
             round(lng, 5) AS lng_centroid, round(lat, 5) AS lat_centroid
      FROM t JOIN o ON o.zone = t.zone AND o.band = t.band
      WHERE hit OR EXISTS (SELECT 1 FROM c WHERE c.zone = t.zone AND c.band = t.band
                           AND floor((c.e - o.e0) / 5000) = t.col AND floor((c.n - o.n0) / 5000) = t.rw)"""


def _grid_sql(dx: float = 0.0, select: str | None = None) -> str:
    """Cell position and centre of the customer points, all north of the equator in regular zones."""
    a, al, be, de = _A, _AL, _BE, _DE
    fwd_t, plus = _fwd_t, _plus
    # origin: westmost easting and central-meridian northing of the parallel 40 N
    return f"""
      WITH p AS (SELECT point_id, lon + {dx!r}::double AS lon, lat + {dx!r}::double AS lat FROM ({CTES['points']})),
      z AS (SELECT *, least(greatest(ceil((lon + 180) / 6), 1), 60)::int AS zone,
                   least(greatest(ceil((lat + 80) / 8), 1), 20)::int AS band FROM p),
      g AS (SELECT *, zone * 6 - 183 AS cm, (-88 + 8 * band)::double AS lat0 FROM z),
      s AS (SELECT *, {fwd_t('lat')} AS t, radians(lon - cm) AS dl, {fwd_t('lat0')} AS t0, radians(-3.0::double) AS dl0 FROM g),
      x AS (SELECT *, atan2(t, cos(dl)) AS xi, atanh(sin(dl) / sqrt(1 + t * t)) AS eta,
                   atan2(t0, cos(dl0)) AS xi0, atanh(sin(dl0) / sqrt(1 + t0 * t0)) AS eta0, atan(t0) AS xim FROM s),
      en AS (SELECT *, 500000 + {a!r}::double * (eta {plus('+', al, 'cos', 'sinh', 'xi', 'eta')}) AS e,
                    {a!r}::double * (xi {plus('+', al, 'sin', 'cosh', 'xi', 'eta')}) AS n,
                    500000 + {a!r}::double * (eta0 {plus('+', al, 'cos', 'sinh', 'xi0', 'eta0')}) AS e0,
                    {a!r}::double * (xim {plus('+', al, 'sin', 'cosh', 'xim', '0')}) AS n0 FROM x),
      c AS (SELECT *, floor((e - e0) / 5000)::int AS col, floor((n - n0) / 5000)::int AS rw FROM en),
      q AS (SELECT *, (n0 + (rw + 0.5) * 5000) / {a!r}::double AS u, (e0 + (col + 0.5) * 5000 - 500000) / {a!r}::double AS v FROM c),
      r AS (SELECT *, u {plus('-', be, 'sin', 'cosh', 'u', 'v')} AS up, v {plus('-', be, 'cos', 'sinh', 'u', 'v')} AS vp FROM q),
      o AS (SELECT *, asin(sin(up) / cosh(vp)) AS chi, degrees(atan2(sinh(vp), cos(up))) + cm AS lng FROM r),
      out AS (SELECT point_id, zone AS utm_zone, col + 1 AS rast_col, rw + 1 AS rast_row,
             round(lng, 5) AS lng_centroid,
             round(degrees(chi {" ".join(f"+ {d!r}::double * sin({2 * j} * chi)" for j, d in enumerate(de, 1))}), 5) AS lat_centroid
      FROM o)
      {select or 'SELECT * FROM out'}"""


def oracle_sql() -> dict[str, str]:
    s = SQUARE
    out = {
        # ---- views
        "plot_details": sql(
            "SELECT f.organization_id, f.field_id, t.field_trial_id, p.plot_id, p.name AS name_plot, "
            "p.treatment_id::int AS treatment_id, p.block_id::int AS block_id, t.date_start AS date_start_field_trial, "
            "t.date_end AS date_end_field_trial, round(x.lon, 6) AS lon FROM plot p JOIN field_trial t ON p.field_trial_id = t.field_trial_id "
            "JOIN field f ON f.field_id = t.field_id JOIN points x ON x.point_id = f.geom_id"),
        "plot_details_geometry": sql(
            "SELECT o.name AS organization, f.name AS field, t.name AS field_trial, p.name AS plot, "
            "f.organization_id, f.field_id, t.field_trial_id, p.plot_id FROM plot p "
            "JOIN field_trial t ON p.field_trial_id = t.field_trial_id JOIN field f ON f.field_id = t.field_id "
            "JOIN organization o ON o.organization_id = f.organization_id"),
        "plot_application_summary": sql(
            "SELECT plot_id, app_id, nutrient_source_id, rate_product, rate_n, rate_k2o FROM ("
            + _app_rows().replace("FROM pd ", f"FROM {_PD} pd ") + ")"),
        "plot_nutrient_totals": sql(_totals()),
        "season_length": sql(_season()),
        "owner_field": sql(f"SELECT act_id, owner_field_id FROM owned_act"),
        # ---- checks
        "acts_outside_field_window": sql(
            "SELECT a.act_id, a.owner_field_id, a.date_performed FROM owned_act a JOIN field f ON f.field_id = a.owner_field_id "
            "WHERE a.date_performed < f.date_start OR a.date_performed > f.date_end"),
        "apps_outside_field_window": sql(
            "SELECT a.app_id, coalesce(a.field_id, t.field_id, t2.field_id) AS owner_field_id FROM app a "
            "LEFT JOIN field_trial t ON a.field_trial_id = t.field_trial_id LEFT JOIN plot p ON a.plot_id = p.plot_id "
            "LEFT JOIN field_trial t2 ON p.field_trial_id = t2.field_trial_id "
            "JOIN field f ON f.field_id = coalesce(a.field_id, t.field_id, t2.field_id) "
            "WHERE a.date_applied < f.date_start OR a.date_applied > f.date_end"),
        "unique_null_safe_violations": sql(
            "SELECT name, organization_id, parent_grouper_id, count(*) AS n_rows FROM "
            "(SELECT * FROM grouper UNION ALL SELECT * FROM grouper WHERE grouper_id % 3 = 0) GROUP BY ALL HAVING count(*) > 1"),
        "orphan_rows": sql(
            "SELECT field_trial_id, fk AS field_id FROM (SELECT field_trial_id, "
            "CASE WHEN field_trial_id % 97 = 0 THEN field_id + 100000000 ELSE field_id END AS fk FROM field_trial) x "
            "WHERE NOT EXISTS (SELECT 1 FROM field f WHERE f.field_id = x.fk)"),
        "exactly_one_parent": sql(
            "SELECT app_id, (field_id IS NOT NULL)::int + (field_trial_id IS NOT NULL)::int + (plot_id IS NOT NULL)::int AS n_parents "
            "FROM (SELECT app_id, CASE WHEN app_id % 89 <> 0 THEN field_id END AS field_id, "
            "CASE WHEN app_id % 89 <> 0 THEN field_trial_id END AS field_trial_id, "
            "CASE WHEN app_id % 89 <> 0 THEN CASE WHEN app_id % 53 = 0 THEN 1 ELSE plot_id END END AS plot_id FROM app) "
            "WHERE (field_id IS NOT NULL)::int + (field_trial_id IS NOT NULL)::int + (plot_id IS NOT NULL)::int <> 1"),
        "enum_domain_violations": sql(
            "SELECT s3_id, file_format, category FROM s3 WHERE category = 'OTHER'"),
        "uppercase_violations": sql(
            "SELECT p_partkey AS crop_type_id FROM part WHERE p_name <> upper(p_name) OR p_type <> upper(p_type)"),
        "nutrient_range_violations": (
            "SELECT p_partkey * 10 + r_regionkey AS nutrient_source_id, p_size::double * 3 AS n FROM part, region WHERE p_size = 50"),
        "crop_type_missing": sql("SELECT act_id FROM act WHERE crop_type_id IS NULL"),
        "file_format_mismatch": sql("SELECT s3_id FROM s3 WHERE lower(file_format) <> ending"),
        "unit_of_other_type": sql(
            "SELECT observation_id FROM observation o WHERE NOT EXISTS (SELECT 1 FROM unit_type u "
            "WHERE u.unit_type_id = CASE WHEN o.observation_id % 41 = 0 THEN o.unit_type_id + 10 ELSE o.unit_type_id END "
            "AND u.observation_type_id = o.observation_type_id)"),
        "observation_without_time": sql(
            "SELECT observation_id FROM observation WHERE observation_id % 6 = 0"),
        # ---- keyed
        "natural_key_lookup": (
            "SELECT s_suppkey AS candidate, (SELECT min(c_custkey) FROM customer WHERE c_nationkey = s_nationkey AND c_mktsegment = "
            "['AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD','MACHINERY','NONE'][(s_suppkey % 6 + 1)::int]) AS found_id FROM supplier"),
        "rows_by_key": (
            "SELECT c_custkey FROM customer WHERE (c_nationkey, c_mktsegment) IN (SELECT (s_nationkey, "
            "['AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD','MACHINERY'][(s_suppkey % 5 + 1)::int]) FROM supplier)"),
        "key_rows": (
            "SELECT l_orderkey AS s3_object_id, l_partkey AS geospatial_key_id, l_suppkey AS temporal_key_id FROM lineitem EXCEPT "
            "SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1997-01-01'"),
        "insert_or_get": (
            "WITH known AS (SELECT p_brand, p_type, min(p_partkey) AS id FROM part WHERE p_size <= 10 GROUP BY ALL), "
            "fresh AS (SELECT DISTINCT p_brand, p_type FROM part ANTI JOIN known USING (p_brand, p_type)) "
            "SELECT p.p_partkey AS candidate, k.id AS known_id, (k.id IS NULL)::int AS is_new, "
            "(SELECT count(*) FROM fresh) AS n_new, "
            "CASE WHEN k.id IS NULL THEN (SELECT max(p_partkey) FROM part WHERE p_size <= 10) + 1 END AS first_new_id, "
            "CASE WHEN k.id IS NULL THEN (SELECT max(p_partkey) FROM part WHERE p_size <= 10) + (SELECT count(*) FROM fresh) END AS last_new_id "
            "FROM part p LEFT JOIN known k ON k.p_brand = p.p_brand AND k.p_type = p.p_type"),
        "rows_by_id": (
            "SELECT c.c_custkey AS field_id, c.c_name AS name FROM customer c "
            "SEMI JOIN orders o ON c.c_custkey = o.o_custkey"),
        "insert_missing": (
            "SELECT DISTINCT s_nationkey AS key FROM supplier WHERE s_nationkey NOT IN "
            "(SELECT n_nationkey FROM nation WHERE n_regionkey < 3)"),
        "apply_updates": (
            "SELECT c_custkey AS organization_id, CASE WHEN c_acctbal < 0 THEN upper(c_name) ELSE c_name END AS name, "
            f"CASE WHEN c_acctbal < 0 THEN {_NOW} ELSE TIMESTAMP '2020-01-01' END AS last_updated FROM customer"),
        "next_version": (
            "WITH f AS (SELECT s_nationkey % 5 AS fn, s_suppkey % 3 AS major, max(s_suppkey % 20) AS top FROM supplier GROUP BY ALL) "
            "SELECT c_custkey AS candidate, c_nationkey % 5 AS fn, c_custkey % 3 AS major, "
            "(coalesce(top, -1) + row_number() OVER (PARTITION BY c_nationkey % 5, c_custkey % 3 ORDER BY c_custkey))::int AS minor "
            "FROM customer LEFT JOIN f ON f.fn = c_nationkey % 5 AND f.major = c_custkey % 3"),
        "repeated_geometries": (
            "WITH g AS (SELECT c_custkey AS geom_id, c_custkey AS c FROM customer UNION ALL "
            "SELECT c_custkey + 100000000, c_custkey FROM customer WHERE c_custkey % 3 = 0) "
            "SELECT geom_id, n_rows FROM (SELECT geom_id, count(*) OVER (PARTITION BY (c * 37) % 1500, (c * 91) % 1500) AS n_rows FROM g) "
            "WHERE n_rows > 1"),
        # ---- hierarchy
        "group_closure": sql(
            "SELECT grouper_id AS ancestor_id, grouper_id, 0 AS distance FROM grouper UNION ALL "
            "SELECT parent_grouper_id, grouper_id, 1 FROM grouper WHERE parent_grouper_id IS NOT NULL UNION ALL "
            "SELECT p.parent_grouper_id, g.grouper_id, 2 FROM grouper g JOIN grouper p ON g.parent_grouper_id = p.grouper_id "
            "WHERE p.parent_grouper_id IS NOT NULL"),
        "group_rollup": "",
        "subtree_fields": sql(
            "SELECT f.field_id, g.organization_id AS ancestor_id FROM field f JOIN grouper g ON f.grouper_id = g.grouper_id"),
        "group_fields": sql(
            "SELECT g.grouper_id, f.field_id, f.name AS field_name FROM grouper g LEFT JOIN field f ON f.grouper_id = g.grouper_id"),
        "three_levels": sql(
            "SELECT a.grouper_id, a.name AS farm_name, b.name AS region_name, c.name AS country_name FROM grouper a "
            "JOIN grouper b ON a.parent_grouper_id = b.grouper_id JOIN grouper c ON b.parent_grouper_id = c.grouper_id"),
        # ---- weather
        "latest_daily": sql(
            "SELECT daily_id, cell_id, date, weather_type_id, value, date_requested FROM newest"),
        "daily_rows_all": sql(
            "SELECT daily_id, cell_id, date, weather_type_id, value, date_requested FROM daily "
            "WHERE cell_id IN (SELECT cell_id FROM need)"),
        "last_requested": sql("SELECT world_utm_id::int AS world_utm_id, cell_id, date_last_requested FROM last_req"),
        "first_year": sql("SELECT cell_id, year(min(date))::int AS first_year FROM daily GROUP BY cell_id"),
        "populated_cells": sql("SELECT DISTINCT world_utm_id::int AS world_utm_id, cell_id FROM daily"),
        "first_plant_date": sql(
            "SELECT owner_field_id AS field_id, min(date_performed) AS date_planted FROM owned_act "
            "WHERE act_type = 'PLANT' GROUP BY ALL"),
        "field_date_bounds": sql(
            "SELECT owner_field_id AS field_id, make_date((year(min(date_performed) - INTERVAL 6 HOUR) - 10)::int, 1, 1) AS date_first, "
            f"{_NOW}::date AS date_last FROM owned_act WHERE act_type = 'PLANT' GROUP BY ALL"),
        "update_inventory": sql(
            "SELECT utm_zone::int AS utm_zone, utc_offset_seconds::int AS utc_offset_seconds, world_utm_id::int AS world_utm_id, cell_id, "
            "date_first, date_last FROM update_need"),
        "add_inventory": sql(
            "SELECT utm_zone::int AS utm_zone, world_utm_id::int AS world_utm_id, cell_id, date_first, date_last FROM add_need"),
        "fill_inventory": sql(
            "SELECT world_utm_id::int AS world_utm_id, cell_id, date, parameter FROM gaps"),
        # ---- plans
        "chunk_plan": sql(
            "SELECT cell_id, zone::int AS zone, chunk FROM (SELECT *, ntile_k, CASE WHEN i < (n % ntile_k) * (n // ntile_k + 1) "
            "THEN i // (n // ntile_k + 1) ELSE (n % ntile_k) + (i - (n % ntile_k) * (n // ntile_k + 1)) // (n // ntile_k) END AS chunk "
            "FROM (SELECT o_orderkey AS cell_id, o_custkey % 60 + 1 AS zone, row_number() OVER (PARTITION BY o_custkey % 60 ORDER BY o_orderkey) - 1 AS i, "
            "count(*) OVER (PARTITION BY o_custkey % 60) AS n, ceil(count(*) OVER (PARTITION BY o_custkey % 60) / 100.0)::bigint AS ntile_k FROM orders))"),
        "year_plan": sql(
            "SELECT cell_id, y::int AS year, make_date(y, 1, 1) AS date_first, "
            "CASE WHEN y = 2024 THEN DATE '2024-02-06' ELSE make_date(y, 12, 31) END AS date_last FROM "
            "(SELECT cell_id, unnest(generate_series(year(date_first), year(date_last)))::int AS y FROM need)"),
        "update_plan": sql(
            "WITH r AS (SELECT *, row_number() OVER (PARTITION BY utm_zone ORDER BY cell_id) - 1 AS i, "
            "count(*) OVER (PARTITION BY utm_zone) AS n FROM update_need), "
            "k AS (SELECT *, ceil(n / m)::bigint AS kk FROM r, (VALUES (0, 6, 4.0), (1, 5, 3.0)) v(set_id, n_par, m)), "
            "c AS (SELECT *, CASE WHEN i < (n % kk) * (n // kk + 1) THEN i // (n // kk + 1) "
            "ELSE (n % kk) + (i - (n % kk) * (n // kk + 1)) // (n // kk) END AS chunk FROM k) "
            "SELECT set_id, utm_zone::int AS zone, chunk, n_par * date_diff('day', min(date_first), max(date_last)) * count(*) AS n_pts_requested, "
            "count(*) AS n_coords, min(date_first)::timestamp + INTERVAL 86399 SECOND - to_seconds(min(utc_offset_seconds)) AS startdate, "
            "max(date_last)::timestamp + INTERVAL 86399 SECOND - to_seconds(min(utc_offset_seconds)) AS enddate "
            "FROM c GROUP BY set_id, n_par, utm_zone, chunk"),
        "add_plan": sql(
            "WITH yr AS (SELECT *, unnest(generate_series(year(date_first), year(date_last)))::int AS y FROM add_need), "
            "r AS (SELECT *, row_number() OVER (PARTITION BY utm_zone, y ORDER BY cell_id) - 1 AS i, "
            "count(*) OVER (PARTITION BY utm_zone, y) AS n FROM yr), "
            "k AS (SELECT *, ceil(n / 5.0)::bigint AS kk FROM r, (VALUES (0, 6), (1, 5)) v(set_id, n_par)), "
            "c AS (SELECT *, CASE WHEN i < (n % kk) * (n // kk + 1) THEN i // (n // kk + 1) "
            "ELSE (n % kk) + (i - (n % kk) * (n // kk + 1)) // (n // kk) END AS chunk FROM k), "
            "g AS (SELECT set_id, n_par, utm_zone, y, chunk, count(*) AS n_coords FROM c GROUP BY ALL) "
            "SELECT set_id, utm_zone::int AS zone, y AS year, chunk, n_coords, (row_number() OVER (PARTITION BY set_id ORDER BY utm_zone, y, chunk) - 1)::int AS utm_request_id, "
            "n_par * date_diff('day', make_date(y, 1, 1), CASE WHEN y = 2024 THEN DATE '2024-02-06' ELSE make_date(y, 12, 31) END) * n_coords AS n_pts_requested FROM g"),
        "fill_plan": sql(
            "WITH cells AS (SELECT DISTINCT utm_zone, year(date) AS y, cell_id FROM gaps), "
            "b AS (SELECT utm_zone, year(date) AS y, min(date) AS lo, max(date) AS hi FROM gaps GROUP BY ALL), "
            "r AS (SELECT *, row_number() OVER (PARTITION BY utm_zone, y ORDER BY cell_id) - 1 AS i, count(*) OVER (PARTITION BY utm_zone, y) AS n FROM cells), "
            "k AS (SELECT *, ceil(n / 4.0)::bigint AS kk FROM r), "
            "c AS (SELECT *, CASE WHEN i < (n % kk) * (n // kk + 1) THEN i // (n // kk + 1) "
            "ELSE (n % kk) + (i - (n % kk) * (n // kk + 1)) // (n // kk) END AS chunk FROM k) "
            "SELECT c.utm_zone::int AS zone, c.y::int AS year, chunk, count(*) AS n_coords, "
            "5 * date_diff('day', lo, hi) * count(*) AS n_pts_requested FROM c JOIN b ON b.utm_zone = c.utm_zone AND b.y = c.y "
            "GROUP BY c.utm_zone, c.y, chunk, lo, hi"),
        "fill_param_groups": (
            "WITH z AS (SELECT DISTINCT p_partkey % 20 AS zone, p_brand AS parameter FROM part), "
            "r AS (SELECT zone, parameter, row_number() OVER (PARTITION BY zone ORDER BY parameter) - 1 AS i, "
            "ceil(count(*) OVER (PARTITION BY zone) / 10.0)::bigint AS n FROM z) "
            "SELECT zone::int AS zone, (i % n)::int AS set_id, string_agg(parameter, ',' ORDER BY parameter) AS parameters "
            "FROM r GROUP BY zone, i % n"),
        "budget_cut": sql(
            "WITH z AS (SELECT zone, count(*) AS n FROM request GROUP BY zone), c AS (SELECT zone, sum(n) OVER (ORDER BY n, zone) AS s FROM z) "
            "SELECT request_id, zone FROM request WHERE zone IN (SELECT zone FROM c WHERE s < 2500) "
            "OR (SELECT count(*) FROM request) <= 2500"),
        "requests_remaining": sql(
            "SELECT least(2500 - count(*) FILTER (WHERE date_requested > TIMESTAMP '1998-06-01'), 900000)::bigint AS n_requests FROM request"),
        "timeout_split": sql(
            "SELECT request_id, half, CASE WHEN one OR half = 0 THEN startdate ELSE mid + INTERVAL 1 DAY END AS startdate, "
            "CASE WHEN one OR half = 1 THEN enddate ELSE mid END AS enddate, "
            "CASE WHEN one AND n_coords > 1 THEN CASE half WHEN 0 THEN ceil(n_coords / 2.0) ELSE floor(n_coords / 2.0) END ELSE n_coords END::int AS n_coords, "
            "CASE WHEN one AND n_coords = 1 THEN CASE half WHEN 0 THEN ceil(n_params / 2.0) ELSE floor(n_params / 2.0) END ELSE n_params END::int AS n_params "
            "FROM (SELECT *, startdate = enddate AS one, startdate + to_days(((date_diff('day', startdate, enddate) + 1) // 2)::int) AS mid "
            "FROM request WHERE code = -408), (VALUES (0), (1)) h(half)"),
        "not_found_filter": sql(
            "SELECT request_id, CASE n_params WHEN 2 THEN 't_max_2m_24h:C' ELSE 't_max_2m_24h:C,precip_24h:mm' END AS parameters "
            "FROM request WHERE code = -404 AND n_params > 1"),
        "request_report": sql(
            "SELECT count(*) AS n_attempted, count(*) FILTER (status <> 'FAIL') AS n_success, count(*) FILTER (status = 'FAIL') AS n_failed, "
            "round(100.0 * count(*) FILTER (status <> 'FAIL') / count(*))::bigint AS percent_success, "
            "round(100.0 * count(*) FILTER (status = 'FAIL') / count(*))::bigint AS percent_failed, "
            + ", ".join(f"count(*) FILTER (code = {c}) AS \"n_{e}\"" for e, c in
                        (("NotFound", -404), ("ReadTimeout", -408), ("TooManyRequests", -429), ("InternalServerError", -500)))
            + " FROM request"),
        # ---- ingest
        "response_clean": sql(
            "SELECT (e.user_id % 40 % 4)::int AS world_utm_id, e.user_id % 40 AS cell_id, "
            "(e.ts + to_seconds((e.user_id % 40 % 4) * 10800 - 21600))::date AS date, e.ts AS date_requested, v.variable, "
            "CASE v.variable WHEN 'a_24h' THEN e.value ELSE e.value * 2 END AS value FROM events e, (VALUES ('a_24h'), ('b_24h')) v(variable)"),
        "response_filter_bounds": sql(
            "SELECT d.daily_id, d.cell_id, d.date FROM daily d WHERE EXISTS (SELECT 1 FROM update_need n "
            "WHERE n.cell_id = d.cell_id AND d.date BETWEEN n.date_first AND n.date_last)"),
        "response_filter_exact": sql(
            "SELECT d.daily_id, d.cell_id, d.date, d.parameter AS variable FROM daily d WHERE EXISTS (SELECT 1 FROM gaps g "
            "WHERE g.cell_id = d.cell_id AND g.date = d.date AND g.parameter = d.parameter)"),
        # ---- features
        "type_summary": sql(
            "WITH v AS (SELECT o.* FROM observation o SEMI JOIN field f ON f.field_id = o.field_id), "
            "u AS (SELECT u.observation_type_id, u.unit_type_id, count(*) AS c, min(date_observed)::date AS lo, max(date_observed)::date AS hi "
            "FROM v JOIN unit_type u ON u.unit_type_id = v.unit_type_id GROUP BY ALL), "
            "g AS (SELECT u.observation_type_id, v.observation_grouper_id, count(*) AS c FROM v JOIN unit_type u ON u.unit_type_id = v.unit_type_id "
            "WHERE v.observation_grouper_id IS NOT NULL GROUP BY ALL) "
            "SELECT t.observation_type_id, t.observation_type_name, t.category, sum(u.c)::bigint AS value_count, count(*) AS unit_count, "
            "min(u.lo) AS earliest, max(u.hi) AS latest, "
            "string_agg(u.unit_type_id || ':' || u.c, ',' ORDER BY u.unit_type_id) AS units, "
            "(SELECT string_agg(g.observation_grouper_id || ':' || g.c, ',' ORDER BY g.observation_grouper_id) FROM g "
            "WHERE g.observation_type_id = t.observation_type_id) AS groups "
            "FROM observation_type t JOIN u ON u.observation_type_id = t.observation_type_id GROUP BY ALL"),
        "observation_selection": sql(
            "SELECT observation_id, field_id, observation_type_name, unit_name, value_observed AS quantity, "
            "CASE observation_grouper_id WHEN 1 THEN 'AMERICA' WHEN 2 THEN 'ASIA' WHEN 3 THEN 'EUROPE' END AS group_name FROM feature_base"),
        "time_ordinal": sql(
            "SELECT observation_type_id, unit_type_id, date_observed AS acquired, time_id FROM feature_time"),
        "tolerance_dedupe": sql(
            "SELECT observation_id, field_id, observation_type_id, unit_type_id, date_observed AS acquired FROM feature_kept"),
        "first_per_group": sql(
            "SELECT observation_id FROM feature_base QUALIFY row_number() OVER (PARTITION BY field_id, observation_type_id, "
            "unit_type_id, value_observed ORDER BY date_observed, observation_id) = 1"),
        "feature_columns": sql(
            "SELECT k.observation_id, k.observation_type_name || '.' || k.unit_name || '.' || t.time_id AS column_name, k.value_observed AS quantity "
            "FROM feature_kept k JOIN feature_time t ON t.observation_type_id = k.observation_type_id AND t.unit_type_id = k.unit_type_id "
            "AND t.date_observed = k.date_observed"),
        "feature_records": sql(
            "WITH u AS (SELECT observation_type_id, unit_type_id, row_number() OVER (ORDER BY observation_type_id, unit_type_id) AS unit_id "
            "FROM (SELECT DISTINCT observation_type_id, unit_type_id FROM feature_base)) "
            "SELECT k.observation_id, '{\"field_id\":' || k.field_id || ',\"quantity\":' || k.value_observed::double::varchar || "
            "CASE WHEN k.observation_id % 3 = 0 THEN ',\"details\":{\"by\":[\"a\",\"b\"],\"depth\":' || (k.observation_id % 7) || '}' ELSE '' END || "
            "',\"acquired\":\"' || strftime(k.date_observed, '%Y-%m-%dT%H:%M:%S.%g') || '\",\"observation_type_id\":' || k.observation_type_id || "
            "',\"observation_type_name\":\"' || k.observation_type_name || '\",\"unit_type_id\":' || k.unit_type_id || ',\"unit_name\":\"' || k.unit_name || "
            "'\",\"internal_ids\":{\"time_id\":' || t.time_id || ',\"unit_id\":' || u.unit_id || ',\"column_name\":\"' || "
            "k.observation_type_name || '.' || k.unit_name || '.' || t.time_id || '\"}}' AS \"column\" "
            "FROM feature_kept k JOIN feature_time t ON t.observation_type_id = k.observation_type_id AND t.unit_type_id = k.unit_type_id "
            "AND t.date_observed = k.date_observed JOIN u ON u.observation_type_id = k.observation_type_id AND u.unit_type_id = k.unit_type_id"),
        "feature_pivot": sql(
            "SELECT field_id, " + ", ".join(
                f"max_by(value_observed, (date_observed, observation_id)) FILTER (lower(observation_type_name || '_' || unit_name) = '{n}_u{u}') AS \"{n}_u{u}\""
                for n in ("click", "error", "purchase", "signup", "view") for u in range(3))
            + " FROM feature_kept GROUP BY field_id"),
        "field_documents": sql(
            "WITH op AS (SELECT field_id, date_performed, act_id, lag(date_performed) OVER (PARTITION BY field_id, act_type ORDER BY date_performed) AS prev, act_type "
            "FROM (SELECT owner_field_id AS field_id, act_type, date_performed, min(act_id) AS act_id FROM owned_act WHERE date_performed > TIMESTAMP '2000-01-01' GROUP BY ALL)), "
            "pl AS (SELECT *, lag(date_performed) OVER (PARTITION BY field_id ORDER BY date_performed) AS prev FROM (SELECT owner_field_id AS field_id, date_performed, "
            "min_by(crop, act_id) AS crop FROM owned_act JOIN crop_type USING (crop_type_id) WHERE act_type = 'PLANT' AND date_performed > TIMESTAMP '2000-01-01' GROUP BY ALL)) "
            ", o1 AS (SELECT field_id, act_type AS name, string_agg('\"' || strftime(date_performed, '%Y-%m-%dT%H:%M:%S.%g') || '\"', ',' ORDER BY date_performed) AS ts, min(date_performed) AS m "
            "FROM op WHERE prev IS NULL OR date_performed - prev > INTERVAL 6 HOUR GROUP BY ALL), "
            "o2 AS (SELECT field_id, string_agg('{\"name\":\"' || name || '\",\"performed\":[' || ts || ']}', ',' ORDER BY m, name) AS j FROM o1 GROUP BY ALL), "
            "p1 AS (SELECT field_id, crop, string_agg('\"' || strftime(date_performed, '%Y-%m-%dT%H:%M:%S.%g') || '\"', ',' ORDER BY date_performed) AS ts, min(date_performed) AS m "
            "FROM pl WHERE prev IS NULL OR date_performed - prev > INTERVAL 6 HOUR GROUP BY ALL), "
            "p2 AS (SELECT field_id, string_agg('{\"crop\":\"' || crop || '\",\"performed\":[' || ts || ']}', ',' ORDER BY m, crop) AS j FROM p1 GROUP BY ALL) "
            "SELECT f.field_id, '{' || CASE WHEN o2.j IS NULL AND p2.j IS NULL THEN '' ELSE '\"operations\":[' || coalesce(o2.j, '') || '],\"plantings\":[' || coalesce(p2.j, '') || '],' END "
            "|| '\"field_name\":\"' || f.name || '\",\"farm_name\":\"' || g.name || '\",\"region_name\":\"' || r.name || '\",\"country_name\":\"' || c.name || '\"}' AS field_meta "
            "FROM field f JOIN grouper g ON g.grouper_id = f.grouper_id JOIN grouper r ON r.grouper_id = g.parent_grouper_id "
            "JOIN grouper c ON c.grouper_id = r.parent_grouper_id LEFT JOIN o2 ON o2.field_id = f.field_id LEFT JOIN p2 ON p2.field_id = f.field_id"),
        "key_observations": sql(
            "SELECT o.observation_id, k.tk AS temporal_key_id, k.gk AS geospatial_key_id FROM observation o JOIN "
            "(SELECT c_custkey AS gk, c_custkey AS geom_id, c_custkey AS field_id, t.tk, t.a, t.b FROM customer, "
            "(SELECT n_nationkey AS tk, DATE '2024-01-01' + n_nationkey AS a, DATE '2024-01-03' + n_nationkey * 2 AS b FROM nation) t) k "
            "ON o.geom_id = k.geom_id AND o.field_id = k.field_id AND o.date_observed > k.a AND o.date_observed < k.b"),
        "key_product": (
            "SELECT c_custkey AS geom_id, n_nationkey AS temporal_key_id FROM customer, nation"),
        "latest_object": (
            "WITH k AS (SELECT DISTINCT l_suppkey % 100 AS g, month(l_shipdate) AS m FROM lineitem), "
            "h AS (SELECT o_orderkey, o_orderkey % 3 AS s3_type_id FROM orders JOIN k ON o_custkey % 100 = g AND month(o_orderdate) = m) "
            "SELECT s3_type_id, max(o_orderkey) AS s3_object_id, 'k' || max(o_orderkey) AS key, count(*) AS n_objects FROM h GROUP BY ALL"),
        # ---- lineage
        "execution_summary": sql(
            "SELECT e.function_id, e.execution_id, (e.execution_id % 2 = 0)::bigint AS n_observation, (e.execution_id % 3 = 0)::bigint AS n_keyword, "
            "(SELECT count(*) FROM s3_in s WHERE s.execution_id = e.execution_id) AS n_s3, 0::bigint AS n_http, 1::bigint AS n_keys, "
            "(SELECT count(*) FROM s3_out s WHERE s.execution_id = e.execution_id) AS n_s3_output "
            "FROM execution e WHERE e.execution_id IN (SELECT execution_id FROM s3_out)"),
        "duplicate_executions": sql(
            "WITH i AS (SELECT execution_id, string_agg(s3_type_id || '-' || s3_object_id, ',' ORDER BY s3_type_id, s3_object_id) AS sig FROM s3_in GROUP BY ALL), "
            "a AS (SELECT e.execution_id, coalesce(sig, '') AS sig FROM execution e LEFT JOIN i USING (execution_id)) "
            "SELECT execution_id, duplicate_of FROM (SELECT execution_id, min(execution_id) OVER (PARTITION BY sig) AS duplicate_of FROM a) "
            "WHERE execution_id <> duplicate_of"),
        "raw_summary_counts": sql(
            "SELECT e.function_id, e.execution_id, count(*) AS n_rows FROM execution e JOIN s3_in i ON i.execution_id = e.execution_id "
            "JOIN s3_out o ON o.execution_id = e.execution_id GROUP BY ALL"),
        "raw_summary": sql(
            "WITH j AS (SELECT e.function_id, e.execution_id, i.s3_type_id AS it, i.s3_object_id AS io, o.s3_type_id AS ot, o.s3_object_id AS oo "
            "FROM execution e JOIN s3_in i ON i.execution_id = e.execution_id JOIN s3_out_typed o ON o.execution_id = e.execution_id) "
            "SELECT function_id, execution_id, 's3' AS family, '{\"s3_type_id\":' || it || ',\"s3_object_id\":' || io || '}' AS item, count(*) AS times FROM j GROUP BY ALL "
            "UNION ALL SELECT function_id, execution_id, 's3_output', '{\"s3_output_parameter_name\":\"out\",\"s3_type_id\":' || ot || ',\"s3_object_id\":' || oo || '}', count(*) FROM j GROUP BY ALL"),
        "latest_functions": (
            "SELECT s_nationkey AS fn, max(s_suppkey) AS minor FROM supplier GROUP BY ALL"),
        # ---- geometry
        "point_to_cell": _grid_sql(),
        "polygon_join": sql(
            "SELECT DISTINCT p.point_id, c.geom_id FROM (SELECT *, unnest([floor(px), ceil(px) - 1]) AS x, py FROM half_points) p "
            "JOIN shape_cells c ON c.x = p.x AND p.py BETWEEN c.y AND c.y + 1 AND p.px BETWEEN c.x AND c.x + 1"),
        "shape_join": sql(_SHAPE_PAIRS.format(a="shape_cells", b="shape_cells", pa="shape_points", pb="shape_points", out="other_id")),
        "field_centroids": sql(
            f"SELECT point_id AS field_id, round(lon + {s / 2}, 6) AS lon, round(lat + {s / 2}, 6) AS lat FROM points"),
    }
    out["cell_centroid"] = out["point_to_cell"]
    out["grid_cells"] = _cells_sql()
    bounds = sql("SELECT owner_field_id AS field_id, make_date((year(min(date_performed) - INTERVAL 6 HOUR) - 10)::int, 1, 1) AS df "
                 "FROM owned_act WHERE act_type = 'PLANT' GROUP BY ALL")
    out["need_of_fields"] = _grid_sql(
        s / 2, "SELECT utm_zone, lng_centroid AS lon, lat_centroid AS lat, min(df) AS date_first, "
        f"{_LAST} AS date_last FROM out JOIN ({bounds}) b ON b.field_id = out.point_id GROUP BY ALL")
    out["invalid_geometries"] = (
        "SELECT c_custkey AS geom_id, CASE c_custkey % 10 WHEN 1 THEN 'not closed' WHEN 2 THEN 'too few points' "
        "ELSE 'crosses itself' END AS reason FROM customer WHERE c_custkey % 10 IN (1, 2, 3, 5, 6, 7)")
    for name, owner in (("acts_outside_field", "owner_field_id"), ("acts_outside_field_as_written", "field_id")):
        # cells of the act's shape that its field's lacks; a point needs one cell around it, or the same point
        out[name] = sql(
            f"WITH a AS (SELECT act_id, {owner} AS f, {owner} % 6 AS fs, list_extract([0, 6, 7, 1, 5, 8], act_id % 6 + 1) AS s FROM owned_act) "
            "SELECT act_id, f AS owner_field_id FROM a WHERE f IS NULL OR (s <> 5 AND EXISTS (SELECT 1 FROM shape_grid c WHERE c.shape = a.s "
            "AND NOT EXISTS (SELECT 1 FROM shape_grid d WHERE d.shape = a.fs AND d.cx = c.cx AND d.cy = c.cy))) "
            "OR (s = 5 AND fs <> 5 AND NOT EXISTS (SELECT 1 FROM shape_grid d WHERE d.shape = a.fs AND d.cx IN (1, 2) AND d.cy IN (1, 2)))")
    # answers are of the local day: validdate is its last second in UTC
    out["daily_job"] = sql(
        "WITH n AS (SELECT 'update' AS step, cell_id, utm_zone, utc_offset_seconds, date_first, date_last FROM update_need "
        "UNION ALL SELECT 'add', cell_id, utm_zone, utc_offset_seconds, date_first, date_last FROM add_need), "
        "d AS (SELECT *, unnest(generate_series(date_first::timestamp, date_last::timestamp, INTERVAL 1 DAY))::date AS day FROM n), "
        "w AS (SELECT *, unnest(['click', 'error', 'purchase', 'signup', 'view']) AS e FROM d) "
        "SELECT step, cell_id, list_position(['click', 'error', 'purchase', 'signup', 'view'], e)::bigint AS weather_type_id, count(*) AS n_rows, "
        "min(day) AS first_date, max(day) AS last_date, "
        "sum(len(e) + 4 + day(day::timestamp + INTERVAL 86399 SECOND - utc_offset_seconds::bigint * INTERVAL 1 SECOND))::bigint AS total "
        "FROM w WHERE NOT (utm_zone = 15 AND e = 'view') GROUP BY ALL")
    out["geometry_upsert"] = (
        "WITH k AS (SELECT (s_suppkey * 37) % 1500 AS a, (s_suppkey * 91) % 1500 AS b, min(s_suppkey) AS id FROM supplier "
        "GROUP BY ALL), c AS (SELECT c_custkey, (c_custkey * 37) % 1500 AS a, (c_custkey * 91) % 1500 AS b FROM customer) "
        "SELECT c_custkey AS candidate, id AS known_id, (SELECT count(DISTINCT (a, b)) FROM c WHERE (a, b) NOT IN (SELECT (a, b) FROM k)) AS n_new "
        "FROM c LEFT JOIN k ON k.a = c.a AND k.b = c.b")
    out["geometry_by_id"] = sql(
        f"SELECT geom_id, round(lon + {s}, 7) AS x, round(lat + {s}, 7) AS y FROM points JOIN field ON geom_id = point_id")
    out["points_on_land"] = _grid_sql(
        0.0, "SELECT point_id FROM out a WHERE EXISTS (SELECT 1 FROM out b JOIN supplier ON s_suppkey = b.point_id WHERE a.utm_zone = b.utm_zone "
        "AND a.lng_centroid = b.lng_centroid AND a.lat_centroid = b.lat_centroid)")
    # 2 + 20 rows of 60, three zones of the last band missing, 2: rows and zones follow from the number
    out["polygon_info"] = (
        "WITH w AS (SELECT DISTINCT (o_orderkey % 1201 + 1)::int AS i FROM orders), "
        "z AS (SELECT i, CASE WHEN i <= 2 OR i >= 1200 THEN 0 WHEN i <= 1142 THEN (i - 3) % 60 + 1 "
        "WHEN i - 1142 < 32 THEN i - 1142 WHEN i - 1142 = 32 THEN 33 WHEN i - 1142 = 33 THEN 35 ELSE i - 1142 + 3 END AS zone FROM w) "
        "SELECT i AS world_utm_id, zone::int AS utm_zone, CASE i WHEN 1 THEN 'A' WHEN 2 THEN 'B' WHEN 1200 THEN 'Y' WHEN 1201 THEN 'Z' "
        "ELSE substr('CDEFGHJKLMNPQRSTUVWX', least((i - 3) // 60 + 1, 20)::int, 1) END AS utm_row, "
        "CASE i WHEN 1 THEN -21600 WHEN 1200 THEN -21600 WHEN 2 THEN 21600 WHEN 1201 THEN 21600 "
        "ELSE round((zone * 6 - 183) / 15.0)::int * 3600 END::int AS utc_offset_seconds FROM z")
    # daylight saving does not matter for dates: plantings are at midnight, 5 to 7 hours ahead
    out["point_time_zone"] = sql(
        "SELECT owner_field_id AS field_id, (min(date_performed) - INTERVAL 5 HOUR)::date AS local_date "
        "FROM owned_act WHERE act_type = 'PLANT' GROUP BY ALL")
    out["time_columns"] = (
        "SELECT event_id, ts + to_seconds((user_id % 25 - 12) * 3600) AS local_time, "
        "(ts + to_seconds((user_id % 25 - 12) * 3600) - INTERVAL 1 DAY)::date AS first_unstable, "
        "CASE WHEN ts > ts::date::timestamp + INTERVAL 12 HOUR THEN ts::date ELSE ts::date - 1 END AS earliest_date, "
        "ts::date::timestamp + INTERVAL 86399 SECOND - to_seconds((user_id % 25 - 12) * 3600) AS end_of_day, "
        "greatest(date_diff('day', ts::date, DATE '2024-02-03') + 1, 0)::int AS n_dates FROM events")
    out["group_ancestors"] = sql(
        "SELECT parent_grouper_id AS ancestor_id, grouper_id, 1 AS distance FROM grouper WHERE grouper_id >= 1000 UNION ALL "
        "SELECT organization_id, grouper_id, 2 FROM grouper WHERE grouper_id >= 1000")
    out["group_descendants"] = sql(
        "SELECT parent_grouper_id AS ancestor_id, grouper_id, 1 AS distance FROM grouper WHERE grouper_id >= 100 UNION ALL "
        "SELECT organization_id, grouper_id, 2 FROM grouper WHERE grouper_id >= 1000")
    out["group_rollup_all"] = sql(
        "WITH c AS (SELECT grouper_id AS a, grouper_id AS d FROM grouper UNION ALL SELECT parent_grouper_id, grouper_id FROM grouper "
        "WHERE grouper_id >= 100 UNION ALL SELECT organization_id, grouper_id FROM grouper WHERE grouper_id >= 1000), "
        "n AS (SELECT g.grouper_id, count(f.field_id) AS k FROM grouper g LEFT JOIN field f ON f.grouper_id = g.grouper_id GROUP BY ALL) "
        "SELECT a AS grouper_id, sum(k)::bigint AS total_field_count, count(*) AS total_group_count, "
        "sum(k) FILTER (a = d)::bigint AS field_count FROM c JOIN n ON n.grouper_id = c.d GROUP BY a")
    out["group_children"] = sql(
        "SELECT parent_grouper_id AS grouper_id, b AS batch, string_agg(grouper_id, ',' ORDER BY grouper_id) AS children FROM "
        "(SELECT *, (row_number() OVER (PARTITION BY parent_grouper_id ORDER BY grouper_id) - 1) // 3 AS b FROM grouper "
        "WHERE parent_grouper_id IS NOT NULL) GROUP BY ALL")
    out["group_field_batches"] = sql(
        "SELECT grouper_id, b AS batch, count(field_id)::int AS n_fields, coalesce(string_agg(field_id, ',' ORDER BY field_id), '') AS ids FROM "
        "(SELECT g.grouper_id, f.field_id, (row_number() OVER (PARTITION BY g.grouper_id ORDER BY f.field_id) - 1) // 7 AS b "
        "FROM grouper g LEFT JOIN field f ON f.grouper_id = g.grouper_id) GROUP BY ALL")
    out["missing_ids"] = (
        "SELECT DISTINCT o_custkey * 2 AS field_id FROM orders WHERE o_custkey * 2 NOT IN (SELECT c_custkey FROM customer)")
    out["object_key_links"] = (
        "SELECT o_orderkey AS s3_object_id, o_custkey % 10 AS geospatial_key_id, month(o_orderdate) AS temporal_key_id FROM orders")
    out["raster_subtype_violations"] = (
        "SELECT rid, t AS raster_type, s AS raster_subtype FROM (SELECT o_orderkey AS rid, "
        "['RAW','PRIMARY','DERIVED','UNKNOWN'][(o_orderkey % 4 + 1)::int] AS t, "
        "['RGB','MULTISPECTRAL','THERMAL','HYPERSPECTRAL','DEM','INTERPOLATED','PREDICTION','BANDMATH','ELEVATION'][(o_orderkey % 9 + 1)::int] AS s, "
        "o_orderkey % 9 AS k FROM orders) WHERE (t = 'RAW' AND k > 3) OR (t = 'PRIMARY' AND k > 5) OR (t = 'DERIVED' AND k < 6)")
    out["bad_unit_names"] = "SELECT p_partkey AS unit_type_id FROM part WHERE p_partkey % 5 = 0 OR p_partkey % 3 = 0"
    out["coordinate_decimals"] = sql(
        "SELECT point_id FROM (SELECT point_id, round(lon + point_id * 0.0000013::double, 7) AS x FROM points WHERE point_id % 2 = 1) "
        "WHERE round(x, 5) <> x")
    out["weather_type_ids"] = sql(
        "SELECT DISTINCT parameter AS weather_type, weather_type_id FROM daily "
        "UNION ALL SELECT DISTINCT parameter || 'x', NULL FROM daily")
    out["fill_inventory_by_request"] = sql(
        "SELECT daily_id, (((date_requested + to_seconds(utc_offset_seconds) - INTERVAL 1 DAY)::date > date) OR "
        f"(date > ({_NOW} + to_seconds(utc_offset_seconds) - INTERVAL 1 DAY)::date - 1))::int AS kept FROM daily JOIN utm USING (world_utm_id)")
    out["request_sizes"] = sql(
        "SELECT utm_zone::int AS utm_zone, 3 * date_diff('day', min(date_first), max(date_last)) * count(*) AS n_pts_requested FROM need GROUP BY utm_zone")
    out["retry_requests"] = sql(
        "SELECT request_id, 0 AS half, (n_params - 1)::int AS n_params FROM request WHERE code = -404 AND n_params > 1 UNION ALL "
        "SELECT request_id, h, CASE WHEN startdate = enddate AND n_coords = 1 THEN CASE h WHEN 0 THEN ceil(n_params / 2.0) ELSE floor(n_params / 2.0) END "
        "ELSE n_params END::int FROM request, (VALUES (0), (1)) v(h) WHERE code = -408")
    out["unhandled_failures"] = sql(
        "SELECT zone, CASE code WHEN -404 THEN 'NotFound(''no data for t_min_2m_24h:C'')' ELSE 'other' END AS error, count(*) AS n_failures "
        "FROM request WHERE code IN (-404, -500) GROUP BY ALL")
    out["daily_ingest"] = sql(
        "SELECT world_utm_id::int AS world_utm_id, cell_id, d AS date, weather_type_id, value, date_requested FROM "
        "(SELECT y.*, (date_requested + to_seconds(utc_offset_seconds))::date AS d FROM daily y JOIN utm USING (world_utm_id)) x "
        "WHERE EXISTS (SELECT 1 FROM update_need n WHERE n.cell_id = x.cell_id AND x.d BETWEEN n.date_first AND n.date_last)")
    out["daily_append_ids"] = sql(
        "SELECT m + 1 AS first_id, m + n AS last_id, n AS n_rows, n AS n_ids FROM (SELECT max(daily_id) AS m FROM daily), "
        "(SELECT count(*) AS n FROM (SELECT y.*, (date_requested + to_seconds(utc_offset_seconds))::date AS d FROM daily y JOIN utm USING (world_utm_id)) x "
        "WHERE EXISTS (SELECT 1 FROM update_need n WHERE n.cell_id = x.cell_id AND x.d BETWEEN n.date_first AND n.date_last))")
    out["request_log_ids"] = sql(
        "SELECT max(request_id) + 1 AS first_id, max(request_id) + count(*) AS last_id, count(*) AS n_rows, count(*) AS n_ids FROM request")
    out["unknown_parameters"] = "SELECT l_returnflag AS variable, count(*) AS rows FROM lineitem GROUP BY l_returnflag"
    out["geojson_features"] = sql(
        "SELECT point_id AS geom_id, 'POLYGON' AS kind, round(lon, 6) AS x, round(lat, 6) AS y, 5 AS n_points FROM points")
    out["response_rows"] = (
        "SELECT l_orderkey AS geospatial_key_id, l_partkey AS temporal_key_id, l_linenumber AS line, l_quantity AS amount "
        "FROM lineitem, (VALUES (1), (2)) v(x)")
    out["keyword_arguments"] = (
        "SELECT o_custkey % 7 AS function_id, o_orderkey AS execution_id, 'k' AS keyword_name, "
        "CASE WHEN o_orderkey % 4 IN (1, 2) THEN o_custkey::double END AS value_number, "
        "CASE WHEN o_orderkey % 4 NOT IN (1, 2) THEN o_custkey::varchar END AS value_string FROM orders")
    out["signature_difference"] = (
        "SELECT 'candidate' AS side, type_name FROM (SELECT p_brand AS type_name FROM part WHERE p_size <= 30 EXCEPT ALL "
        "SELECT p_brand FROM part WHERE p_size > 20) UNION ALL SELECT 'latest', type_name FROM (SELECT p_brand AS type_name FROM part "
        "WHERE p_size > 20 EXCEPT ALL SELECT p_brand FROM part WHERE p_size <= 30)")
    out["execution_arguments"] = sql(
        "WITH d AS (SELECT DISTINCT execution_id FROM s3_out), "
        "o AS (SELECT l_orderkey AS execution_id, l_suppkey FROM lineitem WHERE l_returnflag = 'R') "
        "SELECT execution_id, 's3' AS family, (SELECT count(*) FROM s3_in i WHERE i.execution_id = d.execution_id) AS n_arguments, "
        "(SELECT count(DISTINCT (s3_type_id, s3_object_id)) FROM s3_in i WHERE i.execution_id = d.execution_id)::int AS n_distinct FROM d UNION ALL "
        "SELECT execution_id, 's3_output', (SELECT count(*) FROM o WHERE o.execution_id = d.execution_id), "
        "(SELECT count(DISTINCT l_suppkey) FROM o WHERE o.execution_id = d.execution_id)::int FROM d UNION ALL "
        "SELECT execution_id, 'keys', 1, 1 FROM d UNION ALL "
        "SELECT execution_id, f, 0, 0 FROM d, (VALUES ('observation'), ('keyword'), ('http')) v(f)")
    out["latest_signatures"] = (
        "WITH l AS (SELECT s_nationkey, max(s_suppkey) AS id FROM supplier GROUP BY ALL) "
        "SELECT 'f' || s_nationkey AS function_name, id::int AS minor, 's3_inputs' AS family, "
        "(SELECT count(DISTINCT l_returnflag) FROM lineitem WHERE l_suppkey = id)::int AS n_parameters FROM l UNION ALL "
        "SELECT 'f' || s_nationkey, id::int, 's3_outputs', (SELECT count(DISTINCT l_linestatus) FROM lineitem WHERE l_suppkey = id)::int FROM l")
    out["feature_batches"] = sql(
        "SELECT field_id, b AS batch, count(*)::int AS n_features FROM (SELECT field_id, (row_number() OVER (PARTITION BY field_id "
        "ORDER BY date_observed, observation_id) - 1) // 10 AS b FROM feature_kept) GROUP BY ALL")
    out["column_values"] = sql(
        "SELECT k.observation_type_name || '.' || k.unit_name || '.' || t.time_id AS column_name, "
        "max_by(k.value_observed, (k.date_observed, k.observation_id)) AS quantity "
        "FROM feature_kept k JOIN feature_time t ON t.observation_type_id = k.observation_type_id AND t.unit_type_id = k.unit_type_id "
        "AND t.date_observed = k.date_observed GROUP BY ALL")
    out["observation_counts"] = sql(
        "SELECT observation_type_id, count(*) AS number_of_observations FROM observation GROUP BY ALL")
    out["frame_join"] = sql(
        "SELECT geom_id, shape_id, n_lines, n_orders FROM (" + _SHAPE_PAIRS.format(a="shape_cells", b="supplier_cells", pa="shape_points", pb="supplier_points", out="shape_id") + ") "
        "JOIN (SELECT l_suppkey, count(*) AS n_lines FROM lineitem GROUP BY ALL) ON l_suppkey = shape_id "
        "JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY ALL) ON o_custkey = geom_id")
    out["feature_matrix"] = sql(
        "SELECT geom_id, n_orders, square_id FROM (" + _SHAPE_PAIRS.format(a="shape_cells", b="supplier_cells", pa="shape_points", pb="supplier_points", out="square_id") + ") "
        "JOIN (SELECT o_custkey, count(*) AS n_orders FROM orders GROUP BY ALL) ON o_custkey = geom_id")
    out["seeded_weather_types"] = (
        "WITH m AS (SELECT max(CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3 WHEN 'signup' THEN 4 ELSE 5 END) AS top FROM events) "
        "SELECT (top + i)::bigint AS weather_type_id, n AS weather_type, u AS units FROM m, (VALUES "
        + ", ".join(f"({i}, '{n}', '{u}')" for i, (n, u, _) in enumerate(DAILY_WEATHER_TYPES, 1)) + ") v(i, n, u)")
    tail = ("SELECT g.grouper_id, g.parent_grouper_id, g.name, CASE WHEN g.grouper_id < 100 THEN 0 WHEN g.grouper_id < 1000 THEN 1 ELSE 2 END AS depth, "
            "l.total_group_count, (SELECT count(*) FROM grouper c WHERE c.parent_grouper_id = g.grouper_id) AS group_count, "
            "l.total_field_count, CASE WHEN g.grouper_id >= 1000 THEN l.total_field_count ELSE 0 END AS field_count FROM grouper g JOIN "
            "(SELECT a.grouper_id, count(DISTINCT b.grouper_id) AS total_group_count, count(f.field_id) AS total_field_count FROM grouper a JOIN grouper b "
            "ON b.grouper_id >= 1000 AND (b.grouper_id = a.grouper_id OR b.parent_grouper_id = a.grouper_id OR "
            "(a.grouper_id < 100 AND b.organization_id = a.grouper_id)) LEFT JOIN field f ON f.grouper_id = b.grouper_id GROUP BY ALL) l ON l.grouper_id = g.grouper_id")
    out["group_rollup"] = sql(tail)
    out["all_field_ids"] = "SELECT c_custkey AS field_id FROM customer"
    out["daily_weather_types"] = sql("SELECT DISTINCT weather_type_id, parameter AS weather_type FROM daily")
    out["need_of_populated"] = sql(
        "SELECT utm_zone::int AS utm_zone, utc_offset_seconds::int AS utc_offset_seconds, world_utm_id::int AS world_utm_id, cell_id, "
        "date_first, date_last FROM need_daily")
    out["merged_need"] = sql("SELECT world_utm_id::int AS world_utm_id, cell_id, date_first FROM need_all")
    out["fill_inventory_skip_empty"] = sql(
        "WITH d AS (SELECT * FROM daily WHERE weather_type_id <> 4 OR world_utm_id = 1), "
        "seen AS (SELECT DISTINCT n.world_utm_id, d.weather_type_id, d.parameter FROM d JOIN need n ON n.cell_id = d.cell_id), "
        "kept AS (SELECT DISTINCT cell_id, weather_type_id, date FROM d JOIN utm USING (world_utm_id) WHERE "
        "(date_requested + to_seconds(utc_offset_seconds) - INTERVAL 1 DAY)::date > date OR "
        f"date > ({_NOW} + to_seconds(utc_offset_seconds) - INTERVAL 1 DAY)::date - 1), "
        f"spine AS (SELECT cell_id, world_utm_id, unnest(generate_series(date_first::timestamp, {_LAST}::timestamp, INTERVAL 1 DAY))::date AS date FROM need) "
        "SELECT s.world_utm_id::int AS world_utm_id, e.parameter, count(*) AS n_gaps FROM spine s JOIN seen e ON e.world_utm_id = s.world_utm_id "
        "ANTI JOIN kept k ON k.cell_id = s.cell_id AND k.date = s.date AND k.weather_type_id = e.weather_type_id GROUP BY ALL")
    out["mixed_offsets"] = (
        "SELECT o_custkey % 60 AS zone, o_custkey % 600 AS chunk FROM orders GROUP BY ALL "
        "HAVING count(DISTINCT o_orderdate > TIMESTAMP '1998-01-01') > 1")
    out["geometry_for_keys"] = (
        "SELECT c_custkey AS geom_id FROM customer WHERE c_custkey IN (SELECT o_custkey + 1 FROM orders)")
    out["key_product_ids"] = (
        "SELECT o_custkey * 2 AS geospatial_key_id, date_diff('day', DATE '1990-01-01', o_orderdate::date)::int AS temporal_key_id FROM orders")
    out["type_dimension_upsert"] = (
        "SELECT count(DISTINCT upper(p_name)) AS n_rows, 1::bigint AS first_id, count(DISTINCT upper(p_name)) AS last_id, "
        "count(DISTINCT upper(p_name)) AS n_crops FROM part")
    return out

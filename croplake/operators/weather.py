"""Queries over the long daily table, and the inventories of stale and missing rows.

``daily`` is append-only history: (world_utm_id, cell_id, date, weather_type_id, value,
date_requested), several requests per cell, date and parameter. A *need* is one row per cell:
(utm_zone, utc_offset_seconds, world_utm_id, cell_id, lon, lat, date_first, date_last).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from croplake.functions import timeops as t
from croplake.operators.views import owner_field

NEED_COLUMNS = [
    "utm_zone", "utc_offset_seconds", "world_utm_id", "cell_id", "lon", "lat", "date_first",
    "date_last",
]
FILL_COLUMNS = [
    "utm_zone", "utc_offset_seconds", "world_utm_id", "cell_id", "lon", "lat", "date", "parameter",
]
_DAILY_OUT = ["daily_id", "cell_id", "date", "weather_type_id", "value", "date_requested"]


# ---- queries --------------------------------------------------------------------------------
def daily_weather_types(weather_type: DataFrame) -> DataFrame:
    """Weather types of one day's extent, in id order."""
    one_day = F.expr("interval '1 00:00:00' day to second")
    return weather_type.filter(F.col("temporal_extent") == one_day).orderBy("weather_type_id")


def latest_rows(daily: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """The newest request per cell, parameter and date; of ties the largest ``daily_id``.

    An aggregate, not a window: every task first reduces its own share of a hot cell. Request time
    and id are one number of 38 digits, so that all that is kept per key has a fixed width and
    Spark can hash, where a struct would make it sort the whole table first.
    """
    key = ["cell_id", "weather_type_id", "date"]
    rest = ["daily_id", "value", "date_requested", *extra]
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', date_requested)")
    number = F.coalesce(micros, F.lit(-(10**17))).cast("decimal(19,0)") * F.lit(10**18).cast("decimal(19,0)")
    newest = (number * F.lit(10).cast("decimal(2,0)")).cast("decimal(38,0)") + F.col("daily_id")
    newest = newest.cast("decimal(38,0)")
    return daily.groupBy(*key).agg(*[F.max_by(c, newest).alias(c) for c in rest])


def daily_rows(
    daily: DataFrame, cells: DataFrame | None = None, weather_types: DataFrame | None = None,
    keep: str = "recent",
) -> DataFrame:
    """Rows of the given cells and types: ``keep="all"`` or only the most ``"recent"`` ones."""
    if keep not in ("all", "recent"):
        raise ValueError('keep must be "all" or "recent"')
    rows = daily
    if cells is not None:
        rows = rows.join(cells.select("cell_id"), "cell_id", "left_semi")
    if weather_types is not None:
        rows = rows.join(weather_types.select("weather_type_id"), "weather_type_id", "left_semi")
    return (rows if keep == "all" else latest_rows(rows)).select(*_DAILY_OUT)


def weather_type_ids(weather_type: DataFrame, parameters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(name → id of the wanted parameters, wanted names that are unknown)``."""
    names = parameters.select("weather_type").distinct()
    found = weather_type.join(names, "weather_type", "left_semi").select(
        "weather_type", "weather_type_id"
    )
    return found, names.join(weather_type, "weather_type", "left_anti")


def populated_cells(daily: DataFrame) -> DataFrame:
    return daily.select("world_utm_id", "cell_id").distinct()


def first_year(daily: DataFrame, cells: DataFrame | None = None) -> DataFrame:
    """The first year with data per cell."""
    rows = daily if cells is None else daily.join(cells.select("cell_id"), "cell_id", "left_semi")
    return rows.groupBy("cell_id").agg(F.year(F.min("date")).alias("first_year"))


def last_requested(daily: DataFrame) -> DataFrame:
    """Per cell the oldest among its parameters' newest requests."""
    per_type = daily.groupBy("world_utm_id", "cell_id", "weather_type_id").agg(
        F.max("date_requested").alias("_newest")
    )
    return per_type.groupBy("world_utm_id", "cell_id").agg(
        F.min("_newest").alias("date_last_requested")
    )


# ---- need of the fields ---------------------------------------------------------------------
def first_plant_date(act: DataFrame, field_trial: DataFrame, plot: DataFrame) -> DataFrame:
    """The first planting per owning field, whichever parent the act hangs on."""
    plantings = act.filter("act_type = 'PLANT'").select(
        "field_id", "field_trial_id", "plot_id", "date_performed"
    )
    return (
        owner_field(plantings, field_trial, plot)
        .filter(F.col("owner_field_id").isNotNull())
        .groupBy(F.col("owner_field_id").alias("field_id"))
        .agg(F.min("date_performed").alias("date_planted"))
    )


def field_date_bounds(
    first_plant: DataFrame, field_zone: DataFrame, now, history_years: int = t.HISTORY_YEARS
) -> DataFrame:
    """Dates a field needs: Jan 1, ``history_years`` before its local planting year, to today.

    ``field_zone`` maps field_id to the name of its political time zone; unplanted fields drop.
    """
    local = t.local_time_in_zone(F.col("date_planted"), F.col("tz_name"))
    return first_plant.join(field_zone, "field_id").select(
        "field_id",
        F.make_date(F.year(local) - F.lit(history_years), F.lit(1), F.lit(1)).alias("date_first"),
        F.to_date(t.instant(now)).alias("date_last"),
    )


def need_of_fields(field_cell: DataFrame, bounds: DataFrame, now) -> DataFrame:
    """Need per cell from its fields: their earliest first date, until the last forecast date.

    ``field_cell`` holds one row per field with its cell (field_id, world_utm_id, cell_id,
    utm_zone, utc_offset_seconds, lon, lat of the cell centre).
    """
    per_field = field_cell.join(bounds.select("field_id", "date_first"), "field_id")
    key = ["utm_zone", "utc_offset_seconds", "world_utm_id", "cell_id", "lon", "lat"]
    return (
        per_field.groupBy(*key)
        .agg(F.min("date_first").alias("date_first"))
        .withColumn("date_last", t.last_forecast_date(now))
        .select(*NEED_COLUMNS)
    )


def need_of_populated(
    daily: DataFrame, world_utm: DataFrame, cell_centroid: DataFrame, now
) -> DataFrame:
    """Need per populated cell: Jan 1 of its first year until the last forecast date."""
    cells = daily.groupBy("world_utm_id", "cell_id").agg(F.min("date").alias("_first"))
    # a cell's first year is taken over all its rows, under whichever polygon they were stored
    first = cells.groupBy("cell_id").agg(F.min("_first").alias("_first"))
    return (
        cells.drop("_first")
        .join(first, "cell_id")
        .join(world_utm, "world_utm_id")
        .join(cell_centroid, ["world_utm_id", "cell_id"])
        .select(
            "utm_zone", "utc_offset_seconds", "world_utm_id", "cell_id", "lon", "lat",
            F.make_date(F.year("_first"), F.lit(1), F.lit(1)).alias("date_first"),
            t.last_forecast_date(now).alias("date_last"),
        )
    )


# ---- inventories ----------------------------------------------------------------------------
def update_inventory(
    daily: DataFrame, world_utm: DataFrame, cell_centroid: DataFrame, now
) -> DataFrame:
    """Cells last requested before today: from their first date not final then, to the forecast."""
    stale = last_requested(daily).filter(
        F.to_date("date_last_requested") < F.to_date(t.instant(now))
    )
    local = t.local_time(F.col("date_last_requested"), F.col("utc_offset_seconds"))
    return (
        stale.join(world_utm, "world_utm_id")
        .withColumn("date_first", t.first_unstable_date(local))
        .withColumn("date_last", t.last_forecast_date(now))
        .join(cell_centroid, ["world_utm_id", "cell_id"])
        .select(*NEED_COLUMNS)
    )


def add_inventory(need: DataFrame, daily: DataFrame) -> DataFrame:
    """Needed cells without data, and needed years before a cell's first stored year."""
    stored = first_year(daily)
    known = need.join(stored, "cell_id", "left")
    before = F.make_date(F.col("first_year"), F.lit(1), F.lit(1))
    new_cell = F.col("first_year").isNull()
    return known.filter(new_cell | (F.col("date_first") < before)).withColumn(
        "date_last", F.when(new_cell, F.col("date_last")).otherwise(F.date_sub(before, 1))
    ).select(*NEED_COLUMNS)


def merged_need(need_fields: DataFrame, need_populated: DataFrame) -> DataFrame:
    """One need per cell from both; the row with the later first date wins."""
    both = need_fields.select(*NEED_COLUMNS).unionByName(need_populated.select(*NEED_COLUMNS))
    rest = [c for c in NEED_COLUMNS if c != "cell_id"]
    # ties on the date are settled by the rest of the row, so that reruns agree
    row = F.max(F.struct("date_first", *[c for c in rest if c != "date_first"])).alias("_row")
    return both.groupBy("cell_id").agg(row).select("cell_id", "_row.*").select(*NEED_COLUMNS)


def is_kept(now, offset_seconds: Column) -> Column:
    """True for a daily row that needs no refill: final when requested, or a date not final yet."""
    requested = t.local_time(F.col("date_requested"), offset_seconds)
    last_final = F.date_sub(t.first_unstable_date(t.local_time(t.instant(now), offset_seconds)), 1)
    return (t.first_unstable_date(requested) > F.col("date")) | (F.col("date") > last_final)


def polygon_offsets(need: DataFrame) -> DataFrame:
    """UTC offset per polygon of ``need``.

    One row per polygon, and the world has 1,201 of them: small enough to send to every task, so
    the daily table is not shuffled for it. Whether folders of other polygons are skipped is left to Spark.
    """
    return F.broadcast(
        need.groupBy("world_utm_id").agg(F.min("utc_offset_seconds").alias("_offset"))
    )


def rows_near(daily: DataFrame, need: DataFrame, last: Column) -> DataFrame:
    """Rows of the needed polygons and dates, by filters that reach the scan.

    The polygons (1,201 at most) and the first date of the need are scalars of the same query: where
    the table lies in a folder per polygon, other folders are not listed for reading, and row groups
    before the first date are skipped.
    """
    polygons = need.agg(F.collect_set("world_utm_id")).scalar()
    first = need.agg(F.min("date_first")).scalar()
    return daily.filter(
        F.array_contains(polygons, F.col("world_utm_id")) & (F.col("date") >= first) & (F.col("date") <= last)
    )


def fill_inventory(
    need: DataFrame, daily: DataFrame, weather_type: DataFrame, now, skip_empty: bool = False
) -> DataFrame:
    """Needed (cell, date, parameter) rows without a kept daily row.

    A later request is never less final than an earlier one, so "the newest row is kept" is the
    same as "some row is kept" and the history needs no newest-row step. Kept dates shrink to one
    set per cell and parameter (a calendar at most, reduced in every task before the shuffle, so
    a hot cell is harmless) and the gaps are cut out of the date range in place: what is shuffled
    grows with cells × parameters, not with cells × parameters × dates.

    ``skip_empty`` leaves out a parameter that has no row at all in a polygon's needed cells.
    """
    need = need.select(*NEED_COLUMNS)
    # parameters are an enumerated domain: a literal array, no join
    wanted = daily_weather_types(weather_type).agg(
        F.collect_list(F.struct("weather_type_id", "weather_type"))
    ).scalar()
    last = t.last_forecast_date(now)
    spine = need.withColumn("_type", F.explode(wanted)).select(
        "*", "_type.weather_type_id", F.col("_type.weather_type").alias("parameter")
    ).drop("_type")
    kept = (
        rows_near(daily, need, last)
        .select("world_utm_id", "cell_id", "weather_type_id", "date", "date_requested")
        .join(polygon_offsets(need), "world_utm_id")
        .filter(is_kept(now, F.col("_offset")))
        .groupBy("cell_id", "weather_type_id")
        .agg(F.collect_set("date").alias("_kept"))
    )
    if skip_empty:
        types_of_cell = daily.select("cell_id", "weather_type_id").distinct()
        seen = (
            types_of_cell.join(need.select("cell_id", "world_utm_id"), "cell_id")
            .select("world_utm_id", "weather_type_id").distinct()
        )
        spine = spine.join(seen, ["world_utm_id", "weather_type_id"], "left_semi")
    all_dates = t.dates_between(F.col("date_first"), last)
    none = F.array().cast("array<date>")
    return (
        spine.join(kept, ["cell_id", "weather_type_id"], "left")
        .withColumn("date", F.explode(F.array_except(all_dates, F.coalesce("_kept", none))))
        .select(*FILL_COLUMNS)
    )

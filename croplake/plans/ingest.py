"""From landed wide responses to rows of the daily table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from croplake.functions import timeops as t
from croplake.operators.checks import require_columns
from croplake.operators.keyed import allocate_ids
from croplake.session import cut_lineage

DAILY_COLUMNS = ["world_utm_id", "cell_id", "date", "weather_type_id", "value", "date_requested"]
LOG_COLUMNS = ["zone", "utm_request_id", "n_pts_requested", "startdate", "enddate", "parameters",
               "date_requested", "status", "request_seconds"]
_INDEX = ["lat", "lon", "validdate", "date_requested"]


def _micro_degrees(column: str) -> Column:
    """A coordinate of 5 decimals as an integer, so that it can be a join key."""
    return F.round(F.col(column) * F.lit(100000)).cast("long")


def clean_response(wide: DataFrame, cells: DataFrame) -> DataFrame:
    """Wide response rows as (world_utm_id, cell_id, date, date_requested, variable, value).

    ``wide`` has lat, lon, validdate (UTC), date_requested and one column per parameter; ``cells``
    maps lat, lon to a cell and its polygon's UTC offset. A point no cell claims keeps null ids.
    """
    require_columns(cells, ["world_utm_id", "cell_id", "lat", "lon"], "the cell table")
    index = cells.select(
        "world_utm_id", "cell_id", "utc_offset_seconds",
        _micro_degrees("lat").alias("_lat"), _micro_degrees("lon").alias("_lon"),
    ).distinct()
    parameters = [c for c in wide.columns if c not in _INDEX]
    located = wide.join(
        index,
        (_micro_degrees("lat") == F.col("_lat")) & (_micro_degrees("lon") == F.col("_lon")),
        "left",
    )
    local = t.local_time(F.col("validdate"), F.col("utc_offset_seconds"))
    ids = ["world_utm_id", "cell_id", "date", "date_requested"]
    return located.withColumn("date", F.to_date(local)).unpivot(
        ids, parameters, "variable", "value"
    )


def within_bounds(clean: DataFrame, need: DataFrame) -> DataFrame:
    """Rows inside their cell's date range."""
    bounds = need.select(
        F.col("cell_id").alias("_cell"), F.to_date("date_first").alias("_first"),
        F.to_date("date_last").alias("_last"),
    )
    return clean.join(
        bounds,
        (F.col("cell_id") == F.col("_cell")) & F.col("date").between(F.col("_first"), F.col("_last")),
        "left_semi",
    )


def exactly_requested(clean: DataFrame, gaps: DataFrame) -> DataFrame:
    """Rows whose cell, date and parameter were asked for."""
    wanted = gaps.select("cell_id", "date", F.col("parameter").alias("variable"))
    return clean.join(wanted, ["cell_id", "date", "variable"], "left_semi")


def filter_response(clean: DataFrame, need: DataFrame) -> DataFrame:
    """:func:`within_bounds` or :func:`exactly_requested`, by the columns of ``need``."""
    if {"date_first", "date_last"} <= set(need.columns):
        return within_bounds(clean, need)
    return exactly_requested(clean, need)


def unknown_parameters(clean: DataFrame, weather_type: DataFrame) -> DataFrame:
    """(variable, rows) of cleaned rows whose parameter isn't a stored weather type."""
    ids = weather_type.select(F.col("weather_type").alias("variable"))
    return clean.join(ids, "variable", "left_anti").groupBy("variable").agg(F.count("*").alias("rows"))


def daily_rows_of(clean: DataFrame, weather_type: DataFrame) -> DataFrame:
    """Cleaned rows with their type id, in the columns of the daily table.

    Rows of a parameter that ``weather_type`` lacks are left out, since a stored row needs its type;
    :func:`unknown_parameters` reports them.
    """
    ids = weather_type.select(F.col("weather_type").alias("variable"), "weather_type_id")
    return clean.join(ids, "variable").select(
        "world_utm_id", "cell_id", "date", "weather_type_id",
        F.col("value").cast("float").alias("value"), "date_requested",
    )


def with_row_ids(rows: DataFrame, stored: DataFrame, id_col: str) -> DataFrame:
    """``id_col`` and ``rows``: ids go on densely from the largest one of ``stored``, or from 1.

    Which row gets which id depends on the rows alone, so a task that runs again gives the same.
    """
    start = stored.agg(F.coalesce(F.max(id_col), F.lit(0)) + 1).scalar()
    return allocate_ids(rows, id_col, rows.columns, start).select(id_col, *rows.columns)


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """Columns of the table at ``path``; none where there is no table yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def reserved_ids(path: str) -> str:
    """Where the id ranges given out for the table at ``path`` are kept; readers of the table skip it."""
    return f"{path.rstrip('/')}/_ids"


def _append_once(
    rows: DataFrame, path: str, id_col: str, same: Column, stored: DataFrame | None,
    write: Callable[[DataFrame], None],
) -> None:
    """Append the ``rows`` that the table lacks (by ``same`` of rows ``n`` and stored ``s``), with dense ids.

    The range of ids is noted before the rows are written, in a small table of ranges that later
    appends read instead of the id column. An append that broke off and is sent again adds what
    is missing with a new range (the rest of its first range stays unused); one that succeeded adds nothing.
    """
    spark = rows.sparkSession
    if stored is not None:
        rows = rows.alias("n").join(stored.alias("s"), same, "left_anti")
    fresh = cut_lineage(rows)
    count = fresh.count()
    if not count:
        return
    ranges = _stored(spark, reserved_ids(path), "first_id long, last_id long")
    if ranges is None:  # a table from before the ranges: its ids are looked through once
        ids = _stored(spark, path, f"{id_col} long")
        top = ids.agg(F.max(id_col)).first()[0] if ids is not None else None
    else:
        top = ranges.agg(F.max("last_id")).first()[0]
    first = (top or 0) + 1
    spark.createDataFrame([(first, first + count - 1)], "first_id long, last_id long").coalesce(1).write.mode(
        "append").parquet(reserved_ids(path))
    write(allocate_ids(fresh, id_col, fresh.columns, first).select(id_col, *fresh.columns))


def append_daily(rows: DataFrame, path: str) -> None:
    """Append rows to the daily table, one folder per polygon, with a ``daily_id`` each.

    A row that is stored already (same polygon, cell, date, type and time of request) is not
    appended again; for that only the folders of the rows' polygons are read, from the earliest time
    of request on. Rows of a polygon are spread over as many files as adaptive execution finds fit.
    """
    require_columns(rows, DAILY_COLUMNS, "the weather table")
    rows = rows.select(*DAILY_COLUMNS)
    key = ["world_utm_id", "cell_id", "date", "weather_type_id", "date_requested"]
    fields = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    stored = _stored(rows.sparkSession, path, ", ".join(f"{c} {fields[c]}" for c in key))
    if stored is not None:
        polygons = rows.agg(F.collect_set("world_utm_id")).scalar()  # 1,201 at most
        earliest = rows.agg(F.min("date_requested")).scalar()
        stored = stored.filter(
            F.array_contains(polygons, F.col("world_utm_id")) & (F.col("date_requested") >= earliest)
        )
    _append_once(
        rows, path, "daily_id", reduce(and_, [F.col(f"n.{c}").eqNullSafe(F.col(f"s.{c}")) for c in key]), stored,
        lambda out: out.hint("rebalance", "world_utm_id").write.mode("append").partitionBy("world_utm_id").parquet(path),
    )


def append_request_log(requests: DataFrame, path: str) -> None:
    """Append the metadata of sent requests, with a ``request_id`` each; parameter lists become text.

    A request that is logged already, with the same values in all columns, is not logged again.
    """
    require_columns(requests, LOG_COLUMNS, "the request table")
    rows = requests.select(*LOG_COLUMNS)
    if dict(rows.dtypes)["parameters"].startswith("array"):
        rows = rows.withColumn("parameters", F.array_join("parameters", ","))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    stored = _stored(rows.sparkSession, path, schema)
    if stored is not None:
        earliest = rows.agg(F.min("date_requested")).scalar()
        stored = stored.filter(F.col("date_requested") >= earliest)
    _append_once(
        rows, path, "request_id", reduce(and_, [F.col(f"n.{c}").eqNullSafe(F.col(f"s.{c}")) for c in LOG_COLUMNS]), stored,
        lambda out: out.write.mode("append").parquet(path),
    )

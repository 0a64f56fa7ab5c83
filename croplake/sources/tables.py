"""Stored tables: bootstrap, reading with an empty default, seeding."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from croplake.catalog import CATALOG, DAILY_WEATHER_TYPES, TableSpec
from croplake.operators import keyed
from croplake.operators.weather import FILL_COLUMNS, NEED_COLUMNS

_NEED_TYPES = {
    "utm_zone": "int", "utc_offset_seconds": "int", "world_utm_id": "int", "cell_id": "long",
    "lon": "double", "lat": "double", "date_first": "date", "date_last": "date", "date": "date",
    "parameter": "string",
}


def create_tables(spark: SparkSession, folder: str, names: list[str] | None = None) -> None:
    """Write every table of the catalogue, empty; tables that exist are left alone."""
    for name in names or list(CATALOG):
        CATALOG[name].empty(spark).write.mode("ignore").parquet(f"{folder}/{name}")


def read_stored(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stored table, or an empty one of its schema."""
    spec = CATALOG[name]
    try:
        return spark.read.schema(spec.schema).parquet(f"{folder}/{name}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spec.empty(spark)


def append_rows(rows: DataFrame, folder: str, name: str) -> None:
    spec = CATALOG[name]
    rows.select(*[f.name for f in spec.schema.fields]).write.mode("append").parquet(
        f"{folder}/{name}"
    )


def all_ids(table: DataFrame, spec: TableSpec) -> DataFrame:
    """The ids of all rows; empty for an empty table."""
    return table.select(spec.id_col)


def empty_need(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ", ".join(f"{c} {_NEED_TYPES[c]}" for c in NEED_COLUMNS))


def empty_gaps(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ", ".join(f"{c} {_NEED_TYPES[c]}" for c in FILL_COLUMNS))


def daily_parameters(spark: SparkSession) -> DataFrame:
    """The daily weather parameters with one day's extent, in order."""
    rows = [(i, *w) for i, w in enumerate(DAILY_WEATHER_TYPES, start=1)]
    return spark.createDataFrame(
        rows, "position long, weather_type string, units string, description string"
    ).select(
        "position", "weather_type",
        F.expr("interval '1 00:00:00' day to second").alias("temporal_extent"), "units",
        "description",
    )


def seed_weather_types(existing: DataFrame) -> DataFrame:
    """Rows to append so that all daily parameters are stored; ids follow the list."""
    wanted = daily_parameters(existing.sparkSession)
    fresh = wanted.join(existing.select("weather_type"), "weather_type", "left_anti")
    start = keyed.next_id(existing, CATALOG["weather_type"])
    from pyspark.sql import Window as W

    # a fixed list of eleven
    place = F.row_number().over(W.orderBy("position"))
    return fresh.select(
        (start + place - 1).cast("long").alias("weather_type_id"), "weather_type",
        "temporal_extent", "units", "description",
    )

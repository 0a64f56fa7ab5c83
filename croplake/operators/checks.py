"""Constraint checks: each gives the rows that break a rule, and nothing when all is well."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from croplake.catalog import DAILY_WEATHER_TYPES, NUTRIENTS, RASTER_SUBTYPES, TableSpec
from croplake.operators.ranking import null_safe_join
from croplake.operators.views import PARENT_IDS, owner_field

#: fixed value: what a unit may be called
UNIT_NAME_PATTERN = r"^[A-Za-z](.*[A-Za-z0-9])?$"


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def repeated_keys(rows: DataFrame, key: list[str], nulls_distinct: bool = False) -> DataFrame:
    """Keys held by more than one row, with ``n_rows``.

    Nulls equal nulls, unless ``nulls_distinct``: then a key with a null repeats nothing.
    """
    if nulls_distinct:
        rows = rows.dropna(subset=key)
    return rows.groupBy(*key).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def repeated_rows(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows of a table that share its unique key."""
    key = list(spec.unique_key)
    return null_safe_join(rows, repeated_keys(rows, key, spec.nulls_distinct), key)


def orphans(rows: DataFrame, fk: str, parent: DataFrame, parent_id: str) -> DataFrame:
    """Rows whose non-null ``fk`` names no parent row."""
    ids = parent.select(F.col(parent_id).alias("_parent"))
    return rows.filter(F.col(fk).isNotNull()).join(ids, F.col(fk) == F.col("_parent"), "left_anti")


def not_exactly_one_parent(rows: DataFrame, parents: tuple[str, ...] = PARENT_IDS) -> DataFrame:
    """Rows that name no parent or more than one."""
    filled = reduce(lambda a, b: a + b, [F.col(p).isNotNull().cast("int") for p in parents])
    return rows.filter(filled != 1)


def without_parent(rows: DataFrame, parents: tuple[str, ...] = PARENT_IDS) -> DataFrame:
    """The weaker rule of the row types: no parent at all (an id of 0 counts as none)."""
    return rows.filter(_any([F.coalesce(F.col(p), F.lit(0)) != 0 for p in parents]) == F.lit(False))


def outside_domain(rows: DataFrame, spec: TableSpec, null_fails: tuple[str, ...] = ()) -> DataFrame:
    """Rows with a value outside its column's list; a null fails only in ``null_fails``."""
    bad = []
    for column, values in spec.domains.items():
        if column in rows.columns:
            c = F.col(column)
            wrong = F.coalesce(~c.isin(*values), F.lit(column in null_fails))
            bad.append(wrong)
    return rows.filter(_any(bad))


def not_upper_case(rows: DataFrame, columns: tuple[str, ...] = ("crop", "product_name")) -> DataFrame:
    """Rows with a lower-case letter in one of ``columns``; nulls pass."""
    return rows.filter(_any([F.coalesce(F.col(c) != F.upper(c), F.lit(False)) for c in columns]))


def nutrients_out_of_range(nutrient_source: DataFrame) -> DataFrame:
    """Sources with a nutrient share outside 0 … 100."""
    return nutrient_source.filter(_any([~F.col(n).between(0, 100) for n in NUTRIENTS]))


def outside_field_dates(
    rows: DataFrame, date_col: str, field: DataFrame, field_trial: DataFrame, plot: DataFrame
) -> DataFrame:
    """Acts or apps dated outside their owning field's dates (both ends belong); no owner passes."""
    owned = owner_field(rows, field_trial, plot)
    dates = field.select(F.col("field_id").alias("_field"), "date_start", "date_end")
    return (
        owned.join(dates, F.col("owner_field_id") == F.col("_field"))
        .filter(~F.col(date_col).between(F.col("date_start"), F.col("date_end")))
        .drop("_field")
    )


def crop_type_missing(act: DataFrame) -> DataFrame:
    """Plantings and harvests without crop type."""
    return act.filter(F.col("act_type").isin("PLANT", "HARVEST") & F.col("crop_type_id").isNull())


def wrong_file_format(s3: DataFrame) -> DataFrame:
    """Files whose format is not the ending of their url."""
    ending = F.regexp_extract(F.lower("s3_url"), r"\.([^./]+)$", 1)
    return s3.filter(F.lower("file_format") != ending)


def observation_without_time(observation: DataFrame) -> DataFrame:
    """Observations with neither an act nor a date."""
    return observation.filter(F.col("act_id").isNull() & F.col("date_observed").isNull())


def wrong_raster_subtype(raster_meta: DataFrame) -> DataFrame:
    """Images whose subtype is not allowed for their type; type UNKNOWN takes any."""
    allowed = [
        (F.col("raster_type") == t) & F.col("raster_subtype").isin(*subtypes)
        for t, subtypes in RASTER_SUBTYPES.items() if t != "UNKNOWN"
    ]
    fine = _any(allowed + [F.col("raster_type") == "UNKNOWN"])
    return raster_meta.filter(~fine)


def bad_unit_names(unit_type: DataFrame) -> DataFrame:
    """Units whose name does not start with a letter or ends in a sign."""
    return unit_type.filter(~F.col("unit_name").rlike(UNIT_NAME_PATTERN))


def unit_of_other_type(observation: DataFrame, unit_type: DataFrame) -> DataFrame:
    """Observations whose unit is unknown or belongs to another observation type."""
    return observation.join(
        unit_type.select("unit_type_id", "observation_type_id"),
        ["unit_type_id", "observation_type_id"], "left_anti",
    )


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def require_columns(df: DataFrame, required: list[str], what: str) -> DataFrame:
    """``df``, or an error that names the columns it lacks; looks at the schema only."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"{what} lacks the columns {missing}")
    return df


def too_many_decimals(rows: DataFrame, columns: tuple[str, ...] = ("lat", "lon"), n: int = 5) -> DataFrame:
    """Rows with a coordinate of more than ``n`` decimals."""
    return rows.filter(_any([F.round(F.col(c), n) != F.col(c) for c in columns]))


def too_many_parameters(requests: DataFrame, limit: int = 10) -> DataFrame:
    """Requests for more parameters than one request may name."""
    return requests.filter(F.size("parameters") > limit)


def mixed_offsets(rows: DataFrame, key: list[str]) -> DataFrame:
    """Batches that mix several UTC offsets."""
    return (
        rows.groupBy(*key)
        .agg(F.min("utc_offset_seconds").alias("_lo"), F.max("utc_offset_seconds").alias("_hi"))
        .filter("_lo <> _hi")
        .select(*key)
    )


def unknown_weather_types(weather_type: DataFrame) -> DataFrame:
    """Weather types that are not among the daily parameters."""
    return weather_type.filter(~F.col("weather_type").isin(*[w[0] for w in DAILY_WEATHER_TYPES]))

"""Table catalogue: schemas, ids, natural keys, domains and references.

``lookup_key`` is what a keyed lookup compares (required columns, nulls matching nulls);
``unique_key`` is the uniqueness rule of the table. They differ where a column is optional: two
groupers of one name under different parents are both allowed, yet a lookup by name finds either.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---- fixed values: domains ------------------------------------------------------------------
ACT_TYPES = ("APPLY", "HARVEST", "MECHANICAL", "PLANT", "TILL")
APP_TYPES = (
    "BIOLOGICAL", "FERTILIZER", "FUNGICIDE", "HERBICIDE", "INHIBITOR", "INSECTICIDE",
    "IRRIGATION", "LIME", "MANURE", "NEMATICIDE", "STABILIZER",
)
APP_METHODS = ("BAND", "BROADCAST", "CULTIVATE", "DRY-DROP", "FOLIAR", "KNIFE", "SEED", "Y-DROP")
FILE_FORMATS = ("PARQUET", "TIF", "CSV", "GEOJSON", "JSON")
CATEGORIES = ("REMOTE_SENSING", "SOIL", "TISSUE", "GRAIN", "STOVER", "WEATHER", "SENSOR")
REQUEST_STATUSES = ("SUCCESS", "FAIL")
UTM_ROWS = tuple("ABCDEFGHJKLMNPQRSTUVWXYZ")
NUTRIENTS = ("n", "p2o5", "k2o", "s", "ca", "mg", "b", "cu", "fe", "mn", "mo", "zn", "ch")
RASTER_SUBTYPES = {
    "RAW": ("RGB", "MULTISPECTRAL", "THERMAL", "HYPERSPECTRAL"),
    "PRIMARY": ("RGB", "MULTISPECTRAL", "THERMAL", "HYPERSPECTRAL", "DEM", "INTERPOLATED"),
    "DERIVED": ("PREDICTION", "BANDMATH", "ELEVATION"),
    "UNKNOWN": (
        "RGB", "MULTISPECTRAL", "THERMAL", "HYPERSPECTRAL", "DEM", "INTERPOLATED",
        "PREDICTION", "BANDMATH", "ELEVATION",
    ),
}
#: Stands for "no end date".
INFINITY = "9999-12-31 23:59:59.999999"
#: (name, units, description) of the daily weather parameters, in id order.
DAILY_WEATHER_TYPES = (
    ("t_min_2m_24h:C", "degrees Celsius", "Lowest air temperature of the day, 2 m above ground"),
    ("t_max_2m_24h:C", "degrees Celsius", "Highest air temperature of the day, 2 m above ground"),
    ("t_mean_2m_24h:C", "degrees Celsius", "Mean air temperature of the day, 2 m above ground"),
    ("precip_24h:mm", "millimeters", "Precipitation of the day, liquid, mixed and solid"),
    ("wind_speed_mean_2m_24h:ms", "meters per second", "Mean wind speed, 2 m above ground"),
    ("relative_humidity_mean_2m_24h:p", "percent", "Mean relative humidity, 2 m above ground"),
    ("global_rad_24h:J", "Joules", "Global radiation of the day, diffuse and direct"),
    ("evapotranspiration_24h:mm", "millimeters", "Evapotranspiration of the day"),
    ("volumetric_soil_water_-50cm:m3m3", "cubic meters/cubic meters",
     "Soil water share at 28 to 100 cm depth"),
    ("soil_moisture_deficit:mm", "millimeters", "Field capacity minus soil water"),
    ("leaf_wetness:idx", "unitless", "1 where dew lies on the leaves"),
)
# ---------------------------------------------------------------------------------------------

_LONG, _STR, _DBL, _SHORT = T.LongType(), T.StringType(), T.DoubleType(), T.ShortType()
_TS, _DATE, _INT, _FLT = T.TimestampNTZType(), T.DateType(), T.IntegerType(), T.FloatType()
POINT = T.StructType([T.StructField("x", _DBL), T.StructField("y", _DBL)])
RINGS = T.ArrayType(T.ArrayType(POINT))

#: columns no lookup and no uniqueness rule looks at
DETAIL_COLUMNS = ("details", "created", "last_updated")
_DETAILS = [("details", _STR, True), ("created", _TS, True), ("last_updated", _TS, True)]


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    id_col: str | None = None
    lookup_key: tuple[str, ...] = ()
    unique_key: tuple[str, ...] = ()
    nulls_distinct: bool = False
    defaults: dict[str, str] = field(default_factory=dict)
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def data_columns(self) -> list[str]:
        """Columns without the id."""
        return [f.name for f in self.schema.fields if f.name != self.id_col]

    def empty(self, spark: SparkSession) -> DataFrame:
        """A table of this schema without rows."""
        return spark.createDataFrame([], self.schema)


def _spec(name, columns, *, detailed=False, **kw) -> TableSpec:
    columns = list(columns) + (_DETAILS if detailed else [])
    schema = T.StructType([T.StructField(n, t, null) for n, t, null in columns])
    defaults = dict(kw.pop("defaults", {}))
    if detailed:
        defaults.setdefault("details", "'{}'")
    return TableSpec(name=name, schema=schema, defaults=defaults, **kw)


_PARENTS = {
    "field_id": ("field", "field_id"),
    "field_trial_id": ("field_trial", "field_trial_id"),
    "plot_id": ("plot", "plot_id"),
    "geom_id": ("geom", "geom_id"),
}
_END = {"date_end": f"timestamp_ntz'{INFINITY}'"}

_SPECS = [
    _spec("geom",
          [("geom_id", _LONG, False), ("kind", _STR, False), ("rings", RINGS, False),
           ("canonical", _STR, False)],
          id_col="geom_id", lookup_key=("canonical",), unique_key=("canonical",)),
    _spec("organization", [("organization_id", _LONG, False), ("name", _STR, False)],
          detailed=True, id_col="organization_id", lookup_key=("name",)),
    _spec("grouper",
          [("grouper_id", _LONG, False), ("name", _STR, False), ("organization_id", _LONG, False),
           ("parent_grouper_id", _LONG, True)],
          detailed=True, id_col="grouper_id", lookup_key=("name", "organization_id"),
          unique_key=("name", "organization_id", "parent_grouper_id"),
          references={"organization_id": ("organization", "organization_id"),
                      "parent_grouper_id": ("grouper", "grouper_id")}),
    _spec("field",
          [("field_id", _LONG, False), ("name", _STR, False), ("date_start", _TS, False),
           ("date_end", _TS, False), ("geom_id", _LONG, False), ("organization_id", _LONG, False),
           ("grouper_id", _LONG, True)],
          detailed=True, id_col="field_id", defaults=_END,
          lookup_key=("name", "date_start", "date_end", "geom_id", "organization_id"),
          unique_key=("name", "date_start", "date_end", "geom_id", "organization_id"),
          references={"geom_id": ("geom", "geom_id"),
                      "organization_id": ("organization", "organization_id"),
                      "grouper_id": ("grouper", "grouper_id")}),
    _spec("field_trial",
          [("field_trial_id", _LONG, False), ("name", _STR, False), ("field_id", _LONG, False),
           ("date_start", _TS, False), ("date_end", _TS, False), ("geom_id", _LONG, True),
           ("grouper_id", _LONG, True)],
          detailed=True, id_col="field_trial_id", defaults=_END,
          lookup_key=("name", "field_id", "date_start", "date_end"),
          unique_key=("name", "field_id", "date_start", "date_end"),
          references={"field_id": ("field", "field_id"), "geom_id": ("geom", "geom_id"),
                      "grouper_id": ("grouper", "grouper_id")}),
    _spec("plot",
          [("plot_id", _LONG, False), ("name", _STR, False), ("field_id", _LONG, False),
           ("field_trial_id", _LONG, False), ("geom_id", _LONG, True),
           ("treatment_id", _SHORT, True), ("block_id", _SHORT, True),
           ("replication_id", _SHORT, True)],
          detailed=True, id_col="plot_id", nulls_distinct=True,
          lookup_key=("name", "field_id", "field_trial_id"),
          unique_key=("name", "field_id", "field_trial_id"),
          references={k: v for k, v in _PARENTS.items() if k != "plot_id"}),
    _spec("crop_type",
          [("crop_type_id", _LONG, False), ("crop", _STR, False), ("product_name", _STR, True)],
          detailed=True, id_col="crop_type_id", lookup_key=("crop", "product_name"),
          unique_key=("crop", "product_name")),
    _spec("act",
          [("act_id", _LONG, False), ("act_type", _STR, False), ("date_performed", _TS, False),
           ("crop_type_id", _LONG, True), ("field_id", _LONG, True),
           ("field_trial_id", _LONG, True), ("plot_id", _LONG, True), ("geom_id", _LONG, True)],
          detailed=True, id_col="act_id", domains={"act_type": ACT_TYPES},
          lookup_key=("act_type", "date_performed", "crop_type_id", "field_id", "field_trial_id",
                      "plot_id", "geom_id"),
          unique_key=("act_type", "date_performed", "crop_type_id", "field_id", "field_trial_id",
                      "plot_id", "geom_id"),
          references={**_PARENTS, "crop_type_id": ("crop_type", "crop_type_id")}),
    _spec("nutrient_source",
          [("nutrient_source_id", _LONG, False), ("nutrient", _STR, False),
           ("organization_id", _LONG, False)] + [(n, _DBL, False) for n in NUTRIENTS],
          detailed=True, id_col="nutrient_source_id",
          lookup_key=("nutrient", "organization_id") + NUTRIENTS,
          unique_key=("nutrient", "organization_id"),
          defaults={n: "0.0D" for n in NUTRIENTS},
          references={"organization_id": ("organization", "organization_id")}),
    _spec("app",
          [("app_id", _LONG, False), ("app_type", _STR, False), ("app_method", _STR, True),
           ("date_applied", _TS, False), ("rate", _DBL, False), ("rate_unit", _STR, False),
           ("crop_type_id", _LONG, True), ("nutrient_source_id", _LONG, True),
           ("field_id", _LONG, True), ("field_trial_id", _LONG, True), ("plot_id", _LONG, True),
           ("geom_id", _LONG, True)],
          detailed=True, id_col="app_id",
          domains={"app_type": APP_TYPES, "app_method": APP_METHODS},
          lookup_key=("app_type", "app_method", "date_applied", "rate", "rate_unit",
                      "crop_type_id", "nutrient_source_id", "field_id", "field_trial_id",
                      "plot_id", "geom_id"),
          unique_key=("app_type", "app_method", "date_applied", "rate", "rate_unit",
                      "crop_type_id", "nutrient_source_id", "field_id", "field_trial_id",
                      "plot_id", "geom_id"),
          references={**_PARENTS, "crop_type_id": ("crop_type", "crop_type_id"),
                      "nutrient_source_id": ("nutrient_source", "nutrient_source_id")}),
    _spec("s3",
          [("s3_id", _LONG, False), ("s3_url", _STR, False), ("file_format", _STR, False),
           ("organization_id", _LONG, False), ("category", _STR, True)],
          detailed=True, id_col="s3_id", unique_key=("s3_url",),
          lookup_key=("s3_url", "organization_id", "file_format", "category"),
          domains={"file_format": FILE_FORMATS, "category": CATEGORIES},
          references={"organization_id": ("organization", "organization_id")}),
    _spec("observation_type",
          [("observation_type_id", _LONG, False), ("observation_type_name", _STR, False),
           ("category", _STR, True)],
          detailed=True, id_col="observation_type_id",
          lookup_key=("observation_type_name", "category"),
          unique_key=("observation_type_name", "category"), domains={"category": CATEGORIES}),
    _spec("unit_type",
          [("unit_type_id", _LONG, False), ("unit_name", _STR, False),
           ("observation_type_id", _LONG, False)],
          id_col="unit_type_id", lookup_key=("unit_name", "observation_type_id"),
          unique_key=("unit_name", "observation_type_id"),
          references={"observation_type_id": ("observation_type", "observation_type_id")}),
    _spec("observation",
          [("observation_id", _LONG, False), ("field_id", _LONG, True),
           ("unit_type_id", _LONG, False), ("observation_type_id", _LONG, False),
           ("value_observed", _DBL, False), ("date_observed", _TS, True), ("geom_id", _LONG, True),
           ("act_id", _LONG, True)],
          detailed=True, id_col="observation_id",
          lookup_key=("field_id", "unit_type_id", "observation_type_id", "value_observed",
                      "date_observed", "geom_id", "act_id"),
          unique_key=("value_observed", "date_observed", "observation_type_id", "field_id",
                      "geom_id", "act_id"),
          references={"field_id": ("field", "field_id"),
                      "unit_type_id": ("unit_type", "unit_type_id"),
                      "observation_type_id": ("observation_type", "observation_type_id"),
                      "geom_id": ("geom", "geom_id"), "act_id": ("act", "act_id")}),
    _spec("geospatial_key",
          [("geospatial_key_id", _LONG, False), ("geom_id", _LONG, False),
           ("field_id", _LONG, True)],
          id_col="geospatial_key_id", lookup_key=("geom_id",), unique_key=("geom_id", "field_id")),
    _spec("temporal_key",
          [("temporal_key_id", _LONG, False), ("start_date", _DATE, False),
           ("end_date", _DATE, False)],
          id_col="temporal_key_id", lookup_key=("start_date", "end_date"),
          unique_key=("start_date", "end_date")),
    _spec("world_utm",
          [("world_utm_id", _INT, False), ("zone", _INT, False), ("row", _STR, False),
           ("utc_offset_seconds", _INT, False), ("raster_epsg", _INT, False)],
          id_col="world_utm_id", unique_key=("zone", "row"), nulls_distinct=True,
          domains={"row": UTM_ROWS}),
    _spec("weather_type",
          [("weather_type_id", _LONG, False), ("weather_type", _STR, False),
           ("temporal_extent", T.DayTimeIntervalType(), False), ("units", _STR, True),
           ("description", _STR, False)],
          id_col="weather_type_id", lookup_key=("weather_type",), unique_key=("weather_type",),
          nulls_distinct=True,
          domains={"weather_type": tuple(w[0] for w in DAILY_WEATHER_TYPES)}),
    _spec("daily",
          [("daily_id", _LONG, True), ("world_utm_id", _INT, False), ("cell_id", _LONG, False),
           ("date", _DATE, False), ("weather_type_id", _LONG, False), ("value", _FLT, True),
           ("date_requested", _TS, False)],
          id_col="daily_id",
          references={"weather_type_id": ("weather_type", "weather_type_id"),
                      "world_utm_id": ("world_utm", "world_utm_id")}),
    _spec("request_log",
          [("request_id", _LONG, True), ("zone", _INT, False), ("utm_request_id", _INT, False),
           ("n_pts_requested", _LONG, False), ("startdate", _TS, False), ("enddate", _TS, False),
           ("parameters", _STR, True), ("date_requested", _TS, False), ("status", _STR, False),
           ("request_seconds", _FLT, False)],
          id_col="request_id", domains={"status": REQUEST_STATUSES}),
    _spec("raster_simple",
          [("raster_id", _LONG, False), ("file_vendor_id", _STR, False),
           ("vendor_id_ancestry", _STR, False), ("captured_at", _TS, False),
           ("rings", RINGS, False), ("mosaic_name", _STR, False), ("mosaic_type", _STR, False)],
          id_col="raster_id"),
    _spec("collections",
          [("collection_id", _LONG, False), ("vendor_id", _STR, False),
           ("capture_start", _TS, False), ("capture_end", _TS, False), ("s3_path", _STR, False),
           ("sensor_make", _STR, True), ("sensor_model", _STR, True),
           ("hardware_other", _STR, True), ("created", _TS, True), ("uploaded", _TS, True)],
          id_col="collection_id"),
    _spec("raster_meta",
          [("rid", _LONG, False), ("raster_type", _STR, False), ("raster_subtype", _STR, False),
           ("collection_id", _LONG, False), ("vendor_id", _STR, False), ("s3_path", _STR, False)]
          + [(c, _STR, True) for c in ("profile", "tags_exif", "tags_xml", "tags_tifftag",
                                       "tags_derived", "tags_vendor", "workflow")]
          + [("rings", RINGS, False)],
          id_col="rid",
          domains={"raster_type": tuple(RASTER_SUBTYPES),
                   "raster_subtype": RASTER_SUBTYPES["UNKNOWN"]},
          references={"collection_id": ("collections", "collection_id")}),
    _spec("function_type",
          [("function_type_id", _LONG, False), ("function_type_name", _STR, False),
           ("function_subtype_name", _STR, True)],
          id_col="function_type_id", lookup_key=("function_type_name",),
          unique_key=("function_type_name", "function_subtype_name")),
    _spec("function",
          [("function_id", _LONG, False), ("function_name", _STR, False), ("major", _INT, False),
           ("minor", _INT, False), ("function_type_id", _LONG, False)],
          detailed=True, id_col="function_id",
          lookup_key=("function_name", "major", "function_type_id"),
          unique_key=("function_name", "major", "minor", "function_type_id")),
    _spec("execution", [("execution_id", _LONG, False), ("function_id", _LONG, False)],
          id_col="execution_id"),
    _spec("s3_type", [("s3_type_id", _LONG, False), ("type_name", _STR, False)],
          id_col="s3_type_id", lookup_key=("type_name",), unique_key=("type_name",)),
    _spec("s3_type_dataframe",
          [("s3_type_id", _LONG, False), ("driver", _STR, False),
           ("has_geometry", T.BooleanType(), False)],
          lookup_key=("s3_type_id", "driver", "has_geometry"), unique_key=("s3_type_id",)),
    _spec("s3_object",
          [("s3_object_id", _LONG, False), ("key", _STR, False), ("bucket_name", _STR, False),
           ("s3_type_id", _LONG, False)],
          id_col="s3_object_id", lookup_key=("key", "bucket_name", "s3_type_id")),
    _spec("s3_object_key",
          [("s3_object_id", _LONG, False), ("geospatial_key_id", _LONG, False),
           ("temporal_key_id", _LONG, False)],
          lookup_key=("s3_object_id", "geospatial_key_id", "temporal_key_id"),
          unique_key=("s3_object_id", "geospatial_key_id", "temporal_key_id")),
    _spec("http_type",
          [("http_type_id", _LONG, False), ("type_name", _STR, False), ("verb", _STR, False),
           ("uri", _STR, False), ("uri_parameters", T.ArrayType(_STR), True),
           ("request_body_schema", _STR, True)],
          id_col="http_type_id", lookup_key=("type_name", "verb", "uri")),
    _spec("execution_key",
          [("execution_id", _LONG, False), ("geospatial_key_id", _LONG, False),
           ("temporal_key_id", _LONG, False)],
          lookup_key=("execution_id", "geospatial_key_id", "temporal_key_id")),
]

#: argument families of an execution and the columns each one carries beyond the two ids
ARGUMENT_FAMILIES = {
    "observation_argument": [("observation_type_id", _LONG, False),
                             ("number_of_observations", _LONG, False)],
    "http_argument": [("http_type_id", _LONG, False), ("number_of_observations", _LONG, False)],
    "s3_input_argument": [("s3_type_id", _LONG, False), ("s3_object_id", _LONG, False)],
    "s3_output_argument": [("s3_output_parameter_name", _STR, False), ("s3_type_id", _LONG, False),
                           ("s3_object_id", _LONG, False)],
    "keyword_argument": [("keyword_name", _STR, False), ("value_number", _DBL, True),
                         ("value_string", _STR, True)],
}
#: parameter families of a function
PARAMETER_FAMILIES = {
    "observation_parameter": [("observation_type_id", _LONG, False)],
    "http_parameter": [("http_type_id", _LONG, False)],
    "s3_input_parameter": [("s3_type_id", _LONG, False)],
    "s3_output_parameter": [("s3_output_parameter_name", _STR, False),
                            ("s3_type_id", _LONG, False)],
    "keyword_parameter": [("keyword_name", _STR, False), ("keyword_type", _STR, False)],
}
for _name, _cols in ARGUMENT_FAMILIES.items():
    _ids = [("function_id", _LONG, False), ("execution_id", _LONG, False)]
    _SPECS.append(_spec(_name, _ids + _cols, lookup_key=tuple(c[0] for c in _ids + _cols)))
for _name, _cols in PARAMETER_FAMILIES.items():
    _ids = [("function_id", _LONG, False)]
    _SPECS.append(_spec(_name, _ids + _cols, lookup_key=tuple(c[0] for c in _ids + _cols)))

CATALOG: dict[str, TableSpec] = {s.name: s for s in _SPECS}

#: The tables a plain set-up must hold.
CORE_TABLES = ("act", "app", "crop_type", "field", "field_trial", "geom", "grouper",
               "nutrient_source", "plot", "organization", "s3")


def table_differences(present: list[str]) -> dict[str, list[str]]:
    """Core tables that are missing, and tables nobody asked for."""
    return {
        "missing": sorted(set(CORE_TABLES) - set(present)),
        "unexpected": sorted(set(present) - set(CORE_TABLES)),
    }

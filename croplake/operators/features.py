"""Observation summaries, feature columns, feature matrices and data for keys."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from croplake.operators.hierarchy import three_levels
from croplake.operators.ranking import (
    batches, null_safe_join, numbered, with_previous_time,
)
from croplake.session import cut_lineage, shuffled

#: observations, operations and plantings up to this moment are left out
EARLIEST = "2000-01-01 00:00:00"


def _with_group(observation: DataFrame) -> DataFrame:
    if "observation_grouper_id" in observation.columns:
        return observation
    return observation.withColumn("observation_grouper_id", F.lit(None).cast("long"))


def type_summary(
    observation: DataFrame, field: DataFrame, unit_type: DataFrame, observation_type: DataFrame,
    observation_group: DataFrame, fields: DataFrame | None = None,
) -> DataFrame:
    """Per observation type: its units and groups with counts and first and last date.

    Rows are counted before anything is joined or listed; the lists are as long as the unit and
    group dimensions.
    """
    known = field.select("field_id") if fields is None else fields.select("field_id").join(
        field.select("field_id"), "field_id", "left_semi"
    )
    # counted per field first, so that what meets the fields is small and no field is hot
    per_field = _with_group(observation).groupBy(
        "field_id", "unit_type_id", "observation_grouper_id"
    ).agg(
        F.count("*").alias("n"), F.min("date_observed").alias("lo"),
        F.max("date_observed").alias("hi"),
    )
    counted = per_field.join(known, "field_id", "left_semi").groupBy(
        "unit_type_id", "observation_grouper_id"
    ).agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    typed = counted.join(unit_type, "unit_type_id").join(observation_type, "observation_type_id")
    span = [
        F.sum("n").alias("count"), F.to_date(F.min("lo")).alias("earliest"),
        F.to_date(F.max("hi")).alias("latest"),
    ]
    per_unit = typed.groupBy("observation_type_id", "unit_type_id", "unit_name").agg(*span)
    units = per_unit.groupBy("observation_type_id").agg(
        F.sum("count").alias("value_count"),
        F.array_sort(
            F.collect_list(F.struct("unit_type_id", "unit_name", "count", "earliest", "latest"))
        ).alias("units"),
    )
    per_group = typed.join(observation_group, "observation_grouper_id").groupBy(
        "observation_type_id", "observation_grouper_id", "group_name", "group_category"
    ).agg(*span)
    groups = per_group.groupBy("observation_type_id").agg(
        F.array_sort(
            F.collect_list(
                F.struct("observation_grouper_id", "group_name", "group_category", "count",
                         "earliest", "latest")
            )
        ).alias("groups")
    )
    no_groups = F.array().cast(groups.schema["groups"].dataType)
    return (
        observation_type.join(units, "observation_type_id")
        .join(groups, "observation_type_id", "left")
        .withColumn("groups", F.coalesce("groups", no_groups))
        .select(
            "observation_type_id", "observation_type_name", "category", "value_count", "units",
            F.size("units").alias("unit_count"), "groups", F.size("groups").alias("group_count"),
        )
        .orderBy(
            F.asc_nulls_last("observation_type_name"), F.asc_nulls_last("category"),
            F.desc("value_count"), F.desc("unit_count"),
        )
    )


def select_observations(
    observation: DataFrame, field: DataFrame, unit_type: DataFrame, observation_type: DataFrame,
    observation_group: DataFrame | None = None, type_ids: list[int] | None = None,
    fields: DataFrame | None = None,
) -> DataFrame:
    """Observations since 2000 with unit, type and group names; no list means no filter.

    ``details`` is JSON text, null where the table has no such column.
    """
    if "details" not in observation.columns:
        observation = observation.withColumn("details", F.lit(None).cast("string"))
    rows = _with_group(observation).filter(
        F.col("date_observed") > F.lit(EARLIEST).cast("timestamp_ntz")
    ).drop("observation_type_id")
    units = unit_type.join(observation_type, "observation_type_id")
    if type_ids:
        units = units.filter(F.col("observation_type_id").isin(*type_ids))
    rows = rows.join(field.select("field_id"), "field_id", "left_semi")
    if fields is not None:
        rows = rows.join(fields.select("field_id"), "field_id", "left_semi")
    rows = rows.join(units, "unit_type_id")
    if observation_group is not None:
        names = observation_group.select("observation_grouper_id", "group_name")
        rows = rows.join(names, "observation_grouper_id", "left")
    else:
        rows = rows.withColumn("group_name", F.lit(None).cast("string"))
    return rows.select(
        "field_id", "observation_type_name", "category", "observation_type_id", "unit_name",
        "unit_type_id", "observation_id", F.col("date_observed").alias("acquired"),
        F.col("value_observed").alias("quantity"), "group_name", "details",
    )


def time_ordinals(rows: DataFrame) -> DataFrame:
    """(type, unit, acquired) with ``time_id``: the ordinal of the moment within type and unit.

    There are few types and each holds a large share of all rows, so moments are numbered in
    buckets and the buckets are put end to end.
    """
    moments = rows.select("observation_type_id", "unit_type_id", "acquired").distinct()
    return numbered(
        moments, ["observation_type_id", "unit_type_id"], ["acquired"], "time_id",
    )


def unit_ordinals(rows: DataFrame) -> DataFrame:
    """(type, unit) with ``unit_id``: 1, 2, … by ids. A dimension, so one window is enough."""
    from pyspark.sql import Window as W

    pairs = rows.select("observation_type_id", "unit_type_id").distinct()
    order = W.orderBy("observation_type_id", "unit_type_id")
    return pairs.withColumn("unit_id", F.row_number().over(order).cast("long"))


def first_per_group(rows: DataFrame, keys: list[str], time_col: str, id_col: str) -> DataFrame:
    """The first row of each group, by time and then id; reduced in every task first."""
    rest = [c for c in rows.columns if c not in keys]
    row = F.min_by(F.struct(*rest), F.struct(time_col, id_col)).alias("_row")
    return rows.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*rows.columns)


def first_per_run(
    rows: DataFrame, keys: list[str], time_col: str, id_col: str, tolerance: str
) -> DataFrame:
    """Rows that start a run: those more than ``tolerance`` after the row before in their group.

    Rows at one moment count once (smallest id), which leaves distinct times to look back on.
    """
    single = first_per_group(rows, [*keys, time_col], time_col, id_col)
    seen = with_previous_time(single, keys, time_col, "_previous")
    starts = F.col("_previous").isNull() | (
        F.col(time_col) - F.col("_previous") > F.expr(f"interval {tolerance}")
    )
    return seen.filter(starts).drop("_previous")


def deduplicated(
    rows: DataFrame, keys: list[str], time_col: str, id_col: str, tolerance: str, mode: str = "runs"
) -> DataFrame:
    """Near-repeats removed: ``mode="runs"`` uses the tolerance, ``"first"`` keeps one per group."""
    if mode == "first":
        return first_per_group(rows, keys, time_col, id_col)
    if mode == "runs":
        return first_per_run(rows, keys, time_col, id_col, tolerance)
    raise ValueError('mode must be "runs" or "first"')


FEATURE_KEY = ["field_id", "observation_type_id", "unit_type_id", "quantity"]


def feature_rows(rows: DataFrame, mode: str = "runs", tolerance: str = "18 hours") -> DataFrame:
    """Deduplicated observations with ``time_id``, ``unit_id`` and ``column_name`` type.unit.time.

    ``rows`` are read for the runs, the moments and the units, so they are computed once and written.
    """
    if "details" not in rows.columns:
        rows = rows.withColumn("details", F.lit(None).cast("string"))
    rows = cut_lineage(rows)
    kept = deduplicated(rows, FEATURE_KEY, "acquired", "observation_id", tolerance, mode)
    times, units = time_ordinals(rows), unit_ordinals(rows)
    name = F.concat_ws(
        ".", "observation_type_name", "unit_name", F.col("time_id").cast("string")
    )
    return (
        kept.join(times, ["observation_type_id", "unit_type_id", "acquired"])
        .join(units, ["observation_type_id", "unit_type_id"])
        .withColumn("column_name", name)
    )


def feature_record(details: Column | None = None) -> Column:
    """The nested record of a feature row; ``details`` are JSON text unless given otherwise."""
    own = F.col("details") if details is None else details
    return F.struct(
        "field_id", "quantity", own.alias("details"), "acquired", "observation_type_id", "observation_type_name",
        "unit_type_id", "unit_name",
        F.struct("time_id", "unit_id", "column_name").alias("internal_ids"),
    )


def feature_json(features: DataFrame) -> DataFrame:
    """The records as JSON, with the details as an object; text that is no JSON is left out."""
    record = feature_record(F.try_parse_json("details"))
    return features.select("observation_id", F.to_json(record).alias("column"))


def column_values(features: DataFrame) -> DataFrame:
    """One value per column name: the last one, by time and then id."""
    last = F.max_by("quantity", F.struct("acquired", "observation_id")).alias("quantity")
    return features.groupBy("column_name").agg(last)


def features_per_field(features: DataFrame, batch_size: int = 1000) -> DataFrame:
    """A field's features as arrays of at most ``batch_size`` records: field_id, batch, features."""
    with_record = features.select(
        "field_id", "acquired", "observation_id", F.struct(feature_record()).alias("_record")
    )
    packed = batches(
        with_record, ["field_id"], ["acquired", "observation_id"], ["_record"], batch_size, "_rows",
    )
    return packed.select(
        "field_id", "batch",
        F.transform("_rows", lambda r: r["_record"].getField("col1")).alias("features"),
    )


def feature_pivot(features: DataFrame, columns: list[str]) -> DataFrame:
    """Fields × the named feature columns, with the last value of each."""
    last = F.max_by("quantity", F.struct("acquired", "observation_id"))
    return (
        features.filter(F.col("column_name").isin(*columns))
        .groupBy("field_id").pivot("column_name", columns).agg(last)
    )


# ---- field documents ------------------------------------------------------------------------
def field_events(
    rows: DataFrame, names: list[str], time_col: str, id_col: str, mode: str = "runs",
    tolerance: str = "6 hours",
) -> DataFrame:
    """Deduplicated operations or plantings since 2000: field_id, names, performed.

    Operations are deduplicated per field and name, plantings per field; both by passing rows that
    hold exactly these columns.
    """
    recent = rows.filter(F.col(time_col) > F.lit(EARLIEST).cast("timestamp_ntz"))
    kept = deduplicated(recent, ["field_id", *names], time_col, id_col, tolerance, mode)
    return kept.select("field_id", *names, F.col(time_col).alias("performed"), id_col)


def field_documents(
    field: DataFrame, grouper: DataFrame, operations: DataFrame, plantings: DataFrame,
    batch_size: int = 1000,
) -> DataFrame:
    """JSON documents per field: name, farm, region and country, operations and plantings.

    ``operations`` (field_id, name, performed) and ``plantings`` (field_id, crop, product_name,
    performed) are listed in batches of at most ``batch_size`` events, one document per batch; a
    field with few events has one document. In a document every operation and every planting of a crop
    and product comes once, with the list of its times, in the order in which they first occur.
    Fields without three group levels drop.
    """
    places = three_levels(grouper)
    ops = operations.filter("name is not null and performed is not null").select(
        "field_id", "performed", F.lit("operation").alias("kind"), F.col("name").alias("what"),
        F.lit(None).cast("string").alias("detail"),
    )
    plants = plantings.filter("crop is not null and performed is not null").select(
        "field_id", "performed", F.lit("planting").alias("kind"), F.col("crop").alias("what"),
        F.col("product_name").alias("detail"),
    )
    packed = batches(
        ops.unionByName(plants), ["field_id"], ["performed", "kind", "what", "detail"],
        ["kind", "what", "detail", "performed"], batch_size, "events",
    )
    named = field.select("field_id", F.col("name").alias("field_name"), "grouper_id").join(
        places, "grouper_id"
    )

    def of_kind(kind: str, record: Callable[[Column, Column], Column]) -> Column:
        mine = F.filter("events", lambda e: e["kind"] == kind)
        names = F.array_distinct(
            F.transform(mine, lambda e: F.struct(e["what"].alias("what"), e["detail"].alias("detail")))
        )

        def times(n: Column) -> Column:
            own = F.filter(mine, lambda e: (e["what"] == n["what"]) & e["detail"].eqNullSafe(n["detail"]))
            return F.transform(own, lambda e: e["performed"]).alias("performed")

        return F.transform(names, lambda n: record(n, times(n)))

    ops_list = of_kind("operation", lambda n, times: F.struct(n["what"].alias("name"), times))
    plant_list = of_kind(
        "planting",
        lambda n, times: F.struct(n["what"].alias("crop"), n["detail"].alias("product_name"), times),
    )
    return named.join(packed, "field_id", "left").select(
        "field_id",
        F.coalesce("batch", F.lit(0).cast("long")).alias("batch"),
        F.to_json(
            F.struct(
                ops_list.alias("operations"), plant_list.alias("plantings"), "field_name",
                "farm_name", "region_name", "country_name",
            )
        ).alias("field_meta"),
    )


# ---- data for keys --------------------------------------------------------------------------
def key_product(geospatial: DataFrame, temporal: DataFrame, slots: int = 16) -> DataFrame:
    """Every geospatial key with every temporal key; the product is the result here.

    Temporal keys are dealt into ``slots`` and each geospatial key goes to every slot, so the
    product is built by many tasks, also when one side is a single key.
    """
    dealt = temporal.withColumn(
        "_slot", F.pmod(F.xxhash64(*temporal.columns), F.lit(slots)).cast("int")
    )
    spread = geospatial.withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    return spread.join(dealt, "_slot").drop("_slot")


def observations_for_keys(
    observation: DataFrame, unit_type: DataFrame, geospatial: DataFrame, temporal: DataFrame,
    slots: int = 16,
) -> DataFrame:
    """Observations strictly inside a temporal key, of a geospatial key's geometry and field.

    The key product is not built: observations meet their geospatial keys by geometry and field,
    and then the temporal keys whose months they fall into. There are few months, so observations
    of a month are spread over ``slots`` and the (few) temporal keys go to each of them.
    """
    units = unit_type.select("unit_type_id", "unit_name", "observation_type_id")
    geo = geospatial.select("geospatial_key_id", "geom_id", "field_id")
    months = F.sequence(
        F.trunc("start_date", "MM"), F.trunc("end_date", "MM"), F.expr("interval 1 month")
    )
    spans = temporal.filter("start_date <= end_date").select(
        "temporal_key_id", "start_date", "end_date", F.explode(months).alias("_month")
    ).withColumn("_slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    at = F.col("date_observed")
    return (
        observation.drop("observation_type_id")
        .join(geo, ["geom_id", "field_id"])
        .join(units, "unit_type_id")
        .withColumn("_month", F.trunc(F.to_date("date_observed"), "MM"))
        .withColumn("_slot", F.pmod(F.xxhash64("observation_id"), F.lit(slots)).cast("int"))
        .join(spans, ["_month", "_slot"])
        .filter(
            (at > F.col("start_date").cast("timestamp_ntz"))
            & (at < F.col("end_date").cast("timestamp_ntz"))
        )
        .drop("_month", "_slot")
    )


def observation_counts(rows: DataFrame, types: DataFrame) -> DataFrame:
    """Rows found per wanted observation type, 0 where none was."""
    found = rows.groupBy("observation_type_id").agg(F.count("*").alias("_n"))
    return types.select("observation_type_id").distinct().join(
        found, "observation_type_id", "left"
    ).select(
        "observation_type_id", F.coalesce("_n", F.lit(0)).cast("long").alias("number_of_observations")
    )


def geometry_for_keys(geom: DataFrame, geospatial: DataFrame) -> DataFrame:
    return geom.join(geospatial.select("geom_id"), "geom_id", "left_semi")


def latest_object(
    s3_object: DataFrame, s3_object_key: DataFrame, keys: DataFrame, by: list[str] | None = None
) -> DataFrame:
    """The newest stored object per type for a set of keys, with the number of keys it matched.

    ``keys`` names key pairs and, in ``by``, the set each belongs to; the newest object has the
    largest id. ``n_objects`` above 1 reports that older ones matched too.
    """
    by = by or []
    pair = ["geospatial_key_id", "temporal_key_id"]
    # a pair listed twice still matches once
    hits = s3_object_key.join(keys.select(*by, *pair).distinct(), pair)
    per_object = hits.groupBy(*by, "s3_object_id").agg(F.count("*").alias("n_keys"))
    typed = per_object.join(s3_object, "s3_object_id")
    newest = F.max_by(
        F.struct("s3_object_id", "key", "bucket_name", "n_keys"), "s3_object_id"
    ).alias("_row")
    return typed.groupBy(*by, "s3_type_id").agg(
        newest, F.count("*").alias("n_objects")
    ).select(*by, "s3_type_id", "_row.*", "n_objects")


# ---- feature matrix -------------------------------------------------------------------------
class FrameSet:
    """Named DataFrames of a run, joined into one matrix over the geometry rows.

    ``frames`` are joined on geom_id; ``geo_frames`` (with ``rings``) by spatial intersection.
    """

    GEOM = "GEOM"

    def __init__(self, geometry: DataFrame):
        self.geometry = geometry
        self.frames: dict[str, DataFrame] = {}
        self.geo_frames: dict[str, DataFrame] = {}

    def add(self, name: str, df: DataFrame, geo: bool = False) -> None:
        if name in self.frames or name in self.geo_frames or name == self.GEOM:
            raise ValueError(f"there already is a frame {name}")
        (self.geo_frames if geo else self.frames)[name] = df

    def _take(self, name: str) -> tuple[list[str], DataFrame, bool]:
        if name == self.GEOM:
            return [name], self.geometry, True
        for store, geo in ((self.geo_frames, True), (self.frames, False)):
            for held in list(store):
                if name == held or name in held.split("+"):
                    return held.split("+"), store.pop(held), geo
        raise KeyError(f"no frame named {name}")

    def join(self, left: str, right: str,
             join_fn: Callable[[DataFrame, DataFrame], DataFrame] | None = None) -> None:
        """Replace two frames by their join; later joins find the result under either name.

        Without ``join_fn`` two geo frames meet where they intersect, others on common columns.
        """
        from croplake.operators.spatial import spatial_join

        l_names, l, l_geo = self._take(left)
        r_names, r, r_geo = self._take(right)
        if join_fn is not None:
            out = join_fn(l, r)
        elif l_geo and r_geo:
            out = spatial_join(l, r, suffix=f"_{right}")
        else:
            out = l.join(shuffled(r), [c for c in l.columns if c in r.columns])
        geo = "rings" in out.columns
        (self.geo_frames if geo else self.frames)["+".join(l_names + r_names)] = out

    def matrix(self) -> DataFrame:
        """Geometry rows with every frame: inner joins on geom_id, then spatial joins."""
        from croplake.operators.spatial import spatial_join

        out = reduce(lambda a, b: a.join(shuffled(b), "geom_id"), self.frames.values(), self.geometry)
        for name, df in self.geo_frames.items():
            out = spatial_join(out, df, suffix=f"_{name}")
        return out


def with_key_ids(keys: DataFrame, geospatial_ids: DataFrame, temporal_ids: DataFrame) -> DataFrame:
    """Key rows with the ids of their two halves; a null field matches a null field."""
    out = null_safe_join(keys, geospatial_ids, ["geom_id", "field_id"])
    return out.join(temporal_ids, ["start_date", "end_date"])

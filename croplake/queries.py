"""The registered queries: every operator over whole input tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from croplake.catalog import CATALOG, NUTRIENTS, RASTER_SUBTYPES, TableSpec
from croplake.fixtures import ACT_SHAPES, EVENT_TYPES, NOW, SEGMENTS, Tables, ntz
from croplake.functions import timeops
from croplake.operators import checks, features, grid, hierarchy, keyed, lineage, spatial, views
from croplake.operators import weather as w
from croplake.plans import daily, ingest, requests
from croplake.sources import files, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
    return fn


# ---- views ----------------------------------------------------------------------------------
@query
def plot_details(t: Tables) -> DataFrame:
    rows = views.plot_details(t.plot, t.field_trial, t.field, t.geom)
    return rows.select(
        "organization_id", "field_id", "field_trial_id", "plot_id", "name_plot",
        F.col("treatment_id").cast("int").alias("treatment_id"),
        F.col("block_id").cast("int").alias("block_id"),
        "date_start_field_trial", "date_end_field_trial",
        F.round(F.col("geometry")[0][0]["x"], 6).alias("lon"),
    )


def _plots(t: Tables) -> DataFrame:
    return views.plot_details_geometry(t.plot, t.field_trial, t.field, t.geom, t.organization)


@query
def plot_details_geometry(t: Tables) -> DataFrame:
    return _plots(t).select(
        "organization", "field", "field_trial", "plot", "organization_id", "field_id",
        "field_trial_id", "plot_id",
    )


@query
def plot_application_summary(t: Tables) -> DataFrame:
    return views.plot_application_summary(_plots(t), t.app, t.nutrient_source).select(
        "plot_id", "app_id", "nutrient_source_id", "rate_product", "rate_n", "rate_k2o"
    )


@query
def plot_nutrient_totals(t: Tables) -> DataFrame:
    rows = views.plot_nutrient_totals(_plots(t), t.app, t.nutrient_source)
    return rows.select(
        "organization_id", "plot_id", "nutrient_source_id", "n_apps",
        F.round("rate_product", 6).alias("rate_product"),
        *[F.round(f"rate_{n}", 6).alias(f"rate_{n}") for n in NUTRIENTS],
    )


@query
def season_length(t: Tables) -> DataFrame:
    return views.season_length(t.act, t.field, t.field_trial, t.plot).drop("season_length")


@query
def owner_field(t: Tables) -> DataFrame:
    return views.owner_field(t.act, t.field_trial, t.plot).select("act_id", "owner_field_id")


# ---- checks ---------------------------------------------------------------------------------
@query
def acts_outside_field_window(t: Tables) -> DataFrame:
    return checks.outside_field_dates(
        t.act, "date_performed", t.field, t.field_trial, t.plot
    ).select("act_id", "owner_field_id", "date_performed")


@query
def apps_outside_field_window(t: Tables) -> DataFrame:
    return checks.outside_field_dates(
        t.app, "date_applied", t.field, t.field_trial, t.plot
    ).select("app_id", "owner_field_id")


@query
def unique_null_safe_violations(t: Tables) -> DataFrame:
    again = t.grouper.unionByName(t.grouper.filter("grouper_id % 3 = 0"))
    return checks.repeated_keys(again, list(CATALOG["grouper"].unique_key))


@query
def orphan_rows(t: Tables) -> DataFrame:
    broken = t.field_trial.withColumn(
        "field_id",
        F.when(F.col("field_trial_id") % 97 == 0, F.col("field_id") + 100000000)
        .otherwise(F.col("field_id")),
    )
    return checks.orphans(broken, "field_id", t.field, "field_id").select(
        "field_trial_id", "field_id"
    )


@query
def exactly_one_parent(t: Tables) -> DataFrame:
    keep, two = F.col("app_id") % 89 != 0, F.col("app_id") % 53 == 0
    broken = t.app.select(
        "app_id",
        F.when(keep, F.col("field_id")).alias("field_id"),
        F.when(keep, F.col("field_trial_id")).alias("field_trial_id"),
        F.when(keep & two, F.lit(1).cast("long")).when(keep, F.col("plot_id")).alias("plot_id"),
    )
    filled = sum(
        (F.col(c).isNotNull().cast("int") for c in checks.PARENT_IDS), F.lit(0)
    )
    return checks.not_exactly_one_parent(broken).select("app_id", filled.alias("n_parents"))


@query
def enum_domain_violations(t: Tables) -> DataFrame:
    return checks.outside_domain(t.s3, CATALOG["s3"]).select("s3_id", "file_format", "category")


@query
def uppercase_violations(t: Tables) -> DataFrame:
    crops = t.raw("part").select(
        F.col("p_partkey").alias("crop_type_id"), F.col("p_name").alias("crop"),
        F.col("p_type").alias("product_name"),
    )
    return checks.not_upper_case(crops).select("crop_type_id")


@query
def nutrient_range_violations(t: Tables) -> DataFrame:
    return checks.nutrients_out_of_range(t.nutrient_source_out_of_range).select(
        "nutrient_source_id", "n"
    )


@query
def crop_type_missing(t: Tables) -> DataFrame:
    return checks.crop_type_missing(t.act).select("act_id")


@query
def file_format_mismatch(t: Tables) -> DataFrame:
    return checks.wrong_file_format(t.s3).select("s3_id")


@query
def unit_of_other_type(t: Tables) -> DataFrame:
    broken = t.observation.withColumn(
        "unit_type_id",
        F.when(F.col("observation_id") % 41 == 0, F.col("unit_type_id") + 10)
        .otherwise(F.col("unit_type_id")),
    )
    return checks.unit_of_other_type(broken, t.unit_type).select("observation_id")


@query
def observation_without_time(t: Tables) -> DataFrame:
    key = F.col("observation_id")
    broken = t.observation.withColumn(
        "date_observed", F.when(key % 2 != 0, F.col("date_observed"))
    ).withColumn("act_id", F.when(key % 3 != 0, key))
    return checks.observation_without_time(broken).select("observation_id")


# ---- keyed tables ---------------------------------------------------------------------------
@query
def natural_key_lookup(t: Tables) -> DataFrame:
    """Suppliers looked up among customers by nation and segment; every sixth segment is unknown."""
    spec = TableSpec("segment", CATALOG["organization"].schema, "id", ("nation", "segment"))
    stored = t.raw("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
    )
    names = F.array(*[F.lit(v) for v in (*SEGMENTS, "NONE")])
    rows = t.raw("supplier").select(
        F.col("s_suppkey").alias("candidate"), F.col("s_nationkey").alias("nation"),
        F.element_at(names, (F.col("s_suppkey") % 6 + 1).cast("int")).alias("segment"),
    )
    return keyed.find_ids(stored, rows, spec).select("candidate", F.col("id").alias("found_id"))


@query
def insert_or_get(t: Tables) -> DataFrame:
    spec = CATALOG["crop_type"]
    parts = t.raw("part").select(
        F.col("p_partkey").alias("candidate"), "p_size", F.col("p_brand").alias("crop"),
        F.col("p_type").alias("product_name"),
    )
    stored = parts.filter("p_size <= 10").select(
        F.col("candidate").alias("crop_type_id"), "crop", "product_name"
    )
    fresh, found = keyed.insert_or_get(
        stored, parts.select("candidate", "crop", "product_name"), spec, NOW
    )
    top = stored.agg(F.max("crop_type_id").alias("m")).scalar()
    is_new = F.col("crop_type_id") > top
    n_new = fresh.agg(F.count("*").alias("n")).scalar()
    first = fresh.agg(F.min("crop_type_id").alias("n")).scalar()
    last = fresh.agg(F.max("crop_type_id").alias("n")).scalar()
    return found.select(
        "candidate", F.when(~is_new, F.col("crop_type_id")).alias("known_id"),
        is_new.cast("int").alias("is_new"), n_new.alias("n_new"),
        F.when(is_new, first).alias("first_new_id"), F.when(is_new, last).alias("last_new_id"),
    )


@query
def rows_by_id(t: Tables) -> DataFrame:
    wanted = t.raw("orders").select(F.col("o_custkey").alias("field_id")).distinct()
    return keyed.rows_by_id(t.field, wanted, CATALOG["field"]).select("field_id", "name")


@query
def rows_by_key(t: Tables) -> DataFrame:
    """Customers of the nations and segments that suppliers' numbers name."""
    names = F.array(*[F.lit(v) for v in SEGMENTS])
    keys = t.raw("supplier").select(
        F.col("s_nationkey").alias("c_nationkey"),
        F.element_at(names, (F.col("s_suppkey") % 5 + 1).cast("int")).alias("c_mktsegment"),
    )
    return keyed.rows_by_key(t.raw("customer"), keys, ["c_nationkey", "c_mktsegment"]).select("c_custkey")


@query
def key_rows(t: Tables) -> DataFrame:
    """Object key links to append: those of the orders that the line items' orders do not have."""
    spec = CATALOG["s3_object_key"]
    stored = t.raw("lineitem").filter("l_shipdate < '1997-01-01'").select(
        F.col("l_orderkey").alias("s3_object_id"), F.col("l_partkey").alias("geospatial_key_id"),
        F.col("l_suppkey").alias("temporal_key_id"),
    )
    asked = t.raw("lineitem").select(
        F.col("l_orderkey").alias("s3_object_id"), F.col("l_partkey").alias("geospatial_key_id"),
        F.col("l_suppkey").alias("temporal_key_id"),
    )
    return keyed.insert_missing(stored, asked, spec)


@query
def insert_missing(t: Tables) -> DataFrame:
    spec = TableSpec("kind", CATALOG["s3_object_key"].schema, None, ("s3_object_id",), ("s3_object_id",))
    stored = t.raw("nation").filter("n_regionkey < 3").select(
        F.col("n_nationkey").cast("long").alias("s3_object_id")
    )
    asked = t.raw("supplier").select(F.col("s_nationkey").cast("long").alias("s3_object_id"))
    return keyed.insert_missing(stored, asked, spec).select(
        F.col("s3_object_id").cast("int").alias("key")
    )


@query
def apply_updates(t: Tables) -> DataFrame:
    stored = t.raw("customer").select(
        F.col("c_custkey").alias("organization_id"), F.col("c_name").alias("name"),
        ntz("2020-01-01 00:00:00").alias("last_updated"),
    )
    changed = t.raw("customer").filter("c_acctbal < 0").select(
        F.col("c_custkey").alias("organization_id"), F.upper("c_name").alias("name")
    )
    return keyed.apply_updates(stored, changed, CATALOG["organization"], NOW)


@query
def next_version(t: Tables) -> DataFrame:
    stored = t.raw("supplier").select(
        (F.col("s_nationkey") % 5).alias("function_name"),
        (F.col("s_suppkey") % 3).alias("major"), F.lit(1).alias("function_type_id"),
        (F.col("s_suppkey") % 20).alias("minor"),
    )
    asked = t.raw("customer").select(
        (F.col("c_nationkey") % 5).alias("function_name"),
        (F.col("c_custkey") % 3).alias("major"), F.lit(1).alias("function_type_id"),
        F.timestamp_seconds(F.col("c_custkey")).cast("timestamp_ntz").alias("created"),
        F.col("c_custkey").alias("candidate"),
    )
    return keyed.next_versions(stored, asked).select(
        "candidate", F.col("function_name").alias("fn"), "major", "minor"
    )


def _redrawn(geom: DataFrame) -> DataFrame:
    """The same squares, drawn from another corner and the other way round."""
    ring = F.col("rings")[0]
    return geom.withColumn(
        "rings", F.array(F.reverse(F.array(ring[2], ring[3], ring[0], ring[1], ring[2])))
    )


@query
def repeated_geometries(t: Tables) -> DataFrame:
    """Every third square is stored a second time, redrawn."""
    again = _redrawn(t.geom.filter("geom_id % 3 = 0")).withColumn(
        "geom_id", F.col("geom_id") + 100000000
    )
    return spatial.repeated_geometries(t.geom.unionByName(again)).select("geom_id", "n_rows")


# ---- hierarchy ------------------------------------------------------------------------------
@query
def group_closure(t: Tables) -> DataFrame:
    return hierarchy.closure(t.grouper)


@query
def group_rollup(t: Tables) -> DataFrame:
    return hierarchy.group_summary(t.grouper, t.field, ordered=False).drop("organization_id")


@query
def subtree_fields(t: Tables) -> DataFrame:
    wanted = t.grouper.filter("parent_grouper_id is null")
    return hierarchy.rows_of_subtree(hierarchy.closure(t.grouper), t.field, wanted).select(
        "field_id", "ancestor_id"
    )


@query
def group_fields(t: Tables) -> DataFrame:
    return hierarchy.fields_of_groups(hierarchy.descend(t.grouper), t.field)


@query
def three_levels(t: Tables) -> DataFrame:
    return hierarchy.three_levels(t.grouper)


# ---- weather --------------------------------------------------------------------------------
@query
def latest_daily(t: Tables) -> DataFrame:
    return w.daily_rows(t.daily)


@query
def daily_rows_all(t: Tables) -> DataFrame:
    return w.daily_rows(t.daily, t.need, t.weather_type, keep="all")


@query
def last_requested(t: Tables) -> DataFrame:
    return w.last_requested(t.daily)


@query
def first_year(t: Tables) -> DataFrame:
    return w.first_year(t.daily)


@query
def populated_cells(t: Tables) -> DataFrame:
    return w.populated_cells(t.daily)


@query
def first_plant_date(t: Tables) -> DataFrame:
    return w.first_plant_date(t.act, t.field_trial, t.plot)


@query
def field_date_bounds(t: Tables) -> DataFrame:
    zones = t.field.select("field_id", F.lit("Etc/GMT+6").alias("tz_name"))
    first = w.first_plant_date(t.act, t.field_trial, t.plot)
    return w.field_date_bounds(first, zones, NOW)


@query
def update_inventory(t: Tables) -> DataFrame:
    return w.update_inventory(t.daily, t.world_utm, t.cell_centroid, NOW).drop("lon", "lat")


@query
def add_inventory(t: Tables) -> DataFrame:
    return w.add_inventory(t.need, t.daily).drop("lon", "lat", "utc_offset_seconds")


def _gaps(t: Tables) -> DataFrame:
    populated = w.need_of_populated(t.daily, t.world_utm, t.cell_centroid, NOW)
    return w.fill_inventory(w.merged_need(t.need, populated), t.daily, t.weather_type, NOW)


@query
def fill_inventory(t: Tables) -> DataFrame:
    return _gaps(t).select("world_utm_id", "cell_id", "date", "parameter")


# ---- plans ----------------------------------------------------------------------------------
@query
def chunk_plan(t: Tables) -> DataFrame:
    rows = t.raw("orders").select(
        F.col("o_orderkey").alias("cell_id"), (F.col("o_custkey") % 60 + 1).cast("int").alias("zone")
    )
    return requests.even_chunks(rows, ["zone"], 100)


@query
def year_plan(t: Tables) -> DataFrame:
    return requests.split_years(t.need, NOW).select("cell_id", "year", "date_first", "date_last")


@query
def update_plan(t: Tables) -> DataFrame:
    need = w.update_inventory(t.daily, t.world_utm, t.cell_centroid, NOW)
    return requests.update_plan(need, n_cells_per_set=(4, 3)).select(
        "set_id", "zone", "chunk", "n_pts_requested",
        F.size("coordinate_list").cast("long").alias("n_coords"), "startdate", "enddate",
    )


@query
def add_plan(t: Tables) -> DataFrame:
    need = w.add_inventory(t.need, t.daily)
    return requests.add_plan(need, NOW, n_cells_per_set=(5, 5)).select(
        "set_id", "zone", "year", "chunk", F.size("coordinate_list").cast("long").alias("n_coords"),
        "utm_request_id", "n_pts_requested",
    )


@query
def fill_plan(t: Tables) -> DataFrame:
    return requests.fill_plan(_gaps(t), n_cells=4).select(
        "zone", "year", "chunk", F.size("coordinate_list").cast("long").alias("n_coords"),
        "n_pts_requested",
    )


@query
def fill_param_groups(t: Tables) -> DataFrame:
    gaps = t.raw("part").select(
        (F.col("p_partkey") % 20).cast("int").alias("utm_zone"), F.col("p_brand").alias("parameter")
    )
    return requests.parameter_groups(gaps).select(
        F.col("utm_zone").alias("zone"), "set_id",
        F.array_join(F.array_sort("parameters"), ",").alias("parameters"),
    )


@query
def budget_cut(t: Tables) -> DataFrame:
    return requests.budget_cut(t.request, 2500).select("request_id", "zone")


@query
def requests_remaining(t: Tables) -> DataFrame:
    return requests.requests_remaining(t.request, "1998-06-01 09:30:00", 900000)


@query
def timeout_split(t: Tables) -> DataFrame:
    late = t.request.filter("status = 'FAIL' and request_seconds = -408")
    return requests.halved(late).select(
        "request_id", "half", "startdate", "enddate", F.size("coordinate_list").alias("n_coords"),
        F.size("parameters").alias("n_params"),
    )


@query
def not_found_filter(t: Tables) -> DataFrame:
    lost = t.request.filter("status = 'FAIL' and request_seconds = -404")
    return requests.without_unknown_parameters(lost).select(
        "request_id", F.array_join("parameters", ",").alias("parameters")
    )


@query
def request_report(t: Tables) -> DataFrame:
    return requests.request_report(t.request)


# ---- ingest ---------------------------------------------------------------------------------
def _cells(t: Tables) -> DataFrame:
    return t.cell_centroid.join(t.world_utm, "world_utm_id")


@query
def response_clean(t: Tables) -> DataFrame:
    cell = F.col("user_id") % 40
    wide = t.raw("events").select(
        F.round(F.lit(40.0) + cell * 0.04, 5).alias("lat"),
        F.round(F.lit(-96.0) + cell * 0.05, 5).alias("lon"),
        F.col("ts").alias("validdate"), F.col("ts").alias("date_requested"),
        F.col("value").alias("a_24h"), (F.col("value") * 2).alias("b_24h"),
    )
    return ingest.clean_response(wide, _cells(t))


@query
def response_filter_bounds(t: Tables) -> DataFrame:
    need = w.update_inventory(t.daily, t.world_utm, t.cell_centroid, NOW)
    return ingest.filter_response(t.daily, need).select("daily_id", "cell_id", "date")


@query
def response_filter_exact(t: Tables) -> DataFrame:
    names = t.weather_type.select("weather_type_id", F.col("weather_type").alias("variable"))
    clean = t.daily.join(names, "weather_type_id")
    return ingest.filter_response(clean, _gaps(t)).select(
        "daily_id", "cell_id", "date", "variable"
    )


# ---- features -------------------------------------------------------------------------------
@query
def type_summary(t: Tables) -> DataFrame:
    rows = features.type_summary(
        t.observation, t.field, t.unit_type, t.observation_type, t.observation_group
    )

    def counted(column: str, key: str) -> F.Column:
        text = F.array_join(
            F.transform(
                column,
                lambda u: F.concat(u[key].cast("string"), F.lit(":"), u["count"].cast("string")),
            ),
            ",",
        )
        return F.when(F.size(column) > 0, text)

    return rows.select(
        "observation_type_id", "observation_type_name", "category", "value_count",
        F.col("unit_count").cast("long").alias("unit_count"),
        F.array_min(F.transform("units", lambda u: u["earliest"])).alias("earliest"),
        F.array_max(F.transform("units", lambda u: u["latest"])).alias("latest"),
        counted("units", "unit_type_id").alias("units"),
        counted("groups", "observation_grouper_id").alias("groups"),
    )


def _observations(t: Tables) -> DataFrame:
    return features.select_observations(
        t.observation, t.field, t.unit_type, t.observation_type, t.observation_group
    )


@query
def observation_selection(t: Tables) -> DataFrame:
    return _observations(t).select(
        "observation_id", "field_id", "observation_type_name", "unit_name", "quantity", "group_name"
    )


@query
def time_ordinal(t: Tables) -> DataFrame:
    return features.time_ordinals(_observations(t))


@query
def tolerance_dedupe(t: Tables) -> DataFrame:
    kept = features.deduplicated(
        _observations(t), features.FEATURE_KEY, "acquired", "observation_id", "18 hours"
    )
    return kept.select(
        "observation_id", "field_id", "observation_type_id", "unit_type_id", "acquired"
    )


@query
def first_per_group(t: Tables) -> DataFrame:
    kept = features.deduplicated(
        _observations(t), features.FEATURE_KEY, "acquired", "observation_id", "18 hours", "first"
    )
    return kept.select("observation_id")


@query
def feature_columns(t: Tables) -> DataFrame:
    return features.feature_rows(_observations(t)).select(
        "observation_id", "column_name", "quantity"
    )


@query
def feature_records(t: Tables) -> DataFrame:
    """The nested record of every feature, as JSON."""
    return features.feature_json(features.feature_rows(_observations(t)))


@query
def feature_pivot(t: Tables) -> DataFrame:
    """Fields by features, with a column for every feature that the observations hold."""
    kept = features.deduplicated(
        _observations(t), features.FEATURE_KEY, "acquired", "observation_id", "18 hours"
    )
    named = kept.withColumn(
        "column_name", F.lower(F.concat_ws("_", "observation_type_name", "unit_name"))
    )
    kinds = t.unit_type.join(t.observation_type, "observation_type_id").select(
        F.lower(F.concat_ws("_", "observation_type_name", "unit_name")).alias("column_name")
    )
    return features.feature_pivot(named, [r[0] for r in kinds.distinct().orderBy("column_name").collect()])


@query
def field_documents(t: Tables) -> DataFrame:
    """Documents per field as JSON, with operations and the plantings of known crops and their times."""
    acts = views.owner_field(t.act, t.field_trial, t.plot).drop("field_id").withColumnRenamed(
        "owner_field_id", "field_id"
    )
    rows = acts.select("field_id", F.col("act_type").alias("name"), "date_performed", "act_id")
    operations = features.field_events(rows, ["name"], "date_performed", "act_id", tolerance="6 hours")
    planted = acts.filter("act_type = 'PLANT'").join(t.crop_type, "crop_type_id")
    firsts = features.field_events(
        planted.select("field_id", "date_performed", "act_id"), [], "date_performed", "act_id",
        tolerance="6 hours",
    )
    plantings = firsts.join(planted.select("act_id", "crop", "product_name"), "act_id")
    docs = features.field_documents(
        t.field, t.grouper, operations, plantings, batch_size=10000
    )
    return docs.select("field_id", "field_meta")


@query
def key_observations(t: Tables) -> DataFrame:
    geo = t.raw("customer").select(
        F.col("c_custkey").alias("geospatial_key_id"), F.col("c_custkey").alias("geom_id"),
        F.col("c_custkey").alias("field_id"),
    )
    n = F.col("n_nationkey")
    temporal = t.raw("nation").select(
        n.alias("temporal_key_id"),
        F.date_add(F.lit("2024-01-01").cast("date"), n).alias("start_date"),
        F.date_add(F.lit("2024-01-03").cast("date"), n * 2).alias("end_date"),
    )
    return features.observations_for_keys(t.observation, t.unit_type, geo, temporal).select(
        "observation_id", "temporal_key_id", "geospatial_key_id"
    )


@query
def key_product(t: Tables) -> DataFrame:
    return features.key_product(
        t.raw("customer").select(F.col("c_custkey").alias("geom_id")),
        t.raw("nation").select(F.col("n_nationkey").alias("temporal_key_id")),
    )


@query
def latest_object(t: Tables) -> DataFrame:
    keys = t.raw("lineitem").select(
        (F.col("l_suppkey") % 100).alias("geospatial_key_id"),
        F.month("l_shipdate").cast("long").alias("temporal_key_id"),
    )
    return features.latest_object(t.s3_object, t.s3_object_key, keys).select(
        "s3_type_id", "s3_object_id", "key", "n_objects"
    )


# ---- lineage --------------------------------------------------------------------------------
@query
def execution_summary(t: Tables) -> DataFrame:
    arguments = {
        "observation_argument": t.observation_argument, "keyword_argument": t.keyword_argument,
        "s3_input_argument": t.s3_input_argument,
        "execution_key": t.execution_key.join(t._runs, "execution_id"),
    }
    return lineage.execution_summary(t.execution, t.s3_output_argument, arguments)


@query
def duplicate_executions(t: Tables) -> DataFrame:
    return lineage.duplicate_executions(t.execution, {"s3_input_argument": t.s3_input_argument})


@query
def raw_summary_counts(t: Tables) -> DataFrame:
    # executions are looked up once, for the counts: not for every argument before it is counted
    rows = lineage.raw_summary_counts(
        t.execution, {"s3_input_argument": t.s3_input_line, "s3_output_argument": t.s3_output_line}
    )
    return rows.withColumn("n_rows", F.col("n_rows").cast("long"))


@query
def raw_summary(t: Tables) -> DataFrame:
    return lineage.raw_summary(
        t.execution,
        {"s3_input_argument": t.s3_input_argument, "s3_output_argument": t.s3_output_argument},
    )


@query
def latest_functions(t: Tables) -> DataFrame:
    functions = t.raw("supplier").select(
        F.col("s_suppkey").alias("function_id"), F.col("s_nationkey").alias("function_name"),
        F.lit(1).alias("major"), F.col("s_suppkey").alias("minor"),
        F.lit(1).alias("function_type_id"),
    )
    return lineage.latest_functions(functions).select(F.col("function_name").alias("fn"), "minor")


# ---- geometry -------------------------------------------------------------------------------
@query
def point_to_cell(t: Tables) -> DataFrame:
    return grid.cells_of_points(t.points).select(
        "point_id", "utm_zone", "rast_col", "rast_row", "lng_centroid", "lat_centroid"
    )


@query
def cell_centroid(t: Tables) -> DataFrame:
    cells = grid.cells_of_points(t.points).select("point_id", "cell_id")
    return grid.cell_info(cells).select(
        "point_id", "utm_zone", "rast_col", "rast_row", "lng_centroid", "lat_centroid"
    )


@query
def grid_cells(t: Tables) -> DataFrame:
    cells = grid.grid_cells(t.spark, grid.cells_of_points(t.points).select("world_utm_id"))
    return cells.select("zone", "row", "rast_col", "rast_row", "lng_centroid", "lat_centroid")


@query
def need_of_fields(t: Tables) -> DataFrame:
    centres = spatial.field_centroids(t.field, t.geom)
    placed = grid.cells_of_points(centres).drop("lon", "lat").withColumnsRenamed(
        {"lng_centroid": "lon", "lat_centroid": "lat"}
    )
    zones = t.field.select("field_id", F.lit("Etc/GMT+6").alias("tz_name"))
    bounds = w.field_date_bounds(w.first_plant_date(t.act, t.field_trial, t.plot), zones, NOW)
    return w.need_of_fields(placed, bounds, NOW).select(
        "utm_zone", "lon", "lat", "date_first", "date_last"
    )


@query
def polygon_join(t: Tables) -> DataFrame:
    """Points in half cells against squares, L and U shapes, shapes of parts and with holes."""
    return spatial.points_in_polygons(t.shape_points, t.shapes).select("point_id", "geom_id")


@query
def shape_join(t: Tables) -> DataFrame:
    other = t.shapes.withColumnRenamed("geom_id", "other_id")
    return spatial.spatial_join(t.shapes, other).select("geom_id", "other_id")


@query
def field_centroids(t: Tables) -> DataFrame:
    return spatial.field_centroids(t.field, t.geom).select(
        "field_id", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat")
    )


@query
def invalid_geometries(t: Tables) -> DataFrame:
    """Shapes of which some are broken: open, short, a bow tie, and a second ring that touches in a point or overlaps."""
    key = F.col("geom_id") % 10
    ring = F.transform(F.array(*[F.array(F.lit(x), F.lit(y)) for x, y in ((0, 0), (4, 0), (4, 4), (0, 4), (0, 0))]), lambda c: F.struct(
        (F.col("x0") + c[0]).cast("double").alias("x"), c[1].cast("double").alias("y")
    ))
    def drawn(*corners: tuple[int, int]) -> Column:
        return F.array(*[F.struct((F.col("x0") + x).cast("double").alias("x"), F.lit(float(y)).alias("y")) for x, y in corners])

    bow = F.array(ring[0], ring[2], ring[1], ring[3], ring[4])
    broken = t.shapes.select("geom_id").withColumn("x0", F.pmod("geom_id", F.lit(100))).withColumn(
        "rings",
        F.when(key == 1, F.array(F.slice(ring, 1, 4))).when(key == 2, F.array(F.slice(ring, 1, 2)))
        .when(key == 3, F.array(bow))
        .when(key == 4, F.array(ring, drawn((4, 0), (8, 4), (8, -4), (4, 0))))  # touches in a corner
        .when(key == 5, F.array(ring, drawn((4, 1), (8, 1), (8, 3), (4, 3), (4, 1))))  # shares a stretch
        .when(key == 6, F.array(drawn((0, 0), (4, 0), (2, 0), (2, 4), (0, 0))))  # folds back
        .when(key == 7, F.array(drawn((0, 0), (4, 0), (4, 4), (2, 0), (0, 4), (0, 0))))  # touches its own side
        .otherwise(F.array(ring)),
    ).withColumn("kind", F.lit("POLYGON"))
    return spatial.invalid_geometries(broken).select("geom_id", "reason")


def _acts_outside(t: Tables, mode: str) -> DataFrame:
    """Acts that carry a shape of their own, at the place of the field that owns them."""
    field_of = views.owner_field(t.act, t.field_trial, t.plot)
    kind = F.pmod("act_id", F.lit(len(ACT_SHAPES)))
    shaped = field_of.withColumn(
        "geom_id", F.lit(10**9) + F.col("owner_field_id") * 8 + kind
    ).drop("owner_field_id")
    geom = t.shapes.unionByName(t.act_shapes)
    return spatial.acts_outside_field(
        shaped, t.field, t.field_trial, t.plot, geom, mode
    ).select("act_id", "owner_field_id")


@query
def acts_outside_field(t: Tables) -> DataFrame:
    return _acts_outside(t, "resolved_owner")


@query
def acts_outside_field_as_written(t: Tables) -> DataFrame:
    return _acts_outside(t, "as_written")


@query
def geometry_upsert(t: Tables) -> DataFrame:
    """The suppliers' squares are stored; the customers' are asked for, drawn another way."""
    redrawn = _redrawn(t.geom).select(F.col("geom_id").alias("candidate"), "kind", "rings")
    stored = spatial.with_canonical(t.supplier_geom)
    fresh, found = spatial.insert_or_get_geom(stored, redrawn)
    top = stored.agg(F.max("geom_id").alias("m")).scalar()
    n_new = fresh.agg(F.count("*").alias("n")).scalar()
    return found.select(
        "candidate", F.when(F.col("geom_id") <= top, F.col("geom_id")).alias("known_id"),
        n_new.alias("n_new"),
    )


@query
def geometry_by_id(t: Tables) -> DataFrame:
    """Geometries of all fields."""
    return spatial.geometry_by_id(t.geom, t.field.select("geom_id")).select(
        "geom_id", F.col("rings")[0][2]["x"].alias("x"), F.col("rings")[0][2]["y"].alias("y")
    )


@query
def points_on_land(t: Tables) -> DataFrame:
    """Land cells are those of the suppliers' points."""
    land = grid.cells_of_points(t.supplier_points).select("cell_id").distinct()
    return grid.points_on_land(t.points, land).select("point_id")


@query
def polygon_info(t: Tables) -> DataFrame:
    asked = t.raw("orders").select((F.col("o_orderkey") % 1201 + 1).cast("int").alias("world_utm_id"))
    return grid.polygon_info(asked)[0]


@query
def point_time_zone(t: Tables) -> DataFrame:
    """Local time of plantings by the political zone their field's point lies in."""
    west = F.col("geom_id") % 2 == 0
    box = lambda x0, x1: F.array(F.array(*[
        F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"))
        for x, y in ((x0, 30.0), (x1, 30.0), (x1, 60.0), (x0, 60.0), (x0, 30.0))
    ]))
    zones = t.geom.select("geom_id").filter("geom_id in (0, 1)").select(
        F.when(west, "America/Denver").otherwise("America/Chicago").alias("tz_name"),
        F.when(west, box(-110.0, -93.001)).otherwise(box(-93.001, -80.0)).alias("rings"),
    )
    placed = spatial.points_in_polygons(t.points, zones).select("point_id", "tz_name")
    first = w.first_plant_date(t.act, t.field_trial, t.plot)
    local = timeops.local_time_in_zone(F.col("date_planted"), F.col("tz_name"))
    return first.join(placed, first.field_id == placed.point_id).select(
        "field_id", F.to_date(local).alias("local_date")
    )


# ---- time -----------------------------------------------------------------------------------
@query
def time_columns(t: Tables) -> DataFrame:
    offset = (F.col("user_id") % 25 - 12) * 3600
    local = timeops.local_time(F.col("ts"), offset)
    return t.raw("events").select(
        "event_id", local.alias("local_time"),
        timeops.first_unstable_date(local).alias("first_unstable"),
        timeops.earliest_current_date(F.col("ts")).alias("earliest_date"),
        timeops.end_of_day_utc(F.to_date("ts"), offset).alias("end_of_day"),
        F.size(timeops.dates_between(F.to_date("ts"), F.lit("2024-02-03").cast("date")))
        .alias("n_dates"),
    )


# ---- more of the tree, the tables and the lineage -------------------------------------------
@query
def group_ancestors(t: Tables) -> DataFrame:
    leaves = t.grouper.filter("grouper_id >= 1000")
    return hierarchy.ancestors(hierarchy.closure(t.grouper), leaves)


@query
def group_descendants(t: Tables) -> DataFrame:
    inner = t.grouper.filter("grouper_id < 1000")
    return hierarchy.descendants(hierarchy.closure(t.grouper), inner)


@query
def group_rollup_all(t: Tables) -> DataFrame:
    tree = hierarchy.descend(t.grouper)
    return hierarchy.rollup_counts(tree, hierarchy.closure(t.grouper), t.field, mode="all")


@query
def group_children(t: Tables) -> DataFrame:
    return hierarchy.children(hierarchy.descend(t.grouper), batch_size=3).select(
        "grouper_id", "batch",
        F.array_join(F.transform("grouper_ids", lambda g: g.cast("string")), ",").alias("children"),
    )


@query
def group_field_batches(t: Tables) -> DataFrame:
    return hierarchy.fields_of_groups(
        hierarchy.descend(t.grouper), t.field, batch_size=7
    ).select(
        "grouper_id", "batch", F.size("fields").alias("n_fields"),
        F.array_join(F.transform("fields", lambda f: f["field_id"].cast("string")), ",").alias("ids"),
    )


@query
def missing_ids(t: Tables) -> DataFrame:
    asked = t.raw("orders").select((F.col("o_custkey") * 2).alias("field_id")).distinct()
    return keyed.missing_ids(t.field, asked, CATALOG["field"])


@query
def object_key_links(t: Tables) -> DataFrame:
    objects = t.s3_object.join(
        t.execution.withColumnRenamed("execution_id", "s3_object_id"), "s3_object_id"
    ).select("s3_object_id", F.col("s3_object_id").alias("execution_id"))
    return keyed.link_many(objects, t.execution_key, "execution_id").select(
        "s3_object_id", "geospatial_key_id", "temporal_key_id"
    )


@query
def raster_subtype_violations(t: Tables) -> DataFrame:
    types = F.array(*[F.lit(v) for v in RASTER_SUBTYPES])
    subtypes = F.array(*[F.lit(v) for v in RASTER_SUBTYPES["UNKNOWN"]])
    key = F.col("o_orderkey")
    images = t.raw("orders").select(
        key.alias("rid"), F.element_at(types, (key % 4 + 1).cast("int")).alias("raster_type"),
        F.element_at(subtypes, (key % 9 + 1).cast("int")).alias("raster_subtype"),
    )
    return checks.wrong_raster_subtype(images)


@query
def bad_unit_names(t: Tables) -> DataFrame:
    units = t.raw("part").select(
        F.col("p_partkey").alias("unit_type_id"),
        F.concat(
            F.when(F.col("p_partkey") % 5 == 0, "7").otherwise("k"), F.col("p_name"),
            F.when(F.col("p_partkey") % 3 == 0, "%").otherwise(""),
        ).alias("unit_name"),
    )
    return checks.bad_unit_names(units).select("unit_type_id")


@query
def coordinate_decimals(t: Tables) -> DataFrame:
    fine = F.round(F.col("lon") + F.col("point_id") * 0.0000013, 7)
    digits = F.when(F.col("point_id") % 2 == 0, F.round("lon", 5)).otherwise(fine)
    return checks.too_many_decimals(t.points.withColumn("lon", digits).withColumn(
        "lat", F.round("lat", 5)
    )).select("point_id")


@query
def weather_type_ids(t: Tables) -> DataFrame:
    asked = t.raw("events").select(F.concat("event_type", F.lit("_24h")).alias("weather_type"))
    found, missing = w.weather_type_ids(
        t.weather_type,
        asked.unionByName(asked.select(F.concat("weather_type", F.lit("x")).alias("weather_type"))),
    )
    return found.unionByName(missing.withColumn("weather_type_id", F.lit(None).cast("long")))


@query
def fill_inventory_by_request(t: Tables) -> DataFrame:
    """Kept flag of every daily row."""
    rows = t.daily.join(t.world_utm, "world_utm_id")
    return rows.select(
        "daily_id", w.is_kept(NOW, F.col("utc_offset_seconds")).cast("int").alias("kept")
    )


@query
def request_sizes(t: Tables) -> DataFrame:
    return requests.request_size(t.need, ["utm_zone"], 3)


@query
def retry_requests(t: Tables) -> DataFrame:
    return requests.retry_requests(t.request).select(
        "request_id", "half", F.size("parameters").alias("n_params")
    )


@query
def unhandled_failures(t: Tables) -> DataFrame:
    return requests.unhandled_failures(t.request).groupBy("zone", "error").agg(
        F.count("*").alias("n_failures")
    )


@query
def daily_ingest(t: Tables) -> DataFrame:
    """Events as wide responses, cleaned, cut to the update's bounds and given type ids."""
    cell = F.col("user_id") % 40
    names = [f"{e}_24h" for e in ("click", "error", "purchase", "signup", "view")]
    wide = t.raw("events").select(
        F.round(F.lit(40.0) + cell * 0.04, 5).alias("lat"),
        F.round(F.lit(-96.0) + cell * 0.05, 5).alias("lon"),
        F.col("ts").alias("validdate"), F.col("ts").alias("date_requested"),
        *[
            F.when(F.concat("event_type", F.lit("_24h")) == n, F.col("value")).alias(n)
            for n in names
        ],
    )
    need = w.update_inventory(t.daily, t.world_utm, t.cell_centroid, NOW)
    rows = ingest.filter_response(ingest.clean_response(wide, _cells(t)), need)
    return ingest.daily_rows_of(rows.filter("value is not null"), t.weather_type)


def _answered(step: str, plan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Landed answers to a plan: views are unknown in zone 15, more than 100 days at once time out."""
    names = [f"{e}_24h" for e in EVENT_TYPES]
    unknown = (F.col("zone") == 15) & F.array_contains("parameters", "view_24h")
    late = F.datediff("enddate", "startdate") >= 100
    requests = plan.select(
        "*", F.when(unknown | late, "FAIL").otherwise("SUCCESS").alias("status"),
        F.when(unknown, -404.0).when(late, -408.0).otherwise(1.0).alias("request_seconds"),
        F.when(unknown, "NotFound: view_24h").when(late, "ReadTimeout").alias("error"),
        ntz(NOW).alias("date_requested"),
    )
    days = F.explode(F.sequence("startdate", "enddate", F.expr("interval 1 day"))).alias("validdate")
    rows = requests.filter("status = 'SUCCESS' and startdate <= enddate").select(
        "coordinate_list", "parameters", "date_requested", days
    ).select("*", F.inline("coordinate_list"))
    return rows.select(
        "lat", "lon", "validdate", "date_requested",
        *[F.when(F.array_contains("parameters", n), F.lit(float(len(n))) + F.dayofmonth("validdate")).alias(n) for n in names],
    ), requests


@query
def daily_job(t: Tables) -> DataFrame:
    """Update and add over what has landed, failed requests sent again; per cell and type what they add."""
    names = [f"{e}_24h" for e in EVENT_TYPES]
    steps, _ = daily.run_daily(
        t.daily, t.need, t.world_utm, t.cell_centroid, t.weather_type, _answered, NOW, 2500,
        parameter_sets=(names[:3], names[3:]),
    )
    rows = [s.new_rows.withColumn("step", F.lit(name)) for name, s in steps.items()]
    return rows[0].unionByName(rows[1]).filter("value is not null").groupBy(
        "step", "cell_id", "weather_type_id"
    ).agg(
        F.count("*").alias("n_rows"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.sum(F.col("value").cast("long")).alias("total"),
    )


def _id_range(numbered: DataFrame, stored: DataFrame, id_col: str) -> DataFrame:
    """First and last id; without rows the empty range that begins after the stored ids."""
    top = stored.agg(F.max(id_col)).scalar()
    return numbered.agg(
        F.coalesce(F.min(id_col), top + 1).alias("first_id"), F.coalesce(F.max(id_col), top).alias("last_id"),
        F.count("*").alias("n_rows"), F.count_distinct(id_col).alias("n_ids"),
    )


@query
def daily_append_ids(t: Tables) -> DataFrame:
    """The ids that the ingested rows get after those of the stored daily table."""
    return _id_range(ingest.with_row_ids(daily_ingest(t), t.daily, "daily_id"), t.daily, "daily_id")


@query
def request_log_ids(t: Tables) -> DataFrame:
    """The ids that requests get when all of them are logged once more."""
    again = t.request.select("zone", "utm_request_id", "status", "date_requested", "request_seconds")
    return _id_range(ingest.with_row_ids(again, t.request, "request_id"), t.request, "request_id")


@query
def unknown_parameters(t: Tables) -> DataFrame:
    """Rows of known weather types and of return flags, which are none."""
    known = t.raw("events").select(F.concat("event_type", F.lit("_24h")).alias("variable"))
    other = t.raw("lineitem").select(F.col("l_returnflag").alias("variable"))
    return ingest.unknown_parameters(known.unionByName(other), t.weather_type)


@query
def geojson_features(t: Tables) -> DataFrame:
    """Field squares written as GeoJSON lines and read back."""
    text = files.feature_text(t.geom.select("geom_id", "kind", "rings"))
    return files.features_of_text(text, "geom_id long").select(
        "geom_id", "kind", F.round(F.col("rings")[0][0]["x"], 6).alias("x"),
        F.round(F.col("rings")[0][0]["y"], 6).alias("y"), F.size(F.col("rings")[0]).alias("n_points"),
    )


@query
def response_rows(t: Tables) -> DataFrame:
    """Responses with a JSON array each: one per order and its line number parity."""
    line = F.struct(
        F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("amount")
    )
    landed = t.raw("lineitem").select(
        F.col("l_orderkey").alias("geospatial_key_id"), F.col("l_partkey").alias("temporal_key_id"),
        F.to_json(F.array(line, line)).alias("body"),
    )
    return files.many_rows_per_response(landed, "line: int, amount: double")


@query
def keyword_arguments(t: Tables) -> DataFrame:
    kinds = F.array(*[F.lit(k) for k in ("STRING", "INTEGER", "FLOAT", "JSON")])
    raw = t.raw("orders").select(
        (F.col("o_custkey") % 7).alias("function_id"), F.col("o_orderkey").alias("execution_id"),
        F.lit("k").alias("keyword_name"),
        F.element_at(kinds, (F.col("o_orderkey") % 4 + 1).cast("int")).alias("keyword_type"),
        F.col("o_custkey").cast("string").alias("value"),
    )
    return lineage.keyword_argument_rows(raw)


@query
def signature_difference(t: Tables) -> DataFrame:
    rows = t.raw("part").select(F.col("p_brand").alias("type_name"), "p_size")
    return lineage.signature_difference(
        rows.filter("p_size <= 30").select("type_name"), rows.filter("p_size > 20").select("type_name")
    )


@query
def execution_arguments(t: Tables) -> DataFrame:
    arguments = {
        "s3_input_argument": t.s3_input_argument,
        "execution_key": t.execution_key.join(t._runs, "execution_id"),
    }
    rows = lineage.execution_arguments(t.execution, t.s3_output_argument, arguments)
    return rows.select(
        "execution_id", "family",
        F.aggregate("arguments", F.lit(0).cast("long"), lambda a, x: a + x["times"])
        .alias("n_arguments"),
        F.size("arguments").alias("n_distinct"),
    )


@query
def latest_signatures(t: Tables) -> DataFrame:
    """Inputs and outputs of the latest version of every function."""
    functions = t.raw("supplier").select(
        F.col("s_suppkey").alias("function_id"),
        F.concat(F.lit("f"), F.col("s_nationkey").cast("string")).alias("function_name"),
        F.lit(1).alias("major"), F.col("s_suppkey").cast("int").alias("minor"),
        F.lit(1).cast("long").alias("function_type_id"),
    )
    families = {
        family: t.raw("lineitem").select(
            F.col("l_suppkey").alias("function_id"), F.col(column).alias("type_name")
        ).distinct()
        for family, column in (("s3_inputs", "l_returnflag"), ("s3_outputs", "l_linestatus"))
    }
    rows = lineage.latest_signatures(functions, families)
    return rows.select(
        "function_name", "minor", "family", F.size("parameters").alias("n_parameters")
    )


@query
def feature_batches(t: Tables) -> DataFrame:
    rows = features.features_per_field(features.feature_rows(_observations(t)), batch_size=10)
    return rows.select("field_id", "batch", F.size("features").alias("n_features"))


@query
def column_values(t: Tables) -> DataFrame:
    return features.column_values(features.feature_rows(_observations(t)))


@query
def observation_counts(t: Tables) -> DataFrame:
    return features.observation_counts(t.observation, t.observation_type)


@query
def frame_join(t: Tables) -> DataFrame:
    """Shapes of suppliers joined with their lines, and the result with the fields' shapes, by the names of the parts."""
    frames = features.FrameSet(t.shapes)
    frames.add("shapes", t.supplier_shapes.withColumnRenamed("geom_id", "shape_id"), geo=True)
    frames.add("lines", t.raw("lineitem").groupBy(F.col("l_suppkey").alias("shape_id")).agg(F.count("*").alias("n_lines")))
    frames.add("orders", t.raw("orders").groupBy(F.col("o_custkey").alias("geom_id")).agg(F.count("*").alias("n_orders")))
    frames.join("shapes", "lines")  # on their common column
    frames.join(features.FrameSet.GEOM, "lines")  # two geo frames: where they intersect
    frames.join("shapes", "orders")  # found under either name, on geom_id
    (joined,) = frames.geo_frames.values()
    return joined.select("geom_id", "shape_id", "n_lines", "n_orders")


@query
def feature_matrix(t: Tables) -> DataFrame:
    """Geometry rows with orders per field, and with every shape their own meets."""
    frames = features.FrameSet(t.shapes)
    per_field = t.raw("orders").groupBy(F.col("o_custkey").alias("geom_id")).agg(
        F.count("*").alias("n_orders")
    )
    frames.add("orders", per_field)
    frames.add("squares", t.supplier_shapes.withColumnRenamed("geom_id", "square_id"), geo=True)
    return frames.matrix().select("geom_id", "n_orders", "square_id")


@query
def seeded_weather_types(t: Tables) -> DataFrame:
    stored = t.weather_type.select("weather_type_id", "weather_type")
    return tables.seed_weather_types(stored).select("weather_type_id", "weather_type", "units")


@query
def all_field_ids(t: Tables) -> DataFrame:
    return tables.all_ids(t.field, CATALOG["field"])


@query
def daily_weather_types(t: Tables) -> DataFrame:
    return w.daily_weather_types(t.weather_type).select("weather_type_id", "weather_type")


@query
def need_of_populated(t: Tables) -> DataFrame:
    return w.need_of_populated(t.daily, t.world_utm, t.cell_centroid, NOW).drop("lon", "lat")


@query
def merged_need(t: Tables) -> DataFrame:
    populated = w.need_of_populated(t.daily, t.world_utm, t.cell_centroid, NOW)
    return w.merged_need(t.need, populated).select("world_utm_id", "cell_id", "date_first")


@query
def fill_inventory_skip_empty(t: Tables) -> DataFrame:
    """Gaps of the fields' cells alone, leaving out parameters a polygon has no row of."""
    daily = t.daily.filter("weather_type_id <> 4 or world_utm_id = 1")
    gaps = w.fill_inventory(t.need, daily, t.weather_type, NOW, skip_empty=True)
    return gaps.groupBy("world_utm_id", "parameter").agg(F.count("*").alias("n_gaps"))


@query
def mixed_offsets(t: Tables) -> DataFrame:
    rows = t.raw("orders").select(
        (F.col("o_custkey") % 60).alias("zone"), (F.col("o_custkey") % 600).alias("chunk"),
        (F.col("o_orderdate") > "1998-01-01").cast("int").alias("utc_offset_seconds"),
    )
    return checks.mixed_offsets(rows, ["zone", "chunk"])


@query
def geometry_for_keys(t: Tables) -> DataFrame:
    keys = t.raw("orders").select((F.col("o_custkey") + 1).alias("geom_id"))
    return features.geometry_for_keys(t.geom, keys).select("geom_id")


@query
def key_product_ids(t: Tables) -> DataFrame:
    """Orders' keys with the ids of their halves."""
    day = F.to_date("o_orderdate")
    keys = t.raw("orders").select(
        F.col("o_custkey").alias("geom_id"), F.col("o_custkey").alias("field_id"),
        day.alias("start_date"), F.date_add(day, 1).alias("end_date"),
    )
    geo = t.raw("customer").select(
        F.col("c_custkey").alias("geom_id"), F.col("c_custkey").alias("field_id"),
        (F.col("c_custkey") * 2).alias("geospatial_key_id"),
    )
    days = keys.select("start_date", "end_date").distinct().withColumn(
        "temporal_key_id", F.datediff("start_date", F.lit("1990-01-01").cast("date"))
    )
    return features.with_key_ids(keys, geo, days).select("geospatial_key_id", "temporal_key_id")


@query
def type_dimension_upsert(t: Tables) -> DataFrame:
    """Crop names of all parts, stored once each under dense ids from 1."""
    asked = t.raw("part").select(
        F.upper("p_name").alias("crop"), F.lit(None).cast("string").alias("product_name")
    )
    fresh, _ = keyed.insert_or_get(CATALOG["crop_type"].empty(t.spark), asked, CATALOG["crop_type"], NOW)
    return fresh.select(
        F.count("*").alias("n_rows"), F.min("crop_type_id").alias("first_id"),
        F.max("crop_type_id").alias("last_id"), F.count_distinct("crop").alias("n_crops"),
    )

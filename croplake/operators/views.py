"""Owner resolution and the analytic views over fields, trials, plots, acts and apps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from croplake.catalog import NUTRIENTS
from croplake.session import shuffled


def most_specific_geom_id(field: Column, trial: Column, plot: Column) -> Column:
    """The plot's geometry id, else the trial's, else the field's."""
    return F.coalesce(plot, trial, field)


PARENT_IDS = ("field_id", "field_trial_id", "plot_id")


def parcels(field: DataFrame, field_trial: DataFrame, plot: DataFrame) -> DataFrame:
    """Fields, trials and plots in one table: (level, parcel_id, owner_field_id).

    Level 0 are fields, 1 trials, 2 plots; a plot belongs to the field of its trial.
    """
    fields = field.select(
        F.lit(0).alias("level"), F.col("field_id").alias("parcel_id"),
        F.col("field_id").alias("owner_field_id"),
    )
    return fields.unionByName(_parcels_below_field(field_trial, plot))


def _parcels_below_field(field_trial: DataFrame, plot: DataFrame) -> DataFrame:
    trials = field_trial.select(
        F.lit(1).alias("level"), F.col("field_trial_id").alias("parcel_id"),
        F.col("field_id").alias("owner_field_id"),
    )
    plots = plot.select("plot_id", "field_trial_id").join(
        shuffled(field_trial.select("field_trial_id", "field_id")), "field_trial_id"
    ).select(
        F.lit(2).alias("level"), F.col("plot_id").alias("parcel_id"),
        F.col("field_id").alias("owner_field_id"),
    )
    return trials.unionByName(plots)


def by_parcel(rows: DataFrame) -> DataFrame:
    """One row per parent a row names, as (level, parcel_id); rows without parent drop."""
    named = F.array(*[
        F.struct(F.lit(i).alias("level"), F.col(c).alias("parcel_id"))
        for i, c in enumerate(PARENT_IDS)
    ])
    filled = F.filter(named, lambda p: p["parcel_id"].isNotNull())
    return rows.withColumn("_parcel", F.explode(filled)).select(
        *rows.columns, "_parcel.level", "_parcel.parcel_id"
    )


def owner_field(activity: DataFrame, field_trial: DataFrame, plot: DataFrame) -> DataFrame:
    """``activity`` plus ``owner_field_id``: its field, else its trial's, else its plot's trial's.

    Rows that name a field, or nothing, need no lookup and are not shuffled; the others are looked
    up in one join on (level, id), which has no null keys to pile up in one task.
    """
    level = F.when(F.col("field_trial_id").isNotNull(), F.lit(1)).otherwise(F.lit(2))
    lookup = F.col("field_id").isNull() & F.coalesce("field_trial_id", "plot_id").isNotNull()
    known = _parcels_below_field(field_trial, plot).select(
        F.col("level").alias("_level"), F.col("parcel_id").alias("_parcel"), "owner_field_id"
    )
    direct = activity.filter(~lookup).withColumn("owner_field_id", F.col("field_id"))
    found = activity.filter(lookup).join(
        shuffled(known),
        (level == F.col("_level")) & (F.coalesce("field_trial_id", "plot_id") == F.col("_parcel")),
        "left",
    )
    cols = activity.columns + ["owner_field_id"]
    return direct.select(cols).unionByName(found.select(cols))


def with_most_specific_geometry(
    rows: DataFrame, geom: DataFrame, field_col: str, trial_col: str, plot_col: str
) -> DataFrame:
    """``rows`` joined to the geometry of their most specific id; rows without one drop."""
    wanted = most_specific_geom_id(F.col(field_col), F.col(trial_col), F.col(plot_col))
    shapes = geom.select(F.col("geom_id").alias("_geom"), F.col("rings").alias("geometry"))
    return rows.join(shuffled(shapes), wanted == F.col("_geom")).drop("_geom")


def _plots_with_owner(plot: DataFrame, field_trial: DataFrame, field: DataFrame) -> DataFrame:
    p = plot.select(
        "plot_id", F.col("name").alias("plot"), "field_trial_id", "treatment_id", "block_id",
        "replication_id", F.col("geom_id").alias("_p_geom"),
    )
    ft = field_trial.select(
        "field_trial_id", F.col("name").alias("field_trial"), "field_id",
        F.col("date_start").alias("date_start_field_trial"),
        F.col("date_end").alias("date_end_field_trial"),
        F.col("grouper_id").alias("grouper_id_field_trial"),
        F.col("details").alias("details_field_trial"), F.col("geom_id").alias("_ft_geom"),
    )
    f = field.select(
        "field_id", F.col("name").alias("field"), "organization_id",
        F.col("geom_id").alias("_f_geom"),
    )
    return p.join(shuffled(ft), "field_trial_id").join(shuffled(f), "field_id")


def plot_details(
    plot: DataFrame, field_trial: DataFrame, field: DataFrame, geom: DataFrame
) -> DataFrame:
    """One row per plot with its trial, field and most specific geometry."""
    rows = _plots_with_owner(plot, field_trial, field)
    return with_most_specific_geometry(rows, geom, "_f_geom", "_ft_geom", "_p_geom").select(
        "organization_id", "field_id", "field_trial_id", "plot_id",
        F.col("plot").alias("name_plot"), "treatment_id", "block_id", "replication_id",
        "date_start_field_trial", "date_end_field_trial", "grouper_id_field_trial",
        "details_field_trial", "geometry",
    )


def plot_details_geometry(
    plot: DataFrame, field_trial: DataFrame, field: DataFrame, geom: DataFrame,
    organization: DataFrame,
) -> DataFrame:
    """:func:`plot_details` with the names of organization, field and trial."""
    rows = _plots_with_owner(plot, field_trial, field)
    names = organization.select("organization_id", F.col("name").alias("organization"))
    return (
        with_most_specific_geometry(rows, geom, "_f_geom", "_ft_geom", "_p_geom")
        .join(names, "organization_id")
        .select(
            "organization", "field", "field_trial", "plot", "treatment_id", "block_id",
            "replication_id", "date_start_field_trial", "date_end_field_trial",
            "details_field_trial", "geometry", "organization_id", "field_id", "field_trial_id",
            "plot_id", "grouper_id_field_trial",
        )
    )


def _rates() -> list[Column]:
    return [
        (F.col("rate_product") * (F.col(n) / F.lit(100))).alias(f"rate_{n}") for n in NUTRIENTS
    ]


def _plots_by_parcel(plots: DataFrame, columns: list[str]) -> DataFrame:
    """Each plot three times: under its field, its trial and itself."""
    up = F.array(*[
        F.struct(F.lit(i).alias("level"), F.col(c).alias("parcel_id"))
        for i, c in enumerate(PARENT_IDS)
    ])
    return plots.withColumn("_parcel", F.explode(up)).select(
        *columns, "_parcel.level", "_parcel.parcel_id"
    )


def plot_application_summary(plots: DataFrame, app: DataFrame, nutrient_source: DataFrame) -> DataFrame:
    """Every application as seen by every plot it reaches, with the 13 nutrient rates.

    ``plots`` is :func:`plot_details_geometry`. An application hangs on a field, a trial or a plot;
    one on a field reaches all plots of the field. Plots and applications meet in one join on
    (level, id), so both are read once. Sources are matched per organization: their columns ride
    along on the application before it fans out, and applications without source never fan out.
    """
    sources = nutrient_source.select(
        "nutrient_source_id", F.col("organization_id").alias("_source_org"), "nutrient", *NUTRIENTS
    )
    details = F.col("details") if "details" in app.columns else F.lit("{}")
    apps = by_parcel(
        app.filter(F.col("nutrient_source_id").isNotNull())
        .select(
            "app_id", "app_type", "app_method", "date_applied",
            F.col("rate").alias("rate_product"), "rate_unit", details.alias("details_app"),
            "nutrient_source_id", *PARENT_IDS,
        )
        .join(shuffled(sources), "nutrient_source_id")
        .select(
            "app_id", "app_type", "app_method", "date_applied", "rate_product", "rate_unit",
            "details_app", "nutrient_source_id", "_source_org", "nutrient", *_rates(), *PARENT_IDS,
        )
    ).drop(*PARENT_IDS)
    shown = _plots_by_parcel(
        plots, ["organization", "field", "field_trial", "plot", "organization_id", "plot_id"]
    )
    return (
        apps.join(shown, ["level", "parcel_id"])
        .filter(F.col("organization_id") == F.col("_source_org"))
        .select(
            "organization", "field", "field_trial", "plot", "date_applied", "nutrient", "app_type",
            "app_method", "rate_unit", "rate_product", *[f"rate_{n}" for n in NUTRIENTS],
            "details_app", "organization_id", "plot_id", "app_id", "nutrient_source_id",
        )
    )


#: Plots of a field in one list, where applications meet plots list by list.
UNIT_PLOTS = 64


def _one_parent(plots: DataFrame) -> DataFrame:
    """``plots`` plus ``_one``: whether all rows of a plot name the same field and trial.

    Plots without an id are never ``_one``; they are dealt by their field.
    """
    same = Window.partitionBy("organization_id", "plot_id", "_spread")
    return (
        plots.select("organization_id", "plot_id", "field_id", "field_trial_id")
        .withColumn("_spread", F.when(F.col("plot_id").isNull(), F.col("field_id")))
        .withColumn("_one", F.coalesce(
            (F.count("plot_id").over(same) > 0)
            & (F.min("field_id").over(same) == F.max("field_id").over(same))
            & (F.min("field_trial_id").over(same) == F.max("field_trial_id").over(same)),
            F.lit(False),
        ))
    )


def _units(plots: DataFrame) -> DataFrame:
    """Plots of :func:`_one_parent` in lists: (organization_id, field_id, _unit, _plots).

    A list holds at most :data:`UNIT_PLOTS` plots of one field, each once with the number of its
    rows, in order of their trial.
    """
    each = plots.filter("_one").groupBy(
        "organization_id", "plot_id", "_spread", "field_id", "field_trial_id"
    ).agg(F.count("*").alias("_times"))
    place = F.row_number().over(
        Window.partitionBy("organization_id", "field_id").orderBy("field_trial_id", "plot_id")
    )
    return (
        each.withColumn("_unit", F.floor((place - 1) / UNIT_PLOTS))
        .groupBy("organization_id", "field_id", "_unit")
        .agg(F.sort_array(F.collect_list(F.struct("field_trial_id", "plot_id", "_times"))).alias("_plots"))
    )


def _parcels_of_units(units: DataFrame) -> DataFrame:
    """The field, the trials and the plots of each unit: (level, parcel_id) with the unit's key.

    ``_run`` says which plots of the list are theirs: the first and how many, in one number, which
    takes less of a shuffled row than two (see :func:`_run_of`).
    """
    def run(level: int, parcel: Column, first: Column, number: Column) -> Column:
        return F.struct(
            F.lit(level).alias("level"), parcel.alias("parcel_id"),
            (first * (UNIT_PLOTS + 1) + number).cast("int").alias("_run"),
        )

    trials, one = F.col("_plots")["field_trial_id"], F.lit(1)
    parcel = F.explode(F.concat(
        F.array(run(0, F.col("field_id"), one, F.size("_plots"))),
        F.transform(F.array_distinct(trials), lambda trial: run(
            1, trial, F.array_position(trials, trial), F.size(F.filter(trials, lambda t: t == trial))
        )),
        F.transform("_plots", lambda plot, i: run(2, plot["plot_id"], i + one, one)),
    ))
    return units.select("organization_id", "field_id", "_unit", parcel.alias("_parcel")).select(
        "organization_id", "field_id", "_unit", "_parcel.*"
    )


def _run_of(sums: Column) -> tuple[Column, Column]:
    """First plot, from 1, and number of plots of a sum."""
    return F.floor(sums["_run"] / (UNIT_PLOTS + 1)).cast("int"), sums["_run"] % (UNIT_PLOTS + 1)


def _reached(rate_type: str) -> Column:
    """Each plot of ``_plots`` that one of ``_sums`` reaches: plot_id, rate, apps."""
    def of(plot: Column, rate: Column, apps: Column) -> Column:
        return F.struct(
            plot["plot_id"].alias("plot_id"), (rate * plot["_times"]).cast(rate_type).alias("rate"),
            (apps * plot["_times"]).alias("apps"),
        )

    def added(total: Column, s: Column) -> Column:
        rate = F.coalesce(total["rate"] + s["_rate"], total["rate"], s["_rate"])
        return F.struct(rate.cast(rate_type).alias("rate"), (total["apps"] + s["_apps"]).alias("apps"))

    def covers(s: Column, i: Column) -> Column:
        first, number = _run_of(s)
        return (i + 1 >= first) & (i + 1 < first + number)

    def total(plot: Column, i: Column) -> Column:
        own = F.filter("_sums", lambda s: covers(s, i))
        none = F.struct(F.lit(None).cast(rate_type).alias("rate"), F.lit(0).cast("long").alias("apps"))
        return F.struct(plot.alias("plot"), F.aggregate(own, none, added).alias("total"))

    only = F.col("_sums")[0]
    met = F.filter(F.transform("_plots", total), lambda x: x["total"]["apps"] > 0)
    return F.when(F.size("_sums") == 1, F.transform(
        F.slice("_plots", *_run_of(only)),
        lambda plot: of(plot, only["_rate"].cast(rate_type), only["_apps"]),
    )).otherwise(F.transform(met, lambda x: of(x["plot"], x["total"]["rate"], x["total"]["apps"])))


def plot_nutrient_totals(plots: DataFrame, app: DataFrame, nutrient_source: DataFrame) -> DataFrame:
    """:func:`plot_application_summary` summed per plot and source, without its fan-out.

    Applications are summed per parent and source first, so a field-level hot spot of a billion
    applications meets the plots as one row per source. The rows of plots and sources are made in
    the last join and never shuffled: the plots of a field come as lists, and the sums of the field,
    its trials and its plots meet them there, with the shares of their source. Plots that are under
    several fields or trials, or without an id, take no place in a list; theirs are summed by a
    shuffle.
    """
    sources = nutrient_source.select(
        "nutrient_source_id", F.col("organization_id").alias("_source_org"), "nutrient", *NUTRIENTS
    )
    sums = (
        by_parcel(
            app.filter(F.col("nutrient_source_id").isNotNull())
            .select("nutrient_source_id", "rate", *PARENT_IDS)
        )
        .groupBy("level", "parcel_id", "nutrient_source_id")
        .agg(F.sum("rate").alias("_rate"), F.count("*").alias("_apps"))
    )
    rate_type = sums.agg(F.sum("_rate")).schema[0].dataType.simpleString()
    columns = [
        "organization_id", "plot_id", "nutrient_source_id", "nutrient", "n_apps", "rate_product",
        *_rates(),
    ]
    one_source = (F.col("organization_id") == F.col("_source_org")) & (
        F.col("nutrient_source_id") == F.col("_source")
    )
    known = _one_parent(plots)

    # a source stored in several rows gives as many result rows
    copy = Window.partitionBy("_source_org", "nutrient_source_id").orderBy("nutrient", *NUTRIENTS)
    copies = sources.withColumn("_copy", F.row_number().over(copy))
    units = _units(known)
    unit = ["organization_id", "field_id", "_unit"]
    listed = (
        sums.join(shuffled(_parcels_of_units(units)), ["level", "parcel_id"])
        .drop("level", "parcel_id")
        .join(shuffled(copies.withColumnRenamed("nutrient_source_id", "_source")), one_source)
        .repartition(*unit)
        .groupBy(*unit, "nutrient_source_id", "_copy")
        .agg(
            F.collect_list(F.struct("_run", "_rate", "_apps")).alias("_sums"),
            *[F.first(c).alias(c) for c in ("nutrient", *NUTRIENTS)],
        )
        .join(shuffled(units), unit)
        .select(
            "organization_id", "nutrient_source_id", "nutrient", *NUTRIENTS,
            F.explode(_reached(rate_type)).alias("_plot"),
        )
        .select(
            "*", "_plot.plot_id", F.col("_plot.apps").alias("n_apps"),
            F.col("_plot.rate").alias("rate_product"),
        )
    )

    shown = _plots_by_parcel(known.filter(~F.col("_one")), ["organization_id", "plot_id"])
    others = (
        sums.join(shuffled(shown), ["level", "parcel_id"])
        .groupBy("organization_id", "plot_id", "nutrient_source_id")
        .agg(F.sum("_rate").alias("rate_product"), F.sum("_apps").alias("n_apps"))
        .join(shuffled(sources.withColumnRenamed("nutrient_source_id", "_source")), one_source)
    )
    return listed.select(columns).unionByName(others.select(columns))


def season_length(
    act: DataFrame, field: DataFrame, field_trial: DataFrame, plot: DataFrame
) -> DataFrame:
    """Every PLANT with every HARVEST of the same field, trial or plot, and the time between.

    The pairs are the result here, harvests before planting included. Parcels of all three levels
    are paired by one join on (level, id). The organization joins to the plantings, before the
    pairs exist; the pairing has a shuffle of its own, so Spark may split a hot parcel over tasks.
    """
    org = field.select(F.col("field_id").alias("owner_field_id"), "organization_id")
    owned = parcels(field, field_trial, plot).join(org, "owner_field_id").drop("owner_field_id")
    columns = ["date_performed", *PARENT_IDS]
    pair = F.struct("level", "parcel_id").alias("_pair")
    plant = by_parcel(act.filter("act_type = 'PLANT'").select(*columns)).join(
        owned, ["level", "parcel_id"]
    ).select(pair, "organization_id", *PARENT_IDS, F.col("date_performed").alias("date_plant"))
    harvest = by_parcel(act.filter("act_type = 'HARVEST'").select(*columns)).select(
        pair, F.col("date_performed").alias("date_harvest")
    )
    return plant.join(harvest, "_pair").select(
        "organization_id", *PARENT_IDS, "date_plant", "date_harvest",
        (F.col("date_harvest") - F.col("date_plant")).alias("season_length"),
        F.datediff("date_harvest", "date_plant").alias("season_days"),
    )

"""Batch load of field boundaries and as-planted records into the core tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from croplake.catalog import CATALOG
from croplake.functions import geo
from croplake.operators import keyed, spatial
from croplake.operators.ranking import null_safe_join

BOUNDS_PROPERTIES = "owner string, farm string, field_id string, year int"
PLANTED_PROPERTIES = (
    "field_id string, crop string, variety string, date_plant timestamp_ntz, population double, "
    "description string"
)
COVER_TOLERANCE = 1e-7


def load_fields(
    tables: dict[str, DataFrame], bounds: DataFrame, planted: DataFrame, organization_id: int,
    root_name: str, now,
) -> dict[str, DataFrame]:
    """Rows to append per table, and ``uncovered``: plantings outside their field's boundary.

    Levels go in one after the other (owner group, growers, farms, geometries, fields, crops,
    acts), each as one batch. A field with a single planting takes the field's geometry for it.
    Plantings without date are left out; those reaching past the boundary are not clipped but
    reported and left out.
    """
    def stored(name: str) -> DataFrame:
        return tables[name]

    def groups(rows: DataFrame, parent_col: str, level: str, known: DataFrame):
        cand = rows.select(
            "name", F.lit(organization_id).cast("long").alias("organization_id"),
            F.col(parent_col).cast("long").alias("parent_grouper_id"),
            F.to_json(F.struct(F.lit(level).alias("grouper_type"))).alias("details"),
        )
        return keyed.insert_or_get(known, cand.distinct(), CATALOG["grouper"], now, by="unique")

    spark = bounds.sparkSession
    group_columns = [f.name for f in CATALOG["grouper"].schema.fields]
    known = stored("grouper").select(*group_columns)
    new_groups = []

    root = spark.range(1).select(F.lit(root_name).alias("name"), F.lit(None).cast("long").alias("_p"))
    rows, found = groups(root, "_p", "owner", known)
    new_groups.append(rows)
    known = known.unionByName(rows)
    root_id = found.agg(F.min("grouper_id")).scalar()

    growers = bounds.select(F.col("owner").alias("name")).distinct().withColumn("_p", root_id)
    rows, found = groups(growers, "_p", "grower", known)
    new_groups.append(rows)
    known = known.unionByName(rows)
    grower_ids = found.select(F.col("name").alias("owner"), F.col("grouper_id").alias("_grower"))

    farms = bounds.select("owner", "farm").distinct().join(grower_ids, "owner")
    rows, found = groups(farms.withColumnRenamed("farm", "name"), "_grower", "farm", known)
    new_groups.append(rows)
    farm_ids = found.select(
        F.col("name").alias("farm"), F.col("parent_grouper_id").alias("_grower"),
        F.col("grouper_id"),
    )

    shapes = bounds.select("kind", "rings").unionByName(planted.select("kind", "rings"))
    canonical = shapes.withColumn("_hash", geo.canonical("rings", "kind")).groupBy("_hash").agg(
        F.min(F.struct("kind", "rings")).alias("_s")
    ).select("_s.*")
    new_geoms, _ = spatial.insert_or_get_geom(stored("geom"), canonical)
    geoms = stored("geom").select("geom_id", "kind", "canonical", "rings").unionByName(
        new_geoms.select("geom_id", "kind", "canonical", "rings")
    )
    geom_ids = geoms.groupBy("canonical").agg(F.min("geom_id").alias("geom_id"))

    field_rows = (
        bounds.join(grower_ids, "owner")
        .join(farm_ids, ["farm", "_grower"])
        .withColumn("canonical", geo.canonical("rings", "kind"))
        .join(geom_ids, "canonical")
        .select(
            F.col("field_id").alias("name"), "geom_id",
            F.make_date(F.col("year") - 1, F.lit(12), F.lit(1)).cast("timestamp_ntz")
            .alias("date_start"),
            F.expr(CATALOG["field"].defaults["date_end"]).alias("date_end"),
            F.lit(organization_id).cast("long").alias("organization_id"), "grouper_id",
        )
    )
    new_fields, found_fields = keyed.insert_or_get(
        stored("field"), field_rows, CATALOG["field"], now
    )
    field_ids = found_fields.select(
        F.col("name"), "field_id", F.col("geom_id").alias("_field_geom")
    ).distinct()

    dated = planted.filter(F.col("date_plant").isNotNull()).select(
        F.col("field_id").alias("name"), F.upper("crop").alias("crop"),
        F.upper("variety").alias("product_name"), F.col("date_plant").alias("date_performed"),
        "population", "description", geo.canonical("rings", "kind").alias("canonical"),
    )
    crops = dated.filter(F.col("crop").isNotNull()).select("crop", "product_name").distinct()
    new_crops, found_crops = keyed.insert_or_get(stored("crop_type"), crops, CATALOG["crop_type"], now)
    crop_ids = found_crops.select("crop", "product_name", "crop_type_id")

    records = planted.groupBy(F.col("field_id").alias("name")).agg(F.count("*").alias("_records"))
    acts = (
        null_safe_join(dated, crop_ids, ["crop", "product_name"], "left")
        .join(field_ids, "name")
        .join(records, "name")
        .join(geom_ids.withColumnRenamed("geom_id", "_own_geom"), "canonical")
        .withColumn(
            "geom_id",
            F.when(F.col("_records") == 1, F.col("_field_geom")).otherwise(F.col("_own_geom")),
        )
        .select(
            F.lit("PLANT").alias("act_type"), "date_performed", "crop_type_id", "field_id",
            F.lit(None).cast("long").alias("field_trial_id"), F.lit(None).cast("long").alias("plot_id"),
            "geom_id", "_field_geom",
            F.to_json(
                F.struct(F.col("population").alias("seed_density_per_acre"), "description")
            ).alias("details"),
        )
    )
    pairs = acts.select(F.col("geom_id").alias("inner_id"), F.col("_field_geom").alias("outer_id"))
    fine = spatial.covered_pairs(pairs.filter("inner_id <> outer_id"), geoms, COVER_TOLERANCE)
    judged = acts.join(
        fine.withColumn("_fine", F.lit(True)),
        (F.col("geom_id") == F.col("inner_id")) & (F.col("_field_geom") == F.col("outer_id")), "left",
    ).withColumn("_covered", F.coalesce(F.col("_fine") | (F.col("geom_id") == F.col("_field_geom")), F.lit(False)))
    columns = [c for c in acts.columns if c != "_field_geom"]
    new_acts, _ = keyed.insert_or_get(
        stored("act"), judged.filter("_covered").select(*columns), CATALOG["act"], now
    )
    return {
        "grouper": new_groups[0].unionByName(new_groups[1]).unionByName(new_groups[2]),
        "geom": new_geoms, "field": new_fields, "crop_type": new_crops, "act": new_acts,
        "uncovered": judged.filter("not _covered").select(*columns),
    }

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from croplake.operators import features as f

AT = datetime(2024, 1, 1)


def observations(spark, rows):
    return spark.createDataFrame(
        [(i, 1, "YIELD", "SENSOR", 3, "kg", 31, AT + timedelta(hours=h), q) for i, (h, q) in enumerate(rows)],
        "observation_id long, field_id long, observation_type_name string, category string, "
        "observation_type_id long, unit_name string, unit_type_id long, acquired timestamp_ntz, quantity double",
    )


def test_runs_and_first(spark):
    rows = observations(spark, [(0, 5.0), (10, 5.0), (27, 5.0), (46, 5.0), (46, 5.0), (1, 6.0)])
    runs = f.deduplicated(rows, f.FEATURE_KEY, "acquired", "observation_id", "18 hours").collect()
    # 0, 10 and 27 follow one another closely; 46 is 19 hours after 27
    assert sorted(r.observation_id for r in runs) == [0, 3, 5]
    first = f.deduplicated(rows, f.FEATURE_KEY, "acquired", "observation_id", "18 hours", "first").collect()
    assert sorted(r.observation_id for r in first) == [0, 5]
    with pytest.raises(ValueError):
        f.deduplicated(rows, f.FEATURE_KEY, "acquired", "observation_id", "1 hour", "none")


def test_feature_columns(spark):
    rows = f.feature_rows(observations(spark, [(0, 5.0), (100, 7.0), (200, 5.0)]))
    got = {r.observation_id: (r.column_name, r.unit_id) for r in rows.collect()}
    assert got == {0: ("YIELD.kg.1", 1), 1: ("YIELD.kg.2", 1), 2: ("YIELD.kg.3", 1)}
    assert '"column_name":"YIELD.kg.1"' in f.feature_json(rows).filter("observation_id = 0").first()["column"]
    packed = f.features_per_field(rows, batch_size=2).orderBy("batch").collect()
    assert [[x.quantity for x in r.features] for r in packed] == [[5.0, 7.0], [5.0]]
    wide = f.feature_pivot(rows, ["YIELD.kg.1", "YIELD.kg.9"]).first()
    assert (wide["YIELD.kg.1"], wide["YIELD.kg.9"]) == (5.0, None)


def test_open_interval_of_keys(spark):
    obs = spark.createDataFrame(
        [(i, 1, 1, 31, datetime(2020, 1, d)) for i, d in enumerate((1, 2, 31))] + [(9, 1, None, 31, datetime(2020, 1, 5))],
        "observation_id long, geom_id long, field_id long, unit_type_id long, date_observed timestamp_ntz",
    ).withColumn("observation_type_id", F.lit(0))
    unit = spark.createDataFrame([(31, "kg", 3)], "unit_type_id long, unit_name string, observation_type_id long")
    geo = spark.createDataFrame([(1, 1, 1)], "geospatial_key_id long, geom_id long, field_id long")
    span = spark.createDataFrame(
        [(7, datetime(2020, 1, 1).date(), datetime(2020, 1, 31).date()), (8, datetime(2020, 1, 3).date(), datetime(2020, 1, 1).date())],
        "temporal_key_id long, start_date date, end_date date",
    )
    rows = f.observations_for_keys(obs, unit, geo, span)
    assert [(r.observation_id, r.temporal_key_id) for r in rows.collect()] == [(1, 7)]
    kinds = spark.createDataFrame([(3,), (4,)], "observation_type_id long")
    counts = {r[0]: r[1] for r in f.observation_counts(rows, kinds).collect()}
    assert counts == {3: 1, 4: 0}


def test_key_product_with_ids(spark):
    geo = spark.createDataFrame([(1, 5), (2, None)], "geom_id long, field_id long")
    days = spark.createDataFrame([(AT.date(), AT.date()), (AT.date(), datetime(2025, 1, 1).date())], "start_date date, end_date date")
    keys = f.key_product(geo, days)
    assert keys.count() == 4
    geo_ids = geo.withColumn("geospatial_key_id", F.col("geom_id") * 10)
    day_ids = days.withColumn("temporal_key_id", F.year("end_date"))
    ids = f.with_key_ids(keys, geo_ids, day_ids).select("geospatial_key_id", "temporal_key_id").collect()
    assert sorted(map(tuple, ids)) == [(10, 2024), (10, 2025), (20, 2024), (20, 2025)]


def test_latest_object_reports_older_ones(spark):
    objects = spark.createDataFrame([(1, "a", "b", 1), (2, "c", "b", 1), (3, "d", "b", 2)],
                                    "s3_object_id long, key string, bucket_name string, s3_type_id long")
    links = spark.createDataFrame([(1, 1, 1), (2, 1, 1), (2, 2, 1), (3, 9, 9)],
                                  "s3_object_id long, geospatial_key_id long, temporal_key_id long")
    keys = spark.createDataFrame([("r", 1, 1), ("r", 2, 1), ("r", 1, 1)], "run string, geospatial_key_id long, temporal_key_id long")
    row = f.latest_object(objects, links, keys, by=["run"]).collect()
    assert [(r.run, r.s3_type_id, r.s3_object_id, r.n_keys, r.n_objects) for r in row] == [("r", 1, 2, 2, 2)]


def box(x):
    return [[{"x": float(a), "y": float(b)} for a, b in ((x, 0), (x + 1, 0), (x + 1, 1), (x, 1), (x, 0))]]


def test_frame_set(spark):
    shape = "array<array<struct<x:double,y:double>>>"
    geometry = spark.createDataFrame([(1, box(0)), (2, box(10))], f"geom_id long, rings {shape}")
    frames = f.FrameSet(geometry)
    frames.add("yield", spark.createDataFrame([(1, 5.0), (2, 6.0)], "geom_id long, kg double"))
    frames.add("soil", spark.createDataFrame([(1, "clay"), (3, "sand")], "geom_id long, soil string"))
    frames.add("zones", spark.createDataFrame([("z", 1, box(0.5))], f"zone string, geom_id long, rings {shape}"), geo=True)
    frames.join("yield", "soil")
    assert list(frames.frames) == ["yield+soil"]
    row = frames.matrix().first()
    assert (row.geom_id, row.kg, row.soil, row.zone, row.geom_id_zones) == (1, 5.0, "clay", "z", 1)
    with pytest.raises(ValueError):
        frames.add("zones", geometry)
    with pytest.raises(KeyError):
        frames.join("yield", "nothing")
    other = f.FrameSet(geometry)
    other.add("a", spark.createDataFrame([(1, 5.0)], "geom_id long, kg double"))
    other.join(f.FrameSet.GEOM, "a", lambda left, right: left.join(right, "geom_id", "left"))
    assert other.geo_frames["GEOM+a"].count() == 2


def test_field_documents(spark):
    groups = spark.createDataFrame([(1, "land", None), (2, "region", 1), (3, "farm", 2)],
                                   "grouper_id long, name string, parent_grouper_id long")
    field = spark.createDataFrame([(10, "north", 3), (11, "south", 3), (12, "lost", 1)], "field_id long, name string, grouper_id long")
    ops = spark.createDataFrame([(10, "TILL", AT), (10, None, AT)], "field_id long, name string, performed timestamp_ntz")
    plants = spark.createDataFrame([(10, "CORN", "X", AT)], "field_id long, crop string, product_name string, performed timestamp_ntz")
    docs = {r.field_id: r.field_meta for r in f.field_documents(field, groups, ops, plants).collect()}
    assert set(docs) == {10, 11}
    assert '"operations":[{"name":"TILL"' in docs[10] and '"country_name":"land"' in docs[10]
    assert '"crop":"CORN"' in docs[10]

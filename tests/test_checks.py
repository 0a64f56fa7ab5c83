from __future__ import annotations

from datetime import datetime

import pytest

from croplake.catalog import CATALOG
from croplake.operators import checks


def test_plain_unique_lets_nulls_repeat(spark):
    rows = spark.createDataFrame([("a", None), ("a", None), ("b", 1), ("b", 1)], "x string, y int")
    assert checks.repeated_keys(rows, ["x", "y"]).count() == 2
    assert [r.x for r in checks.repeated_keys(rows, ["x", "y"], nulls_distinct=True).collect()] == ["b"]


def test_parents(spark):
    rows = spark.createDataFrame(
        [(1, None, None), (1, 2, None), (None, None, None), (0, None, None)],
        "field_id long, field_trial_id long, plot_id long",
    )
    assert checks.not_exactly_one_parent(rows).count() == 2
    assert checks.without_parent(rows).count() == 2


def test_domain_null_fails_only_on_request(spark):
    rows = spark.createDataFrame(
        [("CSV", None), ("CSV", "SOIL"), ("XLS", "SOIL")], "file_format string, category string"
    )
    assert checks.outside_domain(rows, CATALOG["s3"]).count() == 1
    assert checks.outside_domain(rows, CATALOG["s3"], ("category",)).count() == 2


def test_field_dates_include_both_ends(spark):
    day = [datetime(2020, 1, d) for d in range(1, 6)]
    field = spark.createDataFrame(
        [(1, day[1], day[3])], "field_id long, date_start timestamp_ntz, date_end timestamp_ntz"
    )
    trial = spark.createDataFrame([(5, 1)], "field_trial_id long, field_id long")
    plot = spark.createDataFrame([(8, 5)], "plot_id long, field_trial_id long")
    acts = spark.createDataFrame(
        [(i, d, None, None, 8) for i, d in enumerate(day)] + [(9, day[0], None, None, None)],
        "act_id long, date_performed timestamp_ntz, field_id long, field_trial_id long, plot_id long",
    )
    bad = checks.outside_field_dates(acts, "date_performed", field, trial, plot).collect()
    assert sorted(r.act_id for r in bad) == [0, 4]


def test_upper_case_lets_nulls_pass(spark):
    rows = spark.createDataFrame([("CORN", None), ("Corn", None), ("CORN", "x1")],
                                 "crop string, product_name string")
    assert checks.not_upper_case(rows).count() == 2


def test_file_ending_is_the_last_suffix(spark):
    rows = spark.createDataFrame(
        [("s3://b/a.tar.CSV", "CSV"), ("s3://b.json/a", "JSON"), ("s3://b/a.json", "JSON")],
        "s3_url string, file_format string",
    )
    assert [r.s3_url for r in checks.wrong_file_format(rows).collect()] == ["s3://b.json/a"]


def test_request_rules(spark):
    rows = spark.createDataFrame([(1, 0, [str(i) for i in range(11)]), (1, 3600, ["a"]), (2, 0, ["a"])],
                                 "zone int, utc_offset_seconds int, parameters array<string>")
    assert checks.too_many_parameters(rows).count() == 1
    assert [r.zone for r in checks.mixed_offsets(rows, ["zone"]).collect()] == [1]
    with pytest.raises(ValueError, match="lat"):
        checks.require_columns(rows, ["zone", "lat"], "the table")


def test_unknown_weather_type(spark):
    rows = spark.createDataFrame([("precip_24h:mm",), ("rain",)], "weather_type string")
    assert [r[0] for r in checks.unknown_weather_types(rows).collect()] == ["rain"]

from __future__ import annotations

from datetime import datetime

import pytest

from croplake.catalog import CATALOG, CORE_TABLES, table_differences
from croplake.operators import checks, keyed

NOW = "2024-01-30 15:00:00"
CROP, GROUPER, FIELD = CATALOG["crop_type"], CATALOG["grouper"], CATALOG["field"]


def grouper(spark, rows):
    return spark.createDataFrame(
        rows, "grouper_id long, name string, organization_id long, parent_grouper_id long"
    )


def test_core_tables_reconcile_both_ways():
    assert table_differences(list(CORE_TABLES)) == {"missing": [], "unexpected": []}
    assert table_differences(["act", "other"])["unexpected"] == ["other"]
    assert "geom" in table_differences(["act"])["missing"]


def test_null_product_is_its_own_crop_type(spark):
    stored = spark.createDataFrame(
        [(7, "BARLEY", "ABI VOYAGER")], "crop_type_id long, crop string, product_name string"
    )
    asked = spark.createDataFrame(
        [("BARLEY", None), ("BARLEY", "ABI VOYAGER")], "crop string, product_name string"
    )
    fresh, found = keyed.insert_or_get(stored, asked, CROP, NOW)
    ids = {r.product_name: r.crop_type_id for r in found.collect()}
    assert ids == {"ABI VOYAGER": 7, None: 8}
    row = fresh.first()
    assert (row.crop_type_id, row.details, row.created) == (8, "{}", datetime(2024, 1, 30, 15))


def test_insert_twice_is_insert_once(spark):
    asked = spark.createDataFrame(
        [(f"C{i % 30}", None if i % 2 else f"P{i % 5}") for i in range(200)],
        "crop string, product_name string",
    )
    fresh, first = keyed.insert_or_get(CROP.empty(spark), asked, CROP, NOW)
    again, second = keyed.insert_or_get(fresh, asked, CROP, NOW)
    assert again.isEmpty()
    key = lambda r: (r.crop, r.product_name or "", r.crop_type_id)
    assert sorted(map(key, first.collect())) == sorted(map(key, second.collect()))
    ids = sorted(r.crop_type_id for r in fresh.collect())
    assert ids == list(range(1, len(ids) + 1))
    assert checks.repeated_rows(fresh, CROP).isEmpty()


def test_lookup_of_groupers_ignores_the_parent(spark):
    stored = grouper(spark, [(1, "root", 1, None), (2, "north", 1, 1)])
    asked = spark.createDataFrame(
        [("north", 1, 9)], "name string, organization_id long, parent_grouper_id long"
    )
    assert keyed.find_ids(stored, asked, GROUPER).first().grouper_id == 2
    assert keyed.find_ids(stored, asked, GROUPER, by="unique").first().grouper_id is None


def test_orphan_grouper_is_reported(spark):
    rows = grouper(spark, [(1, "root", 1, None), (2, "child", 1, 1), (3, "orphan", 1, 10)])
    found = checks.orphans(rows, "parent_grouper_id", rows, "grouper_id").collect()
    assert [r.name for r in found] == ["orphan"]


def test_several_matches_give_the_smallest_id(spark):
    stored = spark.createDataFrame(
        [(9, "X", None), (4, "X", None)], "crop_type_id long, crop string, product_name string"
    )
    asked = spark.createDataFrame([("X", None)], "crop string, product_name string")
    assert keyed.find_ids(stored, asked, CROP).first().crop_type_id == 4


def test_defaults_fill_nulls_only(spark):
    rows = spark.createDataFrame(
        [("f", datetime(2020, 1, 1), None, 1, 1)],
        "name string, date_start timestamp_ntz, date_end timestamp_ntz, geom_id long, "
        "organization_id long",
    )
    row = keyed.with_defaults(rows, FIELD, NOW).first()
    assert row.date_end == datetime(9999, 12, 31, 23, 59, 59, 999999)
    assert row.grouper_id is None


def test_ids_do_not_depend_on_partitions(spark):
    rows = spark.range(5000).selectExpr("concat('k', id) as crop", "cast(null as string) as product_name")
    one = keyed.new_rows(CROP.empty(spark), rows.repartition(3), CROP, NOW)
    two = keyed.new_rows(CROP.empty(spark), rows.repartition(11, "crop"), CROP, NOW)
    pair = ["crop", "crop_type_id"]
    assert one.select(pair).exceptAll(two.select(pair)).isEmpty()


def test_update_stamps_changed_rows_only(spark):
    old = datetime(2020, 1, 1)
    stored = spark.createDataFrame(
        [(1, "a", old), (2, "b", old)], "organization_id long, name string, last_updated timestamp_ntz"
    )
    change = spark.createDataFrame([(2, "B"), (3, "c")], "organization_id long, name string")
    out = keyed.apply_updates(stored, change, CATALOG["organization"], NOW).orderBy("organization_id")
    assert [(r.name, r.last_updated) for r in out.collect()] == [
        ("a", old), ("B", datetime(2024, 1, 30, 15)),
    ]


def test_table_without_key_says_so(spark):
    with pytest.raises(ValueError, match="no lookup key"):
        keyed.find_ids(CATALOG["daily"].empty(spark), CATALOG["daily"].empty(spark), CATALOG["daily"])


def test_rows_by_composite_key(spark):
    stored = spark.createDataFrame([(1, "csv", True), (2, "json", False)],
                                   "s3_type_id long, driver string, has_geometry boolean")
    keys = spark.createDataFrame([(2, "json"), (2, "json"), (3, "csv")], "s3_type_id long, driver string")
    assert [r.s3_type_id for r in keyed.rows_by_key(stored, keys, ["s3_type_id", "driver"]).collect()] == [2]

from __future__ import annotations

import json
from datetime import date, datetime

import pytest

from croplake.catalog import CATALOG
from croplake.operators import keyed
from croplake.sources import files, load, tables

SQUARE = [[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0], [0.0, 0.0]]]


def collection(path, features):
    path.write_text(json.dumps({
        "type": "FeatureCollection",
        "features": [{"type": "Feature", "properties": p, "geometry": g} for p, g in features],
    }, indent=1))
    return str(path)


def test_geometry_kinds(spark, tmp_path):
    kinds = [
        ("Point", [1.5, 2.5]), ("MultiPoint", [[1.0, 2.0], [3.0, 4.0]]), ("LineString", [[0.0, 0.0], [1.0, 1.0]]),
        ("MultiLineString", [[[0.0, 0.0], [1.0, 1.0]], [[2.0, 2.0], [3.0, 3.0]]]), ("Polygon", SQUARE),
        ("MultiPolygon", [SQUARE, [[[9.0, 9.0], [10.0, 9.0], [9.0, 10.0], [9.0, 9.0]]]]),
    ]
    path = collection(tmp_path / "a.geojson", [({"n": i}, {"type": k, "coordinates": c}) for i, (k, c) in enumerate(kinds)])
    rows = files.read_features(spark, path, "n int")
    got = {r.n: (r.kind, [len(g) for g in r.rings]) for r in rows.collect()}
    assert got == {0: ("POINT", [1]), 1: ("MULTIPOINT", [2]), 2: ("LINESTRING", [2]),
                   3: ("MULTILINESTRING", [2, 2]), 4: ("POLYGON", [5]), 5: ("MULTIPOLYGON", [5, 4])}
    out = files.write_table(rows, str(tmp_path / "out"), "GeoJSON", "input", has_geometry=True)
    assert "/input_" in out
    back = files.read_features(spark, out, "n int", layout="lines")
    assert back.exceptAll(rows).isEmpty() and back.count() == 6


def test_tables_by_driver(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "n int, s string")
    for driver in ("CSV", "json"):
        path = files.write_table(df, str(tmp_path), driver)
        assert files.read_table(spark, path, driver, df.schema).exceptAll(df).isEmpty()
        assert files.read_table(spark, path, driver).count() == 2
    for bad in (lambda: files.read_table(spark, "x", "XLS"), lambda: files.write_table(df, "x", "XLS"),
                lambda: files.write_table(df, "x", "KML", has_geometry=True)):
        with pytest.raises(ValueError):
            bad()


def test_key_files(spark, tmp_path):
    geo, span = tmp_path / "g.json", tmp_path / "t.json"
    geo.write_text('[\n {"geom_id": 12668,\n "field_id": 12291},\n {"geom_id": 1484, "field_id": null}]')
    span.write_text('[{"start_date": "2018-01-01",\n "end_date": "2020-12-31"}]')
    assert sorted(r.geom_id for r in files.read_geospatial_keys(spark, str(geo)).collect()) == [1484, 12668]
    assert files.read_temporal_keys(spark, str(span)).first().end_date == date(2020, 12, 31)


def test_landed_responses(spark):
    landed = spark.createDataFrame([(1, '{"a": 1, "b": "x"}'), (2, '{"a": 2}')], "key long, body string")
    one = {r.key: (r.a, r.b) for r in files.one_row_per_response(landed, "a int, b string").collect()}
    assert one == {1: (1, "x"), 2: (2, None)}
    many = spark.createDataFrame([(1, '[{"a": 1}, {"a": 2}]'), (2, "[]")], "key long, body string")
    assert sorted((r.key, r.a) for r in files.many_rows_per_response(many, "a int").collect()) == [(1, 1), (1, 2)]


def test_documents(spark, tmp_path):
    df = spark.createDataFrame([(1, "x")], "field_id long, column string")
    files.write_documents(df, df, df, str(tmp_path / "d"))
    assert spark.read.json(str(tmp_path / "d" / "fields")).first().field_id == 1


def test_bootstrap_and_seed(spark, tmp_path):
    folder = str(tmp_path / "tables")
    tables.create_tables(spark, folder, ["weather_type", "daily", "field"])
    stored = tables.read_stored(spark, folder, "weather_type")
    assert stored.isEmpty() and stored.schema["temporal_extent"].dataType == CATALOG["weather_type"].schema["temporal_extent"].dataType
    fresh = tables.seed_weather_types(stored)
    assert [r.weather_type_id for r in fresh.orderBy("weather_type_id").collect()] == list(range(1, 12))
    tables.append_rows(fresh, folder, "weather_type")
    assert tables.seed_weather_types(tables.read_stored(spark, folder, "weather_type")).isEmpty()
    tables.create_tables(spark, folder, ["weather_type"])
    assert tables.read_stored(spark, folder, "weather_type").count() == 11
    assert tables.read_stored(spark, folder, "plot").isEmpty()
    assert tables.all_ids(tables.read_stored(spark, folder, "field"), CATALOG["field"]).collect() == []


def polygon(x0, y0, x1, y1):
    return {"type": "Polygon", "coordinates": [[[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]]]}


def test_load_of_fields_and_plantings(spark, tmp_path):
    bounds = files.read_features(spark, collection(tmp_path / "field-bounds.geojson", [
        ({"owner": "ann", "farm": "home", "field_id": "01", "year": 2022}, polygon(0, 0, 4, 4)),
        ({"owner": "ann", "farm": "home", "field_id": "02", "year": 2022}, polygon(10, 0, 14, 4)),
        ({"owner": "bob", "farm": "home", "field_id": "03", "year": 2022}, polygon(20, 0, 24, 4)),
    ]), load.BOUNDS_PROPERTIES)
    planted = files.read_features(spark, collection(tmp_path / "as-planted.geojson", [
        ({"field_id": "01", "crop": "corn", "variety": "x1", "date_plant": "2022-05-01T00:00:00", "population": 30000.0}, polygon(0, 0, 3, 3)),
        ({"field_id": "02", "crop": "soy", "date_plant": "2022-05-02T00:00:00"}, polygon(10, 0, 12, 4)),
        ({"field_id": "02", "crop": "soy", "date_plant": "2022-05-03T00:00:00"}, polygon(12, 0, 16, 4)),
        ({"field_id": "03", "crop": "rye"}, polygon(20, 0, 24, 4)),
    ]), load.PLANTED_PROPERTIES)
    stored = {n: CATALOG[n].empty(spark) for n in ("grouper", "geom", "field", "crop_type", "act")}
    new = load.load_fields(stored, bounds, planted, 1, "everyone", "2024-01-30 15:00:00")
    assert {n: df.count() for n, df in new.items()} == {
        "grouper": 5, "geom": 6, "field": 3, "crop_type": 2, "act": 2, "uncovered": 1,
    }
    groups = {r.grouper_id: r for r in new["grouper"].collect()}
    farms = [g for g in groups.values() if g.name == "home"]
    assert sorted(groups[g.parent_grouper_id].name for g in farms) == ["ann", "bob"]
    field = {r.name: r for r in new["field"].collect()}
    assert field["01"].date_start == datetime(2021, 12, 1)
    acts = {r.field_id: r for r in new["act"].collect()}
    # a single planting takes the field's own geometry
    assert acts[field["01"].field_id].geom_id == field["01"].geom_id
    assert '"seed_density_per_acre":30000.0' in acts[field["01"].field_id].details
    assert new["uncovered"].first().date_performed == datetime(2022, 5, 3)
    whole = {n: stored[n].unionByName(new[n].select(*stored[n].columns)) for n in stored}
    again = load.load_fields(whole, bounds, planted, 1, "everyone", "2024-02-01 00:00:00")
    assert all(again[n].isEmpty() for n in stored)
    assert keyed.missing_ids(whole["geom"], whole["field"], CATALOG["geom"]).isEmpty()

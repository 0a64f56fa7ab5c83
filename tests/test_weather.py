from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from croplake.functions import timeops as t
from croplake.operators import weather as w

NOW = "2024-01-30 15:00:00"
LAST = date(2024, 2, 6)
NEED = ("utm_zone int, utc_offset_seconds int, world_utm_id int, cell_id long, lon double, lat double, "
        "date_first date, date_last date")
DAILY = ("daily_id long, world_utm_id int, cell_id long, date date, weather_type_id long, value float, "
         "date_requested timestamp_ntz")


@pytest.fixture(scope="module")
def types(spark):
    return spark.sql(
        "select * from values (2L, 'b', interval '1 00:00:00' day to second), "
        "(1L, 'a', interval '1 00:00:00' day to second), (3L, 'hourly', interval '0 01:00:00' day to second) "
        "as v(weather_type_id, weather_type, temporal_extent)"
    )


def need(spark, rows):
    return spark.createDataFrame([(15, -21600, 1, c, -93.0, 44.0, a, b) for c, a, b in rows], NEED)


def daily(spark, rows):
    return spark.createDataFrame([(i, 1, c, d, k, 1.0, at) for i, (c, d, k, at) in enumerate(rows)], DAILY)


@pytest.mark.parametrize("now, want", [
    ("2024-01-30 12:00:00", date(2024, 1, 29)), ("2024-01-30 12:00:01", date(2024, 1, 30)),
    ("2024-03-01 00:00:00", date(2024, 2, 29)),
])
def test_earliest_current_date(spark, now, want):
    assert spark.range(1).select(t.earliest_current_date(now)).first()[0] == want


def test_time_columns(spark):
    row = spark.range(1).select(
        t.local_time(t.instant("2024-01-01 02:00:00"), F.lit(-21600)),
        t.local_time_in_zone(t.instant("2024-07-01 02:00:00"), F.lit("America/Chicago")),
        t.first_unstable_date(t.instant("2024-01-01 02:00:00")),
        t.end_of_day_utc(F.lit("2024-01-01").cast("date"), F.lit(-21600)),
        F.size(t.dates_between(F.lit("2024-01-01").cast("date"), F.lit("2024-03-01").cast("date"))),
        F.size(t.dates_between(F.lit("2024-01-02").cast("date"), F.lit("2024-01-01").cast("date"))),
    ).first()
    assert tuple(row) == (
        datetime(2023, 12, 31, 20), datetime(2024, 6, 30, 21), date(2023, 12, 31),
        datetime(2024, 1, 2, 5, 59, 59), 61, 0,
    )


def test_recent_takes_the_newest_and_breaks_ties_by_id(spark):
    day, at = date(2024, 1, 1), datetime(2024, 1, 2)
    rows = daily(spark, [(1, day, 1, at), (1, day, 1, at), (1, day, 1, at - timedelta(days=1)), (2, day, 1, at)])
    assert sorted(r.daily_id for r in w.daily_rows(rows).collect()) == [1, 3]
    only = spark.createDataFrame([(2,)], "cell_id long")
    assert [r.daily_id for r in w.daily_rows(rows, only, keep="all").collect()] == [3]
    with pytest.raises(ValueError):
        w.daily_rows(rows, keep="some")


def test_last_request_is_the_oldest_newest(spark):
    day = date(2024, 1, 1)
    rows = daily(spark, [(1, day, 1, datetime(2024, 1, 9)), (1, day, 1, datetime(2024, 1, 5)), (1, day, 2, datetime(2024, 1, 7))])
    assert w.last_requested(rows).first().date_last_requested == datetime(2024, 1, 7)


def test_update_takes_cells_not_requested_today(spark):
    rows = daily(spark, [(1, date(2024, 1, 1), 1, datetime(2024, 1, 28, 3)), (2, date(2024, 1, 1), 1, datetime(2024, 1, 30, 1))])
    utm = spark.createDataFrame([(1, 15, "T", -21600)], "world_utm_id int, utm_zone int, utm_row string, utc_offset_seconds int")
    centre = spark.createDataFrame([(1, 1, -93.0, 44.0), (1, 2, -93.0, 44.1)], "world_utm_id int, cell_id long, lon double, lat double")
    got = w.update_inventory(rows, utm, centre, NOW).collect()
    # 3:00 UTC is the evening before in the polygon
    assert [(r.cell_id, r.date_first, r.date_last) for r in got] == [(1, date(2024, 1, 26), LAST)]


def test_add_finds_earlier_years_and_new_cells(spark):
    rows = daily(spark, [(1, date(2020, 6, 1), 1, datetime(2024, 1, 1)), (2, date(2015, 6, 1), 1, datetime(2024, 1, 1))])
    wanted = need(spark, [(c, date(2018, 1, 1), LAST) for c in (1, 2, 3)])
    got = {r.cell_id: (r.date_first, r.date_last) for r in w.add_inventory(wanted, rows).collect()}
    assert got == {1: (date(2018, 1, 1), date(2019, 12, 31)), 3: (date(2018, 1, 1), LAST)}


def test_merged_need_takes_the_later_first_date(spark):
    a = need(spark, [(1, date(2018, 1, 1), LAST), (2, date(2019, 1, 1), LAST)])
    b = need(spark, [(1, date(2020, 1, 1), LAST)])
    got = {r.cell_id: r.date_first for r in w.merged_need(a, b).collect()}
    assert got == {1: date(2020, 1, 1), 2: date(2019, 1, 1)}


def brute_gaps(rows, cells, kinds, now, skip_empty):
    off = timedelta(hours=-6)
    unstable = lambda at: (at - timedelta(days=1)).date()
    final = unstable(now + off) - timedelta(days=1)
    out = set()
    for k, name in kinds:
        newest = {}
        for c, d, kk, at in rows:
            if kk == k and c in cells:
                newest[c, d] = max(newest.get((c, d), at), at)
        if skip_empty and not newest:
            continue
        kept = {key for key, at in newest.items() if unstable(at + off) > key[1] or key[1] > final}
        for c, first in cells.items():
            d = first
            while d <= LAST:
                if (c, d) not in kept:
                    out.add((c, d, name))
                d += timedelta(days=1)
    return out


@pytest.mark.parametrize("skip_empty", [False, True])
def test_fill_finds_exactly_the_gaps(spark, types, skip_empty):
    import random

    rnd = random.Random(3)
    cells = {1: date(2024, 1, 1), 2: date(2024, 1, 20), 3: date(2024, 2, 5)}
    rows = [
        (rnd.choice([1, 2, 4]), date(2024, 1, 1) + timedelta(days=rnd.randrange(40)), 1,
         datetime(2024, 1, 1) + timedelta(hours=rnd.randrange(30 * 24)))
        for _ in range(150)
    ]
    got = w.fill_inventory(
        need(spark, [(c, a, LAST) for c, a in cells.items()]), daily(spark, rows), types, NOW, skip_empty
    )
    pairs = [(r.cell_id, r.date, r.parameter) for r in got.collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == brute_gaps(rows, cells, [(1, "a"), (2, "b")], datetime(2024, 1, 30, 15), skip_empty)


def test_filled_gaps_leave_no_gaps(spark, types):
    wanted = need(spark, [(1, date(2024, 1, 10), LAST)])
    gaps = w.fill_inventory(wanted, daily(spark, [(1, date(2024, 1, 11), 1, datetime(2024, 1, 12))]), types, NOW)
    ids = types.select("weather_type_id", F.col("weather_type").alias("parameter"))
    filled = gaps.join(ids, "parameter").select(
        F.lit(1).cast("long").alias("daily_id"), "world_utm_id", "cell_id", "date", "weather_type_id",
        F.lit(1.0).cast("float").alias("value"), t.instant("2024-01-30 15:00:00").alias("date_requested"),
    )
    all_rows = filled.unionByName(daily(spark, [(1, date(2024, 1, 11), 1, datetime(2024, 1, 12))]))
    left = w.fill_inventory(wanted, all_rows, types, NOW).collect()
    # requested now, the two days before are not final and stay open for the next run only
    assert {r.date for r in left} <= {date(2024, 1, 28), date(2024, 1, 29)} or not left


def test_planting_of_a_field_act_is_its_own_field(spark):
    act = spark.createDataFrame(
        [("PLANT", 12, None, None, datetime(2021, 5, 1)), ("PLANT", None, 5, None, datetime(2020, 5, 1)),
         ("HARVEST", 12, None, None, datetime(2019, 5, 1)), ("PLANT", None, None, 9, datetime(2018, 1, 1, 3))],
        "act_type string, field_id long, field_trial_id long, plot_id long, date_performed timestamp_ntz",
    )
    trial = spark.createDataFrame([(5, 12), (6, 13)], "field_trial_id long, field_id long")
    plot = spark.createDataFrame([(9, 6)], "plot_id long, field_trial_id long")
    first = w.first_plant_date(act, trial, plot)
    assert {r.field_id: r.date_planted for r in first.collect()} == {
        12: datetime(2020, 5, 1), 13: datetime(2018, 1, 1, 3),
    }
    zones = spark.createDataFrame([(12, "America/Chicago"), (13, "America/Chicago")], "field_id long, tz_name string")
    bounds = {r.field_id: r.date_first for r in w.field_date_bounds(first, zones, NOW).collect()}
    # 3:00 UTC on New Year's Day is still the old year there
    assert bounds == {12: date(2010, 1, 1), 13: date(2007, 1, 1)}


def test_newest_rows_are_hashed_and_ties_go_by_id(spark):
    rows = [(1, 7, 3, date(2024, 1, 1), 1.0, datetime(2024, 1, 2)), (2, 7, 3, date(2024, 1, 1), 2.0, datetime(2024, 1, 3)),
            (9, 7, 3, date(2024, 1, 1), 3.0, datetime(2024, 1, 3)), (4, 7, 3, date(2024, 1, 2), 4.0, datetime(1965, 1, 3)),
            (3, 7, 3, date(2024, 1, 2), None, datetime(1965, 1, 3, 0, 0, 1)), (5, 8, 3, date(2024, 1, 1), 5.0, datetime(2262, 1, 1))]
    daily = spark.createDataFrame(
        rows, "daily_id long, cell_id long, weather_type_id long, date date, value float, date_requested timestamp_ntz"
    )
    newest = w.latest_rows(daily)
    assert {(r.daily_id, r.cell_id, r.value, r.date_requested) for r in newest.collect()} == {
        (9, 7, 3.0, datetime(2024, 1, 3)), (3, 7, None, datetime(1965, 1, 3, 0, 0, 1)), (5, 8, 5.0, datetime(2262, 1, 1))}
    assert "SortAggregate" not in newest._jdf.queryExecution().executedPlan().toString()

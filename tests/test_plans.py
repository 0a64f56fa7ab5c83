from __future__ import annotations

from datetime import date, datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from croplake.operators import weather as w
from croplake.plans import daily as job
from croplake.plans import ingest, requests as r
from croplake.sources import tables

NOW = "2024-01-30 15:00:00"
NEED = ("utm_zone int, utc_offset_seconds int, world_utm_id int, cell_id long, lon double, lat double, "
        "date_first date, date_last date")


def need(spark, n, zone=15, first=date(2023, 5, 1), last=date(2024, 2, 6)):
    return spark.createDataFrame(
        [(zone, -21600, 1, i, round(-93 + i * 0.01, 5), 44.0, first, last) for i in range(n)], NEED
    )


@pytest.mark.parametrize("n, limit", [(1, 10), (10, 10), (11, 10), (23, 5), (100, 7), (9, 100)])
def test_chunks_are_even_and_larger_first(spark, n, limit):
    got = r.even_chunks(need(spark, n), ["utm_zone"], limit).groupBy("chunk").count().orderBy("chunk").collect()
    want = [len(part) for part in np.array_split(np.arange(n), -(-n // limit))]
    assert [x["count"] for x in got] == want


def test_years(spark):
    got = r.split_years(need(spark, 1), NOW).orderBy("year").collect()
    assert [(x.date_first, x.date_last) for x in got] == [
        (date(2023, 1, 1), date(2023, 12, 31)), (date(2024, 1, 1), date(2024, 2, 6)),
    ]


def test_update_plan_covers_every_cell_once_per_set(spark):
    cells = need(spark, 25).unionByName(need(spark, 7, zone=16))
    plan = r.update_plan(cells, n_cells_per_set=(10, 4))
    rows = plan.collect()
    for s, params in ((0, 6), (1, 5)):
        mine = [x for x in rows if x.set_id == s]
        assert sum(len(x.coordinate_list) for x in mine) == 32
        assert sorted(x.utm_request_id for x in mine) == list(range(len(mine)))
        assert all(len(x.parameters) == params for x in mine)
    first = [x for x in rows if x.set_id == 0 and x.zone == 16][0]
    assert first.n_pts_requested == 6 * 281 * 7
    assert (first.startdate, first.enddate) == (datetime(2023, 5, 2, 5, 59, 59), datetime(2024, 2, 7, 5, 59, 59))
    assert (first.coordinate_list[0].lat, first.coordinate_list[1].lon) == (44.0, -92.99)


def test_parameter_groups_stride(spark):
    gaps = spark.createDataFrame([(z, f"p{i:02d}") for z, n in ((1, 10), (2, 23)) for i in range(n)], "utm_zone int, parameter string")
    got = {(x.utm_zone, x.set_id): x.parameters for x in r.parameter_groups(gaps).collect()}
    assert len(got) == 4
    names = [f"p{i:02d}" for i in range(23)]
    assert [got[2, i] for i in range(3)] == [names[i::3] for i in range(3)]


def test_budget_is_strict_and_takes_whole_zones(spark):
    rows = spark.createDataFrame([(z,) for z, n in ((1, 5), (2, 2), (3, 2), (4, 1)) for _ in range(n)], "zone int")
    zones = lambda n: {x.zone for x in r.budget_cut(rows, n).collect()}
    assert zones(10) == {1, 2, 3, 4}
    assert zones(9) == {2, 3, 4}
    assert zones(5) == {2, 4}
    assert zones(1) == set()
    assert r.budget_cut(rows, 9).count() == 5


def request(spark, **kw):
    base = dict(zone=1, status="FAIL", request_seconds=-408.0, error="e", date_requested=datetime(2024, 1, 1),
                startdate=datetime(2024, 1, 1, 5), enddate=datetime(2024, 1, 1, 5),
                coordinate_list=[(1.0, 2.0)], parameters=["a", "b", "c"])
    base.update(kw)
    return spark.createDataFrame([tuple(base.values())], (
        "zone int, status string, request_seconds double, error string, date_requested timestamp_ntz, "
        "startdate timestamp_ntz, enddate timestamp_ntz, coordinate_list array<struct<lat:double,lon:double>>, "
        "parameters array<string>"))


def test_halving(spark):
    one = r.halved(request(spark)).orderBy("half").collect()
    assert [x.parameters for x in one] == [["a", "b"], ["c"]]
    points = r.halved(request(spark, coordinate_list=[(float(i), 0.0) for i in range(3)])).orderBy("half").collect()
    assert [len(x.coordinate_list) for x in points] == [2, 1]
    assert all(x.parameters == ["a", "b", "c"] for x in points)
    days = r.halved(request(spark, enddate=datetime(2024, 1, 10, 5))).orderBy("half").collect()
    assert [(x.startdate.day, x.enddate.day) for x in days] == [(1, 6), (7, 10)]
    assert "status" not in r.halved(request(spark)).columns


def test_unknown_parameters(spark):
    kw = dict(request_seconds=-404.0)
    assert r.retry_requests(request(spark, error="no b here", **kw)).first().parameters == ["a", "c"]
    assert r.retry_requests(request(spark, error="a b c", **kw)).isEmpty()
    assert r.retry_requests(request(spark, error="?", **kw)).first().parameters == ["a", "b", "c"]
    for code in (-429.0, -500.0):
        assert r.retry_requests(request(spark, request_seconds=code)).isEmpty()


def test_report(spark):
    rows = request(spark).unionByName(request(spark, status="SUCCESS", request_seconds=3.0)).unionByName(
        request(spark, request_seconds=-500.0))
    row = r.request_report(rows).first()
    assert (row.n_attempted, row.n_success, row.percent_success, row.percent_failed) == (3, 1, 33, 67)
    assert (row.n_ReadTimeout, row.n_InternalServerError, row.n_NotFound) == (1, 1, 0)
    assert r.unhandled_failures(rows).count() == 1
    assert r.request_report(rows.filter("zone > 9")).first().n_attempted == 0


def test_remaining(spark):
    log = spark.createDataFrame([(datetime(2024, 1, 30, 0, 0, 0),), (datetime(2024, 1, 30, 1),), (datetime(2024, 1, 29, 23),)],
                                "date_requested timestamp_ntz")
    assert r.requests_remaining(log, NOW, 9000).first()[0] == 2499
    assert r.requests_remaining(log, NOW, 12).first()[0] == 12


def test_clean_and_filter(spark):
    wide = spark.createDataFrame(
        [(44.0, -93.0, datetime(2024, 1, 2, 5, 59, 59), datetime(2024, 1, 9), 1.5, None),
         (44.5, -93.0, datetime(2024, 1, 2, 5, 59, 59), datetime(2024, 1, 9), 2.5, 3.5)],
        "lat double, lon double, validdate timestamp_ntz, date_requested timestamp_ntz, a double, b double",
    )
    cells = spark.createDataFrame([(1, 7, -21600, 44.0, -93.0)],
                                  "world_utm_id int, cell_id long, utc_offset_seconds int, lat double, lon double")
    clean = ingest.clean_response(wide, cells)
    assert clean.count() == 4
    row = clean.filter("variable = 'a' and cell_id = 7").first()
    assert (row.date, row.value) == (date(2024, 1, 1), 1.5)
    bounds = spark.createDataFrame([(7, date(2024, 1, 1), date(2024, 1, 1))] * 2, "cell_id long, date_first date, date_last date")
    assert ingest.filter_response(clean, bounds).count() == 2
    exact = spark.createDataFrame([(7, date(2024, 1, 1), "b")], "cell_id long, date date, parameter string")
    assert [x.variable for x in ingest.filter_response(clean, exact).collect()] == ["b"]
    with pytest.raises(ValueError, match="lacks"):
        ingest.clean_response(wide, cells.drop("cell_id"))


def landed(spark, types):
    """Answers to a plan: every asked point, day and parameter, requested now."""
    def responses(step, plan):
        names = [x.weather_type for x in types.collect()]
        days = F.sequence(F.to_date(F.col("startdate") - F.expr("interval 6 hours")), F.to_date(F.col("enddate") - F.expr("interval 6 hours")))
        rows = plan.withColumn("p", F.explode("coordinate_list")).withColumn("d", F.explode(days))
        wide = rows.select(
            F.col("p.lat").alias("lat"), F.col("p.lon").alias("lon"),
            (F.col("d").cast("timestamp_ntz") + F.expr("interval '1 05:59:59' day to second")).alias("validdate"),
            F.lit("2024-02-20 15:00:00").cast("timestamp_ntz").alias("date_requested"),
            *[F.when(F.array_contains("parameters", n), F.lit(1.0)).alias(n) for n in names],
        )
        done = plan.withColumn("status", F.lit("SUCCESS")).withColumn("error", F.lit(None).cast("string")).withColumn("request_seconds", F.lit(1.0)).withColumn(
            "date_requested", F.lit("2024-01-30 15:00:00").cast("timestamp_ntz"))
        return wide, done
    return responses


def test_daily_job_closes_its_gaps(spark, tmp_path):
    from croplake.catalog import CATALOG

    types = tables.seed_weather_types(CATALOG["weather_type"].empty(spark))
    utm = spark.createDataFrame([(1, 15, "T", -21600)], "world_utm_id int, utm_zone int, utm_row string, utc_offset_seconds int")
    centre = spark.createDataFrame([(1, i, round(-93 + i * 0.01, 5), 44.0) for i in range(3)],
                                   "world_utm_id int, cell_id long, lon double, lat double")
    daily = spark.createDataFrame(
        [(1, 0, date(2024, 1, 5), 1, 2.0, datetime(2024, 1, 8)), (1, 0, date(2024, 1, 6), 2, 2.0, datetime(2024, 1, 8))],
        "world_utm_id int, cell_id long, date date, weather_type_id long, value float, date_requested timestamp_ntz",
    )
    fields = need(spark, 3, first=date(2023, 12, 1))
    # values that are null stand for parameters not asked for
    steps, report = job.run_daily(daily, fields, utm, centre, types, landed(spark, types), NOW, 2500, fill=True)
    assert list(steps) == ["update", "add", "fill"]
    new = {k: s.new_rows.filter("value is not null") for k, s in steps.items()}
    assert {r.cell_id for r in steps["add"].need.collect()} == {0, 1, 2}
    assert new["update"].select(F.min("date"), F.max("date")).first() == (date(2024, 1, 6), date(2024, 2, 6))
    path = str(tmp_path / "daily")
    for rows in (daily, *new.values()):
        ingest.append_daily(rows, path)
    stored = spark.read.parquet(path)
    whole = w.merged_need(fields, w.need_of_populated(stored, utm, centre, NOW))
    left = w.fill_inventory(whole, stored, types, NOW)
    assert left.isEmpty()
    assert report.first().n_attempted == report.first().n_success > 0
    # sent again, nothing is added; what is new in it is, with ids that go on
    for rows in (daily, *new.values()):
        ingest.append_daily(rows, path)
    assert spark.read.parquet(path).count() == stored.count()
    later = daily.withColumn("date_requested", F.col("date_requested") + F.expr("interval 1 day")).unionByName(daily)
    ingest.append_daily(later, path)
    stored = spark.read.parquet(path)
    log = str(tmp_path / "log")
    ingest.append_request_log(steps["update"].requests, log)
    ingest.append_request_log(job.requests_to_log({"add": steps["add"]}), log)
    before = spark.read.parquet(log).count()
    ingest.append_request_log(steps["add"].requests, log)
    assert spark.read.parquet(log).count() == before
    logged = spark.read.parquet(log)
    assert logged.columns == ["request_id", *ingest.LOG_COLUMNS]
    for table, name in ((stored, "daily_id"), (logged, "request_id")):
        first, last, ids, rows = table.agg(F.min(name), F.max(name), F.count_distinct(name), F.count("*")).first()
        assert (first, last) == (1, rows) and ids == rows > 0


def test_append_that_broke_off_is_completed(spark, tmp_path):
    """The range of ids was noted, some rows were written: the repeat adds the others under new ids."""
    path = str(tmp_path / "daily")
    rows = spark.range(40).selectExpr(
        "cast(id % 3 as int) as world_utm_id", "id as cell_id", "date'2024-01-01' as date", "1L as weather_type_id",
        "cast(id as float) as value", "timestamp_ntz'2024-01-02 00:00:00' as date_requested",
    )
    spark.createDataFrame([(1, 40)], "first_id long, last_id long").write.parquet(ingest.reserved_ids(path))
    rows.filter("cell_id < 15").withColumn("daily_id", F.col("cell_id") + 1).write.partitionBy("world_utm_id").mode("append").parquet(path)
    ingest.append_daily(rows, path)
    ingest.append_daily(rows, path)
    got = spark.read.parquet(path)
    assert got.count() == 40 and got.select("cell_id").distinct().count() == 40
    assert sorted(r.daily_id for r in got.collect()) == [*range(1, 16), *range(41, 66)]


def test_fill_reads_needed_polygons_and_dates_only(spark, tmp_path):
    path = str(tmp_path / "daily")
    spark.range(2000).selectExpr(
        "id as daily_id", "cast(id % 8 as int) as world_utm_id", "id % 40 as cell_id", "date_add(date'2015-01-01', cast(id as int)) as date",
        "1L as weather_type_id", "cast(id as float) as value", "timestamp_ntz'2024-01-02 00:00:00' as date_requested",
    ).write.partitionBy("world_utm_id").parquet(path)
    wanted = need(spark, 3, first=date(2019, 6, 1))
    near = w.rows_near(spark.read.parquet(path), wanted, F.lit(date(2024, 2, 6)))
    near.collect()
    plan = near._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "FileScan" in x)
    filters = {k: scan.split(k + ": [", 1)[1].split("]", 1)[0] for k in ("PartitionFilters", "PushedFilters")}
    assert "array_contains" in filters["PartitionFilters"]
    assert "GreaterThanOrEqual(date" in filters["PushedFilters"] and "LessThanOrEqual(date" in filters["PushedFilters"]
    assert {r.world_utm_id for r in near.select("world_utm_id").distinct().collect()} <= {r.world_utm_id for r in wanted.collect()}


def test_failed_requests_are_sent_again(spark):
    """Unknown parameters go, time-outs are halved, within three rounds and the budget; names are checked first."""
    from croplake.catalog import CATALOG

    types = tables.seed_weather_types(CATALOG["weather_type"].empty(spark))
    utm = spark.createDataFrame([(1, 15, "T", -21600)], "world_utm_id int, utm_zone int, utm_row string, utc_offset_seconds int")
    centre = spark.createDataFrame([(1, 0, -93.0, 44.0)], "world_utm_id int, cell_id long, lon double, lat double")
    daily = spark.createDataFrame([(1, 0, date(2024, 1, 5), 1, 2.0, datetime(2024, 1, 8))],
        "world_utm_id int, cell_id long, date date, weather_type_id long, value float, date_requested timestamp_ntz")
    names = [x.weather_type for x in types.orderBy("weather_type_id").collect()]
    rounds = []

    def responses(step, plan):
        rounds.append((step, plan.count()))
        lost, late = F.array_contains("parameters", names[0]), F.datediff("enddate", "startdate") >= 9
        wide, done = landed(spark, types)(step, plan.filter(~(lost | late)))
        return wide, plan.select(
            "*", F.when(lost | late, "FAIL").otherwise("SUCCESS").alias("status"), F.when(lost, -404.0).when(late, -408.0).otherwise(1.0).alias("request_seconds"),
            F.when(lost, f"no {names[0]}").alias("error"), F.lit("2024-01-30 15:00:00").cast("timestamp_ntz").alias("date_requested"))

    steps, report = job.run_daily(daily, tables.empty_need(spark), utm, centre, types, responses, NOW, 2500)
    assert [n for s, n in rounds if s == "update"] == [2, 3, 6, 4]
    rows = steps["update"].new_rows.filter("value is not null")
    assert rows.select("weather_type_id").distinct().count() == len(names) - 1
    assert rows.select("date").distinct().count() == 32 and report.first().n_attempted == 15
    assert job.requests_to_log(steps).count() == 15 and job.rows_to_append(steps).count() >= rows.count()
    steps, report = job.run_daily(daily, tables.empty_need(spark), utm, centre, types, responses, NOW, 4)
    assert report.first().n_attempted <= 4
    with pytest.raises(ValueError, match="no weather type"):
        job.run_daily(daily, tables.empty_need(spark), utm, centre, types, responses, NOW, 4, parameter_sets=(("nothing",),))


def test_no_budget_no_requests(spark):
    plan = r.update_plan(need(spark, 5))
    assert r.budget_cut(plan, 0).isEmpty()
    assert r.update_plan(tables.empty_need(spark)).isEmpty()
    assert r.fill_plan(tables.empty_gaps(spark)).isEmpty()

from __future__ import annotations

from datetime import datetime

from croplake.catalog import NUTRIENTS
from croplake.operators import views

D = datetime


def tables(spark):
    ring = [[{"x": 0.0, "y": 0.0}, {"x": 1.0, "y": 0.0}, {"x": 1.0, "y": 1.0}, {"x": 0.0, "y": 0.0}]]
    geom = spark.createDataFrame(
        [(10, "POLYGON", ring), (11, "POLYGON", ring), (12, "POLYGON", ring)],
        "geom_id long, kind string, rings array<array<struct<x:double,y:double>>>",
    )
    organization = spark.createDataFrame([(1, "org")], "organization_id long, name string")
    field = spark.createDataFrame(
        [(1, "f1", 10, 1), (2, "f2", 99, 1)],
        "field_id long, name string, geom_id long, organization_id long",
    )
    trial = spark.createDataFrame(
        [(5, "t5", 1, D(2020, 1, 1), D(2020, 9, 1), 11, None, "{}"),
         (6, "t6", 2, D(2020, 1, 1), D(2020, 9, 1), None, None, "{}")],
        "field_trial_id long, name string, field_id long, date_start timestamp_ntz, "
        "date_end timestamp_ntz, geom_id long, grouper_id long, details string",
    )
    plot = spark.createDataFrame(
        [(100, "p", 1, 5, 12, 1), (101, "q", 1, 5, None, 2), (102, "r", 2, 6, None, 3)],
        "plot_id long, name string, field_id long, field_trial_id long, geom_id long, treatment_id int",
    ).selectExpr("*", "treatment_id as block_id", "treatment_id as replication_id")
    return organization, field, trial, plot, geom


def test_plots_without_any_geometry_drop(spark):
    _, field, trial, plot, geom = tables(spark)
    rows = views.plot_details(plot, trial, field, geom).collect()
    assert sorted(r.plot_id for r in rows) == [100, 101]


def test_field_application_reaches_every_plot(spark):
    organization, field, trial, plot, geom = tables(spark)
    plots = views.plot_details_geometry(plot, trial, field, geom, organization)
    app = spark.createDataFrame(
        [(1, 50.0, 7, 1, None, None), (2, 10.0, 7, None, None, 100), (3, 1.0, None, 1, None, None),
         (4, 2.0, 8, 1, None, None)],
        "app_id long, rate double, nutrient_source_id long, field_id long, field_trial_id long, plot_id long",
    ).selectExpr("*", "'LIME' as app_type", "cast(null as string) as app_method",
                 "timestamp_ntz'2020-05-01' as date_applied", "'lb' as rate_unit")
    share = ", ".join(f"{20.0 if n == 'n' else 0.0}D as {n}" for n in NUTRIENTS)
    source = spark.sql(
        f"select 7L as nutrient_source_id, 'urea' as nutrient, 1L as organization_id, {share} "
        f"union all select 8L, 'other', 2L, {', '.join('0D' for _ in NUTRIENTS)}"
    )
    rows = views.plot_application_summary(plots, app, source).collect()
    assert sorted((r.app_id, r.plot_id, r.rate_n) for r in rows) == [
        (1, 100, 10.0), (1, 101, 10.0), (2, 100, 2.0),
    ]
    totals = views.plot_nutrient_totals(plots, app, source).collect()
    assert sorted((r.plot_id, r.n_apps, r.rate_n) for r in totals) == [(100, 2, 12.0), (101, 1, 10.0)]


def test_season_pairs_all_plantings_with_all_harvests(spark):
    _, field, trial, plot, _ = tables(spark)
    act = spark.createDataFrame(
        [("PLANT", D(2020, 5, 1), 1, None, None), ("PLANT", D(2020, 6, 1), 1, None, None),
         ("HARVEST", D(2020, 5, 11), 1, None, None), ("HARVEST", D(2020, 9, 1), None, 5, None),
         ("PLANT", D(2020, 8, 1), None, None, 101), ("HARVEST", D(2020, 8, 3), None, None, 101)],
        "act_type string, date_performed timestamp_ntz, field_id long, field_trial_id long, plot_id long",
    )
    rows = views.season_length(act, field, trial, plot).collect()
    assert sorted(r.season_days for r in rows) == [-21, 2, 10]
    assert {r.organization_id for r in rows} == {1}


def test_owner_goes_by_priority(spark):
    _, _, trial, plot, _ = tables(spark)
    rows = spark.createDataFrame(
        [(1, 2, 5, 100), (2, None, 6, 100), (3, None, None, 100), (4, None, None, None), (5, None, 77, None)],
        "act_id long, field_id long, field_trial_id long, plot_id long",
    )
    got = {r.act_id: r.owner_field_id for r in views.owner_field(rows, trial, plot).collect()}
    assert got == {1: 2, 2: 2, 3: 1, 4: None, 5: None}


def shuffled_rows(df) -> int:
    """Rows that all exchanges of a collected ``df`` have written."""
    seen, found = set(), 0

    def walk(node):
        nonlocal found
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        rows = node.metrics().get("shuffleRecordsWritten")
        if rows.isDefined() and name == "ShuffleExchangeExec" and node.id() not in seen:
            seen.add(node.id())
            found += rows.get().value()
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return found


PLOTS = "organization string, field string, field_trial string, plot string, organization_id long, field_id long, field_trial_id long, plot_id long"


def sources_of(spark, rows):
    shares = [f"cast(n * {i + 1} / 10 as double) as {name}" for i, name in enumerate(NUTRIENTS)]
    return spark.createDataFrame(rows, "nutrient_source_id long, nutrient string, organization_id long, n double").selectExpr(
        "nutrient_source_id", "nutrient", "organization_id", *shares
    )


def test_totals_do_not_shuffle_the_fan_out(spark):
    plots = spark.createDataFrame([("o", "f", "t", "p", 1, 1, 10 + k % 15, 100 + k) for k in range(150)], PLOTS)
    app = spark.createDataFrame(
        [(float(k), k % 60, 1, None, None) for k in range(240)],
        "rate double, nutrient_source_id long, field_id long, field_trial_id long, plot_id long",
    )
    totals = views.plot_nutrient_totals(plots, app, sources_of(spark, [(k, "s", 1, 1.0) for k in range(60)]))
    assert len(totals.collect()) == 150 * 60
    assert 0 < shuffled_rows(totals) < 150 * 60


def test_totals_of_repeated_and_shared_plots(spark, monkeypatch):
    monkeypatch.setattr(views, "UNIT_PLOTS", 3, raising=False)
    plots = [(1, 1, 10 + k // 3, 100 + k) for k in range(11)]  # more plots than one list holds
    plots += [(1, 1, 10, 100), (1, 1, 10, 100)]  # three times the same
    plots += [(1, 2, 20, 100), (2, 2, 20, 100), (1, 1, 11, 104), (1, 1, 12, 104)]  # under other fields, organizations, trials
    plots += [(1, 1, 10, None), (1, 2, 20, None), (1, 2, 20, None), (None, 3, 30, 300), (2, 3, 30, 301)]
    apps = [
        (None if k % 11 == 0 else k / 4, None if k % 13 == 0 else k % 5, *parents)
        for k, parents in enumerate(
            [(1, None, None), (2, None, None), (3, 30, 301), (None, 10, None), (None, 11, 104), (None, 13, None), (None, 20, None),
             (1, 10, 100), (None, None, 100), (None, None, 104), (None, None, 109), (None, None, 300), (None, None, None), (9, 90, 900)] * 9
        )
    ]
    sources = [(k % 6, "abc"[k % 3], k % 2 + 1, float(k)) for k in range(24)] + [(0, "a", 1, 0.0)] * 2 + [(None, "n", 1, 3.0), (1, None, 1, 7.0)]

    sums, reached = {}, {}
    for rate, source, *parents in apps:
        for level, parent in enumerate(parents):
            if source is not None and parent is not None:
                sums.setdefault((level, parent), []).append((source, rate))
    for organization, field, trial, plot in plots:
        for parcel in ((0, field), (1, trial), (2, plot)):
            for source, rate in sums.get(parcel, []):
                reached.setdefault((organization, plot, source), []).append(rate)
    expected = []
    for (organization, plot, source), rates in reached.items():
        rate = None if all(r is None for r in rates) else round(sum(r for r in rates if r is not None), 6)
        for s, nutrient, of, n in sources:
            if s == source and of == organization:
                expected.append((organization, plot, source, nutrient, len(rates), rate, None if rate is None else round(rate * n / 1000, 6)))

    totals = views.plot_nutrient_totals(
        spark.createDataFrame([("o", "f", "t", "p", *row) for row in plots], PLOTS),
        spark.createDataFrame(apps, "rate double, nutrient_source_id long, field_id long, field_trial_id long, plot_id long"),
        sources_of(spark, sources),
    )
    first = f"rate_{NUTRIENTS[0]}"
    got = [
        (r.organization_id, r.plot_id, r.nutrient_source_id, r.nutrient, r.n_apps,
         *(None if r[c] is None else round(r[c], 6) for c in ("rate_product", first)))
        for r in totals.collect()
    ]
    assert len(expected) > 60 and sorted(got, key=repr) == sorted(expected, key=repr)

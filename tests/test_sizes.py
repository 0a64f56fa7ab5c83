"""Joins whose sides Spark takes for small must not broadcast them: they grow with the input."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry_file
from compare import TABLES, difference, oracle_connection
from croplake import session
from croplake.fixtures import Tables
from croplake.operators import spatial, views
from croplake.queries import QUERIES

ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="input tables are not here")


def joins(df) -> list[str]:
    """The join operators of the plan Spark would run."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.strip(" +-:*(0123456789)") for line in plan.splitlines() if "Join" in line]


def test_matrix_shuffles_its_frames(spark):
    found = joins(QUERIES["feature_matrix"](spark, SF_DIR))
    assert len(found) >= 2 and not [j for j in found if j.startswith("Broadcast")]


@pytest.mark.parametrize("name", ["acts_outside_field", "acts_outside_field_as_written"])
def test_cover_checks_shuffle_their_outlines(spark, name):
    found = joins(QUERIES[name](spark, SF_DIR))
    assert len(found) >= 3 and not [j for j in found if j.startswith("Broadcast")]


@pytest.mark.parametrize("name", ["plot_application_summary", "plot_nutrient_totals"])
def test_plots_and_sources_are_shuffled(spark, name):
    broadcast = [
        line for line in QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString().splitlines()
        if "BroadcastHashJoin" in line and ("nutrient_source_id" in line or "_geom" in line)
    ]
    assert not broadcast


def test_owners_are_shuffled(spark):
    tables = Tables(spark, SF_DIR)
    found = joins(views.owner_field(tables.act, tables.field_trial, tables.plot))
    assert len(found) >= 4 and not [j for j in found if j.startswith("Broadcast")]


@pytest.mark.parametrize("name", ["execution_summary", "raw_summary_counts", "raw_summary", "duplicate_executions", "execution_arguments"])
def test_lineage_is_shuffled(spark, name):
    found = joins(QUERIES[name](spark, SF_DIR))
    assert found and not [j for j in found if j.startswith("Broadcast")]


def test_counts_are_dealt_by_their_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    df = QUERIES["raw_summary_counts"](spark, SF_DIR)
    assert len(joins(df)) == 1  # executions are looked up once
    # as many tasks as the rows ask for, whatever spark.sql.shuffle.partitions is
    assert df.rdd.getNumPartitions() >= spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count() // 100


@pytest.mark.parametrize("name", ["raw_summary_counts", "raw_summary"])
def test_executions_and_arguments_of_no_use(spark, tmp_path, name):
    """Orders twice, under one function and under two, lines without an order, null keys."""
    for table in TABLES:
        os.symlink(f"{SF_DIR}/{table}.parquet", tmp_path / f"{table}.parquet") if table not in ("orders", "lineitem") else None
    orders, lineitem = (f"SELECT * FROM '{SF_DIR}/{table}.parquet'" for table in ("orders", "lineitem"))
    for table, rows in {
        "orders": f"{orders} UNION ALL {orders} WHERE o_orderkey % 5 = 0 "
                  f"UNION ALL SELECT * REPLACE (o_custkey + 1 AS o_custkey) FROM ({orders}) WHERE o_orderkey % 3 = 0 "
                  f"UNION ALL SELECT * REPLACE (NULL AS o_orderkey) FROM ({orders}) WHERE o_orderkey % 7 = 0",
        "lineitem": f"SELECT * REPLACE (CASE l_orderkey % 11 WHEN 0 THEN NULL WHEN 1 THEN -l_orderkey ELSE l_orderkey END AS l_orderkey) FROM ({lineitem})",
    }.items():
        duckdb.sql(f"COPY ({rows}) TO '{tmp_path}/{table}.parquet' (FORMAT parquet)")
    df = entry_file.queries()[name](spark, str(tmp_path))
    con = oracle_connection(str(tmp_path))
    assert difference(df, con, entry_file.oracle_sql()[name]) is None


def test_shapes_are_judged_after_they_are_dealt_out(spark, monkeypatch):
    written = []
    real = spatial.cut_lineage
    monkeypatch.setattr(spatial, "cut_lineage", lambda df: written.append(df) or real(df))
    found = joins(QUERIES["invalid_geometries"](spark, SF_DIR))
    assert found and not [j for j in found if j.startswith("Broadcast")]
    plan = written[0]._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "reason" in plan and "not closed" not in plan[plan.index("REPARTITION_BY_NUM"):]


def test_tasks_stay_small_where_the_size_is_left_to_spark(spark):
    other = spark.newSession()
    other.conf.unset(ADVISORY)
    Tables(other, SF_DIR)
    assert other.conf.get(ADVISORY) == "8m"
    other.conf.set(ADVISORY, "16m")
    Tables(other, SF_DIR)
    assert other.conf.get(ADVISORY) == "16m"


@pytest.mark.parametrize("events", ["all of one day", "none"])
def test_ids_of_nothing_to_append(spark, tmp_path, events):
    for name in TABLES:
        os.symlink(f"{SF_DIR}/{name}.parquet", tmp_path / f"{name}.parquet") if name != "events" else None
    duckdb.sql(
        f"COPY (SELECT * REPLACE (TIMESTAMP '2024-01-30 12:00:00' AS ts) FROM '{SF_DIR}/events.parquet' "
        f"WHERE {events != 'none'}) TO '{tmp_path}/events.parquet' (FORMAT parquet)"
    )
    df = entry_file.queries()["daily_append_ids"](spark, str(tmp_path))
    con = oracle_connection(str(tmp_path))
    assert difference(df, con, entry_file.oracle_sql()["daily_append_ids"]) is None

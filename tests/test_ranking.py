from __future__ import annotations

from collections import defaultdict
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from croplake.operators import ranking
from croplake.operators.ranking import batches, numbered, with_even_bucket, with_previous_time

few = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@few
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.integers(-50, 50)), max_size=60))
def test_numbered_counts_up_per_key(spark, rows):
    df = spark.createDataFrame(rows, "k int, v long")
    got = numbered(df, ["k"], ["v"], "rn", total="n", rows=7).collect()
    want = defaultdict(list)
    for k, v in rows:
        want[k].append(v)
    seen = defaultdict(list)
    for r in got:
        assert r.n == len(want[r.k])
        seen[r.k].append((r.rn, r.v))
    for k, pairs in seen.items():
        pairs.sort()
        assert [p[0] for p in pairs] == list(range(1, len(pairs) + 1))
        assert [p[1] for p in pairs] == sorted(want[k])


def test_hot_key_is_spread_over_buckets(spark):
    df = spark.range(50000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    out = numbered(df, ["k"], ["v"], rows=1000)
    assert out.filter("rn <> v + 1").isEmpty()


def test_buckets_are_even_whatever_the_values(spark):
    """Ids 8,192 apart, times of one second for two million rows, and a handful of far-off ones."""
    far = spark.range(2_000_000).select(
        F.when(F.col("id") % 100_000 == 0, F.col("id") * 10**9).otherwise(F.col("id") * 8192).alias("v"),
        F.lit(datetime(2024, 1, 1)).alias("created"), F.col("id").cast("string").alias("name"),
    )
    for order in (["v"], ["created", "name"]):
        sizes = [r["count"] for r in with_even_bucket(far, order, name="b").groupBy("b").count().collect()]
        assert len(sizes) >= 30 and max(sizes) < 150_000 and sum(sizes) == 2_000_000
    rises = with_even_bucket(far.select("v"), ["v"], name="b").groupBy("b").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    rows = sorted((r.b, r.low, r.high) for r in rises.collect())
    assert all(a[2] < b[1] for a, b in zip(rows, rows[1:]))


def test_versions_of_two_million_candidates_of_one_moment(spark):
    from croplake.operators.keyed import next_versions

    schema = "function_name string, major int, function_type_id long, minor int"
    stored = spark.createDataFrame([("f", 1, 1, 4)], schema)
    rows = spark.range(2_000_000).select(
        F.lit("f").alias("function_name"), F.lit(1).alias("major"), F.lit(1).cast("long").alias("function_type_id"),
        F.lit(datetime(2024, 1, 1)).alias("created"), F.col("id").alias("note"),
    )
    got = next_versions(stored, rows).agg(
        F.min("minor"), F.max("minor"), F.sum((F.col("minor") != F.col("note") + 5).cast("int"))
    ).first()
    assert tuple(got) == (5, 2_000_004, 0)


@few
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 400)), max_size=40, unique=True))
def test_previous_time_looks_over_hours(spark, rows):
    start = datetime(2024, 1, 1)
    data = [(k, start + timedelta(minutes=17 * m)) for k, m in rows]
    df = spark.createDataFrame(data, "k int, at timestamp_ntz")
    got = {(r.k, r.at): r.previous for r in with_previous_time(df, ["k"], "at", rows=5).collect()}
    for k in (0, 1):
        times = sorted(t for kk, t in data if kk == k)
        for before, now in zip([None, *times], times):
            assert got[(k, now)] == before


def test_batches_keep_everything_in_order(spark):
    df = spark.range(25).select((F.col("id") % 2).alias("k"), F.col("id").alias("v"))
    out = batches(df, ["k"], ["v"], ["v"], 5, rows=4).collect()
    rows = sorted((r.k, r.batch, [x.v for x in r.rows]) for r in out)
    assert [len(r[2]) for r in rows] == [5, 5, 3, 5, 5, 2]
    assert [v for k, _, vs in rows if k == 0 for v in vs] == list(range(0, 25, 2))


def test_only_large_keys_are_numbered(spark, monkeypatch):
    seen = []
    real = ranking.numbered
    monkeypatch.setattr(ranking, "numbered", lambda df, *a, **k: seen.append(sorted(r.v for r in df.collect())) or real(df, *a, **k))
    df = spark.createDataFrame([(1, i) for i in range(5)] + [(2, i) for i in range(11)] + [(None, 3), (None, 1)], "k int, v int")
    got = {(r.k, r.batch): [x.v for x in r.rows] for r in batches(df, ["k"], ["v"], ["v"], 5).collect()}
    assert got == {(1, 0): [0, 1, 2, 3, 4], (2, 0): [0, 1, 2, 3, 4], (2, 1): [5, 6, 7, 8, 9], (2, 2): [10], (None, 0): [1, 3]}
    assert seen == [list(range(11))]
    batches(df, ["k"], ["v"], ["v"], 11).collect()
    assert len(seen) == 1

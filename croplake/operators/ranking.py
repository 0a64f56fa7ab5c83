"""Row numbers, gaps and bounded batches that never put a whole key into one task.

A window over a key holding a third of all rows runs in one task. Here a key is cut into buckets
of its ordering columns: numbers are given inside each bucket, and a small table of bucket counts
gives every bucket its starting number. Bounds of the buckets come from a sketch of the ordering
columns (:func:`with_even_bucket`), so that a bucket holds a bounded number of rows of a key whatever ids
and times look like. They change which task numbers a row, never the number.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from croplake.session import cut_lineage, shuffled

#: places (distinct values of the ordering columns) of a bucket, about, up to so many buckets
BUCKET_ROWS, MOST_BUCKETS = 50_000, 4096
#: places of the sketch for each bucket
SKETCHED = 16


def with_even_bucket(df: DataFrame, order: list[str], rows: int = BUCKET_ROWS, name: str = "bucket") -> DataFrame:
    """``df`` plus ``name``: the row's bucket of ``order``, of about ``rows`` distinct places, rising with them.

    The sketch is a sample of the distinct places by their hash, ``SKETCHED`` for each bucket and so
    never more than some 65,536 of them; every 16th in order is a bound. It is made within the query
    that uses it. A row finds its bucket by halving. Few rows are one bucket, without a sketch.
    """
    place, mark = F.struct(*order), F.xxhash64(*order)
    n = df.agg(F.approx_count_distinct(mark).alias("n")).scalar()
    buckets = F.least(F.lit(MOST_BUCKETS), F.ceil(n / F.lit(rows)))
    thin = F.greatest(F.lit(1).cast("long"), F.floor(n / (buckets * F.lit(SKETCHED))))
    sample = df.filter((n > F.lit(rows)) & (F.pmod(mark, thin) == 0)).agg(
        F.array_sort(F.collect_set(place)).alias("s")
    )
    bounds = sample.select(
        F.filter("s", lambda _, i: (i + 1) % SKETCHED == 0).alias("bounds")
    ).scalar()
    halves = F.array(*[F.lit(1 << k) for k in reversed(range(MOST_BUCKETS.bit_length() + 1))])
    found = F.aggregate(
        halves, F.lit(0),
        lambda at, step: at + F.when(
            (at + step <= F.size("_bounds")) & (F.get("_bounds", at + step - 1) <= F.col("_place")), step
        ).otherwise(F.lit(0)),
    )
    some = df.withColumns({"_bounds": bounds, "_place": place})
    bucket = F.when(F.size("_bounds") == 0, F.lit(0)).otherwise(found).cast("long")
    return some.withColumn(name, bucket).drop("_bounds", "_place")


def key_struct(df: DataFrame, keys: list[str]) -> Column:
    """The key columns as one struct. Nulls in equal places of two structs are equal, so a join on
    it lets nulls match, and what was grouped or windowed by it is joined without another shuffle.
    """
    return F.struct(*[df[c].alias(f"k{i}") for i, c in enumerate(keys)])


def null_safe_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "inner"
) -> DataFrame:
    """Equi-join in which nulls match nulls; the key columns of ``left`` stay."""
    if any(left.schema[c].dataType != right.schema[c].dataType for c in on):
        renamed = right.select(
            *[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns]
        )
        same = reduce(lambda a, b: a & b, [left[c].eqNullSafe(renamed[f"_r_{c}"]) for c in on])
        return left.join(renamed, same, how).drop(*[f"_r_{c}" for c in on])
    keyed_left = left.withColumn("_key", key_struct(left, on))
    rest = [c for c in right.columns if c not in on]
    keyed_right = right.select(key_struct(right, on).alias("_key"), *rest)
    return keyed_left.join(keyed_right, "_key", how).drop("_key")


def numbered(
    df: DataFrame, keys: list[str], order: list[str], name: str = "rn", total: str | None = None,
    rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``df`` plus ``name``: 1, 2, … per key by ``order``, in buckets of about ``rows``.

    ``total`` names one more column, the number of rows of the key.
    """
    places = [f"k{i}" for i in range(len(keys))]
    work = _with_bucket(df, keys, order, rows)
    counts = work.groupBy("_key").agg(F.count("*").alias("_n")).select("_key", "_key.*", "_n")
    before = W.partitionBy(*places).orderBy("b").rowsBetween(W.unboundedPreceding, -1)
    extra = [F.sum("_n").over(W.partitionBy(*places)).alias(total)] if total else []
    starts = counts.select(
        "_key", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"), *extra
    )
    inside = W.partitionBy("_key").orderBy(*order)
    local = work.withColumn("_local", F.row_number().over(inside))
    return (
        local.join(starts, "_key")
        .withColumn(name, F.col("_start") + F.col("_local"))
        .drop("_key", "_start", "_local")
    )


def _with_bucket(df: DataFrame, keys: list[str], order: list[str], rows: int) -> DataFrame:
    """``df`` plus ``_key``: its key columns (k0, k1, …) and bucket (b) as one struct."""
    # read for the sketch, the counts and the rows: what leads to it is computed once
    work = with_even_bucket(cut_lineage(df), order, rows, "_bucket")
    fields = [F.col(c).alias(f"k{i}") for i, c in enumerate(keys)]
    return work.withColumn("_key", F.struct(*fields, F.col("_bucket").alias("b"))).drop("_bucket")


def with_previous_time(
    df: DataFrame, keys: list[str], time_col: str, name: str = "previous", rows: int = BUCKET_ROWS
) -> DataFrame:
    """``df`` plus the time just before each row's within its key; times per key must be distinct.

    Inside a bucket the window finds it; the first row of a bucket takes the last time of the
    nearest earlier bucket that has any.
    """
    places = [f"k{i}" for i in range(len(keys))]
    work = _with_bucket(df, keys, [time_col], rows)
    last = work.groupBy("_key").agg(F.max(time_col).alias("_last")).select("_key", "_key.*", "_last")
    by_bucket = W.partitionBy(*places).orderBy("b")
    carried = last.select("_key", F.lag("_last").over(by_bucket).alias("_carried"))
    inside = W.partitionBy("_key").orderBy(time_col)
    local = work.withColumn("_lag", F.lag(time_col).over(inside))
    return (
        local.join(carried, "_key")
        .withColumn(name, F.coalesce("_lag", "_carried"))
        .drop("_key", "_lag", "_carried")
    )


def batches(
    df: DataFrame, keys: list[str], order: list[str], values: list[str], size: int,
    name: str = "rows", rows: int = BUCKET_ROWS, counts: DataFrame | None = None,
) -> DataFrame:
    """Rows of each key as arrays of at most ``size`` structs: key, ``batch`` (0, 1, …), rows.

    Keys of no more than ``size`` rows are one batch and need no numbers; only rows of the others are
    numbered. ``counts`` are the rows of each key (``n_rows``) where they are known; ``df`` is then taken for
    a written copy.
    """
    work = cut_lineage(df) if counts is None else df  # read for the counts and the rows
    if counts is None:
        counts = work.groupBy(*keys).agg(F.count("*").alias("n_rows"))
    large = cut_lineage(counts.filter(F.col("n_rows") > size).select(*keys))
    if large.isEmpty():
        return _one_batch(work, keys, order, values, name)
    small = null_safe_join(work, shuffled(large), keys, "left_anti")
    rest = null_safe_join(work, shuffled(large), keys, "left_semi")
    return _one_batch(small, keys, order, values, name).unionByName(
        _numbered_batches(rest, keys, order, values, size, name, rows)
    )


def _one_batch(df: DataFrame, keys: list[str], order: list[str], values: list[str], name: str) -> DataFrame:
    """Rows of each key as one array by ``order``."""
    item = F.struct(*order, *[v for v in values if v not in order])
    packed = df.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("_items"))
    return packed.select(*keys, F.lit(0).cast("long").alias("batch"), _values("_items", values).alias(name))


def _values(items: str, values: list[str]) -> Column:
    return F.transform(items, lambda r: F.struct(*[r[v].alias(v) for v in values]))


def _numbered_batches(
    df: DataFrame, keys: list[str], order: list[str], values: list[str], size: int, name: str, rows: int
) -> DataFrame:
    rn = numbered(df, keys, order, "_rn", rows=rows)
    batch = F.floor((F.col("_rn") - 1) / F.lit(size)).cast("long")
    item = F.struct(F.col("_rn"), *values)
    packed = rn.groupBy(*keys, batch.alias("batch")).agg(
        F.array_sort(F.collect_list(item)).alias("_items")
    )
    return packed.select(*keys, "batch", _values("_items", values).alias(name))

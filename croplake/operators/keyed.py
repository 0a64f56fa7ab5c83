"""Batch lookups, inserts and updates by natural key.

The input is a DataFrame of candidate rows, not one row per call. A write is single-writer: two
jobs that insert into one table at a time may hand out one id twice.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from croplake.catalog import TableSpec
from croplake.operators.ranking import BUCKET_ROWS, null_safe_join, numbered
from croplake.session import cut_lineage


def _now(now: datetime | str | None) -> Column:
    if now is None:
        return F.expr(
            "convert_timezone(current_timezone(), 'UTC', cast(current_timestamp() as timestamp_ntz))"
        )
    return F.lit(str(now)).cast("timestamp_ntz")


def _key(spec: TableSpec, by: str) -> list[str]:
    key = spec.lookup_key if by == "lookup" else spec.unique_key
    if not key:
        raise ValueError(f"table {spec.name} has no {by} key")
    return list(key)


def find_ids(
    existing: DataFrame, candidates: DataFrame, spec: TableSpec, by: str = "lookup"
) -> DataFrame:
    """``candidates`` plus the id of a stored row with the same key; null where there is none.

    ``by="lookup"`` compares the required columns only, ``by="unique"`` the uniqueness rule.
    Nulls match nulls. Of several matches the smallest id is given.
    """
    key = _key(spec, by)
    # the stored table is reduced to the keys in question first; few keys are sent to where it lies
    wanted = candidates.select(*key).distinct()
    hits = null_safe_join(existing.select(*key, spec.id_col), wanted, key)
    stored = hits.groupBy(*key).agg(F.min(spec.id_col).alias(spec.id_col))
    # joined by another expression than it is grouped by: the shuffle in between is what lets
    # Spark split a key that many candidates share
    return null_safe_join(candidates.drop(spec.id_col), stored, key, "left")


def rows_by_id(existing: DataFrame, ids: DataFrame, spec: TableSpec) -> DataFrame:
    """Stored rows for each id of ``ids``."""
    return ids.select(spec.id_col).join(existing, spec.id_col)


def missing_ids(existing: DataFrame, ids: DataFrame, spec: TableSpec) -> DataFrame:
    """Ids of ``ids`` without a stored row."""
    return ids.select(spec.id_col).join(existing.select(spec.id_col), spec.id_col, "left_anti")


def rows_by_key(existing: DataFrame, keys: DataFrame, key: list[str]) -> DataFrame:
    """Stored rows for each composite key of ``keys``; a null in a key matches nothing."""
    return keys.select(*key).distinct().join(existing, key)


def with_defaults(rows: DataFrame, spec: TableSpec, now: datetime | str | None = None) -> DataFrame:
    """Rows with all columns of the table (without its id), defaults put in for nulls."""
    columns = []
    for f in spec.schema.fields:
        if f.name == spec.id_col:
            continue
        value = F.col(f.name) if f.name in rows.columns else F.lit(None)
        if f.name in ("created", "last_updated"):
            value = F.coalesce(value.cast(f.dataType), _now(now))
        elif f.name in spec.defaults:
            value = F.coalesce(value.cast(f.dataType), F.expr(spec.defaults[f.name]))
        columns.append(value.cast(f.dataType).alias(f.name))
    return rows.select(*columns)


def allocate_ids(
    rows: DataFrame, id_col: str, key: list[str], start: Column | int,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Number ``rows`` densely from ``start``; ``key`` must be unique in ``rows``.

    Rows are numbered inside buckets of the key's hash, as many as there are times ``bucket_rows``
    rows, and the bucket counts give each bucket its offset. Both depend on the rows alone, so a
    lost task gives the same ids again.
    """
    rows = cut_lineage(rows)  # read for the counts and for the rows
    count = rows.agg(F.count("*").alias("n")).scalar()
    buckets = F.greatest(F.lit(1).cast("long"), F.ceil(count / F.lit(bucket_rows)))
    work = rows.withColumn("_bucket", F.pmod(F.xxhash64(*key), buckets))
    counts = work.groupBy("_bucket").agg(F.count("*").alias("_n"))
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    local = F.row_number().over(W.partitionBy("_bucket").orderBy(*key))
    first = F.lit(start) if isinstance(start, int) else start
    return (
        work.withColumn("_local", local)
        .join(offsets, "_bucket")
        .withColumn(id_col, (first + F.col("_offset") + F.col("_local") - 1).cast("long"))
        .drop("_bucket", "_local", "_offset")
    )


def _one_per_key(candidates: DataFrame, key: list[str]) -> DataFrame:
    rest = [c for c in candidates.columns if c not in key]
    if not rest:
        return candidates.select(*key).distinct()
    picked = candidates.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_row"))
    return picked.select(*key, "_row.*")


def next_id(existing: DataFrame, spec: TableSpec) -> Column:
    """One more than the largest stored id, as a scalar subquery."""
    return existing.agg((F.coalesce(F.max(spec.id_col), F.lit(0)) + 1).alias("next")).scalar()


def new_rows(
    existing: DataFrame, candidates: DataFrame, spec: TableSpec,
    now: datetime | str | None = None, by: str = "lookup", start: int | None = None,
) -> DataFrame:
    """Rows to append so that every candidate has a stored row; ids continue those stored, or begin with ``start``.

    Candidates of one key give one row (the smallest of them, so that reruns agree).
    """
    key = _key(spec, by)
    rows = candidates.drop(spec.id_col) if spec.id_col else candidates
    unknown = null_safe_join(rows, existing.select(*key), key, "left_anti")
    rows = with_defaults(_one_per_key(unknown, key), spec, now)
    if spec.id_col is None:
        return rows
    numbered = allocate_ids(rows, spec.id_col, key, next_id(existing, spec) if start is None else start)
    return numbered.select(*[f.name for f in spec.schema.fields])


def insert_or_get(
    existing: DataFrame, candidates: DataFrame, spec: TableSpec,
    now: datetime | str | None = None, by: str = "lookup",
) -> tuple[DataFrame, DataFrame]:
    """``(rows to append, candidates with their id)``; a second run with the result adds nothing.

    The new rows are cut from their lineage before they are used twice: appended and joined. Their
    first id is fixed here, whatever is appended to the stored table meanwhile.
    """
    if spec.id_col:
        top = existing.agg(F.max(spec.id_col)).first()[0]
        fresh = new_rows(existing, candidates, spec, now, by, (top or 0) + 1)
    else:
        fresh = cut_lineage(new_rows(existing, candidates, spec, now, by))
    key = _key(spec, by)
    columns = key + ([spec.id_col] if spec.id_col else [])
    known = existing.select(*columns).unionByName(fresh.select(*columns))
    if spec.id_col is None:
        return fresh, null_safe_join(candidates, known, key, "left_semi")
    return fresh, find_ids(known, candidates, spec, by)


def insert_missing(
    existing: DataFrame, candidates: DataFrame, spec: TableSpec, now: datetime | str | None = None
) -> DataFrame:
    """Rows to append for keys not stored yet (on a stored key: do nothing)."""
    return new_rows(existing, candidates, spec, now, by="unique")


def apply_updates(
    existing: DataFrame, updates: DataFrame, spec: TableSpec, now: datetime | str | None = None
) -> DataFrame:
    """The table after ``updates`` (by id, one row each) replaced values and ``last_updated``.

    Columns the updates lack stay; updates of unknown ids are ignored, as an update of no row. One
    join, so the table is read and shuffled once.
    """
    hit = F.col("u._hit")
    columns = [
        F.when(hit, _now(now)).otherwise(F.col(f"e.{c}")).alias(c) if c == "last_updated"
        else F.when(hit, F.col(f"u.{c}")).otherwise(F.col(f"e.{c}")).alias(c)
        if c in updates.columns and c != spec.id_col else F.col(f"e.{c}")
        for c in existing.columns
    ]
    marked = updates.withColumn("_hit", F.lit(True)).alias("u")
    same = F.col(f"e.{spec.id_col}") == F.col(f"u.{spec.id_col}")
    return existing.alias("e").join(marked, same, "left").select(*columns)


def next_versions(function: DataFrame, candidates: DataFrame) -> DataFrame:
    """``candidates`` plus ``minor``: the next free one per (name, major, type).

    Several candidates of one function get consecutive numbers, by ``created``.
    """
    key = ["function_name", "major", "function_type_id"]
    top = function.groupBy(*key).agg(F.max("minor").alias("_top"))
    order = ["created"] + [c for c in candidates.columns if c not in key + ["created"]]
    placed = numbered(candidates, key, order, "_place")
    return (
        null_safe_join(placed, top, key, "left")
        .withColumn("minor", (F.coalesce("_top", F.lit(-1)) + F.col("_place")).cast("int"))
        .drop("_top", "_place")
    )


def link_many(objects: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Object ↔ key link rows: each object with the keys of its ``on`` value (its run)."""
    return objects.join(keys, on)

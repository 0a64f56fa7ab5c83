"""Exact dedup: an immutable snapshot screened by static binary-fuse filters, a new batch grouped by itself.

The snapshot is held as digest groups dealt into buckets, each with a filter of about nine bits a digest. A new
batch is first reduced to its own groups; their digests are screened by the filter of their bucket; those that
pass join the exact groups, and a pair counts only after the normalised texts are the same byte for byte.

Null texts count as empty. Rows of one id and one text stay or go together. Null ids never stay while an equal
text has an id; without any id the text's rows stay. Empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens

#: Digests of a bucket: the size of one filter and of one task's group.
BUCKET_KEYS = 50_000


def normalised(text: Column) -> Column:
    """Null as empty; every run of the six ASCII white space characters as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


# --- the filter ---------------------------------------------------------------------------------------------


def _places(keys: np.ndarray, seed: int, length: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Three places in neighbouring segments, and the byte to be found there, for each key."""
    h = tokens.mix(keys + np.uint64(seed))
    first = ((h >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)
    g = tokens.mix(h)
    mask = np.uint64(length - 1)
    within = [(g >> np.uint64(s) & mask).astype(np.int64) for s in (0, 20, 40)]
    return np.stack([(first + k) * length + w for k, w in enumerate(within)]), (h & np.uint64(255)).astype(np.uint8)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment length, segments, bytes) of a filter that holds the distinct 64-bit ``keys``."""
    keys = np.unique(keys)
    n = len(keys)
    length = 1 << max(2, min(16, int(np.log(max(n, 2)) / np.log(3.33) + 2.25)))
    room = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 2)))
    for seed in range(1, 200):
        segments = max(1, -(-int(n * (room + 0.02 * (seed - 1))) // length) - 2)
        size = (segments + 2) * length
        place, byte = _places(keys, seed, length, segments)
        count = np.bincount(place.ravel(), minlength=size)
        total = np.zeros(size, np.int64)  # of the numbers of the keys still there
        for p in place:
            total += np.bincount(p, weights=np.arange(n), minlength=size).astype(np.int64)
        taken: list[tuple[np.ndarray, np.ndarray]] = []
        left = n
        while left:
            single = np.flatnonzero(count == 1)
            if not len(single):
                break
            key, at = np.unique(total[single], return_index=True)
            taken.append((key, single[at]))
            for p in place[:, key]:
                np.subtract.at(count, p, 1)
                np.subtract.at(total, p, key)
            left -= len(key)
        if not left:
            cells = np.zeros(size, np.uint8)
            for key, at in reversed(taken):
                cells[at] = 0
                cells[at] = byte[key] ^ np.bitwise_xor.reduce(cells[place[:, key]], axis=0)
            return seed, length, segments, cells.tobytes()
    raise ValueError("no seed fits these keys")


def may_hold(keys: np.ndarray, seed: int, length: int, segments: int, cells: bytes) -> np.ndarray:
    """True for every key of the filter, and for about one of 256 others."""
    place, byte = _places(keys, seed, length, segments)
    return np.bitwise_xor.reduce(np.frombuffer(cells, np.uint8)[place], axis=0) == byte


# --- snapshot and batch -------------------------------------------------------------------------------------


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, sha) of every row: SHA-256 of the normalised text in UTF-8."""
    return docs.select("doc_id", F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("sha"))


def groups(found: DataFrame) -> DataFrame:
    """(sha, keep_id, size): one row per text; counted in every task before the shuffle."""
    return found.groupBy("sha").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("size"))


def _bucket(buckets: int) -> tuple[Column, Column]:
    key = F.conv(F.hex(F.substring("sha", 1, 7)), 16, 10).cast("long")
    return key.alias("key"), F.pmod(F.crc32(F.substring("sha", 8, 8)), F.lit(buckets)).alias("bucket")


def filters(snapshot: DataFrame, buckets: int) -> DataFrame:
    """One filter per bucket of the snapshot's digests."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([(group["bucket"].iloc[0], *build_filter(group["key"].to_numpy(np.uint64)))], columns=["bucket", "seed", "length", "segments", "cells"])

    return snapshot.select(*_bucket(buckets)).groupBy("bucket").applyInPandas(build, "bucket long, seed long, length long, segments long, cells binary")


def screened(batch: DataFrame, kept_filters: DataFrame, buckets: int) -> DataFrame:
    """Rows of ``batch(sha, ...)`` whose digest passes the filter of its bucket."""

    def screen(new: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(new) or not len(held):
            return new[["sha"]].iloc[:0]
        row = held.iloc[0]
        ok = may_hold(new["key"].to_numpy(np.uint64), int(row["seed"]), int(row["length"]), int(row["segments"]), row["cells"])
        return new.loc[ok, ["sha"]]

    keyed = batch.select("sha", *_bucket(buckets))
    passed = keyed.groupBy("bucket").cogroup(kept_filters.groupBy("bucket")).applyInPandas(screen, "sha binary")
    return batch.join(passed, "sha", "left_semi")


def same_bytes(pairs: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """The ``pairs(sha, old_id, new_id)`` whose texts are the same byte for byte; texts are read for these ids only."""
    pairs = common.written(pairs, "pairs")

    def texts(docs: DataFrame, at: str, name: str) -> DataFrame:
        some = common.with_ids(docs.select("doc_id", "text"), pairs.select(at), "doc_id", "left_semi")
        text = normalised(F.col("text"))
        return some.select(F.col("doc_id").alias(f"{name}_id"), text.alias(name), F.unhex(F.sha2(text, 256)).alias(f"{name}_sha"))

    a, b = texts(old, "old_id", "a"), texts(new, "new_id", "b")
    both = pairs.join(a, pairs["old_id"].eqNullSafe(a["a_id"]) & (pairs["sha"] == a["a_sha"]))
    both = both.join(b, both["new_id"].eqNullSafe(b["b_id"]) & (both["sha"] == b["b_sha"]))
    return both.where("a = b").select("sha").distinct()


@dataclass(frozen=True)
class Snapshot:
    """Documents that don't change any more: their digests, groups and filters, written once and read by every batch."""

    docs: DataFrame
    rows: DataFrame
    groups: DataFrame
    filters: DataFrame
    buckets: int


def snapshot_of(docs: DataFrame) -> Snapshot:
    rows = common.written(digests(docs), "digests")
    found = common.written(groups(rows), "groups")
    buckets = max(1, -(-found.count() // BUCKET_KEYS))
    return Snapshot(docs, rows, found, common.written(filters(found, buckets), "filters"), buckets)


def dedup(snapshot: DataFrame | Snapshot, batch: DataFrame) -> DataFrame:
    """Decisions on all rows of ``snapshot`` and ``batch`` (both with doc_id and text).

    Several batches may be held against one :func:`snapshot_of`, whose filters are not built again. Returns
    doc_id, keep_id (smallest doc_id of the text), group_size, kept, text_sha256.
    """
    if not isinstance(snapshot, Snapshot):
        snapshot = snapshot_of(snapshot)
    old, fresh = snapshot.groups, common.written(digests(batch), "digests")
    rows = snapshot.rows.withColumn("fresh", F.lit(False)).union(fresh.withColumn("fresh", F.lit(True)))
    new = common.written(groups(fresh), "groups")
    hits = screened(new, snapshot.filters, snapshot.buckets)
    pairs = hits.select("sha", F.col("keep_id").alias("new_id")).join(old.select("sha", F.col("keep_id").alias("old_id")), "sha")
    equal = same_bytes(pairs, snapshot.docs, batch).withColumn("equal", F.lit(True))
    both = (
        old.select("sha", F.col("keep_id").alias("old_id"), F.col("size").alias("old_size"))
        .join(new.select("sha", F.col("keep_id").alias("new_id"), F.col("size").alias("new_size")), "sha", "full")
        .join(equal, "sha", "left")
    )
    joined = F.col("equal") | F.col("old_size").isNull() | F.col("new_size").isNull()

    def side(own: str) -> Column:
        merged = F.struct(F.least("old_id", "new_id").alias("keep_id"), (F.coalesce("old_size", F.lit(0)) + F.coalesce("new_size", F.lit(0))).alias("size"))
        return F.when(joined, merged).otherwise(F.struct(F.col(f"{own}_id").alias("keep_id"), F.col(f"{own}_size").alias("size")))

    found = both.select("sha", side("old").alias("old"), side("new").alias("new"))
    out = rows.join(found, "sha").select("doc_id", "sha", F.when(F.col("fresh"), F.col("new")).otherwise(F.col("old")).alias("of"))
    return out.select(
        "doc_id", F.col("of.keep_id").alias("keep_id"), F.col("of.size").alias("group_size"),
        F.col("doc_id").eqNullSafe(F.col("of.keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )


def _halves(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One half of the ids as the snapshot, the other as the new batch."""
    fresh = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1
    return docs.where(~fresh), docs.where(fresh)


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(*_halves(common.table(spark, sf_dir, "documents").select("doc_id", "text")))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that stay."""
    found = common.written(dedup(*_halves(docs.select("doc_id", "text"))), "exact")
    gone = found.where(~F.col("kept")).select("doc_id", F.unhex("text_sha256").alias("sha")).distinct()
    gone = common.sized(common.written(gone, "gone").select(F.col("doc_id").alias("__id"), F.col("sha").alias("__sha")))
    same = docs["doc_id"].eqNullSafe(gone["__id"]) & (F.unhex(F.sha2(normalised(docs["text"]), 256)) == gone["__sha"])
    return docs.join(gone, same, "left_anti")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""

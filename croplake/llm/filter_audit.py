"""Interaction of filters: what each removes at every place of every order, from the lattice of filter subsets.

A document fails a set of filters, held as a bit mask. What the mask leaves open is nothing but a count, so that the
documents are reduced to at most ``2**n`` masks a part before any order is looked at. An order of the filters is a path
through the lattice of subsets, from none applied to all; its step from a state by a filter is an edge, and all orders
that take it there see the same numbers. Paths are counted forward (orders that reach a state) and backward (orders
that go on from it to the end): their product is the number of orders through an edge, which weighs the edge's
removals for the Shapley sums. Steps of single orders are read from the same edges.

The filters (whole texts, null as empty): see :func:`masked`. A row of a null doc_id ranks after all ids, so it fails E
where any row with an id has its text. Rows of one id don't precede one another. Of several labels of a document the
highest count. Null lang is the part ``""``. An empty table gives no rows.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

FILTERS = "ABCDE"
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 200, 50, 3
_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


# --- the lattice --------------------------------------------------------------------------------------------


def path_counts(n: int) -> tuple[list[int], list[int]]:
    """For every subset of ``n`` filters: orders that reach it, and orders that go on from it until all are applied."""
    forward, backward = [0] * (1 << n), [0] * (1 << n)
    forward[0] = backward[-1] = 1
    for state in range(1, 1 << n):
        forward[state] = sum(forward[state ^ 1 << f] for f in range(n) if state >> f & 1)
    for state in reversed(range((1 << n) - 1)):
        backward[state] = sum(backward[state | 1 << f] for f in range(n) if not state >> f & 1)
    return forward, backward


def edges(n: int) -> list[tuple[int, int, int]]:
    """(state, filter, orders that take this edge)."""
    forward, backward = path_counts(n)
    return [(s, f, forward[s] * backward[s | 1 << f]) for s in range(1 << n) for f in range(n) if not s >> f & 1]


def steps(names: str) -> list[tuple[str, int, int, int]]:
    """(order, step, state before it, filter) of all orders."""
    found = []
    for order in itertools.permutations(range(len(names))):
        state = 0
        for at, f in enumerate(order):
            found.append(("".join(names[x] for x in order), at + 1, state, f))
            state |= 1 << f
    return found


def audit(counts: DataFrame, names: str) -> DataFrame:
    """One row per part, order and step, from ``counts(part, mask, n, good, toxic)``, whose masks are bits in order of ``names``."""
    spark = counts.sparkSession
    lattice = [(k, *e) for k, e in enumerate(edges(len(names)))]
    table = F.broadcast(spark.createDataFrame(lattice, "edge int, state int, filter int, weight long"))  # n * 2**(n - 1) rows
    rows = counts.withColumn("edge", F.explode(F.sequence(F.lit(0), F.lit(len(lattice) - 1)))).join(table, "edge")
    bit = F.expr("shiftleft(1, filter)")
    fails = F.col("mask").bitwiseAND(bit) != 0
    before = F.col("mask").bitwiseAND(F.col("state")) != 0

    def total(when: Column, what: str = "n") -> Column:
        return F.sum(F.when(when, F.col(what)).otherwise(F.lit(0).cast("long")))

    taken = rows.groupBy("part", "state", "filter", "weight").agg(
        total(~before & ~fails).alias("kept"), total(~before & fails).alias("removed"), total(before & fails).alias("redundant"),
        total(F.col("mask") == bit).alias("unique_fails"), total(~before & fails, "good").alias("good_lost"), total(~before & fails, "toxic").alias("toxic_lost"),
    )
    taken = common.written(taken, "edges")  # read for the sums and for the steps
    shapley = taken.groupBy("part", "filter").agg(F.sum(F.col("weight") * F.col("removed")).alias("shapley"))
    told = F.broadcast(spark.createDataFrame(steps(names), "filter_order string, step int, state int, filter int"))  # n * n! rows
    return taken.drop("weight").join(told, ["state", "filter"]).join(shapley, ["part", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley",
    )


# --- the filters --------------------------------------------------------------------------------------------


def _own_mask(text: Column) -> Column:
    """Filters A to D, which a text alone decides."""
    bare = F.trim(text, F.lit(_SPACE))
    words = F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"[\x20\x09-\x0D]+"))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [
        F.size(words) < LEAST_WORDS,
        100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * F.size(words),
        100 * capitals > CAPITAL_PERCENT * F.length(text),
        text.rlike("[#$%&*|]"),
    ]
    return sum((F.when(x, 1 << k).otherwise(0) for k, x in enumerate(fails[1:], 1)), F.when(fails[0], 1).otherwise(0))


def masked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """counts(part, mask, n, good, toxic) of ``docs(doc_id, text, lang)`` with ``labels(doc_id, quality, toxic)``.

    Fails A: under 200 words; B: 100 * distinct words < 50 * words; C: 100 * [A-Z] > 3 * code points; D: holds one of
    ``#$%&*|``; E: a row of smaller doc_id has the same text. Rows with one text have one mask but for E, and all but
    those of the smallest id fail it: each text is reduced to its rows of the smallest id and their number, in every task
    before the shuffle, so that no text's rows meet in one task.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("sha"), _own_mask(text).alias("mask"))
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    # rows without an id have no label; their text spreads them
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("sha")).otherwise(F.lit(0).cast("long"))
    rows = rows.withColumn("salt", key).join(marks.withColumn("salt", F.lit(0).cast("long")), ["doc_id", "salt"], "left")
    kinds = ["sha", "part", "mask", "good", "toxic"]
    rows = rows.select("doc_id", "sha", "part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    ids = rows.groupBy("doc_id", *kinds).agg(F.count("*").alias("n"))
    first = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "n")
    kept = common.written(ids.groupBy(*kinds).agg(F.min(first).alias("first"), F.sum("n").alias("n")), "texts")
    least = kept.groupBy("sha").agg(F.min(F.struct("first.last", "first.doc_id")).alias("of"))
    kept = kept.join(least, "sha")
    # E fails: all rows but those of the text's smallest id
    earliest = F.when(F.struct("first.last", "first.doc_id").eqNullSafe(F.col("of")), F.col("first.n")).otherwise(F.lit(0).cast("long"))
    split = F.explode(F.array(F.struct(F.col("mask").alias("m"), earliest.alias("k")), F.struct((F.col("mask") + 16).alias("m"), (F.col("n") - earliest).alias("k"))))
    kept = kept.select("part", "good", "toxic", split.alias("x")).where("x.k > 0")
    return kept.groupBy("part", F.col("x.m").alias("mask")).agg(
        F.sum("x.k").alias("n"), F.sum(F.col("x.k") * F.col("good")).alias("good"), F.sum(F.col("x.k") * F.col("toxic")).alias("toxic")
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = masked(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
    return audit(counts, FILTERS)


ORACLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents
), l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT d.part, coalesce(l.good, 0) AS good, coalesce(l.toxic, 0) AS toxic,
    (CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END)
    || (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END)
    || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
    || (CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS failed
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id
), g AS (
  SELECT part, failed, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, failed
), o(o) AS (
  SELECT '' UNION ALL SELECT o || x FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) WHERE length(o) < 5 AND strpos(o, x) = 0
), s AS (
  SELECT o AS filter_order, k AS step, o[k] AS own, translate(failed, o[k:], '') AS before, g.*
  FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS k), g WHERE length(o) = 5
), r AS (
  SELECT part, filter_order, step, own,
    sum(CASE WHEN before = '' AND strpos(failed, own) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN before = '' AND strpos(failed, own) > 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN before <> '' AND strpos(failed, own) > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN failed = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN before = '' AND strpos(failed, own) > 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN before = '' AND strpos(failed, own) > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM s GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r
"""

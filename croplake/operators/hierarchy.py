"""The group tree: descent, ancestors, roll-up counts, owned rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from croplake.operators.ranking import batches
from croplake.session import cut_lineage


def descend(grouper: DataFrame) -> DataFrame:
    """Groups reachable from a root (a group without parent), with ``depth``.

    Every group holds a pointer to an ancestor and the number of steps to it; a round sends each pointer
    on to where that ancestor's pointer leads, so pointers double their reach and a tree of depth d takes about
    log2(d) rounds. Groups whose pointer is a root are done and take no further part. A round in which
    no group is done ends it: groups of every depth up to the deepest exist, so those left sit on
    a cycle, below one, or below an unknown parent (see :func:`unreachable`).
    """
    roots = grouper.filter(F.col("parent_grouper_id").isNull()).select(
        "grouper_id", F.lit(0).alias("depth")
    )
    done = cut_lineage(roots)
    moving = cut_lineage(
        grouper.filter(F.col("parent_grouper_id").isNotNull()).select(
            "grouper_id", F.col("parent_grouper_id").alias("_at"), F.lit(1).alias("_steps")
        )
    )
    while True:
        found = cut_lineage(
            moving.join(done.select(F.col("grouper_id").alias("_at"), "depth"), "_at").select(
                "grouper_id", (F.col("_steps") + F.col("depth")).alias("depth")
            )
        )
        if found.isEmpty():
            return grouper.join(done, "grouper_id")
        # pointers that lead to groups still moving take over theirs
        onward = moving.select(
            F.col("grouper_id").alias("_at"), F.col("_at").alias("_next"), F.col("_steps").alias("_more")
        )
        done = done.unionByName(found)
        moving = cut_lineage(
            moving.join(found, "grouper_id", "left_anti").join(onward, "_at").select(
                "grouper_id", F.col("_next").alias("_at"), (F.col("_steps") + F.col("_more")).alias("_steps")
            )
        )


def unreachable(grouper: DataFrame, descent: DataFrame) -> DataFrame:
    """Groups no root leads to: they sit on a cycle or below one, or name an unknown parent."""
    return grouper.join(descent.select("grouper_id"), "grouper_id", "left_anti")


def closure(grouper: DataFrame) -> DataFrame:
    """(ancestor_id, grouper_id, distance) for every group and each of its ancestors, itself too.

    By doubling: pairs at distance 1, 2, 4, ... are joined with all pairs known so far, each round
    reaching twice as far up, until one finds no new pair. A walk ends at a root or at an unknown
    parent; on a cycle a pair has its smallest distance.
    """
    known_ids = grouper.select(F.col("grouper_id").alias("_known"))
    jump = cut_lineage(  # at exactly the distance reached so far: one at most per group
        grouper.join(known_ids, F.col("parent_grouper_id") == F.col("_known"), "left_semi")
        .select(F.col("parent_grouper_id").alias("ancestor_id"), "grouper_id")
    )
    itself = grouper.select(
        F.col("grouper_id").alias("ancestor_id"), "grouper_id", F.lit(0).alias("distance")
    )
    up = jump.withColumn("distance", F.lit(1)).filter("ancestor_id <> grouper_id")
    done = cut_lineage(itself.unionByName(up))
    reach = 1
    while True:
        low = jump.select(F.col("ancestor_id").alias("_mid"), F.col("grouper_id").alias("_low"))
        above = done.filter("distance > 0").join(low, F.col("grouper_id") == F.col("_mid")).select(
            "ancestor_id", F.col("_low").alias("grouper_id"), (F.col("distance") + reach).alias("distance")
        )
        new = cut_lineage(
            above.groupBy("ancestor_id", "grouper_id").agg(F.min("distance").alias("distance"))
            .join(done.select("ancestor_id", "grouper_id"), ["ancestor_id", "grouper_id"], "left_anti")
        )
        if new.isEmpty():
            return done
        done = done.unionByName(new)
        jump = cut_lineage(
            jump.join(low, F.col("grouper_id") == F.col("_mid"))
            .select("ancestor_id", F.col("_low").alias("grouper_id"))
        )
        reach *= 2


def ancestors(closure_rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Ancestors of each group of ``groups``, nearest first in ``distance``."""
    wanted = groups.select("grouper_id").distinct()
    return closure_rows.filter("distance > 0").join(wanted, "grouper_id", "left_semi")


def descendants(closure_rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Groups below each group of ``groups``."""
    wanted = groups.select(F.col("grouper_id").alias("ancestor_id")).distinct()
    return closure_rows.filter("distance > 0").join(wanted, "ancestor_id", "left_semi")


def rows_of_subtree(closure_rows: DataFrame, rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` (fields, trials) owned by a group of ``groups`` or any group below it.

    A row comes once per listed group that holds it, named by ``ancestor_id``.
    """
    wanted = groups.select(F.col("grouper_id").alias("ancestor_id")).distinct()
    below = closure_rows.join(wanted, "ancestor_id", "left_semi").drop("distance")
    return rows.join(below, "grouper_id")


def fields_of_groups(descent: DataFrame, field: DataFrame, batch_size: int | None = None) -> DataFrame:
    """Fields of each reached group: one row each, a group without fields once with nulls.

    With ``batch_size`` the fields come as arrays of at most that many, numbered by ``batch``;
    a group's whole list never has to fit into one task.
    """
    groups = descent.select("grouper_id")
    own = field.select("grouper_id", "field_id", F.col("name").alias("field_name"))
    if batch_size is None:
        return groups.join(own, "grouper_id", "left")
    held = own.join(groups, "grouper_id", "left_semi")
    packed = batches(
        held, ["grouper_id"], ["field_id"], ["field_id", "field_name"],
        batch_size, "fields",
    )
    return (
        groups.join(packed, "grouper_id", "left")
        .withColumn("batch", F.coalesce("batch", F.lit(0).cast("long")))
        .withColumn("fields", F.coalesce("fields", F.array().cast(packed.schema["fields"].dataType)))
    )


def _field_counts(field: DataFrame) -> DataFrame:
    """Fields per group, counted before any join."""
    return field.filter(F.col("grouper_id").isNotNull()).groupBy("grouper_id").agg(
        F.count("*").alias("_fields")
    )


def rollup_counts(
    descent: DataFrame, closure_rows: DataFrame, field: DataFrame, mode: str = "leaf"
) -> DataFrame:
    """Per reached group: ``total_field_count``, ``total_group_count``, ``field_count``.

    ``mode="leaf"``: totals run over the leaves below a group (fields of inner groups do not
    count), and ``field_count`` is set for leaves only. ``mode="all"``: totals run over every group
    of the subtree.
    """
    if mode not in ("leaf", "all"):
        raise ValueError('mode must be "leaf" or "all"')
    groups = descent.select("grouper_id", "parent_grouper_id")
    counted = groups.join(_field_counts(field), "grouper_id", "left").withColumn(
        "_fields", F.coalesce("_fields", F.lit(0))
    )
    if mode == "leaf":
        inner = groups.select(F.col("parent_grouper_id").alias("_p")).filter("_p is not null")
        counted = counted.join(inner, F.col("grouper_id") == F.col("_p"), "left_anti")
    own = F.sum(F.when(F.col("ancestor_id") == F.col("grouper_id"), F.col("_fields")))
    return (
        closure_rows.join(counted.select("grouper_id", "_fields"), "grouper_id")
        .groupBy(F.col("ancestor_id"))
        .agg(
            F.sum("_fields").alias("total_field_count"),
            F.count("*").alias("total_group_count"),
            own.alias("field_count"),
        )
        .select(
            F.col("ancestor_id").alias("grouper_id"), "total_field_count", "total_group_count",
            "field_count",
        )
    )


def children_count(descent: DataFrame) -> DataFrame:
    """Number of direct children per group that has any."""
    return (
        descent.filter(F.col("parent_grouper_id").isNotNull())
        .groupBy("parent_grouper_id").agg(F.count("*").alias("group_count"))
        .withColumnRenamed("parent_grouper_id", "grouper_id")
    )


def children(descent: DataFrame, batch_size: int = 1000) -> DataFrame:
    """Direct children as arrays of at most ``batch_size`` ids."""
    kids = descent.filter(F.col("parent_grouper_id").isNotNull()).select(
        F.col("parent_grouper_id").alias("_parent"), "grouper_id"
    )
    packed = batches(
        kids, ["_parent"], ["grouper_id"], ["grouper_id"], batch_size,
        "_rows",
    )
    return packed.select(
        F.col("_parent").alias("grouper_id"), "batch",
        F.transform("_rows", lambda r: r["grouper_id"]).alias("grouper_ids"),
    )


def group_summary(
    grouper: DataFrame, field: DataFrame, mode: str = "leaf", ordered: bool = True
) -> DataFrame:
    """Every reached group with depth, number of children and roll-up counts; missing counts are 0."""
    tree = descend(grouper)
    counts = rollup_counts(tree, closure(grouper), field, mode)
    zero = F.lit(0).cast("long")
    out = (
        tree.join(counts, "grouper_id", "left")
        .join(children_count(tree), "grouper_id", "left")
        .select(
            "grouper_id", "parent_grouper_id", "name", "organization_id", "depth",
            *[
                F.coalesce(c, zero).alias(c)
                for c in ("total_group_count", "group_count", "total_field_count", "field_count")
            ],
        )
    )
    if not ordered:
        return out
    return out.orderBy(
        "depth", "total_group_count", "group_count", "total_field_count", "field_count",
        "grouper_id",
    )


def three_levels(grouper: DataFrame) -> DataFrame:
    """Groups that have a parent and a grandparent, with the names of all three."""
    def named(prefix: str) -> DataFrame:
        return grouper.select(
            F.col("grouper_id").alias(f"{prefix}_id"), F.col("name").alias(f"{prefix}_name"),
            F.col("parent_grouper_id").alias(f"{prefix}_parent"),
        )

    farm, region, country = named("farm"), named("region"), named("country")
    return (
        farm.join(region, F.col("farm_parent") == F.col("region_id"))
        .join(country, F.col("region_parent") == F.col("country_id"))
        .select(
            F.col("farm_id").alias("grouper_id"), "farm_name", "region_name", "country_name"
        )
    )


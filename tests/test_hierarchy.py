from __future__ import annotations

import time

import pytest

from croplake.operators import hierarchy as h


@pytest.fixture(scope="module")
def tree(spark):
    # 1 -> 2 -> 3, 1 -> 4; 8 <-> 9 a cycle, 7 below it; 6 names an unknown parent
    rows = [(1, None), (2, 1), (3, 2), (4, 1), (8, 9), (9, 8), (7, 8), (6, 60)]
    return spark.createDataFrame(
        [(g, f"g{g}", 1, p) for g, p in rows],
        "grouper_id long, name string, organization_id long, parent_grouper_id long",
    )


@pytest.fixture(scope="module")
def field(spark):
    return spark.createDataFrame(
        [(10, "a", 3), (11, "b", 3), (12, "c", 2), (13, "d", None), (14, "e", 4)],
        "field_id long, name string, grouper_id long",
    )


def test_descent_stops_at_cycles(spark, tree):
    down = h.descend(tree)
    assert {r.grouper_id: r.depth for r in down.collect()} == {1: 0, 2: 1, 4: 1, 3: 2}
    assert sorted(r.grouper_id for r in h.unreachable(tree, down).collect()) == [6, 7, 8, 9]


def test_closure_gives_each_pair_once(spark, tree):
    pairs = [(r.ancestor_id, r.grouper_id, r.distance) for r in h.closure(tree).collect()]
    assert len(pairs) == len(set(p[:2] for p in pairs))
    assert (1, 3, 2) in pairs and (9, 7, 2) in pairs and (8, 8, 0) in pairs
    assert not [p for p in pairs if p[0] == 60]


def test_leaf_and_all_counts(spark, tree, field):
    leaf = {r.grouper_id: r for r in h.group_summary(tree, field).collect()}
    assert (leaf[1].total_field_count, leaf[1].total_group_count, leaf[1].group_count) == (3, 2, 2)
    assert (leaf[2].total_field_count, leaf[2].field_count) == (2, 0)
    assert (leaf[3].total_field_count, leaf[3].field_count) == (2, 2)
    every = {r.grouper_id: r for r in h.group_summary(tree, field, mode="all").collect()}
    assert (every[1].total_field_count, every[1].total_group_count) == (4, 4)
    assert every[2].field_count == 1


def test_summary_order(spark, tree, field):
    assert [r.depth for r in h.group_summary(tree, field).collect()] == [0, 1, 1, 2]


def test_fields_of_groups_and_subtrees(spark, tree, field):
    down, pairs = h.descend(tree), h.closure(tree)
    rows = h.fields_of_groups(down, field).collect()
    assert sorted((r.grouper_id, r.field_id or 0) for r in rows) == [(1, 0), (2, 12), (3, 10), (3, 11), (4, 14)]
    packed = {(r.grouper_id, r.batch): [f.field_id for f in r.fields]
              for r in h.fields_of_groups(down, field, batch_size=1).collect()}
    assert packed == {(1, 0): [], (2, 0): [12], (3, 0): [10], (3, 1): [11], (4, 0): [14]}
    owned = h.rows_of_subtree(pairs, field, tree.filter("grouper_id = 2")).collect()
    assert sorted(r.field_id for r in owned) == [10, 11, 12]


def test_ancestors_and_descendants(spark, tree):
    pairs = h.closure(tree)
    up = h.ancestors(pairs, tree.filter("grouper_id = 3")).collect()
    assert sorted((r.ancestor_id, r.distance) for r in up) == [(1, 2), (2, 1)]
    down = h.descendants(pairs, tree.filter("grouper_id = 1")).collect()
    assert sorted(r.grouper_id for r in down) == [2, 3, 4]
    assert [r.grouper_ids for r in h.children(h.descend(tree)).orderBy("grouper_id").collect()] == [[2, 4], [3]]


def test_deep_chain_with_branches_and_a_long_cycle(spark):
    """3,000 levels and a cycle of 7 with a tail take about log2 rounds; pairs equal a walk by hand."""
    parent = {i: i - 1 if i else None for i in range(3000)}
    parent |= {10_000 + i: i * 40 for i in range(70)} | {20_000 + i: 20_000 + (i + 1) % 7 for i in range(7)}
    parent |= {20_100 + i: 20_100 + i - 1 for i in range(1, 12)} | {20_100: 20_003}
    groups = spark.createDataFrame(
        [(g, f"g{g}", 1, p) for g, p in parent.items()],
        "grouper_id long, name string, organization_id long, parent_grouper_id long",
    )
    depth = {r.grouper_id: r.depth for r in h.descend(groups).collect()}
    begin = time.perf_counter()
    pairs = h.closure(groups)
    assert time.perf_counter() - begin < 60
    got = pairs.toPandas()
    assert depth == {i: i for i in range(3000)} | {10_000 + i: i * 40 + 1 for i in range(70)}
    want = set()
    for g in parent:
        at, distance, seen = g, 0, set()
        while at is not None and at not in seen:
            want.add((at, g, distance))
            seen.add(at)
            at, distance = parent[at], distance + 1
    assert len(got) == len(want) and set(zip(got.ancestor_id, got.grouper_id, got.distance)) == want

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallygate.llm import negatives


def plain(rows, anchors, rule):
    """(anchor, positive, rank, negative, positive score, negative score) by all pairs."""
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    found = []
    for a, label, v in anchors:
        near = sorted((-score(v, w), i) for i, k, w in rows if k == label and i != a)[: rule.positives]
        for s, p in near:
            fits = [(-t, i) for i, k, w in rows if k != label and rule.low * -s <= 100 * (t := score(v, w)) <= rule.high * -s]
            for rank, (t, i) in enumerate(sorted(fits)[: rule.negatives], 1):
                found.append((a, p, rank, i, -s, -t))
    return sorted(found)


def cloud(seed, n, width=6):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 200) for _ in range(width)] for _ in range(4)]
    rows = []
    for k in range(n):
        label = rng.randrange(4)
        rows.append((k, label, [int(c * 0.7 + rng.gauss(0, 90)) for c in centres[label]]))
    return rows


def test_spanning_tree():
    rng = np.random.default_rng(5)
    points = rng.integers(-50, 50, (40, 3))
    order, parent, edge = negatives.spanning_tree(points)
    assert sorted(order) == list(range(40)) and parent[0] == -1 and all(0 <= p < k for k, p in enumerate(parent) if k)
    away = lambda a, b: math.dist(points[a], points[b])
    assert all(edge[k] == pytest.approx(away(order[k], order[parent[k]])) for k in range(1, 40))
    root, total = list(range(40)), 0.0  # Kruskal's
    find = lambda i: i if root[i] == i else find(root[i])
    for d, a, b in sorted((away(a, b), a, b) for a in range(40) for b in range(a)):
        if find(a) != find(b):
            root[find(a)] = find(b)
            total += d
    assert edge.sum() == pytest.approx(total)


@pytest.mark.parametrize("scale", [1, 1 << 18])
def test_bounds_leave_out_and_lose_nothing(scale):
    """Anchors close together: the walk scores few of the rows, and what it finds is the best."""
    rows = [(i, 1, [x * scale for x in v]) for i, _, v in cloud(2, 3000)]
    anchors = [(10_000 + k, 0, [x + k for x in rows[0][2]]) for k in range(30)]
    vectors = np.array([v for _, _, v in anchors], np.int64)
    order, parent, edge = negatives.spanning_tree(vectors)
    tree = {"label": 0, "at": order.tolist(), "ids": [anchors[k][0] for k in order], "parent": parent.tolist(), "edge": edge.tolist(),
            "vectors": vectors[order].tobytes()}
    most = 300_000 * scale * scale
    walk = negatives.Walk(tree, 6, 10, {k: [(1, 5, -(1 << 60), most, 1)] for k in range(30)})
    ids, labels = np.array([i for i, _, _ in rows]), np.ones(len(rows), np.int64)
    given = np.array([v for _, _, v in rows], np.int64)
    for a in range(0, len(rows), 500):
        part = slice(a, a + 500)
        walk.past(ids[part], labels[part], given[part], np.sqrt((given[part].astype(float) ** 2).sum(axis=1)))
    assert walk.scored < 0.3 * walk.met
    for at, anchor, *_ in walk.found():
        assert anchor == 10_000 + at
    for k, (anchor, _, v) in enumerate(anchors):
        scores = sorted((-t, i) for i, _, w in rows if (t := sum(x * y for x, y in zip(v, w))) <= most)[:10]
        assert [(-s, i) for (at, _, _, _, _, i, s) in walk.found() if at == k] == scores


@pytest.mark.parametrize("group, anchors_at_once, rows_at_once", [(negatives.GROUP, negatives.ANCHORS_AT_ONCE, negatives.ROWS_AT_ONCE), (4, 9, 50)])
def test_against_all_pairs(spark, group, anchors_at_once, rows_at_once):
    rows = cloud(7, 400)
    rows += [(100, 0, rows[100][2]), (100, 2, rows[3][2]), rows[5], rows[5], (-20, 1, [0] * 6), (20, 1, [0] * 6), (900, 3, [])]  # ties, repeats, no length
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, label long, vector array<long>, key string")
    rule = negatives.Rule()
    found = negatives.hard_negatives(frame, F.col("vec_id") % 20 == 0, rule, group, anchors_at_once, rows_at_once)
    expected = plain(rows, [r for r in rows if r[0] % 20 == 0], rule)
    assert sorted(tuple(r) for r in found.collect()) == expected and len(expected) > 300
    assert dict(found.dtypes) == {"rank": "int"} | {c: "bigint" for c in found.columns if c != "rank"}


def test_rows_that_take_no_part_and_empty_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.001], 3), (2, None, 3), (3, [0.5, None], 3), (4, [nan, 1.0], 3), (5, [1.0, -inf], 3), (6, [1.0, 2.0], None), (None, [1.0], 2), (7, [], 9)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(tuple(r) for r in negatives.prepared(frame).collect())
    assert got == [(1, 3, [128, -1]), (7, 9, [])]
    assert negatives.hard_negatives(negatives.prepared(frame.limit(0)), F.lit(True)).count() == 0
    assert negatives.hard_negatives(negatives.prepared(frame), F.lit(False)).count() == 0
    assert negatives.hard_negatives(negatives.prepared(frame), F.lit(True)).count() == 0

"""Centroid clustering and hard negatives against plain versions."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest
from conftest import SF_DIR, local_frame

from revmart.llm import clusters, negatives
from revmart.llm.queries import QUERIES, SQL
from revmart.llm.vectors import MOST, TOP

EXTRA = "parts string, far int, cluster string, node int, anchor string, score double, dim int, place int, side int, rank int, sought int"
ODD = [None, [], [0.0] * 4, [1.0, None, 0.0, 0.0], [math.nan] * 4, [math.inf, 0.0, 0.0, 0.0], [1.0, 2.0], [-math.inf] * 4]


def frame(spark, rows, kind="float"):
    ddl = f"vec_id long, embedding array<{kind}>, label int, {EXTRA}"
    return local_frame(spark, [(*r, *[None] * 11) for r in rows], ddl)


def vector_rows(n=120, dim=4, seed=1, spread=2.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, dim)) * spread
    rows = [(i, (centres[i % 5] + rng.normal(size=dim) * 0.3).astype(np.float32).tolist(), i % 3) for i in range(n)]
    rows += [(200 + i, v, 1) for i, v in enumerate(ODD)]
    rows += [(300, rows[7][1], None), (301, rows[7][1], 0), (302, rows[7][1], 1)]  # equal vectors, no label
    rows += [(None, rows[9][1], 2), (400, [0.5] * dim, 0), (400, [0.25] * dim, 0), (-50, [-0.5] * dim, 1)]
    return rows + rows[10:12]  # repeated rows


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def whole(v, scale):
    return [max(-MOST, min(MOST, math.floor(scale * x))) for x in v]


def plain_clusters(rows, k, dim, scale, rounds, seed):
    kept = [(i, whole(v, scale)) for i, v, _ in rows if usable(v) and len(v) == dim]
    digest = lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    order = sorted(kept, key=lambda r: (r[0] is None, "" if r[0] is None else digest(r[0]), r[1]))
    centroids = [p for _, p in order[:k]]

    def assign():
        far = lambda p, c: sum((a - b) ** 2 for a, b in zip(p, c))
        return [min((far(p, c), j) for j, c in enumerate(centroids)) for _, p in kept]

    for _ in range(rounds):
        near = assign()
        for j in range(len(centroids)):
            own = [p for (_, p), (_, c) in zip(kept, near) if c == j]
            if own:
                centroids[j] = [sum(x) // len(own) for x in zip(*own)]
    near = assign()
    inertia = [sum(min(d, TOP) for d, c in near if c == j) for j in range(len(centroids))]
    return sorted(
        (i is None, i, c, min(d, TOP), min(inertia[c], TOP), min(sum(inertia), TOP), centroids[c]) for (i, _), (d, c) in zip(kept, near)
    )


def got_clusters(df):
    return sorted(((r[0] is None, *r) for r in map(tuple, df.collect())), key=lambda r: (r[0], r[1] or 0, r[2:]))


@pytest.mark.parametrize(("k", "rounds", "scale"), [(8, 10, 1024), (3, 1, 7), (500, 2, 1024), (1, 10, 1024), (5, 0, 1)])
def test_clusters_against_plain_rounds(spark, k, rounds, scale):
    rows = vector_rows()
    got = got_clusters(clusters.cluster_vectors(frame(spark, rows), k, 4, scale, rounds))
    assert got == sorted(plain_clusters(rows, k, 4, scale, rounds, 3), key=lambda r: (r[0], r[1] or 0, r[2:]))


def test_sums_of_many_tasks_are_added_up_in_between(spark, monkeypatch):
    monkeypatch.setattr(clusters, "FEW_TASKS", 1)
    rows = vector_rows()
    got = got_clusters(clusters.cluster_vectors(frame(spark, rows).repartition(9), 8, 4, 1024, 10))
    assert got == sorted(plain_clusters(rows, 8, 4, 1024, 10, 3), key=lambda r: (r[0], r[1] or 0, r[2:]))


def test_clusters_of_huge_components(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1, 1) * 10.0 ** rng.choice([0, 5, 9, 13, 30, 300]) for _ in range(4)], 0) for i in range(60)]
    got = got_clusters(clusters.cluster_vectors(frame(spark, rows, "double"), 8, 4, 1024, 4))
    assert got == plain_clusters(rows, 8, 4, 1024, 4, 3)


def test_ties_of_centroids_go_to_the_smaller_number(spark):
    rows = [(i, [float(i % 2 * 2), 0.0, 0.0, 0.0], 0) for i in range(40)] + [(100 + i, [1.0, 0.0, 0.0, 0.0], 0) for i in range(9)]
    got = got_clusters(clusters.cluster_vectors(frame(spark, rows), 4, 4, 1024, 3))
    assert got == plain_clusters(rows, 4, 4, 1024, 3, 3)


def test_ptolemaic_bounds_never_exceed_distances_and_prune():
    rng = np.random.default_rng(2)
    centres = rng.integers(-30_000, 30_000, size=(8, 64))
    x = centres[rng.integers(8, size=3000)] + rng.integers(-300, 300, size=(3000, 64))
    pivots = clusters.far_apart(x[:64], 6)
    far = clusters.distances(x, pivots.points)
    bound = clusters.lower_bounds(far, clusters.distances(centres, pivots.points), pivots.pairs)
    assert (bound <= clusters.distances(x, centres)).all()
    cluster, best, measured = clusters.nearest(x, far, centres, pivots)
    exactly = np.stack([clusters.squared(x, c) for c in centres], axis=1)
    assert (cluster == exactly.argmin(axis=1)).all() and (best == exactly.min(axis=1)).all()
    assert measured < 2 * len(x)  # of eight times as many


def test_no_vectors_to_cluster(spark):
    for rows in ([], [(i, v, 1) for i, v in enumerate(ODD)]):
        rows = [r for r in rows if r[1] != [0.0] * 4]
        found = clusters.cluster_vectors(frame(spark, rows), 8, 4)
        assert found.count() == 0 and found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]


def plain_negatives(rows, every, positives, negatives_, low, high, scale):
    part = {(i, l, tuple(whole(v, scale))) for i, v, l in rows if usable(v) and l is not None}
    order = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    out = []
    for a in part:
        if a[0] is None or a[0] % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(a[2], r[2])), order(r), r) for r in part if r != a and len(r[2]) == len(a[2])))
        for s, _, p in [x for x in scored if x[2][1] == a[1]][:positives]:
            inside = [x for x in scored if x[2][1] != a[1] and low * -s <= 100 * -x[0] <= high * -s]
            out += [(a[0], p[0], k + 1, n[0], -s, -t) for k, (t, _, n) in enumerate(inside[:negatives_])]
    return sorted(out, key=str)


@pytest.mark.parametrize(("rows_a_block", "anchors_a_block"), [(4096, 1024), (7, 3)])
@pytest.mark.parametrize(("spread", "low", "high"), [(2.0, 50, 95), (0.2, 10, 120)])
def test_negatives_against_all_pairs(spark, monkeypatch, rows_a_block, anchors_a_block, spread, low, high):
    monkeypatch.setattr(negatives, "ROWS", rows_a_block)
    monkeypatch.setattr(negatives, "ANCHORS", anchors_a_block)
    rows = vector_rows(spread=spread)
    got = negatives.mine_negatives(frame(spark, rows), "vec_id % 5 = 0", 4, 3, low, high, 256)
    want = plain_negatives(rows, 5, 4, 3, low, high, 256)
    assert sorted(map(tuple, got.collect()), key=str) == want and want


def test_negatives_with_many_ties(spark):
    rows = [(i, [1.0, float(i % 3) / 2, 0.0, 0.0], i % 2) for i in range(90)]
    got = negatives.mine_negatives(frame(spark, rows), "vec_id % 9 = 0", 5, 3, 50, 100, 256)
    assert sorted(map(tuple, got.collect()), key=str) == plain_negatives(rows, 9, 5, 3, 50, 100, 256)


def test_scores_beyond_doubles(spark):
    rng = random.Random(8)
    rows = [(i, [rng.choice([1.0, 1.0 + 2.0**-20]) * 2.0**21 for _ in range(4)], i % 2) for i in range(60)]
    got = negatives.mine_negatives(frame(spark, rows, "double"), "vec_id % 6 = 0", 3, 3, 50, 100, 256)
    assert sorted(map(tuple, got.collect()), key=str) == plain_negatives(rows, 6, 3, 3, 50, 100, 256)


def test_tree_bounds_hold_and_prune():
    rng = np.random.default_rng(6)
    centres = rng.integers(-3000, 3000, size=(6, 32))
    x = centres[rng.integers(6, size=900)] + rng.integers(-20, 20, size=(900, 32))
    anchors = centres[rng.integers(6, size=50)] + rng.integers(-20, 20, size=(50, 32))
    block = negatives.Block(anchors, x)
    assert sorted(block.order.tolist()) == list(range(50)) and (block.parent < 0).sum() == 1
    for anchor, lower, upper in block:
        exactly = x @ anchors[anchor]
        assert (lower <= exactly).all() and (exactly <= upper).all()
    block = negatives.Block(anchors, x)
    labels = np.zeros(900, int)
    negatives.best_positives(block, labels, np.arange(900), np.arange(1000, 1050), np.zeros(50, int), 5)
    assert block.scored < 0.7 * 50 * 900


def test_no_anchors(spark):
    for rows in ([], [(i, v, 1) for i, v in enumerate(ODD)], [(1, [1.0], 1), (None, [1.0], 1)]):
        found = negatives.mine_negatives(frame(spark, rows), "vec_id % 50 = 0")
        assert found.count() == 0
        assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("name", ["op12_clusters", "op13_negatives"])
def test_vector_queries_equal_their_sql(spark, name):
    got = QUERIES[name](spark, SF_DIR)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_DIR}/embeddings.parquet'")
    want = con.execute(SQL[name])
    assert got.columns == [d[0] for d in want.description]
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())

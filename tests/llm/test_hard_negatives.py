"""Hard negatives against all pairs, whatever the cells, groups and tiles."""

import math
import random

import numpy as np
import pytest
from cantolith.llm import hard_negatives as H
from pyspark.sql import functions as F

ROWS = "vec_id long, embedding array<float>, label int"


def plain(rows, anchors, positives=5, negatives=10, low=30, high=90):
    kept = [r for r in rows if r[0] is not None and r[2] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    own = {}
    for r in sorted(kept, key=lambda r: (r[0], r[2], r[1])):
        own.setdefault(r[0], r)
    n = max([1, *(len(r[1]) for r in kept)])
    v = {k: [math.floor(256 * float(np.float32(x))) for x in r[1]] + [0] * (n - len(r[1])) for k, r in own.items()}
    out = []
    for a in sorted(k for k in own if anchors(k)):
        s = {k: sum(x * y for x, y in zip(v[a], v[k], strict=True)) for k in own}
        order = sorted((k for k in own if k != a), key=lambda k: (-s[k], k))
        for p in [k for k in order if own[k][2] == own[a][2]][:positives]:
            found = [k for k in order if own[k][2] != own[a][2] and low * s[p] <= 100 * s[k] <= high * s[p]][:negatives]
            out += [(a, p, i, k, s[p], s[k]) for i, k in enumerate(found, 1)]
    return sorted(out)


def check(spark, rows, anchors=lambda k: k % 10 == 0, **how):
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    got = sorted(tuple(r) for r in H.hard_negatives(df, F.col("vec_id") % 10 == 0, **how).collect())
    assert got == plain(rows, anchors)
    return got


def clusters(seed, n, centres=6, spread=0.15, labels=4, d=8):
    r = random.Random(seed)
    at = [[r.gauss(0, 1) for _ in range(d)] for _ in range(centres)]
    out = []
    for k in range(n):
        c = r.randrange(centres)
        out.append((k, [x + r.gauss(0, spread) for x in at[c]], r.choice([c % labels, r.randrange(labels)])))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_pairs_equal_brute_force(spark, seed):
    assert len(check(spark, clusters(seed, 400))) > 500


def test_many_tiles_groups_and_pivots(spark, monkeypatch):
    monkeypatch.setattr(H, "ROWS", 20)
    monkeypatch.setattr(H, "MANY", 4)
    monkeypatch.setattr(H, "CELLS", 64)
    monkeypatch.setattr(H, "BROADCAST", 0)
    assert check(spark, clusters(3, 300), pivots=(40, 40), per_group=3)


def test_a_hot_cell_of_copies(spark):
    """A third of all rows are one vector: ties go by id, in whatever tile they are."""
    rows = clusters(4, 200)
    rows = [(k, rows[0][1], k % 3) if k % 3 == 0 else (k, v, label) for k, v, label in rows]
    assert check(spark, rows)


def test_odd_rows(spark):
    rows = clusters(5, 80)
    rows += [(100, None, 1), (110, [None] * 8, 1), (120, [math.nan] * 8, 1), (130, [math.inf] * 8, 1), (140, rows[0][1], None), (None, rows[0][1], 1), (150, rows[0][1], 99), (160, [], 0), (170, [0.5], 1)]
    rows += [(10, rows[3][1], 0), (20, *rows[20][1:])]  # repeated ids
    rows += [(180, [0.0] * 8, 2), (190, [-x for x in rows[0][1]], rows[0][2])]  # scores of 0 and below
    assert check(spark, rows)
    assert check(spark, []) == [] and check(spark, [(1, [0.1], 1)]) == [] and check(spark, [(10, [0.1], 1)]) == []


def test_only_near_rows_are_moved(spark):
    """Far clusters serve no anchor: their rows meet none."""
    rows = [(k, [1.0 + k % 7 / 100 if j == k % 20 else 0.0 for j in range(20)], k % 2) for k in range(2000)]
    df = spark.createDataFrame([r for r in rows if r[0] % 10 or r[0] % 20 == 0], ROWS)
    got = H.hard_negatives(df, F.col("vec_id") % 100 == 0, pivots=(64, 64), per_group=4)
    met = []
    real = H._dealt

    def seen(*args):
        left, right = real(*args)
        met.append(right.count())
        return left, right

    H._dealt = seen
    try:
        again = H.hard_negatives(df, F.col("vec_id") % 100 == 0, pivots=(64, 64), per_group=4)
    finally:
        H._dealt = real
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got.collect()))
    assert met[0] < 0.3 * df.count(), met  # positives lie in the anchors' own clusters


def test_labels_and_ids_of_other_kinds(spark):
    rows = clusters(6, 150)
    df = spark.createDataFrame([(k, v, f"l{label}", 1) for k, v, label in rows], "vec_id int, embedding array<double>, label string, rank int")
    got = H.hard_negatives(df, F.col("vec_id") % 10 == 0)
    names = dict(got.dtypes)
    assert names == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"}
    assert len(plain(rows, lambda k: k % 10 == 0)) == got.count() > 0


def test_exact_scores_of_large_components():
    a, b = np.array([[1 << 28, 3]]), np.array([[1 << 28, 5], [1, 1]])
    assert H.scores(a, b).tolist() == [[(1 << 56) + 15, (1 << 28) + 3]]
    s = np.array([[5, 7, 7, 1, 7]])
    assert [x.tolist() for x in H.best(s, np.array([[True, False, True, True, True]]), 2)] == [[0, 0], [2, 4]]
    assert [len(x) for x in H.best(s, np.zeros((1, 5), bool), 2)] == [0, 0]

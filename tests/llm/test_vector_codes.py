"""Codes against plain loops: every distance, in whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest
from cantolith.llm import vector_codes as C
from pyspark.sql import functions as F

ROWS = "vec_id long, embedding array<float>, label int"


def plain(rows, parts, entries, rounds):
    """{vec_id: (code, error, label_error)} and the digest; rows of (vec_id, vector, label)."""
    kept = sorted((r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])), key=lambda r: (r[0] is None, r[0], r[1]))
    n = -(-max([1, *(len(r[1]) for r in kept)]) // parts) * parts
    w = n // parts
    xs = [[math.floor(256 * float(np.float32(x))) for x in r[1]] + [0] * (n - len(r[1])) for r in kept]
    books = [[x[p * w : (p + 1) * w] for x in xs[:entries]] for p in range(parts)]
    near = lambda p, x: min((sum((a - b) ** 2 for a, b in zip(x[p * w : (p + 1) * w], e, strict=True)), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        new = []
        for p in range(parts):
            own = {}
            for x in xs:
                own.setdefault(near(p, x)[1], []).append(x[p * w : (p + 1) * w])
            new.append([[sum(c) // len(own[k]) for c in zip(*own[k], strict=True)] if k in own else e for k, e in enumerate(books[p])])
        books = new
    codes = [[near(p, x) for p in range(parts)] for x in xs]
    sums = {}
    for r, c in zip(kept, codes, strict=True):
        sums[r[2]] = sums.get(r[2], 0) + sum(d for d, _ in c)
    out = sorted(((r[0], "".join(f"{k:02x}" for _, k in c), sum(d for d, _ in c), sums[r[2]]) for r, c in zip(kept, codes, strict=True)), key=str)
    return out, hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()


def check(spark, rows, parts, entries, rounds=2):
    got = C.vector_codes(spark.createDataFrame(rows, ROWS).repartition(3), parts=parts, entries=entries, rounds=rounds).collect()
    want, digest = plain(rows, parts, entries, rounds)
    assert sorted(((r.vec_id, r.code, r.error, r.label_error) for r in got), key=str) == want
    assert {r.codebooks_sha256 for r in got} <= {digest}
    return got


@pytest.mark.parametrize(("parts", "entries"), [(2, 4), (4, 16), (1, 40)])
def test_codes_equal_loops(spark, parts, entries):
    r = random.Random(parts)
    rows = [(k, [r.choice([-0.5, -0.25, 0.0, 0.1, r.random()]) for _ in range(8)], r.choice([None, 0, 1])) for k in range(120)]
    rows += [(300, None, 1), (301, [0.1, None] * 4, 1), (302, [math.nan] * 8, 1), (303, [math.inf, *[0.0] * 7], None), (304, rows[0][1], 5), (None, rows[1][1], 0)]
    assert len(check(spark, rows, parts, entries)) == 122


def test_ties_repeats_and_few_rows(spark):
    same = [(k, [0.25, 0.25, -0.25, -0.25], 1) for k in range(20)]
    assert {r.code for r in check(spark, same, 2, 8)} == {"0000"}  # the lowest of equal entries
    check(spark, [(7, [0.5], None), (7, [0.25], 2), (7, [0.25], 2), (9, [], 3), (8, [0.1, -0.2, 0.3], 3)], 2, 64)  # repeated ids, lengths that differ
    assert check(spark, [(1, None, 1)], 2, 4) == [] and check(spark, [], 2, 4) == []


def test_extra_columns_and_long_tables(spark):
    df = spark.range(3000).select(F.col("id").alias("vec_id"), F.array(*(F.sin(F.col("id") * k) for k in range(1, 9))).alias("embedding"), (F.col("id") % 2 * 0).cast("int").alias("label"), F.lit("x").alias("code"), F.lit(1).alias("_label"))
    out = C.vector_codes(df, parts=4, entries=32)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert out.agg(F.sum("error") == F.max("label_error"), F.count("*")).first()[:] == (True, 3000)


def test_tree_finds_the_lowest_of_the_nearest():
    r = np.random.default_rng(1)
    for n, w, top in ((1, 1, 3), (9, 2, 3), (64, 4, 4), (64, 4, 200), (200, 3, 2)):
        entries, x = r.integers(-top, top, (n, w)), r.integers(-2 * top, 2 * top, (500, w))
        at, d = C.Tree(entries).nearest(x)
        every = ((x[:, None] - entries) ** 2).sum(2)
        assert (at == every.argmin(1)).all() and (d == every.min(1)).all()


def test_bound_of_components(spark):
    big = [(1, [3e38, -3e38], 1), (2, [0.0, 0.0], 1)]
    assert C.vector_codes(spark.createDataFrame(big, ROWS), parts=2, entries=2).count() == 2

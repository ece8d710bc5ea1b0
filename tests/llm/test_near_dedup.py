import random
import re

import numpy as np
import pytest

from cantolith.llm import near_dedup as N


def brute(rows):
    def lower(t):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)

    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t or ""))
        sets[i] = frozenset(zip(*(w[k:] for k in range(5)), strict=False)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    by, root = {}, {i: i for i in sets}
    for i, s in sets.items():
        for x in s:
            by.setdefault(x, []).append(i)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    done = set()
    for ids in by.values():
        for k, a in enumerate(ids):
            for b in ids[:k]:
                if (a, b) not in done:
                    done.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                        x, y = sorted((find(a), find(b)))
                        root[y] = x
    return {(i, len(s), find(i), find(i) == i) for i, s in sets.items()}


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_equals_brute_force(spark, size):
    d = f"/root/testdata/{size}"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    got = {tuple(r) for r in N.op3_near_duplicates(spark, d).collect()}
    assert got == brute(rows)


def test_edges_and_groups(spark):
    r = random.Random(5)
    base = [f"w{r.randrange(10**6)}" for _ in range(200)]
    near = []
    for k in range(60):
        w = list(base)
        for _ in range(r.randrange(1, 6)):
            w[r.randrange(200)] = f"x{k}"
        near.append(" ".join(w))
    texts = [None, "", " \t\n", "a b", "A  B", "a b c", "é É", "É É", *near, near[0], near[0].upper(), "long " * 30000]
    docs = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)] + [(5, "a b c", "z"), (None, near[3], "z")], "doc_id long, text string, kept string")
    out = [tuple(x) for x in N.near_duplicates(docs).collect()]
    assert len(out) == docs.count()
    assert {x for x in out if x[0] is not None} == brute(list(enumerate(texts)))
    assert [x for x in out if x[0] is None] == [(None, 196, None, True)]
    assert N.near_duplicates(docs.limit(0)).count() == 0
    kept = N.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted([x[0] for x in out if x[3] and x[0] is not None])


def test_group_held_together_by_one_that_is_no_leader(spark):
    """Copies at 0.78 to the original and 0.6 to each other; the original has neither the smallest id nor a leading hash."""
    r = random.Random(8)
    base = [f"w{k}" for k in range(204)]
    rows = []
    for k in range(300):
        w = list(base)
        for place in r.sample(range(5, 199, 5), 5):
            w[place] = f"x{k}-{place}"
        rows.append((k, " ".join(w)))
    rows.append((300, " ".join(base)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert sum(x[3] for x in want) == 1
    assert {tuple(x) for x in N.near_duplicates(docs).collect()} == want


def test_share_of_pairs_that_meet_in_no_key():
    missed = lambda s: 1 - (1 - (1 - s**N.WIDTH) ** N.TABLES) ** 2
    assert missed(0.75) < 2.5e-5 and missed(0.8) < 1.3e-6


def family(n, seed=3, pool=40, chosen=20, words=50):
    """n texts of some stock paragraphs each, every second one an edited copy (similarity over 0.8) of the one before."""
    r = random.Random(seed)
    stock = [[f"p{k}w{j}" for j in range(words)] for k in range(pool)]
    rows = []
    for k in range(n // 2):
        w = [x for p in r.sample(stock, chosen) for x in p]
        rows.append((2 * k, " ".join(w)))
        for _ in range(len(w) // 50):
            w[r.randrange(len(w))] = f"x{k}"
        rows.append((2 * k + 1, " ".join(w)))
    return rows


@pytest.mark.parametrize(("block", "most"), [(4096, 1 << 22), (64, 1 << 22), (4096, 1 << 14)])
def test_family_of_stock_paragraphs_loses_no_link(spark, block, most):
    rows = family(240, words=25)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(x) for x in N.near_duplicates(docs, block=block, most=most).collect()} == brute(rows)


def test_texts_that_share_a_passage_alone_leave_a_large_family(spark):
    r = random.Random(4)
    passage = [f"common{k}" for k in range(60)]
    rows = []
    for k in range(80):
        own = [f"w{r.randrange(10**6)}" for _ in range(60)]
        rows += [(2 * k, " ".join(passage + own)), (2 * k + 1, " ".join(passage + own[:-1] + ["end"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(x) for x in N.near_duplicates(docs, block=16).collect()} == brute(rows)


def test_rows_of_one_id_join_their_texts(spark):
    a, b = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(30))
    docs = spark.createDataFrame([(3, a), (5, a), (5, b), (9, b), (9, b), (7, None), (7, a)], "doc_id long, text string")
    out = {tuple(x)[:3] for x in N.near_duplicates(docs).collect()}
    assert out == {(3, 26, 3), (5, 26, 3), (9, 26, 3), (7, 0, 7), (7, 26, 3)}


def test_overlaps_and_forest_against_sets():
    r = np.random.default_rng(2)
    sets = [np.unique(r.integers(0, 60, r.integers(1, 40))).astype(np.uint64) for _ in range(90)]
    bounds = np.r_[0, np.cumsum([len(x) for x in sets])]
    want = np.array([[len(np.intersect1d(x, y)) for y in sets] for x in sets])
    got = N.overlaps(bounds, np.concatenate(sets), 0)
    off = ~np.eye(90, dtype=bool)
    assert (got[off] == want[off]).all()
    assert (N.overlaps(bounds, np.concatenate(sets), 30) == want[:30, 30:]).all()
    linked = want >= 20
    edges = N.forest(linked, 0)
    assert all(linked[a, b] for a, b in edges) and len(edges) < 90
    assert N.forest(want[:30, 30:] >= 20, 30) == [] or all(want[a, b] >= 20 for a, b in N.forest(want[:30, 30:] >= 20, 30))

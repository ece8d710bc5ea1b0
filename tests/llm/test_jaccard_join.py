"""Components of the Jaccard join against all pairs, with prefixes of any length."""

import random

import numpy as np
import pytest
from cantolith.llm import jaccard_join as J
from cantolith.llm.common import durable
from pyspark.sql import functions as F

A_Z = {c: c + 32 for c in range(65, 91)}


def words(text):
    out, now = [], ""
    for c in (text or "").translate(A_Z):
        if c in " \t\n\x0b\x0c\r":
            out, now = [*out, now] if now else out, ""
        else:
            now += c
    return [*out, now] if now else out


def plain(rows, k=4, percent=85):
    """{doc_id: (sizes, component)} of (doc_id, text) rows."""
    sets = []
    for i, text in rows:
        w = words(text)
        sets.append((i, {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()))
    at = {i: i for i, _ in rows}

    def root(i):
        while at[i] != i:
            i = at[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and i is not None and j is not None and 100 * len(a & b) >= percent * len(a | b):
                at[max(root(i), root(j))] = min(root(i), root(j))
    return sorted(((i, len(s), root(i) if i is not None else None) for i, s in sets), key=str)


def check(spark, rows, **how):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((tuple(r) for r in J.jaccard_join(df, **how).collect()), key=str)
    assert got == plain(rows, how.get("shingle", 4), how.get("percent", 85))
    return got


def corpus(seed, n=150):
    """Families of edited copies, boilerplate that many share, and texts made of stock lines alone."""
    r = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    text = lambda m: [r.choice(vocab) for _ in range(m)]
    stock = [text(25) for _ in range(6)]
    bases = [text(r.randrange(5, 120)) for _ in range(15)]
    out = []
    for i in range(n):
        kind = r.random()
        if kind < 0.5:
            w = list(r.choice(bases))
            for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
                w[r.randrange(len(w))] = r.choice(vocab)
        elif kind < 0.75:
            w = [x for s in r.sample(stock, r.randrange(2, 6)) for x in s]
        else:
            w = text(r.randrange(0, 60)) + r.choice(stock)
        out.append((i, " ".join(w)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_all_pairs(spark, seed):
    got = check(spark, corpus(seed))
    assert len({x[2] for x in got}) < 140


@pytest.mark.parametrize("how", [{"share": 0.05}, {"share": 1.0}, {"block": 5, "most": 200}, {"percent": 60, "shingle": 2}, {"percent": 100}])
def test_parameters_do_not_change_what_is_linked(spark, how):
    check(spark, corpus(3, 100), **how)


def test_odd_rows(spark):
    long = " ".join(f"x{k}" for k in range(30_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one  TWO"), (6, "one two three"), (7, "É é"), (8, "é é"), (9, "a b c d e"), (10, "a b c d e")]
    rows += [(11, long), (12, long + " more"), (13, "p q r s t u"), (13, "p q r s t u"), (14, "k l m n"), (14, "g h i j"), (15, "g h i j"), (16, "k l m n")]
    rows += [(None, "p q r s t u"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in J.jaccard_join(df).collect()}
    want = {x for x in plain([x for x in rows if x[0] != 14 and x[0] not in (15, 16)])}
    # rows of one id are one document, and link what either text links
    assert got == want | {(14, 1, 14), (15, 1, 14), (16, 1, 14)}
    assert J.jaccard_join(df.limit(0)).count() == 0
    named = df.withColumns({"class": F.lit(1), "need": F.lit(2), "rep": F.lit("x")}).withColumnsRenamed({"doc_id": "id", "text": "s"})
    assert {tuple(r) for r in J.jaccard_join(named, "id", "s").collect()} == got


def test_ids_of_text(spark):
    df = spark.createDataFrame([("b", "a b c d e f"), ("a", "a b c d e f"), ("c", "z")], "doc_id string, text string")
    assert {r.doc_id: r.component_id for r in J.jaccard_join(df).collect()} == {"a": "a", "b": "a", "c": "c"}


def test_frequent_shingles_lengthen_prefixes(spark):
    """Texts of stock lines alone ask for more than one shared shingle; texts with words of their own keep short prefixes or none."""
    r = random.Random(4)
    stock = [[f"s{k}-{j}" for j in range(30)] for k in range(12)]
    rows = [(i, " ".join(x for s in r.sample(stock, 6) for x in s)) for i in range(200)]
    rows += [(500 + i, " ".join([*(f"o{i}-{j}" for j in range(60)), *stock[0]])) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    raw = df.select(F.col("doc_id").alias("id"), "text")
    own = raw.mapInArrow(J._postings(4, 85, 0.4, None, True), "hash long, class long, n long, low long")
    counts = own.groupBy("hash").agg(F.count("*").alias("df")).where("df > 1")
    made = durable(J.prefixes(own.join(counts, "hash"), 85, 0.4))
    needs = [x.need for x in made.collect()]
    assert 150 < len(needs) <= 200 and max(needs) > 1, needs  # those with words of their own meet nothing
    check(spark, rows)


def test_a_prefix_of_any_length_keeps_every_link():
    """Of sets that link, the first n - c + l shingles share l at least, for every l, in the order that postings have."""
    r = np.random.default_rng(6)
    for _ in range(200):
        base = r.integers(0, 2**63, 80, dtype=np.uint64) * np.uint64(2)
        a, b = (np.sort(np.unique(np.r_[base[r.permutation(80)[: r.integers(70, 80)]], r.integers(0, 2**63, 3, dtype=np.uint64)])) for _ in range(2))
        both = len(np.intersect1d(a, b))
        if 100 * both < 85 * (len(a) + len(b) - both):
            continue
        df = {int(x): int(r.integers(1, 50)) for x in np.union1d(a, b)}
        edge = int(0.4 * 2**64)
        order = lambda s: sorted(map(int, s), key=lambda x: (x >= edge, df[x] if x < edge else 0, x))
        x, y = order(a), order(b)
        for need in range(1, min(J.needed(len(a), 85), J.needed(len(b), 85)) + 1):
            first = lambda s, n=need: set(s[: len(s) - J.needed(len(s), 85) + n])
            assert len(first(x) & first(y)) >= need


def test_what_a_text_writes():
    s = np.sort(np.random.default_rng(1).integers(0, 2**63, 40, dtype=np.uint64) * np.uint64(2))
    bounds = np.array([0, 0, 25, 25, 26, 40, 40])
    s[:25].sort(), s[26:].sort()
    take, low = J.thin(s, bounds, 85, 0.4)
    for i, j in zip(bounds[:-1], bounds[1:], strict=True):
        own = s[i:j]
        under = int((own < np.uint64(int(0.4 * 2**64))).sum())
        spare = len(own) - int(J.needed(np.array(len(own)), 85)) + 1 if len(own) else 0
        assert take[i:j].sum() == max(under, spare) and take[i : i + max(under, spare)].all()
    assert low.tolist() == [int((s[i:j] < np.uint64(int(0.4 * 2**64))).sum()) for i, j in zip(bounds[:-1], bounds[1:], strict=True)]

import numpy as np
import pytest

from cantolith.llm import mixing as M


def plain_fit(n, p, targets, most):
    """Projected gradient with many small steps and no Spark."""
    total = n.sum()
    metric = np.linalg.inv((p * n[:, None]).T @ p / total)
    r = np.ones(len(n))
    for _ in range(4000):
        r = np.clip(r - 0.5 * p @ (metric @ ((n * r) @ p / total - targets)), 0, most)
    return (n * r) @ p / total


@pytest.mark.parametrize("targets", [[0.9, 0.06, 0.04], [0.2, 0.2, 0.6], [0.0, 0.0, 1.0]])
def test_fit_reaches_targets_or_the_nearest_totals(spark, targets):
    r = np.random.default_rng(3)
    p = np.round(r.dirichlet([2, 0.5, 0.2], 400), 6)
    n = r.integers(0, 500, 400)
    df = spark.createDataFrame([(int(a), *map(float, b)) for a, b in zip(n, p, strict=True)], "n long, p0 double, p1 double, p2 double")
    steps = M.fit(df, np.array(targets), 4.0)
    got = (n * M.rates(p, np.array(steps), 4.0)) @ p / n.sum()
    assert np.abs(got - plain_fit(n, p, np.array(targets), 4.0)).max() < 0.02
    own = df.withColumn("r", M._rate_column(3, steps, 4.0)).collect()
    assert np.allclose([x.r for x in own], M.rates(p, np.array(steps), 4.0))


def test_unbounded_rates_reach_a_rare_domain_and_a_missed_target_is_told(spark):
    r = np.random.default_rng(4)
    clean = np.arange(400) < 60
    p = np.round(np.where(clean[:, None], [0.97, 0.02, 0.01], [0.02, 0.95, 0.03]) + r.normal(0, 0.003, (400, 1)) * [1, -1, 0], 6)
    n = np.full(400, 100)
    df = spark.createDataFrame([(100, *map(float, b)) for b in p], "n long, p0 double, p1 double, p2 double")
    targets = np.array([0.94, 0.04, 0.02])
    steps = M.fit(df, targets)
    got = (n * M.rates(p, np.array(steps), None)) @ p / n.sum()
    assert np.abs(got - targets)[:2].max() < 0.02
    with pytest.warns(UserWarning, match="stay off"):
        M.fit(df, targets, 2.0)


def test_texts_of_many_features_give_a_bounded_number():
    r = np.random.default_rng(5)
    idx, bounds = np.sort(r.choice(1 << 15, 9000, replace=False)), np.array([0, 100, 9000])
    some, at = M.fewer(idx, bounds)
    assert at.tolist() == [0, 100, 100 + M.FEATURES] and (some[:100] == idx[:100]).all() and set(some[100:]) <= set(idx[100:])


def test_query(spark):
    d = "/root/testdata/sf0.01"
    out = M.op6_mixing(spark, d).toPandas()
    labels = spark.read.parquet(f"{d}/labels.parquet").toPandas()
    assert len(out) == 1000 and (out.rate >= 0).all() and ((out.copies - out.rate).abs() < 1).all()
    p = out[[f"p_{x}" for x in M.DOMAINS]].to_numpy()
    assert np.allclose(p.sum(axis=1), 1, atol=1e-5)
    got = (out.n_words * out.rate).to_numpy() @ p / out.n_words.sum()
    assert np.abs(got - [M.TARGETS[x] for x in M.DOMAINS]).max() < 1e-3
    both = out.merge(labels, on="doc_id")
    want = np.where(both.quality == 0, 1, np.where(both.toxic == 1, 2, 0))
    assert (both[[f"p_{x}" for x in M.DOMAINS]].to_numpy().argmax(axis=1) == want).mean() > 0.93


def test_held_out_domains(spark):
    d = "/root/testdata/sf0.1"
    out = M.op6_mixing(spark, d).toPandas()
    labels = spark.read.parquet(f"{d}/labels.parquet").toPandas()
    import zlib

    both = out.merge(labels, on="doc_id")
    both = both[[zlib.crc32(str(i).encode()) % 5 == 0 for i in both.doc_id]]
    want = np.where(both.quality == 0, 1, np.where(both.toxic == 1, 2, 0))
    assert (both[[f"p_{x}" for x in M.DOMAINS]].to_numpy().argmax(axis=1) == want).mean() > 0.93


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, 0.0), (2, "", 0.0), (None, "text", 0.0), (3, "a b", 0.0), (3, "a b", 0.0), (4, "w " * 100000, 0.0)], "doc_id long, text string, rate double")
    labels = spark.createDataFrame([(3, 1, 0), (3, 1, 0), (4, 0, None), (None, 0, 0), (1, 0, 0)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0)):
        out = M.mix(docs, some).collect()
        assert len(out) == 6 and all(0 <= r._rate < np.inf for r in out)
        assert len({r._rate for r in out if r.doc_id == 3}) == 1
        assert M.mix(docs.limit(0), some).count() == 0
    assert {r._rate for r in M.mix(docs.where("text is null or text = ''"), labels).collect()} == {1.0}

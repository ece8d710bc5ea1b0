import corpus_pipeline as P
from cantolith.llm import decontaminate, quality_rules
from tests.llm.test_near_dedup import brute as near
from tests.llm.test_substring_dedup import brute as cut


def test_stages_equal_brute_force(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    text = {i: r.text for i, r in rows.items()}
    verdict = {r.doc_id: r.kept for r in quality_rules.op7_quality_rules(spark, d).collect()}
    text = {i: t for i, t in text.items() if verdict[i]}
    kept = {i for i, _, _, k in near(sorted(text.items())) if k}
    text = cut(sorted((i, t) for i, t in text.items() if i in kept))
    left = spark.createDataFrame(sorted(text.items()), "doc_id long, text string")
    leaking = {r.doc_id for r in decontaminate.find_leaks(left, spark.read.parquet(f"{d}/benchmark.parquet")).collect()}
    items = [r.text for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    assert {i for i, t in text.items() if any(x in t for x in items)} <= leaking
    want = {i: t for i, t in text.items() if i not in leaking}
    out = P.run(spark, d)
    assert out.columns[: len(docs.columns)] == docs.columns
    got = out.collect()
    assert {r.doc_id: r.text for r in got} == want and len(got) == len(want)
    assert all(r.n_chars == len(r.text) and r.lang == rows[r.doc_id].lang and r.source == rows[r.doc_id].source for r in got)
    assert len(want) > 0.6 * len(rows)


def test_empty_and_odd_rows(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (2, "plain words " * 6, None, None, None)], docs.schema)
    clash = docs.limit(60).selectExpr("*", "1 AS c0", "'x' AS kept", "2 AS rate", "map('a', 1) AS _dup", "named_struct('x y', 1) AS `a.b`", "'k' AS _key", "'g' AS _gone", "0 AS _b", "0 AS _w0", "1 AS slot")
    for table in (docs.limit(0), odd, docs.union(odd), clash):
        now = table
        for k, (_, stage) in enumerate(P.STAGES):
            path = str(tmp_path / f"{id(table)}-{k}")
            stage(spark, now, d).write.parquet(path)
            now = spark.read.parquet(path)
        assert now.count() <= table.count()

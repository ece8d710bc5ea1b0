from pyspark.sql import functions as F

from cantolith.llm import url_filter as U
from tests.harness import compare, connect


def test_query_equals_sql(spark):
    d = "/root/testdata/sf0.01"
    out = U.op4_url_filter(spark, d)
    compare(out, connect(d), U.SQL)
    assert out.where("listed").count() > 0


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "no scheme/en/"), (4, "http://A.Example.COM/en/71?x#y"), (5, "http://xcom/en/"), (6, "http://example.net/de/8"), (7, "https://bad.tld/x/"), (7, "https://bad.tld/x/"), (8, "ftp://com/en/://org/es/"), (None, "http://q.org/es/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash")).withColumn("_key", F.lit(1))
    listed = spark.createDataFrame([("http://BAD.tld/x",), (None,), ("nothing",)], "url string")
    got = sorted(((r.page_id or 0, r.host, r.path, r.rule, r.verdict) for r in U.judge_urls(pages, listed).collect()), key=str)
    assert got == sorted([(0, "q.org", "/es/", "org/es/", "block"), (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "", "", None, "allow"), (4, "a.example.com", "/en/71", "example.com/en/7", "allow"), (5, "xcom", "/en/", None, "allow"), (6, "example.net", "/de/8", "example.net/de/8", "block"), (7, "bad.tld", "/x/", None, "block"), (7, "bad.tld", "/x/", None, "block"), (8, "com", "/en/://org/es/", "com/en/", "block")], key=str)
    assert U.judge_urls(pages.limit(0), listed.limit(0)).count() == 0


def test_filter_passes_every_listed_key(spark):
    keys = spark.range(5000).select(F.concat(F.lit("h/"), "id").alias("k"))
    urls = keys.select(F.col("k").alias("page_id"), F.concat(F.lit("http://"), "k").alias("url"))
    out = U.judge_urls(urls.union(urls.select(F.concat("page_id", F.lit("z")), F.concat("url", F.lit("z")))), urls, (), n_blocks=64)
    assert out.where("listed").count() == 5000 and out.count() == 10000


def test_a_listed_site_blocks_its_subdomains(spark):
    urls = ["http://bad.example.com", "https://m.bad.example.com/x?q", "http://a.b.bad.example.com/", "http://notbad.example.com/", "http://example.com/bad.example.com", "http://two.tld/x", "http://w.two.tld", "http://com/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    listed = spark.createDataFrame([("http://bad.example.com/",), ("https://two.tld",)], "url string")
    out = {r.page_id: r.verdict for r in U.judge_urls(pages, listed, ()).collect()}
    assert [out[k] for k in range(8)] == ["block"] * 3 + ["allow"] * 2 + ["block"] * 2 + ["allow"]


def test_query_blocks_unwanted_sites(spark):
    out = U.op4_url_filter(spark, "/root/testdata/sf0.1")
    bad = out.where("host RLIKE 'casino|pills|bets|adult'")
    assert bad.count() > 50 and bad.where("not listed").count() == 0
    assert out.where("listed").count() == bad.count()

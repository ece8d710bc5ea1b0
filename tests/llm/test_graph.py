import random

from cantolith.llm.bloom import bloom, probe
from cantolith.llm.graph import components


def plain(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {x: find(x) for x in root}


def test_components(spark):
    r = random.Random(3)
    edges = [(k, k + 1) for k in range(100, 160)]  # a chain
    edges += [(200, 200 + k) for k in range(1, 80)]  # a star
    edges += [(r.randrange(300, 500), r.randrange(300, 500)) for _ in range(120)]
    edges = [(a, b) for a, b in edges if a != b] + [(7, 9), (9, 7), (9, 7)]
    got = {x.node: x.component for x in components(spark.createDataFrame([*edges, (5, 5)], "a long, b long")).collect()}
    assert got == plain(edges)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bloom_has_no_misses(spark):
    keys = spark.range(3000).withColumnRenamed("id", "k")
    assert bloom(keys, "k", 16).count() <= 16
    out = probe(spark.range(6000), "id", keys, "k", 4096, "maybe")
    assert out.where("id < 3000 and not maybe").count() == 0 and out.where("id >= 3000 and maybe").count() < 30
    assert probe(spark.sql("SELECT CAST(NULL AS BIGINT) AS id"), "id", keys, "k", 16, "maybe").first().maybe is False

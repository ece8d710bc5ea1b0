"""Running folds with carries against plain loops, by blocks of any size, and a document that holds most rows."""

import random

import pytest
from cantolith.operators import sequences, timeline
from cantolith.operators.scan import Fold, places, scan
from pyspark.sql import functions as F


def rows(seed, docs=6, n=60):
    r = random.Random(seed)
    return [(d, k, r.choice([None, *range(-5, 6)])) for d in range(docs) for k in range(r.randrange(0, n)) if r.random() < 0.8]


@pytest.mark.parametrize("size", [1, 3, 7, 4096])
def test_folds_equal_loops(spark, size):
    data = rows(size)
    df = spark.createDataFrame(data, "doc_id long, at long, v long")
    v = F.col("v")
    got = scan(df, "doc_id", ["at"], places("at", size), total=Fold("sum", v), top=Fold("max", v), last=Fold("last", v), before=Fold("sum", v, own=False), ahead=Fold("last", v, back=True), later=Fold("max", v, back=True, own=False))
    for d in range(6):
        own = sorted(x[1:] for x in data if x[0] == d)
        held = {x.at: x for x in got.where(F.col("doc_id") == d).collect()}
        assert len(held) == len(own)
        for k, (at, _) in enumerate(own):
            seen, left, past, next_ = ([y for _, y in part if y is not None] for part in (own[: k + 1], own[k:], own[:k], own[k + 1 :]))
            x = held[at]
            assert (x.total, x.top, x.last) == ((sum(seen), max(seen), seen[-1]) if seen else (None,) * 3)
            assert x.before == (sum(past) if past else None) and x.ahead == (left[0] if left else None) and x.later == (max(next_) if next_ else None)


def test_edges(spark):
    none = spark.createDataFrame([], "doc_id long, at long, v long")
    assert scan(none, "doc_id", ["at"], places("at"), s=Fold("sum", F.col("v"))).count() == 0
    odd = spark.createDataFrame([(None, 0, 1), (None, 1, 2), (1, 0, None)], "doc_id long, at long, v long")
    got = {(x.doc_id, x.at): x.s for x in scan(odd, "doc_id", ["at"], places("at"), s=Fold("sum", F.col("v"))).collect()}
    assert got == {(None, 0): 1, (None, 1): 3, (1, 0): None}  # rows without a key are kept, and folded by block


def test_repairs_do_not_depend_on_blocks(spark):
    r = random.Random(4)
    t, words = 0.0, []
    for k in range(400):
        t += r.choice([-3, 0, 1, 2, 9])
        timed = r.random() < 0.4
        words.append((k % 2, k // 2, t if timed else None, t + r.randrange(5) if timed else None))
    df = spark.createDataFrame(words, "doc_id long, word_idx long, start_s double, end_s double")
    for f in (timeline.interpolate, timeline.monotonic_words):
        assert sorted(map(tuple, f(df, block=3).collect())) == sorted(map(tuple, f(df).collect()))
    frames = df.select("doc_id", F.col("word_idx").alias("tick"), F.col("start_s").cast("long").alias("word_idx"))
    for f in (timeline.monotonic_frames, timeline.fill_between):
        key = lambda x: (x[0], x[1])
        assert sorted(map(tuple, f(frames, block=3).collect()), key=key) == sorted(map(tuple, f(frames).collect()), key=key)
    lined = df.withColumn("line", F.floor(F.col("word_idx") / 7))
    assert sorted(map(str, sequences.line_changes(lined, block=3).collect())) == sorted(map(str, sequences.line_changes(lined).collect()))
    segs = df.select("doc_id", F.col("word_idx").alias("seg_id"), F.lit(2).cast("long").alias("duration"))
    assert all(x.start_s == 2 * x.seg_id for x in timeline.starts(segs, block=3).collect())


def test_a_hot_document_is_dealt_over_tasks(spark):
    """Half of all rows are of one document; no partition of the rows' shuffle holds more than twice the median."""
    words = spark.range(400_000).select(F.when(F.col("id") < 200_000, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("doc_id"), F.when(F.col("id") < 200_000, F.col("id")).otherwise(F.floor((F.col("id") - 200_000) / 97)).alias("word_idx"))
    words = words.withColumn("start_s", F.when(F.col("word_idx") % 3 > 0, F.col("word_idx") * 1.0)).withColumn("end_s", F.col("start_s") + 1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for f in (timeline.interpolate, timeline.monotonic_words):
            sizes = sorted(f(words, block=4096).groupBy(F.spark_partition_id()).count().toPandas()["count"])
            assert sizes[-1] <= 2 * sizes[len(sizes) // 2], sizes
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_no_frame_is_computed_anew_for_each_row(spark):
    """A frame without an end is; folds from the end go through the rows in reverse."""
    df = spark.createDataFrame([(1, 1, 1)], "doc_id long, at long, v long")
    plan = scan(df, "doc_id", ["at"], places("at"), n=Fold("last", F.col("v"), back=True), m=Fold("sum", F.col("v"), back=True, own=False))._jdf.queryExecution().toString()
    assert "unboundedpreceding" in plan and "unboundedfollowing" not in plan

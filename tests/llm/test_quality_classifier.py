import zlib

import numpy as np
import pytest

from cantolith.llm import quality_classifier as C


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    out = C.op8_quality_classifier(spark, d).collect()
    assert len(out) == 10000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    rows = [(r.score, labels[r.doc_id]) for r in out if r.held_out and r.doc_id in labels]
    s, y = map(np.array, zip(*rows, strict=True))
    rank = s.argsort().argsort()
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    auc = (rank[y == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * n0)
    assert auc > 0.97 and ((s >= 0.3) == y).mean() > 0.95
    assert s[y == 1].mean() > 0.9


def test_context_sums_equal_plain_loops():
    import pyarrow as pa

    from cantolith.llm import features

    texts = ["one two three two", "", "one one", None, "x"]
    (got,) = C._contexts(iter([pa.record_batch([pa.array(texts)], ["text"])]))
    place, sign = C.index_vectors()
    want = np.zeros((C.WORDS, C.DIMS))
    for t in filter(None, texts):
        raw = np.frombuffer(t.encode(), np.uint8)
        b = features.buckets(features.tokens(raw, np.array([0, len(raw)]))[0], C.BITS)
        for i in range(len(b)):
            for j in range(max(0, i - 2), min(len(b), i + 3)):
                if i != j:
                    for p, s in zip(place[b[j]], sign[b[j]], strict=True):
                        want[b[i], p] += s
    sums = np.zeros((C.WORDS // C.BLOCK, C.BLOCK * C.DIMS))
    for k, x in zip(got.column(0).to_pylist(), got.column(1).to_pylist(), strict=True):
        sums[k] = np.frombuffer(x, np.int32)
    assert (sums.reshape(C.WORDS, C.DIMS) == want).all() and got.num_rows < len(sums)


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 1), (2, 0), (2, 0), (None, 1), (3, None)]])
def test_edges(spark, labels):
    docs = spark.createDataFrame([(1, None, 0.0), (2, "", 0.0), (None, "text", 0.0), (3, "a b", 0.0), (3, "a b", 0.0), (4, "w " * 100000, 0.0)], "doc_id long, text string, score double")
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    out = C.classify_quality(docs, table).collect()
    assert len(out) == 6 and all(0 <= r.score <= 1 for r in out)
    assert C.classify_quality(docs.limit(0), table).count() == 0

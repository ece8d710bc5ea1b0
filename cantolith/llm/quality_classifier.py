"""Quality classifier: random-indexing word vectors pooled per document, and a two-layer network.

Words fall into WORDS hashed classes. Each has a fixed sparse index vector of DIMS places; a word's
context vector is the sum of the index vectors of its neighbours over all documents. The tables
of all tasks are added in Spark in blocks, so the driver gathers WORDS*DIMS numbers whatever the
corpus's size. A document is the mean of its words' vectors and a few figures; the network learns
on SAMPLE labelled rows at most, and a temperature fitted on some of them that it did not learn on
calibrates its probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import features
from . import kernel as K
from .common import in_batches, pieces, table, utf8

BITS, DIMS, PLACES, REACH = 14, 64, 2, 2
WORDS, BLOCK = 1 << BITS, 64
#: Most labelled rows that the network learns on, those of the smallest hashes.
SAMPLE = 20_000
HIDDEN, EPOCHS, RATE = 32, 60, 0.01
THRESHOLD = 0.3
EXTRA = 4


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """PLACES places and signs of each word class."""
    h = K.mix(np.arange(WORDS, dtype=np.uint64)[:, None] * np.uint64(PLACES) + np.arange(PLACES, dtype=np.uint64) + K.seeds(1, 41))
    return (h % np.uint64(DIMS)).astype(np.int64), np.where(h >> np.uint64(63) == 1, 1.0, -1.0)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    place, sign = index_vectors()
    total = np.zeros(WORDS * DIMS)
    for batch in batches:
        data, offsets = utf8(batch.column(0))
        for i, j in pieces(offsets):
            h, bounds = features.tokens(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            b = features.buckets(h, BITS)
            doc = np.repeat(np.arange(j - i), np.diff(bounds))
            at, weight = [], []
            for k in range(1, REACH + 1):
                near = doc[:-k] == doc[k:]
                left, right = b[:-k][near], b[k:][near]
                for word, other in ((left, right), (right, left)):
                    at.append((word[:, None] * DIMS + place[other]).ravel())
                    weight.append(sign[other].ravel())
            total += np.bincount(np.concatenate(at), np.concatenate(weight), WORDS * DIMS)
    blocks = total.reshape(-1, BLOCK * DIMS)
    some = np.flatnonzero(blocks.any(axis=1))
    yield _table(blocks[some], some)


def _table(blocks: np.ndarray, names: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array(names.astype(np.int32)), pa.array([x.astype(np.int32).tobytes() if abs(x).max(initial=0) < 2**31 else x.astype(np.int64).tobytes() for x in blocks], pa.binary())], ["block", "sums"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of each block, over any number of rows, one batch at a time."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            v = np.frombuffer(x, np.int32 if len(x) == BLOCK * DIMS * 4 else np.int64).astype(np.float64)
            total[k] = total[k] + v if k in total else v
    if total:
        yield _table(np.stack(list(total.values())), np.array(list(total)))


def word_vectors(texts: DataFrame) -> np.ndarray:
    """WORDS centred vectors of length 1 (0 for unseen words), learnt from all rows of texts(text)."""
    schema = "block int, sums binary"
    parts = in_batches(texts, _contexts, schema)
    # each task's block goes first to one of 16 parts by chance, then to the block's own
    some = in_batches(parts.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(16))).repartition("block", "salt").select("block", "sums"), _added, schema)
    rows = in_batches(some.repartition("block"), _added, schema).collect()  # bounded: WORDS / BLOCK rows
    v = np.zeros((WORDS, DIMS))
    for r in rows:
        x = np.frombuffer(r["sums"], np.int32 if len(r["sums"]) == BLOCK * DIMS * 4 else np.int64)
        v[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = x.reshape(BLOCK, DIMS)
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    v = np.divide(v, norm, out=np.zeros_like(v), where=norm > 0)
    if (norm > 0).any():
        v[norm[:, 0] > 0] -= v[norm[:, 0] > 0].mean(axis=0)
    norm = np.linalg.norm(v, axis=1, keepdims=True)
    return np.divide(v, norm, out=np.zeros_like(v), where=norm > 0).astype(np.float32)


def pooled(vectors: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """DIMS + EXTRA features of each text; all 0 for a text without tokens."""
    h, bounds = features.tokens(data, offsets)
    b = features.buckets(h, BITS)
    n = np.diff(bounds)
    mean = features.sums(vectors[b], bounds) / np.maximum(n, 1)[:, None]
    kinds = np.diff(features.distinct(b, bounds, BITS)[1])
    same = np.r_[b[1:] == b[:-1], False][: len(b)].astype(np.float64)
    some = (n > 0).astype(float)
    extra = [np.log1p(n) / 8, kinds / np.maximum(n, 1), np.linalg.norm(mean, axis=1), features.sums(same, bounds) / np.maximum(n, 1)]
    return np.column_stack([mean, *extra]) * some[:, None]


class Network:
    """Two layers; score() is the calibrated probability of label 1."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 1):
        self.mean, self.temperature, self.layers = 0.5, 1.0, None
        self.mean = float((y.sum() + 1) / (len(y) + 2))
        if len(set(y.tolist())) < 2:
            return
        r = np.random.default_rng(seed)
        order = r.permutation(len(y))
        x, y = x[order], y[order].astype(float)
        cut = max(1, len(y) // 8) if len(y) >= 16 else 0
        self.center, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        layers = [r.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), r.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        self.layers = layers
        first, second = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers]
        tx, ty, step = (x[cut:] - self.center) / self.scale, y[cut:], 0
        for _ in range(EPOCHS):
            turn = r.permutation(len(ty))
            for k in range(0, len(turn), 256):
                rows = turn[k : k + 256]
                hidden = np.maximum(tx[rows] @ layers[0] + layers[1], 0)
                wrong = (1 / (1 + np.exp(-np.clip(hidden @ layers[2] + layers[3], -40, 40))) - ty[rows]) / len(rows)
                back = np.outer(wrong, layers[2]) * (hidden > 0)
                step += 1
                for p, m, s, g in zip(layers, first, second, (tx[rows].T @ back, back.sum(axis=0), hidden.T @ wrong, wrong.sum(keepdims=True)), strict=True):
                    g = g + 1e-4 * p
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
        if cut and 0 < y[:cut].sum() < cut:  # the temperature of the least loss on rows kept from learning
            z = self.logits(x[:cut])
            loss = lambda t: np.logaddexp(0, -np.where(y[:cut] > 0, z, -z) / t).mean()
            self.temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x - self.center) / self.scale @ self.layers[0] + self.layers[1], 0)
        return hidden @ self.layers[2] + self.layers[3]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.layers is None:
            return np.full(len(x), self.mean)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def _pool(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Of rows (label, text): label and features."""
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for i, j in pieces(offsets):
            x = pooled(shared.value, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            flat = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
            yield pa.record_batch([batch.column(0).slice(i, j - i), flat], ["label", "x"])


def _score(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    vectors, network = shared.value
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for i, j in pieces(offsets):
            p = network.score(pooled(vectors, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
            yield pa.record_batch([batch.column(0).slice(i, j - i), pa.array(p)], ["id", "score"])


def held_out(doc_id: Column) -> Column:
    """Whether a row's label is kept from learning: crc32 of its id as text, modulo 5, is 0; false for null."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def sampled_labels(labels: DataFrame, doc_id: str, columns: list[str], size: int) -> DataFrame:
    """(_id, columns) of at most size learnable ids, those of the smallest hashes; one row for each id."""
    own = labels.select(F.col(doc_id).alias("_id"), *columns).where(F.col("_id").isNotNull() & ~held_out(F.col("_id"))).na.drop()
    one = own.groupBy("_id").agg(*(F.max(c).alias(c) for c in columns))
    return one.orderBy(F.xxhash64("_id"), "_id").limit(size)


def classify_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of docs.

    score is the probability of label 1, learnt from labels of ids that are not held out; the text
    alone is its input. Null and empty texts have the features of no token and a score as well.
    Of labels of one id the largest counts, of texts of one id the smallest, null ones don't; without labels of both kinds the
    score is their smoothed mean. Repeated rows and null ids get rows of their own; other columns
    are not carried; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    raw = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    vectors = word_vectors(raw.select("text"))
    shared = spark.sparkContext.broadcast(vectors)
    known = sampled_labels(labels, doc_id, [label], sample)
    # bounded: sample rows of two numbers
    rows = raw.join(F.broadcast(known), F.col("id") == F.col("_id")).select("id", F.col(label).cast("int").alias("label"), "text").where("label in (0, 1)").groupBy("id", "label").agg(F.min("text").alias("text"))
    learnt = in_batches(rows.select("label", "text"), lambda it: _pool(it, shared), "label int, x array<double>").toArrow()
    y = np.asarray(learnt["label"].combine_chunks())
    x = np.asarray(learnt["x"].combine_chunks().flatten()).reshape(len(y), DIMS + EXTRA)
    order = np.lexsort((*x.T, y))  # the same network however Spark orders the rows
    both = spark.sparkContext.broadcast((vectors, Network(x[order], y[order])))
    out = in_batches(raw, lambda it: _score(it, both), f"id {dict(raw.dtypes)['id']}, score double")
    return out.select(F.col("id").alias(doc_id), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of every document, learnt from labels.quality."""
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

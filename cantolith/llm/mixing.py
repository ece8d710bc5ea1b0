"""Mixing sources to target weights: soft domains, and document rates fitted by projected gradient.

A softmax classifier learns the domains of at most SAMPLE labelled rows and gives every document a
posterior over them. Nonnegative rates are then sought whose expected domain tokens (words
between white space), sums of rate * tokens * posterior over all documents, come as near as possible to the targets. The
descent starts from rates of 1. In the metric that is used (residuals by the inverse of the
token-weighted Gram matrix of the posteriors, with a small ridge, rates by tokens) the gradient's
Lipschitz constant is at most 1, so full steps descend, and a step moves a document's rate by its posterior times one vector.
Each step sums one vector over a table of a few numbers a document; a document's rate follows
from its posterior and the list of vectors alone, so none is stored between steps.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import features
from . import kernel as K
from .common import durable, in_batches, number, numbered, pieces, table, utf8
from .quality_classifier import sampled_labels

BITS = 15
#: Most labelled rows that the classifier learns on, those of the smallest hashes.
SAMPLE = 6_000
EPOCHS, RATE, DECAY = 120, 0.3, 1e-5
#: Most features of a text that the classifier learns on, those of the smallest hashes; it scores all of them.
FEATURES = 2_048
#: Least texts of the sample that a token is found in to count (fewer in a small sample); a text's weights fall with this power of its number of features.
LEAST, POWER = 20, 0.25
#: Domains of the labels, and their share of the tokens after mixing.
DOMAINS = ("clean", "low", "toxic")
TARGETS = {"clean": 0.94, "low": 0.04, "toxic": 0.02}
#: Steps at most; a step that changes totals by less than this share ends the descent; a residual over this is told.
STEPS, NEAR, FAR = 100, 1e-4, 1e-3
RIDGE = 1e-3
EXTRA = 3


def domain(quality: Column, toxic: Column) -> Column:
    """A label row's domain, as an index into DOMAINS."""
    return F.when(quality == 0, 1).when(toxic == 1, 2).otherwise(0)


def signs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature indices of each text (its distinct tokens, a bias and two of repetition), their offsets, numbers of words."""
    h, bounds = features.tokens(data, offsets)
    n = np.diff(bounds)
    b, at = features.distinct(features.buckets(h, BITS), bounds, BITS)
    kinds = np.diff(at)
    size = 1 << BITS
    share = np.where(n > 0, kinds / np.maximum(n, 1), 1)
    extra = np.stack([np.full(len(n), size), size + 1 + (share < 0.25), size + 3 + (n < 12)])
    ends = at[1:] + EXTRA * np.arange(1, len(n) + 1)
    out = np.empty(len(b) + EXTRA * len(n), np.int64)
    spot = np.ones(len(out), bool)
    for k in range(EXTRA):
        out[ends - EXTRA + k] = extra[k]
        spot[ends - EXTRA + k] = False
    out[spot] = b
    return out, np.r_[0, ends], np.diff(K.words(data, offsets)[2])


def logits(weights: np.ndarray, idx: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.stack([features.sums(w[idx], bounds) for w in weights.T], axis=1)
    return sums / (np.maximum(np.diff(bounds), 1) ** POWER)[:, None]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def learn(idx: np.ndarray, bounds: np.ndarray, y: np.ndarray, k: int) -> np.ndarray:
    """Weights of a softmax classifier by Adam on all rows; zeros without rows."""
    w = np.zeros(((1 << BITS) + 5, k))
    if not len(y):
        return w
    first, second = np.zeros_like(w), np.zeros_like(w)
    row = np.repeat(np.arange(len(y)), np.diff(bounds))
    scale = 1 / np.diff(bounds) ** POWER
    common = (np.bincount(idx, minlength=len(w)) >= max(1, min(LEAST, len(y) // 50)))[:, None]
    aim = np.eye(k)[y]
    for step in range(1, EPOCHS + 1):
        wrong = (softmax(logits(w, idx, bounds)) - aim) * (scale / len(y))[:, None]
        g = (np.stack([np.bincount(idx, wrong[row, c], len(w)) for c in range(k)], axis=1) + DECAY * w) * common
        first += 0.1 * (g - first)
        second += 0.01 * (g * g - second)
        w -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    return w


def fewer(idx: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """At most FEATURES indices of each text, those of the smallest hashes."""
    n = np.diff(bounds)
    if n.max(initial=0) <= FEATURES:
        return idx, bounds
    parts = [idx[i:j] for i, j in zip(bounds[:-1], bounds[1:], strict=True)]
    parts = [x if len(x) <= FEATURES else np.sort(x[np.argsort(K.mix(x.astype(np.uint64) + K.seeds(1, 51)), kind="stable")[:FEATURES]]) for x in parts]
    return np.concatenate(parts), np.r_[0, np.cumsum([len(x) for x in parts])]


def _signs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for i, j in pieces(offsets):
            idx, bounds, _ = signs(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            idx, bounds = fewer(idx, bounds)
            yield pa.record_batch([batch.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(idx.astype(np.int32)))], ["label", "x"])


def posteriors(weights: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posterior rows and numbers of words of the texts, rounded so that any order of sums gives the same."""
    idx, bounds, words = signs(data, offsets)
    return np.round(softmax(logits(weights, idx, bounds)), 6), words


def _moments(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(0))
        for i, j in pieces(offsets):
            p, n = posteriors(shared.value, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            yield pa.record_batch([pa.array(n.astype(np.int64)), *map(pa.array, p.T)], ["n", *(f"p{k}" for k in range(p.shape[1]))])


def rates(p: np.ndarray, steps: np.ndarray, most: float | None) -> np.ndarray:
    """The rates of posterior rows after the steps, each a vector that is taken off by posterior."""
    r = np.ones(len(p))
    for g in steps:
        r = np.clip(r - p @ g, 0, most)
    return r


def _rate_column(k: int, steps: list[np.ndarray], most: float | None) -> Column:
    """rates(), as an expression over columns p0, p1, ..."""
    taken = F.array(*(F.array(*(F.lit(float(x)) for x in g)) for g in steps)) if steps else None
    if taken is None:
        return F.lit(1.0)
    dot = lambda g: sum((F.col(f"p{c}") * g[c] for c in range(1, k)), F.col("p0") * g[0])
    cap = (lambda r: r) if most is None else (lambda r: F.least(F.lit(float(most)), r))
    return F.aggregate(taken, F.lit(1.0), lambda r, g: F.greatest(F.lit(0.0), cap(r - dot(g))))


def fit(moments: DataFrame, targets: np.ndarray, most: float | None = None, limit: int = STEPS) -> list[np.ndarray]:
    """The descent's steps over moments(n, p0, ...); targets are shares of all tokens. A warning tells of totals that stay off."""
    k = len(targets)
    gram = moments.agg(F.sum("n").alias("n"), *(F.sum(F.col("n") * F.col(f"p{a}") * F.col(f"p{b}")).alias(f"g{a}_{b}") for a in range(k) for b in range(a, k))).first()
    if not gram["n"]:
        return []
    total = float(gram["n"])
    g = np.array([[gram[f"g{min(a, b)}_{max(a, b)}"] for b in range(k)] for a in range(k)]) / total
    # the ridge keeps directions that hardly any posterior has from ruling the descent
    metric = np.linalg.inv(g + RIDGE * np.trace(g) * np.eye(k))
    steps: list[np.ndarray] = []
    for _ in range(limit):
        r = _rate_column(k, steps, most)
        now = moments.withColumn("r", r).agg(*(F.sum(F.col("n") * F.col("r") * F.col(f"p{a}")).alias(f"s{a}") for a in range(k))).first()
        sums = np.array([now[f"s{a}"] for a in range(k)]) / total
        if steps and np.abs(sums - last).max() < NEAR or np.abs(sums - targets).max() < NEAR:
            break
        last = sums
        steps.append(metric @ (sums - targets))
    if (off := np.abs(sums - targets).max()) > FAR:
        warnings.warn(f"the domain totals stay off their targets by up to {off:.4f} of all tokens after {len(steps)} steps", stacklevel=2)
    return steps


def _rated(batches: Iterator[pa.RecordBatch], shared, text: int, most: float | None) -> Iterator[pa.RecordBatch]:
    weights, steps = shared.value
    for batch in batches:
        data, offsets = utf8(batch.column(text))
        for i, j in pieces(offsets):
            p, n = posteriors(weights, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            extra = [pa.array(n.astype(np.int64)), *map(pa.array, p.T), pa.array(np.round(rates(p, steps, most), 6))]
            yield pa.record_batch([*(c.slice(i, j - i) for c in batch.columns), *extra], names=[*batch.schema.names, "_n", *(f"_p{k}" for k in range(p.shape[1])), "_rate"])


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, doc_id: str = "doc_id", text: str = "text", most: float | None = None, sample: int = SAMPLE) -> DataFrame:
    """docs with _n, the words of the text, _p0, _p1, ..., its posteriors over DOMAINS, and _rate.

    Null and empty texts have no words: their posterior is that of no token and their rate follows
    from it. Every row has a rate; repeated rows count as often as they stand and have equal ones.
    Labels of null ids or with a null count nothing, of labels of one id the largest do, of texts
    of one id the smallest; without labels the posterior is even. Rates are at most most, if given. Without words in the table all rates are 1. All columns are
    carried; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    names, own_id, text = docs.columns, number(docs, doc_id), number(docs, text)
    docs = numbered(docs)
    aim = np.array([(targets or TARGETS)[x] for x in DOMAINS])
    known = sampled_labels(labels, doc_id, ["quality", "toxic"], sample)
    raw = docs.select(F.col(own_id).alias("id"), F.col(text).alias("text"))
    # bounded: sample rows of three numbers
    rows = raw.join(F.broadcast(known), F.col("id") == F.col("_id")).select("id", domain(F.col("quality"), F.col("toxic")).alias("label"), "text").groupBy("id", "label").agg(F.min("text").alias("text"))
    learnt = in_batches(rows.select("id", "label", "text").orderBy("id").select("label", "text"), _signs, "label int, x array<int>").toArrow()
    y, x = (learnt[c].combine_chunks() for c in ("label", "x"))
    idx, bounds = np.asarray(x.flatten()), np.asarray(x.offsets) if len(x) else np.zeros(1, np.int64)
    weights = learn(idx, bounds - bounds[0], np.asarray(y), len(DOMAINS))
    shared = spark.sparkContext.broadcast(weights)
    kinds = [f"p{k} double" for k in range(len(DOMAINS))]
    moments = durable(in_batches(docs.select(F.col(text).alias("text")), lambda it: _moments(it, shared), ", ".join(["n long", *kinds])))
    steps = fit(moments, aim, most)
    both = spark.sparkContext.broadcast((weights, np.array(steps).reshape(-1, len(DOMAINS))))
    more = ["_n", *(f"_p{k}" for k in range(len(DOMAINS))), "_rate"]
    schema = T.StructType([*docs.schema.fields, T.StructField("_n", T.LongType()), *(T.StructField(x, T.DoubleType()) for x in more[1:])])
    return in_batches(docs, lambda it, at=docs.columns.index(text): _rated(it, both, at, most), schema).toDF(*names, *more)


def copies(doc_id: str, text: str) -> Column:
    """How often a document is taken at its rate: whole copies, and one more where a hash of it falls under the rest."""
    chance = F.pmod(F.xxhash64(doc_id, text, F.lit(61)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor("_rate") + (chance < F.col("_rate") - F.floor("_rate")).cast("long")).alias("copies")


def named(out: DataFrame, columns: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """columns of mix()'s result, then n_words, p_<domain>, rate and copies; columns of such names give way."""
    own = {"n_words", *(f"p_{x}" for x in DOMAINS), "rate", "copies"}
    return out.select(*(F.col(f"`{c}`") for c in columns if c.lower() not in own), F.col("_n").alias("n_words"), *(F.col(f"_p{k}").alias(f"p_{x}") for k, x in enumerate(DOMAINS)), F.col("_rate").alias("rate"), copies(doc_id, text))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posterior, rate and copies of every document for TARGETS."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return named(mix(docs, table(spark, sf_dir, "labels")), ["doc_id"])

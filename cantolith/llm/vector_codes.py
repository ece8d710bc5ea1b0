"""Vectors compressed to one byte for each part, with codebooks fitted by rounds of integer sums.

A round broadcasts a kd-tree for each part's codebook. The search goes down to the nearer box first
and then to every other one whose bound is not above the best distance so far; boxes of an equal
bound are visited as well, so of equal entries the one of the lowest index is found. Tasks add up
their parts by entry before anything is shuffled: what a round moves has a bound (parts x entries x
(components + 1) numbers a task), whatever the table's size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import vectors as V
from .common import durable, meet, table

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Entries of a leaf.
LEAF = 8


class Tree:
    """A kd-tree over a codebook's entries; every node has the box of its entries."""

    def __init__(self, entries: np.ndarray, own: np.ndarray | None = None):
        own = np.arange(len(entries)) if own is None else own
        x = entries[own]
        self.low, self.high, self.sides = x.min(0), x.max(0), None
        if len(own) <= LEAF:
            self.own, self.entries = np.sort(own), entries[np.sort(own)]
            return
        order = own[np.argsort(x[:, int(np.argmax(self.high - self.low))], kind="stable")]
        self.sides = Tree(entries, order[: len(order) // 2]), Tree(entries, order[len(order) // 2 :])

    def bound(self, x: np.ndarray) -> np.ndarray:
        """The squared distance of each point from the box: no entry of the node is nearer."""
        off = np.maximum(0, np.maximum(self.low - x, x - self.high))
        return (off * off).sum(1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of each point's nearest entry, the lowest index of equally near ones."""
        best, at = np.full(len(x), np.iinfo(np.int64).max), np.zeros(len(x), np.int64)
        self._visit(x, np.arange(len(x)), best, at)
        return at, best

    def _visit(self, x: np.ndarray, rows: np.ndarray, best: np.ndarray, at: np.ndarray) -> None:
        if not len(rows):
            return
        if self.sides is None:
            off = x[rows][:, None, :] - self.entries
            d = (off * off).sum(2)
            k = d.argmin(1)
            d, k = d[np.arange(len(rows)), k], self.own[k]
            better = (d < best[rows]) | ((d == best[rows]) & (k < at[rows]))
            best[rows[better]], at[rows[better]] = d[better], k[better]
            return
        a, b = self.sides
        da, db = a.bound(x[rows]), b.bound(x[rows])
        first = da <= db
        for near, far, own, bound in ((a, b, first, db), (b, a, ~first, da)):
            near._visit(x, rows[own], best, at)
            left = own & (bound <= best[rows])
            far._visit(x, rows[left], best, at)


def assigned(x: np.ndarray, trees: list[Tree]) -> tuple[np.ndarray, np.ndarray]:
    """(entry of each part, squared distances summed over the parts) of each row of x."""
    w = x.shape[1] // len(trees)
    found = [tree.nearest(x[:, p * w : (p + 1) * w]) for p, tree in enumerate(trees)]
    return np.stack([k for k, _ in found], 1), np.sum([d for _, d in found], 0)


def _sums(trees, n: int, entries: int):
    """(slot, value) of a task: for each part and entry the sums of its components and, last, how many rows took it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, w = trees.value, n // len(trees.value)
        total = np.zeros((len(own), entries, w + 1), np.int64)
        for batch in batches:
            for b in V.parts(batch):
                x = V.matrix(b.column(0), n)
                codes, _ = assigned(x, own)
                for p in range(len(own)):
                    np.add.at(total[p, :, :w], codes[:, p], x[:, p * w : (p + 1) * w])
                    total[p, :, w] += np.bincount(codes[:, p], minlength=entries)
        slot = np.flatnonzero(np.repeat(total[:, :, w].ravel() > 0, w + 1))
        yield pa.record_batch([pa.array(slot), pa.array(total.ravel()[slot])], ["slot", "value"])

    return run


def fit(rows: DataFrame, vector: str, start: np.ndarray, parts: int, rounds: int) -> np.ndarray:
    """Codebooks as (part, entry, component) after some rounds from those of start's rows (entry, component)."""
    n = start.shape[1]
    books = np.stack(np.split(start, parts, axis=1))
    w = n // parts
    for _ in range(rounds):
        trees = rows.sparkSession.sparkContext.broadcast([Tree(b) for b in books])
        sums = rows.select(vector).mapInArrow(_sums(trees, n, len(start)), "slot long, value long")
        got = np.zeros(parts * len(start) * (w + 1), np.int64)
        t = sums.groupBy("slot").agg(F.sum("value").alias("value")).toArrow()  # bounded: a number for each slot
        got[np.asarray(t["slot"])] = np.asarray(t["value"])
        got = got.reshape(parts, len(start), w + 1)
        used = got[:, :, w] > 0
        books[used] = got[:, :, :w][used] // got[:, :, w][used][:, None]  # // goes down
    return books


def _encode(trees, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = trees.value
        for batch in batches:
            for b in V.parts(batch):
                codes, error = assigned(V.matrix(b.column(2), n), own)
                text = [x.tobytes().hex() for x in codes.astype(np.uint8)]
                yield pa.record_batch([b.column(0), b.column(1), pa.array(text, pa.string()), pa.array(error)], ["id", "label", "code", "error"])

    return run


def vector_codes(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every row whose vector is there and finite.

    A component counts as floor(256 * x), a vector is cut into equal consecutive parts; one shorter
    than the longest ends in zeros, as do all where the parts don't divide their length. Codebooks
    start as the vectors of the smallest vec_ids (of a repeated vec_id the smaller vector first;
    rows without one come last), as many as there are where they are fewer than entries (at most
    256). Of entries equally near the lowest index is taken; one that no part takes stays. code has
    two hex digits for each part. Repeated rows have equal codes and count each. label_error sums
    the errors of all rows of the label, null being one. No row gives an empty result; extra
    columns are not carried. Components beyond some 2**27 count as the bound (vectors.limit).
    """
    kept = rows.select(F.col(vec_id).alias("id"), F.col(label).alias("label"), F.col(vector).alias("x")).where(V.finite("x"))
    kinds = dict(kept.dtypes)
    n = -(-max(1, V.width(kept, "x")) // parts) * parts
    first = kept.select("id", "x").orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).select("x").toArrow()  # bounded: entries rows
    start = V.matrix(first["x"], n)
    books = fit(kept, "x", start, parts, rounds) if len(start) else np.zeros((parts, 0, n // parts), np.int64)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    trees = kept.sparkSession.sparkContext.broadcast([Tree(b) for b in books] if len(start) else [])
    coded = durable(kept.select("id", "label", "x").mapInArrow(_encode(trees, n), f"id {kinds['id']}, label {kinds['label']}, code string, error long"))
    # a label may hold a third of all rows: its sum comes back by a join that has frequent labels in a broadcast
    keyed = coded.withColumn("_none", F.col("label").isNull()).withColumn("_label", F.coalesce("label", F.lit(0).cast(kinds["label"])))
    sums = keyed.groupBy("_none", "_label").agg(F.sum("error").alias("label_error"), F.count("*").alias("_c"))
    out = meet(keyed, sums, ["_none", "_label"], "_c")
    return out.select(F.col("id").alias(vec_id), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors of embeddings: 16 parts, 64 entries a part, 2 rounds."""
    return vector_codes(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """All distances of all parts in SQL, for vectors of 64 components."""
    w = range(4)
    distance = " + ".join(f"(p.x{j} - c.x{j}) * (p.x{j} - c.x{j})" for j in w)
    near = lambda book: f"SELECT p.row, p.part, min(struct_pack(d := {distance}, k := c.k)) AS m FROM p JOIN {book} c ON c.part = p.part GROUP BY p.row, p.part"
    mean = lambda book, near: f"SELECT c.part, c.k, {', '.join(f'coalesce(s.x{j}, c.x{j}) AS x{j}' for j in w)} FROM {book} c LEFT JOIN (SELECT p.part, a.m.k AS k, {', '.join(f'CAST(floor(sum(p.x{j}) / count(*)) AS BIGINT) AS x{j}' for j in w)} FROM p JOIN {near} a ON a.row = p.row AND a.part = p.part GROUP BY ALL) s ON s.part = c.part AND s.k = c.k"
    return f"""
WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id, embedding) AS row, vec_id, label, list_transform(embedding, lambda x: CAST(floor({V.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT row, part, {", ".join(f"v[part * 4 + {j + 1}] AS x{j}" for j in w)} FROM kept, (SELECT unnest(range({PARTS})) AS part)),
c0 AS MATERIALIZED (SELECT part, row - 1 AS k, {", ".join(f"x{j}" for j in w)} FROM p WHERE row <= {ENTRIES}),
a0 AS MATERIALIZED ({near("c0")}), c1 AS MATERIALIZED ({mean("c0", "a0")}),
a1 AS MATERIALIZED ({near("c1")}), c2 AS MATERIALIZED ({mean("c1", "a1")}),
a2 AS MATERIALIZED ({near("c2")}),
e AS (SELECT row, string_agg(format('{{:02x}}', m.k), '' ORDER BY part) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a2 GROUP BY row),
h AS (SELECT sha256(string_agg(concat_ws(',', {", ".join(f"x{j}" for j in w)}), ',' ORDER BY part, k)) AS h FROM c2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM kept JOIN e USING (row), h
"""


SQL = _sql()

"""Hard negatives by a kNN join over Voronoi cells of norm-augmented vectors.

With one more component, sqrt(M - |x|^2) for rows (M the largest squared norm) and 0 for anchors,
the squared distance of an anchor q and a row x is |q|^2 + M - 2qx: the nearest rows have the
highest inner products. Pivots (rows chosen by a hash of their ids) cut the space into cells. A row
keeps its cell and the distance from its pivot; an anchor knows its distance from every pivot. By
the triangle inequality

* the k-th smallest d(q, pivot) + d(pivot, row) over the cells' nearest rows of a label bounds the
  distance of q's k-th row of that label, and scores of the pivots themselves, being rows, bound
  the scores that still count in a band;
* a row can serve q only if |d(q, pivot) - d(pivot, row)| is within that bound.

Anchors are put to groups by their nearest centre. A cell has for each group the range of pivot
distances which may serve any of its anchors; rows are replicated only to groups that may need
them, and dealt with the group's anchors into tiles of bounded size, whatever a group's or a
label's share of the rows. A tile scores its anchors with its rows in whole numbers and keeps each
anchor's best; the best of its tiles are the result. Bounds hold with some slack for rounding, so
they decide what is moved, never what is returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import vectors as V
from .common import durable, table

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90
#: Pivots: a quarter of the root of the rows, within these bounds, and half as many anchors; groups: one for so many anchors, GROUPS at most.
PIVOTS, GROUPS, ANCHORS = (8, 512), 1024, 256
#: Rows and anchors of a tile at most, and cells of its matrix of scores that are made at once.
ROWS, MANY, CELLS = 8192, 4096, 1 << 22
#: Bounds of so many rows or fewer (some 40 bytes each) are broadcast.
BROADCAST = 1 << 18


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of a with those of b, exact; in floating point where that is exact."""
    if a.shape[1] * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def best(s: np.ndarray, ok: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k highest of each row of s where ok holds, the lower column first of equal ones."""
    out = [[], []]
    least = np.iinfo(np.int64).min
    held = np.where(ok, s, least)
    some = min(k, s.shape[1])
    if not some:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.partition(held, s.shape[1] - some, axis=1)[:, s.shape[1] - some]
    for i in np.flatnonzero(ok.any(1)).tolist():
        at = np.flatnonzero((held[i] >= edge[i]) & ok[i])
        at = at[np.argsort(-held[i, at], kind="stable")][:k]
        out[0] += [i] * len(at)
        out[1] += at.tolist()
    return np.array(out[0], np.int64), np.array(out[1], np.int64)


def distances(x: np.ndarray, extra: np.ndarray, y: np.ndarray, extra_y: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows of x, with one more component each, from those of y."""
    a, b = np.c_[x.astype(np.float64), extra], np.c_[y.astype(np.float64), extra_y]
    return np.sqrt(np.maximum(0, (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T))


class Space:
    """What tasks know of the whole: components, the largest squared norm, pivots and centres of groups."""

    def __init__(self, n: int, top: float, pivots: np.ndarray, labels: list, centres: np.ndarray):
        self.n, self.top, self.pivots, self.labels, self.centres = n, top, pivots, labels, centres
        self.slack = 1e-6 * (1 + np.sqrt(top))
        self.extra = self.augment(pivots)

    def augment(self, x: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(0, self.top - (x.astype(np.float64) ** 2).sum(1)))

    def from_pivots(self, x: np.ndarray, anchors: bool) -> np.ndarray:
        return distances(x, np.zeros(len(x)) if anchors else self.augment(x), self.pivots, self.extra)

    def group(self, x: np.ndarray) -> np.ndarray:
        zero = np.zeros(len(self.centres))
        return distances(x, np.zeros(len(x)), self.centres, zero).argmin(1)

    def reach(self, x: np.ndarray, score: np.ndarray) -> np.ndarray:
        """The distance at which a row has a score with each anchor of x (null scores: without end)."""
        q = (x.astype(np.float64) ** 2).sum(1)
        return np.where(np.isnan(score), np.inf, np.sqrt(np.maximum(0, q + self.top - 2 * np.nan_to_num(score)))) + self.slack


def _norms(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        top = 0.0
        for b in batches:
            x = V.matrix(b.column(0), n).astype(np.float64)
            top = max(top, (x * x).sum(1).max(initial=0))
        yield pa.record_batch([pa.array([top])], ["top"])

    return run


def _cells(space):
    """(id, label, anchor, cell, d, group, v): each row's cell and distance from its pivot, and an anchor's group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = space.value
        for batch in batches:
            for b in V.parts(batch):
                x = V.matrix(b.column(3), s.n)
                far = s.from_pivots(x, False)
                cell, group, own = far.argmin(1), np.full(len(x), -1), np.asarray(b.column(2))
                if own.any():
                    group[own] = s.group(x[own])
                v = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * s.n), pa.array(x.ravel()))
                yield pa.record_batch([b.column(0), b.column(1), b.column(2), pa.array(cell), pa.array(far[np.arange(len(x)), cell]), pa.array(group), v], ["id", "label", "anchor", "cell", "d", "group", "v"])

    return run


def _label_reach(space, k: int):
    """For anchors of a label and the cells' nearest rows of that label: the distance within which each anchor has k of them.

    One more is asked for, as the anchor itself is one of them.
    """

    def run(left: Iterator[pa.RecordBatch], right: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = space.value
        near = [(np.asarray(b.column("cell")), np.asarray(b.column("d"))) for b in right]
        cell, d = (np.concatenate([x[j] for x in near]) if near else np.zeros(0, np.int64) for j in range(2))
        for b in left:
            x = _whole(b.column("v"), s.n)
            reach = np.full(len(x), np.inf)
            if len(cell) > k:
                all_ = s.from_pivots(x, True)[:, cell] + d
                reach = np.partition(all_, k, axis=1)[:, k] + s.slack
            yield pa.record_batch([b.column("id"), b.column("label"), b.column("group"), b.column("v"), pa.array(reach)], ["id", "label", "group", "v", "reach"])

    return run


def _whole(col: pa.Array | pa.ChunkedArray, n: int) -> np.ndarray:
    """The matrix of a column of whole-number vectors of n components."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return np.asarray(col.flatten(), np.int64).reshape(len(col), n)


def _ranges(space, by_label: bool):
    """(key..., cell, low, high): the pivot distances at which a row of the cell may serve an anchor of the group, over a task's anchors.

    Columns: id, label, group, v, reach, and floor, the least distance that counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = space.value
        for batch in batches:
            for b in V.parts(batch):
                x, reach, floor = _whole(b.column("v"), s.n), np.asarray(b.column("reach")), np.asarray(b.column("floor"))
                far = s.from_pivots(x, True)
                low, high = np.maximum(far - reach[:, None], floor[:, None] - far), far + reach[:, None]
                label = b.column("label") if by_label else pa.nulls(len(x), b.schema.field("label").type)
                keys = pa.table({"label": label, "group": b.column("group")})
                kinds = keys.group_by(["label", "group"]).aggregate([])
                code = {(a, g): k for k, (a, g) in enumerate(zip(kinds["label"].to_pylist(), kinds["group"].to_pylist(), strict=True))}
                own = np.array([code[x] for x in zip(label.to_pylist(), b.column("group").to_pylist(), strict=True)], np.int64)
                shape = (len(code), len(s.pivots))
                least, most = np.full(shape, np.inf), np.full(shape, -np.inf)
                np.minimum.at(least, own, low)
                np.maximum.at(most, own, high)
                at = np.repeat(np.arange(shape[0]), shape[1])
                yield pa.record_batch([kinds["label"].combine_chunks().take(pa.array(at)), kinds["group"].combine_chunks().take(pa.array(at)), pa.array(np.tile(np.arange(shape[1]), shape[0])), pa.array(least.ravel()), pa.array(most.ravel())], ["label", "group", "cell", "low", "high"])

    return run


def _dealt(rows: DataFrame, anchors: DataFrame, ranges: DataFrame, by_label: bool) -> tuple[DataFrame, DataFrame]:
    """Anchors and the rows that may serve them, by tiles (x, y) of their group: blocks of bounded size of either, all of which meet."""
    keys = ["label", "group"] if by_label else ["group"]
    at = [*keys[:-1], "cell"]
    bounds = durable(ranges.groupBy(*keys, "cell").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low <= high"))
    few = bounds.count() <= BROADCAST
    bounds = F.broadcast(bounds) if few else bounds
    slim = rows.select("id", "label", "cell", "d")
    served = lambda df: df.join(bounds, at).where("d between low and high").drop("low", "high")
    n = served(slim).groupBy(*keys).agg(F.count("*").alias("n"))
    m = anchors.groupBy(*keys).agg(F.count("*").alias("m"))
    sizes = durable(n.join(m, keys).select(*keys, F.ceil(F.col("n") / ROWS).cast("int").alias("r"), F.ceil(F.col("m") / MANY).cast("int").alias("a")))
    sizes = F.broadcast(sizes) if few else sizes
    block = lambda k: F.pmod(F.xxhash64("id", F.lit(23)), F.col(k)).cast("int")
    every = lambda k: F.explode(F.sequence(F.lit(0), F.col(k) - 1))
    left = anchors.join(sizes, keys).withColumn("y", block("a")).withColumn("x", every("r")).select(*keys, "x", "y", *(c for c in anchors.columns if c not in keys))
    right = served(rows.drop("group", "anchor")).join(sizes, keys).withColumn("x", block("r")).withColumn("y", every("a")).select(*keys, "x", "y", *(c for c in ("id", "label", "v") if c not in keys))
    return left, right


def _gathered(batches: Iterator[pa.RecordBatch], names: list[str], n: int) -> tuple[dict[str, np.ndarray], np.ndarray]:
    own = list(batches)
    if not own:
        return {c: np.zeros(0, np.int64) for c in names}, np.zeros((0, n), np.int64)
    t = pa.Table.from_batches(own)
    return {c: np.asarray(t[c]) for c in names}, _whole(t["v"], n)


def _positives(n: int, k: int):
    def run(left: Iterator[pa.RecordBatch], right: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, x = _gathered(left, ["id"], n)
        b, y = _gathered(right, ["id"], n)
        order = np.argsort(b["id"], kind="stable")
        b, y = b["id"][order], y[order]
        for i in range(0, len(x), step := max(1, CELLS // max(1, len(y)))):
            s = scores(x[i : i + step], y)
            r, c = best(s, a["id"][i : i + step, None] != b[None, :], k)
            yield pa.record_batch([pa.array(a["id"][i : i + step][r]), pa.array(b[c]), pa.array(s[r, c])], ["anchor", "row", "score"])

    return run


def _negatives(n: int, k: int, low: int, high: int):
    """Columns of the left side: id, label, v, positives: their scores. A band is within [low, high] percent of one of them."""

    def run(left: Iterator[pa.RecordBatch], right: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(left)
        positives = pa.Table.from_batches(held)["positives"].to_pylist() if held else []
        a, x = _gathered(iter(held), ["id", "label"], n)
        b, y = _gathered(right, ["id", "label"], n)
        order = np.argsort(b["id"], kind="stable")
        own, label, y = b["id"][order], b["label"][order], y[order]
        for i in range(0, len(x), step := max(1, CELLS // max(1, len(y)))):
            s = scores(x[i : i + step], y)
            other = a["label"][i : i + step, None] != label[None, :]
            of = positives[i : i + step]
            for p in range(max(map(len, of), default=0)):
                floor = np.array([-(-low * z[p] // 100) if p < len(z) else 1 for z in of])
                roof = np.array([high * z[p] // 100 if p < len(z) else 0 for z in of])
                r, c = best(s, other & (s >= floor[:, None]) & (s <= roof[:, None]), k)
                yield pa.record_batch([pa.array(a["id"][i : i + step][r]), pa.array(np.full(len(r), p, np.int32)), pa.array(own[c]), pa.array(s[r, c])], ["anchor", "place", "row", "score"])

    return run


def _bands(space, k: int, low: int, high: int):
    """Adds reach and floor, the distances between which a row may be among the k of one of an anchor's bands.

    The pivots are rows: where k of them of other labels are in a band, the k-th score bounds it from below.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = space.value
        labels = np.array(s.labels)
        for b in batches:
            x, label = _whole(b.column("v"), s.n), b.column("label").to_pylist()
            got = scores(x, s.pivots)
            least, most = np.full(len(x), np.nan), np.full(len(x), np.nan)
            for i, own in enumerate(b.column("positives").to_pylist()):
                bands = [(-(-low * p // 100), high * p // 100) for p in own if p >= 0]
                if not bands:
                    continue
                z = np.sort(got[i][labels != label[i]])[::-1]
                ends = []
                for lo, hi in bands:
                    inside = z[(z <= hi) & (z >= lo)]
                    ends.append(int(inside[k - 1]) if len(inside) >= k else lo)
                least[i], most[i] = min(ends), max(hi for _, hi in bands)
            some = ~np.isnan(most)
            floor = s.reach(x, most) - 2 * s.slack
            out = pa.record_batch([*b.columns, pa.array(s.reach(x, least)), pa.array(floor)], [*b.schema.names, "reach", "floor"])
            yield out.filter(pa.array(some))

    return run


def hard_negatives(rows: DataFrame, is_anchor: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, pivots: tuple[int, int] = PIVOTS, per_group: int = ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), ranks from 1 by anchor and positive.

    An anchor's positives are the rows of its label, but itself, of the highest inner products; the
    negatives of a pair are the rows of another label of the highest products within [low, high]
    percent of the positive's, in either case the smaller id first of equal ones. A component counts
    as floor(256 * x); shorter vectors end in zeros; one beyond some 2**27 counts as that. Rows with
    a null id, label, vector or component, or one that is not finite, take no part; of rows of one
    id the one of the smallest (label, vector) counts. An anchor alone in its label, a positive of a
    negative score and a pair without a row in its band give no row; an empty table gives an empty
    result. Other columns are not carried.
    """
    raw = rows.select(F.col(vec_id).cast("long").alias("id"), F.col(label).alias("label"), is_anchor.alias("anchor"), F.col(vector).alias("x")).where(V.finite("x")).where("id is not null and label is not null")
    kind, xkind = dict(raw.dtypes)["label"], dict(raw.dtypes)["x"]
    kept = durable(raw.groupBy("id").agg(F.min(F.struct("label", "x", F.coalesce("anchor", F.lit(False)).alias("anchor"))).alias("r")).select("id", "r.label", "r.anchor", F.col("r.x").cast(xkind).alias("x")))
    n = max(1, V.width(kept, "x"))
    top = kept.select("x").mapInArrow(_norms(n), "top double").agg(F.max("top")).first()[0] or 0.0
    count, anchors = kept.agg(F.count("*"), F.count_if("anchor")).first()
    sample = lambda df, m: df.orderBy(F.xxhash64("id", F.lit(29)), "id").limit(m)  # noqa: E731  bounded: m rows
    p = min(pivots[1], max(pivots[0], int(count**0.5 / 4)))
    # a part of the pivots are anchors, so that regions where few rows but anchors lie have one; none is there twice
    chosen = sample(kept, p).union(sample(kept.where("anchor"), p // 2)).select("id", "label", "x").dropDuplicates(["id"]).orderBy("id").toArrow()
    centres = sample(kept.where("anchor"), min(GROUPS, max(1, -(-anchors // per_group)))).select("x").toArrow()
    space = kept.sparkSession.sparkContext.broadcast(Space(n, top, V.matrix(chosen["x"], n), chosen["label"].to_pylist(), V.matrix(centres["x"], n)))
    schema = f"id long, label {kind}, anchor boolean, cell long, d double, group long, v array<long>"
    empty = not anchors
    celled = durable((kept.limit(0) if empty else kept).select("id", "label", "anchor", "x").mapInArrow(_cells(space), schema))
    own = celled.where("anchor").select("id", "label", "group", "v")

    # the nearest rows of each cell by label; a label's anchors meet them in blocks
    nearest = celled.withColumn("_r", F.row_number().over(Window.partitionBy("label", "cell").orderBy("d", "id"))).where(F.col("_r") <= positives + 1).select("label", "cell", "d")
    blocks = durable(own.groupBy("label").agg(F.ceil(F.count("*") / MANY).cast("int").alias("blocks")))
    left = own.join(blocks, "label").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).drop("blocks")
    right = nearest.join(blocks, "label").select("label", "cell", "d", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    # toDF: both sides come from one table, whose columns must not be taken for each other
    pair = lambda a, b, f, kinds, *keys: a.toDF(*a.columns).groupBy(*keys).cogroup(b.toDF(*b.columns).groupBy(*keys)).applyInArrow(_tabled(f, kinds), kinds)
    near = durable(pair(left, right, _label_reach(space, positives), f"id long, label {kind}, group long, v array<long>, reach double", "label", "block"))

    kinds = f"label {kind}, group long, cell long, low double, high double"
    a, b = _dealt(celled, near.drop("reach"), near.withColumn("floor", F.lit(float("-inf"))).mapInArrow(_ranges(space, True), kinds), True)
    met = pair(a, b, _positives(n, positives), "anchor long, row long, score long", "label", "group", "x", "y")
    rank = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("score"), "row")).cast("int")
    first = durable(met.withColumn("rank", rank("anchor")).where(F.col("rank") <= positives))

    of = first.groupBy(F.col("anchor").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda z: z["score"]).alias("positives"))
    banded = durable(own.join(of, "id").select("id", "label", "group", "v", "positives").mapInArrow(_bands(space, negatives, low, high), f"id long, label {kind}, group long, v array<long>, positives array<long>, reach double, floor double"))
    a, b = _dealt(celled, banded.drop("reach", "floor"), banded.drop("positives").mapInArrow(_ranges(space, False), kinds), False)
    met = pair(a, b, _negatives(n, negatives, low, high), "anchor long, place int, row long, score long", "group", "x", "y")
    mined = met.withColumn("rank", rank("anchor", "place")).where(F.col("rank") <= negatives)
    positive = first.select("anchor", (F.col("rank") - 1).alias("place"), F.col("row").alias("positive_id"), F.col("score").alias("positive_score"))
    out = mined.join(positive, ["anchor", "place"])
    return out.select(F.col("anchor").alias("anchor_id"), "positive_id", "rank", F.col("row").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _tabled(f, kinds: str):
    """f, which takes and yields iterators of batches, as a function of two tables; without rows on either side it gives none."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(kinds))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        got = list(f(iter(left.to_batches()), iter(right.to_batches()))) if left.num_rows else []
        return pa.Table.from_batches(got).cast(schema) if got else schema.empty_table()

    return run


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector among all; every seventh label is another one first."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"))
    return hard_negatives(e, F.col("vec_id") % 100 == 0)


#: Every anchor with every row.
SQL = f"""
WITH e AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor({V.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS s FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT a, b, s FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= {POSITIVES}),
n AS (SELECT p.a, p.b AS p, s.b AS n, p.s AS ps, s.s AS ns, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.s DESC, s.b) AS r FROM p JOIN s ON s.a = p.a AND NOT s.same AND {LOW} * p.s <= 100 * s.s AND 100 * s.s <= {HIGH} * p.s)
SELECT a AS anchor_id, p AS positive_id, CAST(r AS INTEGER) AS rank, n AS negative_id, ps AS positive_score, ns AS negative_score FROM n WHERE r <= {NEGATIVES}
"""

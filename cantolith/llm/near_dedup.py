"""MinHash near-duplicates with tensored banding, candidates verified on full shingle sets.

Two collections of TABLES sub-signatures of WIDTH minhashes each are computed; every pair of one
from each collection is a table key, so 2*TABLES*WIDTH minhashes serve TABLES**2 tables of
2*WIDTH minhashes, about the square root of what separate tables would take. A pair of
similarity s shares a key with probability (1 - (1 - s**WIDTH)**TABLES)**2: at 0.75 it misses
2e-5, at 0.8 1e-6.

Copies (equal shingle sets) are first merged into one class by digest. Classes that share a table
key, directly or through others, are a family. The full sets of a family meet in one task, those
of a larger one in blocks of which any two that can hold a link meet, and a task gives a spanning
forest of the links among its sets: every pair of a family is verified, none is written, and
each candidate's set is shuffled once for each task. Compared with each other are the sets of a
family alone, at some nanoseconds a pair (products of matrices over the shingles they share).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel as K
from .bloom import probe
from .common import durable, in_batches, meet, number, numbered, pieces, table, utf8
from .graph import components

SHINGLE, TABLES, WIDTH = 5, 14, 2
PERCENT = 75
#: Blocks of 64 bytes of the Bloom filter that keeps texts without candidates from being shuffled.
BLOCKS = 1 << 16
#: Texts and hashes of a block: what a task compares with each other, or with another block.
BLOCK, HASHES = 4096, 4 << 20


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each document and their n+1 offsets."""
    starts, ends, bounds = K.words(data, offsets)
    s, sb = K.windows(K.word_hashes(data, starts, ends), bounds, SHINGLE)
    for i, j in zip(sb[:-1], sb[1:], strict=True):
        s[i:j].sort()
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    new[sb[:-1][sb[:-1] < sb[1:]]] = True
    return s[new], np.r_[0, np.cumsum(new)][sb]


def signatures(s: np.ndarray, bounds: np.ndarray, tables: int, width: int) -> np.ndarray:
    """2*tables sub-signatures of each non-empty document's set, as rows."""
    starts = bounds[:-1][bounds[:-1] < bounds[1:]]
    flip, by = K.seeds(2 * tables * width, 11), K.seeds(2 * tables * width, 12) | np.uint64(1)
    out = np.empty((len(starts), 2 * tables), np.uint64)
    for t in range(2 * tables):
        h = np.full(len(starts), t, np.uint64)
        for f in range(t * width, t * width + width):
            h = K.mix(h + np.minimum.reduceat((s ^ flip[f]) * by[f], starts))
        out[:, t] = h
    return out


def _sign(batches: Iterator[pa.RecordBatch], tables: int, width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for i, j in pieces(offsets):
            s, b = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            n = np.diff(b)
            some = n > 0
            sig = np.zeros((j - i, 2 * tables), np.uint64)
            d = np.zeros((2, j - i), np.uint64)
            if some.any():
                sig[some] = signatures(s, b, tables, width)
                at = b[:-1][some]
                for k in range(2):
                    d[k, some] = np.add.reduceat(K.mix(s ^ K.seeds(2, 13)[k]), at)
            flat = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * 2 * tables), pa.array(sig.view(np.int64).ravel()))
            yield pa.record_batch([batch.column(0).slice(i, j - i), pa.array(n.astype(np.int64)), pa.array(d[0].view(np.int64)), pa.array(d[1].view(np.int64)), flat], ["id", "n", "d1", "d2", "sig"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, s): the sorted shingle hashes of each text, once for equal rows of a partition; columns: id, text."""
    seen = set()
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for i, j in pieces(offsets):
            s, b = shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            out = pa.record_batch([batch.column(0).slice(i, j - i), pa.LargeListArray.from_arrays(pa.array(b), pa.array(s.view(np.int64))).cast(pa.list_(pa.int64()))], ["id", "s"])
            yield out.filter(pa.array(unseen(out.column(0).to_pylist(), s, b, seen), pa.bool_()))


def unseen(ids: list, s: np.ndarray, bounds: np.ndarray, seen: set) -> list[bool]:
    """Whether an id and set are not in seen, to which they are added."""
    out = []
    for i, x in zip(ids, np.split(s, bounds[1:-1]), strict=True):
        key = (i, len(x), int(K.mix(x).sum(dtype=np.uint64)))
        out.append(key not in seen)
        seen.add(key)
    return out


def sets_of(ids: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, s) of the texts of ids(id); only texts that a Bloom filter of bounded size takes for one of them are shuffled."""
    kind = dict(texts.dtypes)["id"]
    some = probe(texts, "id", ids.withColumnRenamed("id", "i"), "i", BLOCKS, "_in").where("_in").select("id", "text")
    return in_batches(some, _sets, f"id {kind}, s array<long>").join(ids, "id", "left_semi")


def overlaps(bounds: np.ndarray, s: np.ndarray, cut: int) -> np.ndarray:
    """Sizes of the intersections of the first cut sets (rows) with the others (columns); cut 0: of all with all.

    Hashes that the same sets hold are one column with a weight. Columns of few sets are counted
    pair by pair, the others as a product of matrices.
    """
    m = len(bounds) - 1
    _, column, count = np.unique(s, return_inverse=True, return_counts=True)
    doc = np.repeat(np.arange(m), np.diff(bounds))
    pattern = np.zeros(len(count), np.uint64)
    np.add.at(pattern, column, K.seeds(m, 14)[doc])
    _, first, kind, weight = np.unique(pattern, return_index=True, return_inverse=True, return_counts=True)
    number = count[first]
    chosen = np.zeros(len(count), bool)
    chosen[first[number > 1]] = True
    keep = chosen[column]
    doc, kind = doc[keep], kind[column[keep]]
    order = np.argsort(kind, kind="stable")
    doc, kind = doc[order], kind[order]
    edge = np.flatnonzero(np.r_[True, kind[1:] != kind[:-1]]) if len(kind) else np.zeros(0, np.int64)
    size, kind = np.diff(np.r_[edge, len(kind)]), kind[edge] if len(kind) else kind
    rows, first_column = (cut, cut) if cut else (m, 0)
    out = np.zeros((rows, m - first_column), np.float32 if np.diff(bounds).max(initial=0) < 1 << 24 else np.float64)
    few = max(2, int((m / 64) ** 0.5) * 8)
    for c in np.unique(size[size <= few]).tolist():
        x, y = np.triu_indices(c, 1)
        at = np.flatnonzero(size == c)
        for k in range(0, len(at), step := max(1, (1 << 20) // len(x))):
            part = at[k : k + step]
            members = doc[edge[part][:, None] + np.arange(c)]
            a, b, w = members[:, x].ravel(), members[:, y].ravel(), np.repeat(weight[kind[part]], len(x))
            if cut:
                ok = (a < cut) & (b >= cut)
                a, b, w = a[ok], b[ok] - cut, w[ok]
            np.add.at(out.ravel(), a * out.shape[1] + b, w)
    if not cut:
        out += out.T
    many = np.flatnonzero(size > few)
    for k in range(0, len(many), 2048):
        part = many[k : k + 2048]
        n = size[part]
        spot = np.repeat(edge[part] - np.r_[0, np.cumsum(n)][:-1], n) + np.arange(n.sum())
        x = np.zeros((m, len(part)), np.float32)
        x[doc[spot], np.repeat(np.arange(len(part)), n)] = 1
        out += ((x[:rows] * weight[kind[part]].astype(np.float32)) @ x[first_column:].T).astype(out.dtype)
    return out


def forest(linked: np.ndarray, cut: int) -> list[tuple[int, int]]:
    """A spanning forest of the links overlaps() is shaped for, as pairs of indices."""
    rows, columns = linked.shape
    left = np.ones(cut + columns, bool) if cut else np.ones(rows, bool)
    out = []
    for root in range(rows):
        if not left[root]:
            continue
        left[root], todo = False, [root]
        while todo:
            i = todo.pop()
            near = linked[i] if not cut or i < cut else linked[:, i - cut]
            shift = cut if i < cut else 0
            new = np.flatnonzero(near & left[shift : shift + len(near)]) + shift
            left[new] = False
            out += [(i, x) for x in new.tolist()]
            todo += new.tolist()
    return out


def links_among(sides: np.ndarray, bounds: np.ndarray, s: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that hold together the sets of a task as all its links do: those of side 0 with those of side 1, or all where there is one side."""
    order = np.argsort(sides, kind="stable")
    n = np.diff(bounds)[order]
    s = np.concatenate([s[bounds[k] : bounds[k + 1]] for k in order.tolist()])
    cut = int((sides == 0).sum()) % len(sides)
    both = overlaps(np.r_[0, np.cumsum(n)], s, cut)
    rows, columns = (n[:cut], n[cut:]) if cut else (n, n)
    linked = np.empty(both.shape, bool)
    for k in range(0, len(both), 256):  # in whole numbers, some rows at a time
        part = both[k : k + 256].astype(np.int64)
        linked[k : k + 256] = 100 * part >= percent * (rows[k : k + 256, None] + columns[None, :] - part)
    del both
    return [(int(order[a]), int(order[b])) for a, b in forest(linked, cut)]


def _linked(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """(a, b) of the links of each task; rows (task, side, id, s) stand task by task."""
    held: list[pa.RecordBatch] = []
    seen: set = set()

    def hashes(lists):
        offsets = np.asarray(lists.offsets).astype(np.int64)
        return offsets - offsets[0], np.asarray(lists.flatten()).view(np.uint64)

    def done():
        t = pa.Table.from_batches(held).combine_chunks()
        held.clear()
        seen.clear()
        lists = t["s"].chunk(0)
        found = links_among(np.asarray(t["side"]), *hashes(lists), percent)
        a, b = (t["id"].take(pa.array([x[k] for x in found], pa.int64())).combine_chunks() for k in range(2))
        return pa.record_batch([x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in (a, b)], ["a", "b"]) if found else None

    for batch in batches:
        task = np.asarray(batch.column(0))
        for i, j in zip((edge := np.r_[0, np.flatnonzero(task[1:] != task[:-1]) + 1, len(task)])[:-1].tolist(), edge[1:].tolist(), strict=True):
            if i == j:
                continue
            if held and held[-1].column(0)[-1].as_py() != task[i] and (out := done()):
                yield out
            part = batch.slice(i, j - i)
            bounds, s = hashes(part.column(3))
            held.append(part.filter(pa.array(unseen(list(zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)), s, bounds, seen), pa.bool_())))
    if held and (out := done()):
        yield out


def stars(keys: DataFrame) -> DataFrame:
    """(a, b): each key's smallest member with its others."""
    first = keys.groupBy("key").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a < z").select("key", "a")
    return keys.join(first, "key").where("rep <> a").select("a", F.col("rep").alias("b")).distinct()


def families(keys: DataFrame, texts: DataFrame, percent: int, block: int) -> DataFrame:
    """(node, component): the texts that share a table key, directly or through others.

    A family of more than a block loses, as often as it has any, the texts of which too many
    shingles are in no other text of it: they can't be linked, and hold together what has only a
    passage in common.
    """
    found = durable(components(stars(keys)))
    while True:
        large = meet(found, found.groupBy("component").agg(F.count("*").alias("m")), ["component"], "m").where(F.col("m") > block).select("component", "node")
        if large.isEmpty():
            return found
        large = durable(large)
        held = sets_of(large.select(F.col("node").alias("id")), texts).join(large, F.col("id") == F.col("node")).select("component", "id", F.size("s").alias("n"), F.explode("s").alias("s"))
        alone = held.groupBy("component", "s").agg(F.count("*").alias("c"), F.min("id").alias("id"), F.min("n").alias("n")).where("c = 1")
        # an id with several texts may have its shingles counted twice, and stays
        once = sets_of(large.select(F.col("node").alias("id")), texts).groupBy("id").agg(F.count("*").alias("k")).where("k = 1").select("id")
        gone = durable(alone.groupBy("id", "n").agg(F.count("*").alias("u")).where(100 * (F.col("n") - F.col("u")) < percent * F.col("n")).join(once, "id", "left_semi").select(F.col("id").alias("node")))
        if gone.isEmpty():
            return found
        rest = large.join(gone, "node", "left_anti").select(F.col("node").alias("rep"))
        again = components(stars(keys.join(rest, "rep", "left_semi")))
        found = durable(found.join(large.select("node"), "node", "left_anti").unionByName(again))


def tasks(found: DataFrame, sizes: DataFrame, percent: int, block: int, most: int) -> DataFrame:
    """(task, side, id): each family in one task, or in blocks of which any two that can hold a link meet.

    A family of over block texts or most hashes is dealt by classes of size (linked sets are in
    one class or in two neighbouring ones) and then by chance into blocks.
    """
    one = found.join(sizes, F.col("node") == F.col("rep")).select("node", "component", "n")
    ratio = float(np.log(100 / percent))
    one = one.withColumn("size", F.floor(F.log("n") / ratio).cast("int"))
    total = one.groupBy("component", "size").agg(F.count("*").alias("m"), F.sum("n").alias("h"))
    per = total.groupBy("component").agg(F.sum("m").alias("m"), F.sum("h").alias("h"), F.map_from_entries(F.collect_list(F.struct("size", F.greatest(F.ceil(F.col("m") / block), F.ceil(F.col("h") / most)).cast("int").alias("k")))).alias("blocks")).withColumn("whole", (F.col("m") <= block) & (F.col("h") <= most)).select("component", "m", "whole", "blocks")
    own = meet(one, per, ["component"], "m")
    count = lambda c: F.coalesce(F.element_at("blocks", c), F.lit(0))
    mine = F.pmod(F.xxhash64("node", F.lit(19)), count(F.col("size"))).cast("int")
    side = lambda a, i, b, j, k: F.struct(F.xxhash64("component", a, i, b, j).alias("task"), F.lit(k).alias("side"))
    up = lambda to: F.when(to > 0, F.sequence(F.lit(0), to - 1)).otherwise(F.array().cast("array<int>"))
    size, k = F.col("size"), F.col("k")
    each = F.concat(
        F.transform(up(count(size)), lambda j: F.when(j >= k, side(size, k, size, j, 0)).otherwise(side(size, j, size, k, 1))),
        F.transform(up(count(size + 1)), lambda j: side(size, k, size + 1, j, 0)),
        F.transform(up(count(size - 1)), lambda j: side(size - 1, j, size, k, 1)),
    )
    whole = F.array(F.struct(F.xxhash64("component").alias("task"), F.lit(0).alias("side")))
    return own.withColumn("k", mine).select("node", F.explode(F.when(F.col("whole"), whole).otherwise(each)).alias("t")).select("t.task", "t.side", F.col("node").alias("id"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tables: int = TABLES, width: int = WIDTH, percent: int = PERCENT, block: int = BLOCK, most: int = HASHES) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of docs.

    Words are runs of other bytes than white space, A-Z lower-cased; the set is the distinct
    5-word shingles, or the whole sequence of a shorter text. Null and empty texts have an empty
    set and are linked with nothing. Rows of one doc_id with words are one document: they are
    linked; repeated rows have equal results. A row
    without doc_id can't be named by a link; its component_id is null and it is kept. An empty
    table gives an empty result; other columns are not carried.
    """
    raw = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    kind = dict(raw.dtypes)["id"]
    sig = durable(in_batches(raw, lambda it: _sign(it, tables, width), f"id {kind}, n long, d1 long, d2 long, sig array<long>"))
    live = sig.where("n > 0 and id is not null")
    same = ["d1", "d2", "n"]
    classes = durable(live.groupBy(*same).agg(F.min(F.struct("id", "sig")).alias("m"), F.count("*").alias("c")).select(*same, F.col("m.id").alias("rep"), F.col("m.sig").alias("sig"), "c"))

    parts = classes.select("rep", "n", F.posexplode("sig").alias("t", "key"))
    shared = parts.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
    mine = parts.join(shared, "key", "left_semi").groupBy("rep", "n").agg(*(F.collect_set(F.when(c, F.col("key"))).alias(x) for x, c in (("x", F.col("t") < tables), ("y", F.col("t") >= tables))))
    keys = durable(mine.select("rep", "n", F.explode("x").alias("x"), "y").select("rep", "n", "x", F.explode("y").alias("y")).select("rep", F.xxhash64("x", "y").alias("key")).distinct())

    texts = raw.where("id is not null")
    found = families(keys, texts, percent, block)
    sizes = classes.groupBy("rep").agg(F.max("n").alias("n"))
    dealt = durable(tasks(found, sizes, percent, block, most))
    rows = dealt.join(sets_of(dealt.select("id").distinct(), texts), "id").select("task", "side", "id", "s")
    links = in_batches(rows.repartition("task").sortWithinPartitions("task"), lambda it: _linked(it, percent), f"a {kind}, b {kind}")

    # copies of a text meet their class, those of the most frequent texts in a broadcast
    one = durable(meet(live.select("id", *same), classes.where("c > 1").select(*same, "rep", "c"), same, "c").select("id", *same, F.coalesce("rep", "id").alias("rep")))
    several = one.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a < z").select("id", "a")
    links = links.union(one.join(several, "id").select("a", F.col("rep").alias("b"))).union(several.select("a", F.col("id").alias("b")))
    joined = components(links)
    copies = classes.groupBy("rep").agg(F.sum("c").alias("c"))
    held = joined.join(copies, F.col("node") == F.col("rep"), "left").select(F.col("node").alias("rep"), "component", F.coalesce("c", F.lit(1)).alias("c"))
    named = meet(one.select("id", "n", "rep"), held, ["rep"], "c").select("id", "n", F.coalesce("component", "rep").alias("component"))
    rest = sig.where("not (n > 0 and id is not null)").select("id", "n", F.col("id").alias("component"))
    return named.unionByName(rest).select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), (F.col("id").isNull() | (F.col("id") == F.col("component"))).alias("kept"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without the rows that near_duplicates does not keep; rows of one doc_id stay or go together.

    Rows without doc_id, null and empty texts stay; of tied copies the smallest doc_id stays; an
    empty table gives an empty result; all columns are carried, whatever their names.
    """
    d, i = numbered(docs), number(docs, doc_id)
    gone = near_duplicates(d, i, number(docs, text)).where("not kept").select(F.col(i).alias("_gone")).distinct()
    return d.join(gone, d[i] == gone["_gone"], "left_anti").toDF(*docs.columns)


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicates over all documents."""
    return near_duplicates(table(spark, sf_dir, "documents"))

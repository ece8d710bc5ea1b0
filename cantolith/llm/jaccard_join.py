"""N-gram Jaccard self-join with adaptive multi-match prefixes.

The shingles of every document stand in one order of the whole corpus, rare ones first. Two sets
that link share at least c = ceil(percent * n / 100) shingles of either, n its size; so for every l
the first n - c + l shingles of both share l at least. A document takes the l whose estimated cost
is least: the postings that its prefix meets, and for each l-th part of them a verification. Texts
with frequent shingles in a short prefix so get a longer prefix, and as many more shared shingles are
required of their pairs (the lesser l of the two) before the whole sets are compared.

What keeps the shuffles small: a global order need not look at every shingle. Those with the lowest
SHARE of hashes come first, by their counts over all documents, the others after them by hash; a
document writes the former and of the latter only what its shortest prefix needs. Shingles counted
once match nothing and are never joined; they only take up places in the prefix.

Equal sets are one class first. Documents that share a shingle of their shortest prefixes (l = 1), directly
or through others, are a family; its members meet in tasks of bounded size (a large family in blocks of which any two
that can hold a link meet), where shared prefix shingles are counted, pairs that reach their l are
verified on the whole sets, and a spanning forest of the links is written: no list of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel as K
from .base import components_sql
from .bloom import digest_filter, may_hold, probe
from .common import durable, in_batches, meet, pieces, table, utf8
from .graph import components
from .near_dedup import BLOCK, BLOCKS, HASHES, forest, overlaps, stars, tasks

SHINGLE, PERCENT = 4, 85
#: The share of hashes whose shingles are ordered by count, before all others.
SHARE = 0.4
#: Prefixes that are weighed, by the number of shingles that a pair must share; the cost of a verification, by shingles of a set.
MATCHES, VERIFY = (1, 2, 4, 8, 16, 32, 64), 1 / 16


def sets(data: np.ndarray, offsets: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text and their n+1 offsets."""
    starts, ends, bounds = K.words(data, offsets)
    s, sb = K.windows(K.word_hashes(data, starts, ends), bounds, shingle, 5)
    doc = np.repeat(np.arange(len(sb) - 1), np.diff(sb))
    order = np.lexsort((s, doc))
    s = s[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (doc[1:] != doc[:-1])
    return s[new], np.r_[0, np.cumsum(new)][sb]


def needed(n: np.ndarray, percent: int) -> np.ndarray:
    """How many shingles of a set of n a linked one shares at least."""
    return -(-percent * n // 100)


def _each(batches: Iterator[pa.RecordBatch], shingle: int):
    """Pieces of the batches: (ids, hashes, offsets, sizes, digests)."""
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for i, j in pieces(offsets):
            s, b = sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], shingle)
            n = np.diff(b)
            d = np.zeros((2, j - i), np.uint64)
            for k in range(2):
                d[k, n > 0] = np.add.reduceat(K.mix(s ^ K.seeds(2, 15)[k]), b[:-1][n > 0]) if len(s) else 0
            yield batch.column(0).slice(i, j - i), s, b, n, d


def class_of(d: np.ndarray) -> np.ndarray:
    """What equal sets have in common, as one number."""
    return K.mix(d[0]) + d[1]


def _digests(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, _, n, d in _each(batches, shingle):
            yield pa.record_batch([ids, pa.array(n), *(pa.array(x.view(np.int64)) for x in (*d, class_of(d)))], ["id", "n", "d1", "d2", "class"])

    return run


def edge_of(share: float) -> int:
    """The least hash that is not ordered by count."""
    return min(int(share * 2**64), (1 << 64) - 1)


def thin(s: np.ndarray, bounds: np.ndarray, percent: int, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Which of the sorted hashes a text writes, and how many of each text are under share.

    All under share; where they are fewer than the shortest prefix, the next ones by hash as well.
    """
    n = np.diff(bounds)
    low = np.add.reduceat(np.r_[s < np.uint64(edge_of(share)), False].astype(np.int64), bounds[:-1]) * (n > 0) if len(n) else n
    take = np.maximum(low, np.minimum(n, n - needed(n, percent) + 1))
    place = np.arange(len(s)) - np.repeat(bounds[:-1], n)
    return place < np.repeat(take, n), low


def _postings(shingle: int, percent: int, share: float, held: np.ndarray | None, seen_too: bool):
    """(hash, class, n, low) of what each text writes, once for equal texts of a partition; of hashes that held may have, if given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for _, s, b, n, d in _each(batches, shingle):
            own = class_of(d)
            new = np.array([x not in seen and not seen.add(x) for x in zip(d[0].tolist(), d[1].tolist(), strict=True)], bool) & (n > 0)
            take, low = thin(s, b, percent, share)
            take &= np.repeat(new, n)
            if held is not None and len(s):
                take[take] = may_hold(held, s[take])
            doc = np.repeat(np.arange(len(n)), n)[take]
            columns = [pa.array(s[take].view(np.int64))]
            if seen_too:
                columns += [pa.array(own[doc].view(np.int64)), pa.array(n[doc]), pa.array(low[doc])]
            yield pa.record_batch(columns, ["hash", "class", "n", "low"][: len(columns)])

    return run


def _wholes(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, s, b, _, d in _each(batches, shingle):
            yield pa.record_batch([ids, pa.array(class_of(d).view(np.int64)), pa.LargeListArray.from_arrays(pa.array(b), pa.array(s.view(np.int64))).cast(pa.list_(pa.int64()))], ["id", "class", "s"])

    return run


def prefixes(postings: DataFrame, percent: int, share: float) -> DataFrame:
    """(class, n, need, prefix, short): each class's shared shingles of the prefix that costs least, how many a pair must share, and how many are of the shortest prefix.

    postings(hash, class, n, low, df): those counted more than once. Costs are sums of counts.
    """
    edge = F.lit(edge_of(share) - (1 << 63))  # hashes as signed numbers, shifted so that their order is that of unsigned ones
    h = F.col("hash").bitwiseXOR(F.lit(-(1 << 63)))
    own = postings.groupBy("class", "n", "low").agg(F.array_sort(F.collect_set(F.struct(F.when(h < edge, F.col("df")).otherwise(F.lit(1 << 62)).alias("df"), h.alias("at"), "hash"))).alias("all"))
    spare = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100).cast("long")
    counted = F.filter("all", lambda x: x["at"] < edge)
    df = own.withColumn("_spare", spare).withColumn("_counted", counted).withColumn("_single", F.col("low") - F.size("_counted"))
    count = lambda need: F.greatest(F.lit(0), F.least(F.size("_counted"), (F.col("_spare") + need - F.col("_single")).cast("int")))
    met = lambda need: F.aggregate(F.slice("_counted", 1, count(need)), F.lit(0).cast("long"), lambda a, x: a + x["df"] - 1)
    most = F.greatest(F.lit(1), F.least(F.col("low"), F.col("n")) - F.col("_spare"))
    cost = lambda need: met(F.lit(need)) * (1 + F.col("n") * VERIFY / need)
    best = F.array_min(F.array(*(F.when(most >= need, F.struct(cost(need).alias("cost"), F.lit(need).alias("need"))) for need in MATCHES)))
    df = df.withColumn("need", best["need"])
    # a prefix that goes past the counted shingles holds all that the text wrote
    prefix = F.when(F.col("low") < F.col("_spare") + 1, F.col("all")).otherwise(F.slice("_counted", 1, count(F.col("need"))))
    short = F.when(F.col("low") < F.col("_spare") + 1, F.size("all")).otherwise(count(F.lit(1)))
    return df.select("class", "n", "need", F.transform(prefix, lambda x: x["hash"]).alias("prefix"), short.alias("short")).where("short > 0")


def links_among(sides: np.ndarray, needs: np.ndarray, prefix: tuple[np.ndarray, np.ndarray], whole: tuple[np.ndarray, np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that hold together the sets of a task as all its links do.

    Candidates share as many prefix shingles as the lesser need of the two; only sets that have one
    are compared, and a link is a candidate of enough similarity.
    """
    def chosen(lists, rows):
        b, s = lists
        return np.r_[0, np.cumsum(np.diff(b)[rows])], np.concatenate([s[b[k] : b[k + 1]] for k in rows.tolist()] or [s[:0]])

    rows = np.argsort(sides, kind="stable")
    while True:
        cut = int((sides[rows] == 0).sum()) % len(rows)
        if len(np.unique(sides)) > 1 and not cut:
            return []
        near = overlaps(*chosen(prefix, rows), cut)
        need = needs[rows]
        a, b = (need[:cut], need[cut:]) if cut else (need, need)
        candidate = near >= np.minimum(a[:, None], b[None, :])
        if not cut:
            np.fill_diagonal(candidate, False)
        some = np.r_[candidate.any(1), candidate.any(0)] if cut else candidate.any(1)
        if some.all():
            break
        rows = rows[some]
        if len(rows) < 2:
            return []
    bounds, s = chosen(whole, rows)
    n = np.diff(bounds)
    both = overlaps(bounds, s, cut)
    a, b = (n[:cut], n[cut:]) if cut else (n, n)
    for k in range(0, len(both), 256):  # in whole numbers, some rows at a time
        part = both[k : k + 256].astype(np.int64)
        candidate[k : k + 256] &= 100 * part >= percent * (a[k : k + 256, None] + b[None, :] - part)
    return [(int(rows[i]), int(rows[j])) for i, j in forest(candidate, cut)]


def _linked(percent: int):
    """(a, b) of the links of each task; rows (task, side, id, need, prefix, s) stand task by task."""

    def lists(col):
        col = col.combine_chunks()
        offsets = np.asarray(col.offsets).astype(np.int64)
        return offsets - offsets[0], np.asarray(col.flatten()).view(np.uint64)

    def done(held: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        t = pa.Table.from_batches(held)
        found = links_among(np.asarray(t["side"]), np.asarray(t["need"]), lists(t["prefix"]), lists(t["s"]), percent)
        if found:
            return pa.record_batch([t["id"].combine_chunks().take(pa.array([x[k] for x in found], pa.int64())) for k in range(2)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            task = np.asarray(batch.column(0))
            edges = np.r_[0, np.flatnonzero(task[1:] != task[:-1]) + 1, len(task)] if len(task) else np.zeros(1, np.int64)
            for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if held and held[-1].column(0)[-1].as_py() != task[i]:
                    if out := done(held):
                        yield out
                    held = []
                held.append(batch.slice(i, j - i))
        if held and (out := done(held)):
            yield out

    return run


def jaccard_join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, percent: int = PERCENT, share: float = SHARE, block: int = BLOCK, most: int = HASHES) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs.

    Words are runs of other bytes than white space, A-Z lower-cased; the set is the distinct
    shingles of some words, or the whole sequence of a shorter text. Texts link when percent of
    their union is shared. Null and empty texts have an empty set and are linked with nothing. Rows
    of one doc_id with words are one document: they are linked, and repeated rows have equal
    results. A row without doc_id can't be named by a link; its component_id is null. An empty table
    gives an empty result; other columns are not carried. A text of any length is taken whole.
    """
    raw = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    kind = dict(raw.dtypes)["id"]
    sized = durable(in_batches(raw, _digests(shingle), f"id {kind}, n long, d1 long, d2 long, class long"))
    live = sized.where("n > 0 and id is not null")
    same = ["d1", "d2", "n"]
    classes = durable(live.groupBy(*same, "class").agg(F.min("id").alias("rep"), F.count("*").alias("c")))

    texts = raw.where("id is not null")
    counted = in_batches(texts, _postings(shingle, percent, share, None, False), "hash long")
    repeated = durable(counted.groupBy("hash").agg(F.count("*").alias("df")).where("df > 1"))
    held = digest_filter(repeated, "hash")
    postings = in_batches(texts, _postings(shingle, percent, share, held, True), "hash long, class long, n long, low long")
    own = durable(prefixes(postings.join(repeated, "hash"), percent, share))
    # sets that link share one shingle of the shortest prefixes at least, so these are enough for families
    keys = own.select(F.col("class").alias("rep"), F.explode(F.slice("prefix", F.lit(1), F.col("short"))).alias("key"))
    found = durable(components(stars(keys)))

    dealt = durable(tasks(found, own.select(F.col("class").alias("rep"), "n"), min(percent, 99), block, most)).withColumnRenamed("id", "class")
    # a class has the text of its smallest id
    named = durable(classes.join(dealt.select("class").distinct(), "class").groupBy("class").agg(F.min("rep").alias("id")))
    some = probe(texts, "id", named.withColumnRenamed("id", "i"), "i", BLOCKS, "_in").where("_in").select("id", "text")
    whole = in_batches(some, _wholes(shingle), f"id {kind}, class long, s array<long>").join(named, ["id", "class"], "left_semi").dropDuplicates(["class"])
    rows = dealt.join(own.select("class", "need", "prefix"), "class").join(whole, "class").select("task", "side", "id", "need", "prefix", "s")
    links = in_batches(rows.repartition("task").sortWithinPartitions("task"), _linked(percent), f"a {kind}, b {kind}")

    # copies of a text meet their class, those of the most frequent texts in a broadcast
    one = durable(meet(live.select("id", *same), classes.where("c > 1").select(*same, "rep", "c"), same, "c").select("id", *same, F.coalesce("rep", "id").alias("rep")))
    several = one.groupBy("id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a < z").select("id", "a")
    links = links.union(one.join(several, "id").select("a", F.col("rep").alias("b"))).union(several.select("a", F.col("id").alias("b")))
    joined = components(links)
    copies = classes.groupBy("rep").agg(F.sum("c").alias("c"))
    placed = joined.join(copies, F.col("node") == F.col("rep"), "left").select(F.col("node").alias("rep"), "component", F.coalesce("c", F.lit(1)).alias("c"))
    out = meet(one.select("id", "n", "rep"), placed, ["rep"], "c").select("id", "n", F.coalesce("component", "rep").alias("component"))
    rest = sized.where("not (n > 0 and id is not null)").select("id", "n", F.col("id").alias("component"))
    return out.unionByName(rest).select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents that share 85 of 100 shingles of 4 words, over all documents."""
    return jaccard_join(table(spark, sf_dir, "documents"))


SQL = components_sql(SHINGLE, PERCENT) + "SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id FROM d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)"

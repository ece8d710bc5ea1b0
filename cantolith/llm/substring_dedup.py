"""Substring dedup: content-defined chunks cut by a gear rolling hash, deduplicated by digest.

A cut depends on the WINDOW bytes before it alone, so an insertion moves the chunks near it and no
others. A chunk of which an earlier document, or an earlier place of the same one, has a copy is
repeated; maximal runs of repeated chunks with MIN_WORDS words or more are removed. Short common
phrases make no such run and stay.

One row for each chunk is shuffled once, for the first place of each digest (with partial minima);
chunks that a Bloom filter of bounded size takes for repeated ones are then shuffled to meet it,
those of the most frequent digests in a broadcast. Texts are shuffled only where the repeated
chunks of a document have MIN_WORDS words together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import kernel as K
from .bloom import digest_filter, may_hold, probe
from .common import durable, in_batches, meet, number, numbered, pieces, table, utf8

#: Bytes that a cut depends on; least and most bytes of a chunk; one place in 2**BITS is a cut.
WINDOW, LEAST, MOST, BITS = 16, 16, 256, 4
#: Words of a run of repeated chunks that is removed; whole chunks cover so many of a passage of 50 words in all but one case of thousands.
MIN_WORDS = 16
BLOCKS = 1 << 16
_GEAR = (K.seeds(256, 21) >> np.uint64(48)).astype(np.uint16)
_BYTE = K.seeds(256, 22)


def cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chunks' starts, and the n+1 offsets of the documents' chunks; a document starts one."""
    h = _GEAR[data]
    size = 1
    while size < WINDOW:  # sums of shifted gear values over 2, 4, 8, 16 bytes
        h[size:] += h[:-size] << np.uint16(size)
        size *= 2
    head = (data & 0xC0) != 0x80  # no cut inside a character
    able = np.flatnonzero((h[:-1] >> np.uint16(16 - BITS) == 0) & head[1:]) + 1
    at = np.searchsorted(able, offsets)
    out, bounds = [], [0]
    able = able.tolist()
    for d in range(len(offsets) - 1):
        last, end = int(offsets[d]), int(offsets[d + 1])
        if last < end:
            out.append(last)
        for c in [*able[at[d] : at[d + 1]], end]:
            while c - last > MOST:
                last += MOST
                while not head[last]:
                    last -= 1
                if last < end:
                    out.append(last)
            if c - last >= LEAST and c < end and c >= offsets[d] + WINDOW:
                out.append(c)
                last = c
        bounds.append(len(out))
    return np.array(out, np.int64), np.array(bounds, np.int64)


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Starts, ends, digests and word counts of the chunks, and the documents' offsets among them."""
    starts, bounds = cuts(data, offsets)
    ends = np.r_[starts[1:], len(data)] if len(starts) else starts
    words = np.searchsorted(K.words(data, offsets)[0], np.r_[starts, len(data)])
    return starts, ends, K.word_hashes(data, starts, ends, _BYTE).view(np.int64), np.diff(words), bounds


def _rows(batches: Iterator[pa.RecordBatch], shared=None) -> Iterator[pa.RecordBatch]:
    """(id, h, place, digest) of each chunk of rows (id, h, text), or of those that a shared filter takes."""
    for batch in batches:
        data, offsets = utf8(batch.column(2))
        for i, j in pieces(offsets):
            starts, _, digest, words, bounds = chunks(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            doc = np.repeat(np.arange(i, j), np.diff(bounds))
            place = (np.arange(len(starts)) - bounds[doc - i]) * 256 + np.minimum(words, 255)
            if shared is not None:
                some = may_hold(shared.value, digest)
                doc, place, digest = doc[some], place[some], digest[some]
            for k in range(0, len(doc), 1 << 16):
                part = slice(k, k + (1 << 16))
                of = pa.array(doc[part])
                yield pa.record_batch([batch.column(0).take(of), batch.column(1).take(of), pa.array(place[part]), pa.array(digest[part])], ["id", "h", "place", "digest"])


def removals(starts, ends, words, dup: set[int], min_words: int) -> list[tuple[int, int]]:
    """Byte ranges of the runs of repeated chunks; dup: their indices."""
    out, i, n = [], 0, len(starts)
    while i < n:
        if i not in dup:
            i += 1
            continue
        j = i
        while j < n and j in dup:
            j += 1
        if sum(words[i:j]) >= min_words:
            out.append((int(starts[i]), int(ends[j - 1])))
        i = j
    return out


def _clean(batches: Iterator[pa.RecordBatch], text: int, min_words: int) -> Iterator[pa.RecordBatch]:
    """The last column, the repeated chunks of the row, gives way to the spans removed."""
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        col, dups = batch.column(text), batch.column(batch.num_columns - 1)
        data, offsets = utf8(col)
        new, spans = {}, [[] for _ in range(batch.num_rows)]
        for d in np.flatnonzero(np.asarray(dups.is_valid())).tolist():
            own = data[offsets[d] : offsets[d + 1]]
            s, e, _, w, _ = chunks(own, np.array([0, len(own)]))
            if cut := removals(s.tolist(), e.tolist(), w.tolist(), {x >> 8 for x in dups[d].as_py()}, min_words):
                chars = np.r_[0, np.cumsum((own & 0xC0) != 0x80)]
                spans[d] = [{"start": int(chars[a]), "end": int(chars[b])} for a, b in cut]
                keep = np.ones(len(own), bool)
                for a, b in cut:
                    keep[a:b] = False
                new[d] = own[keep].tobytes().decode()
        if new:
            texts = col.to_pylist()
            for d, t in new.items():
                texts[d] = t
            col = pa.array(texts, col.type)
        cols = [col if k == text else c for k, c in enumerate(batch.columns[:-1])]
        yield pa.record_batch([*cols, pa.array(spans, kind)], names=[*batch.schema.names[:-1], "_spans"])


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """docs with repeated passages cut out of the text, and _spans: what was cut, in characters of the old text.

    The first place, by doc_id and then by position, keeps a passage. Null and empty texts have no
    chunks and stay as they are; a copy of an earlier document of min_words words or more becomes
    empty, its row stays. Rows of one doc_id and one text are one document: they are treated alike
    and do not repeat each other; rows of one doc_id with different texts are different documents,
    as are rows without doc_id, which come first. An empty table gives an empty result; all
    columns are carried, whatever their names.
    """
    names, doc_id, text = docs.columns, number(docs, doc_id), number(docs, text)
    docs = numbered(docs)
    cols, digest = docs.columns, F.xxhash64(text)
    raw = docs.select(F.col(doc_id).alias("id"), digest.alias("h"), F.col(text).alias("text"))
    schema = f"id {dict(raw.dtypes)['id']}, h long, place long, digest long"
    first = in_batches(raw, _rows, schema).groupBy("digest").agg(F.count("*").alias("c"), F.min(F.struct("id", "h", "place")).alias("f"))
    first = durable(first.where("c > 1"))
    shared = docs.sparkSession.sparkContext.broadcast(digest_filter(first, "digest"))
    same = F.col("id").eqNullSafe(F.col("f.id")) & (F.col("h") == F.col("f.h")) & (F.col("place") == F.col("f.place"))
    again = meet(in_batches(raw, lambda it: _rows(it, shared), schema), first, ["digest"], "c").where(F.col("f").isNotNull() & ~same)
    words = F.sum(F.col("place").bitwiseAND(F.lit(255)))
    dups = durable(again.groupBy("id", "h").agg(words.alias("w"), F.collect_set("place").alias("_dup")).where(F.col("w") >= min_words).select(F.xxhash64("id", "h").alias("_at"), F.col("id").alias("_id"), F.col("h").alias("_h"), "_dup"))
    marked = probe(docs.withColumn("_h0", digest).withColumn("_key", F.xxhash64(doc_id, "_h0")), "_key", dups, "_at", BLOCKS, "_maybe")
    spans = "array<struct<start:bigint,end:bigint>>"
    as_is = marked.where("not _maybe").select(*cols, F.array().cast(spans).alias("_spans"))
    own = (F.col("_key") == F.col("_at")) & F.col(doc_id).eqNullSafe(F.col("_id")) & (F.col("_h0") == F.col("_h"))
    joined = marked.where("_maybe").join(dups, own, "left").select(*cols, "_dup")
    return as_is.unionByName(in_batches(joined, lambda it, at=cols.index(text): _clean(it, at, min_words), as_is.schema)).toDF(*names, "_spans")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without passages that an earlier place has, and the spans removed."""
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("_spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return out.select("doc_id", "text", F.size("_spans").cast("long").alias("n_spans"), removed.alias("n_removed"), F.col("_spans").alias("spans"))

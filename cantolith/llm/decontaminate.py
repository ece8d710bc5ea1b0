"""Benchmark decontamination by the q-gram lemma.

A window of W characters of a benchmark item and a document region within E edits of it share at
least W + 1 - Q*(E + 1) q-grams on neighbouring diagonals. Shared q-grams are counted in diagonal
bands that overlap by E, windows whose band reaches the bound are retained, and an alignment of
each such window inside the band verifies it. The benchmark is the stated query set: it is
broadcast in blocks of at most BLOCK characters, and every block is searched in every whole document.

Repetitive texts meet an item on many diagonals. A stretch of a document is one region of an item,
whatever the diagonals on which its windows were found, and a window whose whole reach is in a region
already is not verified again, so the work follows the document and not the number of diagonals. Of long
stretches of a short period (ruler lines, padding), which share all their q-grams with each other, the
middle is left out as well, whole periods of it: what remains has the same windows. Shared q-grams are
expanded at most HITS at a time, by places and then by items.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import kernel as K
from .common import durable, in_batches, number, numbered, pieces, table, utf8

#: Length of a q-gram, window and edit budget in characters, width of a band beyond its overlap.
Q, W, E, BAND = 8, 64, 6, 8
#: Characters of a block of the benchmark; longer items are cut with W*2 characters in common.
BLOCK = 1 << 21
#: Characters of a piece of an item, shared q-grams that are expanded at once.
PIECE, HITS = 1 << 16, 1 << 20
#: Longest period of a stretch whose middle is left out; what stays of it; shared q-grams a character from which a document is looked at for such.
PERIOD, STAY, HEAVY = 32, 2 * (W + 2 * E) + 32, 8
_FILTER = 20
_MULTIPLIER = np.uint64(0xC2B2AE3D27D4EB4F)


def normal(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters with A-Z lower-cased and a run of ASCII white space as one space, offsets among them, their old places."""
    codes = np.where((codes >= 65) & (codes <= 90), codes + 32, codes)
    white = (codes == 32) | ((codes >= 9) & (codes <= 13))
    codes[white] = 32
    drop = white.copy()
    drop[1:] &= white[:-1]
    drop[offsets[:-1][offsets[:-1] < len(codes)]] = False
    places = np.flatnonzero(~drop)
    return codes[places], np.searchsorted(places, offsets), places


def grams(codes: np.ndarray) -> np.ndarray:
    """A hash of each Q consecutive characters (Q is a power of two)."""
    h, a, size = K.mix(codes.astype(np.uint64) + np.uint64(1)), _MULTIPLIER, 1
    with np.errstate(over="ignore"):
        while size < Q and len(h) > size:
            h = h[:-size] * a + h[size:]
            a = a * a
            size *= 2
    return h if size == Q else h[:0]


def characters(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def shortened(codes: np.ndarray) -> np.ndarray:
    """Places of the characters that stay when the middle of each periodic stretch of over STAY characters goes."""
    places = np.arange(len(codes))
    for p in range(1, PERIOD + 1):
        own = codes[places]
        if len(own) <= STAY:
            break
        same = np.r_[False, own[p:] == own[:-p], False]
        edge = np.flatnonzero(same[1:] != same[:-1])
        keep = np.ones(len(own), bool)
        for i, j in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):  # own[i : j + p] has period p
            if (spare := (j + p - i - STAY) // p * p) > 0:
                keep[i + STAY // 2 : i + STAY // 2 + spare] = False
        places = places[keep]
    return places


class Regions:
    """Windows of an item that were found in a document, as regions of overlapping ones."""

    def __init__(self):
        self.new: list[tuple[int, int, int, int, int]] = []
        self.regions: list[list[int]] = []  # [start, end, item start, item end, most edits], by start
        self.met: dict[int, set[int]] = {}  # the windows by their diagonal

    def add(self, start: int, end: int, at: int, window: int, edits: int) -> None:
        self.new.append((start, end, at, at + window, edits))
        self.met.setdefault(start - at, set()).add(at)

    def starts(self, low: int, high: int) -> set[int]:
        """The windows that were found on the diagonals from low to before high."""
        return set().union(*(self.met[k] for k in range(low, high) if k in self.met))

    def joined(self) -> list[list[int]]:
        if self.new:
            out: list[list[int]] = []
            for a, b, x, y, edits in sorted([*map(tuple, self.regions), *self.new]):
                if out and a <= out[-1][1]:
                    o = out[-1]
                    o[1], o[2], o[3], o[4] = max(b, o[1]), min(x, o[2]), max(y, o[3]), max(edits, o[4])
                else:
                    out.append([a, b, x, y, edits])
            self.regions, self.new = out, []
        return self.regions

    def has(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Whether a region holds all from each start to its end."""
        own = self.joined()
        if not own:
            return np.zeros(len(start), bool)
        first, last = np.array([r[0] for r in own]), np.array([r[1] for r in own])
        at = np.searchsorted(first, start, side="right") - 1
        return (at >= 0) & (last[at] >= end)


class Block:
    """Items' normal characters and a sorted table of their q-grams."""

    def __init__(self, items: list[tuple]):
        """items: (number of the item, first character, text)."""
        parts = []
        for i, shift, text in items:
            c = characters(text)
            codes, _, places = normal(c, np.array([0, len(c)]))
            stay = shortened(codes)
            if len(stay) >= Q:
                parts.append((i, shift, codes[stay], places[stay]))
        self.fill(parts)

    def fill(self, parts: list[tuple]) -> Block:
        self.parts, self.halves = parts, None
        self.ids, self.shift, self.codes, self.places = (list(x) for x in zip(*parts, strict=True)) if parts else ([], [], [], [])
        self.length = n = np.array([len(c) for c in self.codes], np.int64)
        self.window = np.minimum(n, W)
        # an item shorter than W has a budget in proportion, and never one that leaves no q-gram to find
        self.budget = np.minimum(self.window * E // W, self.window // Q - 1)
        self.bound = self.window + 1 - Q * (self.budget + 1)
        found = [grams(c) for c in self.codes]
        keys = np.concatenate([*found, np.zeros(0, np.uint64)])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.item = np.repeat(np.arange(len(n)), [len(g) for g in found])[order].astype(np.int32)
        self.at = np.concatenate([*(np.arange(len(g)) for g in found), np.zeros(0, np.int64)])[order].astype(np.int32)
        self.some = np.zeros(1 << _FILTER, bool)
        self.some[(self.keys >> np.uint64(64 - _FILTER)).astype(np.int64)] = True
        return self

    def split(self) -> tuple[Block, Block]:
        """Two blocks with half of the items each."""
        if self.halves is None:
            k = len(self.parts) // 2
            self.halves = tuple(Block.__new__(Block).fill(x) for x in (self.parts[:k], self.parts[k:]))
        return self.halves

    def __getstate__(self):
        return {**self.__dict__, "halves": None}

    def shared(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places with a q-gram of the block, the first of its rows and their number."""
        g = grams(codes)
        where = np.flatnonzero(self.some[(g >> np.uint64(64 - _FILTER)).astype(np.int64)])
        first = np.searchsorted(self.keys, g[where])
        count = np.searchsorted(self.keys, g[where], side="right") - first
        some = count > 0
        return where[some], first[some], count[some]

    def candidates(self, codes: np.ndarray, offsets: np.ndarray, shared: tuple | None = None) -> Iterator[tuple[Block, list[tuple]]]:
        """Parts of the block with (document, item, lowest diagonal, first and last window) of bands that reach the bound."""
        where, first, count = shared or self.shared(codes)
        sums = np.r_[0, np.cumsum(count)]
        i = 0
        while i < len(where):
            # as many places as HITS allows; slices overlap by what a window can span, so each is whole in one of them
            j = max(int(np.searchsorted(sums, sums[i] + HITS, side="right")) - 1, int(np.searchsorted(where, where[i] + 2 * (W + E + Q))))
            if sums[j] - sums[i] > HITS and len(self.parts) > 1:
                lo, hi = int(where[i]), int(where[j - 1]) + Q
                for half in self.split():
                    for part, found in half.candidates(codes[lo:hi], np.clip(offsets - lo, 0, hi - lo)):
                        yield part, [(d, t, low + lo, s, e) for d, t, low, s, e in found]
            else:
                yield self, self.bands(offsets, where[i:j], first[i:j], count[i:j])
            if j == len(where):
                break
            i = int(np.searchsorted(where, where[j] - (W + E + Q)))

    def bands(self, offsets: np.ndarray, where: np.ndarray, first: np.ndarray, count: np.ndarray) -> list[tuple]:
        row = np.repeat(first - np.r_[0, np.cumsum(count)][:-1], count) + np.arange(count.sum())
        where, item, at = np.repeat(where, count), self.item[row].astype(np.int64), self.at[row].astype(np.int64)
        doc = np.searchsorted(offsets, where, side="right") - 1
        inside = where + Q <= offsets[doc + 1]
        where, item, at, doc = where[inside], item[inside], at[inside], doc[inside]
        diagonal = where - at + (1 << 31)  # never below zero
        band = diagonal // BAND
        twice = diagonal % BAND < E  # the lower band reaches E beyond
        band = np.r_[band, band[twice] - 1]
        doc, item, at = (np.r_[x, x[twice]] for x in (doc, item, at))
        bucket = (K.mix(((doc * len(self.ids) + item) << 34 ^ band).astype(np.uint64)) >> np.uint64(64 - _FILTER)).astype(np.int64)
        dense = np.bincount(bucket, minlength=1 << _FILTER)[bucket] >= self.bound[item]  # too few hits of any kind: no window
        doc, item, at, band = (x[dense] for x in (doc, item, at, band))
        key = doc * len(self.ids) + item
        order = np.lexsort((at, band, key))
        doc, item, at, band, key = (x[order] for x in (doc, item, at, band, key))
        new = np.ones(len(key), bool)  # a place of the item counts once, however often repetitive text meets it in a band
        new[1:] = (key[1:] != key[:-1]) | (band[1:] != band[:-1]) | (at[1:] != at[:-1])
        doc, item, at, band, key = (x[new] for x in (doc, item, at, band, key))
        last = np.arange(len(key)) + self.bound[item] - 1
        ok = last < len(key)
        idx, last = np.flatnonzero(ok), last[ok]
        good = (key[idx] == key[last]) & (band[idx] == band[last]) & (at[last] - at[idx] <= self.window[item[idx]] - Q)
        i, j = idx[good], last[good]
        if not len(i):
            return []
        t, w = item[i], self.window[item[i]]
        first, last = np.maximum(0, at[j] + Q - w), np.minimum(self.length[t] - w, at[i])  # both rise within a band
        new = (key[i][1:] != key[i][:-1]) | (band[i][1:] != band[i][:-1]) | (first[1:] > last[:-1] + 1)
        begin = np.flatnonzero(np.r_[True, new])
        end = np.r_[begin[1:], len(i)] - 1
        return list(zip(*(x.tolist() for x in (doc[i][begin], t[begin], band[i][begin] * BAND - (1 << 31), first[begin], last[end])), strict=True))

    def verify(self, codes: np.ndarray, begin: int, end: int, t: int, low: int, first: int, last: int, known: Regions) -> None:
        """Adds to known each window of an item that an alignment inside the band confirms.

        Windows that known has on a diagonal of the band, and those whose whole reach is in a region,
        are left out. One that is found without gaps needs no alignment; its edits are then the
        characters that differ.
        """
        item, w, e = self.codes[t], int(self.window[t]), int(self.budget[t])
        lo, width = low - E, BAND + 3 * E + 1  # diagonals of the band and E on both sides
        steps = np.arange(width)
        windows = np.arange(first, last + 1)
        windows = windows[~known.has(np.maximum(begin, windows + lo), np.minimum(end, windows + lo + width + w))]
        if done := known.starts(lo, lo + width):
            windows = windows[~np.isin(windows, list(done))]
        if not len(windows):
            return
        k = np.arange(windows[0], windows[-1] + w)
        place = k[:, None] + lo + steps
        valid = (place >= begin) & (place < end)
        differs = ~(valid & (codes[np.clip(place, 0, len(codes) - 1)] == item[k][:, None]))
        sums = np.zeros((len(k) + 1, width), np.int32)
        np.cumsum(differs, axis=0, out=sums[1:])
        at = windows - windows[0]
        each = sums[at + w] - sums[at]
        d = each.argmin(axis=1)
        least = each[np.arange(len(d)), d]
        plain = least <= e
        for x, y, edits in zip(windows[plain].tolist(), d[plain].tolist(), least[plain].tolist(), strict=True):
            known.add(max(begin, x + lo + y), min(end, x + lo + y + w), x, w, edits)
        rest = windows[~plain]
        for k in range(0, len(rest), 1024):
            self.align(codes, begin, end, item, w, e, lo, rest[k : k + 1024], known)

    @staticmethod
    def align(codes: np.ndarray, begin: int, end: int, item: np.ndarray, w: int, e: int, lo: int, windows: np.ndarray, known: Regions) -> None:
        """The same by the edit distance, for any number of windows at once."""
        steps = np.arange(BAND + 3 * E + 1)
        s = windows[:, None]
        origin = s + lo + steps  # where the alignment that ends at a cell begins
        row = np.zeros(origin.shape, np.int64)  # least edits of item[s : s + i] ending before place s + i + lo + d
        for i in range(w):
            place = s + i + lo + steps
            valid = (place >= begin) & (place < end)
            over = row + ~(valid & (codes[np.clip(place, 0, len(codes) - 1)] == item[s + i]))
            best, source = over, origin.copy()
            less = row[:, 1:] + 1 < over[:, :-1]  # a character of the item is missing
            best[:, :-1][less] = row[:, 1:][less] + 1
            source[:, :-1][less] = origin[:, 1:][less]
            row = np.minimum.accumulate(best - steps, axis=1)  # characters of the document that the item has not
            fresh = np.ones(row.shape, bool)
            fresh[:, 1:] = row[:, 1:] < row[:, :-1]
            origin = np.take_along_axis(source, np.maximum.accumulate(np.where(fresh, steps, 0), axis=1), axis=1)
            row = row + steps
        d = row.argmin(axis=1)
        each = np.arange(len(d))
        for x in np.flatnonzero(row[each, d] <= e).tolist():
            at = int(windows[x])
            a, b = max(begin, int(origin[x, d[x]])), min(end, at + w + lo + int(d[x]))
            known.add(a, max(a, b), at, w, int(row[x, d[x]]))


def _search(batches: Iterator[pa.RecordBatch], shared, kind: pa.DataType, brief: bool = False) -> Iterator[pa.RecordBatch]:
    """brief: of each document the first region that is found is enough."""
    block, items = shared.value
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        rows = []
        for i, j in pieces(offsets):
            part = data[offsets[i] : offsets[j]]
            heads = np.r_[0, np.cumsum((part & 0xC0) != 0x80)]
            old = heads[offsets[i : j + 1] - offsets[i]]
            codes, bounds, places = normal(characters(part.tobytes().decode()), old)
            shares = block.shared(codes)
            where, _, count = shares
            heavy = np.flatnonzero(np.diff(np.r_[0, np.cumsum(count)][np.searchsorted(where, bounds)]) > HEAVY * np.diff(bounds))
            if len(heavy):
                keep = np.ones(len(codes), bool)
                for d in heavy.tolist():
                    keep[bounds[d] : bounds[d + 1]] = False
                    keep[bounds[d] + shortened(codes[bounds[d] : bounds[d + 1]])] = True
                codes, places, bounds = codes[keep], places[keep], np.r_[0, np.cumsum(keep)][bounds]
                shares = None
            done: dict[tuple[int, int, int], Regions] = {}
            spots_of, leaks = {}, set()
            for own, found in block.candidates(codes, bounds, shares):
                for d, t, low, first, last in found:
                    if d in leaks:
                        continue
                    key = (d, own.ids[t], own.shift[t])
                    spots_of[key] = own.places[t]
                    own.verify(codes, int(bounds[d]), int(bounds[d + 1]), t, low, first, last, done.setdefault(key, Regions()))
                    if brief and done[key].joined():
                        leaks.add(d)
            for (d, number, shift), found in sorted(done.items(), key=lambda x: x[0]):
                spots = spots_of[d, number, shift]
                for s, e, x, y, edits in found.joined():
                    e = max(e, s + 1)
                    rows.append((i + d, items[number], int(places[s] - old[d]), int(places[e - 1] - old[d]) + 1, shift + int(spots[x]), shift + int(spots[y - 1]) + 1, edits))
        cols = list(zip(*rows, strict=True)) or [[]] * 7
        yield pa.record_batch([batch.column(0).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], kind), *(pa.array(c, pa.int64()) for c in cols[2:])], ["id", "item", "start", "end", "item_start", "item_end", "edits"])


def blocks(benchmark: DataFrame, item_id: str, text: str, size: int) -> Iterator[tuple[list[tuple], list]]:
    """The items in blocks of about size characters, as (number, first character, text) and their ids; the driver holds one block at a time."""
    items = benchmark.select(F.col(item_id).alias("i"), F.col(text).alias("t")).where("i is not null and t is not null")
    block, ids, filled = [], [], 0
    step = min(size, PIECE)
    for row in items.toLocalIterator():
        for k in range(0, max(1, len(row.t) - 2 * W), step):
            piece = row.t[k : k + step + 2 * W]
            if filled + len(piece) > size and block:
                yield block, ids
                block, ids, filled = [], [], 0
            if not ids or ids[-1] != row.i:
                ids.append(row.i)
            block.append((len(ids) - 1, k, piece))
            filled += len(piece)
    if block:
        yield block, ids


def find_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", size: int = BLOCK, brief: bool = False) -> DataFrame:
    """(doc_id, item_id, start, end, item_start, item_end, edits): every region of a document that has a window of an item.

    A stretch of overlapping windows is one region of an item. Where the item repeats itself, so that the
    stretch meets several of its places, item_start and item_end hold those that were looked at. brief gives one region
    of each document that has any, for those who only ask which have.

    Windows are W characters (the whole of a shorter item) within E edits (in proportion), after
    lower-casing A-Z and joining white space; places are characters of the texts as they are.
    Items of fewer than Q characters can't be found, nor can null ids or texts; null and empty
    documents have no leaks. Documents are searched row by row: repeated rows and null ids get
    rows of their own, as have repeated items. edits is the most that a window of the region
    needs that was looked at. A long stretch of a short period is found at its ends or as a whole. Other columns are not
    carried; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    raw = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    schema = f"id {dict(raw.dtypes)['id']}, item {dict(benchmark.dtypes)[item_id]}, start long, end long, item_start long, item_end long, edits long"
    kind = to_arrow_type(benchmark.schema[item_id].dataType)
    out = None
    for items, ids in blocks(benchmark, item_id, item_text, size):
        shared = spark.sparkContext.broadcast((Block(items), ids))
        part = in_batches(raw, lambda it, shared=shared: _search(it, shared, kind, brief), schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], schema)
    return out.withColumnsRenamed({"id": doc_id, "item": "item_id"})


def drop_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without those that have a leak.

    Rows without doc_id are judged by their text, rows of one doc_id each by its own; null and empty
    texts stay; an empty table gives an empty result. All columns are carried, whatever their names.
    """
    d, t = numbered(docs), number(docs, text)
    key = F.xxhash64(number(docs, doc_id), t)
    found = durable(find_leaks(d.withColumn("_key", key), benchmark, "_key", t, brief=True).select(F.col("_key").alias("_leak")).distinct())
    return d.join(found, key == F.col("_leak"), "left_anti").toDF(*docs.columns)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every region of documents that has a passage of the benchmark."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))

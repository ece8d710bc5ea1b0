"""Quality rules: counting rules, and bands of n-gram perplexity by language.

Spark counts, by language, the ORDER-grams of the characters of all documents that pass the base
rules and have few symbols (the others would teach the model what it should reject). A character is
16 bits, so an n-gram is one exact number, and what is gathered grows with what the corpus holds.
The driver makes modified Kneser-Ney models of the counts, kept as sorted arrays of n-grams.
What the driver gathers and broadcasts is bounded by KEYS n-grams, of which each language has a share, half
of it evenly and half by the root of its n-grams; what a small language leaves of it goes to the others. A language with more
n-grams than its share keeps its whole model in tables of Spark (Levels): its most frequent n-grams, down to
the least power of two of places that fits, are broadcast with their bits (Held), and what documents hold of
others is joined with the tables. So no n-gram is left out, and only the rare ones are shuffled.
Languages with under POOL n-grams, or one in LANGUAGES of all, share a model.

A second pass scores every document; a document is rejected outside its language's band, from
LOWER spreads below the middle to UPPER above, MARGIN bits at least. Middle and spread are the
median and half the width of the narrowest range that holds half of the documents that teach the
model, which bad ones can't move to themselves while they are fewer than half. Perplexities of
short texts are drawn towards the middle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import features
from . import kernel as K
from .common import durable, in_batches, meet, number, numbered, pieces, table, utf8

ORDER, BITS = 4, 16
LOWER, UPPER, MARGIN = 8.0, 8.0, 1.0
#: Share of symbols, in percent of the characters in words, up to which a text teaches the model.
FEW = 1
#: A text of so many characters counts half its distance from the middle; widths of the histogram.
PRIOR, STEP, STEPS = 50, 0.005, 4096
#: Most n-grams that the driver gathers, some 50 bytes each with all that is made of them; beyond it the rest stays in Spark.
KEYS = 1 << 21
#: n-grams, and share of all, under which a language has no model of its own; the name of what such share.
POOL, LANGUAGES, POOLED = 20_000, 1 << 16, "\0"
WINDOW = 5
#: Slots of a table of n-grams that a worker has met; n-grams beyond it that are held before they are counted.
SLOTS, HELD = 1 << 18, 1 << 21


def _characters() -> np.ndarray:
    """What stands for each 16-bit code: lower case where that is one such code, a space for white space, 0 for digits."""
    out = np.arange(1 << BITS, dtype=np.uint16)
    for c in range(1 << BITS):
        if not 0xD800 <= c < 0xE000:
            low = chr(c).lower()
            if len(low) == 1 and ord(low) < 1 << BITS:
                out[c] = ord(low)
    out[[*range(9, 14), 0xA0]] = 32
    out[48:58] = 48
    return out


_LOWER = _characters()
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(x) for x in "#*$%&|<>"]] = True
_RAW = K.seeds(256, 31)


def keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each character, with spaces before each text, and the texts' n+1 offsets.

    Characters beyond 16 bits fall on the 6,400 codes of the private area.
    """
    code = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    c = _LOWER[np.where(code < 1 << BITS, code, 0xE000 + code % 6400)]
    bounds = np.r_[0, np.cumsum((data & 0xC0) != 0x80)][offsets]
    n = np.diff(bounds)
    to = np.arange(len(c)) + (ORDER - 1) * (np.repeat(np.arange(len(n)), n) + 1)
    padded = np.full(len(c) + (ORDER - 1) * len(n), 32, np.uint64)
    padded[to] = c
    out = padded[to - (ORDER - 1)]
    for k in range(ORDER - 2, -1, -1):
        out = out << np.uint64(BITS) | padded[to - k]
    return out, bounds


class Met:
    """n-grams in a table of SLOTS slots, with a value each."""

    def __init__(self, kind):
        self.used, self.keys, self.values = np.zeros(SLOTS, bool), np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, kind)

    def find(self, g: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slot of each n-gram, and whether it is there."""
        slot = (K.mix(g) & np.uint64(SLOTS - 1)).astype(np.int64)
        return slot, self.used[slot] & (self.keys[slot] == g)

    def put(self, g: np.ndarray, values: np.ndarray, free: bool) -> np.ndarray:
        """Which of distinct n-grams were put; of two for one slot the last, with free only into free slots."""
        slot, _ = self.find(g)
        if free:
            able = np.flatnonzero(~self.used[slot])
        else:
            able = np.arange(len(g))
        _, at = np.unique(slot[able][::-1], return_index=True)
        able = able[len(able) - 1 - at]
        self.used[slot[able]], self.keys[slot[able]], self.values[slot[able]] = True, g[able], values[able]
        done = np.zeros(len(g), bool)
        done[able] = True
        return done


class Tally:
    """Numbers of n-grams."""

    def __init__(self):
        self.met, self.rest, self.size = Met(np.int64), [], 0

    def add(self, g: np.ndarray):
        slot, there = self.met.find(g)
        self.met.values += np.bincount(slot[there], minlength=SLOTS)
        if not there.all():
            new, c = np.unique(g[~there], return_counts=True)
            over = ~self.met.put(new, c, True)
            self.rest.append((new[over], c[over]))
            self.size += int(over.sum())

    def settle(self):
        """Adds up what found no slot."""
        if len(self.rest) > 1:
            g, at = np.unique(np.concatenate([x for x, _ in self.rest]), return_inverse=True)
            self.rest = [(g, np.bincount(at, np.concatenate([c for _, c in self.rest]), len(g)).astype(np.int64))]
            self.size = len(g)

    def rows(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        yield self.met.keys[self.met.used], self.met.values[self.met.used]
        yield from self.rest


def language(lang: Column) -> Column:
    """A language's name; null is like an empty one."""
    return F.coalesce(lang.cast("string"), F.lit(""))


def _by_language(names: pa.Array) -> tuple[list[str], np.ndarray]:
    d = names.dictionary_encode()
    return d.dictionary.to_pylist(), np.asarray(d.indices)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, key, number) of the n-grams of a partition; columns: lang, text."""
    tallies: dict[str, Tally] = {}

    def rows():
        for name, tally in tallies.items():
            for g, c in tally.rows():
                for k in range(0, len(g), 1 << 16):
                    part = slice(k, k + (1 << 16))
                    n = len(g[part])
                    yield pa.record_batch([pa.array([name] * n, pa.string()), pa.array(g[part].view(np.int64)), pa.array(c[part])], ["lang", "key", "number"])
        tallies.clear()

    for batch in batches:
        names, of = _by_language(batch.column(0))
        data, offsets = utf8(batch.column(1))
        for i, j in pieces(offsets):
            part, o = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            found, bounds = keys(part, o)
            teaches = teaching(counts(part, o))
            each = np.repeat(np.where(teaches, of[i:j], -1), np.diff(bounds))
            for x in np.unique(of[i:j][teaches]).tolist():
                tallies.setdefault(names[x], Tally()).add(found[each == x])
            if sum(t.size for t in tallies.values()) > HELD:
                for t in tallies.values():
                    t.settle()
                if sum(t.size for t in tallies.values()) > HELD // 2:
                    yield from rows()
            if len(tallies) > 16:  # a partition of many languages
                yield from rows()
    yield from rows()


class KneserNey:
    """An interpolated modified Kneser-Ney model of the n-grams of one language."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        order = np.argsort(grams)
        self.tables = []  # by order: sorted n-grams and their own shares, sorted contexts and their backoff weights
        levels = [(grams[order], counts[order].astype(np.float64))]
        for n in range(ORDER - 1, 0, -1):  # below the highest order: in how many contexts an n-gram follows
            rest, c = np.unique(levels[-1][0] & self.mask(n), return_counts=True)
            levels.append((rest, c.astype(np.float64)))
        for n, (g, c) in zip(range(1, ORDER + 1), reversed(levels), strict=True):
            d = self.discounts(c)
            context, at = np.unique(g >> np.uint64(BITS), return_inverse=True)
            total = np.bincount(at, c, len(context))
            less = d[np.minimum(c, 3).astype(int)]
            share, back = (c - less) / total[at], np.bincount(at, less, len(context)) / total
            self.tables.append((g, share.astype(np.float32), context, back.astype(np.float32)))
        self.even = 1 / (len(levels[-1][0]) + 1)

    @staticmethod
    def mask(n: int) -> np.uint64:
        return np.uint64((1 << BITS * n) - 1)

    @staticmethod
    def discounts(c: np.ndarray | list[int]) -> np.ndarray:
        """What is taken off counts of 0, 1, 2 and 3 or more; c are the counts, or a list of how many are 1 to 4."""
        n = [max(1, x) for x in (c if isinstance(c, list) else [int((c == k).sum()) for k in range(1, 5)])]
        y = n[0] / (n[0] + 2 * n[1])
        return np.array([0.0, *(min(max(0.1 * k, k - (k + 1) * y * n[k] / n[k - 1]), k * 0.9) for k in (1, 2, 3))])

    @staticmethod
    def find(table: np.ndarray, values: np.ndarray, g: np.ndarray, missing: float) -> np.ndarray:
        at = np.minimum(np.searchsorted(table, g), len(table) - 1)
        return np.where(table[at] == g, values[at], np.float32(missing))

    def probability(self, keys: np.ndarray) -> np.ndarray:
        """Of the last character of each n-gram after the others; a character never seen has what an even share of the rest gives."""
        p = np.full(len(keys), self.even)
        for n, (g, share, context, back) in enumerate(self.tables, 1):
            k = keys & self.mask(n)
            p = self.find(g, share, k, 0) + self.find(context, back, k >> np.uint64(BITS), 1) * p
        return p

    def look(self, keys: np.ndarray) -> np.ndarray:
        return -np.log2(np.maximum(self.probability(keys), 1e-9)).astype(np.float32)

    def bits(self, keys: np.ndarray) -> np.ndarray:
        """-log2 of the probabilities; a worker remembers those of the n-grams it has met."""
        if not hasattr(self, "met"):
            self.met = Met(np.float32)
        slot, there = self.met.find(keys)
        out = self.met.values[slot]
        if not there.all():
            fresh, at = np.unique(keys[~there], return_inverse=True)
            new = self.look(fresh)
            out[~there] = new[at]
            self.met.put(fresh, new, False)
        return out

    def __getstate__(self):
        return {"tables": self.tables, "even": self.even}


class Held(KneserNey):
    """The bits of the most frequent n-grams of one language, whose whole model is in Levels; of others they are not a number."""

    def __init__(self, grams: np.ndarray, bits: np.ndarray):
        order = np.argsort(grams)
        self.tables, self.even = [(grams[order], bits[order])], np.nan

    def look(self, keys: np.ndarray) -> np.ndarray:
        grams, bits = self.tables[0]
        return self.find(grams, bits, keys, np.nan) if len(grams) else np.full(len(keys), np.nan, np.float32)


class Levels:
    """Models of languages as tables of Spark, with the formula and the roundings of KneserNey.

    An n-gram meets its own count, its context and its end; of each there are 65,536 at most that
    share a key, so no task of these joins is long.
    """

    def __init__(self, counts: DataFrame):
        """counts(model, key, number) of the n-grams of ORDER, computed once."""
        self.counts = {ORDER: counts.select("model", "key", F.col("number").alias("c"))}
        for n in range(ORDER - 1, 0, -1):  # in how many contexts an n-gram follows
            self.counts[n] = durable(self.counts[n + 1].groupBy("model", self.end(n).alias("key")).agg(F.count("*").alias("c")))
        self.less = {}
        for n, t in self.counts.items():  # bounded: a row for each model
            found = t.groupBy("model").agg(F.count("*").alias("n"), *(F.count_if(F.col("c") == k).alias(f"n{k}") for k in range(1, 5))).collect()
            rows = [(r.model, *KneserNey.discounts(list(r)[2:]).tolist()[1:], 1 / (r.n + 1)) for r in found]
            self.less[n] = counts.sparkSession.createDataFrame(rows, "model string, d1 double, d2 double, d3 double, even double")

    @staticmethod
    def end(n: int) -> Column:
        """The last n characters of an n-gram."""
        return F.col("key").bitwiseAND(F.lit((1 << BITS * n) - 1))

    def probability(self, wanted: DataFrame, n: int = ORDER) -> DataFrame:
        """(model, key, p) of wanted(model, key), which are n characters long and distinct."""
        start = F.shiftrightunsigned("key", BITS)
        less = F.broadcast(self.less[n])
        d = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        t = self.counts[n].join(less, "model").withColumn("d", d)
        times = [F.col(f"d{k}") * F.count_if(F.col("c") == k if k < 3 else F.col("c") >= 3) for k in (1, 2, 3)]
        contexts = t.groupBy("model", start.alias("context"), "d1", "d2", "d3").agg(F.sum("c").alias("total"), sum(times[1:], times[0]).alias("less"))
        out = wanted.select("model", "key", start.alias("context"), self.end(n - 1).alias("end"))
        out = out.join(t.select("model", "key", "c", "d"), ["model", "key"], "left")
        out = out.join(contexts.select("model", "context", "total", "less"), ["model", "context"], "left")
        if n == 1:
            out = out.join(less.select("model", F.col("even").alias("low")), "model")
        else:
            low = self.probability(wanted.select("model", self.end(n - 1).alias("key")).distinct(), n - 1)
            out = out.join(low.select("model", F.col("key").alias("end"), F.col("p").alias("low")), ["model", "end"])
        part = lambda x, missing: F.coalesce((x / F.col("total")).cast("float").cast("double"), F.lit(missing))
        return out.select("model", "key", (part(F.col("c") - F.col("d"), 0.0) + part(F.col("less"), 1.0) * F.col("low")).alias("p"))

    def bits(self, wanted: DataFrame) -> DataFrame:
        """wanted, which has (model, key), with bits float."""
        p = self.probability(wanted.select("model", "key"))
        return wanted.join(p.select("model", "key", (-F.log2(F.greatest("p", F.lit(1e-9)))).cast("float").alias("bits")), ["model", "key"])


def perplexities(models: dict[str, KneserNey], names: list[str], of: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]:
    """Sum of the bits of each text and its number of characters, 0 and 0 without a model; the text's n-grams that are not held, and how often it has them."""
    found, bounds = keys(data, offsets)
    n = np.diff(bounds)
    bits, each, scored = np.zeros(len(found)), np.repeat(of, n), np.zeros(len(n), bool)
    for x in np.unique(of[n > 0]).tolist():
        if model := models.get(names[x]) or models.get(POOLED):
            mine = each == x
            bits[mine] = model.bits(found[mine])
            scored |= of == x
    at = np.flatnonzero(np.isnan(bits))
    bits[at] = 0
    text = np.repeat(np.arange(len(n)), n)[at]
    order = np.lexsort((found[at], text))
    text, gram = text[order], found[at][order]
    first = np.flatnonzero(np.r_[True, (text[1:] != text[:-1]) | (gram[1:] != gram[:-1])][: len(text)])
    ends = pa.array(np.r_[0, np.cumsum(np.bincount(text[first], minlength=len(n)))].astype(np.int32))
    rest = pa.array(gram[first].view(np.int64)), pa.array(np.diff(np.r_[first, len(text)]).astype(np.int64))
    return features.sums(bits, bounds), n * scored, *(pa.ListArray.from_arrays(ends, x) for x in rest)


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of the texts."""
    starts, ends, wb = K.words(data, offsets)
    n = np.diff(wb)
    total = lambda x: np.diff(np.r_[0, np.cumsum(x)][offsets])
    docs = len(n)

    def again(h, doc):  # whether h is found more than once in its text, and whether earlier
        key = K.mix(h + doc.astype(np.uint64) * K.seeds(1, 33)[0])
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        more, before = np.zeros(len(h), bool), np.zeros(len(h), bool)
        more[order[1:]] = before[order[1:]] = same
        more[order[:-1]] |= same
        return more, before

    line = data != 10
    ls, le, lb = K.words(data, offsets, np.arange(256) != 10)
    has_word = np.searchsorted(starts, le) > np.searchsorted(starts, ls)
    ls, le, of = ls[has_word], le[has_word], np.repeat(np.arange(docs), np.diff(lb))[has_word]
    _, dup = again(K.word_hashes(data, ls, le, _RAW), of)
    h = K.word_hashes(data, starts, ends, _RAW)
    full = np.zeros(0, np.uint64)
    covered = np.zeros(len(h) + 1, np.int64)
    if len(h) >= WINDOW:
        c = K.seeds(WINDOW, 32)
        full = sum(h[k : len(h) - WINDOW + 1 + k] * c[k] for k in range(WINDOW))
        of_word = np.repeat(np.arange(docs), n)
        at = np.flatnonzero(of_word[: len(full)] == of_word[WINDOW - 1 :])
        more, _ = again(full[at], of_word[at])
        covered[at[more]] += 1
        covered[at[more] + WINDOW] -= 1
    repeat = np.diff(np.r_[0, np.cumsum(np.cumsum(covered[:-1]) > 0)][wb])
    return np.stack([n, total(K.WORD[data] & ((data & 0xC0) != 0x80)), total(_SYMBOL[data] & line), np.bincount(of[dup], minlength=docs), repeat]).astype(np.int64)


def base_failed(c: np.ndarray) -> np.ndarray:
    """Of the columns that counts() gives."""
    return (c[0] < 10) | (100 * c[4] > 20 * c[0])


def teaching(c: np.ndarray) -> np.ndarray:
    """Whether texts teach the model, of the columns that counts() gives."""
    return ~base_failed(c) & (100 * c[2] <= FEW * c[1])


def _score(batches: Iterator[pa.RecordBatch], shared, whole: bool) -> Iterator[pa.RecordBatch]:
    """Columns lang, text, then any; the figures stand before the others. Unless the models are whole, what is not held comes as well."""
    for batch in batches:
        names, of = _by_language(batch.column(0))
        data, offsets = utf8(batch.column(1))
        for i, j in pieces(offsets):
            part, o = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            c = counts(part, o)
            bits, n, *rest = perplexities(shared.value, names, of[i:j], part, o)
            if whole:
                bits, rest = np.round(bits / np.maximum(n, 1), 9), []
            own = [names[x] if names[x] in shared.value else POOLED for x in of[i:j].tolist()]
            cols = [*map(pa.array, c), pa.array(own, pa.string()), pa.array(bits), pa.array(n.astype(np.int64)), pa.array(teaching(c))]
            others = [x.slice(i, j - i) for x in batch.columns[2:]]
            yield pa.record_batch([*cols, *rest, *others], names=[*COUNTS, *SCORES, *REST[: len(rest)], *(f"c{k}" for k in range(len(others)))])


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SCORES = ["_model", "_bits", "_chars", "_teaches"]
REST = ["_grams", "_times"]
NAMES = [*COUNTS, "perplexity", "base_failed", "kept", "judged"]


def shares(sizes: dict[str, int], most: int) -> dict[str, int]:
    """How many n-grams of each model are held: up to an even share of half of most for each, and of what is left parts by the roots of what the others have more."""
    floor = most // (2 * max(1, len(sizes)))
    out = {x: min(n, floor) for x, n in sizes.items()}
    left, room = {x: n - floor for x, n in sizes.items() if n > floor}, most - sum(out.values())
    while left:
        total = sum(n**0.5 for n in left.values())
        part = {x: int(room * n**0.5 / total) for x, n in left.items()}
        small = {x: n for x, n in left.items() if n <= part[x]}
        for x, n in (small or part).items():
            out[x] += n
            room -= n
            del left[x]
    return out


def learn(texts: DataFrame, most: int = KEYS) -> tuple[dict[str, KneserNey], Levels | None]:
    """The models of texts(lang, text), of most n-grams in all, and the tables of those that are not whole."""
    counted = in_batches(texts, _count, "lang string, key long, number long").groupBy("lang", "key").agg(F.sum("number").alias("number"))
    counted = durable(counted)
    total = counted.agg(F.sum("number")).first()[0] or 0
    # bounded: fewer than LANGUAGES languages have so many
    own = [r.lang for r in counted.groupBy("lang").agg(F.sum("number").alias("n")).where((F.col("n") >= POOL) & (F.col("n") * LANGUAGES > total)).select("lang").collect()]
    spark = texts.sparkSession
    named = counted.join(F.broadcast(spark.createDataFrame([(x, x) for x in own], "lang string, model string")), "lang", "left").withColumn("model", F.coalesce("model", F.lit(POOLED)))
    named = named.groupBy("model", "key").agg(F.sum("number").alias("number"))
    sizes: dict[str, dict[int, int]] = {}
    for r in named.groupBy("model", F.floor(F.log2("number")).alias("power")).agg(F.count("*").alias("n")).collect():  # bounded: at most 63 powers for each model
        sizes.setdefault(r.model, {})[r.power] = r.n
    part = shares({x: sum(s.values()) for x, s in sizes.items()}, most)
    power = {x: next(k for k in range(65) if sum(n for p, n in s.items() if p >= k) <= part[x]) for x, s in sizes.items()}
    of_power = lambda some: F.broadcast(spark.createDataFrame([(x, 1 << min(k, 62)) for x, k in some.items()], "model string, least long"))  # noqa: E731  bounded: a row for each model
    whole, cut = {x: 0 for x, k in power.items() if not k}, {x: k for x, k in power.items() if k}
    models: dict[str, KneserNey] = {}
    if whole:
        t = named.join(of_power(whole), "model").select("model", "key", "number").toArrow()  # bounded: most rows
        names, of = _by_language(t["model"].combine_chunks())
        key, number = (np.asarray(t[c].combine_chunks()) for c in ("key", "number"))
        models = {name: KneserNey(key[of == x].view(np.uint64), number[of == x]) for x, name in enumerate(names)}
    if not cut:
        return models, None
    large = durable(named.join(of_power(cut), "model"))
    levels = Levels(large)
    t = levels.bits(large.where("number >= least").select("model", "key")).toArrow()  # bounded: most rows
    names, of = _by_language(t["model"].combine_chunks())
    key, bits = (np.asarray(t[c].combine_chunks()) for c in ("key", "bits"))
    place = {name: x for x, name in enumerate(names)}
    return models | {name: Held(key[of == place.get(name, -1)].view(np.uint64), bits[of == place.get(name, -1)]) for name in cut}, levels


def train(texts: DataFrame, most: int = KEYS) -> dict[str, KneserNey]:
    """What the driver holds of the models of texts(lang, text): most n-grams in all."""
    return learn(texts, most)[0]


def narrowest_half(numbers: np.ndarray) -> tuple[int, int, int]:
    """First step, median and last step of the narrowest range that holds half of a histogram, the lowest of equal ones."""
    before = np.r_[0, np.cumsum(numbers)]
    half = (before[-1] + 1) // 2
    last = np.searchsorted(before, before[:-1] + half) - 1
    width = np.where(last < len(numbers), last - np.arange(len(numbers)), len(numbers))
    i = int(np.argmin(width))
    mid = np.searchsorted(before, (before[i] + before[last[i] + 1] + 1) // 2) - 1
    return i, int(mid), int(last[i])


def find_bands(scored: DataFrame, lower: float, upper: float) -> DataFrame:
    """(_model, _low, _mid, _high), in bits a character, from a histogram of the texts that teach a model."""
    step = F.least(F.floor(F.col("_bits") / STEP), F.lit(STEPS - 1)).cast("int")
    t = scored.where("_teaches and _chars > 0").groupBy("_model", step.alias("step")).agg(F.count("*").alias("number")).toArrow()  # bounded: STEPS rows for each model
    names, of = _by_language(t["_model"].combine_chunks())
    k, c = (np.asarray(t[x].combine_chunks()) for x in ("step", "number"))
    rows = []
    for x, name in enumerate(names):
        q1, mid, q3 = (s * STEP for s in narrowest_half(np.bincount(k[of == x], c[of == x], STEPS).astype(np.int64)))
        spread = (q3 - q1) / 2
        rows.append((name, mid - max(MARGIN, lower * spread), mid, mid + max(MARGIN, upper * spread)))
    return scored.sparkSession.createDataFrame(rows, "_model string, _low double, _mid double, _high double")


def scores(docs: DataFrame, shared, columns: list[str], text: str, lang: str, whole: bool = True) -> DataFrame:
    """COUNTS and SCORES of every row, then its columns as c0, c1, ...; unless the models are whole, with REST and sums in place of means."""
    base = docs.select(language(F.col(lang)).alias("lang"), F.col(text).alias("text"), *(F.col(c).alias(f"c{k}") for k, c in enumerate(columns)))
    own = [T.StructField("_model", T.StringType()), T.StructField("_bits", T.DoubleType()), T.StructField("_chars", T.LongType()), T.StructField("_teaches", T.BooleanType())]
    rest = [] if whole else [T.StructField(x, T.ArrayType(T.LongType())) for x in REST]
    schema = T.StructType([*(T.StructField(x, T.LongType()) for x in COUNTS), *own, *rest, *base.schema.fields[2:]])
    return in_batches(base, lambda it: _score(it, shared, whole), schema)


def completed(scored: DataFrame, levels: Levels) -> DataFrame:
    """scores() of models that are not whole, with the bits of what was not held."""
    rows = durable(scored.withColumn("_row", F.monotonically_increasing_id()))
    each = rows.select("_row", F.col("_model").alias("model"), F.explode(F.arrays_zip(*REST)).alias("x")).select("_row", "model", F.col("x._grams").alias("key"), F.col("x._times").alias("times"))
    bits = durable(levels.bits(durable(each.groupBy("model", "key").agg(F.count("*").alias("texts")))))
    # what many texts share that teach no model, such as lines of one symbol, is met in a broadcast
    more = meet(each, bits, ["model", "key"], "texts").groupBy("_row").agg(F.sum(F.col("bits") * F.col("times")).alias("_more"))
    mean = F.round((F.col("_bits") + F.coalesce("_more", F.lit(0.0))) / F.greatest("_chars", F.lit(1)), 9)
    return durable(rows.drop(*REST).join(more, "_row", "left").withColumn("_bits", mean).drop("_row", "_more"))


def verdicts(scored: DataFrame, bands: DataFrame) -> DataFrame:
    """scored with perplexity, base_failed, kept, and judged: whether there was a model to judge by, without which the base rules decide alone."""
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    smooth = F.col("_mid") + (F.col("_bits") - F.col("_mid")) * F.col("_chars") / (F.col("_chars") + PRIOR)
    inside = F.coalesce((smooth >= F.col("_low")) & (smooth <= F.col("_high")), F.lit(True)) | (F.col("_chars") == 0)
    # bounded: one row for each model
    out = scored.join(F.broadcast(bands), "_model", "left")
    return out.withColumns({"perplexity": F.round(F.pow(F.lit(2.0), "_bits"), 6), "base_failed": failed, "kept": ~failed & inside, "judged": F.col("_chars") > 0})


def trained(docs: DataFrame, text: str, lang: str, most: int = KEYS):
    """What is held of the models of docs, shared with the executors."""
    return _trained(docs, text, lang, most)[0]


def _trained(docs: DataFrame, text: str, lang: str, most: int) -> tuple:
    models, levels = learn(docs.select(language(F.col(lang)).alias("lang"), F.col(text).alias("text")), most)
    return docs.sparkSession.sparkContext.broadcast(models), levels


def quality_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", lower: float = LOWER, upper: float = UPPER, most: int = KEYS) -> DataFrame:
    """(doc_id, NAMES) of every row of docs.

    kept is false where base_failed, or where the perplexity is outside its language's band. Null
    and empty texts have no words and fail the base rules; a null language is one of its own. Each
    row counts and is judged: repeated rows and null ids get rows of their own. An empty table
    gives an empty result; other columns are not carried.
    """
    shared, levels = _trained(docs, text, lang, most)
    scored = scores(docs, shared, [doc_id], text, lang, levels is None)
    scored = completed(scored, levels) if levels else durable(scored)
    return verdicts(scored, find_bands(scored, lower, upper)).select(F.col("c0").alias(doc_id), *NAMES)


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", most: int = KEYS) -> DataFrame:
    """docs without the rows that quality_rules rejects.

    Null and empty texts go, as do all rows that fail the base rules; equal rows stay or go
    together; an empty table gives an empty result. All columns are carried, whatever their names.
    """
    d, t, x = numbered(docs), number(docs, text), number(docs, lang)
    shared, levels = _trained(d, t, x, most)
    if levels:
        scored = completed(scores(d, shared, d.columns, t, x, False), levels)
        bands = find_bands(scored, LOWER, UPPER)
    else:
        scored = scores(d, shared, d.columns, t, x)
        bands = find_bands(scores(d, shared, [], t, x), LOWER, UPPER)
    out = verdicts(scored, bands).where("kept")
    return out.select(*d.columns).toDF(*docs.columns)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts, perplexity and verdict of every document."""
    return quality_rules(table(spark, sf_dir, "documents"))

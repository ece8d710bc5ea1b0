"""Global alignment of a noisy timed word stream with a clean text, one document a group.

The dynamic program over two word lists is the one operator here that built-in expressions can't
hold; it runs as a grouped Arrow function. Cells are computed by diagonals, whose cells do not depend on
each other, each with the very floating-point steps of the cell-by-cell recurrence. Memory is linear:
moves are kept for a strip of rows at a time. Strips are entered again from rows of scores that were kept
on the way down, a few for each level, and the way back goes through them from the last to the first.
Short documents go together: diagonals of many of them are one matrix, with the same steps for each cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GAP, BONUS, NEAR, MARKED = -0.5, 2.0, 1.0, 1.0
TRUTH = 5.0
#: Moves that are kept at once, scores of the parts that a longer stretch is cut into (PARTS at most), and similarities that are held at once.
CELLS, SCORES, PARTS, TABLE = 1 << 27, 1 << 24, 128, 1 << 22

#: Rows of words after which a batch is given out.
ROWS = 1 << 13
#: Cells up to which a document goes with others, cells and words that wait, cells of those that go together, pairs of words compared at once, characters of a word.
SMALL, POOL, WORDS, TOGETHER, CHUNK, SHORT = 1 << 17, 1 << 22, 1 << 16, 1 << 19, 1 << 13, 63


def edit_distance(a: str, b: str) -> int:
    """Levenshtein distance, in characters."""
    if len(a) < len(b):
        a, b = b, a
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def similarity(a: str, b: str) -> float:
    longest = max(len(a), len(b))
    return 1.0 if not longest else 1.0 - edit_distance(a.lower(), b.lower()) / longest


def similarities(a: list[str], b: list[str]) -> np.ndarray:
    """similarity() of every word of a with every word of b, all at once.

    Columns of the edit tables are kept as bits of a word of a (Myers 1999; Hyyro 2003), so a step
    over one character of all words of b is a few operations on a matrix; words of over 63
    characters are compared one by one.
    """
    low_a, low_b = [x.lower() for x in a], [x.lower() for x in b]
    out = np.empty((len(a), len(b)))
    short_a, short_b = ([k for k, x in enumerate(w) if len(x) < 64] for w in (low_a, low_b))
    if short_a and short_b:
        number = {c: k for k, c in enumerate(sorted(set("".join(low_b[k] for k in short_b))))}
        equal = np.zeros((len(short_a), len(number) + 1), np.uint64)
        for r, k in enumerate(short_a):
            for i, c in enumerate(low_a[k]):
                if c in number:
                    equal[r, number[c]] |= np.uint64(1 << i)
        sizes = np.array([len(low_b[k]) for k in short_b])
        codes = np.full((len(short_b), max(1, sizes.max())), len(number))
        for r, k in enumerate(short_b):
            codes[r, : sizes[r]] = [number[c] for c in low_b[k]]
        length = np.array([len(low_a[k]) for k in short_a])
        last = np.where(length > 0, np.uint64(1) << np.maximum(length - 1, 0).astype(np.uint64), np.uint64(0))[:, None]
        score = np.repeat(length[:, None], len(short_b), axis=1)
        up, down = np.full(score.shape, ~np.uint64(0)), np.zeros(score.shape, np.uint64)
        one = np.uint64(1)
        for j in range(sizes.max()):
            e = equal[:, codes[:, j]]
            vertical = e | down
            across = (((e & up) + up) ^ up) | e
            more, less = down | ~(across | up), up & across
            score += ((more & last != 0).astype(int) - (less & last != 0)) * (sizes > j)
            more, less = more << one | one, less << one
            up, down = less | ~(vertical | more), more & vertical
        score[length == 0] = sizes
        out[np.ix_(short_a, short_b)] = score
    long_b = [j for j in range(len(b)) if len(low_b[j]) > 63]
    for i in range(len(a)):
        for j in range(len(b)) if len(low_a[i]) > 63 else long_b:
            out[i, j] = edit_distance(low_a[i], low_b[j])
    longest = np.maximum(np.array([len(x) for x in a])[:, None], np.array([len(y) for y in b])[None, :]) if len(a) and len(b) else out
    return np.where(longest == 0, 1.0, 1.0 - out / np.maximum(longest, 1))


class _Grid:
    """The score table of heard words (rows) and words (columns), a strip of rows at a time."""

    def __init__(self, heard: list[tuple[str, float | None, float | None]], words: list[str], markers: dict[int, float]):
        self.n = len(words)
        kinds_a, kinds_b = sorted({h[0] for h in heard}), sorted(set(words))
        number = lambda kinds, own: np.array(list(map({w: k for k, w in enumerate(kinds)}.__getitem__, own)), np.int64)
        self.at_a, self.at_b = number(kinds_a, [h[0] for h in heard]), number(kinds_b, words)
        self.kinds_a, self.kinds_b = kinds_a, kinds_b
        self.start = np.array([np.nan if h[1] is None else h[1] for h in heard], np.float64)
        self.mark = np.full(self.n, np.nan)
        for j, t in markers.items():
            if 0 <= j < self.n:
                self.mark[j] = t
        self.marked = bool((~np.isnan(self.mark)).any())
        whole = len(kinds_a) * len(kinds_b) <= TABLE
        self.table = similarities(kinds_a, kinds_b) if whole else None
        #: Rows whose similarities are held at once.
        self.rows = len(heard) if whole else max(1, TABLE // max(1, len(kinds_b)))

    def similarity(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """(table, rows): similarities of the rows' words with all kinds of words, and each row's place in it."""
        if self.table is not None:
            return self.table, self.at_a[low:high]
        kinds, own = np.unique(self.at_a[low:high], return_inverse=True)
        return similarities([self.kinds_a[k] for k in kinds.tolist()], self.kinds_b), own

    def strip(self, low: int, high: int, top: np.ndarray, moves: bool) -> tuple[np.ndarray, np.ndarray | None]:
        """(scores of row high, moves or None) for the columns of top, the scores of row low.

        A move is 0 for a match, 1 for a heard word left out, 2 for a word without a heard one; the first
        that gives the score counts.
        """
        h, width = high - low, len(top) - 1
        table, own = self.similarity(low, high)
        bottom, kept = np.empty(width + 1), np.empty((h, width), np.uint8) if moves else None
        bottom[0] = high * GAP
        one, two = np.empty(h + 1), np.empty(h + 1)  # the last diagonal and the one before, by row of the strip
        flat, line = table.ravel(), own * table.shape[1]
        spots = kept.reshape(-1) if moves else None
        for d in range(h + width + 1):
            now = np.empty(h + 1)
            a, b = max(1, d - width), min(h, d - 1)
            if a <= b:  # rows a to b of the strip, columns d - a down to d - b
                across = slice(d - b - 1, d - a)
                like = flat.take(line[a - 1 : b] + self.at_b[across][::-1])
                if self.marked:
                    like = np.where(np.abs(self.mark[across][::-1] - self.start[low + a - 1 : low + b]) < NEAR, like + BONUS, like)
                match, gaps = two[a - 1 : b] + like, one[a - 1 : b + 1] + GAP
                up, left = gaps[:-1], gaps[1:]
                best = np.maximum(up, left)
                now[a : b + 1] = np.maximum(match, best)
                if moves:
                    first = (a - 1) * width + d - a - 1
                    spots[first : first + (b - a) * (width - 1) + 1 : max(1, width - 1)] = np.where(match >= best, 0, (up < left) + np.uint8(1))
            if d <= width:
                now[0] = top[d]
            if d <= h:
                now[d] = (low + d) * GAP if d else top[0]
            if h <= d:
                bottom[d - h] = now[h]
            one, two = now, one
        return bottom, kept

    def back(self, low: int, high: int, top: np.ndarray, j: int, found: np.ndarray) -> int:
        """Goes from (high, j) back to row low; found[j] gets the heard word that j is matched with. Returns the column at row low."""
        if not j or low == high:
            return j
        top = top[: j + 1]
        if high - low <= max(1, min(self.rows, CELLS // j)):
            moves, i = self.strip(low, high, top, True)[1], high - low
            while i and j:
                move = moves[i - 1, j - 1]
                i -= move < 2
                j -= move != 1
                if move == 0:
                    found[j] = low + i
            return j
        base, parts = max(1, min(self.rows, CELLS // j)), min(PARTS, max(2, SCORES // j))
        step = base if high - low <= base * parts else -(-(high - low) // parts)
        tops = [top]
        for k in range(low, high - step, step):
            rest, at = tops[-1], k
            while at < k + step:  # as many rows as similarities are held for
                end = min(at + self.rows, k + step)
                rest, at = self.strip(at, end, rest, False)[0], end
            tops.append(rest)
        for k in reversed(range(len(tops))):
            j = self.back(low + k * step, min(low + (k + 1) * step, high), tops[k], j, found)
        return j


def align(heard: list[tuple[str, float | None, float | None]], words: list[str], markers: dict[int, float] | None = None, least: float = 0.5, truth: float = TRUTH) -> list[tuple[float | None, float | None]]:
    """(start, end) of each of words, from the heard (word, start, end) it is aligned with.

    A match scores the words' similarity, BONUS more where the word has a marker nearer than NEAR
    to the heard start; a word left out on either side costs GAP. Of equal scores a match comes
    before a heard word left out, that before a word without one. A matched word with a marker
    spans MARKED seconds from it, one similar enough takes the heard times; a word without a
    match is timed by its marker alone, for truth seconds.
    """
    markers = markers or {}
    n = len(words)
    found = np.full(n, -1, np.int64)
    if heard and n:
        _Grid(heard, words, markers).back(0, len(heard), np.arange(n + 1) * GAP, n, found)
    like: dict[tuple[str, str], float] = {}
    out: list[tuple[float | None, float | None]] = []
    for j, i in enumerate(found.tolist()):
        t = markers.get(j)
        if t is not None:
            out.append((t, t + (truth if i < 0 else MARKED)))
        elif i < 0:
            out.append((None, None))
        else:
            pair = heard[i][0], words[j]
            if pair not in like:
                like[pair] = similarity(*pair)
            out.append(heard[i][1:] if like[pair] >= least else (None, None))
    return out


def pair_similarities(kinds: list[str], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """similarity() of kinds[a] and kinds[b] for pairs of any number, of words of SHORT characters at most; the steps are those of similarities()."""
    low = [w.lower() for w in kinds]
    size, own = np.array([len(w) for w in low], np.int64), np.array([len(w) for w in kinds], np.int64)
    letters, code = np.unique(np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32), return_inverse=True)
    codes = np.zeros((max(1, size.max(initial=0)), len(kinds)), np.int64)
    start = np.r_[0, np.cumsum(size)][:-1]
    equal = np.zeros((len(kinds), len(letters) + 1), np.uint64)
    for i in range(len(codes)):
        has = np.flatnonzero(size > i)
        codes[i, has] = code[start[has] + i]
        equal[has, codes[i, has]] |= np.uint64(1 << i)
    flat, width, one = equal.ravel(), equal.shape[1], np.uint64(1)
    out = np.empty(len(a))
    order = np.argsort((SHORT - size[b]).astype(np.uint8), kind="stable")  # the longest first, so that those left are the first ones
    for k in range(0, len(order), CHUNK):
        at = order[k : k + CHUNK]
        x, y = a[at], b[at]
        line, steps, last = x * width, size[y], np.maximum(size[x] - 1, 0).astype(np.uint64)
        score = size[x].copy()
        up, down = np.full(len(at), ~np.uint64(0)), np.zeros(len(at), np.uint64)
        for j in range(int(steps[0])):
            n = int(np.searchsorted(-steps, -j))  # of more than j characters
            u, d = up[:n], down[:n]
            e = flat.take(line[:n] + codes[j].take(y[:n]))
            vertical = e | d
            across = (((e & u) + u) ^ u) | e
            more, less = d | ~(across | u), u & across
            score[:n] += (more >> last[:n] & one).astype(np.int64) - (less >> last[:n] & one).astype(np.int64)
            more = more << one | one
            up[:n], down[:n] = less << one | ~(vertical | more), more & vertical
        score = np.where(size[x] == 0, steps, score)
        longest = np.maximum(own[x], own[y])
        out[at] = np.where(longest == 0, 1.0, 1.0 - score / np.maximum(longest, 1))
    return out


def _matched(docs: list[tuple]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(place of the heard word or -1, similarity with it) of each word of documents(heard words, starts, words, markers), none of them empty."""
    ids: dict[str, int] = {}
    number = lambda own: np.array([ids.setdefault(w, len(ids)) for w in own], np.int64)
    n, m = (np.array([len(d[k]) for d in docs], np.int64) for k in (0, 2))
    h, width, every = int(n.max()), int(m.max()), np.arange(len(docs))
    line, across_at = np.zeros((h, len(docs)), np.int64), np.zeros((width, len(docs)), np.int64)
    start, mark = np.full((h, len(docs)), np.nan), np.full((width, len(docs)), np.nan)
    left, right, first = [], [], 0
    for x, (heard, starts, words, markers) in enumerate(docs):
        (a, at_a), (b, at_b) = (np.unique(number(own), return_inverse=True) for own in (heard, words))
        line[: n[x], x], across_at[: m[x], x], start[: n[x], x] = first + at_a * len(b), at_b, starts
        left.append(np.repeat(a, len(b)))
        right.append(np.tile(b, len(a)))
        first += len(a) * len(b)
        for j, t in markers.items():
            if 0 <= j < m[x]:
                mark[j, x] = np.nan if t is None else t
    like = pair_similarities(list(ids), np.concatenate(left), np.concatenate(right))
    marked = bool((~np.isnan(mark)).any())
    moves = np.zeros((h * width, len(docs)), np.uint8)
    one, two = np.empty((h + 1, len(docs))), np.empty((h + 1, len(docs)))
    for d in range(h + width + 1):  # cells beyond a document's own words are filled as well, and never reached from within
        now = np.empty((h + 1, len(docs)))
        a, b = max(1, d - width), min(h, d - 1)
        if a <= b:
            across = slice(d - b - 1, d - a)
            own = like.take(line[a - 1 : b] + across_at[across][::-1])
            if marked:
                own = np.where(np.abs(mark[across][::-1] - start[a - 1 : b]) < NEAR, own + BONUS, own)
            match, gaps = two[a - 1 : b] + own, one[a - 1 : b + 1] + GAP
            up, other = gaps[:-1], gaps[1:]
            best = np.maximum(up, other)
            now[a : b + 1] = np.maximum(match, best)
            at = (a - 1) * width + d - a - 1
            moves[at : at + (b - a) * (width - 1) + 1 : max(1, width - 1)] = np.where(match >= best, 0, (up < other) + np.uint8(1))
        if d <= width:
            now[0] = d * GAP
        if d <= h:
            now[d] = d * GAP
        one, two = now, one
    found = np.full((width, len(docs)), -1, np.int64)
    i, j, who = n.copy(), m.copy(), every
    while len(who):
        move = moves[(i[who] - 1) * width + j[who] - 1, who]
        i[who] -= move < 2
        j[who] -= move != 1
        hit = who[move == 0]
        found[j[hit], hit] = i[hit]
        who = who[(i[who] > 0) & (j[who] > 0)]
    out = []
    for x in every.tolist():
        got = found[: m[x], x]
        out.append((got, like[np.where(got < 0, line[0, x], line[got, x]) + across_at[: m[x], x]]))
    return out


def align_many(docs: list[tuple], least: float = 0.5, truth: float = TRUTH) -> list[list[tuple[float | None, float | None]]]:
    """align() of each of docs(heard words, starts, ends, words, markers); short ones go together, by size."""
    out: list = [None] * len(docs)
    small = []
    for x, (heard, starts, ends, words, markers) in enumerate(docs):
        if 0 < len(heard) * len(words) <= SMALL and max(len(w.lower()) for own in (heard, words) for w in own) <= SHORT:
            small.append(x)
        else:
            out[x] = align(list(zip(heard, starts, ends, strict=True)), words, markers, least, truth)
    size = lambda x: (-(-len(docs[x][0]) // 16), len(docs[x][3]))
    small.sort(key=size)
    at = 0
    while at < len(small):
        end, h, w, total, letters = at, 0, 0, 0, set()
        while end < len(small):  # cells with those that fill up, and letters of words
            heard, words = docs[small[end]][0], docs[small[end]][3]
            h, w, total = max(h, len(heard)), max(w, len(words)), total + len(heard) + len(words)
            letters |= set("".join(heard).lower()) | set("".join(words).lower())
            if end > at and (h * w * (end + 1 - at) > TOGETHER or total * len(letters) > TABLE):
                break
            end += 1
        group = small[at:end]
        nans = [np.array([np.nan if t is None else t for t in docs[x][1]], np.float64) for x in group]
        for x, (found, like) in zip(group, _matched([(docs[x][0], s, docs[x][3], docs[x][4]) for x, s in zip(group, nans, strict=True)]), strict=True):
            _, starts, ends, _, markers = docs[x]
            times = [(starts[i], ends[i]) if i >= 0 and ok else (None, None) for i, ok in zip(found.tolist(), (like >= least).tolist(), strict=True)]
            for j, t in markers.items():
                if t is not None and 0 <= j < len(times):
                    times[j] = t, t + (truth if found[j] < 0 else MARKED)
            out[x] = times
        at = end
    return out


def _documents(least: float, truth: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = batch.schema.field(0).type, pa.int64(), pa.string(), pa.float64(), pa.float64()
            waiting, names, cells, size = [], [], 0, 0
            columns: list[list] = [[] for _ in kinds]
            for at in range(batch.num_rows):  # a bounded number of words becomes Python objects
                doc, heard, words, markers = (batch.column(k)[at] for k in range(4))
                own = [x.to_pylist() for x in heard.values.flatten()] if heard.is_valid else [[], [], []]
                waiting.append((*own, words.as_py() or [], {x["word_idx"]: x["ts"] for x in markers.as_py() or ()}))
                names.append(doc.as_py())
                cells, size = cells + len(own[0]) * len(waiting[-1][3]), size + len(own[0]) + len(waiting[-1][3])
                if cells < POOL and size < WORDS and at + 1 < batch.num_rows:
                    continue
                for name, x, times in zip(names, waiting, align_many(waiting, least, truth), strict=True):
                    for part, more in zip(columns, ([name] * len(times), range(len(times)), x[3], (t[0] for t in times), (t[1] for t in times)), strict=True):
                        part.extend(more)
                    if len(columns[0]) >= ROWS:
                        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], NAMES)
                        columns = [[] for _ in kinds]
                waiting, names, cells, size = [], [], 0, 0
            if columns[0]:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], NAMES)

    return run


NAMES = ["doc_id", "word_idx", "word", "start_s", "end_s"]


def align_words(heard: DataFrame, texts: DataFrame, markers: DataFrame | None = None, least: float = 0.5, truth: float = TRUTH) -> DataFrame:
    """(doc_id, word_idx, word, start_s, end_s): a row for each word of texts(doc_id, words), in order.

    heard(doc_id, word_idx, word, start_s, end_s) and markers(doc_id, word_idx, ts) are gathered by
    document, the unit that an alignment needs whole; a document without heard words has null times.
    """
    own = heard.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("word_idx", "word", "start_s", "end_s"))), lambda x: F.struct(x["word"].alias("word"), x["start_s"].cast("double").alias("start_s"), x["end_s"].cast("double").alias("end_s"))).alias("heard"))
    df = texts.select("doc_id", "words").join(own, "doc_id", "left")
    if markers is None:
        df = df.withColumn("markers", F.lit(None).cast("array<struct<word_idx:bigint,ts:double>>"))
    else:
        df = df.join(markers.groupBy("doc_id").agg(F.collect_list(F.struct(F.col("word_idx").cast("bigint").alias("word_idx"), F.col("ts").cast("double").alias("ts"))).alias("markers")), "doc_id", "left")
    kind = dict(texts.dtypes)["doc_id"]
    # the work is in the tables, not in the bytes by which small partitions would be merged; by a hash, as by doc_id the join's own merged ones would do
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.select("doc_id", "heard", "words", "markers").repartition(parts, F.xxhash64("doc_id")).mapInArrow(_documents(least, truth), f"doc_id {kind}, word_idx long, word string, start_s double, end_s double")

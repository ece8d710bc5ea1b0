"""Closed forms against plain loops, and golden values."""

import random

import pytest
from cantolith.operators import alignment, matching, quality, timeline

WORDS = "doc_id long, word_idx long, word string, start_s double, end_s double"


def words(seed, docs=25, n=30):
    r = random.Random(seed)
    out = []
    for d in range(docs):
        t = 0.0
        for i in range(r.randrange(0, n)):
            t += r.choice([-3, 0, 1, 2, 9, 40])
            timed = r.random() < 0.6
            out.append((d, i, "w", float(t) if timed else None, float(t + r.randrange(0, 5)) if timed else None))
    return out


def by_doc(rows):
    out = {}
    for x in sorted(rows):
        out.setdefault(x[0], []).append(list(x))
    return out


def collected(df):
    return by_doc([tuple(r) for r in df.select("doc_id", "word_idx", "word", "start_s", "end_s").collect()])


def test_interpolate(spark):
    rows = words(1) + [(90, 0, "a", 0.0, 1.0), (90, 1, "b", None, None), (90, 2, "c", None, None), (90, 3, "d", 4.0, 5.0), (91, 0, "a", 0.0, 1.0), (91, 1, "b", None, None), (91, 2, "c", 30.0, 31.0)]
    want = by_doc(rows)
    for ws in want.values():
        known = [k for k, w in enumerate(ws) if w[3] is not None]
        for p, n in zip(known, known[1:], strict=False):
            gap = ws[n][3] - ws[p][4]
            if n - p > 1 and gap <= 20:
                step = gap / (n - p)
                for k in range(1, n - p):
                    ws[p + k][3:] = [ws[p][4] + (k - 1) * step, ws[p][4] + k * step]
    got = collected(timeline.interpolate(spark.createDataFrame(rows, WORDS)))
    assert got[90][1][3:] == [1.0, 2.0] and got[90][2][3:] == [2.0, 3.0] and got[91][1][3:] == [None, None]
    for d, ws in want.items():
        for a, b in zip(ws, got[d], strict=True):
            assert a[3:] == pytest.approx(b[3:], abs=1e-9) if a[3] is not None else b[3] is None


def test_monotonic_words(spark):
    rows = words(2) + [(90, 0, "a", 0.0, 5.0), (90, 1, "b", 3.0, 4.0), (90, 2, "c", 10.0, 11.0)]
    want = by_doc(rows)
    for ws in want.values():
        last = float("-inf")
        for w in ws:
            if w[3] is not None:
                if w[3] < last:
                    w[3:] = [last, last + w[4] - w[3]]
                last = w[4]
    got = collected(timeline.monotonic_words(spark.createDataFrame(rows, WORDS)))
    assert got == want and got[90][1][3:] == [5.0, 6.0]


def test_active(spark):
    rows = words(3)
    ws = by_doc(rows)
    df = spark.createDataFrame(rows, WORDS)
    ticks = timeline.grid(spark.createDataFrame([(d, 100.0) for d in range(25)], "doc_id long, total_s double"), 0.5)
    assert ticks.where("doc_id = 0").count() == 200
    got = {(r.doc_id, r.tick): r.word_idx for r in timeline.active(ticks, df, 8.0, 7.0, 10.0).collect()}
    for (d, k), w in got.items():
        t = k * 0.5
        own = [x for x in ws.get(d, []) if x[3] is not None]
        inside = [x[1] for x in own if x[3] <= t <= x[4]]
        ended = sorted((-x[4], x[1]) for x in own if x[4] <= t)
        want = -1 if t < 10 else inside[0] if inside else ended[0][1] if ended and t + ended[0][0] <= 8 else None
        assert w == want, (d, t)
    plan = timeline.active(ticks, df, 8.0, 7.0)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("block", [3, 1 << 14])
@pytest.mark.parametrize("step", [0.7, 2.5])
def test_active_runs_equal_active(spark, block, step):
    """The grid's words as runs, with ends between and on ticks, before 0 and long gone."""
    rows = [(d, k, w, None if a is None else a - 5, None if b is None else b - 5) for d, k, w, a, b in words(3)]
    df = spark.createDataFrame(rows, WORDS)
    totals = spark.createDataFrame([(d, 100.0 if d % 3 else float(d)) for d in range(25)], "doc_id long, total_s double")
    runs = timeline.active_runs(totals, df, step, 4.0, block)
    want = timeline.active(timeline.grid(totals, step), df, 4.0, 7.0)
    assert sorted(map(tuple, timeline.ticks(runs, step).collect()), key=str) == sorted(map(tuple, want.collect()), key=str) and want.count() > 500
    repaired = lambda x: timeline.fill_between(timeline.monotonic_frames(x, block=block), block=block)
    assert sorted(map(tuple, timeline.ticks(repaired(runs), step).collect()), key=str) == sorted(map(tuple, repaired(want).collect()), key=str)


@pytest.mark.parametrize("block", [2, 1 << 14])
def test_repairs_by_the_runs_own_blocks(spark, block):
    """The column of blocks gives what blocks of ticks give; words of no document and totals of none make no run."""
    rows = [(d or None, k, w, a, b) for d, k, w, a, b in words(5)]
    totals = spark.createDataFrame([(d or None, float(4 * d + 4)) for d in range(24)], "doc_id long, total_s double")
    runs = timeline.active_runs(totals, spark.createDataFrame(rows, WORDS), 2.5, 4.0, block)
    own = timeline.fill_between(timeline.monotonic_frames(runs, block="block"), block="block")
    want = timeline.fill_between(timeline.monotonic_frames(runs))
    got = sorted(map(tuple, own.collect()), key=str)
    assert got == sorted(map(tuple, want.collect()), key=str) and len(got) > 50 and all(x[0] for x in got)


@pytest.mark.parametrize("name", ["timeline_monotonic", "time_grid_active"])
def test_marks_of_a_grid_are_shuffled_once(spark, name):
    """Events by document and marks by document and block, each once, whether states are broadcast or joined."""
    from cantolith.plans import registry

    sc = spark.sparkContext._jsc.sc()

    def shuffled(threshold):
        stages = lambda: (sc.listenerBus().waitUntilEmpty(), sc.statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None))[1]
        seen = stages()
        last = max((seen.apply(k).stageId() for k in range(seen.size())), default=-1)
        held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            registry.QUERIES[name](spark, "/root/testdata/sf0.01").write.format("noop").mode("overwrite").save()
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
        new = stages()
        return sum(new.apply(k).shuffleWriteRecords() for k in range(new.size()) if new.apply(k).stageId() > last)

    few, many = shuffled("10MB"), shuffled("-1")
    assert 10_000 < few <= many < 1.1 * few, (few, many)


def test_frames(spark):
    frames = lambda x: spark.createDataFrame([(1, k, v) for k, v in enumerate(x)], "doc_id long, tick long, word_idx long")
    out = lambda df: [r.word_idx for r in df.orderBy("tick").collect()]
    assert out(timeline.fill_between(frames([None, 5, None, None, 5, None]))) == [None, 5, 5, 5, 5, None]
    assert out(timeline.fill_between(frames([1, None, 2, None, 2]))) == [1, None, 2, 2, 2]
    assert out(timeline.monotonic_frames(frames([3, 1, None, 4, 2]))) == [3, 3, None, 4, 4]
    order = spark.createDataFrame([(4, 0), (1, 1), (3, 2)], "word_idx long, pos long")
    assert out(timeline.monotonic_frames(frames([4, 3, 1, 9]), order)) == [4, 3, 3, 3]


def test_absolute_and_blank(spark):
    segs = spark.createDataFrame([(1, 1, 10, ["a"]), (1, 2, 5, ["b"]), (1, 3, 7, ["c"])], "doc_id long, seg_id long, duration long, words array<string>")
    blank = timeline.blank_segments(segs, spark.createDataFrame([(1, 2)], "doc_id long, seg_id long"))
    assert {r.seg_id: r.words for r in blank.collect()} == {1: ["a"], 2: [], 3: ["c"]}
    w = spark.createDataFrame([(1, 3, 1.0, 2.0)], "doc_id long, seg_id long, start_s double, end_s double")
    assert tuple(timeline.absolute(w, blank).select("start_s", "end_s").first()) == (16.0, 17.0)


def test_low_runs(spark):
    timed = [1] * 30 + [0] * 12 + [1] * 20 + [0] * 9
    rows = [(1, k, "w", 1.0 if x else None, 2.0 if x else None) for k, x in enumerate(timed)]
    width, margin, least = 5, 0.2, 4
    avg = sum(timed) / len(timed)
    low = [sum(timed[k : k + width]) / width < avg - margin - 1e-9 for k in range(len(timed) - width + 1)]
    runs, k = [], 0
    while k < len(low):
        if low[k]:
            e = k
            while e < len(low) and low[e]:
                e += 1
            if e - k >= least:
                runs.append((1, k, e))
            k = e
        k += 1
    assert sorted(tuple(r) for r in quality.low_runs(spark.createDataFrame(rows, WORDS), width, margin, least).collect()) == runs and runs
    for block in (1, 3, 8):  # also where a window is longer than a block
        assert sorted(tuple(r) for r in quality.low_runs(spark.createDataFrame(rows, WORDS), width, margin, least, block).collect()) == runs


def plain_align(heard, words, markers, least):
    """The full score table, cell by cell."""
    m, n = len(heard), len(words)
    sim = lambda i, j: alignment.similarity(heard[i][0], words[j])
    s = [[0.0] * (n + 1) for _ in range(m + 1)]
    mv = [["i"] * (n + 1) for _ in range(m + 1)]
    for i in range(m + 1):
        for j in range(n + 1):
            if i == 0 or j == 0:
                s[i][j], mv[i][j] = (i + j) * -0.5, "i" if i == 0 else "d"
                continue
            x = sim(i - 1, j - 1)
            if j - 1 in markers and heard[i - 1][1] is not None and abs(markers[j - 1] - heard[i - 1][1]) < 1.0:
                x += 2.0
            a, b, c = s[i - 1][j - 1] + x, s[i - 1][j] - 0.5, s[i][j - 1] - 0.5
            s[i][j] = max(a, b, c)
            mv[i][j] = "m" if a >= b and a >= c else "d" if b >= c else "i"
    out, i, j = [(None, None)] * n, m, n
    while j > 0:
        k = mv[i][j]
        if k == "d":
            i -= 1
            continue
        t = markers.get(j - 1)
        if k == "m":
            i -= 1
            out[j - 1] = (t, t + 1.0) if t is not None else heard[i][1:] if sim(i, j - 1) >= least else (None, None)
        elif t is not None:
            out[j - 1] = (t, t + 5.0)
        j -= 1
    return out


def test_align_equals_the_full_table(spark):
    r = random.Random(6)
    vocab = ["la", "Las", "gran", "grane", "so", "sol", "é", "x"]
    docs = []
    for d in range(120):
        ws = [r.choice(vocab) for _ in range(r.randrange(0, 12))]
        heard = [(w if r.random() < 0.7 else r.choice(vocab), float(k), k + 0.5) for k, w in enumerate(ws) if r.random() < 0.8]
        marks = {r.randrange(len(ws)): float(r.randrange(0, 10)) for _ in range(r.randrange(0, 3))} if ws else {}
        docs.append((d, heard, ws, marks))
        assert alignment.align(heard, ws, marks, 0.3) == plain_align(heard, ws, marks, 0.3)
    h = spark.createDataFrame([(d, k, *x) for d, heard, _, _ in docs for k, x in enumerate(heard)], WORDS)
    t = spark.createDataFrame([(d, ws) for d, _, ws, _ in docs], "doc_id long, words array<string>")
    m = spark.createDataFrame([(d, j, ts) for d, _, _, marks in docs for j, ts in marks.items()], "doc_id long, word_idx long, ts double")
    got = {(x.doc_id, x.word_idx): (x.start_s, x.end_s) for x in alignment.align_words(h, t, m, 0.3).collect()}
    assert got == {(d, k): v for d, heard, ws, marks in docs for k, v in enumerate(plain_align(heard, ws, marks, 0.3))}


def test_similarities_equal_the_plain_ones():
    r = random.Random(8)
    w = ["", "É", "a" * 70, *("".join(r.choice("abcÉé") for _ in range(r.randrange(1, 64))) for _ in range(60))]
    got = alignment.similarities(w, w[::-1])
    for i, a in enumerate(w):
        for j, b in enumerate(w[::-1]):
            assert got[i, j] == alignment.similarity(a, b)
    assert alignment.similarities([], ["a"]).shape == (0, 1)


def test_align_query_equals_the_full_table(spark, sf):
    from cantolith.plans import registry

    turns = {}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        turns[r.conv_id, r.turn] = r.text.split()
    got = {(x.doc_id, x.word_idx): (x.word, x.start_s, x.end_s) for x in registry.QUERIES["align_words"](spark, sf).collect()}
    want = {}
    for (c, t), words in turns.items():
        after = turns.get((c, t + 1))
        if after is not None:
            heard = [(w, float(k), k + 1.0) for k, w in enumerate(words)]
            for k, (w, v) in enumerate(zip(after, plain_align(heard, after, {}, 0.3), strict=True)):
                want[c * 1000 + t, k] = (w, *v)
    assert got == want and want


def test_fuzzy_lookup_and_names(spark):
    cards = matching.cards_of(spark.createDataFrame([("c/Don_Jose.png",), ("c/carmen.JPG",), ("c/notes.txt",), ("c/don.png",)], "path string"))
    assert {r.stem for r in cards.collect()} == {"don_jose", "carmen", "don"}
    names = spark.createDataFrame([(" Carmen ",), ("Don José",), ("DON-JOSE",), ("Micaela",), ("?",), ("car",)], "name string")
    got = {r.name: r.path for r in matching.fuzzy_lookup(names, cards).collect()}
    assert got == {" Carmen ": "c/carmen.JPG", "Don José": "c/don.png", "DON-JOSE": "c/don.png", "Micaela": None, "?": "c/carmen.JPG", "car": "c/carmen.JPG"}
    df = spark.createDataFrame([("b", 2, "x"), ("a", 1, "x"), ("c", 3, "y")], "v string, o long, k string")
    assert [r.v for r in matching.first_distinct(df, "k", ["o"]).orderBy("o").collect()] == ["a", "c"]
    assert [r.v for r in matching.first_distinct(df, "k", ["o"], 1).collect()] == ["a"]
    files = spark.createDataFrame([("r/01.mp3",), ("r/01.wav",), ("r/02.ogg",)], "path string")
    side = matching.sidecar(spark.createDataFrame([("t/01.json",), ("t/03.json",)], "path string"), files)
    assert {r.path: r.audio for r in side.collect()} == {"t/01.json": "r/01.wav", "t/03.json": None}
    one = names.limit(1)
    assert matching.existing_only(names, one, "name", required=True).count() == 1
    with pytest.raises(ValueError):
        matching.existing_only(names, one.limit(0), "name", required=True)
    assert matching.new_only(names, one, "name").count() == 5
    times = spark.createDataFrame([("b", 1), ("a", 1), ("c", 0)], "path string, mtime long")
    assert [r.path for r in matching.newest_last(times).collect()] == ["c", "a", "b"]
    free = matching.free_names(spark.createDataFrame([(1, "a.png"), (2, "a.png"), (3, "a.png"), (4, "b")], "o long, n string"), "n", "o")
    assert [r.file for r in free.orderBy("o").collect()] == ["a.png", "a_01.png", "a_02.png", "b"]

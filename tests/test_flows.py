"""Sinks and sources of one's own, band joins, attempts, memos and fitting against plain loops; and where they fail."""

import json
import random

import pyarrow as pa
import pytest
from cantolith.functions import fitting
from cantolith.functions.text import similarity
from cantolith.plans import registry
from cantolith.operators import alignment, attempts, bands, matching, requests, sequences
from cantolith.sources import files, readers
from pyspark.sql import functions as F


@pytest.fixture(scope="module", autouse=True)
def sources(spark):
    files.register(spark)


def test_named_files(spark, tmp_path):
    out = tmp_path / "a b" / "out"
    df = spark.createDataFrame([(f"{k}.bin", bytes([k]) * k) for k in range(40)] + [("none", None)], "name string, bytes binary").repartition(5)
    df.write.format("named_files").mode("append").save(str(out))
    assert {p.name: p.read_bytes() for p in out.iterdir()} == {f"{k}.bin": bytes([k]) * k for k in range(40)} | {"none": b"", "_SUCCESS": b""}
    with pytest.raises(Exception, match="has files in it"):
        df.write.format("named_files").mode("append").save(str(out))
    df.limit(1).write.format("named_files").mode("overwrite").save(str(out))
    assert len(list(out.iterdir())) == 2


@pytest.mark.parametrize("bad", ["a/b", ".hidden", ""])
def test_a_failed_task_leaves_no_file(spark, tmp_path, bad):
    out = tmp_path / "out"
    df = spark.range(200).repartition(4).select(F.when(F.col("id") == 199, bad).otherwise(F.col("id").cast("string")).alias("name"), F.lit(b"x").alias("bytes"))
    with pytest.raises(Exception, match="not a file's name"):
        df.write.format("named_files").mode("append").save(str(out))
    assert not out.exists()


def test_free_names_of_a_hot_name(spark):
    df = spark.range(3000).select(F.col("id").alias("o"), F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, "hot.png").otherwise(F.concat("id", F.lit(".png"))).alias("n"))
    got = {r.o: r.file for r in matching.free_names(df, "n", "o", block=64).collect()}
    assert len(got) == 3000
    hot = [got[k] for k in range(1, 3000, 3)]
    assert hot[:3] == ["hot.png", "hot_01.png", "hot_02.png"] and hot[-1] == "hot_999.png" and len(set(hot)) == 1000
    assert got[0] is None and got[2] == "2.png"


def pages(folder, items, limit):
    for at in range(0, max(len(items), 1), limit):
        (folder / f"{at}.json").write_text(json.dumps({"items": items[at : at + limit], "total": len(items), "limit": limit}))


@pytest.mark.parametrize(("n", "limit", "per_task"), [(0, 5, 2), (1, 5, 2), (10, 5, 1), (23, 5, 2), (23, 50, 20)])
def test_cursor_pages(spark, tmp_path, n, limit, per_task):
    items = [{"id": f"i{k}", "track": {"id": f"t{k}"}} if k % 2 else {"id": None if k % 5 == 0 else f"i{k}"} for k in range(n)]
    pages(tmp_path, items, limit)
    df = spark.read.format("cursor_pages").option("per_task", str(per_task)).load(str(tmp_path))
    assert sorted(r.page for r in df.collect()) == list(range(max(1, -(-n // limit))))
    got = [tuple(r) for r in readers.track_ids(df).orderBy("page", "pos").collect()]
    assert got == [(k // limit, k % limit, (x.get("track") or x)["id"]) for k, x in enumerate(items) if (x.get("track") or x)["id"]]
    assert df.rdd.getNumPartitions() == max(1, -(-n // (limit * per_task)))


def test_answers_are_asked_for_again(tmp_path):
    class Flaky(files.CursorPages):
        def fetch(self, cursor):
            asked.append(cursor)
            if len(asked) % 3:
                raise OSError("busy")
            return super().fetch(cursor)

    pages(tmp_path, [{"id": "a"}], 1)
    asked: list = []
    source = Flaky({"path": str(tmp_path), "wait": "0"})
    assert [p for p, _ in source.reader(None).read(files.Cursors(0, 1, 1))] == [0] and asked == [0, 0, 0]
    with pytest.raises(OSError):
        Flaky({"path": str(tmp_path), "wait": "0", "tries": "2"}).answer(0)


def test_bands_equal_all_pairs(spark):
    r = random.Random(7)
    name = lambda: "".join(r.choice("abc") for _ in range(r.randrange(1, 5)))
    a = [(k, name(), r.choice([None, *[float(x) / 4 for x in range(-40, 40)]])) for k in range(60)]
    b = [(k, name(), float(r.randrange(-40, 40)) / 4) for k in range(50)] + [(99, "x", None)]
    left, right = spark.createDataFrame(a, "left long, a string, at double"), spark.createDataFrame(b, "right long, b string, at double")
    found = bands.near(left, right, "at", 2.0)
    assert "NestedLoop" not in found._jdf.queryExecution().toString()
    pairs = bands.ranked(found, "a", "b").cache()
    like = {(x.a, x.b): x.s for x in left.select("a").distinct().crossJoin(right.select("b").distinct()).select("a", "b", F.round(similarity(F.col("a"), F.col("b")) * 1_000_000).cast("long").alias("s")).collect()}
    want = sorted((-like[n, m], abs(x - y), i, j) for i, n, x in a for j, m, y in b if x is not None and y is not None and abs(x - y) < 2)
    assert sorted((-p.similarity, p.gap, p.left, p.right) for p in pairs.collect()) == want and len(want) > 300
    first = {}
    for x in want:
        first.setdefault(x[2], x)
    assert {p.left: (-p.similarity, p.gap, p.left, p.right) for p in bands.best(pairs, "left").collect()} == first
    taken, used = [], (set(), set())
    for x in want:
        if x[2] not in used[0] and x[3] not in used[1]:
            taken.append(x)
            used[0].add(x[2])
            used[1].add(x[3])
    assert sorted((-p.similarity, p.gap, p.left, p.right) for p in bands.one_to_one(pairs).collect()) == taken
    with pytest.raises(ValueError):
        bands.one_to_one(pairs, 1)
    assert bands.one_to_one(pairs.limit(0)).count() == 0


def test_kinds_equal_all_pairs(spark):
    """Copies of few names and values, so that kinds are large and tie, against the joins of rows."""
    r = random.Random(8)
    a = [(k, r.choice([None, "ab", "abc", "b"]), r.choice([None, *[float(x) / 2 for x in range(-6, 6)]])) for k in range(300)]
    b = [(k, r.choice(["ab", "bc", "c"]), float(r.randrange(-6, 6)) / 2) for k in range(120)]
    left, right = spark.createDataFrame(a, "left long, a string, at double"), spark.createDataFrame(b, "right long, b string, at double")
    pairs = bands.ranked(bands.near(left, right, "at", 1.2), "a", "b").cache()
    assert sorted(map(tuple, bands.best_near(left, right, "at", 1.2, "a", "b").collect())) == sorted(map(tuple, bands.best(pairs, "left").collect()))
    left = left.where("a is not null")
    taken, used = [], (set(), set())
    for x in sorted((-p.similarity, p.gap, p.left, p.right) for p in pairs.where("similarity is not null").collect()):
        if x[2] not in used[0] and x[3] not in used[1]:
            taken.append((x[2], x[3], -x[0], x[1]))
            used[0].add(x[2])
            used[1].add(x[3])
    assert sorted(map(tuple, bands.one_to_one_near(left, right, "at", 1.2, "a", "b").collect())) == sorted(taken) and len(taken) > 100


def test_rounds_do_not_grow_with_copies(spark):
    """Rows of one name and value are paired in one round, and compared once."""
    left, right = (spark.range(500).select(F.col("id").alias(x), F.lit("n").alias(n), F.lit(1.0).alias("at")) for x, n in (("left", "a"), ("right", "b")))
    got = bands.one_to_one_near(left, right, "at", 1.0, "a", "b", 1).collect()
    assert sorted((r.left, r.right) for r in got) == [(k, k) for k in range(500)]
    tied = right.withColumn("at", F.when(F.col("right") % 3 == 0, 0.5).otherwise(1.5))  # two kinds as near and like
    got = bands.one_to_one_near(left, tied, "at", 1.0, "a", "b", 1).collect()
    assert sorted((r.left, r.right) for r in got) == [(k, k) for k in range(500)]


def taken_one_by_one(left, right, within: float) -> list[tuple]:
    """All pairs of rows by similarity, gap, left and right, each taken if both rows are free; those without a name last."""
    pairs = bands.ranked(bands.near(left, right, "at", within), "a", "b").collect()
    taken, used = [], (set(), set())
    for x in sorted((p.similarity is None, -(p.similarity or 0), p.gap, p.left, p.right) for p in pairs):
        if x[3] not in used[0] and x[4] not in used[1]:
            taken.append((x[3], x[4], None if x[0] else -x[1], x[2]))
            used[0].add(x[3])
            used[1].add(x[4])
    return sorted(taken)


@pytest.mark.parametrize("copies", [1, 3])
def test_short_lists_are_asked_for_more(spark, monkeypatch, copies):
    """Lists of one to begin with, small blocks, more rows of right than find one; names of several lengths, some null."""
    monkeypatch.setattr(bands, "OWN", 7)
    monkeypatch.setattr(bands, "OTHER", 11)
    r = random.Random(9 + copies)
    name = lambda: r.choice([None, *("".join(r.choice("abÀ") for _ in range(r.randrange(1, 5))) for _ in range(6))])
    n_left, n_right = (16, 20) if copies == 1 else (3, 4)
    rows = lambda n: [(c * 1000 + k, x, at) for k, x, at in [(k, name(), r.choice([-0.75, 0.0, 0.25, 1.0, float(k) / 16])) for k in range(n)] for c in range(copies)]
    left, right = spark.createDataFrame(rows(n_left), "left long, a string, at double"), spark.createDataFrame(rows(n_right), "right long, b string, at double")
    if copies == 1:  # no two rows of one name and value
        left, right = left.dropDuplicates(["a", "at"]), right.dropDuplicates(["b", "at"])
    left, right = left.cache(), right.cache()
    got = bands.one_to_one_near(left, right, "at", 1.0, "a", "b", k=1)
    key = lambda x: (x[0], x[1])
    assert sorted(map(tuple, got.collect()), key=key) == taken_one_by_one(left, right, 1.0)


def test_pairs_that_are_kept_grow_with_the_rows(spark, monkeypatch):
    """Of 60,000 pairs of different rows in one band, no step keeps more than a list of each."""
    kept, cut = [], bands.cut
    monkeypatch.setattr(bands, "cut", lambda df: kept.append((out := cut(df)).count()) or out)
    left = spark.range(600).select(F.col("id").alias("left"), F.format_string("c%04d", F.col("id") * 7 % 600).alias("a"), (F.col("id") / 600).alias("at"))
    right = spark.range(100).select(F.col("id").alias("right"), F.format_string("s%04d", F.col("id") * 11 % 600).alias("b"), (F.col("id") * 37 % 100 / 100).alias("at"))
    assert bands.near(left, right, "at", 2.0).count() == 60_000
    assert sorted(map(tuple, bands.one_to_one_near(left, right, "at", 2.0, "a", "b").collect())) == taken_one_by_one(left, right, 2.0)
    assert max(kept) < 6_000


def test_best_is_found_in_blocks(spark, monkeypatch):
    """Each row's best over several blocks of both sides; rows without a name come after all others, and pairs are not rows of the plan."""
    monkeypatch.setattr(bands, "OWN", 7)
    monkeypatch.setattr(bands, "OTHER", 5)
    r = random.Random(4)
    rows = lambda n: [(k, r.choice([None, "ab", "abc", "bca", "Àb", "c" * 300]), r.choice([None, float("nan"), float("inf"), 0.0, float(k) / 16])) for k in range(n)]
    left, right = spark.createDataFrame(rows(60), "left long, a string, at double"), spark.createDataFrame(rows(40), "right long, b string, at double")
    first = {}
    for p in bands.ranked(bands.near(left, right, "at", 0.5), "a", "b").collect():
        x = (p.similarity is None, -(p.similarity or 0), p.gap, p.right)
        first[p.left] = min(first.get(p.left, x), x)
    got = bands.best_near(left, right, "at", 0.5, "a", "b")
    assert {x.left: (x.similarity is None, -(x.similarity or 0), x.gap, x.right) for x in got.collect()} == first and len(first) > 10
    plan = got._jdf.queryExecution().toString()
    assert "levenshtein" not in plan and "CoGroups" in plan


def test_outcomes_equal_the_loop(spark):
    r = random.Random(5)
    rows = [(k, a, r.choice(["valid", "invalid", "invalid", "error"])) for k in range(300) for a in range(1, r.randrange(2, 9))]
    df = spark.createDataFrame(rows, "item long, attempt int, kind string")
    for most in (1, 3):
        want = {}
        for k in {x[0] for x in rows}:
            n, end = 0, ("open", None)
            for _, a, kind in sorted(x for x in rows if x[0] == k):
                n += kind == "invalid"
                if kind == "valid" or n == most:
                    end = ("valid" if kind == "valid" else "exhausted", a)
                    break
            want[k] = (*end, n)
        assert {x.item: (x.outcome, x.attempt, x.n_invalid) for x in attempts.outcome(df, most).collect()} == want


def test_no_item_or_document_is_gathered(spark):
    """Attempts pass in order; the lines of a return flag, a third of the table, are numbered by blocks."""
    df = spark.createDataFrame([(1, 1, "valid")], "item long, attempt int, kind string")
    assert "collect_list" not in attempts.outcome(df, 3)._jdf.queryExecution().toString()
    plan = registry.QUERIES["low_alignment_runs"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number()" not in plan


def test_markers_of_phrases_that_stand_once(spark):
    """The others are left out; the places of a phrase are looked for once a row."""
    rows = [(1, 1, ["a", "B", "c", "a"], "b c", "1:01"), (1, 2, ["a", "B", "c", "a"], "a", "2:01"), (1, 3, ["a", "B", "c", "a"], "B", "3:01"), (2, 1, [], "x", "1:01"), (2, 2, ["y"], "", "1:01")]
    df = spark.createDataFrame(rows, "doc_id long, ord int, words array<string>, phrase string, timestamp string")
    got = sequences.markers(df, once=True)
    assert [tuple(r) for r in got.collect()] == [(1, 1, 181.0)]
    plan = registry.QUERIES["marker_merge"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("flatten(") == 1


def test_only_rejected_items_are_sent_again(spark):
    sent = []

    def send(df):
        sent.append({r.k for r in df.collect()})
        return df.withColumn("answer", F.concat(F.lit("a"), F.col("attempt"))).withColumn("error", F.when((F.col("k") == 3) & (F.col("attempt") < 3), "busy"))

    items = spark.createDataFrame([(1, 1), (2, 2), (3, 1), (4, 9), (None, 1)], "k long, good int")
    out = attempts.until_valid(items, send, F.col("attempt") >= F.col("good"), 4, 10)
    got = {x.k: (x.answer, x.outcome, x.attempt, x.n_invalid) for x in out.collect()}
    assert got == {None: ("a1", "valid", 1, 0), 1: ("a1", "valid", 1, 0), 2: ("a2", "valid", 2, 1), 3: ("a3", "valid", 3, 0), 4: (None, "exhausted", 4, 4)}
    assert sent == [{1, 2, 3, 4, None}, {2, 3, 4}, {3, 4}, {4}]
    assert attempts.until_valid(items.limit(0), send, F.lit(True), 3).count() == 0
    cut = attempts.until_valid(items.where("k = 4"), lambda df: df.withColumn("answer", F.lit("x")).withColumn("error", F.lit("busy")), F.lit(True), 4, 2)
    assert [(x.outcome, x.answer, x.n_invalid) for x in cut.collect()] == [("open", None, 0)]


def test_memo(spark, tmp_path):
    asked = []

    def answer(df):
        asked.append(sorted(r.key for r in df.collect()))
        return df.withColumn("value", F.when(F.col("key") != "b", F.upper("key")))

    path = str(tmp_path / "memo")
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "id long, k string")
    first = attempts.remembered(df, "k", path, answer)
    assert {x.id: (x.value, x.known) for x in first.collect()} == {1: ("A", False), 2: ("A", False), 3: (None, False), 4: (None, False)}
    again = attempts.remembered(df.where("id < 3"), "k", path, answer)
    assert {x.id: (x.value, x.known) for x in again.collect()} == {1: ("A", True), 2: ("A", True)}
    assert asked[0] == ["a", "b"] and asked[-1] == []  # a failure is not remembered, but nobody asked for it here
    assert spark.read.parquet(path).count() == 1


GLYPHS = {250: " .", 300: "il", 800: "mW"}


def plain_fit(text, column, height, size, least=20):
    wide = {c: w for w, cs in GLYPHS.items() for c in cs}
    while True:
        n = 0
        for line in text.split("\n") if text else []:
            x, n = None, n + 1
            for w in line.split():
                own = sum(wide.get(c, 500) for c in w)
                if x is None or x + 250 + own <= column * 1000 // size:
                    x = own if x is None else x + 250 + own
                else:
                    x, n = own, n + 1
        if n * (size * 120 // 100) <= height or size <= least:
            return size, n
        size -= 2


def test_fitting_equals_the_loop(spark):
    r = random.Random(2)
    texts = ["", "W", "\n", "a\n\nb", *("".join(r.choice("ilmWab .  \n") for _ in range(r.randrange(1, 300))) for _ in range(150))]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(texts)] + [(-1, None)], "k long, text string")
    for size, column, height in ((96, 500, 300), (23, 90, 200), (20, 100, 50), (60, 1, 10_000)):
        got = {x.k: (x.f.size, x.f.lines) for x in df.select("k", fitting.fitted(F.col("text"), GLYPHS, column, height, size).alias("f")).collect()}
        assert got == {-1: (size, 0)} | {k: plain_fit(x, column, height, size) for k, x in enumerate(texts)}


def test_configs(spark, tmp_path):
    good = "title: A\nfile_prefix: a\nlanguage: it\nstart_idx: 1\nend_idx: 3\noverture_indices: []\ncharacters:\n  - Tosca\n  - Mario\n"
    for name, text in {"good": good, "short": "title: A\n", "typed": good.replace("end_idx: 3", "end_idx: three"), "list": "- a\n- b\n", "none": "# nothing\n", "broken": "title: [a\n"}.items():
        (tmp_path / f"{name}.yaml").write_text(text)
    got = {r.path.rsplit("/", 1)[1].split(".")[0]: r for r in readers.configs(spark, str(tmp_path)).collect()}
    assert got["good"].error is None and (got["good"].end_idx, got["good"].characters, got["good"].overture_indices, got["good"].font_size, got["good"].secondary_color) == (3, ["Tosca", "Mario"], [], 96, "Silver")
    assert got["short"].error == "missing: file_prefix, language, start_idx, end_idx, overture_indices, characters" and got["short"].title == "A"
    assert got["typed"].error == "wrong type: end_idx" and got["typed"].end_idx is None and got["typed"].start_idx == 1
    assert got["list"].error == got["none"].error == "not a mapping" and got["broken"].error.startswith("not readable")


def test_items(spark):
    rows = [(1, '[{"title": " A ", "description": " d "}, 3, "x", null, [{}], {"title": 7}]'), (2, '{"title": "A"}'), (3, "[bad"), (4, None), (5, "[]")]
    got = requests.items_of(spark.createDataFrame(rows, "k long, j string"), "j")
    assert sorted(map(tuple, got.collect())) == [(1, 0, "A", "d"), (1, 5, "7", "")]


def test_alignment_in_strips(monkeypatch):
    """Whatever is kept at once, the way is that of the full table."""
    from tests.test_timeline import plain_align

    r = random.Random(3)
    vocab = ["la", "Las", "gran", "grane", "so", "sol", "é", "x"]
    for cells, scores, parts, table in ((8, 40, 2, 4), (30, 9, 3, 9), (5, 1 << 24, 16, 1)):
        for name, value in (("CELLS", cells), ("SCORES", scores), ("PARTS", parts), ("TABLE", table)):
            monkeypatch.setattr(alignment, name, value)
        for _ in range(60):
            words = [r.choice(vocab) for _ in range(r.randrange(0, 25))]
            heard = [(w if r.random() < 0.7 else r.choice(vocab), float(k) if r.random() < 0.9 else None, k + 0.5) for k, w in enumerate(words) if r.random() < 0.8]
            marks = {r.randrange(len(words)): float(r.randrange(0, 20)) for _ in range(r.randrange(0, 4))} if words else {}
            assert alignment.align(heard, words, marks, 0.3) == plain_align(heard, words, marks, 0.3)


def test_long_alignment_in_bounded_memory():
    """6,000 x 6,000 words, whose scores would take 288 MB and whose moves 36 MB, with 2 MB of moves at a time."""
    import tracemalloc

    r = random.Random(9)
    vocab = ["".join(r.choice("abcdefgh") for _ in range(r.randrange(2, 7))) for _ in range(300)]
    words = [r.choice(vocab) for _ in range(6000)]
    heard = [(w if r.random() < 0.9 else r.choice(vocab), float(k), k + 0.5) for k, w in enumerate(words) if r.random() < 0.95]
    held, alignment.CELLS = alignment.CELLS, 1 << 21
    tracemalloc.start()
    try:
        out = alignment.align(heard, words, {100: 100.0})
        assert tracemalloc.get_traced_memory()[1] < 120e6
    finally:
        tracemalloc.stop()
        alignment.CELLS = held
    assert out[100] == (100.0, 101.0) and sum(x[0] is not None for x in out) > 5000


def test_words_of_lines(spark):
    df = spark.createDataFrame([(1, ["a b", "", "c  d e"]), (2, ["x"]), (3, []), (4, None)], "doc_id long, lines array<string>")
    rows = lambda *how: sorted(tuple(r) for r in sequences.words_to_lines(df, "lines", *how).collect())
    assert rows() == [(1, 0, 0, "a"), (1, 1, 0, "b"), (1, 2, 2, "c"), (1, 3, 2, "d"), (1, 4, 2, "e"), (2, 0, 0, "x")]
    limit = spark.createDataFrame([(1, 3), (2, 0), (2, -1), (3, 5), (2, None)], "doc_id long, n long")
    assert rows(limit) == [(1, 0, 0, "a"), (1, 1, 0, "b"), (1, 2, 2, "c")]


def test_aligned_documents_are_given_out_in_bounded_batches(monkeypatch):
    """A batch of many documents comes out as several; none of its words is lost."""
    monkeypatch.setattr(alignment, "ROWS", 10)
    kind = pa.list_(pa.struct([("word", pa.string()), ("start_s", pa.float64()), ("end_s", pa.float64())]))
    marks = pa.list_(pa.struct([("word_idx", pa.int64()), ("ts", pa.float64())]))
    heard = [[{"word": w, "start_s": float(k), "end_s": k + 1.0} for k, w in enumerate("abc")], None, []] * 5
    words = [list("abc"), list("ab"), None] * 5
    batch = pa.record_batch([pa.array(range(15), pa.int64()), pa.array(heard, kind), pa.array(words, pa.list_(pa.string())), pa.array([None] * 15, marks)], ["doc_id", "heard", "words", "markers"])
    out = list(alignment._documents(0.5, 5.0)(iter([batch])))
    assert len(out) == 3 and max(b.num_rows for b in out) <= 12
    rows = [tuple(r.values()) for b in out for r in b.to_pylist()]
    assert rows == [(d, k, w, *((float(k), k + 1.0) if d % 3 == 0 else (None, None))) for d in range(15) for k, w in enumerate(words[d] or [])]


def test_documents_aligned_together_equal_each_alone(monkeypatch):
    """Of words short, long, empty and in letters that change their number in lower case; groups of one document, of some and of all."""
    r = random.Random(7)
    odd = ["", "a", "A", "ab", "ba", "İx", "ß", "\U0001f600q", "x" * 63, "x" * 64, "heaven", "haven", "seven"]
    docs = []
    for _ in range(150):
        heard, words = ([r.choice(odd) for _ in range(r.randrange(12))] for _ in range(2))
        starts = [r.choice([None, float(i), i + 0.25]) for i in range(len(heard))]
        docs.append((heard, starts, [None if t is None else t + 1 for t in starts], words, {r.randrange(14): r.choice([1.0, 2.5, None]) for _ in range(r.randrange(4))}))
    want = [alignment.align(list(zip(h, s, e, strict=True)), w, m, 0.3) for h, s, e, w, m in docs]
    together = []
    own = alignment._matched
    monkeypatch.setattr(alignment, "_matched", lambda group: together.append(len(group)) or own(group))
    for cells in (1, 1000, 1 << 19):
        together.clear()
        monkeypatch.setattr(alignment, "TOGETHER", cells)
        assert alignment.align_many(docs, 0.3) == want
        assert (len(together) == 1) == (cells == 1 << 19) and (max(together) == 1) == (cells == 1)


def test_written_images_are_read_by_name(spark, monkeypatch):
    """Nobody lists the folder, and files are dealt over the tasks of a shuffle, however small they are; a missing one is told."""
    from pyspark.sql.readwriter import DataFrameReader

    asked, own = [], DataFrameReader.format
    monkeypatch.setattr(DataFrameReader, "format", lambda self, source: asked.append(source) or own(self, source))
    got = registry.QUERIES["written_images"](spark, "/root/testdata/sf0.001")
    assert got.count() == got.select("name").distinct().count() == spark.read.parquet("/root/testdata/sf0.001/part.parquet").count()
    assert "binaryFile" not in asked


def test_contents_of_named_files(spark, tmp_path):
    data = {"a b.png": b"x", "\u00e9%20.png": b"", "#1.png": bytes(range(256)), "k": b"y" * 70000}
    for name, x in data.items():
        (tmp_path / name).write_bytes(x)
    names = lambda some: spark.createDataFrame([(x,) for x in some], "name string").coalesce(1)
    got = files.contents(names(data), str(tmp_path))
    assert {r.name: (r.length, bytes(r.content)) for r in got.collect()} == {k: (len(x), x) for k, x in data.items()}
    assert got.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    with pytest.raises(Exception, match="FileNotFound"):
        files.contents(names([*data, "none"]), str(tmp_path)).collect()

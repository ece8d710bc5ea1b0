import random
import time
import tracemalloc

import numpy as np
import pyarrow as pa

from cantolith.llm import decontaminate as D


def text(r, n):
    return " ".join("".join(r.choice("abcdeéfghij") for _ in range(r.randrange(2, 8))) for _ in range(n))


def edited(r, t, n):
    t = list(t)
    for _ in range(n):
        k = r.randrange(len(t))
        t[k : k + r.randrange(2)] = r.choice(["", "z", "ä"])
    return "".join(t)


def has_window(item, doc):
    """Whether some W characters of the item are within E edits of some part of the document, by plain dynamic programs."""
    item, doc = (" ".join(x.lower().split()) for x in (item, doc))
    w = min(D.W, len(item))
    e = min(w * D.E // D.W, w // D.Q - 1)
    d = np.array([ord(c) for c in doc])
    for k in range(len(item) - w + 1):
        row = np.zeros(len(d) + 1, int)
        steps = np.arange(len(d) + 1)
        for i, c in enumerate(item[k : k + w]):
            best = np.r_[i + 1, np.minimum(row[:-1] + (d != ord(c)), row[1:] + 1)]
            row = np.minimum.accumulate(best - steps) + steps
        if row.min() <= e:
            return True
    return False


def test_planted_passages(spark):
    r = random.Random(7)
    items = [(k, text(r, 30)) for k in range(12)] + [(12, "short item of forty characters or fewer"), (13, "tiny"), (14, None), (None, text(r, 30))]
    docs, want = [], set()
    for k in range(72):
        i = k % 13
        body = text(r, r.randrange(0, 60))
        part = items[i][1]
        kind = k // 13
        if kind == 1:
            part = edited(r, part, 3)
        elif kind == 2:
            part = part[:90].upper().replace(" ", "\n ")
        elif kind == 3:
            part = edited(r, part, 25)
        elif kind == 4:
            part = part[:40]
        elif kind == 5:
            part = ""
        docs.append((k, body + " " + part + " " + text(r, 10), "x"))
    docs += [(100, None, "x"), (101, "", "x"), (None, items[0][1], "x"), (102, items[1][1], "x"), (102, items[1][1], "x"), (103, "the " * 3000, "x")]
    df = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for size in (D.BLOCK, 400):
        out = D.find_leaks(df, bench, size=size).collect()
        got = {(x.doc_id, x.item_id) for x in out}
        want = {(d, i) for d, t, _ in docs for i, b in items if i is not None and b and len(b) >= D.Q and t and has_window(b, t)}
        assert got == want
        texts = {d: t for d, t, _ in docs}
        for x in out:
            own = " ".join(texts[x.doc_id][x.start : x.end].lower().split())
            item = " ".join(dict(items)[x.item_id][x.item_start : x.item_end].lower().split())
            if x.edits == 0:
                assert own == item
        assert sum(x.doc_id == 102 for x in out) == 2
    clean = D.drop_leaks(df, bench)
    assert clean.columns == df.columns
    assert sorted(x.doc_id for x in clean.collect()) == sorted(d for d, *_ in docs if d is not None and d not in {x[0] for x in got})
    assert D.find_leaks(df.limit(0), bench).count() == 0 and D.find_leaks(df, bench.limit(0)).count() == 0


def test_lightly_edited_windows_at_the_budget():
    """Every number of edits up to the budget and beyond, against plain dynamic programs."""
    r = random.Random(11)
    items = [text(r, 30) for _ in range(14)]
    for n in range(3, 12):
        docs = [text(r, 5) + " " + edited(r, x[20:100], n) + " " + text(r, 5) for x in items]
        for k, (x, d) in enumerate(zip(items, docs, strict=True)):
            assert bool(search([(k, 0, x)], d)) == has_window(x, d), (n, k)


def search(items, doc):
    """Rows of one document."""
    class Shared:
        value = (D.Block(items), list(range(100)))

    batch = pa.record_batch([pa.array([0]), pa.array([doc])], ["id", "text"])
    return [r for b in D._search(iter([batch]), Shared, pa.int64()) for r in b.to_pylist()]


def test_periodic_texts_in_bounded_memory():
    tracemalloc.start()
    began = time.perf_counter()
    for unit in ("-", "=-", "* * "):
        item, doc = unit * (2000 // len(unit)), "intro " + unit * (1_000_000 // len(unit)) + " end"
        (row,) = search([(0, 0, item)], doc)
        assert row["start"] <= 8 and row["end"] >= 999_990
    assert search([(0, 0, "-" * 30 + "a real question about something " * 3)], "-" * 100_000) == []
    assert time.perf_counter() - began < 60 and tracemalloc.get_traced_memory()[1] < 1 << 30
    tracemalloc.stop()


def test_repeats_are_one_region_in_time_that_follows_the_document():
    """Items and documents that repeat themselves with periods too long to be left out, and many equal items."""
    r = random.Random(21)
    began = time.perf_counter()
    unit = text(r, 60)[:100]
    (row,) = search([(0, 0, unit * 20)], "start " + unit * 200 + " end")
    assert row["start"] <= 8 and row["end"] >= 20_000 and row["item_end"] - row["item_start"] >= D.W
    short = text(r, 30)[:40]
    (row,) = search([(0, 0, short * 40)], short * 400)
    assert (row["start"], row["end"]) == (0, 16_000)
    assert time.perf_counter() - began < 8
    began = time.perf_counter()
    item = text(r, 30)[:80] + " "
    rows = search([(k, 0, item) for k in range(100)], item * 100)
    assert len(rows) == 100 and all(x["start"] == 0 and x["end"] >= 100 * 81 - 2 for x in rows)
    assert time.perf_counter() - began < 15
    began = time.perf_counter()
    (row,) = search([(0, 0, unit * 20)], unit * 2000)
    assert row["end"] == 200_000 and time.perf_counter() - began < 20


def test_brief_finds_the_same_documents():
    r = random.Random(22)
    items = [(k, 0, text(r, 30)) for k in range(10)]
    docs = [text(r, 20) + " " + " ".join(t for _, _, t in items[: k % 3]) + " " + text(r, 20) for k in range(9)]

    class Shared:
        value = (D.Block(items), list(range(10)))

    batch = pa.record_batch([pa.array(range(9)), pa.array(docs)], ["id", "text"])
    full, brief = ([x for b in D._search(iter([batch]), Shared, pa.int64(), how) for x in b.to_pylist()] for how in (False, True))
    assert {x["id"] for x in full} == {x["id"] for x in brief} == {k for k in range(9) if k % 3} and len(brief) == 6 < len(full)


def test_slices_and_halves_find_the_same(monkeypatch):
    r = random.Random(12)
    items = [(k, 0, "the same opening of each of them " + text(r, 20)) for k in range(30)]
    doc = " ".join(text(r, 20) + " " + t[k % 40 : k % 40 + 90] for k, (_, _, t) in enumerate(items))
    want = search(items, doc)
    assert {x["item"] for x in want} == set(range(30))
    monkeypatch.setattr(D, "HITS", 50)
    assert search(items, doc) == want


def test_items_with_text_ids(spark):
    r = random.Random(13)
    t = text(r, 40)
    docs = spark.createDataFrame([("d", "before " + t + " after")], "doc_id string, text string")
    out = D.find_leaks(docs, spark.createDataFrame([("q-1", t), ("q-2", text(r, 40))], "item_id string, text string")).collect()
    assert [(x.doc_id, x.item_id, x.edits) for x in out] == [("d", "q-1", 0)]


def test_query_finds_every_exact_passage(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{d}/benchmark.parquet").collect()
    exact = {(x.doc_id, b.item_id) for x in docs for b in items if b.text in (x.text or "")}
    got = {(x.doc_id, x.item_id) for x in D.op9_decontamination(spark, d).collect()}
    assert exact and exact <= got and len(got) <= 1.1 * len(exact)

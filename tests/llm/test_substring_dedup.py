import random
import re

import numpy as np

from cantolith.llm import bloom
from cantolith.llm import common as C
from cantolith.llm import substring_dedup as S


def text(r, n):
    return " ".join("".join(r.choice("abcdeéfghij") for _ in range(r.randrange(2, 8))) for _ in range(n))


def cut(b):
    """The chunks of a text, byte by byte: (start, end) pairs."""
    out, start, n = [], 0, len(b)
    for i in range(1, n + 1):
        if i < n and b[i] & 0xC0 == 0x80:
            continue
        near = sum(int(S._GEAR[x]) << k for k, x in enumerate(reversed(b[max(0, i - 16) : i]))) & 0xFFFF
        cuts = i < n and i >= 16 and near >> 12 == 0
        if cuts or i == n:
            while i - start > 256:
                end = start + 256
                while b[end] & 0xC0 == 0x80:
                    end -= 1
                out.append((start, end))
                start = end
            if i == n or i - start >= 16:
                out.append((start, i))
                start = i
    return [x for x in out if x[0] < x[1]]


def brute(rows):
    """Chunks as bytes, first places in a plain dict; rows in order."""
    made, first = [], {}
    for i, t in rows:
        b = (t or "").encode()
        starts = [m.start() for m in re.finditer(rb"[^\x20\x09-\x0D]+", b)]
        made.append([(b[x:y], sum(x <= w < y for w in starts)) for x, y in cut(b)])
        for k, (x, _) in enumerate(made[-1]):
            first.setdefault(x, (i, t, k))
    out = {}
    for (i, t), parts in zip(rows, made, strict=True):
        new, run, words = b"", b"", 0
        for k, (x, w) in enumerate([*parts, (None, 0)]):
            if x is not None and first[x] != (i, t, k):
                run, words = run + x, words + w
                continue
            new += (run if words < S.MIN_WORDS else b"") + (x or b"")
            run, words = b"", 0
        out[i] = new.decode() if t is not None else None
    return out


def test_chunks_are_whole_and_resist_shifts():
    r = random.Random(1)
    t = text(r, 2000)
    a, b = (np.frombuffer(x.encode(), np.uint8) for x in (t, t[:500] + "inserted" + t[500:]))
    (s, e, g, *_), (_, _, h, *_) = (S.chunks(x, np.array([0, len(x)])) for x in (a, b))
    assert s[0] == 0 and e[-1] == len(a) and (s[1:] == e[:-1]).all() and (e - s).max() <= S.MOST
    assert len(set(g.tolist()) - set(h.tolist())) <= 4
    same = np.frombuffer(b"a" * 5000, np.uint8)
    assert len(S.chunks(same, np.array([0, 5000]))[0]) <= 5000 // S.LEAST + 1


def test_batches_do_not_change_chunks():
    r = random.Random(2)
    texts = [text(r, n) for n in (0, 1, 3, 300, 0, 40)]
    buf = [x.encode() for x in texts]
    o = np.r_[0, np.cumsum([len(x) for x in buf])]
    all_ = S.chunks(np.frombuffer(b"".join(buf), np.uint8), o)
    for d, x in enumerate(buf):
        one = S.chunks(np.frombuffer(x, np.uint8), np.array([0, len(x)]))
        assert one[2].tolist() == all_[2][all_[4][d] : all_[4][d + 1]].tolist()
        assert one[3].tolist() == all_[3][all_[4][d] : all_[4][d + 1]].tolist()


def test_passages_go_once_and_clean_texts_stay(spark):
    r = random.Random(3)
    passages = [text(r, 55) for _ in range(20)]
    rows = [(i, text(r, 100), "x") for i in range(40)]
    for k, p in enumerate(passages):
        rows += [(100 + 3 * k + j, text(r, 60) + " " + p + " " + text(r, 30), "x") for j in range(3)]
    rows += [(500, None, "x"), (501, "", "x"), (502, rows[0][1], "x"), (502, rows[0][1], "x"), (503, "short one", "x"), (504, "short one", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _maybe2 string").withColumnRenamed("_maybe2", "spans")
    out = S.remove_repeats(docs).collect()
    got = {x.doc_id: x.text for x in out}
    assert len(out) == len(rows)
    assert got == brute([x[:2] for x in rows])
    assert all(got[i] == t for i, t, _ in rows[:40])
    assert all(sum(p in (t or "") for t in got.values()) == 1 for p in passages)
    assert got[502] == "" and got[500] is None and got[504] == "short one"
    for x in out:
        old = dict((i, t) for i, t, _ in rows)[x.doc_id]
        for s in reversed(x._spans):
            old = old[: s.start] + old[s.end :]
        assert old == x.text
    assert S.remove_repeats(docs.limit(0)).count() == 0


def test_query_equals_brute_force(spark):
    d = "/root/testdata/sf0.001"
    rows = sorted(tuple(x) for x in C.table(spark, d, "documents").select("doc_id", "text").collect())
    assert {x.doc_id: x.text for x in S.op10_substring_dedup(spark, d).collect()} == brute(rows)


def test_one_passage_in_most_rows(spark, monkeypatch):
    r = random.Random(6)
    p = text(r, 60)
    rows = [(i, text(r, 20) + " " + p + " " + text(r, 20)) for i in range(120)] + [(200, p), (201, "z " * 3000)]
    monkeypatch.setattr(C.meet, "__defaults__", (20,))  # digests of more than a twentieth of the repeated rows are broadcast
    assert {x.doc_id: x.text for x in S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == brute(rows)


def test_rows_without_id_and_ids_with_two_texts(spark):
    r = random.Random(7)
    p = text(r, 60)
    rows = [(None, p + " " + text(r, 40)), (4, text(r, 40) + " " + p), (4, text(r, 30) + " " + p), (4, None), (None, None)]
    out = S.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(out) == 5 and sum(p in (x.text or "") for x in out) == 1
    assert next(x.text for x in out if x.doc_id is None and x.text) == rows[0][1]


def test_digest_filter(spark):
    keys = spark.range(5000).selectExpr("xxhash64(id) AS d")
    table = bloom.digest_filter(keys, "d")
    held = np.array([x.d for x in keys.collect()])
    other = np.array([x.d for x in spark.range(5000, 10000).selectExpr("xxhash64(id) AS d").collect()])
    assert bloom.may_hold(table, held).all() and bloom.may_hold(table, other).sum() < 5

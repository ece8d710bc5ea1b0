"""Golden values and edge cases of the text functions."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cantolith.functions import text as T
from cantolith.operators import alignment, requests, sequences


def values(spark, column, rows):
    """column over rows of one text x each."""
    df = spark.createDataFrame([(k, x) for k, x in enumerate(rows)], "k long, x string")
    return [r.v for r in df.select("k", column.alias("v")).orderBy("k").collect()]


def X():
    return F.col("x")


def test_seconds_and_clock(spark):
    assert values(spark, T.seconds(X()), ["1:48:35", "2:05", "7", "1:2.5", None]) == [6515.0, 125.0, 7.0, 62.5, None]
    with pytest.raises(Exception, match="no time of the form"):
        values(spark, T.seconds(X()), ["1:2:3:4"])
    assert values(spark, T.cue(X().cast("double"), F.lit("X")), ["0", "65", "3661", "86400", "180000.9"]) == [" - X", "1:05 - X", "1:01:01 - X", "1 day, 0:00:00 - X", "2 days, 2:00:00 - X"]


def test_slugs_and_blocks(spark):
    assert values(spark, T.slug(X()), ["The  Rope!", "--", "é", "a" * 90]) == ["the-rope", "", "", "a" * 80]
    assert values(spark, T.blocks(X()), ["a  \r\nb\r\n\r\n\r\n c ", " \n\n ", ""]) == [["a\nb", " c"], [], []]
    assert values(spark, T.blocks_at(X()), ["a\n\n\nb\n\n  \n\nc"]) == [["a", "\nb", "c"]]
    assert values(spark, T.tokens(X()), [" a b\t c ", "", None]) == [["a", "b", "c"], [], []]


def test_markup(spark):
    names = F.array(F.lit("Tom"), F.lit("Tomas"))
    out = values(spark, T.markup(X(), names), ["Tom\nhi (smiles) yo (x", "Tomas\n(a)(b)", "(", "", "Tom hi"])
    assert [[tuple(s) for s in x] for x in out] == [
        [("Tom\n", "bold"), ("hi ", "regular"), ("(smiles)", "italic"), (" yo ", "regular"), ("(x", "regular")],
        [("Tomas\n", "bold"), ("(a)", "italic"), ("(b)", "italic")],
        [("(", "regular")],
        [],
        [("Tom hi", "regular")],
    ]
    assert values(spark, T.strip_speaker(X(), F.array(F.lit("Tom"))), ["Tom: hi: there", "TOM:x", "tom: x", "Tom"]) == ["hi: there", "x", "tom: x", "Tom"]
    assert values(spark, T.break_after_speaker(X(), F.array(F.lit("Tom"))), ["Tom hi", "Ann hi"]) == ["Tom\nhi", "Ann hi"]


def test_similarity(spark):
    pairs = F.array(F.struct(F.lit("Kitten").alias("a"), F.lit("sitting").alias("b")), F.struct(F.lit("").alias("a"), F.lit("").alias("b")), F.struct(F.lit("é").alias("a"), F.lit("e").alias("b")))
    assert values(spark, F.transform(pairs, lambda p: T.similarity(p["a"], p["b"])), ["x"])[0] == pytest.approx([1 - 3 / 7, 1.0, 0.0])
    assert alignment.similarity("Kitten", "sitting") == pytest.approx(1 - 3 / 7)


def plain_split(lines):
    """The nearest balanced index by walking outward from the middle."""
    n, mid = len(lines), len(lines) // 2
    ok = lambda i: 1 <= i < n and sum(x.count("(") - x.count(")") for x in lines[:i]) == 0
    for o in range(n):
        for i in (mid + o, mid - o):
            if ok(i):
                return i
    return mid


def plain_parts(s, t, longest):
    if len(s) <= longest:
        return [(s, t)]
    k = plain_split(s)
    return plain_parts(s[:k], t[:k], longest) + plain_parts(s[k:], t[k:], longest)


def test_split_long_equals_recursion(spark):
    r = random.Random(2)
    rows = []
    for k in range(120):
        s = [r.choice(["a", "(", ")", "b (c)", "d"]) for _ in range(r.randrange(0, 70))]
        rows.append((k, 0, s, [f"t{i}" for i in range(max(0, len(s) + r.randrange(-3, 4)))]))
    df = spark.createDataFrame(rows, "doc_id long, pair_idx long, src array<string>, tgt array<string>")
    assert [x.v for x in df.select("doc_id", T.split_point(F.col("src")).alias("v")).orderBy("doc_id").collect()] == [plain_split(x[2]) for x in rows]
    got = {}
    for x in sequences.split_long(df).orderBy("doc_id", "part").collect():
        got.setdefault(x.doc_id, []).append((x.src, x.tgt))
    assert got == {k: [("\n".join(a), "\n".join(b)) for a, b in plain_parts(s, t, 15)] for k, _, s, t in rows}


def test_json_and_content(spark):
    rows = ['x ```json\n[{"a": 1}]\n``` y', "text [1, 2] end", "{bad", 'pre {"a": [1]} post', "```\n{\"a\": 2}\n```"]
    assert values(spark, T.json_fragment(X()), rows) == ['[{"a": 1}]', "[1, 2]", None, '{"a": [1]}', '{"a": 2}']
    parts = F.from_json(X(), "array<struct<type:string,text:string>>")
    assert values(spark, T.flat_content(parts, F.lit(None).cast("string"), F.lit("f")), ['[{"type":"text","text":"a"},{"type":"img"},{"type":"text","text":"b"}]', None]) == ["ab", "f"]


def test_files_and_numbers(spark):
    assert values(spark, F.struct(T.stem(X()).alias("s"), T.suffix(X()).alias("e")), ["a/b.c.PNG", "x", ".hidden", "a.b/c"]) == [("b.c", ".png"), ("x", ""), (".hidden", ""), ("c", "")]
    assert values(spark, T.padded(X()), ["7", "107"]) == ["07", "107"]
    assert values(spark, T.title(X()), ["die-walkuere_en.txt"]) == ["Die Walkuere"]
    assert values(spark, T.whole_number(X()), ["", "none", " 5 "]) == [None, None, 5]
    with pytest.raises(Exception):
        values(spark, T.whole_number(X()), ["five"])
    assert values(spark, T.size_of(X()), ["1024x768", "2K"]) == [(1024, 768, None), (None, None, "2K")]
    assert values(spark, T.all_cases(F.array(X())), ["Tom"]) == [["Tom", "tom", "TOM"]]
    assert values(spark, T.prompt(X(), F.lit("wide"), F.lit(None).cast("string"), F.lit("soft"), F.lit("red"), F.lit("end")), ["a\nb", ""]) == ["a b, wide shot, soft lighting, color palette: red, end", "wide shot, soft lighting, color palette: red, end"]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 60), st.integers(1, 14), st.integers(1, 14))
def test_hop_formula(n, window, stride):
    starts, i = [], 0
    while i < n:
        starts.append(i)
        if i + window >= n:
            break
        i += stride
    last = max(0, -(-(n - window) // stride))
    assert starts == [k * stride for k in range(last + 1) if k * stride < n][: len(starts)] and len(starts) == len([k for k in range(last + 1) if k * stride < n])


def test_hops(spark):
    df = spark.createDataFrame([(20, [0, 6, 12]), (0, []), (10, [0]), (11, [0, 6])], "n int, want array<bigint>")
    assert all(r.got == r.want for r in df.select("want", sequences.hops(F.col("n"), 10, 6).alias("got")).collect())
    with pytest.raises(ValueError):
        sequences.hops(F.col("n"), 0, 6)


def test_phrases(spark):
    w = T.tokens(X())
    assert values(spark, sequences.phrase_places(w, F.lit("The rope")), ["the ROPE and the rope", "the", ""]) == [[0, 3], [], []]
    assert values(spark, sequences.only_place(w, F.lit("a b")), ["x a b"]) == [1]
    for bad in ("x", "a b a b"):
        with pytest.raises(Exception, match="place"):
            values(spark, sequences.only_place(w, F.lit("a b")), [bad])


def test_strict_zip(spark):
    df = spark.createDataFrame([(1, ["a", "b"], ["x"])], "doc_id long, s array<string>, t array<string>")
    assert [tuple(r) for r in sequences.zip_lists(df, "s", "t").collect()] == [(1, 0, "a", "x")]
    with pytest.raises(Exception, match="must have as many"):
        sequences.zip_lists(df, "s", "t", strict=True).collect()


def test_requests_limits_and_provider(spark):
    rows = [(0, None, "", "  ", None), (1, None, "p1", None, None), (2, "f2", "x", None, "S"), (3, None, None, "d3", "T")]
    df = spark.createDataFrame(rows, "ord long, final_prompt string, prompt string, description string, global_style string")
    assert [tuple(r) for r in requests.requests(df).orderBy("index").collect()] == [(1, 1, 3, "p1", "S"), (2, 2, 3, "f2", "S"), (3, 3, 3, "d3", "S")]
    assert [tuple(r) for r in requests.requests(df, limit=2).collect()] == [(1, 1, 1, "p1", None)]
    assert requests.requests(df, limit=0).count() == 0
    assert requests.requests(df, style="Z").first().style == "Z"
    made = requests.generate(df.select("ord", "prompt"), "prompt", lambda: lambda p: p.upper())
    assert {r.ord: r.answer for r in made.collect()} == {0: "", 1: "P1", 2: "X", 3: None}

import re

from hypothesis import given, settings
from hypothesis import strategies as st

from cantolith.llm import token_count as T


def greedy(word, initial, inner):
    n, at = 0, 0
    while at < len(word):
        vocab = inner if at else initial
        end = next((e for e in range(len(word), at, -1) if word[at:e] in vocab), None)
        if end is None:
            return -1
        n, at = n + 1, end
    return n


pieces = st.sets(st.text("abc", min_size=1, max_size=5), max_size=12)


@settings(max_examples=1500, deadline=None)
@given(pieces, pieces, st.lists(st.text("abcd", min_size=1, max_size=14), max_size=8))
def test_automaton_equals_greedy_match(initial, inner, words):
    a = T.Automaton(initial, inner)
    for w in words:
        assert a.count(w) == greedy(w, initial, inner)


def test_query_equals_greedy_match(spark):
    d = "/root/testdata/sf0.001"
    initial, inner = map(set, T.vocabulary())
    docs = dict(tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect())
    seen = {}
    for r in T.op5_token_counts(spark, d).collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", docs.pop(r.doc_id) or "")
        for w in words:
            seen.setdefault(w, greedy(w, initial, inner))
        assert (r.n_words, r.n_tokens, r.n_unknown) == (len(words), sum(abs(seen[w]) for w in words), sum(seen[w] < 0 for w in words))
    assert not docs


def test_edges(spark):
    docs = spark.createDataFrame([(1, None, "c"), (2, "", "c"), (3, "ab zz ab", "c"), (3, "ab zz ab", "c"), (None, "\n\t", "c"), (4, "ab" * 100000, "c")], "doc_id long, text string, n_tokens string")
    out = T.count_tokens(docs, (["a", "ab"], ["ab", "b"]))
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted([(1, 0, 0, 0), (2, 0, 0, 0), (3, 3, 3, 1), (3, 3, 3, 1), (None, 0, 0, 0), (4, 1, 100000, 0)], key=str)
    assert T.count_tokens(docs.limit(0), ([], [])).count() == 0

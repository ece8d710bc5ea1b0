import re
from collections import Counter

import numpy as np

from cantolith.llm import quality_rules as Q


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    win = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    c = Counter(win)
    cover = {i + k for i, x in enumerate(win) if c[x] > 1 for k in range(5)}
    lines = Counter(x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x))
    return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), sum(lines.values()) - len(lines), len(cover)


TEXTS = [None, "", " \n\t", "a b c d e a b c d e", "x " * 9, "one\none\n \n\none", "é É é É é É", "a|b <c> #&", "Tab\tsame\nTab\tsame", "r s t u v " * 400]


def test_base_counts_equal_brute_force():
    data = [(x or "").encode() for x in TEXTS]
    got = Q.counts(np.frombuffer(b"".join(data), np.uint8), np.r_[0, np.cumsum([len(x) for x in data])])
    assert [tuple(x) for x in got.T.tolist()] == [brute(x) for x in TEXTS]


def test_kneser_ney_is_a_distribution():
    """Over the characters seen and one that stands for any other."""
    r = np.random.default_rng(1)
    letters = r.integers(97, 110, (3000, Q.ORDER)).astype(np.uint64)
    grams = np.unique((letters << (np.arange(Q.ORDER, dtype=np.uint64)[::-1] * np.uint64(Q.BITS))).sum(axis=1, dtype=np.uint64))
    m = Q.KneserNey(grams, r.integers(1, 9, len(grams)))
    after = np.r_[np.unique(grams & m.mask(1)), np.uint64(0xE001)]
    for c in [*(grams[:40] >> np.uint64(Q.BITS)), np.uint64(5)]:
        assert abs(m.probability((c << np.uint64(Q.BITS)) | after).sum() - 1) < 1e-5


def test_query(spark):
    d = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    label = {r.doc_id: r for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    out = Q.op7_quality_rules(spark, d).collect()
    assert len(out) == len(docs)
    for r in out:
        b = brute(docs[r.doc_id].text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == b
        assert r.base_failed == (b[0] < 10 or 100 * b[4] > 20 * b[0]) and not (r.kept and r.base_failed)
    rest = [(r.kept, label[r.doc_id].quality) for r in out if r.doc_id in label and not r.base_failed]
    assert all(k for k, q in rest if q == 1)
    assert sum(not k for k, q in rest if q == 0) > 0.8 * sum(q == 0 for _, q in rest)


def test_perplexity_equals_a_plain_model(spark):
    """Of one language: the same counts and formula with dictionaries."""
    texts = ["the cat sat on the mat and then the dog ran after the cat again", "a dog and a cat are not the same animal, said the dog to the cat one day"]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    got = {r.doc_id: r.perplexity for r in Q.quality_rules(docs).collect()}
    full = Counter()
    seq = []
    for t in texts:
        s = [32, 32, 32] + [ord(c) for c in t.lower()]
        grams = [tuple(int(x) for x in s[i - 3 : i + 1]) for i in range(3, len(s))]
        seq.append(grams)
        full.update(grams)
    levels = {4: full}
    for n in (3, 2, 1):
        levels[n] = Counter(g[1:] for g in levels[n + 1])
    cut = {n: Q.KneserNey.discounts(np.array(list(c.values()), float)) for n, c in levels.items()}

    def p(g):
        if not g:
            return 1 / (len(levels[1]) + 1)
        c = levels[len(g)]
        own = {x: v for x, v in c.items() if x[:-1] == g[:-1]}
        if not own:
            return p(g[1:])
        total, d = sum(own.values()), cut[len(g)]
        return max(own.get(g, 0) - d[min(3, own.get(g, 0))], 0) / total + sum(d[min(3, v)] for v in own.values()) / total * p(g[1:])

    for i, grams in enumerate(seq):
        want = 2 ** (-sum(np.log2(p(g)) for g in grams) / len(grams))
        assert abs(got[i] / want - 1) < 1e-4


def test_edges(spark):
    rows = [(i, t, lang, "x") for i, (t, lang) in enumerate(zip(TEXTS, ["en", None, "", "xx", "en", "en", "fr", "en", None, "en"], strict=True))]
    rows += [(None, "a few plain words that make a fine short text here", "en", "x"), (3, TEXTS[3], "xx", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept string")
    out = Q.quality_rules(docs).collect()
    assert len(out) == len(rows) and sum(r.kept for r in out) == 1
    good = Q.keep_good(docs)
    assert good.columns == docs.columns and [r.doc_id for r in good.collect()] == [None]
    assert Q.quality_rules(docs.limit(0)).count() == 0


def test_narrowest_half():
    r = np.random.default_rng(3)
    clean = r.normal(480, 20, 600).astype(int)
    for bad in (0, 300, 550):
        i, mid, j = Q.narrowest_half(np.bincount(np.r_[clean, r.normal(980, 60, bad).astype(int)], minlength=Q.STEPS))
        assert abs(mid - 480) < 20 and j - i < 110, (bad, i, mid, j)
    assert Q.narrowest_half(np.bincount([7], minlength=9)) == (7, 7, 7)


def test_many_bad_texts_of_a_language_are_rejected(spark):
    """A third, then three fifths of one language's texts are junk of symbols."""
    r = np.random.default_rng(4)
    syllables = "ka lo mi ter su an re don vi la pes to ne".split()
    vocabulary = ["".join(r.choice(syllables, r.integers(1, 4))) for _ in range(400)]
    clean = [" ".join(r.choice(vocabulary, 80)) for _ in range(400)]
    junk = ["".join(r.choice(list("#*$%&|abcqxz019 "), 500)) for _ in range(600)]
    for bad in (200, 600):
        rows = [(i, t, "en") for i, t in enumerate(clean)] + [(-1 - i, t, "en") for i, t in enumerate(junk[:bad])]
        out = Q.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
        assert not any(x.base_failed for x in out)
        assert all(x.kept == (x.doc_id >= 0) for x in out), (bad, sum(x.kept for x in out if x.doc_id < 0), sum(not x.kept for x in out if x.doc_id >= 0))


def test_languages_have_models_of_their_own_in_all_scripts(spark):
    """Codes that a small hash would join; Cyrillic and Chinese, clean and scrambled."""
    r = np.random.default_rng(5)
    rows, n = [], 0
    for lang, letters, space in (("en", "abcdefghij", " "), ("ro", "klmnopqrst", " "), ("ru", "абвгдежзик", " "), ("zh", "天地玄黄宇宙洪荒日月", "")):
        letters = list(letters)
        syllables = ["".join(r.choice(letters, 3)) for _ in range(12)]
        vocabulary = ["".join(r.choice(syllables, 2)) for _ in range(80)]
        for k in range(120):
            rows.append((n, space.join(r.choice(vocabulary, 60)) + " one two three four five six seven eight nine", lang, True))
            n += 1
        for k in range(20):
            t = "".join(r.permutation(list(space.join(r.choice(vocabulary, 60)).replace(" ", "")))) + " a b c d e f g h i"
            rows.append((n, t, lang, False))
            n += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, good boolean")
    out = {x.doc_id: x.kept for x in Q.quality_rules(docs).collect()}
    assert all(out[i] == good for i, _, _, good in rows), [(i, g) for i, _, l, g in rows if out[i] != g][:5]
    assert sorted(x.doc_id for x in Q.keep_good(docs).collect()) == [i for i, _, _, g in rows if g]
    models = Q.trained(docs, "text", "lang").value
    assert sorted(models) == ["en", "ro", "ru", "zh"]
    ngrams = [set(m.tables[-1][0].tolist()) for m in (models["en"], models["ro"])]
    assert len(ngrams[0] & ngrams[1]) < 0.2 * len(ngrams[0])


def test_model_is_pruned_to_a_bound(spark):
    d = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{d}/documents.parquet").select(Q.language(Q.F.col("lang")).alias("lang"), "text")
    size = lambda m: sum(len(x.tables[-1][0]) for x in m.values())
    full = Q.train(texts)
    assert size(Q.train(texts, most=2000)) <= 2000 < size(full)


def test_results_do_not_depend_on_what_the_driver_holds(spark):
    """Of languages in one, two and three bytes a character, with junk that no model has met: most bounds memory, not the model."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    r = np.random.default_rng(8)
    other = [(9000 + i, " ".join("".join(r.choice(list(letters), 4)) for _ in range(200)), lang) for i in range(150) for lang, letters in [("ru", "абвгдежзик"), ("zh", "天地玄黄宇宙洪荒日月")]]
    odd = [(None, "é \U0001f600 " * 30, "en"), (None, None, "zh"), (1, "", "xx"), *((-1 - i, " ".join(map(str, r.permutation(80))) + " #x" * 3, "en") for i in range(3))]
    docs = docs.union(spark.createDataFrame([*other, *odd], "doc_id long, text string, lang string")).persist()
    rows = lambda df: sorted((tuple(x) for x in df.collect()), key=repr)
    want = rows(Q.quality_rules(docs))
    good = rows(Q.keep_good(docs))
    size = sum(len(m.tables[-1][0]) for m in Q.train(docs.select(Q.language(Q.F.col("lang")).alias("lang"), "text")).values())
    for most in (0, size // 20):
        got = rows(Q.quality_rules(docs, most=most))
        assert len(got) == len(want)
        at = 1 + Q.NAMES.index("perplexity")
        for g, w in zip(got, want, strict=True):
            assert g[:at] + g[at + 1 :] == w[:at] + w[at + 1 :] and abs(g[at] - w[at]) <= 2e-6 * max(1, w[at]), (most, g, w)
        assert rows(Q.keep_good(docs, most=most)) == good
    docs.unpersist()


def test_a_small_language_keeps_its_verdicts_beside_large_ones(spark):
    """Of a language with few of the n-grams the same texts go as where it stands alone, though the others lose many of theirs."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    ids = [r.doc_id for r in docs.where("lang = 'es'").orderBy("doc_id").select("doc_id").take(30)]
    small = docs.where(Q.F.col("doc_id").isin(ids))
    all_ = docs.where("lang <> 'es'").withColumn("lang", Q.F.lit("xx")).union(small)
    texts = all_.select(Q.language(Q.F.col("lang")).alias("lang"), "text")
    size = lambda m: {x: len(m[x].tables[-1][0]) for x in m}
    full = size(Q.train(texts))
    most = sum(full.values()) * 7 // 10
    cut = size(Q.train(texts, most))
    assert cut["es"] == full["es"] and cut["xx"] < 0.75 * full["xx"] and sum(cut.values()) <= most, (full, cut)
    alone = {r.doc_id: (r.kept, r.judged) for r in Q.quality_rules(small).collect()}
    beside = {r.doc_id: (r.kept, r.judged) for r in Q.quality_rules(all_, most=most).collect() if r.doc_id in alone}
    few = {r.doc_id: r.kept for r in Q.quality_rules(all_, most=most // 4).collect() if r.doc_id in alone}  # now it loses n-grams of its own
    assert sum(few[k] == alone[k][0] for k in alone) >= 0.85 * len(alone)
    assert beside == alone and len({x for x, _ in alone.values()}) == 2 and all(x for _, x in alone.values())


def test_shares_of_models():
    assert Q.shares({"a": 10, "b": 10}, 100) == {"a": 10, "b": 10}
    got = Q.shares({"a": 1_000_000, "b": 10_000, "c": 50}, 2000)
    assert got["c"] == 50 and sum(got.values()) <= 2000 and got["a"] > 3 * got["b"] > 1000
    assert Q.shares({}, 5) == {} and Q.shares({"a": 9}, 5) == {"a": 5}


def test_tally_counts_like_a_dictionary(monkeypatch):
    monkeypatch.setattr(Q, "SLOTS", 16)
    r = np.random.default_rng(6)
    t, want = Q.Tally(), Counter()
    for _ in range(5):
        g = r.integers(0, 60, 500).astype(np.uint64)
        t.add(g)
        want.update(g.tolist())
    t.settle()
    got = Counter()
    for g, c in t.rows():
        got.update(dict(zip(g.tolist(), c.tolist(), strict=True)))
    assert got == want

import random

import numpy as np

from cantolith.llm import common, features
from cantolith.llm import kernel as K


def buffer(texts):
    raw = [x.encode() for x in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(x) for x in raw])]


def test_words_and_hashes(monkeypatch):
    r = random.Random(1)
    texts = ["".join(r.choice("aB \té\n") for _ in range(r.randrange(0, 40))) for _ in range(200)]
    data, offsets = buffer(texts)
    starts, ends, bounds = K.words(data, offsets)
    got = [[bytes(data[s:e]).decode() for s, e in zip(starts[i:j], ends[i:j], strict=True)] for i, j in zip(bounds[:-1], bounds[1:], strict=True)]
    assert got == [t.split() for t in texts]
    h = K.word_hashes(data, starts, ends)
    by = {}
    for w, x in zip([w.translate({66: 98}) for t in texts for w in t.split()], h.tolist(), strict=True):
        assert by.setdefault(w, x) == x
    assert len(set(by.values())) == len(by)
    monkeypatch.setattr(K, "PART", 7)
    assert (K.word_hashes(data, starts, ends) == h).all()
    assert len(K.word_hashes(data, starts[:0], ends[:0])) == 0


def test_windows():
    texts = ["a b c d e f", "", "a b", "a b c d e", "b c d e f", "a b"]
    data, offsets = buffer(texts)
    starts, ends, bounds = K.words(data, offsets)
    s, b = K.windows(K.word_hashes(data, starts, ends), bounds, 5)
    assert np.diff(b).tolist() == [2, 0, 1, 1, 1, 1]
    assert s[0] == s[3] and s[1] == s[4] and s[2] == s[5] and len(set(s.tolist())) == 3


def test_text_buffers():
    import pyarrow as pa

    col = pa.array(["ab", None, "", "é"]).slice(1)
    data, offsets = common.utf8(col)
    assert offsets.tolist() == [0, 0, 0, 2] and bytes(data) == "é".encode()
    assert list(common.pieces(np.array([0, 5, 5, 30, 31]), 6)) == [(0, 2), (2, 3), (3, 4)]
    assert list(common.pieces(np.array([0]))) == []


def test_tokens():
    data, offsets = buffer(["Ab,12 ab!!", "3", ""])
    h, b = features.tokens(data, offsets)
    assert np.diff(b).tolist() == [5, 1, 0] and h[0] == h[3] and h[2] == h[5] == 0

"""Token counts: greedy longest-match word pieces counted by a linear automaton, without building the pieces.

The automaton is a trie of the vocabulary with failure links. Where a node has no edge for the
next character, its link leads to the node of what is left after the pieces that are then certain,
and the node keeps how many these are. So each character is followed once, however far a greedy
matcher would have to go back.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import in_batches, table, utf8

#: Place of the query's vocabulary; a parameter of vocabulary().
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
#: The automaton is broadcast; larger vocabularies are refused.
MOST_PIECES = 1 << 20
#: Words remembered by a worker; beyond, it starts anew. Counts don't depend on it.
REMEMBERED = 1 << 19


class Automaton(dict):
    """Word -> number of its pieces; -1 if some place of it has no piece. Remembers what it has counted."""

    def __init__(self, initial: Iterable[str], inner: Iterable[str]):
        """initial: pieces that begin a word; inner: pieces that continue one."""
        super().__init__()
        self.edges: list[dict[str, int]] = [{}, {}]  # 0: start of a word; 1: a piece has just ended
        self.link, self.pops = [-1, -1], [0, 0]
        ends = set()
        for root, pieces in ((0, initial), (1, inner)):
            for piece in filter(None, pieces):
                v = root
                for c in piece:
                    u = self.edges[v].get(c)
                    if u is None:
                        u = self.edges[v][c] = len(self.edges)
                        self.edges.append({})
                        self.link.append(-1)
                        self.pops.append(0)
                    v = u
                ends.add(v)
        queue = deque([0, 1])
        while queue:
            v = queue.popleft()
            for c, u in self.edges[v].items():
                if u in ends:
                    self.link[u], self.pops[u] = 1, 1
                else:
                    z, n = self.link[v], self.pops[v]
                    while z >= 0 and c not in self.edges[z]:
                        n += self.pops[z]
                        z = self.link[z]
                    if z >= 0:
                        self.link[u], self.pops[u] = self.edges[z][c], n
                queue.append(u)

    def count(self, word: str) -> int:
        """Pieces of a word; -1 if greedy matching gets stuck."""
        edges, link, pops = self.edges, self.link, self.pops
        v = n = 0
        for c in word:
            u = edges[v].get(c)
            while u is None:
                n += pops[v]
                v = link[v]
                if v < 0:
                    return -1
                u = edges[v].get(c)
            v = u
        while v > 1:
            n += pops[v]
            v = link[v]
            if v < 0:
                return -1
        return n

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        n = self.count(word.decode())
        if len(word) < 64:
            self[word] = n
        return n

    def __reduce__(self):
        return _restored, (self.edges, self.link, self.pops)


def _restored(edges, link, pops) -> Automaton:
    out = Automaton((), ())
    out.edges, out.link, out.pops = edges, link, pops
    return out


def vocabulary(path: str = VOCABULARY) -> tuple[list[str], list[str]]:
    """(pieces that begin a word, pieces that continue one) of a sentencepiece model, without control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))]
    return [p[1:] for p in pieces if p[0] == "▁" and p[1:]], [p for p in pieces if "▁" not in p]


def _count(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    automaton = shared.value
    of = automaton.__getitem__
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        raw = memoryview(data)
        n = np.zeros((3, batch.num_rows), np.int64)
        for d in range(batch.num_rows):
            words = bytes(raw[offsets[d] : offsets[d + 1]]).split()
            counts = list(map(of, words))
            stuck = counts.count(-1)
            n[:, d] = len(words), sum(counts) + 2 * stuck, stuck
        yield pa.record_batch([batch.column(0), *map(pa.array, n)], ["id", "n_words", "n_tokens", "n_unknown"])


def count_tokens(docs: DataFrame, pieces: tuple[list[str], list[str]], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_tokens, n_unknown) of every row.

    Words are runs of other characters than ASCII white space; a word has as many tokens as greedy
    longest match has pieces, or one, the unknown token, if some place of it has none. Null and
    empty texts have none. Each row is counted alone; other columns are not carried.
    """
    if sum(map(len, pieces)) > MOST_PIECES:
        raise ValueError(f"the vocabulary has more than {MOST_PIECES} pieces")
    shared = docs.sparkSession.sparkContext.broadcast(Automaton(*pieces))
    raw = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    out = in_batches(raw, lambda it: _count(it, shared), f"id {dict(raw.dtypes)['id']}, n_words long, n_tokens long, n_unknown long")
    return out.withColumnRenamed("id", doc_id)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-piece counts of every document under the vocabulary at VOCABULARY."""
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary())

"""Ordered lists: positional pairing, count windows, phrase search, long-pair splitting, line changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cantolith.functions import text as T
from cantolith.operators.scan import BLOCK, Fold, places, scan


def number(df: DataFrame, order: list[str], by: str = "doc_id", name: str = "n", total: str | None = None) -> DataFrame:
    """df with ordinals from 1 in order within by, and the total where it is named."""
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(by).orderBy(*order)).cast("bigint"))
    return out.withColumn(total, F.count("*").over(Window.partitionBy(by))) if total else out


def zip_lists(df: DataFrame, source: str, target: str, strict: bool = False) -> DataFrame:
    """A row (doc_id, pair_idx, src, tgt) for each position of two lists.

    The shorter list ends the pairing; strict raises an error where they differ in length.
    """
    n = F.least(F.size(source), F.size(target))
    if strict:
        wrong = F.format_string("the lists have %d and %d items, and must have as many", F.size(source), F.size(target))
        n = F.when(F.size(source) == F.size(target), n).otherwise(F.raise_error(wrong).cast("int"))
    both = F.slice(F.arrays_zip(F.col(source).alias("src"), F.col(target).alias("tgt")), F.lit(1), n)
    return df.select("doc_id", F.posexplode(both).alias("pair_idx", "_p")).select("doc_id", F.col("pair_idx").cast("bigint").alias("pair_idx"), F.col("_p.src").alias("src"), F.col("_p.tgt").alias("tgt"))


def hops(n: Column, window: int, stride: int) -> Column:
    """Starts 0, stride, 2*stride, ... up to the first window that reaches n; none for n = 0."""
    if window <= 0 or stride <= 0:
        raise ValueError("window and stride must be positive")
    last = F.greatest(F.lit(0), F.ceil((n - window) / stride)).cast("bigint")
    every = F.filter(F.transform(F.sequence(F.lit(0).cast("bigint"), last), lambda k: k * stride), lambda s: s < n)
    return F.when(n > 0, every).otherwise(F.array().cast("array<bigint>"))


def hopping_windows(df: DataFrame, items: str, window: int = 10, stride: int = 6) -> DataFrame:
    """(doc_id, start, items): the list's hopping windows, named by their start."""
    n = F.size(items).cast("bigint")
    return df.select("doc_id", items, F.explode(hops(n, window, stride)).alias("start")).select("doc_id", "start", F.slice(items, (F.col("start") + 1).cast("int"), window).alias("items"))


def chunks(df: DataFrame, items: str, size: int = 12) -> DataFrame:
    """(doc_id, chunk, items): lists of size items, the last may be shorter; chunks with only blank items are left out."""
    n = F.size(items)
    out = df.where(n > 0).select("doc_id", items, F.explode(F.sequence(F.lit(0), F.floor((n - 1) / size).cast("int"))).alias("chunk"))
    out = out.select("doc_id", F.col("chunk").cast("bigint").alias("chunk"), F.slice(items, F.col("chunk") * size + 1, size).alias("items"))
    return out.where(F.exists("items", lambda x: ~T.is_blank(x)))


def groups(words: DataFrame, size: int = 7) -> DataFrame:
    """(doc_id, line, words, start_s, end_s): size words a line, with the times they span."""
    line = F.floor(F.col("word_idx") / size).cast("bigint")
    own = words.select("doc_id", line.alias("line"), F.struct("word_idx", "word").alias("w"), "start_s", "end_s")
    out = own.groupBy("doc_id", "line").agg(F.array_sort(F.collect_list("w")).alias("w"), F.min("start_s").alias("start_s"), F.max("end_s").alias("end_s"))
    return out.select("doc_id", "line", F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("words"), "start_s", "end_s")


def context(df: DataFrame, order: str, value: str, reach: int = 1, name: str = "context") -> DataFrame:
    """df with the values of reach rows on both sides and its own, in order."""
    frame = Window.partitionBy("doc_id").orderBy(order).rowsBetween(-reach, reach)
    return df.withColumn(name, F.collect_list(value).over(frame))


def line_changes(words: DataFrame, line: str = "line", block: int = BLOCK) -> DataFrame:
    """words with is_first, is_last of their line, and silence before the word, where its start is after the last timed end."""
    of = F.struct(F.col(line).alias("l"))  # a null line is one as well
    out = scan(words, "doc_id", ["word_idx"], places("word_idx", block), _p=Fold("last", of, own=False), _n=Fold("last", of, back=True, own=False), _e=Fold("last", F.col("end_s"), own=False))
    differs = lambda other: F.col(other).isNull() | F.col(f"{other}.l").isNull() | (F.col(f"{other}.l") != F.col(line))
    gap = F.col("start_s") - F.col("_e")
    return out.withColumns({"is_first": differs("_p"), "is_last": differs("_n"), "silence": F.when(gap > 0, gap)}).drop("_p", "_n", "_e")


def words_to_lines(lines: DataFrame, items: str, limit: DataFrame | None = None) -> DataFrame:
    """(doc_id, word_idx, line_idx, word) of the words of a list of lines, cut at limit(doc_id, n) words.

    A list stands in one row, so its words are numbered there and no word is shuffled; limits meet the lists.
    """
    each = F.flatten(F.transform(items, lambda x, i: F.transform(T.tokens(x), lambda w: F.struct(i.cast("bigint").alias("line_idx"), w.alias("word")))))
    if limit is not None:
        lines = lines.join(limit.select("doc_id", F.col("n").alias("_n")), "doc_id")
        n = F.greatest(F.lit(0), F.least(F.col("_n"), F.lit((1 << 31) - 1))).cast("int")
        each = F.when(F.col("_n").isNotNull(), F.slice(each, F.lit(1), n))  # a null limit leaves no word
    out = lines.select("doc_id", F.posexplode(each).alias("word_idx", "_w"))
    return out.select("doc_id", F.col("word_idx").cast("bigint").alias("word_idx"), "_w.line_idx", "_w.word")


def phrase_places(words: Column, phrase: Column) -> Column:
    """Every index at which the lower-cased words of phrase stand in words."""

    def places(x):
        low, p = x["low"], x["p"]
        last = F.size(low) - F.size(p)
        return F.when((last >= 0) & (F.size(p) > 0), F.filter(F.sequence(F.lit(0), last), lambda i: (F.get(low, i) == F.get(p, F.lit(0))) & (F.slice(low, i + 1, F.size(p)) == p))).otherwise(F.array().cast("array<int>"))

    # a lambda's variable is computed once; the lists themselves would be made anew for every index
    return F.flatten(F.transform(F.array(F.struct(F.transform(words, F.lower).alias("low"), T.tokens(F.lower(phrase)).alias("p"))), places))


def only_place(words: Column, phrase: Column) -> Column:
    """The one place of a phrase; an error where it is not found, or more than once."""

    def only(at):
        wrong = F.when(F.size(at) == 0, F.concat(F.lit("no place has the words: "), phrase)).otherwise(F.concat(F.lit("several places have the words: "), phrase, F.lit(", at "), F.array_join(at.cast("array<string>"), ", ")))
        return F.when(F.size(at) == 1, F.get(at, F.lit(0))).otherwise(F.raise_error(wrong).cast("int"))

    # as a lambda's variable the places are looked for once
    return F.get(F.transform(F.array(phrase_places(words, phrase)), only), F.lit(0))


def markers(phrases: DataFrame, once: bool = False) -> DataFrame:
    """(doc_id, word_idx, ts) of phrases(doc_id, ord, words, phrase, timestamp); of one index the last ord wins.

    A phrase that does not stand exactly once is an error, or with once left out.
    """
    if once:  # a generator looks for the places once
        own = phrases.select("doc_id", "ord", F.explode(F.array(phrase_places(F.col("words"), F.col("phrase")))).alias("_at"), "timestamp").where(F.size("_at") == 1)
        own = own.select("doc_id", "ord", F.get("_at", F.lit(0)).cast("bigint").alias("word_idx"), T.seconds(F.col("timestamp")).alias("ts"))
    else:
        own = phrases.select("doc_id", "ord", only_place(F.col("words"), F.col("phrase")).cast("bigint").alias("word_idx"), T.seconds(F.col("timestamp")).alias("ts"))
    return own.groupBy("doc_id", "word_idx").agg(F.max_by("ts", "ord").alias("ts"))


def split_long(pairs: DataFrame, source: str = "src", target: str = "tgt", longest: int = 15, rounds: int = 40) -> DataFrame:
    """(doc_id, pair_idx, part, src, tgt) of pairs of line lists, split until no source has more than longest lines.

    A list is split at the point of T.split_point() of the source, the target at the same index, which may leave
    it nothing. Each round splits every list once in place, inside one expression, so no row is shuffled.
    rounds bounds the depth: a split leaves both parts shorter, and a part never has more than
    all lines but one; lists that need more rounds raise an error.
    """
    part = lambda s, t: F.struct(s.alias("s"), t.alias("t"))

    def split(x):
        s, t = x["s"], x["t"]
        at = T.split_point(s)
        head, tail = part(F.slice(s, F.lit(1), at), F.slice(t, F.lit(1), at)), part(F.slice(s, at + 1, F.size(s)), F.slice(t, at + 1, F.greatest(F.size(t), F.lit(1))))
        return F.when(F.size(s) > longest, F.array(head, tail)).otherwise(F.array(x))

    start = F.array(part(F.col(source), F.col(target)))
    done = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, lambda a, _: F.when(F.exists(a, lambda x: F.size(x["s"]) > longest), F.flatten(F.transform(a, split))).otherwise(a))
    checked = F.when(F.exists(done, lambda x: F.size(x["s"]) > longest), F.raise_error(F.lit(f"a pair needs more than {rounds} splits in a row")).cast("array<struct<s:array<string>,t:array<string>>>")).otherwise(done)
    out = pairs.select("doc_id", "pair_idx", F.posexplode(checked).alias("part", "_x"))
    return out.select("doc_id", "pair_idx", F.col("part").cast("bigint").alias("part"), F.array_join("_x.s", "\n").alias("src"), F.array_join("_x.t", "\n").alias("tgt"))

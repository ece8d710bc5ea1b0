"""Alignment quality: coverage, moving averages, low runs, length ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cantolith.operators.scan import BLOCK, Fold, ahead, places, scan


def timed(start: str = "start_s", end: str = "end_s") -> Column:
    """1 where a word has both times, else 0."""
    return F.when(F.col(start).isNotNull() & F.col(end).isNotNull(), 1).otherwise(0)


def coverage(words: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_timed, ratio, first_start, last_end) by document; times of no timed word are null and 0."""
    return words.groupBy("doc_id").agg(F.count("*").alias("n_words"), F.sum(timed()).cast("bigint").alias("n_timed"), F.avg(timed()).alias("ratio"), F.min("start_s").alias("first_start"), F.coalesce(F.max("end_s"), F.lit(0.0)).alias("last_end"))


def moving_sum(words: DataFrame, width: int = 20, block: int = BLOCK) -> DataFrame:
    """(doc_id, word_idx, n): timed words of the width words from word_idx on; only full windows.

    Words stand in blocks that also hold the width - 1 words after them, so a document of any length is dealt over many tasks.
    """
    own = ahead(words, "doc_id", ["word_idx"], places("word_idx", block), width - 1, block)
    frame = Window.partitionBy("doc_id", "_blk").orderBy("_at").rowsBetween(0, width - 1)
    return own.select("doc_id", "word_idx", "_home", F.sum(timed()).over(frame).alias("n"), F.count("*").over(frame).alias("_c")).where(F.col("_home") & (F.col("_c") == width)).drop("_c", "_home")


def low_runs(words: DataFrame, width: int = 20, margin: float = 0.2, least: int = 500, block: int = BLOCK) -> DataFrame:
    """(doc_id, start, end): runs [start, end) of at least least windows whose average is under the document's less margin.

    Sums of whole numbers are compared, so that no rounding decides: n * N < width * (T - margin * N).
    A run is told by the last window before it that is not low.
    """
    total = words.groupBy("doc_id").agg(F.sum(timed()).alias("_t"), F.count("*").alias("_n"))
    cut = F.round(F.lit(margin) * 1000).cast("bigint")
    low = F.col("n") * F.col("_n") * 1000 < width * (F.col("_t") * 1000 - cut * F.col("_n"))
    windows = moving_sum(words, width, block).join(total, "doc_id").select("doc_id", "word_idx", low.alias("low"))
    runs = scan(windows, "doc_id", ["word_idx"], places("word_idx", block), run=Fold("last", F.when(~F.col("low"), F.col("word_idx")))).where("low")
    out = runs.groupBy("doc_id", "run").agg(F.min("word_idx").alias("start"), (F.max("word_idx") + 1).alias("end"))
    return out.where(F.col("end") - F.col("start") >= least).select("doc_id", "start", "end")


def length_ratios(pairs: DataFrame, far: float = 1.5) -> DataFrame:
    """(doc_id, n_pairs, mean_src, mean_tgt, first_far): by document, first_far the first pair whose lengths' ratio is more than far off 1."""
    ratio = F.length("src") / F.nullif(F.length("tgt"), F.lit(0))
    return pairs.groupBy("doc_id").agg(F.count("*").alias("n_pairs"), F.avg(F.length("src")).alias("mean_src"), F.avg(F.length("tgt")).alias("mean_tgt"), F.min(F.when(F.abs(ratio - 1) > far, F.col("pair_idx"))).alias("first_far"))

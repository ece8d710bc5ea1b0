"""Timed words and time grids: absolute times, gaps, clamps, which word is active when.

Sequential repairs are closed forms: prefix sums, running maxima, last and next values in place of
loops. They are scans with a carry (operators.scan), so a document of any length is dealt over many
tasks. Interval lookups are equi-joins on time buckets, never a nested loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cantolith.operators.scan import BLOCK, Fold, places, scan


def starts(segments: DataFrame, order: str = "seg_id", block: int = BLOCK) -> DataFrame:
    """segments with start_s: the durations of all earlier segments of the document."""
    out = scan(segments, "doc_id", [order], places(order, block), start_s=Fold("sum", F.col("duration"), own=False))
    return out.withColumn("start_s", F.coalesce("start_s", F.lit(0)))


def absolute(words: DataFrame, segments: DataFrame) -> DataFrame:
    """words(doc_id, seg_id, start_s, end_s) with times from the document's beginning; blanked segments still count."""
    at = starts(segments).select("doc_id", "seg_id", F.col("start_s").alias("_at"))
    return words.join(at, ["doc_id", "seg_id"]).withColumns({"start_s": F.col("start_s") + F.col("_at"), "end_s": F.col("end_s") + F.col("_at")}).drop("_at")


def blank_segments(segments: DataFrame, blanked: DataFrame, words: str = "words") -> DataFrame:
    """segments with no words where blanked(doc_id, seg_id) names them; their duration stays."""
    own = blanked.select("doc_id", "seg_id", F.lit(True).alias("_blank")).distinct()
    kind = segments.schema[words].dataType
    return segments.join(own, ["doc_id", "seg_id"], "left").withColumn(words, F.when(F.col("_blank"), F.array().cast(kind)).otherwise(F.col(words))).drop("_blank")


def interpolate(words: DataFrame, widest: float = 20.0, block: int = BLOCK) -> DataFrame:
    """Untimed words between timed ones get equal steps of the gap, where it is at most widest.

    A step is the gap over the distance of the anchors' indices, so one step stays free before the
    later one; gaps at both ends stay null, negative ones are filled as well.
    """
    timed = F.col("start_s").isNotNull() & F.col("end_s").isNotNull()
    anchor = F.when(timed, F.struct("word_idx", "start_s", "end_s"))
    out = scan(words, "doc_id", ["word_idx"], places("word_idx", block), _p=Fold("last", anchor), _n=Fold("last", anchor, back=True))
    gap = F.col("_n.start_s") - F.col("_p.end_s")
    step = gap / (F.col("_n.word_idx") - F.col("_p.word_idx"))
    k = F.col("word_idx") - F.col("_p.word_idx")
    fill = ~timed & (gap <= widest)
    return out.withColumns({"start_s": F.when(fill, F.col("_p.end_s") + (k - 1) * step).otherwise(F.col("start_s")), "end_s": F.when(fill, F.col("_p.end_s") + k * step).otherwise(F.col("end_s"))}).drop("_p", "_n")


def monotonic_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """Timed words in order, each moved to the last end where it starts before it, its duration kept; untimed ones stay.

    end' = D + max over the prefix of (start - D before it), where D sums durations. Both are scanned at
    once: of a block of places the sum of durations and the maximum by its own sums are its state.
    """
    timed = F.col("start_s").isNotNull() & F.col("end_s").isNotNull()
    run = Window.partitionBy("doc_id", "_b").orderBy("word_idx").rowsBetween(Window.unboundedPreceding, 0)
    out = words.withColumn("_b", places("word_idx", block)).withColumn("_len", F.when(timed, F.col("end_s") - F.col("start_s"))).withColumn("_d", F.sum("_len").over(run))
    out = out.withColumn("_m", F.when(timed, F.col("start_s") - (F.col("_d") - F.col("_len"))))
    states = out.where("doc_id is not null").groupBy("doc_id", "_b").agg(F.coalesce(F.sum("_len"), F.lit(0.0)).alias("_sum"), F.max("_m").alias("_top"))
    blocks = Window.partitionBy("doc_id").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    left = states.withColumn("_before", F.coalesce(F.sum("_sum").over(blocks), F.lit(0.0))).select("doc_id", "_b", "_before", F.max(F.col("_top") - F.col("_before")).over(blocks).alias("_peak"))
    out = out.withColumn("_m", F.max("_m").over(run)).join(left, ["doc_id", "_b"], "left")
    before = F.coalesce("_before", F.lit(0.0))
    end = before + F.col("_d") + F.greatest("_peak", F.col("_m") - before)
    return out.withColumns({"start_s": F.when(timed, end - F.col("_len")).otherwise(F.col("start_s")), "end_s": F.when(timed, end).otherwise(F.col("end_s"))}).select(*words.columns)


def grid(totals: DataFrame, step: float) -> DataFrame:
    """(doc_id, tick, t_s) for every k with k * step < total_s."""
    last = F.ceil(F.col("total_s") / step).cast("bigint") - 1
    return totals.where(F.col("total_s") > 0).select("doc_id", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("tick")).withColumn("t_s", F.col("tick") * F.lit(float(step)))


def during(ticks: DataFrame, words: DataFrame, bucket: float) -> DataFrame:
    """(doc_id, tick, word_idx): the lowest word with start <= t <= end, where there is one."""
    b = lambda x: F.floor(F.col(x) / bucket)
    spans = words.where("start_s <= end_s").select("doc_id", "word_idx", "start_s", "end_s", F.explode(F.sequence(b("start_s"), b("end_s"))).alias("_b"))
    return ticks.withColumn("_b", b("t_s")).join(spans, ["doc_id", "_b"]).where("t_s between start_s and end_s").groupBy("doc_id", "tick").agg(F.min("word_idx").alias("word_idx"))


def before(ticks: DataFrame, words: DataFrame, tolerance: float, bucket: float = 600.0) -> DataFrame:
    """(doc_id, tick, t_s, word_idx or null): the word of the latest end at or before t, the lowest of equal ones, if t - end <= tolerance.

    Ends and ticks stand in blocks of bucket seconds; a scan brings the latest end across blocks.
    """
    ends = words.where("end_s is not null").select("doc_id", F.col("end_s").alias("t_s"), F.lit(0).alias("kind"), F.struct(F.col("end_s").alias("e"), (-F.col("word_idx")).alias("i")).alias("w"), F.lit(None).cast("bigint").alias("tick"))
    both = ends.unionByName(ticks.select("doc_id", "t_s", F.lit(1).alias("kind"), F.lit(None).cast(ends.schema["w"].dataType).alias("w"), "tick"))
    got = scan(both, "doc_id", ["t_s", "kind"], places("t_s", bucket), last=Fold("max", F.col("w"))).where("kind = 1")
    return got.select("doc_id", "tick", "t_s", F.when(F.col("t_s") - F.col("last.e") <= tolerance, -F.col("last.i")).alias("word_idx"))


def active(ticks: DataFrame, words: DataFrame, tolerance: float, bucket: float, title_until: float = 0.0) -> DataFrame:
    """(doc_id, tick, t_s, word_idx): -1 before title_until, else the word during t, else the one before it within tolerance, else null."""
    x = during(ticks, words, bucket).withColumnRenamed("word_idx", "_in")
    y = before(ticks, words, tolerance, bucket).withColumnRenamed("word_idx", "_before")
    at = F.when(F.col("t_s") < title_until, F.lit(-1).cast("bigint")).otherwise(F.coalesce("_in", "_before"))
    return y.join(x, ["doc_id", "tick"], "left").select("doc_id", "tick", "t_s", at.alias("word_idx"))


def active_runs(totals: DataFrame, words: DataFrame, step: float, tolerance: float, block: int = BLOCK) -> DataFrame:
    """(doc_id, tick, until, word_idx, block): active() over grid(totals, step), as runs [tick, until) of ticks with one value.

    Only ticks at which something changes are shuffled and scanned: those inside a word, the first one at or after
    an end, and 0, which brings the grid's end to the others. Repairs of frames hold for runs as well, by the same
    blocks (block="block") without a shuffle of them; ticks() gives the grid at last. Words of no document are in no grid.
    """
    step = float(step)
    from_ = lambda x, k: F.when((k - 1) * step >= x, k - 1).when(k * step < x, k + 1).otherwise(k)  # noqa: E731  quotients are rounded
    first = lambda x: from_(x, F.ceil(x / step).cast("bigint"))
    over = lambda e, k: F.when((k - 1) * step - e > tolerance, k - 1).when(k * step - e <= tolerance, k + 1).otherwise(k)
    no, at = F.lit(None).cast("bigint"), F.struct(F.col("end_s").alias("e"), (-F.col("word_idx")).alias("i"))
    mark = lambda tick, inside, end: F.struct(tick.alias("tick"), inside.alias("_in"), end.alias("_w"))
    low, high = F.greatest(F.lit(0).cast("bigint"), first(F.col("start_s"))), first(F.col("end_s"))
    high = F.when(high * step > F.col("end_s"), high - 1).otherwise(high)
    none = F.array().cast("array<bigint>")
    inside = F.when((F.col("start_s") <= F.col("end_s")) & (low <= high), F.sequence(low, high)).otherwise(none)
    ended = F.when(F.col("end_s").isNotNull(), F.array(F.greatest(F.lit(0).cast("bigint"), first(F.col("end_s"))))).otherwise(none)
    empty = F.when(F.lit(False), at)
    both = F.concat(F.transform(inside, lambda k: mark(k, F.col("word_idx").cast("bigint"), empty)), F.transform(ended, lambda k: mark(k, no, at)))
    marks = words.where("doc_id is not null").select("doc_id", F.explode(both).alias("x")).select("doc_id", "x.*", no.alias("_n"))
    ends = totals.where("doc_id is not null and total_s > 0").select("doc_id", F.lit(0).cast("bigint").alias("tick"), no.alias("_in"), F.lit(None).cast(marks.schema["_w"].dataType).alias("_w"), F.ceil(F.col("total_s") / step).cast("bigint").alias("_n"))
    marks = marks.unionByName(ends).groupBy("doc_id", "tick").agg(F.min("_in").alias("_in"), F.max("_w").alias("_w"), F.max("_n").alias("_n")).withColumn("block", places("tick", block))
    marks = scan(marks, "doc_id", ["tick"], "block", deal=True, _before=Fold("last", F.col("_w")), _next=Fold("last", F.col("tick"), back=True, own=False), _end=Fold("last", F.col("_n")))
    marks = marks.where("tick < _end").withColumn("until", F.least("_next", "_end"))
    e = F.col("_before.e")
    far = F.greatest("tick", F.least("until", F.coalesce(over(e, F.floor((e + tolerance) / step).cast("bigint") + 1), F.col("tick"))))
    rest = F.when(F.col("_in").isNotNull(), F.col("tick") + 1).otherwise(F.col("tick"))
    run = lambda low, high, value: F.struct(low.alias("tick"), high.alias("until"), value.alias("word_idx"))
    marks = marks.select("doc_id", "block", "tick", "until", "_in", rest.alias("_rest"), far.alias("_far"), (-F.col("_before.i")).alias("_i"))
    three = F.array(run(F.col("tick"), F.col("_rest"), F.col("_in")), run(F.col("_rest"), F.col("_far"), F.col("_i")), run(F.greatest("_far", "_rest"), F.col("until"), no))
    return marks.select("doc_id", "block", F.explode(three).alias("x")).select("doc_id", "x.*", "block").where("tick < until")


def ticks(runs: DataFrame, step: float) -> DataFrame:
    """(doc_id, tick, t_s, word_idx): every tick of runs(doc_id, tick, until, word_idx)."""
    each = runs.select("doc_id", F.explode(F.sequence("tick", F.col("until") - 1)).alias("tick"), "word_idx")
    return each.select("doc_id", "tick", (F.col("tick") * F.lit(float(step))).alias("t_s"), "word_idx")


def monotonic_frames(frames: DataFrame, order: DataFrame | None = None, at: str = "word_idx", block: int | str = BLOCK) -> DataFrame:
    """Of a document's ticks, one that goes back in the order takes the last valid one; nulls stay.

    order(at, pos) places the values; without it they are their own places. A value that is not
    in the order has place -1. block is a number of ticks, or the name of a column of blocks.
    """
    df = frames.withColumn("_pos", F.col(at)) if order is None else frames.join(order.select(at, F.col("pos").alias("_pos")), at, "left").withColumn("_pos", F.coalesce("_pos", F.lit(-1)))
    out = scan(df, "doc_id", ["tick"], places("tick", block), _best=Fold("max", F.when(F.col(at).isNotNull(), F.struct("_pos", at))))
    return out.withColumn(at, F.when(F.col(at).isNotNull(), F.col(f"_best.{at}"))).drop("_pos", "_best")


def fill_between(frames: DataFrame, at: str = "word_idx", block: int | str = BLOCK) -> DataFrame:
    """Nulls between two equal values take that value; block as in monotonic_frames."""
    df = scan(frames, "doc_id", ["tick"], places("tick", block), _p=Fold("last", F.col(at)), _n=Fold("last", F.col(at), back=True))
    return df.withColumn(at, F.coalesce(F.col(at), F.when(F.col("_p") == F.col("_n"), F.col("_p")))).drop("_p", "_n")


def first_words(segments: DataFrame, words: DataFrame, n: int = 8, bucket: float = 600.0) -> DataFrame:
    """(doc_id, seg_id, first_words): the first n words, in word order, with start in [start_s, end_s) of the segment.

    Only words of the segment's buckets meet it; of a segment the n smallest are kept by a
    partial top-n, whatever their number.
    """
    b = lambda x: F.floor(x / bucket)
    # ranking by the whole window gives the first n; each bucket's own first n are enough for it
    s = segments.where("end_s > start_s").select("doc_id", "seg_id", "start_s", "end_s", F.explode(F.sequence(b(F.col("start_s")), b(F.col("end_s")))).alias("_b"))
    w = words.where("start_s is not null").select("doc_id", "word_idx", "word", F.col("start_s").alias("_t"), b(F.col("start_s")).alias("_b"))
    met = s.join(w, ["doc_id", "_b"]).where("_t >= start_s and _t < end_s")
    near = Window.partitionBy("doc_id", "seg_id", "_b").orderBy("word_idx")
    few = met.withColumn("_r", F.row_number().over(near)).where(F.col("_r") <= n)
    own = few.groupBy("doc_id", "seg_id").agg(F.slice(F.array_sort(F.collect_list(F.struct("word_idx", "word"))), 1, n).alias("_w"))
    return own.select("doc_id", "seg_id", F.array_join(F.transform("_w", lambda x: x["word"]), " ").alias("first_words"))


def lookup_line(frames: DataFrame, lines: DataFrame) -> DataFrame:
    """frames with line_idx: of lines(doc_id, word_idx, line_idx); the title stays -1, unknown words have null."""
    out = frames.join(lines.select("doc_id", "word_idx", "line_idx"), ["doc_id", "word_idx"], "left")
    return out.withColumn("line_idx", F.when(F.col("word_idx") == -1, F.lit(-1).cast("bigint")).otherwise(F.col("line_idx")))


def at_tick(ticks: DataFrame, frames: DataFrame, default: Column) -> DataFrame:
    """ticks with the frame's word_idx, or default; the key is the whole tick, never the time."""
    return ticks.join(frames.select("doc_id", "tick", "word_idx"), ["doc_id", "tick"], "left").withColumn("word_idx", F.coalesce("word_idx", default))

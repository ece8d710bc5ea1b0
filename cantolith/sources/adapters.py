"""The data folder's tables as the shapes that the operators take: words, segments, blocks, pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cantolith.functions import text as T
from cantolith.session import table


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, word_idx, word, start_s, end_s): a user's events as words, 'error' ones untimed."""
    # renamed before the window, whose shuffle by doc_id then serves every later window by doc_id
    e = table(spark, sf_dir, "events").withColumnRenamed("user_id", "doc_id")
    order = Window.partitionBy("doc_id").orderBy("ts", "event_id")
    start = F.expr("timestampdiff(SECOND, timestamp_ntz'2024-01-01 00:00:00', ts)").cast("double")
    timed = F.col("event_type") != "error"
    return e.select("doc_id", (F.row_number().over(order) - 1).cast("bigint").alias("word_idx"), F.col("event_type").alias("word"), F.when(timed, start).alias("start_s"), F.when(timed, start + F.floor("value") * 60).alias("end_s"))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, seg_id, duration): a user's days as recordings; durations in whole hundredths."""
    day = F.expr("timestampdiff(DAY, timestamp_ntz'2024-01-01 00:00:00', ts)").cast("bigint")
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("doc_id"), day.alias("seg_id"), F.floor("value").cast("bigint").alias("v"))
    return e.groupBy("doc_id", "seg_id").agg(F.sum("v").alias("duration"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, lines): the non-blank lines of documents, in order."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", T.blocks_at(F.col("text"), "\n").alias("lines"))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, pair_idx, src, tgt): each user turn and the assistant's next one."""
    c = table(spark, sf_dir, "conversations")
    a = c.where("role = 'user'").select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("pair_idx"), F.col("text").alias("src"))
    b = c.where("role = 'assistant'").select(F.col("conv_id").alias("doc_id"), (F.col("turn") - 1).alias("pair_idx"), F.col("text").alias("tgt"))
    return a.join(b, ["doc_id", "pair_idx"])


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, title) of pages."""
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1).alias("title"))

"""From documents to a mixed training corpus, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cantolith.llm import decontaminate, mixing, near_dedup, quality_rules, substring_dedup
from cantolith.llm.common import checkpoint_folder, forget, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the counting rules and their language's band of perplexity.

    Null and empty texts go; equal rows stay or go together; an empty table stays empty.
    """
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each component of near-duplicates.

    Rows without doc_id and texts without words are in no component and stay; repeated rows of the
    doc_id that stays, stay; an empty table stays empty.
    """
    return near_dedup.drop_near_duplicates(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; n_chars follows the text.

    No row goes; null and empty texts stay as they are; of a passage that several rows hold the
    smallest doc_id keeps it, equal rows are treated alike; an empty table stays empty.
    """
    out = substring_dedup.remove_repeats(docs)
    n = F.when(F.size("_spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return out.select(*(n.alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns))


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    Null and empty texts stay; equal rows stay or go together; an empty table stays empty.
    """
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its words, posterior over domains, rate and copies.

    The decision is the column copies: how often a document is taken, 0 for not at all. No row goes
    here, as whoever writes the mix repeats or leaves rows by it. Null and empty texts have no words
    and a rate as well; equal rows have equal ones; an empty table stays empty.
    """
    return mixing.named(mixing.mix(docs, table(spark, sf_dir, "labels")), docs.columns)


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("substring dedup", repeats),
    ("benchmark decontamination", leaks),
    ("mixing", mixture),
]

#: No stage's rows can be told in SQL (hashes, models, alignments): tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, with a table in the shared checkpoint folder after each but the last.

    A table goes as soon as the next one is written; the last one stays, as the result reads it.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        path = f"{checkpoint_folder(spark)}/pipeline-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            forget(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)

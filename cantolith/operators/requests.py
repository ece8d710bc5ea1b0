"""Records to generation requests: first texts, style precedence, references, validity, stand-in providers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cantolith.functions import text as T


def prompt_of(*names: str) -> Column:
    """The first of the columns that is not empty; one of white space is taken, and then is no prompt (null)."""
    first = F.coalesce(*(T.not_empty(F.col(c)) for c in names or ("final_prompt", "prompt", "description")))
    return F.when(~T.is_blank(first), T.strip(first))


def requests(records: DataFrame, order: str = "ord", limit: int | None = None, style: str | None = None) -> DataFrame:
    """(ord, index, total, prompt, style) of the records with a prompt.

    limit (None: none, 0: no record) cuts before records are judged. The style is the one given,
    else the first global_style that is not blank of the records read, else the record's own.
    The global style is a scalar subquery; ordinals are counts before the record.
    """
    df = records
    if limit is not None:
        df = df.orderBy(order).limit(limit)
    blank = T.is_blank(F.coalesce(F.col("global_style"), F.lit("")))
    own = df.withColumn("prompt", prompt_of()).where("prompt is not null")
    if style:
        own = own.withColumn("style", F.lit(style))
    elif style is not None:
        own = own.withColumn("style", F.col("global_style"))
    else:
        shared = df.agg(F.min_by("global_style", F.when(~blank, F.col(order))))
        own = own.withColumn("style", F.coalesce(shared.scalar(), "global_style"))
    ranked = ordinals(own.select(order, "prompt", "style"), order)
    return ranked.select(F.col(order).alias("ord"), "index", "total", "prompt", "style")


def ordinals(df: DataFrame, order: str) -> DataFrame:
    """df with index from 1 in order over all rows, and total; order's values are whole numbers from 0 on.

    Rows are numbered within ranges of the order and shifted by the counts of the ranges before.
    Ranges are summed in groups of 4,096 and those among each other, so no task takes them all.
    """
    block = F.floor(F.col(order) / (1 << 12)).cast("bigint")
    counts = df.groupBy(block.alias("_b")).agg(F.count("*").alias("_c")).withColumn("_g", F.floor(F.col("_b") / (1 << 12)))
    groups = counts.groupBy("_g").agg(F.sum("_c").alias("_c"))
    # bounded: an order of 64 bits has a group for each 16 million of its values
    first = groups.select("_g", F.coalesce(F.sum("_c").over(Window.orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_first"))
    total = groups.agg(F.sum("_c")).scalar()
    inner = F.coalesce(F.sum("_c").over(Window.partitionBy("_g").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = counts.withColumn("_inner", inner).join(first, "_g").select("_b", (F.col("_first") + F.col("_inner")).alias("_before"), total.alias("total"))
    own = df.withColumn("_b", block).withColumn("_n", F.row_number().over(Window.partitionBy("_b").orderBy(order)))
    out = own.join(before.select("_b", "_before", "total"), "_b")
    return out.withColumn("index", (F.col("_n") + F.coalesce("_before", F.lit(0))).cast("bigint")).drop("_b", "_n", "_before")


def valid_transcription(language: Column, wanted: Column, words: Column) -> Column:
    """Whether a transcription is in the wanted language and has words."""
    return (language == wanted) & (F.size(words) > 0)


def same_newlines(a: Column, b: Column) -> Column:
    """Whether two texts have as many line ends."""
    n = lambda x: F.length(x) - F.length(F.replace(x, F.lit("\n"), F.lit("")))
    return n(a) == n(b)


def titled(title: Column) -> Column:
    return F.coalesce(T.not_empty(T.strip(title)), F.lit("untitled"))


def items_of(df: DataFrame, json: str) -> DataFrame:
    """df's rows for each item of a JSON list that is an object, with pos (from 0), title and description; json goes.

    Items of another kind are left out, and so is a text that is no list; a title that is missing or
    blank is `untitled`, texts are stripped.
    """
    own = df.withColumn("_v", F.try_parse_json(json)).drop(json)
    each = own.where(F.schema_of_variant("_v").startswith("ARRAY")).lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_v").outer()))
    field = lambda k: F.coalesce(T.strip(F.try_variant_get("value", f"$.{k}", "string")), F.lit(""))
    objects = each.where(F.schema_of_variant("value").startswith("OBJECT"))
    return objects.select(*(c for c in own.columns if c != "_v"), "pos", titled(field("title")).alias("title"), field("description").alias("description"))


def generate(df: DataFrame, column: str, provider: Callable[[], Callable[[str], str]], out: str = "answer") -> DataFrame:
    """df with a provider's answer to each text of column.

    provider sets up once for each partition and returns the function that answers; effects such as
    network calls are the provider's own business.
    """
    names = [*df.columns, out]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        answer = provider()
        for frame in frames:
            frame[out] = [None if x is None else answer(x) for x in frame[column]]
            yield frame[names]

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), f"`{out}` string"])
    return df.mapInPandas(run, schema)

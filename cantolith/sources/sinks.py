"""Writers: ordered CSV, JSON documents, JSONL with parallel text, summaries. None writes over its own input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantolith.sources import files


def write_csv(df: DataFrame, path: str, order: list[str]) -> None:
    """Range-partitioned by order, so that part files in name order are in order; a header, no index."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("errorifexists").option("header", True).csv(path)


def write_json_documents(df: DataFrame, path: str, key: str) -> None:
    """A folder key=... for each document, with its JSON (2 spaces of indent)."""
    cols = [c for c in df.columns if c != key]
    df.select(key, F.to_json(F.struct(*cols), {"pretty": "true"}).alias("value")).write.mode("errorifexists").partitionBy(key).text(path)


def write_files(df: DataFrame, path: str, name: str, text: str) -> None:
    """A file for each row, called by its column name, which is unique, with a line end after the text; executors write."""
    rows = df.select(F.col(name).alias("name"), F.encode(F.concat(F.coalesce(text, F.lit("")), F.lit("\n")), "UTF-8").alias("bytes"))
    files.register(df.sparkSession)
    rows.write.format("named_files").mode("append").save(path)


def write_jsonl(df: DataFrame, path: str, text: str, text_path: str, order: list[str]) -> None:
    """JSON lines, and the column text as lines of their own in the same order."""
    own = df.repartitionByRange(*order).sortWithinPartitions(*order)
    own.write.mode("errorifexists").json(path)
    own.select(F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit(" ")).alias("value")).write.mode("errorifexists").text(text_path)


def summary(df: DataFrame, *aggregates: Column) -> DataFrame:
    """One row: a JSON object of aggregates."""
    one = df.agg(*aggregates)
    return one.select(F.to_json(F.struct(*one.columns)).alias("json"))


def joined(df: DataFrame, order: str, value: str, separator: str = "\n\n", by: str = "doc_id") -> DataFrame:
    """(by, text): the values of a document, in order, joined."""
    own = df.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(order, value))).alias("_x"))
    return own.select(by, F.array_join(F.transform("_x", lambda x: x[value]), separator).alias("text"))

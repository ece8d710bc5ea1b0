"""Answers of services: attempts until one is valid, and a memo of what was answered before."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cantolith.session import cut

VALID, INVALID, ERROR = "valid", "invalid", "error"
#: Attempts that a task sorts.
ROWS = 1 << 20


def outcome(attempts: DataFrame, most: int, item: str = "item") -> DataFrame:
    """(item, outcome, attempt, n_invalid) of attempts(item, attempt, kind), in the order of attempt.

    The first valid attempt ends an item, unless most invalid ones stand before it: then it is
    `exhausted`. An error doesn't count. An item with neither is `open`. attempt is the one that ended
    the item, n_invalid how many invalid ones there were until then. Attempts are counted as they pass in
    order; those of an item are never gathered.
    """
    seen = Window.partitionBy(item).orderBy("attempt").rangeBetween(Window.unboundedPreceding, 0)
    number = F.when(F.col("kind") == INVALID, 1).when(F.col("kind") == VALID, 2).otherwise(0).cast("tinyint")
    own = attempts.select(item, "attempt", number.alias("_k"))
    # parts by rows: such rows compress well, so parts merged by bytes would hold very many
    own = own.repartition(own.count() // ROWS + 1, item).withColumn("_n", F.count_if(F.col("_k") == 1).over(seen))
    valid, over = F.col("_k") == 2, F.col("_n") >= most
    at = lambda c, x: F.min(F.when(c, F.col(x)))
    df = own.groupBy(item).agg(at(valid, "attempt").alias("_valid"), at(over, "attempt").alias("_last"), at(valid, "_n").alias("_n_valid"), at(over, "_n").alias("_n_last"), F.max("_n").alias("_n"))
    won = F.col("_valid").isNotNull() & (F.col("_last").isNull() | (F.col("_valid") < F.col("_last")))
    end = F.when(won, F.col("_valid")).otherwise(F.col("_last"))
    kind = F.when(won, VALID).when(F.col("_last").isNotNull(), "exhausted").otherwise("open")
    return df.select(item, kind.alias("outcome"), end.alias("attempt"), F.coalesce(F.when(won, F.col("_n_valid")), "_n_last", "_n").alias("n_invalid"))


def until_valid(items: DataFrame, send: Callable[[DataFrame], DataFrame], valid: Column, most: int, rounds: int = 100) -> DataFrame:
    """items with answer, outcome, attempt and n_invalid: each sent again until valid holds, most invalid answers at most.

    send gets the items still open, with attempt (from 1), and gives each an answer and an error (null:
    none); an error is sent again and doesn't count. Only rejected items are sent on, those ended are
    written each round and not computed again. What is open after rounds stays `open`, without an answer.
    """
    names = items.columns
    left, done = cut(items.withColumn("n_invalid", F.lit(0).cast("bigint"))), None
    for k in range(1, rounds + 1):
        if left.isEmpty():
            break
        kind = F.when(F.col("error").isNotNull(), ERROR).when(F.coalesce(valid, F.lit(False)), VALID).otherwise(INVALID)
        sent = cut(send(left.withColumn("attempt", F.lit(k))).withColumn("_kind", kind).withColumn("n_invalid", F.col("n_invalid") + F.when(F.col("_kind") == INVALID, 1).otherwise(0)))
        over = (F.col("_kind") == VALID) | (F.col("n_invalid") >= most)
        end = sent.where(over).select(*names, F.when(F.col("_kind") == VALID, F.col("answer")).alias("answer"), F.when(F.col("_kind") == VALID, VALID).otherwise("exhausted").alias("outcome"), "attempt", "n_invalid")
        done = end if done is None else done.unionByName(end)
        left = sent.where(~over).select(*names, "n_invalid")
    rest = left.select(*names, F.lit(None).cast("string").alias("answer"), F.lit("open").alias("outcome"), F.lit(None).cast("int").alias("attempt"), "n_invalid")
    return rest if done is None else done.unionByName(rest)


def remembered(df: DataFrame, key: str, path: str, answer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """df with value and known: the answer for its key, from the memo in path or, for new keys, from answer.

    answer gets the distinct keys that the memo lacks, as rows (key), and gives (key, value); answers
    that are neither null nor empty are appended to the memo before df is joined with it, so equal keys
    are asked for once and a second run asks for none. known tells whether the memo had the key before.
    A null key isn't asked for. One run at a time may write a memo.
    """
    spark, kind = df.sparkSession, dict(df.dtypes)[key]
    memo = lambda: spark.read.schema(f"key {kind}, value string").parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        spark.createDataFrame([], f"key {kind}, value string").write.parquet(path)
    before = cut(memo().select("key"))
    keys = df.select(F.col(key).alias("key")).where("key is not null").distinct()
    new = answer(keys.join(before, "key", "left_anti")).select("key", "value").where("value <> ''")
    new.write.mode("append").parquet(path)
    had = before.withColumn("known", F.lit(True))
    now = memo().join(had, "key", "left").withColumn("known", F.coalesce("known", F.lit(False))).withColumnRenamed("key", "_key")
    return df.join(now, F.col(key) == F.col("_key"), "left").drop("_key").withColumn("known", F.coalesce("known", F.lit(False)))

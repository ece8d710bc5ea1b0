"""Blocked Bloom filters of bounded size whatever they hold: in DataFrame expressions, and as an array for digests in Python."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8
#: Blocks of a filter of digests.
DIGEST_BLOCKS = 1 << 16


def _bits(key: Column) -> list[Column]:
    h = F.xxhash64(key, F.lit(1))
    return [F.call_function("shiftleft", F.lit(1).cast("long"), (F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63))).cast("int")) for i in range(WORDS)]


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks)).cast("int")


def bloom(keys: DataFrame, key: str, n_blocks: int) -> DataFrame:
    """(block, w0..w7): the blocked Bloom filter of a column; n_blocks rows at most."""
    cols = [_block(F.col(key), n_blocks).alias("_block"), *(b.alias(f"_w{i}") for i, b in enumerate(_bits(F.col(key))))]
    return keys.where(F.col(key).isNotNull()).select(*cols).groupBy("_block").agg(*(F.bit_or(f"_w{i}").alias(f"_w{i}") for i in range(WORDS)))


def probe(df: DataFrame, key: str, keys: DataFrame, keys_col: str, n_blocks: int, flag: str) -> DataFrame:
    """df with a boolean column flag: false only where key is surely not in keys.

    The filter is broadcast: n_blocks rows of 68 bytes bound it. Null keys get false.
    """
    found = [F.col(f"_w{i}").bitwiseAND(b) == b for i, b in enumerate(_bits(F.col(key)))]
    all_found = F.col(key).isNotNull()
    for x in found:
        all_found = all_found & x
    return (
        df.withColumn("_b", _block(F.col(key), n_blocks))
        .join(F.broadcast(bloom(keys, keys_col, n_blocks)), F.col("_b") == F.col("_block"), "left")
        .withColumn(flag, F.coalesce(all_found, F.lit(False)))
        .drop("_b", "_block", *(f"_w{i}" for i in range(WORDS)))
    )


def digest_filter(keys: DataFrame, digest: str) -> np.ndarray:
    """The filter of a column of 64-bit digests, WORDS words for each of DIGEST_BLOCKS blocks: 4 MB."""
    own = F.col(digest)
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(own, 16 + 6 * i).bitwiseAND(F.lit(63)).cast("int")).alias(f"w{i}") for i in range(WORDS)]
    rows = keys.select(own.bitwiseAND(F.lit(DIGEST_BLOCKS - 1)).alias("block"), *bits).groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)))
    out = np.zeros((DIGEST_BLOCKS, WORDS), np.int64)
    t = rows.toArrow()  # bounded: DIGEST_BLOCKS rows
    for i in range(WORDS):
        out[np.asarray(t["block"]), i] = np.asarray(t[f"w{i}"])
    return out.view(np.uint64)


def may_hold(table: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """Whether each digest may be in the filter."""
    own = digests.view(np.uint64)
    block = own & np.uint64(DIGEST_BLOCKS - 1)
    out = np.ones(len(own), bool)
    for i in range(WORDS):
        out &= (table[block, i] >> ((own >> np.uint64(16 + 6 * i)) & np.uint64(63))) & np.uint64(1) == 1
    return out

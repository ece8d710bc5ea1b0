"""First-wins distinct, fuzzy lookups, set differences, collision-free names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cantolith.functions import text as T
from cantolith.operators.scan import BLOCK, Fold, places, scan


# Suffixes of images and of audio files, these in order of preference.
IMAGES = (".png", ".jpg", ".jpeg", ".webp")
AUDIO = (".wav", ".mp3", ".flac", ".ogg", ".m4a")


def first_distinct(df: DataFrame, key: str, order: list[str], most: int | None = None) -> DataFrame:
    """The first row of each key in order, and of these the first most (None or 0: all), in order.

    The first rows are partial minima, so a key of any number of rows is not gathered in one task.
    """
    cols = df.columns
    rank = F.struct(*(F.col(c) for c in order), *(F.col(c) for c in cols if c not in order))
    out = df.groupBy(F.col(key).alias("_key")).agg(F.min(rank).alias("_first")).select(*(F.col(f"_first.{c}").alias(c) for c in cols))
    return out.orderBy(*order).limit(most) if most else out


def fuzzy_lookup(names: DataFrame, cards: DataFrame) -> DataFrame:
    """(name, path) of names(name) and cards(stem, path, ord): by trimmed lower-case name, else by letters and digits.

    A miss takes the first card whose letters and digits equal the name's, begin them or are begun
    by them. Prefixes of both sides are keys of an equi-join, so no pair is compared for nothing. A
    name without letters and digits begins every card and so takes the first one, which is one row
    that all such names share; an empty name matches nothing. A card without letters and digits
    begins every name.
    """
    n = names.select("name").distinct()
    exact = cards.select(F.lower(F.trim("stem")).alias("_k"), "path", "ord").groupBy("_k").agg(F.max_by("path", "ord").alias("_exact"))
    met = n.withColumn("_k", F.lower(F.trim("name"))).join(exact, "_k", "left")
    miss = met.where("_exact is null and _k <> ''").select("name", T.alnum(F.col("name")).alias("_a"))
    keyed = cards.select("path", "ord", T.alnum(F.col("stem")).alias("_c"))
    least = lambda df: (df.agg(F.min_by("path", "ord")).scalar().alias("path"), df.agg(F.min("ord")).scalar().alias("ord"))
    by_all = miss.where("_a = ''").select("name", *least(cards)).union(miss.where("_a <> ''").select("name", *least(keyed.where("_c = ''")))).where("path is not null")
    miss, keyed = miss.where("_a <> ''"), keyed.where("_c <> ''")
    cut = lambda c: F.explode(F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.substring(F.col(c), F.lit(1), i)))
    shorter = miss.withColumn("_p", cut("_a")).join(keyed, F.col("_p") == F.col("_c")).select("name", "path", "ord")
    longer = miss.join(keyed.withColumn("_p", cut("_c")), F.col("_a") == F.col("_p")).select("name", "path", "ord")
    near = shorter.union(longer).union(by_all).groupBy("name").agg(F.min_by("path", "ord").alias("_near"))
    return met.join(near, "name", "left").select("name", F.coalesce("_exact", "_near").alias("path"))


def cards_of(paths: DataFrame) -> DataFrame:
    """(stem, path, ord) of image paths; of one lower-cased stem the last path in order counts."""
    ok = paths.where(T.suffix(F.col("path")).isin(*IMAGES))
    own = ok.select(F.lower(T.stem(F.col("path"))).alias("stem"), "path").groupBy("stem").agg(F.max("path").alias("path"))
    return own.select("stem", "path", F.col("stem").alias("ord"))


def distinct_in_order(x: Column) -> Column:
    """A list's values at their first places."""
    return F.array_distinct(x)


def new_only(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in seen: what is still to do."""
    return df.join(seen.select(key).distinct(), key, "left_anti")


def existing_only(df: DataFrame, listed: DataFrame, key: str, required: bool = False) -> DataFrame:
    """Rows whose key is in listed; required raises an error at once where there is none."""
    out = df.join(listed.select(key).distinct(), key, "left_semi")
    if required and out.isEmpty():
        raise ValueError("none of the files exists")
    return out


def newest_last(df: DataFrame, mtime: str = "mtime", name: str = "path", most: int | None = None) -> DataFrame:
    """Files in order of their time, then name; the last most of them, if given."""
    return df.orderBy(mtime, name) if most is None else df.orderBy(F.desc(mtime), F.desc(name)).limit(most).orderBy(mtime, name)


def free_names(df: DataFrame, name: str, order: str, out: str = "file", block: int = BLOCK) -> DataFrame:
    """df with out: name, and _01, _02, ... before the suffix of its later uses, in an order of whole numbers.

    Uses are counted by a scan, so a name of any share of the rows is dealt over many tasks. A row
    without a name has none.
    """
    used = scan(df, name, [order], places(order, block), _k=Fold("sum", F.lit(1), own=False))
    k = F.coalesce("_k", F.lit(0))
    base, ext = T.stem(F.col(name)), F.regexp_extract(name, r"^.+(\.[^.]+)$", 1)
    return used.withColumn(out, F.when(k == 0, F.col(name)).otherwise(F.concat(base, F.lit("_"), T.padded(k), ext))).drop("_k")


def sidecar(df: DataFrame, files: DataFrame, exts: tuple[str, ...] = AUDIO) -> DataFrame:
    """df(path) with audio: the file of the same stem whose suffix comes first in exts, or null."""
    rank = F.coalesce(*(F.when(T.suffix(F.col("path")) == e, k) for k, e in enumerate(exts)))
    own = files.select(T.stem(F.col("path")).alias("_s"), rank.alias("_r"), "path").where("_r is not null").groupBy("_s").agg(F.min_by("path", F.struct("_r", "path")).alias("audio"))
    return df.join(own, T.stem(df["path"]) == own["_s"], "left").drop("_s")

"""URL filters: host and path rules, then a blocked Bloom filter in front of an exact hash join.

Everything is DataFrame expressions. The filter has one row for each block of 8 words of 64 bits; a
key sets one bit in each word of its block. It has n_blocks rows at most whatever the list's
length, which bounds the broadcast; a list too long for it lets more urls through to the exact
join and changes no verdict. Only urls that pass the filter are shuffled. A listed url without a
path lists its whole site: the host of two or three labels and all its subdomains.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bloom import probe
from .common import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The rules (verdict, host, path) of the url contract.
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without '://'."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """What listed and judged urls are compared by: host and path without closing slashes; null without a host."""
    return F.when(host != "", F.concat(host, F.regexp_replace(path, "/+$", "")))


#: Labels of the hosts that can be listed as a site.
LABELS = (2, 3)


def site(host: Column, labels: int) -> Column:
    """The last labels of a host, or all of a shorter one; null without a host."""
    return F.when(host != "", F.substring_index(host, ".", -labels))


def rule_column(rules: Sequence[tuple[str, str, str]], host: Column, path: Column, value) -> Column:
    """value(verdict, host, path) of the longest rule that fits; a rule fits its host and all subdomains."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule[1]) | host.endswith("." + rule[1])) & path.startswith(rule[2])
        out = F.when(fits, F.lit(value(*rule))).otherwise(out)
    return out


def judge_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    n_blocks: int = 1 << 15,
) -> DataFrame:
    """(id, host, path, rule, verdict, listed) of every row of pages, by the rules and the listed urls.

    verdict: the longest fitting rule's, else 'block' if the canonical url or its site is in
    listed(url), else 'allow'. Null and malformed urls have an empty host and path, match nothing and are allowed;
    repeated rows are each judged; other columns, also of these names, are not carried. An empty
    list blocks nothing; an empty table gives an empty result.
    """
    host, path = url_parts(F.col("_url"))
    base = (
        pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"))
        .select("_id", host.alias("_host"), path.alias("_path"))
        .withColumn("_rule", rule_column(rules, F.col("_host"), F.col("_path"), lambda v, h, p: h + p))
        .withColumn("_verdict", rule_column(rules, F.col("_host"), F.col("_path"), lambda v, h, p: v))
        .withColumn("_key0", canonical(F.col("_host"), F.col("_path")))
        .withColumns({f"_key{n}": site(F.col("_host"), n) for n in LABELS})
    )
    lh, lp = url_parts(F.col("url"))
    keys = listed.select(canonical(lh, lp).alias("_lkey")).where("_lkey is not null").distinct()
    names = ["_key0", *(f"_key{n}" for n in LABELS)]
    probed = base
    for k in names:
        probed = probe(probed, k, keys, "_lkey", n_blocks, f"_maybe{k}")
    maybe = functools.reduce(lambda a, b: a | b, (F.col(f"_maybe{k}") for k in names))
    sure = probed.where(~maybe).withColumn("_hit", F.lit(False))
    exact = probed.where(maybe).withColumn("_hit", F.lit(False))
    for k in names:
        one = keys.select(F.col("_lkey"), F.lit(True).alias("_in"))
        exact = exact.join(one, F.col(k) == F.col("_lkey"), "left").withColumn("_hit", F.col("_hit") | F.coalesce("_in", F.lit(False))).drop("_lkey", "_in")
    return sure.unionByName(exact).select(
        F.col("_id").alias(id_col),
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule").alias("rule"),
        F.coalesce("_verdict", F.when(F.col("_hit"), "block").otherwise("allow")).alias("verdict"),
        F.col("_hit").alias("listed"),
    )


# What the names of gambling, pill and adult sites are put together of; each name stands under each domain.
BEFORE = ("", "best-", "big-", "buy-", "cheap-", "free-", "hot-", "live-", "my-", "online-", "real-", "super-", "top-", "vip-")
SUBJECTS = ("adult", "bet", "bets", "betting", "bingo", "casino", "escort", "jackpot", "lottery", "pharma", "pill", "pills", "poker", "porn", "replica", "roulette", "sex", "slots", "viagra", "xxx")
AFTER = ("", "-24", "-bonus", "-club", "-deal", "-deals", "-live", "-online", "-play", "-shop", "-store", "-win", "-x", "-xxx")
DOMAINS = ("example.com", "example.net", "example.org", "example.info")


def listed_urls(spark: SparkSession) -> DataFrame:
    """The block list that the query uses: sites made of BEFORE, SUBJECTS, AFTER and DOMAINS."""
    df = spark.range(1)
    for name, values in zip("bsad", (BEFORE, SUBJECTS, AFTER, DOMAINS), strict=True):
        df = df.select("*", F.explode(F.array(*map(F.lit, values))).alias(name))
    return df.select(F.format_string("https://%s%s%s.%s/", "b", "s", "a", "d").alias("url"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every url of pages judged by RULES and the block list."""
    return judge_urls(table(spark, sf_dir, "pages"), listed_urls(spark))


_VALUES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
_CROSS = " CROSS JOIN ".join(f"(SELECT unnest([{', '.join(map(repr, x))}]) AS {c}) AS x{c}" for c, x in zip("bsad", (BEFORE, SUBJECTS, AFTER, DOMAINS), strict=True))
SQL = f"""
WITH parts AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
    row_number() OVER () AS rid
  FROM pages),
rules(v, h, p) AS (VALUES {_VALUES}),
best AS (
  SELECT rid, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS v
  FROM parts, rules
  WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY rid),
listed AS (
  SELECT DISTINCT b || s || a || '.' || d AS k FROM {_CROSS}),
hits AS (
  SELECT DISTINCT rid FROM parts, LATERAL (SELECT unnest([
    host || regexp_replace(path, '/+$', ''),
    array_to_string(string_split(host, '.')[-2:], '.'),
    array_to_string(string_split(host, '.')[-3:], '.')]) AS c) JOIN listed ON c = k
  WHERE host <> '')
SELECT page_id, host, path, rule,
  coalesce(v, CASE WHEN hits.rid IS NULL THEN 'allow' ELSE 'block' END) AS verdict, hits.rid IS NOT NULL AS listed
FROM parts LEFT JOIN best USING (rid)
LEFT JOIN hits ON hits.rid = parts.rid
"""

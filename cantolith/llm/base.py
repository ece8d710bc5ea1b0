"""SQL for what SQL can express of these operators, and queries of those columns alone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import license_scan, near_dedup, quality_rules
from .common import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LOW = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"


def components_sql(shingle: int, percent: int) -> str:
    """Tables d, n (set sizes) and c (components) of documents: every pair that shares a shingle is compared, components are the closure of the links."""
    return rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_LOW)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {shingle} THEN list_transform(range(1, len(w) - {shingle - 2}), lambda i: array_to_string(w[i:i + {shingle - 1}], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS x FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * shared >= {percent} * (na.n + nb.n - shared)),
r(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
"""


NEAR_DUPLICATES = components_sql(near_dedup.SHINGLE, near_dedup.PERCENT) + "SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM d LEFT JOIN n USING (doc_id) JOIN c USING (doc_id)"

_PLACES = ", ".join(f"list_transform(list_filter(range(0, len(w) - {len(p.split()) - 1}), lambda i: w[i + 1:i + {len(p.split())}] = {p.split()!r}), lambda i: struct_pack(i := i, label := '{label}'))" for p, label in license_scan.BASE.items())
LICENSE_BASE = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
p AS (SELECT doc_id, w, flatten([{_PLACES}]) AS p FROM d)
SELECT doc_id, len(w) AS n_words, len(p) AS n_base, list_min(list_transform(p, lambda x: x.i)) AS first_word, list_max(list_transform(p, lambda x: x.i)) AS last_word, array_to_string(list_sort(list_distinct(list_transform(p, lambda x: x.label))), ',') AS base_labels FROM p
"""

QUALITY_BASE = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS.format("coalesce(text, '')")} AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
e AS (SELECT doc_id, unnest(range(1, len(w) - {quality_rules.WINDOW - 2})) AS i, w FROM d WHERE len(w) >= {quality_rules.WINDOW}),
k AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i + {quality_rules.WINDOW - 1}], ' ')) AS c FROM e),
r AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(i, i + {quality_rules.WINDOW})) AS place FROM k WHERE c > 1) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
  len(w) < 10 OR 100 * coalesce(r.n, 0) > 20 * len(w) AS base_failed
FROM d LEFT JOIN r USING (doc_id)
"""


def license_base_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base columns of op1_license_scan, over all documents."""
    out = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def quality_base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base columns of op7_quality_rules, over all documents."""
    out = quality_rules.quality_rules(table(spark, sf_dir, "documents"))
    return out.select("doc_id", *quality_rules.COUNTS, "base_failed")

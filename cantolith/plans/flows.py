"""Further registered queries: alignment with markers, band joins, sinks and sources of one's own, retries, memos, fitting, configs."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cantolith.functions import fitting
from cantolith.functions import text as T
from cantolith.operators import alignment, attempts, bands, matching, quality, requests
from cantolith.operators.scan import Fold, places, scan
from cantolith.plans.more import alignment_sql
from cantolith.plans.registry import SECONDS, query
from cantolith.session import cut, scratch, table
from cantolith.sources import files, readers, sinks
from cantolith.streaming import clamp


@query(alignment_sql(True))
def align_marked(spark: SparkSession, d: str) -> DataFrame:
    """Each turn's words, heard a second each, aligned with the next turn's, of which each ninth has a marker."""
    t = table(spark, d, "conversations").select("conv_id", "turn", T.tokens(F.col("text")).alias("words"))
    doc = F.col("a.conv_id") * 1000 + F.col("a.turn")
    heard = t.alias("a").select(doc.alias("doc_id"), F.posexplode("words").alias("word_idx", "word"))
    heard = heard.select("doc_id", "word_idx", "word", F.col("word_idx").cast("double").alias("start_s"), (F.col("word_idx") + 1.0).alias("end_s"))
    texts = t.alias("b").join(t.alias("a"), (F.col("a.conv_id") == F.col("b.conv_id")) & (F.col("b.turn") == F.col("a.turn") + 1)).select(doc.alias("doc_id"), F.col("b.words").alias("words"))
    j = F.col("word_idx")
    markers = texts.select("doc_id", F.posexplode("words").alias("word_idx", "_w")).where("word_idx % 9 = 4").select("doc_id", "word_idx", (j + j % 4 * 0.5).alias("ts"))
    return alignment.align_words(heard, texts, markers, 0.3)


_NEAR = """p AS (SELECT *, row_number() OVER (ORDER BY similarity DESC, gap, "left", "right") AS k FROM (
  SELECT c_custkey AS "left", s_suppkey AS "right", CAST(round((1 - levenshtein(lower(c_name), lower(s_name)) / greatest(length(c_name), length(s_name))) * 1000000) AS BIGINT) AS similarity, abs(c_acctbal - s_acctbal) AS gap
  FROM customer, supplier WHERE abs(c_acctbal - s_acctbal) < 20))"""


def _sides(spark: SparkSession, d: str) -> tuple:
    """Both tables by name and balance, and how near they must be."""
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("left"), F.col("c_name").alias("a"), F.col("c_acctbal").alias("at"))
    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("right"), F.col("s_name").alias("b"), F.col("s_acctbal").alias("at"))
    return c, s, "at", 20.0, "a", "b"


@query(f'WITH {_NEAR} SELECT "left", "right", similarity, round(gap, 6) AS gap FROM p QUALIFY row_number() OVER (PARTITION BY "left" ORDER BY k) = 1')
def band_best(spark: SparkSession, d: str) -> DataFrame:
    """Of each customer the supplier of the likest name among those whose balance is less than 20 off."""
    return bands.best_near(*_sides(spark, d)).withColumn("gap", F.round("gap", 6))


@query(f"""WITH RECURSIVE {_NEAR},
g(k, a, b, took) AS (SELECT 0::BIGINT, []::BIGINT[], []::BIGINT[], false UNION ALL
  SELECT k, CASE WHEN ok THEN list_append(a, "left") ELSE a END, CASE WHEN ok THEN list_append(b, "right") ELSE b END, ok
  FROM (SELECT p.k, a, b, "left", "right", NOT list_contains(a, "left") AND NOT list_contains(b, "right") AS ok FROM g JOIN p ON p.k = g.k + 1))
SELECT "left", "right", similarity, round(gap, 6) AS gap FROM g JOIN p USING (k) WHERE took""")
def band_one_to_one(spark: SparkSession, d: str) -> DataFrame:
    """The same, no supplier twice: the first pair of all, then the first of those left, and so on."""
    return bands.one_to_one_near(*_sides(spark, d)).withColumn("gap", F.round("gap", 6))


@query("""SELECT p_partkey // 50 AS page, p_partkey % 50 AS pos, CASE WHEN p_partkey % 3 = 1 THEN 't' ELSE 'i' END || p_partkey AS id FROM part WHERE p_partkey % 7 <> 5""")
def cursor_track_ids(spark: SparkSession, d: str) -> DataFrame:
    """Parts served as pages of fifty, some as tracks and some without an id, read by their cursors."""
    k = F.col("p_partkey")
    own = F.when(k % 7 != 5, F.concat(F.lit("i"), k))
    track = F.when(k % 3 == 1, F.struct(F.when(k % 7 != 5, F.concat(F.lit("t"), k)).alias("id")))
    p = table(spark, d, "part").select(F.floor(k / 50).alias("page"), F.struct(k.alias("k"), own.alias("id"), track.alias("track")).alias("x"))
    total = p.agg(F.count("*")).scalar()
    answer = F.struct(F.transform("items", lambda x: F.struct(x["id"], x["track"])).alias("items"), total.alias("total"), F.lit(50).alias("limit"))
    pages = p.groupBy("page").agg(F.array_sort(F.collect_list("x")).alias("items")).select(F.concat((F.col("page") * 50).cast("string"), F.lit(".json")).alias("name"), F.to_json(answer).alias("json"))
    path = scratch(spark)
    sinks.write_files(pages, path, "name", "json")
    return readers.track_ids(files.register(spark).read.format("cursor_pages").option("per_task", "4").load(path))


@query("""SELECT p_brand || CASE WHEN k > 0 THEN '_' || lpad(CAST(k AS VARCHAR), CAST(greatest(2, length(CAST(k AS VARCHAR))) AS INT), '0') ELSE '' END || '.png' AS name, CAST(octet_length(encode(p_name || '/' || p_partkey)) AS BIGINT) AS length, p_name || '/' || p_partkey AS text
FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS k FROM part)""")
def written_images(spark: SparkSession, d: str) -> DataFrame:
    """Payloads written by the executors under their brand's name, later ones with a suffix, and read again."""
    p = table(spark, d, "part").select("p_partkey", F.concat("p_brand", F.lit(".png")).alias("brand"), F.encode(F.concat_ws("/", "p_name", F.col("p_partkey").cast("string")), "UTF-8").alias("bytes"))
    path = scratch(spark)
    files.register(spark)
    own = cut(matching.free_names(p, "brand", "p_partkey", "name").select("name", "bytes"))
    files.dealt(own, "name").write.format("named_files").mode("append").save(path)
    return cut(files.contents(own, path).select("name", "length", F.decode("content", "UTF-8").alias("text")))


_SENT = """t AS (SELECT o_orderkey AS item, CAST(unnest(range(1, 13)) AS INTEGER) AS attempt FROM orders),
k AS (SELECT item, attempt, CASE WHEN (item + attempt) % 4 = 0 THEN 'error' WHEN (item * 7 + attempt * 5) % 6 = 0 THEN 'valid' ELSE 'invalid' END AS kind FROM t)"""


def _attempts_sql(most: int) -> str:
    """The fold over attempts 1 to 12: the first valid one, or the most-th invalid one before it."""
    return f"""SELECT item, CASE WHEN v IS NOT NULL AND (x IS NULL OR v < x) THEN 'valid' WHEN x IS NOT NULL THEN 'exhausted' ELSE 'open' END AS outcome, CASE WHEN v IS NOT NULL AND (x IS NULL OR v < x) THEN v ELSE x END AS attempt,
  (SELECT count(*) FROM k WHERE k.item = o.item AND k.kind = 'invalid' AND k.attempt <= coalesce(CASE WHEN v IS NOT NULL AND (x IS NULL OR v < x) THEN v ELSE x END, 12)) AS n_invalid, CAST({most} AS INTEGER) AS most
  FROM (SELECT item, min(CASE WHEN kind = 'valid' THEN attempt END) AS v, list_sort(list(attempt) FILTER (kind = 'invalid'))[{most}] AS x FROM k GROUP BY item) o"""


def _kind(item: Column, attempt: Column) -> Column:
    return F.when((item + attempt) % 4 == 0, attempts.ERROR).when((item * 7 + attempt * 5) % 6 == 0, attempts.VALID).otherwise(attempts.INVALID)


@query(f"WITH {_SENT} {_attempts_sql(3)} UNION ALL {_attempts_sql(5)}")
def attempt_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """What twelve recorded attempts at each order come to, where three or five invalid answers end it and errors don't count."""
    t = table(spark, d, "orders").select(F.col("o_orderkey").alias("item"), F.explode(F.sequence(F.lit(1), F.lit(12))).alias("attempt"))
    own = t.withColumn("kind", _kind(F.col("item"), F.col("attempt")))
    return attempts.outcome(own, 3).withColumn("most", F.lit(3)).unionByName(attempts.outcome(own, 5).withColumn("most", F.lit(5)))


@query(f"WITH {_SENT}, o AS ({_attempts_sql(3)}) SELECT item, outcome, attempt, n_invalid, CASE WHEN outcome = 'valid' THEN 'answer ' || attempt END AS answer FROM o")
def sent_until_valid(spark: SparkSession, d: str) -> DataFrame:
    """Orders sent to a service that errs or answers badly, only rejected ones again, in at most twelve rounds."""
    kind = _kind(F.col("item"), F.col("attempt"))
    send = lambda df: df.withColumns({"error": F.when(kind == attempts.ERROR, "busy"), "answer": F.concat(F.lit("answer "), F.col("attempt").cast("string"))})
    return attempts.until_valid(table(spark, d, "orders").select(F.col("o_orderkey").alias("item")), send, kind == attempts.VALID, 3, 12)


@query("""WITH f AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_custkey % 10 <> 3)
SELECT o_orderkey, CASE WHEN o.o_custkey % 10 <> 3 THEN 'https://store/' || md5(CAST(o.o_custkey AS VARCHAR)) END AS value, f.o_custkey IS NOT NULL AS known FROM orders o LEFT JOIN f ON f.o_custkey = o.o_custkey""")
def remembered_uploads(spark: SparkSession, d: str) -> DataFrame:
    """Uploads for all orders after those for finished ones: a customer's is made once; some fail and are not remembered."""
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.col("o_custkey").cast("string").alias("_c"))
    link = F.when(F.col("key").cast("bigint") % 10 != 3, F.concat(F.lit("https://store/"), F.md5("key")))
    upload = lambda df: df.withColumn("value", link)
    path = scratch(spark)
    attempts.remembered(o.where("o_orderstatus = 'F'"), "_c", path, upload)
    return attempts.remembered(o, "_c", path, upload).select("o_orderkey", "value", "known")


#: Widths of characters in thousandths of the size; others are 500 wide.
GLYPHS = {250: " .,'", 300: "fijlt", 600: "bdghknopqu", 800: "mwMW", 700: "ABCDEGHKNOPQRU"}
_COLUMN, _HEIGHT, _SIZE = 1900, 700, 96
_WIDE = "length(w) * 500" + "".join(f" + (length(w) - length(translate(w, '{chars.replace(chr(39), chr(39) * 2)}', ''))) * {n - 500}" for n, chars in GLYPHS.items())


@query(rf"""WITH s AS (SELECT unnest(range(0, 39)) AS k, 96 - 2 * unnest(range(0, 39)) AS size),
t AS (SELECT conv_id, turn, list_transform(string_split(text, chr(10)), lambda l: list_transform(list_filter(regexp_split_to_array(l, '[ \t\r\f\v]+'), lambda w: w <> ''), lambda w: CAST({_WIDE} AS BIGINT))) AS rows FROM conversations WHERE text <> ''),
n AS (SELECT conv_id, turn, size, CAST(list_sum(list_transform(rows, lambda r: greatest(1, list_reduce(list_prepend(struct_pack(n := 0::BIGINT, x := NULL::BIGINT), list_transform(r, lambda w: struct_pack(n := 0::BIGINT, x := w))),
  lambda a, b: CASE WHEN a.x + 250 + b.x <= {_COLUMN} * 1000 // size THEN struct_pack(n := a.n, x := a.x + 250 + b.x) ELSE struct_pack(n := a.n + 1, x := b.x) END).n))) AS BIGINT) AS lines FROM t, s)
SELECT conv_id, turn, CAST(max(size) FILTER (lines * floor(size * 120 / 100) <= {_HEIGHT} OR size = 20) AS INTEGER) AS size, arg_max(lines, size) FILTER (lines * floor(size * 120 / 100) <= {_HEIGHT} OR size = 20) AS lines FROM n GROUP BY conv_id, turn
UNION ALL SELECT conv_id, turn, {_SIZE}, 0 FROM conversations WHERE coalesce(text, '') = ''""")
def fitted_texts(spark: SparkSession, d: str) -> DataFrame:
    """The largest size at which each turn's text fits a column, and its lines at that size."""
    fit = fitting.fitted(F.col("text"), GLYPHS, _COLUMN, _HEIGHT, _SIZE)
    return table(spark, d, "conversations").select("conv_id", "turn", fit.alias("f")).select("conv_id", "turn", "f.size", "f.lines")


@query("""SELECT 'c' || s_suppkey || '.yaml' AS name, s_name AS title, 'it' AS language, 1 AS start_idx, CASE WHEN s_nationkey % 5 <> 0 THEN s_nationkey + 2 END AS end_idx, CASE WHEN s_nationkey % 5 = 0 THEN NULL ELSE 'A: b, ' || s_name END AS characters,
CASE WHEN s_nationkey % 2 = 0 THEN 'Gold' ELSE 'Silver' END AS color, CAST(CASE WHEN s_nationkey % 3 = 0 THEN 1280 ELSE 3840 END AS INTEGER) AS video_width, CASE WHEN s_nationkey % 5 = 0 THEN 'missing: end_idx, characters' END AS error FROM supplier""")
def config_table(spark: SparkSession, d: str) -> DataFrame:
    """A config file for each supplier, written and read as typed rows; some lack keys."""
    n = F.col("s_nationkey").cast("string")
    some = lambda c, x: F.when(c, x).otherwise("")
    whole = F.col("s_nationkey") % 5 != 0
    text = F.concat(
        F.lit("# settings\ntitle: "), "s_name", F.lit("\nfile_prefix: sup\nlanguage: it\nstart_idx: 1\noverture_indices: [1, 2]\n"),
        some(whole, F.concat(F.lit("end_idx: "), (F.col("s_nationkey") + 2).cast("string"), F.lit("\ncharacters:\n  - \"A: b\"\n  - "), "s_name", F.lit("\n"))),
        some(F.col("s_nationkey") % 2 == 0, F.lit("secondary_color: Gold\n")), some(F.col("s_nationkey") % 3 == 0, F.lit("video_width: 1280\n")),
    )
    own = table(spark, d, "supplier").select(F.concat(F.lit("c"), F.col("s_suppkey").cast("string"), F.lit(".yaml")).alias("name"), text.alias("text"))
    path = scratch(spark)
    sinks.write_files(own, path, "name", "text")
    c = readers.configs(spark, path)
    return c.select(F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), "title", "language", "start_idx", "end_idx", F.array_join("characters", ", ").alias("characters"), F.col("secondary_color").alias("color"), "video_width", "error")


@query("""SELECT p_partkey, CAST(unnest([1, 3, 4]) AS INTEGER) AS pos, unnest([p_name, 'untitled', 'untitled']) AS title, unnest([p_type, p_brand, '']) AS description FROM part WHERE p_partkey % 11 <> 4""")
def listed_items(spark: SparkSession, d: str) -> DataFrame:
    """Answers of a model as lists in which not every item is an object; some are no list at all."""
    k = F.col("p_partkey")
    item = lambda title, text: F.to_json(F.struct(title.alias("title"), text.alias("description")))
    listed = F.concat(F.lit('["{}", '), item(F.concat(F.lit("  "), "p_name"), F.col("p_type")), F.lit(", [1], "), item(F.lit(" "), F.concat("p_brand", F.lit(" "))), F.lit(', {"shot": 3}, 7, null]'))
    answer = F.when(k % 22 == 4, '{"title": "alone"}').when(k % 11 == 4, "no json [").otherwise(listed)
    return requests.items_of(table(spark, d, "part").select("p_partkey", answer.alias("answer")), "answer")


@query(f"""WITH w AS (SELECT user_id AS doc_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS word_idx, ts,
  CASE WHEN event_type <> 'error' THEN CAST({SECONDS} AS DOUBLE) END AS start_s, CASE WHEN event_type <> 'error' THEN CAST({SECONDS} AS DOUBLE) + floor(value) * 60 END AS end_s FROM events),
a AS (SELECT *, sum(end_s - start_s) OVER (PARTITION BY doc_id ORDER BY word_idx) AS dd FROM w),
b AS (SELECT *, max(start_s - (dd - (end_s - start_s))) OVER (PARTITION BY doc_id ORDER BY word_idx) AS m, lead(ts) OVER (PARTITION BY doc_id ORDER BY word_idx) AS next FROM a)
SELECT doc_id, 'word' AS kind, ts, word_idx, CASE WHEN start_s IS NOT NULL THEN dd + m - (end_s - start_s) END AS start_s, CASE WHEN start_s IS NOT NULL THEN dd + m END AS end_s FROM b
UNION ALL SELECT doc_id, 'idle', ts + INTERVAL 6 HOUR, NULL, NULL, NULL FROM b WHERE next IS NULL OR next > ts + INTERVAL 6 HOUR""")
def clamped_idle(spark: SparkSession, d: str) -> DataFrame:
    """Extension: what the stateful stream operator gives for the whole table: a user's words clamped, and when the user falls idle."""
    e = table(spark, d, "events").withColumnRenamed("user_id", "doc_id")
    start = F.expr("timestampdiff(SECOND, timestamp_ntz'2024-01-01 00:00:00', ts)").cast("double")
    timed = F.col("event_type") != "error"
    at = (F.row_number().over(Window.partitionBy("doc_id").orderBy("ts", "event_id")) - 1).cast("bigint")
    words = e.select("doc_id", at.alias("word_idx"), "ts", F.when(timed, start).alias("start_s"), F.when(timed, start + F.floor("value") * 60).alias("end_s"))
    return clamp.clamped(words, timedelta(hours=6))


@query("""WITH w AS (SELECT l_returnflag AS doc_id, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_orderkey, l_linenumber) - 1 AS word_idx, CAST(l_orderkey // 400 % 3 <> 1 AS INTEGER) AS timed FROM lineitem),
m AS (SELECT *, sum(timed) OVER f AS n, count(*) OVER f AS c, sum(timed) OVER (PARTITION BY doc_id) AS t, count(*) OVER (PARTITION BY doc_id) AS nn FROM w WINDOW f AS (PARTITION BY doc_id ORDER BY word_idx ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
low AS (SELECT *, word_idx - row_number() OVER (PARTITION BY doc_id ORDER BY word_idx) AS run FROM m WHERE c = 20 AND n * nn * 1000 < 20 * (t * 1000 - 200 * nn))
SELECT doc_id, min(word_idx) AS "start", max(word_idx) + 1 AS "end" FROM low GROUP BY doc_id, run HAVING max(word_idx) + 1 - min(word_idx) >= 500""")
def low_alignment_runs(spark: SparkSession, d: str) -> DataFrame:
    """Runs of at least 500 windows of 20 words that are badly timed, over three long documents: the lines of each return flag."""
    start = F.when(F.floor(F.col("l_orderkey") / 400) % 3 != 1, F.lit(0.0))
    own = table(spark, d, "lineitem").select(F.col("l_returnflag").alias("doc_id"), "l_orderkey", "l_linenumber", start.alias("start_s"))
    # numbered by blocks of orders, as a document is a third of the table
    own = scan(own, "doc_id", ["l_orderkey", "l_linenumber"], places("l_orderkey"), word_idx=Fold("sum", F.lit(1).cast("bigint"), own=False))
    return quality.low_runs(own.select("doc_id", F.coalesce("word_idx", F.lit(0).cast("bigint")).alias("word_idx"), "start_s", F.col("start_s").alias("end_s")))

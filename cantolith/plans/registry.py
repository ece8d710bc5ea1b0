"""Query name -> callable(spark, sf_dir), and query name -> DuckDB SQL. Every query runs over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cantolith.functions import text as T
from cantolith.operators import alignment, matching, quality, requests, sequences, timeline
from cantolith.sources import adapters, readers, sinks
from cantolith.streaming import sessions
from cantolith.session import cut, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

SECONDS = "date_diff('second', TIMESTAMP '2024-01-01', ts)"
WORDS = f"""words AS (
  SELECT user_id AS doc_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS word_idx, event_type AS word,
    CASE WHEN event_type <> 'error' THEN CAST({SECONDS} AS DOUBLE) END AS start_s,
    CASE WHEN event_type <> 'error' THEN CAST({SECONDS} AS DOUBLE) + floor(value) * 60 END AS end_s
  FROM events)"""
SEGMENTS = f"""segments AS (
  SELECT user_id AS doc_id, CAST(floor({SECONDS} / 86400) AS BIGINT) AS seg_id, CAST(sum(floor(value)) AS BIGINT) AS duration
  FROM events GROUP BY ALL)"""
LINES = r"lines AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: trim(x, ' ' || chr(9) || chr(10) || chr(13)) <> '') AS lines FROM documents)"
PAIRS = "pairs AS (SELECT a.conv_id AS doc_id, a.turn AS pair_idx, a.text AS src, b.text AS tgt FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user' AND b.role = 'assistant')"
DAY, HOUR = 86400.0, 3600.0


def query(sql: str | None = None):
    """Registers a function under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


# --- timed words


@query(f"WITH {SEGMENTS} SELECT *, CAST(coalesce(sum(duration) OVER (PARTITION BY doc_id ORDER BY seg_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_s FROM segments")
def absolute_times(spark: SparkSession, d: str) -> DataFrame:
    return timeline.starts(adapters.segments(spark, d))


INTERPOLATED = f"""{WORDS},
anchored AS (
  SELECT *, last_value(CASE WHEN start_s IS NOT NULL THEN word_idx END IGNORE NULLS) OVER p AS pi, last_value(end_s IGNORE NULLS) OVER p AS pe,
    first_value(CASE WHEN start_s IS NOT NULL THEN word_idx END IGNORE NULLS) OVER n AS ni, first_value(start_s IGNORE NULLS) OVER n AS ns
  FROM words
  WINDOW p AS (PARTITION BY doc_id ORDER BY word_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), n AS (PARTITION BY doc_id ORDER BY word_idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
filled AS (
  SELECT doc_id, word_idx, word,
    CASE WHEN start_s IS NULL AND ns - pe <= {DAY} THEN pe + (word_idx - pi - 1) * ((ns - pe) / (ni - pi)) ELSE start_s END AS start_s,
    CASE WHEN start_s IS NULL AND ns - pe <= {DAY} THEN pe + (word_idx - pi) * ((ns - pe) / (ni - pi)) ELSE end_s END AS end_s
  FROM anchored)"""


@query(f"WITH {INTERPOLATED} SELECT doc_id, word_idx, word, round(start_s, 6) AS start_s, round(end_s, 6) AS end_s FROM filled")
def word_interpolate(spark: SparkSession, d: str) -> DataFrame:
    out = timeline.interpolate(adapters.words(spark, d), DAY)
    return out.withColumns({"start_s": F.round("start_s", 6), "end_s": F.round("end_s", 6)})


@query(f"""WITH {WORDS}, a AS (SELECT *, sum(end_s - start_s) OVER w AS dd FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY word_idx)),
b AS (SELECT *, max(start_s - (dd - (end_s - start_s))) OVER (PARTITION BY doc_id ORDER BY word_idx) AS m FROM a)
SELECT doc_id, word_idx, word, CASE WHEN start_s IS NOT NULL THEN dd + m - (end_s - start_s) END AS start_s, CASE WHEN start_s IS NOT NULL THEN dd + m END AS end_s FROM b""")
def monotonic_words(spark: SparkSession, d: str) -> DataFrame:
    return timeline.monotonic_words(adapters.words(spark, d))


@query(f"WITH {WORDS} SELECT doc_id, count(*) AS n_words, count(start_s) AS n_timed, round(count(start_s) / count(*), 6) AS ratio, min(start_s) AS first_start, coalesce(max(end_s), 0.0) AS last_end FROM words GROUP BY doc_id")
def coverage_ratio(spark: SparkSession, d: str) -> DataFrame:
    return quality.coverage(adapters.words(spark, d)).withColumn("ratio", F.round("ratio", 6))


@query(f"""WITH {WORDS}, m AS (SELECT doc_id, word_idx, count(start_s) OVER w AS n, count(*) OVER w AS c, count(start_s) OVER (PARTITION BY doc_id) AS t, count(*) OVER (PARTITION BY doc_id) AS nn
  FROM words WINDOW w AS (PARTITION BY doc_id ORDER BY word_idx ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)),
low AS (SELECT *, word_idx - row_number() OVER (PARTITION BY doc_id ORDER BY word_idx) AS run FROM m WHERE c = 5 AND n * nn * 1000 < 5 * (t * 1000 - 100 * nn))
SELECT doc_id, min(word_idx) AS "start", max(word_idx) + 1 AS "end" FROM low GROUP BY doc_id, run HAVING count(*) >= 4""")
def low_alignment_islands(spark: SparkSession, d: str) -> DataFrame:
    return quality.low_runs(adapters.words(spark, d), 5, 0.1, 4)


def _runs(words: DataFrame) -> DataFrame:
    """The active words of the hourly grid, with tolerance of a day, as runs of hours."""
    return timeline.active_runs(words.groupBy("doc_id").agg(F.max("end_s").alias("total_s")), words, HOUR, DAY)


def _active(source: str) -> str:
    """SQL of the hourly grid over a table of words, with tolerance of a day."""
    return f"""ticks AS (SELECT doc_id, unnest(range(0, CAST(ceil(max(end_s) / {HOUR}) AS BIGINT))) AS tick FROM {source} GROUP BY doc_id HAVING max(end_s) > 0),
inside AS (SELECT t.doc_id, tick, min(word_idx) AS i FROM ticks t JOIN {source} w ON w.doc_id = t.doc_id AND start_s <= tick * {HOUR} AND tick * {HOUR} <= end_s GROUP BY ALL),
ago AS (SELECT t.doc_id, tick, -max(struct_pack(e := end_s, i := -word_idx)).i AS i FROM ticks t JOIN {source} w ON w.doc_id = t.doc_id AND end_s <= tick * {HOUR} AND end_s >= tick * {HOUR} - {DAY} GROUP BY ALL),
frames AS (SELECT t.doc_id, t.tick, CAST(t.tick * {HOUR} AS DOUBLE) AS t_s, coalesce(a.i, b.i) AS word_idx FROM ticks t LEFT JOIN inside a USING (doc_id, tick) LEFT JOIN ago b USING (doc_id, tick))"""


@query(f"WITH {WORDS}, {_active('words')} SELECT * FROM frames")
def time_grid_active(spark: SparkSession, d: str) -> DataFrame:
    return timeline.ticks(_runs(adapters.words(spark, d)), HOUR)


RISING = "rising AS (SELECT doc_id, tick, t_s, CASE WHEN word_idx IS NOT NULL THEN max(word_idx) OVER (PARTITION BY doc_id ORDER BY tick) END AS word_idx FROM frames)"
FILLED = """SELECT doc_id, tick, t_s, coalesce(word_idx, CASE WHEN p = n THEN p END) AS word_idx FROM (
  SELECT *, last_value(word_idx IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY tick ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS p,
    first_value(word_idx IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY tick ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS n FROM {})"""


@query(f"WITH {WORDS}, {_active('words')}, {RISING} SELECT * FROM rising")
def timeline_monotonic(spark: SparkSession, d: str) -> DataFrame:
    return timeline.ticks(timeline.monotonic_frames(_runs(adapters.words(spark, d)), block="block"), HOUR)


@query(f"WITH {WORDS}, f AS (SELECT doc_id, word_idx AS tick, start_s AS t_s, CASE word WHEN 'error' THEN NULL ELSE ascii(word) END AS v FROM words), frames AS (SELECT doc_id, tick, t_s, CAST(v AS BIGINT) AS word_idx FROM f) {FILLED.format('frames')}")
def timeline_fill(spark: SparkSession, d: str) -> DataFrame:
    w = adapters.words(spark, d)
    frames = w.select("doc_id", F.col("word_idx").alias("tick"), F.col("start_s").alias("t_s"), F.when(F.col("word") != "error", F.ascii("word").cast("bigint")).alias("word_idx"))
    return timeline.fill_between(frames)


@query(f"WITH {INTERPOLATED}, {_active('filled')}, {RISING} {FILLED.format('rising')}")
def active_timeline(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: untimed words interpolated, the hourly grid, the active word, both repairs."""
    words = cut(timeline.interpolate(adapters.words(spark, d), DAY))
    runs = cut(_runs(words))
    return timeline.ticks(timeline.fill_between(timeline.monotonic_frames(runs, block="block"), block="block"), HOUR)


@query(f"""WITH {WORDS}, {SEGMENTS}, met AS (SELECT s.doc_id, seg_id, word, row_number() OVER (PARTITION BY s.doc_id, seg_id ORDER BY word_idx) AS r, word_idx FROM segments s JOIN words w ON w.doc_id = s.doc_id AND start_s >= seg_id * 86400 AND start_s < (seg_id + 1) * 86400),
f AS (SELECT doc_id, seg_id, string_agg(word, ' ' ORDER BY word_idx) AS fw FROM met WHERE r <= 8 GROUP BY ALL)
SELECT doc_id, seg_id, regexp_replace((CASE seg_id WHEN 0 THEN '00' WHEN 1 THEN '1 day, 0' ELSE seg_id || ' days, 0' END) || ':00:00 - ' || coalesce(fw, 'Scene ' || (seg_id + 1)), '^[0:]+', '') AS line FROM segments LEFT JOIN f USING (doc_id, seg_id)""")
def cue_sheet(spark: SparkSession, d: str) -> DataFrame:
    s = adapters.segments(spark, d).select("doc_id", "seg_id", (F.col("seg_id") * DAY).alias("start_s"), ((F.col("seg_id") + 1) * DAY).alias("end_s"))
    words = timeline.first_words(s, adapters.words(spark, d), 8, DAY)
    scene = F.concat(F.lit("Scene "), (F.col("seg_id") + 1).cast("string"))
    return s.join(words, ["doc_id", "seg_id"], "left").select("doc_id", "seg_id", T.cue(F.col("start_s"), F.coalesce("first_words", scene)).alias("line"))


@query(f"WITH {WORDS} SELECT doc_id, CAST(floor(word_idx / 7) AS BIGINT) AS line, string_agg(word, ' ' ORDER BY word_idx) AS words, min(start_s) AS start_s, max(end_s) AS end_s FROM words GROUP BY ALL")
def karaoke_lines(spark: SparkSession, d: str) -> DataFrame:
    return sequences.groups(adapters.words(spark, d))


@query(f"""WITH {WORDS}, l AS (SELECT doc_id, word_idx, CAST(floor(word_idx / 7) AS BIGINT) AS line, start_s, start_s - last_value(end_s IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY word_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gap FROM words)
SELECT doc_id, word_idx, line, coalesce(lag(line) OVER w <> line, true) AS is_first, coalesce(lead(line) OVER w <> line, true) AS is_last, CASE WHEN gap > 0 THEN gap END AS silence FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY word_idx)""")
def line_changes(spark: SparkSession, d: str) -> DataFrame:
    w = adapters.words(spark, d).withColumn("line", F.floor(F.col("word_idx") / 7).cast("bigint"))
    return sequences.line_changes(w).select("doc_id", "word_idx", "line", "is_first", "is_last", "silence")


@query(f"WITH {WORDS} SELECT doc_id, word_idx, array_to_string(list(word) OVER (PARTITION BY doc_id ORDER BY word_idx ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), ' ') AS context FROM words")
def context_frame(spark: SparkSession, d: str) -> DataFrame:
    out = sequences.context(adapters.words(spark, d), "word_idx", "word", 2)
    return out.select("doc_id", "word_idx", F.array_join("context", " ").alias("context"))


# --- parallel text


@query(r"WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS t FROM documents) SELECT doc_id, len(t) AS n_tokens, t[1] AS first_token, t[-1] AS last_token FROM t")
def token_index(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents").select("doc_id", T.tokens(F.col("text")).alias("t"))
    return t.select("doc_id", F.size("t").cast("bigint").alias("n_tokens"), F.get("t", F.lit(0)).alias("first_token"), F.get("t", F.size("t") - 1).alias("last_token"))


@query(rf"""WITH {LINES}, e AS (SELECT doc_id, unnest(lines) AS l, generate_subscripts(lines, 1) - 1 AS line_idx FROM lines), c AS (SELECT doc_id, line_idx, len(list_filter(regexp_split_to_array(l, '\s+'), lambda x: x <> '')) AS n FROM e)
SELECT doc_id, line_idx, CAST(sum(n) OVER (PARTITION BY doc_id ORDER BY line_idx) - n AS BIGINT) AS first_word, CAST(n AS BIGINT) AS n_words FROM c WHERE n > 0""")
def word_to_line(spark: SparkSession, d: str) -> DataFrame:
    w = sequences.words_to_lines(adapters.lines(spark, d), "lines")
    return w.groupBy("doc_id", "line_idx").agg(F.min("word_idx").alias("first_word"), F.count("*").alias("n_words"))


@query(f"""WITH {PAIRS}, x AS (SELECT doc_id, pair_idx, list_filter(string_split(src, ' '), lambda x: x <> '') AS a, list_filter(string_split(tgt, ' '), lambda x: x <> '') AS b FROM pairs)
SELECT doc_id * 1000 + pair_idx AS doc_id, unnest(range(0, least(len(a), len(b)))) AS pair_idx, unnest(a[1:least(len(a), len(b))]) AS src, unnest(b[1:least(len(a), len(b))]) AS tgt FROM x""")
def pair_zip(spark: SparkSession, d: str) -> DataFrame:
    part = lambda c: F.filter(F.split(c, " "), lambda x: x != "")
    p = adapters.pairs(spark, d).select((F.col("doc_id") * 1000 + F.col("pair_idx")).alias("doc_id"), part("src").alias("a"), part("tgt").alias("b"))
    return sequences.zip_lists(p, "a", "b")


@query(f"WITH {PAIRS} SELECT doc_id, count(*) AS n_pairs, round(avg(length(src)), 6) AS mean_src, round(avg(length(tgt)), 6) AS mean_tgt, min(CASE WHEN abs(length(src) / nullif(length(tgt), 0) - 1) > 1.5 THEN pair_idx END) AS first_far FROM pairs GROUP BY doc_id")
def pair_mismatch(spark: SparkSession, d: str) -> DataFrame:
    out = quality.length_ratios(adapters.pairs(spark, d))
    return out.withColumns({"mean_src": F.round("mean_src", 6), "mean_tgt": F.round("mean_tgt", 6)})


@query(r"""WITH s AS (SELECT doc_id, text, regexp_extract_all(text, '\([^)]*\)?|[^(]+') AS s FROM documents)
SELECT doc_id, len(s) AS n_segments, len(list_filter(s, lambda x: starts_with(x, '(') AND ends_with(x, ')'))) AS n_italic, CAST(length(replace(text, ')', '')) - length(replace(text, '(', '')) AS BIGINT) AS balance FROM s""")
def paren_tokens(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "documents").select("doc_id", "text", T.markup(F.col("text"), F.array().cast("array<string>")).alias("m"))
    return m.select("doc_id", F.size("m").cast("bigint").alias("n_segments"), F.size(F.filter("m", lambda x: x["fmt"] == "italic")).cast("bigint").alias("n_italic"), T.balance(F.col("text")).cast("bigint").alias("balance"))


NAMES = ("user", "assistant")


@query(r"SELECT conv_id, turn, CASE WHEN role IN ('user', 'assistant') THEN trim(text, chr(32) || chr(10) || chr(9) || chr(13)) ELSE role || ': ' || text END AS stripped, CASE WHEN role IN ('user', 'assistant') THEN role END AS speaker FROM conversations")
def speaker_strip(spark: SparkSession, d: str) -> DataFrame:
    names = F.array(*map(F.lit, NAMES))
    line = table(spark, d, "conversations").withColumn("line", F.concat("role", F.lit(": "), "text"))
    return line.select("conv_id", "turn", T.strip_speaker(F.col("line"), names).alias("stripped"), T.speaker(F.col("line"), names, ":").alias("speaker"))


@query(r"SELECT conv_id, turn, role || CASE WHEN role IN ('user', 'assistant') THEN chr(10) || trim(text, chr(32) || chr(10) || chr(9) || chr(13)) ELSE ' ' || text END AS line FROM conversations")
def speaker_split(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat("role", F.lit(" "), "text")
    return table(spark, d, "conversations").select("conv_id", "turn", T.break_after_speaker(line, F.array(*map(F.lit, NAMES))).alias("line"))


@query(rf"""WITH {LINES}, e AS (SELECT doc_id, len(lines) AS n, unnest(lines) AS l, generate_subscripts(lines, 1) AS i FROM lines),
b AS (SELECT doc_id, n, i, sum(length(replace(l, ')', '')) - length(replace(l, '(', ''))) OVER (PARTITION BY doc_id ORDER BY i) AS o FROM e),
m AS (SELECT doc_id, arg_min(i, abs(i - n // 2) * 2 + CAST(i < n // 2 AS INT)) AS i FROM b WHERE o = 0 AND i < n GROUP BY doc_id)
SELECT doc_id, len(lines) AS n_lines, CAST(coalesce(i, len(lines) // 2) AS BIGINT) AS split_at FROM lines LEFT JOIN m USING (doc_id)""")
def safe_split_point(spark: SparkSession, d: str) -> DataFrame:
    return adapters.lines(spark, d).select("doc_id", F.size("lines").cast("bigint").alias("n_lines"), T.split_point(F.col("lines")).cast("bigint").alias("split_at"))


@query()
def split_long(spark: SparkSession, d: str) -> DataFrame:
    """Documents' lines, beside the same in reverse, in parts of fifteen lines at most."""
    p = adapters.lines(spark, d).select("doc_id", F.lit(0).cast("bigint").alias("pair_idx"), F.col("lines").alias("src"), F.reverse("lines").alias("tgt"))
    return sequences.split_long(p)


@query(r"""WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, list_filter(range(0, len(w) - 1), lambda i: w[i + 1] = 'of' AND w[i + 2] = 'the') AS places FROM t)
SELECT doc_id, len(places) AS n_places, places[1] AS first_place FROM p""")
def phrase_find(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "documents").select("doc_id", sequences.phrase_places(T.tokens(F.col("text")), F.lit("of the")).alias("at"))
    return p.select("doc_id", F.size("at").cast("bigint").alias("n_places"), F.get("at", F.lit(0)).cast("bigint").alias("first_place"))


@query(rf"""WITH {LINES}, s AS (SELECT doc_id, lines, unnest(range(0, len(lines), 6)) AS "start" FROM lines)
SELECT doc_id, "start", len(lines["start" + 1:"start" + 10]) AS n_items, array_to_string(lines["start" + 1:"start" + 10], chr(10)) AS text FROM s WHERE "start" = 0 OR "start" - 6 + 10 < len(lines)""")
def hopping_blocks(spark: SparkSession, d: str) -> DataFrame:
    w = sequences.hopping_windows(adapters.lines(spark, d), "lines")
    return w.select("doc_id", "start", F.size("items").cast("bigint").alias("n_items"), F.array_join("items", "\n").alias("text"))


@query(rf"""WITH {LINES}, s AS (SELECT doc_id, lines, unnest(range(0, CAST(ceil(len(lines) / 12) AS BIGINT))) AS chunk FROM lines)
SELECT doc_id, chunk, array_to_string(lines[chunk * 12 + 1:chunk * 12 + 12], chr(10) || chr(10)) AS text FROM s""")
def chunk12(spark: SparkSession, d: str) -> DataFrame:
    return sequences.chunks(adapters.lines(spark, d), "lines").select("doc_id", "chunk", F.array_join("items", "\n\n").alias("text"))


@query(rf"WITH {LINES} SELECT doc_id, array_to_string(lines[2:4], '|') AS from_2_to_4, array_to_string(lines[1:3], '|') AS first_3, array_to_string(CASE WHEN len(lines) > 10 THEN lines[-10:] ELSE lines END, '|') AS last_10 FROM lines")
def line_slices(spark: SparkSession, d: str) -> DataFrame:
    lines = F.col("lines")
    last = F.when(F.size(lines) > 10, F.slice(lines, -10, 10)).otherwise(lines)
    return adapters.lines(spark, d).select("doc_id", F.array_join(F.slice(lines, 2, 3), "|").alias("from_2_to_4"), F.array_join(F.slice(lines, 1, 3), "|").alias("first_3"), F.array_join(last, "|").alias("last_10"))


@query("SELECT conv_id AS doc_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS text FROM conversations GROUP BY conv_id")
def joined_blocks(spark: SparkSession, d: str) -> DataFrame:
    return sinks.joined(table(spark, d, "conversations").withColumnRenamed("conv_id", "doc_id"), "turn", "text")


@query(f"WITH {PAIRS} SELECT doc_id, pair_idx, length(src) - length(replace(src, chr(10), '')) = length(tgt) - length(replace(tgt, chr(10), '')) AS same FROM pairs")
def newline_parity(spark: SparkSession, d: str) -> DataFrame:
    return adapters.pairs(spark, d).select("doc_id", "pair_idx", requests.same_newlines(F.col("src"), F.col("tgt")).alias("same"))


@query("SELECT p_partkey, round(1 - levenshtein(lower(p_name), lower(p_type)) / greatest(length(p_name), length(p_type)), 6) AS similarity FROM part")
def word_similarity_pairs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", F.round(T.similarity(F.col("p_name"), F.col("p_type")), 6).alias("similarity"))


@query()
def align_words(spark: SparkSession, d: str) -> DataFrame:
    """Each turn's words, heard a second each, aligned with the next turn's."""
    t = table(spark, d, "conversations").select("conv_id", "turn", T.tokens(F.col("text")).alias("words"))
    a = t.select((F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), F.posexplode("words").alias("word_idx", "word"))
    heard = a.select("doc_id", "word_idx", "word", F.col("word_idx").cast("double").alias("start_s"), (F.col("word_idx") + 1.0).alias("end_s"))
    both = t.alias("b").join(t.alias("a"), (F.col("a.conv_id") == F.col("b.conv_id")) & (F.col("b.turn") == F.col("a.turn") + 1))
    texts = both.select((F.col("a.conv_id") * 1000 + F.col("a.turn")).alias("doc_id"), F.col("b.words").alias("words"))
    return alignment.align_words(heard, texts, None, 0.3)


# --- records, names, files

SLUG = r"substr(regexp_replace(regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 80)"


@query(f"WITH t AS (SELECT page_id, regexp_extract(html, '<title>(.*?)</title>', 1, 's') AS title FROM pages), s AS (SELECT page_id, title, {SLUG} AS slug FROM t) SELECT page_id, title, slug FROM s QUALIFY row_number() OVER (PARTITION BY slug ORDER BY page_id) = 1")
def slug_dedup(spark: SparkSession, d: str) -> DataFrame:
    s = adapters.titles(spark, d).withColumn("slug", T.slug(F.col("title")))
    return matching.first_distinct(s, "slug", ["page_id"]).select("page_id", "title", "slug")


@query(r"""SELECT p_partkey, trim(concat_ws(', ', p_name, CASE WHEN p_size % 2 = 0 THEN p_brand || ' shot' END, nullif(p_type, ''), 'color palette: ' || p_brand, 'end')) AS prompt,
concat_ws(chr(10) || chr(10), p_name, p_type) AS paragraphs, p_name || ' by ' || p_brand AS filled, p_brand || '_' || lpad(CAST(p_partkey AS VARCHAR), CAST(greatest(3, length(CAST(p_partkey AS VARCHAR))) AS INT), '0') || '_' || lpad(CAST(p_size AS VARCHAR), 2, '0') || '.png' AS file FROM part""")
def prompt_build(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    shot = F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).otherwise("")
    text = T.prompt(F.col("p_name"), shot, F.col("p_type"), F.lit(""), F.col("p_brand"), F.lit("end"))
    return p.select("p_partkey", text.alias("prompt"), T.paragraphs([F.col("p_name"), F.lit(" "), F.col("p_type")]).alias("paragraphs"), T.template("{a} by {b}", {"a": F.col("p_name"), "b": F.col("p_brand")}).alias("filled"), T.file_name(F.col("p_brand"), F.col("p_partkey"), F.col("p_size"), F.lit(".png")).alias("file"))


@query(r"""SELECT p_partkey, greatest(1, least(p_size, 6)) AS clamped, p_size AS width, p_size * 2 AS height, CASE p_size % 3 WHEN 0 THEN '.jpg' WHEN 1 THEN '.gif' ELSE '.png' END AS ext,
CASE WHEN p_size % 2 = 0 THEN p_size END AS whole, CASE WHEN p_size % 2 = 0 THEN '/abs/' || p_partkey ELSE 'root/' || p_partkey END AS path, CASE p_size % 2 WHEN 0 THEN 'italian' ELSE 'xx' END AS language FROM part""")
def scalar_coercions(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").withColumn("k", F.col("p_partkey").cast("string"))
    n = F.col("p_size")
    size = T.size_of(F.concat(n.cast("string"), F.lit("x"), (n * 2).cast("string")))
    ext = T.extension(F.when(n % 3 == 0, "image/jpeg"), F.when(n % 3 == 1, "https://h/a.b/c.GIF?x=.png").otherwise("https://h/plain"))
    return p.select(
        "p_partkey", T.clamp(n).alias("clamped"), size["width"].alias("width"), size["height"].alias("height"), ext.alias("ext"),
        T.whole_number(F.when(n % 2 == 0, n.cast("string")).otherwise(" None ")).alias("whole"),
        T.resolved(F.when(n % 2 == 0, F.concat(F.lit("/abs/"), "k")).otherwise(F.col("k")), F.lit("root/")).alias("path"),
        T.one_of(T.LANGUAGES, F.when(n % 2 == 0, "ita").otherwise("xx")).alias("language"),
    )


@query(r"SELECT event_id, CAST(regexp_extract(props, '\"k\": (-?\d+)', 1) AS BIGINT) AS k FROM events")
def jsonl_tolerant(spark: SparkSession, d: str) -> DataFrame:
    """Every event's record, with a bad line, a list, a bare text and a blank line for each of them put between."""
    lines = F.explode(F.array(F.col("props"), F.lit("{bad"), F.lit("[1]"), F.lit('"x"'), F.lit("")))
    e = table(spark, d, "events").select("event_id", lines.alias("json"))
    return readers.only_objects(e, "json").select("event_id", F.get_json_object("json", "$.k").cast("bigint").alias("k"))


@query("""WITH r AS (SELECT p_partkey AS ord, CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN p_type WHEN 2 THEN p_brand END AS prompt FROM part), k AS (SELECT * FROM r WHERE prompt IS NOT NULL)
SELECT ord, row_number() OVER (ORDER BY ord) AS "index", count(*) OVER () AS total, prompt, (SELECT p_brand FROM part WHERE p_partkey % 7 = 3 ORDER BY p_partkey LIMIT 1) AS style FROM k""")
def coalesce_prompt(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("p_partkey") % 5
    p = table(spark, d, "part").select(F.col("p_partkey").alias("ord"), F.when(k == 0, F.col("p_name")).otherwise("").alias("final_prompt"), F.when(k == 1, F.col("p_type")).when(k == 3, F.lit("   ")).alias("prompt"), F.col("p_brand").alias("_b"), k.alias("_k"), F.when(F.col("p_partkey") % 7 == 3, F.col("p_brand")).otherwise(" ").alias("global_style"))
    return requests.requests(p.withColumn("description", F.when((F.col("_k") == 2) | (F.col("_k") == 3), F.col("_b"))).drop("_b", "_k"))


@query("""WITH cards AS (SELECT DISTINCT lower(n_name) AS stem, 'cards/' || lower(n_name) || '.png' AS path FROM nation),
names AS (SELECT DISTINCT unnest([n_name, '-' || lower(left(n_name, 4)), n_name || ' (Young)', '?!']) AS name FROM nation),
keys AS (SELECT name, regexp_replace(lower(name), '[^a-z0-9]', '', 'g') AS a FROM names),
near AS (SELECT name, arg_min(path, stem) AS path FROM keys, (SELECT *, regexp_replace(stem, '[^a-z0-9]', '', 'g') AS c FROM cards) WHERE starts_with(a, c) OR starts_with(c, a) GROUP BY name)
SELECT n.name, coalesce(c.path, r.path) AS path FROM names n LEFT JOIN cards c ON lower(trim(n.name)) = c.stem LEFT JOIN near r ON r.name = n.name""")
def fuzzy_lookup(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation")
    cards = matching.cards_of(n.select(F.concat(F.lit("cards/"), F.lower("n_name"), F.lit(".png")).alias("path")))
    names = n.select(F.col("n_name").alias("name")).union(n.select(F.concat(F.lit("-"), F.lower(F.substring("n_name", 1, 4))))).union(n.select(F.concat("n_name", F.lit(" (Young)")))).union(spark.sql("SELECT '?!'"))
    return matching.fuzzy_lookup(names, cards)


@query("""SELECT panel, image, prompt, seed, id, text FROM (
SELECT 0 AS panel, unnest([0, 2]) AS image, p_name AS prompt, p_partkey + unnest([0, 2]) AS seed, p_brand AS id, p_type AS text FROM part)""")
def nested_images(spark: SparkSession, d: str) -> DataFrame:
    """Responses of one panel with three images each, the second without a payload."""
    image = lambda k, payload: F.struct(payload.alias("encodedImage"), (F.col("p_partkey") + k).alias("seed"), F.col("p_brand").alias("mediaGenerationId"))
    full = F.base64(F.encode("p_type", "UTF-8"))
    panel = F.struct(F.col("p_name").alias("prompt"), F.array(image(0, full), image(1, F.lit("")), image(2, full)).alias("generatedImages"))
    r = table(spark, d, "part").select(F.to_json(F.struct(F.array(panel).alias("imagePanels"))).alias("json"))
    return readers.images(r).withColumn("text", F.decode("bytes", "UTF-8")).drop("bytes").withColumns({"panel": F.col("panel").cast("int"), "image": F.col("image").cast("int")})


@query(f"""WITH w AS (SELECT user_id AS doc_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS pos, event_type AS word, CASE WHEN event_type <> 'error' THEN floor(value) ELSE 0.0 END AS "start", value AS v FROM events WHERE event_type <> 'click')
SELECT doc_id, pos, "start", CASE WHEN word <> 'error' THEN "start" + 1 ELSE 0.0 END AS "end", word FROM w""")
def vendor_normalise(spark: SparkSession, d: str) -> DataFrame:
    """A user's events as vendor words: clicks are spacing, errors have no times."""
    e = table(spark, d, "events")
    timed = F.when(F.col("event_type") != "error", F.floor("value").cast("double"))
    w = F.struct("event_id", F.when(F.col("event_type") == "click", "spacing").alias("type"), F.col("event_type").alias("text"), timed.alias("start"), (timed + 1).alias("end"))
    docs = e.select(F.col("user_id").alias("doc_id"), w.alias("w")).groupBy("doc_id").agg(F.array_sort(F.collect_list("w")).alias("w"))
    out = docs.select("doc_id", F.posexplode(readers.vendor_words(F.col("w"))).alias("pos", "x"))
    return out.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "x.start", "x.end", "x.word")


@query("SELECT page_id AS doc_id, CAST(0 AS BIGINT) AS pair_idx, 'Page ' || page_id AS src, trim(url) AS tgt, 'A' AS speaker FROM pages")
def html_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pages' numbers and addresses, written as tables of two cells and read again."""
    cell = lambda x: F.concat(F.lit("<td><b>A</b> "), x, F.lit("<i>aside</i></td>"))
    p = table(spark, d, "pages")
    page = F.concat(F.lit("<table><tr>"), cell(F.concat(F.lit("Page "), F.col("page_id").cast("string"))), cell(F.replace(F.col("url"), F.lit("&"), F.lit("&amp;"))), F.lit("</tr></table>"))
    out = readers.html_pairs(p.select(F.col("page_id").alias("doc_id"), page.alias("html")))
    return out.where("src.kind = 'lyric'").select("doc_id", "pair_idx", F.col("src.text").alias("src"), F.col("tgt.text").alias("tgt"), F.col("src.character").alias("speaker"))


@query("SELECT doc_id, lang FROM documents ANTI JOIN labels USING (doc_id)")
def incremental_todo(spark: SparkSession, d: str) -> DataFrame:
    return matching.new_only(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels"), "doc_id")


@query("SELECT doc_id, lang FROM documents SEMI JOIN labels USING (doc_id)")
def existing_only(spark: SparkSession, d: str) -> DataFrame:
    return matching.existing_only(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels"), "doc_id")


@query("SELECT p_partkey, p_brand || '.png' AS name, p_brand || CASE WHEN k > 0 THEN '_' || lpad(CAST(k AS VARCHAR), CAST(greatest(2, length(CAST(k AS VARCHAR))) AS INT), '0') ELSE '' END || '.png' AS file FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS k FROM part)")
def collision_free_names(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", F.concat("p_brand", F.lit(".png")).alias("name"))
    return matching.free_names(p, "name", "p_partkey")


@query("SELECT p_partkey, CAST(p_partkey % 90000 AS DOUBLE) AS s, 's' AS kind FROM part UNION ALL SELECT p_partkey, CAST(p_partkey % 3600 AS DOUBLE), 'm' FROM part UNION ALL SELECT p_partkey, CAST(p_partkey % 90000 AS DOUBLE), 'h' FROM part")
def timestamps(spark: SparkSession, d: str) -> DataFrame:
    """Seconds written as S, M:S and H:M:S, and read again."""
    k = F.col("p_partkey")
    n = k % 90000
    forms = {"s": n.cast("string"), "m": F.format_string("%d:%02d", F.floor(k % 3600 / 60), k % 60), "h": F.format_string("%d:%02d:%02d", F.floor(n / 3600), F.floor(n % 3600 / 60), n % 60)}
    each = F.explode(F.array(*(F.struct(F.lit(x).alias("kind"), T.seconds(v).alias("s")) for x, v in forms.items())))
    return table(spark, d, "part").select("p_partkey", each.alias("x")).select("p_partkey", "x.s", "x.kind")


@query("SELECT s_suppkey, list_aggregate(list_transform(string_split(regexp_replace(lower(s_name), '[^a-z]+', ' ', 'g'), ' '), lambda x: upper(x[1]) || x[2:]), 'string_agg', ' ') AS title FROM supplier")
def stem_titles(spark: SparkSession, d: str) -> DataFrame:
    name = F.concat(F.regexp_replace(F.lower("s_name"), "[^a-z]+", "-"), F.lit("_en"))
    return table(spark, d, "supplier").select("s_suppkey", T.title(name).alias("title"))


@query("""SELECT c_custkey, alnum, stem, suffix, c_custkey % 2 = 0 AS fenced FROM (SELECT c_custkey, regexp_replace(lower(c_name), '[^a-z0-9]', '', 'g') AS alnum, lower(c_mktsegment) AS stem, '.jpg' AS suffix FROM customer)""")
def name_keys(spark: SparkSession, d: str) -> DataFrame:
    """Name keys, file stems, and JSON found in a fence or not at all."""
    c = table(spark, d, "customer")
    path = F.concat(F.lit("a.b/"), F.lower("c_mktsegment"), F.lit(".JPG"))
    answer = F.when(F.col("c_custkey") % 2 == 0, F.lit('Here:\n```json\n[{"a": 1}]\n```')).otherwise("none [at all")
    return c.select("c_custkey", T.alnum(F.col("c_name")).alias("alnum"), T.stem(path).alias("stem"), T.suffix(path).alias("suffix"), T.json_fragment(answer).isNotNull().alias("fenced"))


@query("""WITH e AS (SELECT user_id, ts, coalesce(date_diff('microsecond', lag(ts) OVER w, ts) >= 6 * 3600 * 1000000::BIGINT, true) AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(CAST(new AS INT)) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
SELECT user_id, min(ts) AS "start", max(ts) + INTERVAL 6 HOUR AS "end", count(*) AS n FROM s GROUP BY user_id, k""")
def idle_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Extension: runs of a user's events less than six hours apart."""
    return sessions.sessions(table(spark, d, "events"))


from cantolith.plans import flows as _flows  # noqa: E402, F401  registers its queries and those of more here

"""Further registered queries: files written and read again, records, repairs by lists, recursion in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cantolith.functions import text as T
from cantolith.operators import matching, quality, requests, sequences, timeline
from cantolith.plans.registry import LINES, ORACLE, PAIRS, SECONDS, SEGMENTS, WORDS, query
from cantolith.session import scratch, table
from cantolith.sources import adapters, readers, sinks

STRIP = "trim({}, chr(32) || chr(9) || chr(10) || chr(13))"
NATION = "SELECT n_nationkey, n_name, n_regionkey FROM nation"

# --- files: written whole, read again


@query("""SELECT user_id AS seg_id, 'eng' AS language, count(*) AS n_words, CAST(sum(floor(value)) AS DOUBLE) AS length, string_agg(event_type, ' ' ORDER BY ts, event_id) AS text
FROM events WHERE user_id >= 2 AND user_id < 1000000 GROUP BY user_id""")
def transcription_files(spark: SparkSession, d: str) -> DataFrame:
    """A JSON document for each user, named by its ordinal, with the words in order; ordinals from 2 on are read."""
    e = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type", F.floor("value").cast("double").alias("v"))
    word = F.struct(F.lit(0.0).alias("start"), F.col("v").alias("end"), F.col("event_type").alias("word"), F.lit(1.0).alias("confidence"))
    takes = e.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id", word.alias("w")))), lambda x: x["w"]).alias("words"))
    path = scratch(spark)
    sinks.write_files(takes.select(F.format_string("take_%06d.json", "user_id").alias("name"), F.to_json(F.struct(F.lit("eng").alias("language"), "words"), {"pretty": "true"}).alias("json")), path, "name", "json")
    t = readers.file_range(readers.transcriptions(spark, path), 2, 1_000_000)
    total = F.aggregate("words", F.lit(0.0), lambda a, w: a + w["end"] - w["start"])
    text = F.array_join(F.transform("words", lambda w: w["word"]), " ")
    return t.select("seg_id", "language", F.size("words").cast("bigint").alias("n_words"), total.alias("length"), text.alias("text"))


@query(f'WITH {WORDS} SELECT word, start_s AS "start", end_s AS "end" FROM words')
def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Timed words written in order as CSV and read with their empty times as null."""
    path = scratch(spark)
    w = adapters.words(spark, d).select("doc_id", "word_idx", "word", F.col("start_s").alias("start"), F.col("end_s").alias("end"))
    sinks.write_csv(w.select("word", "start", "end", "doc_id", "word_idx"), path, ["doc_id", "word_idx"])
    return readers.aligned_csv(spark, path)


@query("SELECT 'json' AS kind, p_name AS value FROM part UNION ALL SELECT 'line', p_name FROM part")
def jsonl_and_lines(spark: SparkSession, d: str) -> DataFrame:
    """Records written as JSON lines and as prompt lines, with bad and blank ones between, and read again."""
    path = scratch(spark)
    p = table(spark, d, "part").select("p_partkey", "p_name")
    sinks.write_jsonl(p, path + "/json", "p_name", path + "/text", ["p_partkey"])
    spark.createDataFrame([("{bad",), ("",), ("[1, 2]",)], "value string").coalesce(1).write.text(path + "/bad")
    records = readers.json_records(spark, path + "/json").union(readers.json_records(spark, path + "/bad"))
    lines = readers.prompt_lines(spark, path + "/text")
    return records.select(F.lit("json").alias("kind"), F.get_json_object("json", "$.p_name").alias("value")).union(lines.select(F.lit("line"), "line"))


@query("""SELECT '{"n":' || count(*) || ',"parts":' || count(DISTINCT l_partkey) || ',"first":' || min(l_orderkey) || '}' AS json FROM lineitem""")
def summary_record(spark: SparkSession, d: str) -> DataFrame:
    """One JSON object of aggregates."""
    return sinks.summary(table(spark, d, "lineitem"), F.count("*").alias("n"), F.countDistinct("l_partkey").alias("parts"), F.min("l_orderkey").alias("first"))


@query("SELECT lower(n_name) || '.txt' AS name, 'Line one' || chr(10) || n_name || chr(10) AS text, CAST(10 + length(n_name) AS BIGINT) AS bytes, (SELECT 'Line one' || chr(10) || min(n_name) FROM nation) AS first FROM nation")
def whole_files(spark: SparkSession, d: str) -> DataFrame:
    """A text file for each nation: read whole, listed, and the first path that exists."""
    path = scratch(spark)
    n = table(spark, d, "nation").select(F.concat(F.lower("n_name"), F.lit(".txt")).alias("name"), F.concat(F.lit("Line one\n"), "n_name").alias("text"), "n_name")
    sinks.write_files(n, path, "name", "text")
    least = n.agg(F.min("name")).first()[0]
    first = readers.first_existing(spark, [f"{path}/none.txt", f"{path}/{least.replace(' ', '%20')}", f"{path}/{least}"], "nothing")
    name = F.url_decode(F.regexp_extract("path", r"([^/]*)$", 1))
    texts = readers.whole_texts(spark, path).select(name.alias("name"), "text")
    sizes = readers.listing(spark, path).select(name.alias("name"), F.col("length").alias("bytes"))
    return texts.join(sizes, "name").select("name", "text", "bytes", F.lit(first).alias("first"))


@query(f"SELECT CASE n_nationkey % 3 WHEN 0 THEN n_name WHEN 1 THEN 'guide of ' || n_name ELSE 'plain ' || n_name END AS style FROM ({NATION})")
def style_files(spark: SparkSession, d: str) -> DataFrame:
    """Styles from JSONL (the first that is not blank), JSON and text files."""
    path = scratch(spark)
    k = F.col("n_nationkey") % 3
    jsonl = F.concat(F.lit('{"global_style": "  "}\n{"global_style": "'), "n_name", F.lit('"}\n{"global_style": "later"}'))
    json = F.concat(F.lit('{"global_style": "x", "guide": "guide of '), "n_name", F.lit('"}'))
    n = table(spark, d, "nation").select(F.concat(F.col("n_nationkey").cast("string"), F.when(k == 0, ".jsonl").when(k == 1, ".json").otherwise(".txt")).alias("name"), F.when(k == 0, jsonl).when(k == 1, json).otherwise(F.concat(F.lit("\nplain "), "n_name", F.lit(" \n"))).alias("text"))
    sinks.write_files(n, path, "name", "text")
    return readers.style_of(spark, path).select("style")


@query("SELECT CAST(doc_id AS VARCHAR) || '.txt' AS path, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN CAST(doc_id AS VARCHAR) || '.wav' WHEN doc_id IN (SELECT doc_id FROM labels) THEN CAST(doc_id AS VARCHAR) || '.MP3' END AS audio FROM documents")
def sidecar_audio(spark: SparkSession, d: str) -> DataFrame:
    """The audio beside each text: .wav before .mp3."""
    name = F.col("doc_id").cast("string")
    own = table(spark, d, "labels")
    files = own.select(F.concat(name, F.lit(".MP3")).alias("path")).union(own.where("quality = 1").select(F.concat(name, F.lit(".wav")))).union(own.select(F.concat(name, F.lit(".jpg"))))
    return matching.sidecar(table(spark, d, "documents").select(F.concat(name, F.lit(".txt")).alias("path")), files)


@query("SELECT event_id, user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 10")
def newest_files(spark: SparkSession, d: str) -> DataFrame:
    """The ten newest of all events, as files in order of time and name."""
    return matching.newest_last(table(spark, d, "events"), "ts", "event_id", 10).select("event_id", "user_id")


@query("""SELECT o_custkey AS page, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS pos, CASE WHEN o_orderkey % 3 = 0 THEN 'track-' ELSE 'item-' END || o_orderkey AS id FROM orders QUALIFY o_orderkey % 5 <> 0""")
def track_pages(spark: SparkSession, d: str) -> DataFrame:
    """Pages of answers: an item's track before the item itself, null ids left out, places kept."""
    o = F.col("o_orderkey")
    key = F.when(o % 5 != 0, o.cast("string"))
    track = F.when(o % 3 == 0, F.struct(F.concat(F.lit("track-"), key).alias("id")))
    item = F.struct(o.alias("o"), F.concat(F.lit("item-"), key).alias("id"), track.alias("track"))
    pages = table(spark, d, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(item)).alias("items"))
    json = F.to_json(F.struct(F.transform("items", lambda x: x.dropFields("o")).alias("items")))
    return readers.track_ids(pages.select(F.col("o_custkey").alias("page"), json.alias("json")))


@query("""SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'album' WHEN 1 THEN 'playlist' END AS kind, CASE WHEN s_suppkey % 3 < 2 THEN 'x' || s_suppkey END AS id, CASE WHEN s_suppkey % 2 = 0 THEN 'https://v/' || s_suppkey END AS video FROM supplier""")
def link_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Kinds and ids of addresses, and the video link of a service's answer."""
    k = F.col("s_suppkey")
    address = F.when(k % 3 == 0, F.concat(F.lit("https://h/album/x"), k.cast("string"), F.lit("?si=1"))).when(k % 3 == 1, F.concat(F.lit("h:playlist:x"), k.cast("string"))).otherwise("https://h/artist/9")
    answer = F.when(k % 2 == 0, F.concat(F.lit('{"linksByPlatform": {"youtube": {"url": "https://v/'), k.cast("string"), F.lit('"}}}'))).otherwise('{"linksByPlatform": {}}')
    kind = readers.playlist_kind(address)
    return table(spark, d, "supplier").select("s_suppkey", kind["kind"].alias("kind"), kind["id"].alias("id"), readers.video_url(answer).alias("video"))


def _tables(spark: SparkSession, d: str) -> DataFrame:
    """A page for each conversation: a row of two cells for each of its pairs, then one of three and one of heads."""
    safe = lambda c: F.replace(F.replace(F.replace(F.col(c), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    row = F.concat(F.lit("<tr><td><b>U</b> "), safe("src"), F.lit("</td><td><b>A</b> "), safe("tgt"), F.lit("</td></tr>"))
    rows = adapters.pairs(spark, d).select("doc_id", F.struct("pair_idx", row.alias("html")).alias("r")).groupBy("doc_id").agg(F.array_sort(F.collect_list("r")).alias("r"))
    body = F.array_join(F.transform("r", lambda x: x["html"]), "")
    return rows.select("doc_id", F.concat(F.lit("<table>"), body, F.lit("<tr><td>one</td><td>two</td><td>three</td></tr><tr><th>h</th><th>h</th></tr></table>")).alias("html"))


NUMBERED = f"n AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY pair_idx) - 1 AS k FROM pairs)"


@query(f"WITH {PAIRS}, {NUMBERED} SELECT doc_id, k AS pair_idx, {STRIP.format('src')} AS src, {STRIP.format('tgt')} AS tgt FROM n")
def html_rows(spark: SparkSession, d: str) -> DataFrame:
    """Conversations written as two-column tables and read again; rows of three cells and of heads are left out."""
    out = readers.html_pairs(_tables(spark, d))
    return out.select("doc_id", "pair_idx", F.col("src.text").alias("src"), F.col("tgt.text").alias("tgt"))


@query(f"WITH {PAIRS}, {NUMBERED} SELECT doc_id, k AS pair_idx, {STRIP.format('src')} AS src, 'U' AS speaker FROM n")
def html_groups(spark: SparkSession, d: str) -> DataFrame:
    """The same with lines grouped between two line breaks."""
    out = readers.html_pairs(_tables(spark, d), grouped=True)
    return out.select("doc_id", "pair_idx", F.col("src.text").alias("src"), F.col("src.character").alias("speaker"))


@query(rf"""WITH {PAIRS}, {NUMBERED}, c AS (SELECT doc_id, k AS "row", 'U ' || src AS a, 'A ' || tgt AS b, 2 AS size FROM n),
e AS (SELECT doc_id, max("row") + 1 AS last FROM c GROUP BY doc_id)
SELECT doc_id, "row", CAST(2 AS BIGINT) AS n_cells, trim(regexp_replace(a, '\s+', ' ', 'g')) AS first FROM c
UNION ALL SELECT doc_id, last, 3, 'one' FROM e UNION ALL SELECT doc_id, last + 1, 0, NULL FROM e""")
def html_cells(spark: SparkSession, d: str) -> DataFrame:
    """All cells of the tables."""
    out = readers.html_table(_tables(spark, d))
    return out.select("doc_id", "row", F.size("cells").cast("bigint").alias("n_cells"), F.get("cells", F.lit(0)).alias("first"))


# --- records


@query("""SELECT event_id, value / 1000 AS seconds, CASE WHEN event_id % 3 = 0 THEN value WHEN event_id % 3 = 1 THEN value + 1 ELSE 0.0 END AS duration, event_type = 'click' AND event_id % 3 = 1 AS valid, CASE event_id % 6 WHEN 0 THEN 'italian' WHEN 1 THEN 'german' WHEN 2 THEN 'english' WHEN 3 THEN 'french' WHEN 4 THEN 'spanish' ELSE 'xyz' END AS language,
greatest(event_id % 7, event_id % 11) AS higher FROM events""")
def transcription_records(spark: SparkSession, d: str) -> DataFrame:
    """Milliseconds, durations with their fallbacks, validity, names of all codes."""
    k = F.col("event_id")
    word = lambda kind, end: F.struct(kind.alias("type"), end.alias("end"))
    words = F.when(k % 3 == 1, F.array(word(F.lit(None).cast("string"), F.col("value") + 1), word(F.lit("spacing"), F.col("value") + 9))).otherwise(F.array().cast("array<struct<type:string,end:double>>"))
    probe = F.when(k % 3 == 0, F.col("value")).otherwise(0.0)
    codes = F.array(*map(F.lit, ["ita", "deu", "eng", "fra", "spa", "xyz"]))
    return table(spark, d, "events").select(
        "event_id", T.from_milliseconds(F.col("value")).alias("seconds"), readers.duration_of(probe, words).alias("duration"),
        requests.valid_transcription(F.col("event_type"), F.lit("click"), words).alias("valid"),
        T.one_of(T.LANGUAGES, F.get(codes, (k % 6).cast("int"))).alias("language"), F.greatest(k % 7, k % 11).alias("higher"),
    )


@query(r"""SELECT conv_id, turn, role || ',' || upper(role) || ',' || role || ',' || role || ',' || upper(role) || ',' || upper(role) AS cases, CASE WHEN turn % 2 = 0 THEN text || role WHEN turn % 3 = 0 THEN role ELSE 'none' END AS flat,
CASE WHEN turn % 2 = 0 THEN 'untitled' ELSE role END AS title, lower(text) AS answer FROM conversations""")
def message_records(spark: SparkSession, d: str) -> DataFrame:
    """Names in all cases, flattened content, titles, a stand-in provider's answers."""
    c = table(spark, d, "conversations")
    part = lambda kind, text: F.struct(F.lit(kind).alias("type"), text.alias("text"))
    parts = F.when(F.col("turn") % 2 == 0, F.array(part("text", F.col("text")), part("image", F.lit("no")), part("text", F.col("role"))))
    out = requests.generate(c.select("conv_id", "turn", "role", "text"), "text", lambda: str.lower)
    names = F.array("role", F.upper("role"))
    flat = T.flat_content(parts, F.when(F.col("turn") % 3 == 0, F.col("role")), F.lit("none"))
    title = requests.titled(F.when(F.col("turn") % 2 == 0, F.lit("  ")).otherwise(F.col("role")))
    return out.select("conv_id", "turn", F.array_join(T.all_cases(names), ",").alias("cases"), flat.alias("flat"), title.alias("title"), "answer")


@query(rf"""SELECT conv_id, {STRIP.format("string_agg(regexp_replace(text, '[ \t]+(\n|$)', chr(92) || '1', 'g'), chr(10) || chr(10) ORDER BY turn)")} AS text, CAST(count(*) AS BIGINT) AS n_blocks, string_agg({STRIP.format('text')}, '|' ORDER BY turn) AS blocks FROM (SELECT conv_id, turn, regexp_replace(regexp_replace(text, '\n+', ' ', 'g'), '\s+$', '') AS text FROM conversations) GROUP BY conv_id""")
def normal_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Turns with line ends of other systems and spaces before them, normalised and cut into blocks again."""
    line = F.regexp_replace(F.regexp_replace("text", r"\n+", " "), r"\s+$", "")
    c = table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), "turn", line.alias("text"))
    own = sinks.joined(c, "turn", "text", " \t\r\n\r\n").withColumnRenamed("doc_id", "conv_id")
    text, blocks = T.normal_lines(F.col("text")), T.blocks(F.col("text"))
    return own.select("conv_id", text.alias("text"), F.size(blocks).cast("bigint").alias("n_blocks"), F.array_join(F.transform(blocks, T.strip), "|").alias("blocks"))


@query("""SELECT o_custkey, string_agg(o_orderpriority, '|' ORDER BY first) AS in_order, string_agg(o_orderpriority, '|' ORDER BY o_orderpriority) AS sorted FROM (SELECT o_custkey, o_orderpriority, min(o_orderkey) AS first FROM orders GROUP BY ALL) GROUP BY o_custkey""")
def distinct_lists(spark: SparkSession, d: str) -> DataFrame:
    """A customer's priorities at their first places, and sorted."""
    o = table(spark, d, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", "o_orderpriority"))).alias("o"))
    x = F.transform("o", lambda y: y["o_orderpriority"])
    return o.select("o_custkey", F.array_join(matching.distinct_in_order(x), "|").alias("in_order"), F.array_join(F.array_sort(matching.distinct_in_order(x)), "|").alias("sorted"))


@query("SELECT min(p_partkey) AS p_partkey, p_brand FROM part GROUP BY p_brand ORDER BY 1 LIMIT 7")
def first_brands(spark: SparkSession, d: str) -> DataFrame:
    """The first seven brands, each at its first part."""
    return matching.first_distinct(table(spark, d, "part").select("p_partkey", "p_brand"), "p_brand", ["p_partkey"], 7)


@query("""WITH r AS (SELECT * FROM part ORDER BY p_partkey LIMIT 50), k AS (SELECT * FROM r WHERE p_size % 4 <> 0)
SELECT p_partkey AS ord, row_number() OVER (ORDER BY p_partkey) AS "index", count(*) OVER () AS total, p_name AS prompt, 'given' AS style FROM k""")
def limited_requests(spark: SparkSession, d: str) -> DataFrame:
    """The first fifty records, of which some have no prompt; a style that is given comes first."""
    p = table(spark, d, "part")
    r = p.select(F.col("p_partkey").alias("ord"), F.when(F.col("p_size") % 4 != 0, F.col("p_name")).otherwise("  ").alias("final_prompt"), F.lit("").alias("prompt"), F.lit("").alias("description"), F.col("p_brand").alias("global_style"))
    return requests.requests(r, limit=50, style="given")


@query("SELECT ord, url FROM (SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS ord, o_custkey || '/' || o_orderkey AS url, o_orderstatus FROM orders) WHERE o_orderstatus <> 'O'")
def gaps_in_ordinals(spark: SparkSession, d: str) -> DataFrame:
    """Rows without an address go after they are numbered, so their numbers stay free."""
    o = sequences.number(table(spark, d, "orders"), ["o_orderkey"], "o_custkey", "ord")
    url = F.when(F.col("o_orderstatus") != "O", F.concat(F.col("o_custkey").cast("string"), F.lit("/"), F.col("o_orderkey").cast("string")))
    return o.select("ord", url.alias("url")).where("url is not null")


@query("SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_suppkey AS BIGINT) AS l_suppkey FROM lineitem")
def strict_pairs(spark: SparkSession, d: str) -> DataFrame:
    """An order's parts and suppliers as two lists of one length, paired by place again."""
    each = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey")))
    o = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("doc_id")).agg(each.alias("l"))
    of = lambda c: F.transform("l", lambda x: x[c])
    lists = o.select("doc_id", F.arrays_zip(of("l_linenumber").alias("n"), of("l_partkey").alias("p")).alias("a"), of("l_suppkey").alias("b"))
    z = sequences.zip_lists(lists, "a", "b", strict=True)
    return z.select(F.col("doc_id").alias("l_orderkey"), F.col("src.n").alias("l_linenumber"), F.col("src.p").alias("l_partkey"), F.col("tgt").cast("bigint").alias("l_suppkey"))


@query(rf"WITH {LINES} SELECT doc_id, array_to_string(lines[3:7], '|') AS cut, array_to_string(lines[1:12], '|') AS first_12, array_to_string(lines[1:2], '|') AS clamped FROM lines WHERE len(lines) >= 3")
def line_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Lines 3 to 7 cut to what there is, the default number of first ones, and a range that begins before the list."""
    own = adapters.lines(spark, d).where(F.size("lines") >= 3)
    lines = F.col("lines")
    return own.select("doc_id", F.array_join(T.line_range(lines, 3, 7), "|").alias("cut"), F.array_join(T.first_items(lines, 0), "|").alias("first_12"), F.array_join(T.line_range(lines, -4, 2), "|").alias("clamped"))


@query(rf"""WITH {LINES}, s AS (SELECT doc_id, list_transform(range(0, len(lines)), lambda i: CASE WHEN (i // 12) % 2 = 0 THEN lines[i + 1] ELSE ' ' END) AS lines FROM lines),
c AS (SELECT doc_id, lines, unnest(range(0, CAST(ceil(len(lines) / 12) AS BIGINT))) AS chunk FROM s)
SELECT doc_id, chunk, array_to_string(lines[chunk * 12 + 1:chunk * 12 + 12], '|') AS src, array_to_string(list_transform(lines[chunk * 12 + 1:chunk * 12 + 12], lambda x: lower(x)), '|') AS tgt FROM c WHERE chunk % 2 = 0""")
def paired_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Every second chunk blank: both sides leave it out."""
    lines = F.transform("lines", lambda x, i: F.when(F.floor(i / 12) % 2 == 0, x).otherwise(" "))
    c = sequences.chunks(adapters.lines(spark, d).select("doc_id", lines.alias("lines")), "lines")
    return c.select("doc_id", "chunk", F.array_join("items", "|").alias("src"), F.array_join(F.transform("items", F.lower), "|").alias("tgt"))


@query(r"""WITH w AS (SELECT doc_id, unnest(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')) AS word, generate_subscripts(list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> ''), 1) - 1 AS word_idx FROM documents)
SELECT doc_id, word_idx, word FROM w WHERE word_idx < doc_id % 40""")
def limited_words(spark: SparkSession, d: str) -> DataFrame:
    """A document's words by line, cut at a number of its own."""
    docs = table(spark, d, "documents")
    w = sequences.words_to_lines(adapters.lines(spark, d), "lines", docs.select("doc_id", (F.col("doc_id") % 40).alias("n")))
    return w.select("doc_id", "word_idx", "word")


# --- timed words


@query(f"""WITH {WORDS}, g AS (SELECT doc_id, word_idx, word, word_idx // 10 AS seg_id, start_s, end_s FROM words),
s AS (SELECT doc_id, seg_id, CAST(count(*) * 5 AS BIGINT) AS duration FROM g GROUP BY ALL),
a AS (SELECT doc_id, seg_id, coalesce(sum(duration) OVER (PARTITION BY doc_id ORDER BY seg_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS shift FROM s)
SELECT doc_id, word_idx, start_s + shift AS start_s, end_s + shift AS end_s FROM g JOIN a USING (doc_id, seg_id)""")
def absolute_words(spark: SparkSession, d: str) -> DataFrame:
    """Words of ten a segment, with the durations of the segments before added to their times."""
    w = adapters.words(spark, d).withColumn("seg_id", F.floor(F.col("word_idx") / 10))
    s = w.groupBy("doc_id", "seg_id").agg((F.count("*") * 5).alias("duration"))
    return timeline.absolute(w, s).select("doc_id", "word_idx", "start_s", "end_s")


@query(f"""WITH {SEGMENTS}, b AS (SELECT *, coalesce(sum(duration) OVER (PARTITION BY doc_id ORDER BY seg_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start_s FROM segments)
SELECT doc_id, seg_id, duration, CAST(start_s AS BIGINT) AS start_s, CAST(CASE WHEN seg_id % 4 = 1 THEN 0 ELSE 2 END AS BIGINT) AS n_words FROM b""")
def blanked_segments(spark: SparkSession, d: str) -> DataFrame:
    """Every fourth day without words; it lasts as long as before."""
    s = adapters.segments(spark, d).withColumn("words", F.array(F.lit("a"), F.lit("b")))
    gone = s.where("seg_id % 4 = 1").select("doc_id", "seg_id")
    return timeline.starts(timeline.blank_segments(s, gone)).select("doc_id", "seg_id", "duration", F.col("start_s").cast("bigint").alias("start_s"), F.size("words").cast("bigint").alias("n_words"))


@query(f"""WITH {WORDS}, t AS (SELECT doc_id, unnest(range(0, max(word_idx) + 3)) AS tick FROM words GROUP BY doc_id),
f AS (SELECT doc_id, tick, CASE WHEN tick = 0 THEN -1 ELSE tick END AS word_idx FROM t WHERE tick % 3 <> 2),
l AS (SELECT doc_id, word_idx, word_idx // 7 AS line_idx FROM words)
SELECT t.doc_id, t.tick, coalesce(f.word_idx, -9) AS word_idx, CASE WHEN f.word_idx = -1 THEN -1 ELSE l.line_idx END AS line_idx
FROM t LEFT JOIN f USING (doc_id, tick) LEFT JOIN l ON l.doc_id = t.doc_id AND l.word_idx = f.word_idx""")
def frame_lines(spark: SparkSession, d: str) -> DataFrame:
    """Frames by whole ticks with a default, and their lines; the title's line is -1, an unknown word has none."""
    w = adapters.words(spark, d)
    ticks = w.groupBy("doc_id").agg(F.max("word_idx").alias("m")).select("doc_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("m") + 2)).alias("tick"))
    frames = ticks.where("tick % 3 <> 2").withColumn("word_idx", F.when(F.col("tick") == 0, F.lit(-1).cast("bigint")).otherwise(F.col("tick")))
    lines = w.select("doc_id", "word_idx", F.floor(F.col("word_idx") / 7).alias("line_idx"))
    return timeline.lookup_line(timeline.at_tick(ticks, frames, F.lit(-9).cast("bigint")), lines).select("doc_id", "tick", "word_idx", "line_idx")


@query(f"""WITH {WORDS}, f AS (SELECT doc_id, word_idx AS tick, CASE WHEN word_idx % 5 <> 3 THEN word END AS word_idx FROM words),
p AS (SELECT *, CASE word_idx WHEN 'view' THEN 2 WHEN 'click' THEN 1 WHEN 'purchase' THEN 3 ELSE -1 END AS pos FROM f),
m AS (SELECT *, max(CASE WHEN word_idx IS NOT NULL THEN CAST(pos + 1 AS VARCHAR) || word_idx END) OVER (PARTITION BY doc_id ORDER BY tick ROWS UNBOUNDED PRECEDING) AS best FROM p)
SELECT doc_id, tick, CASE WHEN word_idx IS NOT NULL THEN substr(best, 2) END AS word_idx FROM m""")
def ordered_frames(spark: SparkSession, d: str) -> DataFrame:
    """Frames whose values have an order of their own; one that is not in it comes before all others."""
    f = adapters.words(spark, d).select("doc_id", F.col("word_idx").alias("tick"), F.when(F.col("word_idx") % 5 != 3, F.col("word")).alias("word_idx"))
    order = spark.createDataFrame([("click", 1), ("view", 2), ("purchase", 3)], "word_idx string, pos int")
    return timeline.monotonic_frames(f, order).select("doc_id", "tick", "word_idx")


@query(r"""WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '\s+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, unnest([0, len(w) // 2, 0]) AS i, unnest([1, 2, 3]) AS ord, w FROM t WHERE len(w) >= 6),
f AS (SELECT doc_id, i, ord FROM p WHERE len(list_filter(range(0, len(w) - 2), lambda k: w[k + 1:k + 3] = w[i + 1:i + 3])) = 1 AND i + 3 <= len(w))
SELECT doc_id, CAST(i AS BIGINT) AS word_idx, CAST(max(ord) * 60 + 1 AS DOUBLE) AS ts FROM f GROUP BY doc_id, i""")
def marker_merge(spark: SparkSession, d: str) -> DataFrame:
    """Markers at phrases that stand once; of two for one place the later wins."""
    t = table(spark, d, "documents").select("doc_id", T.tokens(F.col("text")).alias("words")).where(F.size("words") >= 6)
    n = F.floor(F.size("words") / 2).cast("int")
    at = F.explode(F.array(*(F.struct(i.alias("i"), F.lit(k).alias("ord")) for i, k in ((F.lit(0), 1), (n, 2), (F.lit(0), 3)))))
    p = t.select("doc_id", "words", at.alias("x")).select("doc_id", "words", F.col("x.ord").alias("ord"), F.array_join(F.slice("words", F.col("x.i") + 1, 3), " ").alias("phrase"), F.concat(F.col("x.ord").cast("string"), F.lit(":01")).alias("timestamp"))
    return sequences.markers(p, once=True)


@query(f"""WITH {WORDS} SELECT doc_id, word_idx, CAST(sum(CAST(start_s IS NOT NULL AND end_s IS NOT NULL AS INT)) OVER w AS BIGINT) AS n FROM words
WINDOW w AS (PARTITION BY doc_id ORDER BY word_idx ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) QUALIFY count(*) OVER w = 20""")
def wide_moving_sum(spark: SparkSession, d: str) -> DataFrame:
    """Timed words among twenty, the smoothing's own width."""
    return quality.moving_sum(adapters.words(spark, d)).select("doc_id", "word_idx", F.col("n").cast("bigint").alias("n"))


# --- recursion: SQL for queries of the registry

# One ASCII sign for each letter beyond ASCII, as DuckDB's edit distance counts bytes; words are lower-cased before.
_LETTERS = "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)
_SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ" + "".join(f"{chr(c)}" for c in (1, 2, 3, 4, 5, 6))
_SIMILAR = "CASE WHEN greatest(length({0}), length({1})) = 0 THEN 1.0::DOUBLE ELSE 1 - levenshtein({0}, {1}) / greatest(length({0}), length({1}))::DOUBLE END"


def alignment_sql(marked: bool) -> str:
    """A row of the score table at a time, the row itself from left to right by list_reduce; then the way back through all moves as one text.

    marked: every ninth word has a marker.
    """
    at = lambda j: f"({j} + {j} % 4 * 0.5)"
    like = _SIMILAR.format("a[i + 1]", "b[j]")
    like = f"(({like}) + CASE WHEN (j - 1) % 9 = 4 AND abs({at('(j - 1)')} - i) < 1 THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END)" if marked else like
    start, end = "CASE WHEN heard THEN CAST(spot - 1 AS DOUBLE) END", "CASE WHEN heard THEN CAST(spot AS DOUBLE) END"
    if marked:
        start, end = (f"CASE WHEN j % 9 = 4 THEN CAST({at('j')}{more} AS DOUBLE) ELSE {x} END" for x, more in ((start, ""), (end, " + CASE WHEN move = 0 THEN 1 ELSE 5 END")))
    return rf"""
WITH RECURSIVE t AS (SELECT conv_id, turn, list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS w FROM conversations),
p AS (SELECT a.conv_id * 1000 + a.turn AS doc_id, b.w AS words, list_transform(a.w, lambda x: translate(lower(x), '{_LETTERS}', '{_SIGNS}')) AS a, list_transform(b.w, lambda x: translate(lower(x), '{_LETTERS}', '{_SIGNS}')) AS b
  FROM t b JOIN t a ON a.conv_id = b.conv_id AND b.turn = a.turn + 1),
rows(doc_id, i, cells, moves) AS (
  SELECT doc_id, 0::BIGINT, list_transform(range(0, len(b) + 1), lambda j: j * -0.5::DOUBLE), []::INT[] FROM p
  UNION ALL
  SELECT doc_id, i + 1, new, list_transform(range(1, len(new)), lambda j: CASE WHEN same[j] >= up[j] AND same[j] >= new[j] - 0.5 THEN 0 WHEN up[j] >= new[j] - 0.5 THEN 1 ELSE 2 END)
  FROM (SELECT *, list_reduce(list_prepend([(i + 1) * -0.5::DOUBLE], list_transform(range(1, len(up) + 1), lambda j: [greatest(same[j], up[j])])), lambda acc, x: list_append(acc, greatest(acc[len(acc)] - 0.5, x[1]))) AS new
    FROM (SELECT doc_id, i, list_transform(range(1, len(b) + 1), lambda j: cells[j] + {like}) AS same,
        list_transform(range(1, len(b) + 1), lambda j: cells[j + 1] - 0.5) AS up
      FROM rows JOIN p USING (doc_id) WHERE i < len(a)))),
table_of AS MATERIALIZED (SELECT doc_id, string_agg(array_to_string(moves, ''), '' ORDER BY i) AS moves FROM rows WHERE i > 0 GROUP BY doc_id),
way(doc_id, i, j, move, spot) AS (
  SELECT doc_id, len(a)::BIGINT, len(b)::BIGINT, NULL::INT, NULL::BIGINT FROM p
  UNION ALL
  SELECT doc_id, i - CAST(m < 2 AS INT), j - CAST(m <> 1 AS INT), m, i FROM (
    SELECT w.doc_id, i, j, CASE WHEN i = 0 THEN 2 ELSE CAST(substr(moves, (i - 1) * n + j, 1) AS INT) END AS m
    FROM way w JOIN (SELECT doc_id, len(b) AS n FROM p) USING (doc_id) LEFT JOIN table_of USING (doc_id) WHERE j > 0))
SELECT doc_id, j AS word_idx, words[j + 1] AS word, {start} AS start_s, {end} AS end_s
FROM (SELECT way.doc_id, j, words, spot, move, move = 0 AND ({_SIMILAR.format("a[spot]", "b[j + 1]")}) >= 0.3 AS heard FROM way JOIN p USING (doc_id) WHERE move IN (0, 2))
"""


ORACLE["align_words"] = alignment_sql(False)

_BALANCE = "length(replace(x, ')', '')) - length(replace(x, '(', ''))"
#: A part's key is the way to it, so parts in order of keys are in order.
ORACLE["split_long"] = rf"""
WITH RECURSIVE {LINES.replace("lines AS", "l0 AS")},
r(doc_id, key, s, t) AS (
  SELECT doc_id, '', lines, list_reverse(lines) FROM l0
  UNION ALL
  SELECT doc_id, key || side, CASE WHEN side = '0' THEN s[1:cut] ELSE s[cut + 1:len(s)] END, CASE WHEN side = '0' THEN t[1:cut] ELSE t[cut + 1:len(t)] END
  FROM (SELECT doc_id, key, s, t, coalesce(list_min(list_transform(list_filter(range(1, len(s)), lambda i: list_sum(b[1:i]) = 0), lambda i: (abs(i - len(s) // 2) * 2 + CAST(i < len(s) // 2 AS INT)) * 1000000 + i)) % 1000000, len(s) // 2) AS cut
    FROM (SELECT *, list_transform(s, lambda x: {_BALANCE}) AS b FROM r WHERE len(s) > 15)), (VALUES ('0'), ('1')) AS sides(side))
SELECT doc_id, 0::BIGINT AS pair_idx, row_number() OVER (PARTITION BY doc_id ORDER BY key) - 1 AS part, array_to_string(s, chr(10)) AS src, array_to_string(t, chr(10)) AS tgt FROM r WHERE len(s) <= 15
"""

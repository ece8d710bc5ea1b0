"""Readers and sinks on small files."""

import base64
import json

import pytest
from pyspark.sql import functions as F

from cantolith.sources import readers, sinks
from cantolith.streaming.sessions import sessions


def test_transcriptions(spark, tmp_path):
    for k in (1, 2, 3, 11):
        (tmp_path / f"{k:02d}.json").write_text(json.dumps({"text": f"t{k}", "language": "italian", "duration": 1.5, "words": [{"start": 0, "end": 1, "word": "a"}]}, indent=2))
    df = readers.transcriptions(spark, str(tmp_path))
    assert sorted(r.seg_id for r in readers.file_range(df, 2, 11).collect()) == [2, 3]
    assert df.where("seg_id = 11").first().words[0].word == "a"


def test_vendor(spark, tmp_path):
    words = [{"type": "word", "text": "a", "start": 1.0, "end": 2.0}, {"type": "spacing", "text": " ", "start": 2.0, "end": 9.0}, {"type": "word"}]
    (tmp_path / "v.json").write_text(json.dumps({"language_code": "ita", "text": "a", "words": words}))
    r = readers.vendor_transcriptions(spark, str(tmp_path)).select(readers.vendor_words(F.col("words")).alias("w"), readers.duration_of(F.lit(0.0), F.col("words")).alias("d"), readers.duration_of(F.lit(7.0), F.col("words")).alias("e")).first()
    assert [tuple(x) for x in r.w] == [(1.0, 2.0, "a"), (0.0, 0.0, "")] and (r.d, r.e) == (2.0, 7.0)
    assert spark.range(1).select(readers.duration_of(F.lit(None).cast("double"), F.array().cast("array<struct<type:string,text:string,start:double,end:double>>")).alias("d")).first().d == 0.0


def test_lines_and_records(spark, tmp_path):
    (tmp_path / "p.txt").write_text(" one \n\n\ttwo\nthree\n")
    assert [r.line for r in readers.prompt_lines(spark, str(tmp_path / "p.txt")).orderBy("ord").collect()] == ["one", "two", "three"]
    assert [r.line for r in readers.prompt_lines(spark, str(tmp_path / "p.txt"), 2).orderBy("ord").collect()] == ["one", "two"]
    assert readers.prompt_lines(spark, str(tmp_path / "p.txt"), 0).count() == 3
    (tmp_path / "r.jsonl").write_text('{"a": 1}\n\n{bad\n[1]\n "x"\n {"global_style": " noir "}\n')
    assert [r.json for r in readers.json_records(spark, str(tmp_path / "r.jsonl")).orderBy("ord").collect()] == ['{"a": 1}', '{"global_style": " noir "}']
    assert readers.style_of(spark, str(tmp_path / "r.jsonl")).first().style == "noir"
    (tmp_path / "s.json").write_text('{"guide": " ", "short_suffix": "ink"}')
    assert readers.style_of(spark, str(tmp_path / "s.json")).first().style == "ink"
    assert readers.style_of(spark, str(tmp_path / "p.txt")).first().style == "one \n\n\ttwo\nthree"
    assert readers.first_existing(spark, [str(tmp_path / "no"), str(tmp_path / "p.txt")], "f") == "one \n\n\ttwo\nthree"
    assert readers.first_existing(spark, [str(tmp_path / "no")], "f") == "f"
    assert readers.listing(spark, str(tmp_path)).count() == 3


def test_csv_round_trip(spark, tmp_path):
    (tmp_path / "w.csv").write_text("word,start,end\na,1.0,2.5\nNA,,\n")
    df = readers.aligned_csv(spark, str(tmp_path / "w.csv"))
    assert [tuple(r) for r in df.collect()] == [("a", 1.0, 2.5), (None, None, None)]
    big = spark.range(1000).select(F.col("id"), (F.col("id") * 2).alias("v"))
    sinks.write_csv(big, str(tmp_path / "out"), ["id"])
    lines = [x for p in sorted((tmp_path / "out").glob("part-*")) for x in p.read_text().splitlines() if x != "id,v"]
    assert lines == [f"{k},{2 * k}" for k in range(1000)]
    with pytest.raises(Exception):
        sinks.write_csv(big, str(tmp_path / "out"), ["id"])


def test_other_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, "b\nc"), (1, "a")], "ord long, text string")
    sinks.write_jsonl(df, str(tmp_path / "j"), "text", str(tmp_path / "t"), ["ord"])
    read = lambda d: [x for p in sorted((tmp_path / d).glob("part-*")) for x in p.read_text().splitlines()]
    assert [json.loads(x)["ord"] for x in read("j")] == [1, 2] and read("t") == ["a", "b c"]
    sinks.write_json_documents(df, str(tmp_path / "d"), "ord")
    assert json.loads(next((tmp_path / "d" / "ord=1").glob("part-*")).read_text()) == {"text": "a"}
    assert json.loads(sinks.summary(df, F.count("*").alias("n")).first().json) == {"n": 2}
    own = df.withColumn("doc_id", F.lit(1))
    assert sinks.joined(own, "ord", "text").first().text == "a\n\nb\nc"


def test_config(tmp_path):
    (tmp_path / "c.yaml").write_text('title: "Carmen"\nfile_prefix: carmen\nstart_idx: 1 # first\nend_idx: 35\nhd: true\noverture_indices: [1, 2]\ncharacters:\n  - Don José\n  - Micaela\nurl:\n')
    want = {"title": "Carmen", "file_prefix": "carmen", "start_idx": 1, "end_idx": 35, "hd": True, "overture_indices": [1, 2], "characters": ["Don José", "Micaela"], "url": None}
    got = readers.config(str(tmp_path / "c.yaml"), defaults={"font_size": 40})
    assert got == want | {"font_size": 40} and readers._plain_yaml((tmp_path / "c.yaml").read_text()) == want
    (tmp_path / "c.yaml").write_text("title: x\n")
    with pytest.raises(ValueError, match="missing"):
        readers.config(str(tmp_path / "c.yaml"))


def test_nested(spark):
    payload = base64.b64encode(b"png").decode()
    answer = {"imagePanels": [{"prompt": "p", "generatedImages": [{"encodedImage": payload, "seed": 5, "mediaGenerationId": "m"}, {"encodedImage": "", "seed": 6}, {"seed": 7}]}, {"generatedImages": None}]}
    df = spark.createDataFrame([(json.dumps(answer),), ("{}",)], "json string")
    assert [tuple(r) for r in readers.images(df).collect()] == [(0, 0, "p", 5, "m", bytearray(b"png"))]
    pages = spark.createDataFrame([(0, json.dumps({"items": [{"track": {"id": "a"}}, {"track": {"id": None}}, {"id": "b"}]}))], "page long, json string")
    assert [tuple(r) for r in readers.track_ids(pages).orderBy("pos").collect()] == [(0, 0, "a"), (0, 2, "b")]
    row = spark.sql("SELECT 'https://x/album/4aZ?si=1' AS u, '{\"linksByPlatform\":{\"youtube\":{\"url\":\"y\"}}}' AS j").select(readers.playlist_kind(F.col("u")).alias("k"), readers.playlist_kind(F.lit("x")).alias("n"), readers.video_url(F.col("j")).alias("v")).first()
    assert tuple(row.k) == ("album", "4aZ") and row.n is None and row.v == "y"


def test_html(spark):
    page = "<table><tr><td>lost</td><td>lost</td></tr><tr><td><b>TOM</b> Ciao <i>(esce)</i> poi<br><br>due</td><td><b>TOM</b> Hi <i>(exit)</i> then<br><br>two</td></tr><tr><td></td><td>x</td></tr><tr><td>one</td></tr></table>"
    plain = readers.parallel_lines(page)
    assert plain == [("lyric", "Ciao", "TOM", "lyric", "Hi", "TOM"), ("direction", "(esce)", None, "direction", "(exit)", None), ("lyric", "poi", "TOM", "lyric", "then", "TOM"), ("lyric", "due", "TOM", "lyric", "two", "TOM")]
    uneven = page.replace("poi", "")
    assert readers.parallel_lines(uneven)[2][1] == "due" and readers.parallel_lines(uneven)[2][4] == "then"
    assert [x[1] + x[4] for x in readers.parallel_lines(uneven, grouped=True)] == ["CiaoHi", "(esce)(exit)", "duetwo"]
    df = spark.createDataFrame([(1, page), (2, None), (3, "")], "doc_id long, html string")
    assert readers.html_pairs(df).count() == 4
    assert readers.html_table(df).where("row = 3").first().cells == ["one"]


def test_stream_equals_batch(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    events.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    q = sessions(stream, "6 hours", "1 day").writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = {tuple(r) for r in spark.read.schema("user_id long, start timestamp, end timestamp, n long").parquet(str(tmp_path / "out")).collect()}
    every = {tuple(r) for r in sessions(events, "6 hours").collect()}
    last = events.agg(F.max("ts")).first()[0]
    closed = {r for r in every if (last - r[2]).total_seconds() > 86400}
    assert closed and closed <= got <= every

"""Readers of the engine's inputs; schemas are given, never inferred."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cantolith.functions import text as T

TRANSCRIPTION = "text string, language string, duration double, words array<struct<start:double,end:double,word:string,confidence:double>>"
VENDOR = "language_code string, text string, words array<struct<type:string,text:string,start:double,end:double>>"
ALIGNED = "word string, start double, end double"
RESPONSE = "imagePanels array<struct<prompt:string,generatedImages:array<struct<encodedImage:string,seed:bigint,mediaGenerationId:string>>>>"
# What a CSV field is read as null for.
NULLS = ("", "NA", "N/A", "NaN", "nan", "null", "NULL", "None", "n/a", "<NA>", "#N/A", "#NA", "-NaN", "-nan", "1.#IND", "1.#QNAN", "-1.#IND", "-1.#QNAN", "#N/A N/A")


def transcriptions(spark: SparkSession, path: str) -> DataFrame:
    """(seg_id, path, TRANSCRIPTION) of JSON files named by their ordinal."""
    df = spark.read.schema(TRANSCRIPTION).option("multiLine", True).json(path)
    name = F.col("_metadata.file_path")
    return df.select(F.regexp_extract(name, r"(\d+)[^/]*$", 1).cast("bigint").alias("seg_id"), name.alias("path"), "*")


def file_range(df: DataFrame, first: int, end: int) -> DataFrame:
    """Files of ordinals first <= seg_id < end."""
    return df.where((F.col("seg_id") >= first) & (F.col("seg_id") < end))


def vendor_transcriptions(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.schema(VENDOR).option("multiLine", True).json(path)
    return df.select(F.col("_metadata.file_path").alias("path"), "*")


def vendor_words(words: Column) -> Column:
    """Vendor words without spacing ones, as (start, end, word); absent times are 0.0, absent text ''."""
    kept = F.filter(words, lambda w: w["type"].isNull() | (w["type"] != "spacing"))
    return F.transform(kept, lambda w: F.struct(F.coalesce(w["start"], F.lit(0.0)).alias("start"), F.coalesce(w["end"], F.lit(0.0)).alias("end"), F.coalesce(w["text"], F.lit("")).alias("word")))


def duration_of(probe: Column, words: Column) -> Column:
    """The probed duration, where it is not 0, else the last end of the words but spacing ones, else 0.0."""
    ends = F.transform(F.filter(words, lambda w: w["type"].isNull() | (w["type"] != "spacing")), lambda w: w["end"])
    return F.coalesce(F.nullif(probe, F.lit(0.0)), F.array_max(ends), F.lit(0.0))


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of whole files."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def _lines(texts: DataFrame) -> DataFrame:
    """(path, ord, line) of the lines of whole texts; a file's order is kept."""
    return texts.select("path", F.posexplode(F.split("text", "\r?\n")).alias("ord", "line")).select("path", F.col("ord").cast("bigint").alias("ord"), "line")


def prompt_lines(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """(ord, line): trimmed lines that are not blank, of a file; the first limit of them (None or 0: all)."""
    df = _lines(whole_texts(spark, path)).select("ord", T.strip(F.col("line")).alias("line")).where("line <> ''")
    return df.orderBy("ord").limit(limit) if limit else df


def json_records(spark: SparkSession, path: str) -> DataFrame:
    """(ord, json): a JSONL file's lines that are JSON objects; blank and bad lines and other values are left out."""
    df = _lines(whole_texts(spark, path)).select("ord", T.strip(F.col("line")).alias("json"))
    return only_objects(df, "json")


def only_objects(df: DataFrame, json: str) -> DataFrame:
    """Rows whose text is a JSON object."""
    return df.where(F.col(json).startswith("{") & F.try_parse_json(json).isNotNull())


def aligned_csv(spark: SparkSession, path: str) -> DataFrame:
    """ALIGNED rows of a CSV with a header; NULLS are null."""
    raw = spark.read.schema("word string, start string, end string").option("header", True).csv(path)
    blank = lambda c: F.when(~F.col(c).isin(*NULLS), F.col(c))
    return raw.select(blank("word").alias("word"), blank("start").cast("double").alias("start"), blank("end").cast("double").alias("end"))


def config(path: str, required: tuple[str, ...] = ("title", "file_prefix", "start_idx", "end_idx"), defaults: dict | None = None) -> dict:
    """A YAML file of scalars and lists as a dict; a missing required key raises an error.

    Uses PyYAML where it is installed; else a reader of 'key: value', 'key: [a, b]' and '- item' lines.
    """
    text = Path(path).read_text()
    try:
        import yaml

        out = yaml.safe_load(text)
    except ImportError:
        out = _plain_yaml(text)
    for k in required:
        if k not in out:
            raise ValueError(f"config key {k!r} is missing")
    return (defaults or {}) | out


def _plain_yaml(text: str) -> dict:
    def value(x: str):
        x = x.strip()
        if x[:1] == x[-1:] and x[:1] in "\"'" and len(x) > 1:
            return x[1:-1]
        if x.startswith("[") and x.endswith("]"):
            return [value(y) for y in x[1:-1].split(",") if y.strip()]
        if x in ("", "null", "~"):
            return None
        if x in ("true", "false"):
            return x == "true"
        for kind in (int, float):
            try:
                return kind(x)
            except ValueError:
                pass
        return x

    out, key = {}, None
    for line in text.splitlines():
        line = line.split(" #")[0].rstrip()
        if not line.strip() or line.lstrip().startswith("#"):
            continue
        if line.lstrip().startswith("- "):
            if out.get(key) is None:
                out[key] = []
            out[key].append(value(line.lstrip()[2:]))
        elif ":" in line:
            key, _, rest = line.strip().partition(":")
            out[key] = value(rest)
    return out


#: The keys of a config, those that it must have, and what the others are without it.
CONFIG = (
    "title string, file_prefix string, language string, start_idx int, end_idx int, overture_indices array<int>, characters array<string>, secondary_color string, "
    "playlist_url string, spotify_url string, translation_file string, video_width int, video_height int, font_size int, res_divisor int"
)
REQUIRED = ("title", "file_prefix", "language", "start_idx", "end_idx", "overture_indices", "characters")
DEFAULTS = {"secondary_color": "Silver", "video_width": 3840, "video_height": 2160, "font_size": 96, "res_divisor": 1}


def typed_config(text: str) -> tuple[dict, str | None]:
    """(values by key, error or null) of a config's text: error names the keys that are missing or of another type."""
    try:
        try:
            import yaml

            found = yaml.safe_load(text)
        except ImportError:
            found = _plain_yaml(text)
    except Exception as e:
        return {}, f"not readable: {' '.join(str(e).split())}"
    if not isinstance(found, dict):
        return {}, "not a mapping"
    is_int = lambda x: isinstance(x, int) and not isinstance(x, bool) and abs(x) < 1 << 31
    right = {
        "int": is_int, "string": lambda x: isinstance(x, (str, int, float, bool)),
        "array<int>": lambda x: isinstance(x, list) and all(map(is_int, x)), "array<string>": lambda x: isinstance(x, list) and all(isinstance(y, (str, int, float)) for y in x),
    }
    out, wrong = {}, []
    for key, kind in (x.split(" ") for x in CONFIG.split(", ")):
        value = found.get(key, DEFAULTS.get(key))
        if value is not None and not right[kind](value):
            wrong.append(key)
        elif value is not None:
            out[key] = str(value) if kind == "string" else [str(y) for y in value] if kind == "array<string>" else value
    missing = [k for k in REQUIRED if k not in found]
    said = [f"{what}: {', '.join(keys)}" for what, keys in (("missing", missing), ("wrong type", wrong)) if keys]
    return out, "; ".join(said) or None


def configs(spark: SparkSession, path: str) -> DataFrame:
    """(path, CONFIG, error) of YAML files, a row each, read by the executors; a bad file has an error and what could be read of it, an empty one no row."""
    names = [x.split(" ")[0] for x in CONFIG.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            read = [typed_config(x or "") for x in f["text"]]
            rows = [(p, *(values.get(n) for n in names), error) for p, (values, error) in zip(f["path"], read, strict=True)]
            yield pd.DataFrame(rows, columns=["path", *names, "error"], dtype=object)

    return whole_texts(spark, path).mapInPandas(run, f"path string, {CONFIG}, error string")


def style_of(spark: SparkSession, path: str) -> DataFrame:
    """(style) by the file's suffix: a JSONL's first global_style that is not blank, a JSON's guide, global_style or short_suffix, else the whole text."""
    whole = whole_texts(spark, path)
    ext = T.suffix(F.col("path"))
    field = lambda c, k: T.not_empty(T.strip(F.get_json_object(c, f"$.{k}")))
    first = F.get(F.filter(F.transform(F.split("text", "\r?\n"), lambda x: F.get_json_object(x, "$.global_style")), lambda s: s.isNotNull() & ~T.is_blank(s)), F.lit(0))
    return whole.select(F.when(ext == ".jsonl", T.strip(first)).when(ext == ".json", F.coalesce(field(F.col("text"), "guide"), field(F.col("text"), "global_style"), field(F.col("text"), "short_suffix"))).otherwise(T.not_empty(T.strip(F.col("text")))).alias("style"))


def first_existing(spark: SparkSession, paths: list[str], fallback: str) -> str:
    """The first of the files that can be read, stripped, else fallback."""
    for p in paths:
        try:
            row = whole_texts(spark, p).first()
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            continue
        if row:
            return row["text"].strip()
    return fallback


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, mtime, length) of a folder's files; their contents are not read."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("modificationTime").alias("mtime"), "length")


def images(responses: DataFrame, json: str = "json") -> DataFrame:
    """(panel, image, prompt, seed, id, bytes) of image responses; entries without a payload are left out."""
    r = responses.select(F.from_json(json, RESPONSE).alias("r"))
    panels = r.select(F.posexplode("r.imagePanels").alias("panel", "p"))
    each = panels.select("panel", "p.prompt", F.posexplode("p.generatedImages").alias("image", "g"))
    return each.where(F.col("g.encodedImage") != "").select(F.col("panel").cast("bigint").alias("panel"), F.col("image").cast("bigint").alias("image"), "prompt", F.col("g.seed").alias("seed"), F.col("g.mediaGenerationId").alias("id"), F.unbase64("g.encodedImage").alias("bytes"))


def playlist_kind(url: Column) -> Column:
    """(kind, id) of an album's or playlist's address, null for others."""
    pattern = r"(album|playlist)[/:]([0-9A-Za-z]+)"
    return F.when(F.regexp_like(url, F.lit(pattern)), F.struct(F.regexp_extract(url, pattern, 1).alias("kind"), F.regexp_extract(url, pattern, 2).alias("id")))


def track_ids(pages: DataFrame, json: str = "json", order: str = "page") -> DataFrame:
    """(page, pos, id) of answer pages' items, null ids left out; an item's track counts before the item itself."""
    schema = "items array<struct<id:string,track:struct<id:string>>>"
    each = pages.select(order, F.posexplode(F.from_json(json, schema)["items"]).alias("pos", "i"))
    return each.select(F.col(order).alias("page"), F.col("pos").cast("bigint").alias("pos"), F.coalesce("i.track.id", "i.id").alias("id")).where("id is not null")


def video_url(json: Column) -> Column:
    """The video link of a link service's answer; null without one."""
    return F.get_json_object(json, "$.linksByPlatform.youtube.url")


class _Cells(HTMLParser):
    """Rows of a table's cells; a cell is a list of (kind, text): 'b', 'i', 'br' or 'text'."""

    def __init__(self):
        super().__init__()
        self.rows, self.kind, self.cell = [], "text", None

    def handle_starttag(self, tag, attrs):
        if tag == "tr":
            self.rows.append([])
        elif tag == "td":
            if not self.rows:
                self.rows.append([])
            self.cell = []
            self.rows[-1].append(self.cell)
        elif tag in ("b", "i"):
            self.kind = tag
            if self.cell is not None:
                self.cell.append((tag, ""))
        elif tag == "br" and self.cell is not None:
            self.cell.append(("br", "\n"))

    def handle_endtag(self, tag):
        if tag in ("b", "i"):
            self.kind = "text"
        elif tag == "td":
            self.cell = None

    def handle_data(self, data):
        if self.cell is None:
            return
        if self.kind != "text" and self.cell and self.cell[-1][0] == self.kind:
            self.cell[-1] = (self.kind, self.cell[-1][1] + data)
        else:
            self.cell.append((self.kind, data))


def _cell_lines(cell, who, grouped):
    """Lines (kind, text, character) of a cell, or its groups between two line breaks; and the last speaker."""
    groups, now, breaks = [], [], 0
    for kind, text in cell:
        if kind == "br":
            breaks += 1
            if grouped and breaks == 2 and now:
                groups.append(now)
                now = []
            continue
        if text.strip() or kind in ("b", "i"):
            breaks = 0
        if kind == "b":
            who = text.strip()
        elif kind == "i":
            now.append(("direction", text.strip(), None))
        elif text.strip() and who is not None:
            now.append(("lyric", text.strip(), who))
    return [*groups, now] if now or not groups else groups, who


def parallel_lines(html: str, grouped: bool = False) -> list[tuple]:
    """(src kind, text, character, tgt kind, text, character) of a two-column table's lines, by position in a row (or in a group).

    Rows of other than two td cells or with an empty cell are left out; lines before the first speaker
    of their page as well; the longer side's last lines have no partner and are left out.
    """
    parser = _Cells()
    parser.feed(html)
    parser.close()
    out, who = [], None
    for row in parser.rows:
        if len(row) != 2:
            continue
        if not all("".join(t for k, t in c if k != "br").strip() for c in row[:2]):
            names = [t.strip() for c in row for k, t in c if k == "b"]
            who = names[-1] if names else who
            continue
        left, who = _cell_lines(row[0], who, grouped)
        right, who = _cell_lines(row[1], who, grouped)
        for a, b in zip(left, right, strict=False):
            out += [(*x, *y) for x, y in zip(a, b, strict=False)]
    return out


def html_pairs(pages: DataFrame, html: str = "html", doc: str = "doc_id", grouped: bool = False) -> DataFrame:
    """(doc_id, pair_idx, src, tgt) of parallel_lines(), each side a struct of kind, text and character."""
    side = "struct<kind:string,text:string,character:string>"
    kind = dict(pages.dtypes)[doc]
    names = ("kind", "text", "character")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(d, k, dict(zip(names, x[:3], strict=True)), dict(zip(names, x[3:], strict=True))) for d, h in zip(f[doc], f[html], strict=True) for k, x in enumerate(parallel_lines(h or "", grouped))]
            yield pd.DataFrame(rows, columns=["doc_id", "pair_idx", "src", "tgt"])

    return pages.select(doc, html).mapInPandas(run, f"doc_id {kind}, pair_idx long, src {side}, tgt {side}")


def html_table(pages: DataFrame, html: str = "html", doc: str = "doc_id") -> DataFrame:
    """(doc_id, row, cells): all cells' texts of the tables of a page."""
    kind = dict(pages.dtypes)[doc]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for d, h in zip(f[doc], f[html], strict=True):
                p = _Cells()
                p.feed(h or "")
                p.close()
                rows += [(d, k, [" ".join("".join(t for _, t in c).split()) for c in r]) for k, r in enumerate(p.rows)]
            yield pd.DataFrame(rows, columns=["doc_id", "row", "cells"])

    return pages.select(doc, html).mapInPandas(run, f"doc_id {kind}, row long, cells array<string>")

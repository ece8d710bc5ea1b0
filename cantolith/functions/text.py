"""Column functions over text: timestamps, slugs, markup, blocks, JSON fragments, names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space as str.strip() and str.split() take it, for Java's regexes.
WHITE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"


def strip(x: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(F.regexp_replace(x, f"^{WHITE}+", ""), f"{WHITE}+$", "")


def is_blank(x: Column) -> Column:
    return strip(x) == ""


def not_empty(x: Column) -> Column:
    """x, with '' as null."""
    return F.nullif(x, F.lit(""))


def tokens(x: Column) -> Column:
    """Words between white space, without empty ones; null has none."""
    return F.filter(F.split(F.coalesce(x, F.lit("")), f"{WHITE}+"), lambda w: w != "")


def similarity(a: Column, b: Column) -> Column:
    """1 - edit distance of the lower-cased words over the longer one's length; two empty words are alike."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, 1.0).otherwise(1.0 - F.levenshtein(F.lower(a), F.lower(b)) / longest)


def seconds(x: Column) -> Column:
    """H:M:S, M:S or S, with fractions, as seconds; other forms raise an error."""
    p = F.split(x, ":")
    at = lambda k: F.element_at(p, k).cast("double")
    bad = F.raise_error(F.concat(F.lit("no time of the form H:M:S, M:S or S: "), x)).cast("double")
    return F.when(F.size(p) == 1, at(1)).when(F.size(p) == 2, at(1) * 60 + at(2)).when(F.size(p) == 3, at(1) * 3600 + at(2) * 60 + at(3)).when(x.isNotNull(), bad)


def from_milliseconds(ms: Column) -> Column:
    return ms / 1000.0


def clock(s: Column) -> Column:
    """Whole seconds as HH:MM:SS, with 'N day(s), ' before it from 24 hours on; the hour has two digits below that only."""
    n = F.floor(s).cast("bigint")
    day, rest = F.floor(n / 86400).cast("bigint"), n % 86400
    h, tail = F.floor(rest / 3600).cast("bigint"), F.format_string(":%02d:%02d", F.floor(rest / 60).cast("bigint") % 60, rest % 60)
    return F.when(day == 0, F.concat(F.format_string("%02d", h), tail)).otherwise(F.concat(day.cast("string"), F.when(day == 1, " day, ").otherwise(" days, "), h.cast("string"), tail))


def cue(s: Column, what: Column) -> Column:
    """A cue-sheet line; zeros and colons at the line's start go."""
    return F.regexp_replace(F.concat(clock(s), F.lit(" - "), what), "^[0:]+", "")


def slug(x: Column, longest: int = 80) -> Column:
    """Lower-case letters and digits with single hyphens between, at most longest characters."""
    return F.substring(F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9]+", "-"), "^-+|-+$", ""), 1, longest)


def normal_lines(x: Column) -> Column:
    """Line ends as \\n, spaces at line ends gone, the text trimmed."""
    return strip(F.regexp_replace(F.regexp_replace(x, r"\r\n?", "\n"), r"(?m)[ \t]+$", ""))


def blocks(x: Column) -> Column:
    """Blocks between two or more line ends, blank ones dropped, after normal_lines()."""
    return F.filter(F.split(normal_lines(x), r"\n{2,}"), lambda b: ~is_blank(b))


def blocks_at(x: Column, separator: str = "\n\n") -> Column:
    """Blocks between exact separators, blank ones dropped; three line ends leave one at a block's start."""
    return F.filter(F.split(x, F.regexp_replace(F.lit(separator), r"([\\.\[\]{}()*+?^$|])", r"\\$1")), lambda b: ~is_blank(b))


def all_cases(names: Column) -> Column:
    """Names, then lower-cased, then upper-cased; repeated ones stay."""
    return F.concat(names, F.transform(names, F.lower), F.transform(names, F.upper))


def speaker(x: Column, names: Column, mark: str = "\n") -> Column:
    """The first of names that x starts with, followed by mark; null without one."""
    return F.get(F.filter(names, lambda n: x.startswith(F.concat(n, F.lit(mark)))), F.lit(0))


def markup(x: Column, names: Column) -> Column:
    """[(text, fmt)]: a bold speaker line, italic (…) and regular parts; an unclosed '(' is regular."""
    who = speaker(x, names)
    head = F.when(who.isNotNull(), F.concat(who, F.lit("\n")))
    rest = F.when(who.isNotNull(), F.substr(x, F.length(who) + 2)).otherwise(x)
    seg = lambda t, fmt: F.struct(t.alias("text"), fmt.alias("fmt"))
    body = F.transform(F.regexp_extract_all(rest, F.lit(r"\([^)]*\)?|[^(]+"), F.lit(0)), lambda s: seg(s, F.when(s.startswith("(") & s.endswith(")"), "italic").otherwise("regular")))
    return F.when(head.isNotNull(), F.concat(F.array(seg(head, F.lit("bold"))), body)).otherwise(body)


def break_after_speaker(x: Column, names: Column) -> Column:
    """A line end between a speaker's name and what follows it."""
    who = speaker(x, names, "")
    return F.when(who.isNotNull(), F.concat(who, F.lit("\n"), strip(F.substr(x, F.length(who) + 1)))).otherwise(x)


def strip_speaker(x: Column, names: Column) -> Column:
    """What follows the first ':' where x starts with 'Name:' or 'NAME:', trimmed; x otherwise."""
    hit = F.exists(names, lambda n: x.startswith(F.concat(n, F.lit(":"))) | x.startswith(F.concat(F.upper(n), F.lit(":"))))
    return F.when(hit, strip(F.regexp_replace(x, "(?s)^[^:]*:", ""))).otherwise(x)


def balance(x: Column) -> Column:
    """Opening less closing parentheses."""
    return F.length(F.replace(x, F.lit(")"), F.lit(""))) - F.length(F.replace(x, F.lit("("), F.lit("")))


def split_point(lines: Column) -> Column:
    """The index (from 1, before the end) nearest the middle before which parentheses balance; of two, the later; else the middle."""

    def best(x):
        n, mid = F.size(x), F.floor(F.size(x) / 2).cast("int")
        # opens[i]: the balance before line i
        opens = F.aggregate(x, F.array(F.lit(0)), lambda a, y: F.concat(a, F.array(F.element_at(a, -1) + balance(y))))
        near = F.filter(F.transform(opens, lambda o, i: F.struct(F.abs(i - mid).alias("d"), (i < mid).alias("before"), i.alias("i"), o.alias("open"))), lambda s: (s["open"] == 0) & (s["i"] > 0) & (s["i"] < n))
        return F.coalesce(F.array_min(near)["i"], mid)

    return F.get(F.transform(F.array(lines), best), F.lit(0))


def line_range(lines: Column, first: int | None = None, last: int | None = None) -> Column:
    """Lines first to last, from 1, both included and cut to the list; a last one before the first is an error."""
    n = F.size(lines)
    a = F.lit(1) if first is None else F.greatest(F.lit(1), F.lit(first))
    b = n if last is None else F.least(n, F.lit(last))
    wrong = F.raise_error(F.format_string("lines %d to %d are no range", a, b)).cast("array<string>")
    return F.when(b < a, wrong).otherwise(F.slice(lines, a, F.greatest(b - a + 1, F.lit(0))))


def first_items(items: Column, n: int, default: int = 12) -> Column:
    """The first n of a list; the first default of them for n of 0 or less."""
    return F.slice(items, 1, n if n > 0 else default)


def json_fragment(x: Column) -> Column:
    """The first JSON text of an answer: in a fence (shortest), else the longest [...] or {...}; null if it is no JSON."""
    fenced = not_empty(F.regexp_extract(x, r"(?s)```(?:json)?\s*([\[{].*?[\]}])\s*```", 1))
    bare = not_empty(F.regexp_extract(x, r"(?s)(\[.*\]|\{.*\})", 1))
    found = F.coalesce(fenced, bare)
    return F.when(F.try_parse_json(found).isNotNull(), found)


def alnum(x: Column) -> Column:
    """Lower-cased letters and digits of any script."""
    return F.regexp_replace(F.lower(x), r"[^\p{L}\p{N}]", "")


def stem(path: Column) -> Column:
    """A file name without its last suffix."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    return F.when(F.regexp_like(name, F.lit(r"^.+\.[^.]*$")), F.regexp_extract(name, r"^(.+)\.[^.]*$", 1)).otherwise(name)


def suffix(path: Column) -> Column:
    """A file name's last suffix with its dot, lower-cased; '' without one."""
    return F.lower(F.regexp_extract(F.regexp_extract(path, r"([^/]*)$", 1), r"^.+(\.[^.]+)$", 1))


def padded(n: Column, width: int = 2) -> Column:
    """Zero-padded, never cut."""
    return F.format_string(f"%0{width}d", n.cast("bigint"))


def title(name: Column) -> Column:
    """A file stem up to its first '_', hyphens as spaces, each word capitalised."""
    return F.initcap(F.replace(F.split_part(name, F.lit("_"), F.lit(1)), F.lit("-"), F.lit(" ")))


def one_of(names: dict[str, str], x: Column, keep: bool = True) -> Column:
    """names[x]; unknown ones stay, or become null."""
    found = F.element_at(F.create_map(*(F.lit(v) for kv in names.items() for v in kv)), x)
    return F.coalesce(found, x) if keep else found


# Language codes and names.
LANGUAGES = {"ita": "italian", "deu": "german", "eng": "english", "fra": "french", "spa": "spanish"}


def template(pattern: str, values: dict[str, Column]) -> Column:
    """pattern with every {name} replaced."""
    out = F.lit(pattern)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def prompt(description: Column, shot: Column, time: Column, lighting: Column, palette: Column, end: Column) -> Column:
    """Description, 'shot shot', time, 'lighting lighting', 'color palette: palette', end; empty ones skipped, line ends as spaces."""
    part = lambda x, before="", after="": F.concat(F.lit(before), not_empty(strip(x)), F.lit(after))
    joined = F.concat_ws(", ", part(description), part(shot, "", " shot"), part(time), part(lighting, "", " lighting"), part(palette, "color palette: "), part(end))
    return strip(F.replace(joined, F.lit("\n"), F.lit(" ")))


def paragraphs(parts: Sequence[Column]) -> Column:
    """Non-empty parts with a blank line between."""
    return F.concat_ws("\n\n", *(not_empty(strip(p)) for p in parts))


def clamp(n: Column, low: int = 1, high: int = 6) -> Column:
    return F.greatest(F.lit(low), F.least(F.coalesce(n, F.lit(low)), F.lit(high)))


def size_of(x: Column) -> Column:
    """'WxH' as (width, height, preset null); any other text as a preset; bad numbers raise an error."""
    wide = F.lower(x).contains("x")
    number = lambda k: F.split_part(F.lower(x), F.lit("x"), F.lit(k)).cast("int")
    return F.when(wide, F.struct(number(1).alias("width"), number(2).alias("height"), F.lit(None).cast("string").alias("preset"))).otherwise(F.struct(F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"), x.alias("preset")))


# File suffixes of media types.
MEDIA = {"image/png": ".png", "image/jpeg": ".jpg", "image/jpg": ".jpg", "image/webp": ".webp", "image/gif": ".gif"}


def extension(mime: Column, url: Column) -> Column:
    """By media type, else the url path's suffix, else .png."""
    path = F.regexp_extract(url, r"^(?:[a-zA-Z][\w+.-]*://[^/?#]*)?([^?#]*)", 1)
    return F.coalesce(one_of(MEDIA, F.lower(mime), False), not_empty(suffix(path)), F.lit(".png"))


def whole_number(x: Column) -> Column:
    """'' and 'none' as null, other texts as a number or an error."""
    return F.when((strip(x) == "") | (F.lower(strip(x)) == "none"), F.lit(None).cast("int")).otherwise(strip(x).cast("int"))


def resolved(path: Column, root: Column) -> Column:
    """Absolute paths as they are, others under root where there is one."""
    return F.when(path.startswith("/") | root.isNull(), path).otherwise(F.concat(F.rtrim(root, F.lit("/")), F.lit("/"), path))


def file_name(prefix: Column, index: Column, variant: Column, ext: Column) -> Column:
    return F.concat(prefix, F.lit("_"), padded(index, 3), F.lit("_"), padded(variant), ext)


def flat_content(parts: Column, text: Column, fallback: Column) -> Column:
    """Text parts joined where parts is not null, else text, else fallback."""
    own = F.array_join(F.transform(F.filter(parts, lambda p: p["type"] == "text"), lambda p: F.coalesce(p["text"], F.lit(""))), "")
    return F.coalesce(own, text, fallback)

"""Texts that shrink until they fit: lines by greedy filling, and the largest size that a height allows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def width(word: Column, glyphs: dict[int, str], other: int) -> Column:
    """A text's width in thousandths of its size: glyphs has characters by their width, others are other wide.

    Characters of one width are counted together, by what translating them away takes off.
    """
    of = lambda chars: F.length(word) - F.length(F.translate(word, chars, ""))
    known = sum((of(chars) * (w - other) for w, chars in glyphs.items()), F.lit(0))
    return (F.length(word) * other + known).cast("bigint")


def line_count(widths: Column, room: Column, space: int) -> Column:
    """Lines of words of some widths, each line as many as room holds; a wider word has a line of its own."""
    state = lambda n, x: F.struct(n.alias("n"), x.alias("x"))
    start = state(F.lit(0).cast("bigint"), F.lit(None).cast("bigint"))
    fits = lambda a, w: a["x"] + space + w <= room
    return F.aggregate(widths, start, lambda a, w: F.when(fits(a, w), state(a["n"], a["x"] + space + w)).otherwise(state(a["n"] + 1, w)), lambda a: a["n"])


def fitted(text: Column, glyphs: dict[int, str], column: int, height: int, size: int, least: int = 20, step: int = 2, other: int = 500, leading: int = 120) -> Column:
    """(size, lines) of a text in a column: the first of size, size - step, ... at which its lines are at most height high, or else the first that is not above least.

    Words stand between white space, a line end begins a new line and an empty one counts. A line is
    leading percent of the size high. Lines and their height only fall with the size, so the size is
    searched for by halving; null is an empty text, of no line.
    """
    sizes = [size]
    while sizes[-1] > least:
        sizes.append(sizes[-1] - step)
    space = next((w for w, chars in glyphs.items() if " " in chars), other)
    rows = F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<array<bigint>>")).otherwise(
        F.transform(F.split(text, "\n"), lambda line: F.transform(F.filter(F.split(line, r"[ \t\r\f\x0B]+"), lambda w: w != ""), lambda w: width(w, glyphs, other)))
    )
    of = F.array(*map(F.lit, sizes))
    at = lambda k: F.element_at(of, (k + 1).cast("int"))
    ends = lambda low, top: F.struct(low.cast("int").alias("low"), top.cast("int").alias("top"))
    half = lambda a: F.floor((a["low"] + a["top"]) / 2)

    def search(rows: Column) -> Column:
        room = lambda s: F.floor(F.lit(column * 1000) / s).cast("bigint")
        lines = lambda s: F.aggregate(rows, F.lit(0).cast("bigint"), lambda n, words: n + F.greatest(F.lit(1).cast("bigint"), line_count(words, room(s), space)))
        fits = lambda s: lines(s) * F.floor(s * leading / 100) <= height
        rounds = F.sequence(F.lit(1), F.lit(max(1, (len(sizes) - 1).bit_length())))
        halved = lambda a: F.when(a["low"] >= a["top"], a).when(fits(at(half(a))), ends(a["low"], half(a))).otherwise(ends(half(a) + 1, a["top"]))
        found = F.aggregate(rounds, ends(F.lit(0), F.lit(len(sizes) - 1)), lambda a, _: halved(a), lambda a: at(a["low"]))
        return F.transform(F.array(found), lambda s: F.struct(s.alias("size"), lines(s).alias("lines")))[0]

    return F.transform(F.array(rows), search)[0]  # the widths are made once

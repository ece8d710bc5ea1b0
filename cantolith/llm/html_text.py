"""HTML extraction with site template removal.

Element subtrees are hashed and counted by host in Spark, over pages of different main texts so
that copies of one page make no template; subtrees found in PAGES of them or more are deleted.
Paragraphs and headings inside the page's main element are prose and are never taken for
template, nor is anything that holds the main element. What a page alone tells is removed as well:
elements that are no text, and those whose tag, role or class names a menu, header, footer,
sidebar, notice, advert, form or reader comments.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import durable, in_batches, meet, table
from .url_filter import url_parts

#: Pages of a host, of different main texts, that make a subtree a template.
PAGES = 5
#: Templates that are broadcast (8 bytes each); beyond, pages meet theirs in a join.
BROADCAST = 1 << 20

# HTML element names by their part in a text, and words of classes and roles.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
ENDS_P = BLOCK - {"option", "title", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend"}
ITSELF = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",), "p": ()}
SAME = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}
DROP = frozenset("head nav header footer aside form script style noscript template iframe svg canvas button select textarea object audio video dialog menu title xmp noembed noframes datalist".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li td th dd dt figcaption".split())
CONTAINER = frozenset("div section ul ol table nav header footer aside form p article dl menu figure details address".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot banner promo promotion sponsor sponsored sidebar menu navbar nav navigation breadcrumb breadcrumbs masthead footer topbar toolbar notice notices cookie cookies consent gdpr alert newsletter subscribe subscription signup login search share sharing social comment comments commentlist disqus respond replies reply related recommended widget popup modal overlay pagination pager paywall skip copyright legal disclaimer".split()
)
# What may stand beside a word of NAMES in one class ("site-footer", "related-posts"); beside other words it means something else ("related-work").
BESIDE = frozenset(
    "site page main top bottom left right center upper lower primary secondary tertiary global local inner outer mobile desktop sticky fixed floating header head foot body content text box block list lists link links item items container wrapper wrap inner section sections area region panel bar row col column grid card button buttons icon icons group set post posts article articles story stories entry entries form field slot unit units zone space media module component title heading label message messages policy bottombar side js wp the my and is has".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
MAIN = frozenset("content article post entry story main".split())
OPEN = re.compile(r"<(?:(!--)|[!?]|(/?)([a-zA-Z][^\s/>]*))")
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
WORDS = re.compile(r"[a-z0-9]+")
BARRIER = frozenset("div section article td th main body aside button".split())
HEADING = re.compile(r"h[1-6]$")
HEADER = frozenset(["header"])
COMMENTS = frozenset("comment comments commentlist disqus respond replies reply".split())
#: What of NAMES tells that an article is not the page's own.
OTHERS = COMMENTS | frozenset("ad ads advert advertisement promo promotion sponsor sponsored related teaser".split())
#: What may lead to the main element from beside it.
LEAD = frozenset("h1 h2 h3 h4 h5 h6 p blockquote".split())


def tags(source: str) -> Iterator[tuple[int, int, str | None, bool, str]]:
    """(start, end, name, whether it closes, attributes) of each tag; name is None for comments and declarations.

    A '>' in quotes does not end a tag, unless the quotes are never closed. After a tag whose content is
    no markup the caller sends where to go on.
    """
    last = {q: source.rfind(q) for q in "\"'"}
    at = 0
    while m := OPEN.search(source, at):
        if m[1]:
            at = source.find("-->", m.end())
            at = len(source) if at < 0 else at + 3
            yield m.start(), at, None, False, ""
            continue
        end = source.find(">", m.end())
        end = len(source) if end < 0 else end
        attributes = source[m.end() : end]
        if m[3] and (attributes.count('"') % 2 or attributes.count("'") % 2):
            k = m.end()
            while k < len(source) and source[k] != ">":
                if source[k] in last:
                    if last[source[k]] <= k:  # never closed
                        k = len(source)
                        break
                    k = source.index(source[k], k + 1)
                k += 1
            if k < len(source):
                end, attributes = k, source[m.end() : k]
        at = min(end + 1, len(source))
        moved = yield m.start(), at, m[3], bool(m[2]), attributes
        if moved is not None:
            at = moved
            yield at, at, None, False, ""


def named(value: str) -> bool:
    """Whether a class or id has a token that names something other than the article."""
    for token in value.split():
        words = [w for w in WORDS.findall(token) if not w.isdigit()]
        if token in NAMES or not NAMES.isdisjoint(words) and all(w in NAMES or w in BESIDE or len(w) == 1 for w in words):
            return True
    return False


class Page:
    """Elements in page order (0 is the page), and the texts and block borders between them."""

    def __init__(self, source: str):
        self.tag, self.parent, self.attributes = ["html"], [-1], [""]
        self.items: list[tuple[int, str | None]] = []  # (element, text); None is a block border
        parts: list[list[int]] = [[]]
        self.hash = [0]
        stack, at = [0], 0
        spots: dict[str, list[int]] = {}  # places in the stack of the open elements of each name
        barriers = [0]

        def leave(k):
            for x in reversed(stack[k:]):
                self.hash[x] = hash((xxhash.xxh64_intdigest(self.tag[x]), *parts[x]))
                if x:
                    parts[self.parent[x]].append(self.hash[x])
                    spots[self.tag[x]].pop()
                    if self.tag[x] in BARRIER:
                        barriers.pop()
                if self.tag[x] in BLOCK:
                    self.items.append((self.parent[x], None))
            del stack[k:]

        def nearest(names):
            return max((spots[n][-1] for n in names if spots.get(n)), default=0)

        def text(t):
            if t:
                self.items.append((stack[-1], html.unescape(t) if "&" in t else t))
                parts[stack[-1]].append(xxhash.xxh64_intdigest(" ".join(t.split())))

        markup = tags(source)
        for start, end, name, closes, attributes in markup:
            text(source[at:start])
            at = end
            if name is None:
                continue
            name = name.lower()
            if closes:
                if k := nearest((name,)):
                    leave(k)
                continue
            if name in ENDS_P or name in ITSELF:
                k = nearest((*(("p",) if name in ENDS_P else ()), *(SAME.get(name, (name,)) if name in ITSELF else ())))
                if k and k >= max(barriers[-1], nearest(ITSELF.get(name, ()))):
                    leave(k)
            node = len(self.tag)
            self.tag.append(name)
            self.parent.append(stack[-1])
            self.attributes.append(attributes)
            self.hash.append(0)
            parts.append([])
            if name in BLOCK:
                self.items.append((stack[-1], None))
            if name == "br":
                self.items.append((stack[-1], " "))
            if name in VOID or attributes.endswith("/") and name in ("svg", "path"):
                parts[stack[-1]].append(xxhash.xxh64_intdigest(name))
                continue
            spots.setdefault(name, []).append(len(stack))
            if name in BARRIER:
                barriers.append(len(stack))
            stack.append(node)
            if name in RAW:
                close = re.compile(rf"</{re.escape(name)}\b", re.I).search(source, at)
                markup.send(close.start() if close else len(source))
                text(source[at : close.start() if close else len(source)])
                at = close.start() if close else len(source)
        text(source[at:])
        leave(0)
        self.dropped = self.by_page()
        self.mains = self.find_main()

    def by_page(self) -> list[bool]:
        """Whether an element is no text of the article by its tag, role or class; notes which are headers."""
        out, by_name = [], []
        self.header: list[bool] = []
        for k, (tag, attributes) in enumerate(zip(self.tag, self.attributes, strict=True)):
            drop = tag in DROP
            header = tag == "header"
            if attributes and not drop and tag not in ("html", "body", "main"):
                for m in ATTRIBUTE.finditer(attributes):
                    name, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
                    if name in ("class", "id"):
                        words = WORDS.findall(value)
                        if not drop and named(value) and (tag != "article" or not OTHERS.isdisjoint(words)):
                            drop = True
                            if COMMENTS.isdisjoint(words):
                                by_name.append(k)
                        header = header or tag in ("div", "section") and not HEADER.isdisjoint(words)
                    else:
                        drop = drop or name == "hidden" or name == "role" and value in ROLES or name == "aria-hidden" and value == "true" or name == "style" and bool(HIDDEN.search(value))
            out.append(drop or header)
            self.header.append(header)
        if by_name:  # a name such as with-sidebar on what holds most of the page tells of something in it
            size, held = [0] * len(out), [0] * len(out)
            for k, t in self.items:
                if t and self.tag[k] not in ("a", "script", "style", "title"):
                    size[k] += len(t.strip())
            for k in range(len(out) - 1, 0, -1):
                size[self.parent[k]] += size[k]
                held[self.parent[k]] += held[k] + (3 if self.tag[k] in ("article", "main") else self.tag[k] == "p")
            for k in by_name:
                if held[k] >= 3 and 2 * size[k] >= size[0]:
                    out[k] = False
        return out

    def weights(self, prose: bool = False) -> list[int]:
        """Characters of text in an element that no element within it drops; links don't count, and with prose only what stands in prose."""
        n = [0] * len(self.tag)
        told = [False] * len(n)
        for k in range(1, len(n)):
            told[k] = told[self.parent[k]] or self.tag[k] in PROSE
        for k, t in self.items:
            if t and self.tag[k] != "a" and (told[k] or not prose):
                n[k] += len(t.strip())
        for k in range(len(n) - 1, 0, -1):
            if not self.dropped[k]:
                n[self.parent[k]] += n[k]
        return n

    def find_main(self) -> set[int]:
        """The articles that are in no other one, the main elements, the elements called so, or the smallest that holds all prose.

        Of elements called so by class or id the largest counts, and those of the same class. What leads to
        the first of them from beside it is one of them: headings and paragraphs before it in the main
        element around it; where there is none, a heading of the first rank.
        """
        n = self.weights()

        within = [False] * len(n)  # whether something around an element drops it
        for k in range(1, len(n)):
            up = self.parent[k]
            within[k] = within[up] or up > 0 and self.dropped[up] and not self.header[up]

        role = lambda k: any(m[1].lower() == "role" and (m[2] or "").strip("\"'").lower() in ("main", "article") for m in ATTRIBUTE.finditer(self.attributes[k]))
        called = lambda k: self.tag[k] in ("div", "section") and any(m[1].lower() in ("class", "id") and not MAIN.isdisjoint(WORDS.findall((m[2] or "").lower())) for m in ATTRIBUTE.finditer(self.attributes[k]))
        for is_main in (lambda k: self.tag[k] == "article", lambda k: self.tag[k] == "main" or role(k), called):
            found = [k for k in range(1, len(n)) if is_main(k) and n[k] and not self.dropped[k] and not within[k]]
            if found and is_main is called:
                largest = max(found, key=lambda k: (n[k], -k))
                found = [k for k in found if k == largest or self.tag[k] == self.tag[largest] and self.attributes[k] == self.attributes[largest]]
            if found:
                held = [False] * len(n)  # whether one of found is around an element
                own = set(found)
                for k in range(1, len(n)):
                    held[k] = held[self.parent[k]] or self.parent[k] in own
                own = {k for k in found if not held[k]}
                return own | self.leads(own, within)
        best, told = 0, self.weights(prose=True)
        told = told if told[0] else n
        for k in range(1, len(n)):
            if self.parent[k] == best and not self.dropped[k] and self.tag[k] not in PROSE and told[k] == told[best] > 0:
                best = k
        return {best}

    def leads(self, mains: set[int], within: list[bool]) -> set[int]:
        """What leads to the first main element from beside it or beside what holds it."""
        first, around = min(mains), set()
        k = self.parent[first]
        while k >= 0:
            around.add(k)
            k = self.parent[k]
        inside = any(self.tag[k] == "main" for k in around)
        top = max((k for k in around if self.tag[k] == "main"), default=0)
        found = (k for k in range(1, first) if self.parent[k] in around and not self.dropped[k] and not within[k])
        return {k for k in found if (self.tag[k] in LEAD and self.parent[k] >= top if inside else self.tag[k] == "h1")}

    def around(self) -> set[int]:
        """The main elements and all that hold one."""
        out: set[int] = set()
        for k in self.mains:
            while k >= 0 and k not in out:
                out.add(k)
                k = self.parent[k]
        return out

    def subtrees(self) -> list[int]:
        """Elements that may be template: containers, but none that holds the main element, nor prose inside it."""
        around, within = self.around(), [False] * len(self.tag)
        article = all(self.tag[k] in ("article", "main") for k in self.mains)
        out = []
        for k in range(1, len(self.tag)):
            within[k] = within[self.parent[k]] or self.parent[k] in self.mains
            if self.tag[k] in CONTAINER and k not in around and not (within[k] and (article and self.tag[k] in PROSE or self.tag[k] == "p" and article)):
                out.append(k)
        return out

    def text(self, template: set[int] = frozenset()) -> str:
        """The blocks of the main element without what is dropped and the elements of template."""
        around = self.around()
        out = [False] * len(self.tag)  # whether an element's own text is left out
        only_header = [False] * len(self.tag)  # because of a header in the article alone, whose headings stay
        outside = [True] * len(self.tag)
        for k in self.mains:
            outside[k] = False
        for k in range(1, len(self.tag)):
            up = self.parent[k]
            outside[k] = k not in self.mains and outside[up]
            if k in around:
                continue
            own = k in template or self.dropped[k] and not self.header[k]
            free = not out[up] or only_header[up]
            if free and not own and HEADING.match(self.tag[k]):
                continue
            out[k] = out[up] or own or self.header[k]
            only_header[k] = free and not own and out[k]
        blocks, now = [], []
        for k, t in self.items:
            if t is None:
                if now:
                    blocks.append("".join(now))
                    now = []
            elif not outside[k] and not out[k]:
                now.append(t)
        blocks.append("".join(now))
        return "\n".join(filter(None, (" ".join(b.split()) for b in blocks)))


def key(host: str, subtree: int) -> int:
    """A template's number: of the host and the subtree's hash."""
    return hash((xxhash.xxh64_intdigest(host), subtree))


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (host, html): a subtree's number and its page's main text's digest."""
    for batch in batches:
        keys, prints = [], []
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if source:
                page = Page(source)
                digest = xxhash.xxh64_intdigest(page.text()) - (1 << 63)
                for h in {page.hash[k] for k in page.subtrees()}:
                    keys.append(key(host, h))
                    prints.append(digest)
        yield pa.record_batch([pa.array(keys, pa.int64()), pa.array(prints, pa.int64())], ["key", "print"])


def _texts(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Of rows (id, url, host, html, own templates or null): id, url, text."""
    known = None if shared is None else shared.value
    for batch in batches:
        texts = []
        for host, source, own in zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True):
            if not source:
                texts.append("")
                continue
            page = Page(source)
            may = page.subtrees()
            keys = [key(host, page.hash[k]) for k in may]
            if known is None:
                mine = set(own or ())
                hit = [x in mine for x in keys]
            else:
                at = np.minimum(np.searchsorted(known, keys), max(0, len(known) - 1))
                hit = (known[at] == keys).tolist() if len(known) else [False] * len(keys)
            texts.append(page.text({k for k, x in zip(may, hit, strict=True) if x}))
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["id", "url", "text"])


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html", least: int = PAGES, most: int = BROADCAST) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of pages.

    Blocks of the article, white space in each joined, by one line feed. <br> is white space. A
    null or empty page has an empty text; a url without a host shares its templates with the
    others without one. Broken markup is read as far as it goes. Repeated rows and null ids get
    rows of their own; other columns are not carried; an empty table gives an empty result.
    """
    host, _ = url_parts(F.col("url"))
    raw = pages.select(F.col(page_id).alias("id"), F.col(url).alias("url"), F.col(source).alias("html")).select("id", "url", host.alias("host"), "html")
    seen = in_batches(raw.select("host", "html"), _subtrees, "key long, print long")
    templates = durable(seen.distinct().groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= least))
    schema = f"id {dict(raw.dtypes)['id']}, url {dict(raw.dtypes)['url']}, text string"
    if templates.count() <= most:
        known = np.sort(np.asarray(templates.select("key").toArrow()["key"].combine_chunks()))  # bounded by the count
        shared = pages.sparkSession.sparkContext.broadcast(known)
        out = in_batches(raw.withColumn("own", F.lit(None).cast("array<long>")), lambda it: _texts(it, shared), schema)
    else:
        marked = raw.withColumn("page", F.xxhash64("host", "html"))
        seen = in_batches(marked.select("page", "host", "html"), _page_keys, "page long, key long").distinct()
        per_page = meet(seen, templates, ["key"], "n").where("n is not null").groupBy("page").agg(F.collect_list("key").alias("own"))
        out = in_batches(marked.join(per_page, "page", "left").select("id", "url", "host", "html", "own"), lambda it: _texts(it, None), schema)
    return out.select(F.col("id").alias(page_id), F.col("url").alias(url), "text", F.length("text").cast("long").alias("n_chars"))


def _page_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pages, keys = [], []
        for number, host, source in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            page = Page(source or "")
            for k in page.subtrees():
                pages.append(number)
                keys.append(key(host, page.hash[k]))
        yield pa.record_batch([pa.array(pages, pa.int64()), pa.array(keys, pa.int64())], ["page", "key"])


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages"))

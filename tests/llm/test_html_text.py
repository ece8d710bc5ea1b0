import html
import re
import time

from cantolith.llm import html_text as H


def test_query_gives_exactly_the_article(spark):
    d = "/root/testdata/sf0.01"
    src = {r.page_id: r for r in spark.read.parquet(f"{d}/pages.parquet").collect()}
    out = H.op2_html_text(spark, d).collect()
    assert len(out) == len(src)
    for r in out:
        inner = re.search(r"<article>(.*)</article>", src[r.page_id].html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"</?b>|<br>", " " if "br" in x else "", x)).replace("<br>", " ").split()) for x in re.split(r"</?(?:p|h1)>", re.sub(r"<br>", " ", re.sub(r"</?b>", "", inner))))
        assert r.text == "\n".join(filter(None, blocks)) and r.n_chars == len(r.text) and r.url == src[r.page_id].url


def page(body, extra=""):
    return f"<html><head><title>T</title></head><body>{body}{extra}</body></html>"


def test_page_rules():
    cases = [
        (page("<header>Site</header><main><h1>A &amp; B</h1><p>One<br>two<p>Three <b>bold</b><ul><li>x<li>y</ul></main><footer>f</footer>"), "A & B\nOne two\nThree bold\nx\ny"),
        (page('<div id="content"><p>Text here</p><div class="share-buttons">Share</div></div><div class="comments"><p>Me first!</p></div>'), "Text here"),
        (page('<article><header><h1>T</h1><span>By me</span></header><p>P</p><aside>no</aside><form>f</form><section id="comments"><article>c</article></section></article>'), "T\nP"),
        (page('<nav>m</nav><div><div><p>Only the text, long enough</p><p>More</p></div></div><div class="ad">Buy</div><script>if(a<b)"</p>"</script>'), "Only the text, long enough\nMore"),
        ("<p>no body", "no body"),
        ("plain &lt;text&gt; &#x41;&nbsp;b", "plain <text> A b"),
        ("", ""),
        ("<", "<"),
        ("<article><p>a<!-- x --><p hidden>h</p><p style='display:none'>h</p>", "a"),
        ("<article>a<div>b</div>c</article>", "a\nb\nc"),
        ("<article><p title='a>b'>q</p><p title=\"un>closed>r</p>", "q\nclosed>r"),
        (page('<div class="header">Site</div><p>One</p><p>Two</p><div class="footer">f</div>'), "One\nTwo"),
        (page('<article><div class="entry-header"><div><h1>T <em>x</em></h1></div><p>by</p></div><p>P</p></article>'), "T x\nP"),
        (page('<div id="wrap"><div id="sidebar"><ul><li>a</li></ul></div><div class="main-content"><h2>H</h2><p>Body &mdash; text</p><div class="cookie-notice">c</div><ul class="comment-list"><li>nice</li></ul></div></div>'), "H\nBody — text"),
        (page('<div role="banner">b</div><div role="main"><p>q</p><div role="alert">n</div></div><div role="contentinfo">c</div>'), "q"),
        (page("<article><h1>A</h1><p>x</p><blockquote>q</blockquote><pre>a  b</pre><figure><img><figcaption>cap</figcaption></figure></article>"), "A\nx\nq\na b\ncap"),
        (page('<div class="layout with-sidebar"><article><p>Long enough to be most of it</p></article><div class="sidebar">s</div></div>'), "Long enough to be most of it"),
        (page('<article class="post"><p>Short</p><section class="comments"><p>A long comment</p><p>another one</p><p>and a third of them</p></section></article>'), "Short"),
        (page("<article><p>First</p></article><article><p>The second and longer one</p></article>"), "First\nThe second and longer one"),
        (page('<article><section class="related-work"><p>Earlier work</p></section><p class="share-price">12.50</p><p>It is <math><mi>x</mi></math>.</p></article>'), "Earlier work\n12.50\nIt is x."),
        (page('<article><p>P</p><div class="related-posts">r</div><div class="social-share-buttons">s</div><div class="post__comments">c</div><p id="legal-text">l</p></article>'), "P"),
        (page('<main><p>One</p></main><div>not main</div><div role="main"><p>Two</p></div>'), "One\nTwo"),
        ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a\nb\nc"),
    ]
    for source, want in cases:
        assert H.Page(source).text() == want, (source, H.Page(source).text())


def test_nothing_of_the_article_is_lost():
    """Text that stands beside the largest block, in several blocks, or under a class that tells of something else."""
    long = "A long text that holds nearly all the characters of the page. " * 10
    cases = [
        (page(f"<h1>Title</h1><p>Lead.</p><div>{long}</div><p>Last.</p>"), f"Title\nLead.\n{long.strip()}\nLast."),
        (page('<div class="entry-content"><p>One</p></div><div class="ad">Buy</div><div class="entry-content"><p>And two</p></div>'), "One\nAnd two"),
        (page('<header><h1>Site</h1></header><div><h1>Title</h1><div class="post-content"><p>P</p></div></div>'), "Title\nP"),
        (page("<main><h2>Part</h2><p>Intro.</p><nav>n</nav><article><p>P</p></article></main>"), "Part\nIntro.\nP"),
        (page("<p>Before</p><h1>Title</h1><article><p>P</p></article><h1>After</h1>"), "Title\nP"),
        (page('<article class="search"><p>How to search</p></article>'), "How to search"),
        (page('<article><p>P</p></article><article class="comment"><p>c</p></article><article class="related-posts"><p>r</p></article>'), "P"),
        (page('<div class="story"><p>The story itself, which is long</p></div><div class="story teaser"><p>Other</p></div>'), "The story itself, which is long"),
        (page('<ul><li><a href="/">Home</a></li><li><a href="/x">More</a></li></ul><div><p>One</p><div><p>Two</p></div></div>'), "One\nTwo"),
    ]
    for source, want in cases:
        assert H.Page(source).text() == want, (source, H.Page(source).text())


def test_pages_without_article_tags_give_the_same_text(spark):
    """The fixture's pages with their article as a plain div: nothing names it, its text stays as it was."""
    rows = [r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("html").collect()]
    same = 0
    for source in rows:
        with_tags, without = H.Page(source).text(), H.Page(source.replace("<article>", "<div>").replace("</article>", "</div>")).text()
        assert set(with_tags.split("\n")) <= set(without.split("\n"))
        same += with_tags == without
    assert same >= 0.9 * len(rows), (same, len(rows))


def test_templates_of_a_host_go_and_copies_stay(spark):
    box = "<div class=x1><span>Buy our things now</span></div>"
    rows = [(k, f"http://h.org/{k}", page(f"<div><p>Page {k} has a text of its own, number {k}</p><p>and a second line {k}</p>{box}</div>")) for k in range(12)]
    rows += [(100 + k, f"http://g.org/{k}", page(f"<div><p>Other {k} text that is quite long here</p>{box}</div>")) for k in range(2)]
    rows += [(200 + k, f"http://c.org/{k}", page("<div><p>The same page</p><div>many times</div></div>")) for k in range(20)]
    rows += [(300, None, None), (301, "", ""), (None, "x", "<p>t</p>"), (302, "http://h.org/z", "<p>" * 3000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS host")
    for most in (H.BROADCAST, 0):
        got = {r.page_id: r.text for r in H.extract(df, most=most).collect()}
        assert len(got) == len(rows)
        assert all(got[k] == f"Page {k} has a text of its own, number {k}\nand a second line {k}" for k in range(12))
        assert all(got[100 + k].endswith("Buy our things now") for k in range(2))
        assert all(got[200 + k] == "The same page\nmany times" for k in range(20))
        assert got[300] == got[301] == got[302] == "" and got[None] == "t"
    assert H.extract(df.limit(0)).count() == 0


def test_broken_markup_takes_linear_time():
    for source in ("<div><b>" * 60_000 + "</i>" * 60_000, "<a href=\"x>'y " * 60_000, "<p><button>" + "<b>" * 60_000 + "<hr>" * 60_000, "<i>" + "<b>" * 60_000 + "<li>" * 60_000, "<" * 300_000):
        began = time.perf_counter()
        H.Page(source).text()
        assert time.perf_counter() - began < 4, source[:20]

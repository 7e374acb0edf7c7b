"""Wrappers of hosts, and the main text of pages against what their makers put in."""

import re
from html import unescape

from tarmac.llm import wrappers
from tarmac.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def blocks_by_hand(html):
    """The article's blocks by plain cuts, for the given pages' simple markup."""
    article = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    parts = re.split(r"</?(?:p|h1)>", article)
    texts = [" ".join(unescape(re.sub(r"<[^>]*>", " " , p)).split()) for p in parts]
    return "\n".join(t for t in texts if t)


def test_main_text_of_the_given_pages(spark):
    html = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    rows = QUERIES["op6_wrapper_extraction"](spark, FOLDER).collect()
    assert len(rows) == len(html)
    for r in rows:
        assert r.text == blocks_by_hand(html[r.page_id]) and r.n_chars == len(r.text)


HEAD = "<html><head><title>T</title><style>p{}</style><script>var a='<p>x</p>'</script></head><body>"
RICH = [
    (
        1,
        "http://Site.example:80/1",
        HEAD + "<header class='site'>Top</header><div id='main-nav'><a href=/>Home</a></div>"
        "<div class=cookieNotice>We use cookies</div><main><article class='post has-ads'>"
        "<h1>Title &amp; more</h1><p>First  <b>bold</b>er\n line<br>next<p>Second"
        "<ul><li>one<li>two</ul><aside>Side</aside><div class='ad-slot'>Buy</div>"
        "<form><p>Mail</p><input></form><!-- gone <p>no</p> --><pre>a  b</pre>"
        "<section class='comments'><article class=comment><p>Nice!</p></article></section>"
        "</article></main><div class=sidebar><p>Links</p></div><footer>End</footer></body></html>",
        "Title & more\nFirst bolder line next\nSecond\none\ntwo\na b",
    ),
    (
        2,
        "http://site.example/2",
        HEAD + "<main><article class='post has-ads'><h1>Other</h1><p>Only</p></article></main>"
        "<section id=comments><article><p>Reader</p></article></section><footer>End</footer>",
        "Other\nOnly",
    ),
    (
        3,
        "https://plain.example/",
        "<div class=menu><a href=/>A</a></div><div><p>Plain text without article.</p>"
        "<p>More of it</p></div><ul><li><a href=/x>Link one</a></li></ul><div class=footer>Z</div>",
        "Plain text without article.\nMore of it",
    ),
    (4, None, None, ""),
    (5, "", "", ""),
    (None, "http://site.example/3", "<p>stray < text & more", "stray < text & more"),
    (6, "http://deep.example/", "<main>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "end", "deep\nend"),
    (7, "http://long.example/", "<main>" + "<p>word</p>" * 30_000, "\n".join(["word"] * 30_000)),
]


def frame(spark, rows):
    return spark.createDataFrame(
        [r[:3] for r in rows], "page_id long, url string, html string"
    ).selectExpr("*", "'x' as host", "'y' as main", "1 as text", "2 as pages")


def test_main_text_of_awkward_pages(spark):
    rows = RICH + [RICH[0]]
    got = wrappers.extract(frame(spark, rows)).collect()
    want = sorted((r[0] or 0, r[3]) for r in rows)
    assert sorted((r.page_id or 0, r.text) for r in got) == want
    assert all(r.n_chars == len(r.text) for r in got)
    assert wrappers.extract(frame(spark, RICH).limit(0)).count() == 0


def test_alignment_in_parts_gives_the_same_text(spark):
    pages = frame(spark, RICH)
    whole = wrappers.extract(pages, wrappers.infer(pages)).collect()
    parts = wrappers.extract(pages, wrappers.infer(pages, patterns_a_task=1)).collect()
    assert sorted(map(str, whole)) == sorted(map(str, parts))


def wrapped(*pages):
    out = None
    for html in pages:
        one = wrappers.pattern(wrappers.Page(html).root)
        out = one if out is None else wrappers.aligned(out, one)
    return wrappers.expression(out)


def test_mismatches_become_optional_and_repeated_groups():
    assert wrapped("<ul><li>a<li>b<li>c</ul>") == "<ul>(<li>TEXT</li>)+</ul>"
    assert wrapped("<h2>a</h2><p>b</p><h2>c</h2><p>d</p><h2>e</h2><p>f</p>") == (
        "(<h2>TEXT</h2> <p>TEXT</p>)+"
    )
    assert wrapped("<p>a</p><hr><div>b</div>", "<div>b</div>") == "(<p>TEXT</p>)? <div>TEXT</div>"
    assert wrapped("<p>a</p>", "<p>a</p><p>b</p>", "<h1>t</h1><p>c</p>") == (
        "(<h1>TEXT</h1>)? (<p>TEXT</p>)+"
    )
    assert wrapped("<div></div>", "<div>x</div>") == "<div>(TEXT)?</div>"

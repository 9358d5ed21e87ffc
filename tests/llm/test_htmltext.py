from __future__ import annotations

import html
import re
import time

from plumbline.llm import htmltext, queries

PAGE = """<html><head><title>T</title></head><body class="has-sidebar"><header class="site"><h1>Site</h1></header>
<div class="cookie-notice">We use cookies</div><nav><a href=x>Menu</a></nav>
<div id="wrap"><div class="content-12"><h2>Title &amp; more</h2><p>Some long text here, with <a href=x>a link</a> in it.
<p>More   text follows&nbsp;now &lt;b&gt;<script>var t="</p>";</script>.</p><form><input>Search</form>
<div class="comments"><p>I liked this very much, and here is my comment that is longer than the article itself, honestly.</p></div></div>
<div class="sidebar"><p>Side text</p></div></div><footer>Foot</footer></body></html>"""


def test_article_only():
    assert htmltext.extract(PAGE, None) == "Title & more Some long text here, with a link in it. More text follows now <b>."


def test_odd_pages():
    assert htmltext.extract("", None) == "" and htmltext.extract("<p>", None) == ""
    assert htmltext.extract("plain < text & more", None) == "plain < text & more"
    assert htmltext.extract("<!-- open <p>gone", None) == ""
    assert htmltext.extract("<article><p>one<br>two</b> three<p title='>'>four</article><p>outside", None) == "one two three four"
    assert htmltext.extract("<ARTICLE><P>up&#x41;per&eacute;</P></ARTICLE>", None) == "upAperé"
    assert htmltext.extract("<nav><a>never closed</a><article><p>the text</p></article>", None) == "the text"
    assert htmltext.extract("<div>" * 3000 + "deep text" + "</div>" * 10, None) == "deep text"
    assert len(htmltext.extract("<article><p>" + "word " * 200_000 + "</p></article>", None)) == 999_999


LONG = "A sentence of running text that goes on for a while, as articles do. " * 3


def test_nothing_of_an_article_is_dropped():
    assert htmltext.extract("<article><p>We prove <math>x=2</math> here</article>", None) == "We prove x=2 here"
    assert htmltext.extract("<article><p>one<xmp><b>&amp;</b></xmp>two</article>", None) == "one <b>&amp;</b> two"
    assert htmltext.extract("<article><p>one<svg><text>x</text><p>two<svg/>three</article>", None) == "one two three"
    related = f"<article><p>{LONG}</p><div class='related-work'><p>{LONG * 3}</p></div><div class='share'><a href=x>{LONG}</a></div><div class=related><a href=y>see also</a></div></article>"
    assert htmltext.extract(related, None) == " ".join((LONG * 4).split())


def test_pages_without_an_article():
    page = f"<body><div class=top>Logo</div><div class=wrap><div class=post><div class=lead><p>{LONG}</p></div><div class='body a b c d'><p>{LONG * 4}</p><p>{LONG}</p></div><div class=comments><p>{LONG}</p></div></div><div class=side-3><a href=x>{LONG}</a></div></div><div class=footer>{LONG}</div></body>"
    assert htmltext.extract(page, None) == " ".join((LONG * 6).split())
    table = f"<body><table><tr><td><a href=x>menu</a><td><p>{LONG}<td><a href=y>more</a></table>"
    assert htmltext.extract(table, None).startswith("A sentence")


def test_length_decides_nothing():
    for n in (1, 2, 5, 20, 60, 95, 99, 100, 101, 399, 400, 401, 2000):
        words = ("lead text " * 200)[:n].strip()
        for lead in (f"<div class=lead>{words}</div>", f"<div class=lead><p>{words}</p></div>"):
            page = f"<body><div class=post>{lead}<div class=body><p>{LONG * 4}</p></div></div><div class=footer>foot</div></body>"
            assert htmltext.extract(page, None) == f"{words} {' '.join((LONG * 4).split())}", n
        inside = lambda c, more="": htmltext.extract(f"<article><p>{LONG}</p><div class='{c}'>{more or f'<p>{words}</p>'}</div></article>", None)  # noqa: B023, E731
        assert inside("related-work") == f"{LONG.strip()} {words}"
        assert inside("notice") == LONG.strip() and inside("share", f"<a href=x>{words}</a>") == LONG.strip()
        # a heading of the article, whatever its length
        assert htmltext.extract(f"<body><div id=a><h1>{words}</h1><div class=text><p>{LONG}</p></div></div></body>", None) == f"{words} {LONG.strip()}"
    # links around an article aren't it, whatever there is of them
    for k in (1, 50):
        links = f"<div class=more>{'<a href=x>another page</a> ' * k}</div>"
        assert htmltext.extract(f"<body><div id=a>{links}<div class=text><p>{LONG}</p></div>{links}</div></body>", None) == LONG.strip()


def test_more_classes_than_three_tell_paths_apart():
    page = htmltext.parse("<div class='a b c d'><p>x</p></div><div class='a b c e'><p>y</p></div>")
    assert len({e.path for e in page.elements if e.tag == "div"}) == 2


def test_hostile_pages_take_linear_time():
    n = 1 << 20
    parts = ('<a "', "<a '", "<div>", "</b>", "<b>", "<p>", "<b><p>", "<", "<!--", "<svg>", "<li><b>", "<div></i>", '<a ">" ', "<i><h2>")
    for part in parts:
        start = time.process_time()
        htmltext.extract("<div><b>" + part * (n // len(part)), None)
        htmltext.extract(part * (n // len(part)) + "'>", None)
        assert time.process_time() - start < 30, part
    start = time.process_time()
    htmltext.extract("<div>" * 50_000 + "</p>" * 100_000 + "<h2></h2>" * 50_000, None)
    assert time.process_time() - start < 15


def test_host_votes_decide(spark):
    page = "<body><div class='post-{}'><p>{}</p></div><div class='box'><p>{}</p></div></body>"
    rows = [(i, f"http://A.example/{i}", page.format(i, "article text " * 9, "short note")) for i in range(5)]
    # on its own this page would be read from the box
    rows.append((9, "http://a.example/9", page.format(9, "article text " * 4, "a much longer note than usual " * 3)))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in htmltext.extract_pages(df).collect()}
    assert got[9] == ("article text " * 4).strip() and got[0] == ("article text " * 9).strip()
    assert htmltext.extract(rows[-1][2], None) != got[9]


def test_edges(spark):
    rows = [(1, None, None, 1), (2, "x", "", 1), (3, "http://h/", "<p>a</p>", 1), (3, "http://h/", "<p>a</p>", 1), (None, "http://h/", "<p>b</p>", 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host int")
    got = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in htmltext.extract_pages(df).collect()), key=repr)
    assert got == sorted([(1, "", 0), (2, "", 0), (3, "a", 1), (3, "a", 1), (None, "b", 1)], key=repr)
    assert htmltext.extract_pages(df.limit(0)).count() == 0


def test_query(spark, sf):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = queries.op9_html(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        inside = re.search(r"<article>(.*)</article>", pages[r["page_id"]], re.S)[1]
        inside = re.sub(r"</?(?:b|a|i|em|strong)\b[^>]*>", "", inside)
        assert r["text"] == " ".join(html.unescape(re.sub(r"<[^>]+>", " ", inside)).split()) and r["n_chars"] == len(r["text"])

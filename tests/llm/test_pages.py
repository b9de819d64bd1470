"""URL verdicts and main texts of pages."""

from __future__ import annotations

import html
import re

import pytest

from tickloom.llm import html_extract, queries, url_filter


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, verdict string")


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if c.isascii() else c for c in host), path


def rule_of(host, path):
    fit = []
    for said, rule in url_filter.RULES:
        of_host, slash, of_path = rule.partition("/")
        if (host == of_host or host.endswith("." + of_host)) and path.startswith(slash + of_path):
            fit.append((len(rule), rule, said))
    return max(fit)[1:] if fit else (None, None)


def test_urls_against_brute_force(spark, sf_dir):
    rows = {r["page_id"]: r for r in queries.op9_url_filter(spark, sf_dir).collect()}
    for p in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        r = rows[p["page_id"]]
        assert (r["host"], r["path"]) == split(p["url"])
        rule, said = rule_of(r["host"], r["path"])
        assert r["rule"] == rule and r["verdict"] in ("allow", "block") and (said is None or said == r["verdict"])


ODD = [None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG", "x://a.org?q=/", "http://Example.org/es/1#/en", "http://sub.example.org/en/12?x", "http://notexample.com/de/", "http://É.COM/fr/a\nb", "http://a.com/fr"]


def test_odd_urls(spark):
    rows = [(k, u, None, "clash", "clash") for k, u in enumerate(ODD)]
    got = {r["page_id"]: r for r in url_filter.judge(pages_of(spark, rows)).collect()}
    for k, u in enumerate(ODD):
        assert (got[k]["host"], got[k]["path"]) == split(u)
        assert got[k]["rule"] == rule_of(*split(u))[0]
    assert url_filter.judge(pages_of(spark, [])).count() == 0
    only_rejected = url_filter.judge(pages_of(spark, [(1, "http://a.com/de/1", None, "", ""), (2, "http://b.net/", None, "", "")])).collect()
    assert {r["verdict"] for r in only_rejected} == {"block"}


def test_method_learns_rejected_hosts(spark):
    rows = [(k, f"http://news{k}.org/story/{k}", None, "", "") for k in range(200)] + [(1000 + k, f"http://spam{k}.com/de/win-cash-{k}", None, "", "") for k in range(200)]
    rows += [(5000, "http://news7.net/story/9", None, "", ""), (5001, "http://spam7.net/win-cash-9", None, "", "")]
    got = {r["page_id"]: r["verdict"] for r in url_filter.judge(pages_of(spark, rows)).collect()}
    assert (got[5000], got[5001]) == ("allow", "block")


def article_of(page: str) -> str:
    inner = re.search(r"<article>(.*?)(?:</article>|\Z)", page, re.S)[1]
    inner = re.sub(r"</?b>", "", inner.replace("<br>", " "))
    blocks = (re.sub(r"\s+", " ", html.unescape(x)).strip() for x in re.split(r"</?(?:p|h1)>", inner))
    return "\n".join(b for b in blocks if b)


def test_pages_against_plain_article(spark, sf_dir):
    rows = {r["page_id"]: r for r in queries.op10_html_extraction(spark, sf_dir).collect()}
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    assert len(rows) == len(pages)
    for p in pages:
        text = article_of(p["html"])
        assert (rows[p["page_id"]]["text"], rows[p["page_id"]]["n_chars"], rows[p["page_id"]]["url"]) == (text, len(text), p["url"])


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body class="nav-open">
<header>Site <a href=/>home</a></header><nav><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav>
<div class="cookie-notice">We use cookies</div><div class="layout"><div class="content-12"><h1>Big &amp; small</h1>
<p>First   part<br>goes &lt;on&gt; <i>and</i> on <span class="ad">buy now</span> to its end&nbsp;here.<p>Second part, which is never closed, is as long as the first one
<ul><li>one<li>two</ul><script>if (a < b) { document.write("<p>no</p>") }</script><form><p>Your mail</p></form></div>
<aside><p>Side text which is long enough to look like an article, but it is not part of one at all.</p></aside></div>
<div id="comments"><p>A reader wrote a very long comment which goes on and on and on, longer than all the rest of this page put together, because readers do that sometimes, and they never stop at all.</p></div>
<footer>&copy; us</footer></body></html>"""
TEXT = "Big & small\nFirst part goes <on> and on to its end here.\nSecond part, which is never closed, is as long as the first one\none\ntwo"


def test_general_page_and_host_consensus(spark):
    # On the third page the side text is longest, but the host's other pages vote for the content.
    odd = PAGE.replace("look like", "look " + "very " * 60 + "like").replace("<aside>", '<div class="more">').replace("</aside>", "</div>")
    rows = [(1, "http://h.example/1", PAGE, "", ""), (2, "http://h.example/2", PAGE, "", ""), (3, "http://h.example/3", odd, "", "")]
    rows += [(4, None, None, "", ""), (5, "http://h.example/5", "", "", ""), (6, "http://h.example/6", "just  text &amp; more", "", ""), (7, "http://h.example/7", "<div><p>cut off <a href='x", "", ""), (1, "http://h.example/1", PAGE, "", "")]
    got = {r["page_id"]: r["text"] for r in html_extract.extract(pages_of(spark, rows)).collect()}
    assert got[1] == got[2] == got[3] == TEXT
    assert (got[4], got[5], got[6], got[7]) == ("", "", "just text & more", "cut off")
    assert html_extract.extract(pages_of(spark, rows)).count() == len(rows)
    assert html_extract.extract(pages_of(spark, [])).count() == 0


@pytest.mark.parametrize("hosts", [0, 10])
def test_winners_by_join_or_broadcast(spark, hosts):
    rows = [(1, "http://h.example/1", PAGE, "", "")]
    assert html_extract.extract(pages_of(spark, rows), broadcast_hosts=hosts).first()["text"] == TEXT


def main_text(page: str) -> str:
    parsed = html_extract.parse(page)
    return html_extract.text_of(parsed, html_extract.best_path(parsed))


LONG = "<p>A first paragraph of the article, which is long enough to be its main text.</p>"
KEPT = [
    ("<h2 id='Related_work'>Related work</h2>", "Related work"),
    ("<section id='social-history'><h2>Social history</h2><p>Of the town.</p></section>", "Social history\nOf the town."),
    ("<section id='comments'><h2>Comments</h2><p>On the law.</p></section>", "Comments\nOn the law."),
    ("<div class='post-header'><h1>Title</h1></div>", "Title"),
    ("<div class='header'><h1>Title</h1></div>", "Title"),
    ("<p class='alert'>Take care.</p>", "Take care."),
    ("<p>The <span id='form'>form</span> is</p>", "The form is"),
    ("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be</p>", "Let x=1 be"),
    ("<p>Let <math><mi>x</mi> be</p><p>More</p>", "Let x be\nMore"),
    ("<div class='ad'><p>Buy now</p></div><ul class='share'><li>Mail</ul><div id='comments'><p>First!</p></div><p>End</p>", "End"),
    ("<p>One <svg><text>icon</text></svg> two</p>", "One two"),
]
KEPT += [("<p>A <svg><!-- <svg> --><text>icon</text></svg> b</p>" + "<svg>" * 20_000, "A b")]
KEPT += [(f"<p>One <{tag} class=x>cut</p><p>Two</p><p>Three <{tag}>x</{tag}> four</p>", "One\nTwo\nThree four") for tag in ("svg", "object", "select", "button")]


@pytest.mark.parametrize("inside, text", KEPT, ids=range(len(KEPT)))
def test_article_text_is_kept(inside, text):
    page = f"<html><body><nav>Site</nav><article>{LONG}{inside}</article><footer>us</footer></body></html>"
    assert main_text(page) == LONG[3:-4] + "\n" + text


def test_ids_of_headings_outside_articles():
    assert main_text(f"<body><div class=content>{LONG}<h2 id=related>Related</h2><p class=ad>Buy</p></div>") == LONG[3:-4] + "\nRelated"


WHOLE = [
    (f"<form id='aspnetForm' class='form'><input type=hidden name=x><div id=content>{LONG * 6}</div><input name=q></form>", "\n".join([LONG[3:-4]] * 6)),
    (f"<div id='content'>{LONG}<h2 class='section-header'>Next</h2><p class='alert'>Mind it.</p><div class='social-history'><p>Of the town.</p></div></div>", LONG[3:-4] + "\nNext\nMind it.\nOf the town."),
    (f"<div id='content'>{LONG}<div class='top-menu'><p>Go</p></div><div class='related-posts'><p>More</p></div><p class='ad'>Buy</p></div>", LONG[3:-4]),
    (f"<div>{LONG}<form><p>Write to us</p><input name=a><textarea></textarea><button>Send</button></form></div>", LONG[3:-4]),
]


@pytest.mark.parametrize("body, text", WHOLE, ids=range(len(WHOLE)))
def test_text_outside_articles(body, text):
    assert main_text(f"<html><body>{body}</body></html>") == text


@pytest.mark.parametrize("page", ["<div>" * 50_000 + LONG, "<div><section>" * 25_000 + LONG + "</section>" * 5 + "</nav></li>" * 25_000, "<form>" * 20_000 + LONG, "<p><ul><li>" * 20_000 + LONG])
def test_deep_pages_in_linear_time(page):
    import time

    begin = time.perf_counter()
    assert html_extract.parse(page).blocks[-1][1] == LONG[3:-4]
    html_extract.path_scores(html_extract.parse(page))
    assert time.perf_counter() - begin < 10


def test_url_query_counts_and_letters_are_letters(spark):
    rows = [(k, f"http://shop{k % 7}.example.com/{'fr' if k % 2 else 'de'}/{k}?{'ref=news' if k % 2 else 'ref=casino77'}", None, "", "") for k in range(300)]
    rows += [(900, "http://other.example.net/x?ref=news", None, "", ""), (901, "http://other.example.net/x?ref=casino77", None, "", ""), (902, "http://other.example.net/x", None, "", "")]
    got = {r["page_id"]: (r["path"], r["score"]) for r in url_filter.judge(pages_of(spark, rows)).collect()}
    assert got[900][0] == got[901][0] == "/x" and got[900][1] > got[902][1] > got[901][1]
    from tickloom.llm.language import LETTER

    assert not LETTER.search("½ ² Ⅷ ① \u0301 123 _ €") and all(LETTER.search(x) for x in ("é", "漢", "я", "ª"))


def test_host_with_two_templates(spark):
    text = "A paragraph that belongs to the text of the page and says a thing or two about it. "
    often = "<body><article><h1>Story {0}</h1><p>" + text * 5 + "</p></article></body>"
    rare = "<body><article><p>Read also: story 1</p></article><div class=guide><h1>Guide {0}</h1><p>" + text * 6 + "</p><p>Its end</p></div></body>"
    rows = [(k, f"http://h.example/{k}", (rare if k > 7 else often).format(k), "", "") for k in range(10)]
    got = {r["page_id"]: r["text"] for r in html_extract.extract(pages_of(spark, rows)).collect()}
    for k in range(10):
        assert got[k] == (f"Guide {k}\n{(text * 6).strip()}\nIts end" if k > 7 else f"Story {k}\n{(text * 5).strip()}")

"""Main text and url rules against plain forms."""

from __future__ import annotations

import html
import re
import time
from collections import Counter
from itertools import combinations

import duckdb
import pytest
from pyspark.sql import functions as F

from fieldpulse.llm import main_text as mt, url_rules as ur
from fieldpulse.llm.queries import QUERIES, URL_RULES

SF_DIR = "/root/testdata/sf0.01"

# --- Main text ------------------------------------------------------------------------


def test_pages_against_their_article_elements(spark):
    source = dict(duckdb.sql(f"SELECT page_id, html FROM read_parquet('{SF_DIR}/pages.parquet')").fetchall())
    rows = QUERIES["op4_html_extraction"](spark, SF_DIR).collect()
    assert len(rows) == len(source)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", source[r["page_id"]], re.S)[1]
        blocks = [
            " ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)
        ]
        assert r["text"] == "\n\n".join(filter(None, blocks))
        assert r["n_chars"] == len(r["text"])


PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar">
<header><h1>Site</h1><p>A header with quite a lot of text in it, as if it were a paragraph of the page.</p></header>
<div id="cookie-notice"><p>We use cookies and tell you so at some length, so that it looks like content.</p></div>
<nav><ul><li><a href="/">Home</a></li><li><a href="/b">Blog</a></li></ul></nav>
<div class="ad-slot"><p>Buy this thing now, it is the best thing that ever was, and so on and so forth.</p></div>
{open}<h1>The &lt;title&gt;</h1><p>First   paragraph&nbsp;with <b>bold</b>, <a href="x">a link</a> and enough
words to count as content.</p><p>Short.</p><script>if (a < b) document.write("<p>no</p>")</script>
<form><label>Your mail</label><input name="m"><button>Send</button></form><ul><li>one item<li>another item</ul>
<p>Last paragraph, which is long enough to count as content, too, by any measure.{close}
<section id="comments"><h3>2 comments</h3><article class="comment"><p>A reader's comment that is as long as a
paragraph of the article and would pass for it.</p></article></section>
<aside><p>A sidebar with a teaser that is as long as a paragraph of the article, more or less.</p></aside>
<ul><li><a href="1">Related one</a></li><li><a href="2">Related two</a></li><li><a href="3">Related three</a></li></ul>
<footer><p>&copy; all rights reserved, and a long text about this site's owner and its many terms.</p></footer>
</body></html>"""
EXPECTED = [
    "The <title>", "First paragraph with bold, a link and enough words to count as content.", "Short.", "one item",
    "another item", "Last paragraph, which is long enough to count as content, too, by any measure.",
]


@pytest.mark.parametrize(("before", "after"), [
    ("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content"><div>', "</div></div>"),
    ('<div class="ad"><article>', "</article>"),
])
def test_furniture_goes_and_content_stays(before, after):
    page = PAGE.replace("{open}", before).replace("{close}", after)
    if "ad" in before.split('"'):
        page = page.replace("</body>", "</div></body>")
    assert mt.main_text(page).split("\n\n") == EXPECTED


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("<p></p>", ""), ("plain &amp; simple", "plain & simple"), ("<p>a<p>b", "a\n\nb"),
    ("<p>x<br>y</p>", "x y"), ("a &amp", "a &"), ("<div class=sidebar>only</div>", ""), ("<p>1 < 2 <3</p>", "1 < 2 <3"),
    ("<p>a</b>b</i>c</p></div>", "abc"), ("<p>\u00a0 wide \u3000 space\t</p>", "wide space"), ("<p>end <a hre", "end"),
])
def test_edges_of_markup(page, text):
    assert mt.main_text(page) == text


SENTENCE = "This sentence is long enough to be a line of content by any measure. "


@pytest.mark.parametrize("around", [
    "<div>{}</div>", "<div><div>{}</div></div>", "<section>{}</section>", "{}",
])
@pytest.mark.parametrize("each", ["<p>{}</p>", "<div><p>{}</p></div>"])
def test_a_dominating_paragraph_keeps_its_neighbours(around, each):
    texts = ["Title", "The lead.", *(f"Paragraph {i}." for i in range(8)), (SENTENCE * 300).strip(), "Then.", "The end."]
    menu = "<nav>" + "<p>An entry of the menu</p>" * 6 + "</nav>"
    body = [each.format(t) for t in texts]
    assert mt.main_text(f"<body>{menu}{around.format(''.join(body))}</body>").split("\n\n") == texts
    # Nothing near the long paragraph is possible content.
    apart = "".join([*body[:10], menu, body[10], menu, *body[11:]])
    assert mt.main_text(f"<body>{around.format(apart)}</body>").split("\n\n") == texts


@pytest.mark.parametrize("tag", ["div", "article"])
@pytest.mark.parametrize("sizes", [(19, 1), (1, 19), (5, 5), (12, 1, 12)])
def test_sibling_bodies_are_all_kept(tag, sizes):
    bodies = [[f"{SENTENCE}{b} {i}." for i in range(n)] for b, n in enumerate(sizes)]
    made = "".join(f"<{tag}>{''.join(f'<p>{t}</p>' for t in body)}</{tag}>" for body in bodies)
    page = f"<body><header><p>{SENTENCE}</p></header><div>{made}</div><footer><p>{SENTENCE}</p></footer></body>"
    assert mt.main_text(page).split("\n\n") == sum(bodies, [])


TEXTS = [f"{SENTENCE}{i}." for i in range(4)]
PARAGRAPHS = "".join(f"<p>{t}</p>" for t in TEXTS)


@pytest.mark.parametrize("name", [
    "has-sidebar", "no-sidebar", "with-nav wide", "search-page", "search", "modal", "comments-open", "related-work", "sidebarless",
])
def test_a_wrapper_does_not_empty_the_page(name):
    furniture = f"<div class='sidebar'><p>{SENTENCE}</p></div><nav><p>{SENTENCE}</p></nav>"
    page = f"<body><h1>Site</h1><div class='{name}'>{PARAGRAPHS}{furniture}</div><div id='cookie-notice'><p>Ok?</p></div></body>"
    assert [t for t in mt.main_text(page).split("\n\n") if t != "Site"] == TEXTS


@pytest.mark.parametrize("name", ["sidebar", "main-nav", "ad-slot", "ad_300x250", "cookieBanner", "related-posts", "page-footer", "comment-list"])
def test_names_of_furniture_still_bar(name):
    page = f"<body><div>{PARAGRAPHS}<div class='{name}'><p>{SENTENCE}</p></div></div></body>"
    assert mt.main_text(page).split("\n\n") == TEXTS


@pytest.mark.parametrize("tag", ["article", "div"])
@pytest.mark.parametrize("name", ["related-work", "copyright", "search", "discussion"])
def test_headings_and_sections_of_a_paper_stay(tag, name):
    made = f"<{tag}>{PARAGRAPHS}<h2 id='{name}'>A heading</h2>{PARAGRAPHS}</{tag}>"
    assert mt.main_text(made).split("\n\n") == [*TEXTS, "A heading", *TEXTS]
    if tag == "article" or name in ("related-work", "discussion"):
        made = f"<{tag}>{PARAGRAPHS}<section id='{name}'><h2>A heading</h2>{PARAGRAPHS}</section></{tag}>"
        assert mt.main_text(made).split("\n\n") == [*TEXTS, "A heading", *TEXTS]


def test_links_inside_the_region_stay():
    links = "".join(f"<li><a href='{i}'>Reference number {i}</a></li>" for i in range(4))
    names = [f"Reference number {i}" for i in range(4)]
    menu = "<ul><li><a>One</a><li><a>Two</a><li><a>Three</a></ul>"
    for tag in ("article", "div"):
        page = f"<body>{menu}<{tag}>{PARAGRAPHS}<ol>{links}</ol></{tag}>{menu}</body>"
        assert mt.main_text(page).split("\n\n") == [*TEXTS, *names]
    assert mt.main_text(f"<body>{menu}{PARAGRAPHS}<ol>{links}</ol>{PARAGRAPHS}{menu}</body>").split("\n\n") == [*TEXTS, *names, *TEXTS]
    assert mt.main_text(f"{menu}<article>{links}</article>").split("\n\n") == names


@pytest.mark.parametrize("piece", ["<", "<a ", "<!--", "&", "<p>x", "<div>x", "<b><p>", "</x>", '<a href="', "<div>x</div><b>"])
def test_time_does_not_explode(piece):
    start = time.process_time()
    mt.main_text(piece * 20_000)
    mt.main_text(piece * 20_000 + ">")
    assert time.process_time() - start < 10


def test_extra_columns_and_empty_table(spark):
    rows = [(1, None, "u", 5), (1, None, "u", 5), (None, "<p>x</p>", None, None)]
    pages = spark.createDataFrame(rows, "page_id long, html string, url string, n_chars int")
    got = mt.extract(pages)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(
        map(str, [(1, "u", "", 0), (1, "u", "", 0), (None, None, "x", 1)])
    )
    assert mt.extract(pages.limit(0)).collect() == []


# --- Url rules ------------------------------------------------------------------------


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = re.split(r"[?#]", url.split("://", 1)[1])[0]
    host, slash, path = rest.partition("/")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), slash + path


def plain_rule(url):
    host, path = plain_parts(url)
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


def test_every_url_against_the_plain_form(spark):
    urls = dict(duckdb.sql(f"SELECT page_id, url FROM read_parquet('{SF_DIR}/pages.parquet')").fetchall())
    rows = QUERIES["op6_url_filters"](spark, SF_DIR).collect()
    assert len(rows) == len(urls)
    for r in rows:
        rule = plain_rule(urls[r["page_id"]])
        assert (r["host"], r["path"]) == plain_parts(urls[r["page_id"]])
        assert r["rule"] == (rule and rule.text)
        assert r["verdict"] == rule.verdict if rule else r["verdict"] in ("allow", "block")


ODD = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x", "http://example.com/en/", "http://xexample.com/en/",
    "http://a.net/es/1", "http://net/fr/", "http://com", "http://x.com?a=/", "ftp://é.com/#x", "http://u@h.com:80/p://q",
    "://net/es/", "http://a.org/es/1", "http://a.org/es/1", "x\n://com/",
]


def test_odd_urls(spark):
    pages = spark.createDataFrame([(i, u, "r") for i, u in enumerate(ODD)], "page_id int, url string, rule string")
    for r in ur.judge(pages, URL_RULES).collect():
        rule = plain_rule(ODD[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (*plain_parts(ODD[r["page_id"]]), rule and rule.text)
    assert ur.judge(pages.limit(0), URL_RULES).collect() == []


def plain_rules(baskets, min_support, min_confidence):
    n, counts, joint = len(baskets), Counter(), Counter()
    for tokens, verdict in baskets:
        for k in range(1, len(tokens) + 1):
            for c in combinations(sorted(tokens), k):
                counts[c] += 1
                joint[c, verdict] += 1
    rules = {
        key: together / counts[key[0]] for key, together in joint.items()
        if together >= min_support * n and together / counts[key[0]] >= min_confidence
    }
    return {
        (tokens, verdict): confidence for (tokens, verdict), confidence in rules.items()
        if not any(rules.get((c, verdict), 0) >= confidence for c in combinations(tokens, len(tokens) - 1) if c)
    }


def test_mined_rules_and_matches_against_all_subsets(spark):
    baskets = [
        (sorted({f"a{i % 3}", f"b{i % 5}", f"c{i * 7 % 4}", "all"}), "block" if i % 5 == 1 or i % 12 == 0 else "allow")
        for i in range(240)
    ]
    labelled = spark.createDataFrame(baskets, "tokens array<string>, verdict string")
    mined = ur.mine(labelled, 0.02, 0.8).collect()
    expected = plain_rules(baskets, 0.02, 0.8)
    assert {(tuple(r["tokens"]), r["verdict"]): round(r["confidence"], 9) for r in mined} == {
        k: round(v, 9) for k, v in expected.items()
    }
    urls = [(f"u{i}", sorted({f"a{i % 4}", f"b{i % 6}", f"c{i % 5}"})) for i in range(60)]
    rules = [(tuple(r["tokens"]), r["verdict"], r["confidence"], r["support"]) for r in mined]
    best = {}
    for url, tokens in urls:
        fits = [(c, s, -len(t), v) for t, v, c, s in rules if set(t) <= set(tokens)]
        if fits:
            best[url] = max(fits)[3]
    got = ur.match(
        spark.createDataFrame(urls, "url string, tokens array<string>"),
        spark.createDataFrame(mined, "tokens array<string>, verdict string, confidence double, support double"),
    )
    assert {r["url"]: r["verdict"] for r in got.collect()} == best


def test_tokens(spark):
    row = spark.createDataFrame([("HTTPS://m.A.org/en/x-12.html?q=1&q=2&u#top",)], "url string").select(
        F.sort_array(ur.tokens_of(F.col("url"))).alias("t")
    ).first()
    assert row["t"] == sorted([
        "scheme:https", "host0:org", "host1:a", "host2:m", "path:en", "path:x", "path:0", "path:html", "depth:2",
        "key:q", "key:u", "fragment",
    ])


def test_labels_of_urls_are_learned_from(spark):
    pages = spark.createDataFrame([(i, f"http://shop{i}.org/sale/{i}") for i in range(5)], "page_id int, url string")
    labels = spark.createDataFrame(
        [(f"http://other{i}.org/sale/x", "block") for i in range(20)] + [("http://fine.org/news", "allow"), (None, "block"), ("http://x.org", None)],
        "url string, verdict string",
    )
    assert {r["verdict"] for r in ur.judge(pages, [], labels).collect()} == {"block"}
    assert {r["verdict"] for r in ur.judge(pages, []).collect()} == {"allow"}


def test_nothing_is_blocked_where_only_blocked_urls_are_labelled(spark):
    def verdicts(*labels):
        urls = ["http://a.net/en/1", "http://a.net/de/1", "http://a.org/en/1", "http://a.com/en/1", "http://a.com/de/1"]
        pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
        made = [(f"http://x{i}.{place}/{i}", verdict) for place, verdict in labels for i in range(20)]
        judged = ur.judge(pages, [], spark.createDataFrame(made, "url string, verdict string")).collect()
        return {urls[r["page_id"]][9:-2]: r["verdict"] for r in judged}

    known = [("net/es", "block"), ("net/fr", "block"), ("com/de", "allow"), ("com/en", "block")]
    # A path is judged where it differs from others, and then wherever it occurs; a host label that differs from nothing is not.
    assert verdicts(*known) == {"net/en": "block", "net/de": "allow", "org/en": "block", "com/en": "block", "com/de": "allow"}
    assert verdicts(*known[:2], ("net/en", "block"), ("com/de", "allow")) == {
        "net/en": "allow", "net/de": "allow", "org/en": "allow", "com/en": "allow", "com/de": "allow"
    }
    assert verdicts(*known, ("net/de", "allow"))["net/en"] == "block"


def test_mining_decides_pages_of_the_query(spark):
    rows = QUERIES["op6_url_filters"](spark, "/root/testdata/sf0.01").collect()
    mined = [r for r in rows if r["mined_rule"] is not None]
    assert all(r["rule"] is None for r in mined)
    assert {r["verdict"] for r in mined} == {"allow", "block"}
    assert {r["verdict"] for r in rows if r["rule"] is None and r["mined_rule"] is None} <= {"allow"}


@pytest.mark.parametrize("verdict", ["block", "mixed"])
def test_a_long_path_that_urls_share_ends_in_seconds(spark, verdict):
    slug = "-".join(f"word{i}" for i in range(20))
    urls = [(f"http://a{i}.com/x/{i}", "allow" if i % 3 else "block") for i in range(290)]
    urls += [(f"http://news.com/{slug}?page={i}", "allow" if verdict == "mixed" and i % 2 else "block") for i in range(10)]
    labels = spark.createDataFrame(urls, "url string, verdict string")
    pages = spark.createDataFrame([(1, f"http://other.com/{slug}?page=99"), (2, "http://other.com/word7")], "page_id int, url string")
    started = time.monotonic()
    got = {r["page_id"]: r["verdict"] for r in ur.judge(pages, [], labels).collect()}
    assert time.monotonic() - started < 60
    assert got == {1: "block", 2: "block"} if verdict == "block" else {1: "allow", 2: "allow"}


def test_tokens_that_always_stand_together_become_one(spark):
    baskets = [({"all", f"a{i % 3}", f"b{i % 3}", f"c{i % 3}", f"d{i % 4}", f"e{i % 4}", f"rare{i}"}, i) for i in range(120)]
    labelled = [(sorted(t), "block" if i % 3 == 1 and i % 4 != 2 else "allow") for t, i in baskets]
    rows = spark.createDataFrame([(i, *row) for i, row in enumerate(labelled)], "row long, tokens array<string>, verdict string")
    items = ur.merged_tokens(rows, 0.02)
    assert {(r["token"], r["item"]) for r in items.collect()} == {
        (f"{t}{i}", f"{g[0]}{i}") for g, n in (("abc", 3), ("de", 4)) for i in range(n) for t in g
    }
    merged = ur.as_items(rows, items, "row")
    assert {len(r["tokens"]) for r in merged.collect()} == {4}
    mined = {(tuple(r["tokens"]), r["verdict"]): round(r["confidence"], 9) for r in ur.mine(merged, 0.02, 0.8).collect()}
    plain = plain_rules([(t, v) for t, v in ((sorted(set(t) & {"all", *(f"{g}{i}" for g in "ad" for i in range(4))}), v)
                                             for t, v in labelled)], 0.02, 0.8)
    assert mined == {k: round(v, 9) for k, v in plain.items()}

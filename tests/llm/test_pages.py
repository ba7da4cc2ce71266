"""URL rules and main texts."""

from fnmatch import translate
import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyroom.llm import html_text, queries, urls
from tests.llm.conftest import MEDIUM, SMALL, rows_of


@given(st.lists(st.text("ab*?", max_size=6), min_size=1, max_size=30), st.lists(st.text("abc", max_size=9), min_size=1, max_size=8))
@settings(max_examples=200, deadline=None)
def test_automaton_matches_globs(globs, texts):
    automaton = urls.WildcardAutomaton([[c if c in "*?" else ord(c) for c in g] for g in globs])
    ends = np.cumsum([len(t) for t in texts])
    got = automaton.matches(np.array([ord(c) for t in texts for c in t], np.int64), ends)
    assert got.tolist() == [[bool(re.fullmatch(translate(g), t)) for g in globs] for t in texts]


ODD_URLS = [
    (1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "https://COM/"), (6, "x://com"), (7, "http://www.example.com/en/x"), (8, "http://a.WWW.Example.Com/en/"),
    (9, "http://example.com/en/?q"), (10, "http://notexample.com/en/"), (11, "http://example.com/EN/"), (12, "ftp://net/es/"), (13, "http://x.net/esp/"), (14, "http://y.org/.example.com/en/"),
    (15, "http://y.org/a://com/"), (16, "http://h.org#/en/://x"), (17, "http://h.org/wp-admin/x"), (18, "http://h.org/a.exe"), (19, "http://h.org/é/cgi-bin/?x.exe"), (20, "http://É.com/" + "long/" * 4000), (21, "http://h.org//a//b//"), (20, "http://é.net/fr/"),
]


def test_rules_match_sql(spark, tmp_path):
    frame = spark.createDataFrame([(*r, "h", "r") for r in ODD_URLS], "page_id long, url string, host string, rule string")
    duck = duckdb.connect()
    duck.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    duck.executemany("INSERT INTO pages VALUES (?, ?)", ODD_URLS)
    got = urls.judge_urls(frame)
    names = ("page_id", "host", "path", "rule", "verdict")
    want = duck.execute(f"SELECT {', '.join(names)} FROM ({queries.URL_SQL})").fetchall()
    assert sorted(rows_of(got.select(*names)), key=str) == sorted(want, key=str)
    verdicts = {r.page_id: (r.rule, r.verdict) for r in got.collect()}
    assert verdicts[7] == ("www.example.com/en/", "allow") and verdicts[9] == ("example.com/en/", "block")
    assert verdicts[6] == (None, "allow") and verdicts[14] == (None, "allow") and verdicts[17] == (None, "block")
    assert urls.judge_urls(frame.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op5_threshold_topk", "op9_url_wildcards"])
def test_queries_match_sql_on_the_table(name, spark):
    duck = duckdb.connect()
    for table in ("pages", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{MEDIUM}/{table}.parquet'")
    got = queries.QUERIES[name](spark, MEDIUM)
    want = duck.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLES[name]})").fetchall()
    assert sorted(rows_of(got), key=str) == sorted(want, key=str) and want


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header>Site</header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- <p>no</p> --><div class="cookie-notice">Accept</div><div class="ad">Buy</div>
<article><h1>Head &amp; line</h1><p><b>One\n two<br>three.<p>Caf&eacute;&nbsp;&#8212; x &lt; y</b></p><div class="share">Tweet</div><ul><li>a<li>b</ul>
<aside>Side</aside><form><input>Name</form><section id="comments"><p>First!</p></section></article><footer>&copy;</footer></body></html>"""


def test_main_text_is_the_article():
    assert html_text.main_text(PAGE) == "Head & line\nOne two three.\nCafé — x < y\na\nb"


def test_pages_without_article_lose_what_is_marked():
    assert html_text.main_text('<body><header>h</header><div role="navigation">n</div><div><p>kept &amp;amp; x</div><div hidden>z</div><p style="display: none">q</p>tail</body>') == "kept &amp; x\ntail"


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "<p class='x", "</div>", "<!--", "<script>x", "<article>"])
def test_broken_pages_are_empty(page):
    assert html_text.main_text(page) in ("", "<")


def test_text_without_markup_and_very_deep_pages():
    assert html_text.main_text("a &am b &amp c") == "a &am b & c"
    assert html_text.main_text("<div>" * 20_000 + "deep" + "</div>" * 20_000) == "deep"
    assert len(html_text.main_text("<p>" + "word " * 200_000)) == 999_999


def test_templates_are_found_by_recurrence(spark):
    """A container on many different pages of one host goes; paragraphs, copies and other hosts stay."""
    def page(i, extra=""):
        return f"<body><div><b>Site slogan</b></div><div><p>Text {i} here</p><p>Shared line</p></div>{extra}</body>"

    rows = [(i, f"http://a.org/{i}", page(i), 1, "x") for i in range(8)] + [(20 + i, "http://A.org/copy", page(50, "<div>Copied box</div>"), 1, "x") for i in range(9)]
    rows += [(40, "http://b.org/", page(1), 1, "x"), (41, None, page(2), 1, "x"), (42, "http://a.org/n", None, 1, "x"), (43, "http://a.org/n", "", 1, "x"), (0, "http://a.org/0", page(0), 1, "x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, key int, hash string")
    got = {}
    for r in html_text.extract_pages(frame, min_pages=5, min_share=0.01).collect():
        got.setdefault(r.page_id, set()).add((r.text, r.n_chars))
    assert got[3] == {("Text 3 here\nShared line", 23)} and got[0] == {("Text 0 here\nShared line", 23)}
    assert got[22] == {("Text 50 here\nShared line\nCopied box", 35)}
    assert got[40] == {("Site slogan\nText 1 here\nShared line", 35)} and got[42] == got[43] == {("", 0)} and len(got) == 21
    assert html_text.extract_pages(frame.limit(0)).count() == 0


LONG = "<p>The text of this page goes on for a while, so that it is most of it.</p>"
PLAIN = "The text of this page goes on for a while, so that it is most of it."


@pytest.mark.parametrize("page, text", [
    (f'<article class="post has-comments">{LONG}<div class="comments">c</div></article>', PLAIN),
    (f'<div class="layout with-sidebar"><article>{LONG}</article><div class="sidebar">s</div></div>', PLAIN),
    (f'<article>{LONG}<p>See <a href="/the-hidden-valley">the valley</a> and <a href="?id=comment">more</a> <b aria-hidden="false" data-class="ad">now</b></p></article>', PLAIN + "\nSee the valley and more now"),
    (f"<div>{LONG}</div><article>teaser</article><article>other</article>", PLAIN + "\nteaser\nother"),
    (f'<div class="page notice">{LONG}</div><article>teaser</article>', PLAIN + "\nteaser"),
    (f'<div class="menu"><p>a b</p></div><div class="notice"><p>c d</p></div>', "a b\nc d"),
    (f'<article><p>Short post</p><section id="comments">{LONG}</section></article>', "Short post"),
    (f'<article>{LONG}</article><div class="related"><article>teaser</article></div>', PLAIN),
])
def test_no_article_goes_for_a_piece_of_a_name(page, text):
    assert html_text.main_text(page) == text


def texts_of(spark, pages):
    rows = [(i, url, page) for i, (url, page) in enumerate(pages)]
    return {r.page_id: r.text for r in html_text.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_notices_inside_articles_are_found_by_recurrence(spark):
    """Plain text blocks and inline elements on most pages of a host go; a passage of few articles and words of sentences stay."""
    def page(i):
        shared = "<p>Passage of a few articles.</p>" if i < 6 else ""
        return f"<article><h3>Read more</h3><p>Text {i} <b>The</b> end</p>{shared}<p>Subscribe to us</p><ul><li>Follow us<li>Own {i}</ul><span>Sign up</span></article>"

    got = texts_of(spark, [(f"http://a.org/{i}", page(i)) for i in range(40)])
    assert got[0] == "Text 0 The end\nPassage of a few articles.\nOwn 0" and got[30] == "Text 30 The end\nOwn 30"


def test_templates_do_not_depend_on_the_size_of_a_host(spark):
    """A menu on 0.5% of a hot host goes; a container that five articles share stays, also on a small host."""
    def page(i, menu, box):
        return f"<body>{'<div>Section menu</div>' if menu else ''}<p>Text {i}</p>{'<div>Table of facts</div>' if box else ''}</body>"

    hot = [("http://hot.org/x", page(i, i % 200 == 0, i % 500 == 1)) for i in range(2500)]
    small = [("http://small.org/x", page(i, i < 12, i < 5)) for i in range(30)]
    got = texts_of(spark, hot + small)
    assert not any("menu" in t for t in got.values())
    assert sum("Table of facts" in t for t in got.values()) == 10


def by_counting(rows, min_pages):
    """Texts of (url, html) rows with the templates counted in one dictionary."""
    pages, hosts, kinds = {}, {}, {}
    for url, page in rows:
        host, top = html_text.host_digest(url), html_text.parse(page or "")
        article = html_text.main_text(page)
        hosts.setdefault(host, set()).add(article)
        for _, whole, kind in html_text.candidates(top):
            pages.setdefault((host, kind, whole), set()).add(article)
    gone = set()
    for (host, kind, whole), articles in pages.items():
        least, share = {0: (min_pages, 0), 1: (max(min_pages, 10), 0.3), 2: (max(min_pages, 10), 0.5)}[kind]
        if len(articles) >= max(2, least) and len(articles) >= share * len(hosts[host]):
            gone.add((host, kind, whole))
    texts = []
    for url, page in rows:
        top = html_text.parse(page or "")
        out = {id(node) for node, whole, kind in html_text.candidates(top) if (html_text.host_digest(url), kind, whole) in gone}
        texts.append(html_text.text_without(top, out) if page else "")
    return texts


@pytest.mark.parametrize("sent", [1 << 20, 0])
def test_counting_in_spark_equals_one_dictionary(spark, sent):
    """Whether templates are sent to the tasks or pages joined with theirs; repeated ids keep their own html."""
    table = spark.read.parquet(f"{MEDIUM}/pages.parquet").select("page_id", "url", "html")
    rows = [tuple(r) for r in table.collect()]
    rows += [(7, f"http://{'Twelve' if i % 3 else 'few'}.org/{i}", f"<div class=box{i}>Sold by {i}</div><article><p>{'own words ' * (i + 4)}</p><div>Shared</div></article>") for i in range(18)]
    frame = spark.createDataFrame(rows, table.schema)
    got = html_text.extract_pages(frame.repartition(5), sent=sent)
    want = [(i, url, text) for (i, url, _), text in zip(rows, by_counting([r[1:] for r in rows], 10))]
    assert sorted(rows_of(got.select("page_id", "url", "text")), key=str) == sorted(want, key=str)
    assert sum("Shared" in text for _, _, text in want) == 6


def test_shapes_decide_without_marks(monkeypatch):
    """Bars of ever different links and short boxes outside the article go on a host where they recur; the same inside an
    article, main headings, other articles and lists with few links stay. What stands outside `article` is kept here."""
    monkeypatch.setattr(html_text, "holders", lambda top, gone, spared: [top])

    def page(i):
        bar = "".join(f"<span><a href=/{i}{j}>go {i} {j}</a></span>" for j in range(2 + i % 4))
        inside = f"<div class=fact>Fact {i}</div><ul><li>Point {i} <a href=x>here</a> and more words of it</ul>"
        return f"<div>{bar}</div><div class='x{i} low'>Low {i}</div><div><h1>Head {i}</h1></div><article><p>Text {i} {'goes on ' * 9}</p>{inside}</article><article>Brief {i}</article>"

    def other(i):
        return f"<div><p>Lead {i}</p></div><div><p>Body {i} of a page without an article</p></div>"

    pages = [(f"http://a.org/{i}", page(i)) for i in range(20)] + [(f"http://b.org/{i}", other(i)) for i in range(20)] + [(f"http://c.org/{i}", page(i)) for i in range(9)]
    got = by_counting(pages, 10)
    for i in range(20):
        assert f"Head {i}\n" in got[i]
        assert f"go {i}" not in got[i] and "Low" not in got[i]
        assert f"Fact {i}\nPoint {i} here and more" in got[i] and got[i].endswith(f"Brief {i}")
        assert got[20 + i] == f"Lead {i}\nBody {i} of a page without an article"
    assert "go 3 0" in got[43] and "Low 3" in got[43]


def test_attributes_of_megabytes_and_clashing_columns(spark):
    page = f'<div class="{"a1 " * 700_000}" title="{"<p>" * 500_000}">{LONG}</div>'
    frame = spark.createDataFrame([(1, "http://a.org/", page, 5, 6, 7), (1, None, None, 5, 6, 7)], "page_id int, url string, html string, key int, host int, template int")
    assert sorted(rows_of(html_text.extract_pages(frame)), key=str) == [(1, "http://a.org/", PLAIN, len(PLAIN)), (1, None, "", 0)]


def test_every_page_of_the_table_has_a_text(spark):
    frame = spark.read.parquet(f"{SMALL}/pages.parquet")
    rows = html_text.extract_pages(frame).collect()
    assert len(rows) == frame.count()
    assert all(r.text and r.n_chars == len(r.text) and "  " not in r.text and "&copy;" not in r.text for r in rows)

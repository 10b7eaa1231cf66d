"""Licence scans and main text, which only read."""

from __future__ import annotations

import os
import random
from html.parser import HTMLParser

import duckdb
import pytest

from tallygate.llm import html_text, licenses
from tests.llm.shapes import documents, odd_rows, prose


def licensed_rows():
    apache = "Licensed under the Apache License, Version 2.0"
    bsd = licenses.TEMPLATES["bsd"][0]
    return odd_rows() + [
        (30, f"{apache}.\n{prose(1, 50)}"),
        (31, f"{prose(2, 30)}\n\n{bsd.upper()}\n \n{prose(3, 30)}"),
        (32, " ".join(bsd.split()[: len(bsd.split()) // 2]) + "\n\n" + " ".join(bsd.split()[len(bsd.split()) // 2 :])),
        (33, "the MIT\n\nlicense, a mit-license and General Public License mit licensed"),
        (34, "permitted " + " ".join(reversed(bsd.split()))),
        (36, "The album was released under a license by the studio, and the dog ran home"),
        (37, f"{prose(4, 200)} {bsd} {prose(5, 200)}"),
        (38, f" {prose(6, 100)} ".join(bsd.split())),
        (39, f"{prose(7, 128 + 256 - len(bsd.split()))} {bsd}"),
        (40, licenses.TEMPLATES["mit"][1]),
        (35, "Kelvin general public lİcense"),
    ]


def test_scans_equal_their_sql(spark):
    rows = licensed_rows()
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    # a repeated id would join with itself in the SQL
    rows = [(k, t.replace("\x00", "") if t else t) for k, (_, t) in enumerate(rows)]
    con.executemany("insert into documents values (?, ?)", rows)
    sql = con.sql(licenses.oracle_sql())
    found = licenses.license_scan(documents(spark, rows, extra=True))
    names = sorted(found.columns)
    assert sorted(sql.columns) == names
    key = lambda r: r[0]
    order = ["doc_id", *[n for n in names if n != "doc_id"]]
    assert sorted(map(tuple, found.select(order).collect()), key=key) == sorted(sql.select(", ".join(order)).fetchall(), key=key)


def test_labels_need_words_near_each_other(spark):
    labels = {r["doc_id"]: r["labels"] for r in licenses.license_scan(documents(spark, licensed_rows())).collect()}
    assert [labels[k] for k in (34, 36, 37, 38, 39, 40)] == ["bsd", "", "bsd", "", "bsd", "mit"]


def test_scans_of_odd_rows(spark):
    found = licenses.license_scan(documents(spark, extra=True)).collect()
    assert len(found) == len(odd_rows()) and {r["labels"] for r in found} == {""}
    assert licenses.license_scan(documents(spark, [])).count() == 0
    with pytest.raises(ValueError):
        licenses.license_scan(documents(spark), templates={"x": [" ".join(map(str, range(30_000)))]})


ARTICLE = "<p>First <b>bold</b> one &amp; more</p><p>Second\n  of&nbsp;it<br>goes on</p><p>End.</p>"
TEXT = "First bold one & more\nSecond of it goes on\nEnd."


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>T</title><style>p{{}}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href=x>Home</a></ul></nav><article>{ARTICLE}</article><footer>&copy; me</footer>",
        f"<body><header><h1>Site</h1></header><main>{ARTICLE}<form>Name <input></form><div class='comments'><p>{'I agree. ' * 99}</p></div></main>",
        f"<div id=sidebar-left>{'Side text. ' * 30}</div><article>{ARTICLE.replace('<p>End', '<div class=ad>Buy</div><p>End')}</article>",
        f"<div class=ad>{'never closed ' * 40}<article>{ARTICLE}</article>",
        f"<article><p>Teaser</p></article><article>{ARTICLE}</article><aside><article>{'other ' * 99}</article></aside>".replace("<aside><article>", "<aside><p>").replace("</article></aside>", "</p></aside>"),
        f"<!-- <article>no</article> --><article title='a > b'>{ARTICLE}</article><div role='complementary'>x</div><div style='display: none'>{'y ' * 300}</div>",
    ],
)
def test_the_article_alone_is_left(page):
    assert html_text.main_text(page) == TEXT


def test_pages_without_an_article_keep_what_surges():
    long = "A sentence of some length that goes on. " * 8
    menu = "".join(f"<li><a href=x>{long}</a>" for _ in range(3))
    page = f"<div><p>tiny</p></div><ul>{menu}</ul><div><p>{long}<p>short<p>{long}</div><div>tail</div>"
    assert html_text.main_text(page) == f"{long.strip()}\nshort\n{long.strip()}"
    assert html_text.main_text("a <b>b") == "a b"


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<!--", "<script>", "<script>x", "</p></div>", "<div class=ad>x", "&#0;&bogus;<a b='"])
def test_broken_pages_dont_fail(page):
    assert isinstance(html_text.main_text(page), str)


def test_pages_of_odd_rows(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, "<p>x</p>"), (2, "v", "<p>" + "long " * 200_000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'y' as text", "1 as n_chars")
    found = html_text.extract(frame).collect()
    assert sorted(r["n_chars"] for r in found) == [0, 0, 1, 999_999]
    assert html_text.extract(frame.where("false")).count() == 0


def test_every_registered_page_query_reads_its_table(spark):
    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no test tables here")
    from tallygate.llm.queries import QUERIES

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    assert QUERIES["op7_html_text"](spark, "/root/testdata/sf0.001").count() == pages.count()


LONG = "A sentence of some length that goes on. " * 8


@pytest.mark.parametrize(
    "begin, end",
    [("<main>", "</main>"), ("<div class=content>", "</div>"), ("<section>", "</section>"), ("<div class='page with-sidebar'><div>", "</div></div>"), ("<body>", "</body>")],
)
def test_lists_and_closing_lines_of_the_main_text_stay(begin, end):
    inner = f"<h2>Parts</h2><p>{LONG}</p><ul><li>Bolt 4 mm<li>Nut</ul><table><tr><td>1<td>2</table><p>Short closing.</p>"
    page = f"<nav><a href=x>{LONG}</a></nav>{begin}{inner}{end}<div>tail</div>"
    assert html_text.main_text(page) == f"Parts\n{LONG.strip()}\nBolt 4 mm\nNut\n1 2\nShort closing."


@pytest.mark.parametrize("begin, end", [("<main>", "</main>"), ("<div>", "</div>")])
def test_links_inside_the_main_text_stay(begin, end):
    page = f"<ul><li><a href=x>Menu</a></ul>{begin}<p>{LONG}</p><ul><li><a href=x>Source</a></ul><p>End.</p>{end}<ul><li><a href=y>Next</a></ul>"
    assert html_text.main_text(page) == f"{LONG.strip()}\nSource\nEnd."


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<article>Teaser card.</article><div class='post-body'>{LONG}</div>", LONG),
        (f"<article><p>{LONG}</article><div><p>Aside.</div><article><p>More. {LONG}</article><article>Card</article>", f"{LONG.strip()}\nMore. {LONG}"),
        (f"<article><p>{LONG}<div class=share>Shares. {LONG}</div><div class=share><a href=x>{LONG}</a></div><p>End.</article>", f"{LONG.strip()}\nShares. {LONG.strip()}\nEnd."),
        (f"<div class='search results'><p>{LONG}</div><div class=search>Go</div>", LONG),
        (f"<form action=x><p>{LONG}<p>End.</form><form><input>Send</form>", f"{LONG.strip()}\nEnd."),
        (f"<div><p>{LONG}</div><div class=cookie-bar>We use {LONG}</div>", LONG),
        (f"<article><p>{LONG}<div class=comment-list>I think {LONG}</div><p>End.</article>", f"{LONG.strip()}\nEnd."),
        (f"<main><article><p>{LONG}</article><div>Others read this.</div></main>", LONG),
        (f"<div class=widget><div>x</div><p class=share>y<article><p>{LONG}</article>", LONG),
        (f"<main><p>{LONG}</main><div class=related><p>{LONG}{LONG}</div><section class=with-sidebar><p>Other {LONG}</section>", f"{LONG.strip()}\nOther {LONG}"),
    ],
)
def test_windows_decide_on_pages_with_marked_text(page, text):
    assert html_text.main_text(page) == text.strip()


def plainly(parts):
    """The text of parts, (in an article or not, its blocks), by every window of three blocks."""
    found = []
    for article, blocks in parts:
        blocks = [x for x in (" ".join(b.split()) for b in blocks) if x]
        peak = max((sum(map(len, blocks[k : k + 3])) for k in range(len(blocks))), default=0)
        found.append((article, peak, sum(map(len, blocks)), "\n".join(blocks)))
    found = [x for x in found if x[1]]
    highest = max((x[1] for x in found if x[0]), default=0)
    risen = [x for x in found if (4 * x[1] >= max(150, highest) if x[0] else x[1] >= max(150, highest))]
    risen = risen or [x for x in found if x[1] >= 150]
    risen = risen or found and [max(found, key=lambda x: x[2] * (4 if x[0] else 1))]
    return "\n".join(x[3] for x in risen)


def test_parts_equal_every_window():
    rng = random.Random(3)
    for _ in range(2000):
        parts = [
            (rng.random() < 0.4, [prose(rng.randrange(99), rng.choice([0, 1, 3, 8, 30])) for _ in range(rng.randint(1, 6))])
            for _ in range(rng.randint(1, 6))
        ]
        page = "".join(f"<{n}>{''.join(f'<p>{b}</p>' for b in bs)}</{n}>" for n, bs in (("article" if a else "div", bs) for a, bs in parts))
        assert html_text.main_text(page) == plainly(parts)


class Parts(HTMLParser):
    """Parts of the supplied pages, by the library's parser."""

    def __init__(self):
        super().__init__()
        self.open, self.parts = [], []

    def handle_starttag(self, tag, attrs):
        if tag not in ("br", "meta"):
            self.open.append(("ad" if ("class", "ad") in attrs else tag))
        if tag in ("article", "nav", "footer", "div"):
            self.parts.append((tag == "article", [""]))
        elif tag in ("p", "h1") and self.parts:
            self.parts[-1][1].append("")
        elif tag == "br" and self.parts:
            self.parts[-1][1][-1] += " "

    def handle_endtag(self, tag):
        while self.open and self.open[-1] not in (tag, "ad" if tag == "div" else tag):
            self.open.pop()
        if self.open:
            self.open.pop()

    def handle_data(self, data):
        if self.parts and not {"nav", "footer", "ad", "script", "style", "title"}.intersection(self.open):
            self.parts[-1][1][-1] += data


def test_supplied_pages_equal_every_window(spark):
    if not os.path.isdir("/root/testdata/sf0.01"):
        pytest.skip("no test tables here")
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()}
    for page in pages.collect():
        parser = Parts()
        parser.feed(page["html"])
        parser.close()
        assert found[page["page_id"]] == plainly(parser.parts)

"""Pages whose wrappers are named like boilerplate, broken markup, and text that only looks like markup."""

from __future__ import annotations

import time

import pytest

from croplake.llm import html_text

TEXT = "The rules of the second pass give the label of the nearest block that is decided, and this is a long block of text that has the words for it."
NAV = "<nav><a href=1>Home</a></nav>"
PART = f"<h1>Title</h1><p>{TEXT}</p><p>{TEXT}</p>"
GOOD = f"Title\n\n{TEXT}\n\n{TEXT}"


@pytest.mark.parametrize("page, want", [
    (f'<div class="layout with-sidebar">{NAV}<article>{PART}</article><div class="sidebar">Side text here</div></div>', GOOD),
    (f'<div class="page sidebar-right">{NAV}<main>{PART}</main><div class="sidebar"><p>{TEXT}</p></div></div>', GOOD),
    (f'{NAV}<div class="entry has-comments">{PART}</div><div class="comments"><p>{TEXT}</p></div>', GOOD),
    (f'<form id="aspnetForm">{NAV}<article>{PART}</article></form>', GOOD),
    (f'<form id="aspnetForm">{NAV}{PART}<div class="footer">All rights</div></form>', GOOD),
    (f'<article>{PART}<div class="related-work"><h2>Related work</h2><p>{TEXT}</p></div></article>', f"{GOOD}\n\nRelated work\n\n{TEXT}"),
    (f'<article>{PART}<div class="related"><h2>Related</h2><ul><li><a href=1>Some page</a><li><a href=2>Other page</a></ul></div></article>', GOOD),
    (f'<article>{PART}<section id="comments"><p>{TEXT * 5}</p></section></article><div class="related-posts"><article><p>{TEXT}</p></article></div>', GOOD),
    (f'<article>{PART}<form><p>Your name</p><input><textarea>x</textarea></form><div class="newsletter"><p>{TEXT}</p></div></article>', GOOD),
    (f'<div class="has-footer"><div id="main">{PART}</div><div id="footer"><p>{TEXT}</p></div></div>', GOOD),
])
def test_wrappers_named_like_boilerplate(page, want):
    assert html_text.main_text(page) == want


@pytest.mark.parametrize("page, want", [
    ("a < b and c > d <p>x</p> <3 you", "a < b and c > d\n\nx\n\n<3 you"),
    ('<p title="a > b">one</p><p data-x=\'"\'>two</p>', "one\n\ntwo"),
    ('<p title="never closed>one</p><p>two</p>', "one\n\ntwo"),
    ("<p>one<br/>two</p><p>three</", "one two\n\nthree</"),
    ("<P CLASS=x>one<SCRIPT>var a = '<p>no</p>'</SCRIPT >two</P>", "onetwo"),
    ("<p>a<!-- b --><![CDATA[ c ]]>d &amp;amp; &#x41;&lt;p&gt;</p>", "a d &amp; A<p>"),
])
def test_markup(page, want):
    assert html_text.main_text(page) == want


@pytest.mark.parametrize("unit", ['<a "', "<a b=\"", "<a b='\">", "<", "<b ", "<b>", "</x", "<!x", "<!--", "<script>", "</script", "<div class=\"comment\">", "<![CDATA[", "&", "<p a= ", "<div>x"])
def test_broken_pages_take_linear_time(unit):
    begin = time.perf_counter()
    html_text.main_text(f"<p>{TEXT}</p><script>" * (unit == "</script") + unit * (100_000 // len(unit)) + "<p>x</p>")
    assert time.perf_counter() - begin < 1.5  # 100 kB
    html_text.main_text(f"<p>{TEXT}</p>" + unit * (400_000 // len(unit)))


def test_long_pages_and_repeated_rows(spark):
    page = f"<article>{'<p>' + TEXT + '</p>'}" + f"<p>{TEXT}" * 4000 + "</article>"
    rows = [(1, "u", page), (1, "u", page), (None, None, '<a "' * 20_000)]
    got = html_text.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert [r["text"].count(TEXT) for r in got if r["page_id"] == 1] == [4001, 4001] and len(got) == 3

"""Main text of pages of several builds."""

import re
import time
from html import unescape

from tessera.llm import html_text, queries

ARTICLE = "<p>The first paragraph of the story, which is long enough to be read as a text of its own.</p>"
SECOND = "<p>A second one follows it with <a href='x'>a link</a> and <b>bold</b> words, and it goes on for a while.</p>"
WANT = (
    "The first paragraph of the story, which is long enough to be read as a text of its own. "
    "A second one follows it with a link and bold words, and it goes on for a while."
)


def page(body: str) -> str:
    return f"<!DOCTYPE html><html><head><title>Not this</title><script>var a='<p>no</p>';</script></head><body>{body}</body></html>"


def test_table_of_pages(spark):
    rows = queries.op1_html_extraction(spark, "/root/testdata/sf0.001").collect()
    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()}
    assert len(rows) == len(pages)
    for r in rows:
        inside = re.search(r"<article>(.*?)(</article>|<footer|$)", pages[r.page_id], re.S)[1]
        assert r.text == " ".join(unescape(re.sub(r"<[^>]*>?", " ", inside)).split())
        assert r.n_chars == len(r.text)


def test_boilerplate_goes():
    around = (
        "<header><h1>Site</h1></header><nav><a href='a'>One</a></nav>{}<aside>Side text of some length here</aside>"
        "<div class='advert'>Buy this now, it is very cheap and good for you and for all others</div>"
        "<div id='cookie-notice'>We use cookies on this site, as all do</div><form><label>Name</label><input></form>"
        "<section class='comments'><article class='comment'><p>I liked it, said a reader of this page at length.</p>"
        "</article></section><footer>&copy; all of us</footer>"
    )
    assert html_text.main_text(page(around.format(f"<article>{ARTICLE}{SECOND}</article>"))) == WANT
    assert html_text.main_text(page(around.format(f"<main><div>{ARTICLE}{SECOND}</div></main>"))) == WANT
    assert html_text.main_text(page(around.format(f"<div id='content'>{ARTICLE}{SECOND}</div>"))) == WANT


def test_menus_without_names():
    menu = "<div>" + "".join(f"<div><a href='{i}'>Entry {i}</a></div>" for i in range(12)) + "</div>"
    assert html_text.main_text(page(f"{menu}<div>{ARTICLE}{SECOND}</div>{menu}")) == WANT


def test_blocks_references_and_blanks():
    html = "<article><h2>A&amp;B</h2><p>one\n  two&nbsp;three<br>four</p><ul><li>x</li><li>y&#33;</li></ul><pre>a\n b</pre></article>"
    assert html_text.main_text(page(html)) == "A&B one two three four x y! a b"
    assert html_text.main_text("<p>lo<b>ud</b>ly</p>") == "loudly"


def test_broken_pages():
    assert html_text.main_text(None) == "" and html_text.main_text("") == "" and html_text.main_text("  ") == ""
    assert html_text.main_text("<nav>only a menu</nav>") == ""
    assert html_text.main_text("plain words") == "plain words"
    assert html_text.main_text("<head><title>t<body><article><p><b>never closed<p>text") == "never closed text"
    assert html_text.main_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    long = "<p>" + "word " * 200_000 + "</p>"
    assert len(html_text.main_text(long)) == 5 * 200_000 - 1


def test_columns_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "<p>x</p>", "old"), (1, None, None)], "page_id long, html string, text string")
    out = html_text.extract(pages)
    assert out.columns == ["page_id", "html", "text", "n_chars"]
    assert sorted((r.text, r.n_chars) for r in out.collect()) == [("", 0), ("x", 1)]
    assert html_text.extract(pages.limit(0)).count() == 0


LIST = "".join(f"<li>Entry {i} of a list that is much longer than all the rest of this article</li>" for i in range(12))
LIST_TEXT = " ".join(f"Entry {i} of a list that is much longer than all the rest of this article" for i in range(12))


def test_content_around_the_inner_container_stays():
    for tag in ("ul", "blockquote", "section", "div"):
        inner = f"<{tag}>{LIST}</{tag}>"
        for outer in ("article", "main"):
            got = html_text.main_text(page(f"<{outer}><p>How it begins.</p>{inner}<p>How it ends.</p></{outer}>"))
            assert got == f"How it begins. {LIST_TEXT} How it ends.", (tag, outer)
        got = html_text.main_text(page(f"<div>{ARTICLE}{inner}{SECOND}</div>"))
        assert got == WANT.replace(" A second", f" {LIST_TEXT} A second"), tag
    table = "<table>" + LIST.replace("<li>", "<tr><td>").replace("</li>", "</td></tr>") + "</table>"
    assert html_text.main_text(page(f"<article>{ARTICLE}{table}{SECOND}</article>")) == (
        WANT.replace(" A second", f" {LIST_TEXT} A second")
    )
    header = f"<nav><a href='a'>One</a></nav><article><header><h1>Head</h1></header><div class='body'>{ARTICLE}{SECOND}</div></article>"
    assert html_text.main_text(page(header)) == f"Head {WANT}"
    sections = f"<main><section><h2>A</h2>{ARTICLE * 4}</section><section><h2>B</h2>{SECOND}</section></main>"
    got = html_text.main_text(page(sections))
    assert got.startswith("A The first") and got.endswith(f"B {WANT[WANT.index('A second'):]}")


def test_two_blocks_of_content():
    menu = "<div>" + "".join(f"<div><a href='{i}'>Entry {i}</a></div>" for i in range(12)) + "</div>"
    got = html_text.main_text(page(f"{menu}<div>{ARTICLE * 4}</div><div>{SECOND * 2}</div>{menu}"))
    assert got.count("The first paragraph") == 4 and got.count("A second one") == 2 and "Entry" not in got


def test_names_and_forms_around_the_content():
    aside = "<div class='sidebar'><p>Side text of some length here</p></div><form><label>Name</label></form>"
    for outer in ("div class='layout has-sidebar'", "div id='page' class='with-navbar'", "form id='aspnetForm'", "div role='form'"):
        tag = outer.split()[0]
        for inner in ("article", "main", "div"):
            body = f"<{outer}>{aside}<{inner}>{ARTICLE}{SECOND}</{inner}></{tag}>"
            assert html_text.main_text(page(body)) == WANT, (outer, inner)
    nested = f"<form><div class='with-navbar'><div class='has-sidebar'>{aside}<article>{ARTICLE}{SECOND}</article></div></div></form>"
    assert html_text.main_text(page(nested)) == WANT
    cards = "<div class='related'>" + "<article><p>Another story that is told on a page of its own</p></article>" * 2 + "</div>"
    assert html_text.main_text(page(f"<div class='has-sidebar'><article>{ARTICLE}{SECOND}</article>{cards}</div>")) == WANT


def test_names_do_not_silence_all():
    assert html_text.main_text("<div class='notice'>All that is here</div>") == "All that is here"
    ads = "".join(f"<div class='ad'>{word} here</div>" for word in ("one", "two", "six"))
    assert html_text.main_text(ads) == "one here two here six here"


def test_flags_about_comments_name_no_comment():
    body = "<h1>Title of it</h1>" + "<p>" + "word of the article " * 30 + "</p>"
    for name in ("post has-comments", "comments-open hentry", "no-reply", "post no-comments comments-closed"):
        for other in ("<div><p>" + "other words " * 20 + "</p></div>", "<article class='teaser'>" + "tease more " * 5 + "</article>"):
            made = f"<html><body><article class='{name}'>{body}</article>{other}</body></html>"
            text = html_text.main_text(made)
            assert text.startswith("Title of it word of the article"), (name, text[:80])


def test_cells_and_items_without_end_tags():
    def listed(n):
        rows = "".join(f"<tr><td>cell {k} of the table<td>and its value {k}" for k in range(n))
        return f"<html><body><article><h1>Rows</h1><table>{rows}</table><ul>" + "<li>an item of some words" * n + "</ul></article></body></html>"

    text = html_text.main_text(listed(5))
    assert text.startswith("Rows cell 0 of the table and its value 0 cell 1") and text.count("an item of some words") == 5
    took = []
    for n in (1000, 4000):
        start = time.perf_counter()
        html_text.main_text(listed(n))
        took.append(time.perf_counter() - start)
    assert took[1] < 1 + 8 * took[0]

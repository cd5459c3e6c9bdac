"""Pages of several builds with known article text."""

import html
import time

import pytest

from daybook.llm.html_text import extracted, main_text

PARTS = ["A headline & more", "First paragraph with  quite\n some words in it, enough to be text. " * 3, "Short.",
         "Second long paragraph that goes on and on, with “quotes” and 3 < 4. " * 4, "End."]
WANT = " ".join(" ".join(" ".join(p.split()) for p in PARTS).split())
BODY = f"<h1>{html.escape(PARTS[0])}</h1>" + "".join(f"<p>{html.escape(p)}</p>" for p in PARTS[1:])
MENU = '<ul class="main-menu"><li><a href="/a">Home</a><li><a href="/b">News</a></ul>'
BUILDS = {
    "article": f"<html><head><title>T</title><style>p{{}}</style></head><body><nav>{MENU}</nav><div class='ad'>Buy this now, a long advert text {'x ' * 80}</div>"
               f"<article>{BODY}</article><footer>&copy; me</footer></body></html>",
    "divs": f"<body><div id='header'><header>Site name</header></div>{MENU}<div id='content'>{BODY}</div>"
            f"<div class='sidebar'><p>{'side words ' * 40}</p></div><div id=comments><article><p>{'I think so ' * 30}</p></article></div>",
    "main": f"<body><header><h2>Site</h2></header><main>{BODY}<form><p>Mail <input name=a><button>Send</button></p></form>"
            f"<script>var a='<p>no</p>'</script></main><aside>{'other things ' * 50}</aside>",
    "unclosed": f"<body><div class=advert>Ad text<article>{BODY.replace('</p>', '')}</article><footer>foot",
    "inline": f"<body><article>{BODY.replace('long', 'lo<b>ng</b>').replace('words in', 'words<br>in')}</article>",
    "cookie": f"<body><div class='cookie-notice'><p>{'We use cookies ' * 30}</p></div><section>{BODY}</section><div class='share'>Share</div>",
    "flat": f"<body>{MENU}{BODY}<footer>foot {'x ' * 40}</footer></body>",
    "comments in article": f"<body><article>{BODY}<section class='comments'><p>{'Nice one ' * 40}</p></section></article>",
}


@pytest.mark.parametrize("name", BUILDS)
def test_builds(name):
    assert main_text(BUILDS[name])[0] == WANT


INTRO = ["First opening paragraph of the text, " * 8, "Second opening paragraph of it all, " * 8]


@pytest.mark.parametrize("inner", ["section", "ul", "blockquote", "td", "div"])
def test_dominant_inner_element(inner):
    big = ["One of the long lines inside the element. " * 10 for _ in range(5)]
    tag = "li" if inner == "ul" else "p"
    inside = "".join(f"<{tag}>{t}</{tag}>" for t in big)
    around = f"<table><tr><td>{inside}</table>" if inner == "td" else f"<{inner}>{inside}</{inner}>"
    page = (f"<body>{MENU}<div id=content><h1>The title</h1>" + "".join(f"<p>{t}</p>" for t in INTRO)
            + around + "<p>Short end.</p></div><div class=sidebar>Other things</div><footer>foot</footer>")
    assert main_text(page)[0] == " ".join(" ".join(["The title", *INTRO, *big, "Short end."]).split())


@pytest.mark.parametrize("name", ["content with-sidebar", "no-comments", "has-nav main-column", "post without_ads", "page-no-sidebar"])
def test_names_of_what_stands_beside(name):
    assert main_text(f"<body>{MENU}<div class='{name}'>{BODY}</div><div class='site-sidebar'>x y z</div>")[0] == WANT


@pytest.mark.parametrize("name", ["elementor-widget", "elementor-widget-text-editor", "social-text-page", "notice-page", "ad-free", "sidebar-layout"])
@pytest.mark.parametrize("page", ["<body><main><div class='{0}'>{1}</div></main>", "<body><article><section class='{0}'>{1}</section></article>",
                                  "<body><nav>Menu</nav><div class='{0}'>{1}</div><footer>x</footer>"])
def test_names_that_mark_nothing(name, page):
    assert main_text(page.format(name, BODY))[0] == WANT


@pytest.mark.parametrize("name", ["ad", "ad-container", "ad-slot-1", "adContainer", "main-menu", "site-sidebar", "cookie-notice", "share-buttons",
                                  "widget", "related-posts", "sidebar-left", "ad300x250"])
def test_names_that_mark(name):
    assert main_text(f"<body><article>{BODY}<div class='{name}'><p>{'bought things ' * 40}</p></div></article>")[0] == WANT


def test_lines_alike():
    a, b, c = "One paragraph of the text. " * 6, "Another one that is longer. " * 12, "The last and longest of all. " * 30
    want = " ".join(" ".join([a, b, c]).split())
    same = " ".join((a + a).split())
    assert main_text(f"<body><div><p>{a}</p></div><div><p>{a}</p></div></body>")[0] == same
    assert main_text(f"<body><main><article>{a}</article></main><article>{a}</article>")[0] == same
    for tag in ("article", "div", "section"):
        parts = "".join(f"<{tag}><p>{t}</p></{tag}>" for t in (a, b, c))
        assert main_text(f"<body>{parts}</body>")[0] == want
        assert main_text(f"<body>{MENU}<ul><li><a href=x>Home</a><li><a href=y>About</a></ul>{parts}<footer>f</footer></body>")[0] == want


def test_only_named_elements():
    assert main_text(f"<body><nav>m</nav><div class='modal'>{BODY}</div></body>")[0] == WANT
    assert main_text("<body><article></article><div class='ad'><p>Buy this now</p></div></body>")[0] == ""


@pytest.mark.parametrize("part", ["<a ", "<!--", "<?", "</", "<!", "<div>x", "<div>", "<div></ul>", "<script></", "<a b='", "&", "&#", "<article>x", "<div class=ad>"])
def test_hostile_pages(part):
    """Linear time: 400 kB of one opening part, also with a close far behind."""
    for end in ("", ">", "<p>x</p>"):
        begin = time.process_time()
        main_text(part * (400_000 // len(part)) + end)
        assert time.process_time() - begin < 8


def test_unclosed():
    assert main_text("<article><p>one</p><p>two <b")[0] == "one two"
    assert main_text("<article><p>one</p><!-- two")[0] == "one"
    assert main_text("<article><p>one</p><!--> <p>two 3 < 4 <5")[0] == "one two 3 < 4 <5"


def test_references_and_space():
    t = main_text("<article><p>a&nbsp;b &#233;&eacute; &amp;amp; &lt;p&gt;\n\tc</p><p>d</p>e</article>")[0]
    assert t == "a b éé &amp; <p> c d e"


def test_rows(spark):
    rows = [(1, "u", BUILDS["article"], 1), (1, "u", BUILDS["article"], 1), (None, None, None, 2), (3, "v", "", 3),
            (4, "w", "<br><p></p><!-- x -->", 4), (5, "x", "<p>" + "word " * 200_000, 5), (6, "y", "no tags", 6),
            (7, "z", "<article><p>cut off &am", 7), (8, "z", "<![bad <p>", 8)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int").repartition(2)
    got = {r.page_id: r for r in extracted(df).collect()}
    assert extracted(df).count() == len(rows)
    assert got[1].text == WANT and got[1].n_chars == len(WANT) and got[1].url == "u"
    assert [got[k].text for k in (None, 3, 4)] == [""] * 3 and got[4].n_chars == 0
    assert got[5].n_chars == 5 * 200_000 - 1 and got[6].text == "no tags" and got[7].text == "cut off &am"
    assert extracted(df.limit(0)).count() == 0

"""op2: content region of hand-made pages and of the given pages."""

import html
import re

import pytest

from sitecast.llm import html_extract as H
from sitecast.llm.q_html import op2_html_extract

WEIGHTS = H.weights([("w:p", 900, 3), ("w:h1", 60, 0), ("w:b", 50, 0), ("w:a", 5, 200), ("w:div.frame", 0, 300),
                     ("w:footer", 0, 100), ("p", 100, 3), ("/p", 100, 3), ("b", 10, 0), ("h1", 10, 0), ("/h1", 10, 0),
                     ("div.frame", 0, 20), ("/div.frame", 0, 20), ("footer", 0, 10), ("/footer", 0, 10),
                     ("nav", 0, 10), ("/nav", 0, 10), ("li", 0, 60), ("/li", 0, 60), ("a", 0, 60), ("/a", 0, 60)])
FRAME = ("<nav><ul><li><a href='/'>Home</a></li></ul></nav><header><p>Site name</p></header>"
         "<div class='cookie-notice'><p>We use cookies here.</p></div>")


@pytest.mark.parametrize("page,want", [
    ("", ""), ("plain words only", "plain words only"), ("<p>", ""), ("<!-- open", ""), ("<script>var x = '<p>no</p>';", ""),
    (f"<html><body>{FRAME}<article><h1>Title</h1><p>One  two\n three.</p><p>Four &amp; fi<b>ve</b>&nbsp;&eacute;</p>"
     "<aside>Side</aside><form><p>Mail?</p></form><p>Six<br>seven</p><div class='ad'>Buy now</div><p>End</p>"
     "<section id='comments'><p>Nice post, very nice post.</p></section></article>"
     "<footer>&copy; us</footer></body></html>", "Title One two three. Four & five é Six seven End"),
    # no article: the stretch finds the division
    (f"<body>{FRAME}<div id='content'><h1>News</h1>" + "<p>many good words stand in this paragraph</p>" * 3
     + "</div><div class='sidebar'><p>Other things</p></div><footer>x</footer></body>",
     "News" + " many good words stand in this paragraph" * 3),
    ("<article><p>open paragraph <p>next<b>bold <p>last", "open paragraph next bold last".replace("nextb", "next b").replace(
        "next bold", "nextbold")),
    ("<article><header><h1>Head</h1></header><p>a < b and c</p></article>", "Head a < b and c"),
    ("<ARTICLE><P>Upper</P></ARTICLE></div></span>", "Upper"),
])
def test_hand_made_pages(page, want):
    assert H.extract(page, WEIGHTS) == want


@pytest.mark.parametrize("mark", ["layout has-sidebar", "with-comments", "no-ads", "search-result", "share-price", "widget"])
def test_wrapper_of_an_article_is_no_frame(mark):
    body = "<article><h1>Head</h1><p>some words of the article</p></article>"
    assert H.extract(f"<body>{FRAME}<div class='{mark}'>{body}</div></body>", WEIGHTS) == "Head some words of the article"


def test_marks_are_whole_names():
    page = ("<article><h2 id='notice-period'>Notice period</h2><section id='social-impact'><p>it has an impact</p></section>"
            "<p data-id='share-1'>shares rose</p><p title='an id=ad there'>last</p><div class='box ad'>Buy</div></article>"
            "<section id='comments'><article><p>Nice post, nice post</p></article></section>")
    assert H.extract(page, WEIGHTS) == "Notice period it has an impact shares rose last"


FRAMES = ["comment-list", "comments-area", "user-comments", "reader-comments", "comments-section", "ad-container", "ad-slot",
          "advert-box", "sponsored-content", "promo-box", "notice-box", "site-footer", "sidebar-left", "main-nav",
          "commentList", "js-comments wide", "related-posts"]
PROSE = "many good words stand in this paragraph"


@pytest.mark.parametrize("mark", FRAMES)
@pytest.mark.parametrize("learned", [True, False])
def test_compound_names_of_frames(mark, learned):
    weight = WEIGHTS if learned else {}
    extra = f"<div class='{mark}'><p>{'other words that are not the story ' * 3}</p></div>"
    story = f"<h1>News</h1><p>{PROSE}</p><p>{PROSE}</p>"
    want = f"News {PROSE} {PROSE}"
    for body in (f"<article>{story}{extra}</article>", f"<article>{story}</article>{extra}",
                 f"<main><article>{story}</article>{extra}</main>", f"<div id='content'>{story}{extra}</div>",
                 f"<div id='content'>{story}</div>{extra}"):
        assert H.extract(f"<html><body>{FRAME}{body}<footer>x</footer></body></html>", weight) == want


@pytest.mark.parametrize("body", [
    "<main><article><p>{0}</p></article><ol class='comment-list'><li><article><p>{1}</p></article></li></ol></main>",
    "<article><p>{0}</p><div id='comments'><article><p>{1}</p></article><article><p>{1}</p></article></div></article>",
    "<article><p>{0}</p><article class='comment'><p>{1}</p></article></article>",
    "<div id='content'><p>{0}</p><p>{0}</p></div><div class='user-comments'><article><p>{1}</p></article></div>",
])
def test_comment_articles_are_no_content(body):
    got = H.extract(f"<body>{FRAME}{body.format(PROSE, 'nice post, a very nice post indeed')}</body>", WEIGHTS)
    assert got in (PROSE, f"{PROSE} {PROSE}")


@pytest.mark.parametrize("mark", ["has-sidebar-left", "no-ads-box", "with-comments-list", "post-content", "main-content", "user-story",
                                  "notice-period", "social-impact", "share-price-list", "section-body"])
def test_other_names_are_no_frames(mark):
    assert H.extract(f"<body>{FRAME}<article><p>{PROSE}</p><div class='{mark}'><p>{PROSE}</p></div></article></body>",
                     WEIGHTS) == f"{PROSE} {PROSE}"


ONE, TWO = "<p>the first story has six words</p>" * 3, "<p>the second has five</p>" * 2
FIRST, SECOND = " ".join(["the first story has six words"] * 3), " ".join(["the second has five"] * 2)


@pytest.mark.parametrize("body,want", [
    (f"<article>{ONE}</article><article>{TWO}</article>", f"{FIRST} {SECOND}"),
    (f"<div id='list'><article>{ONE}</article><article>{TWO}</article></div>", f"{FIRST} {SECOND}"),
    (f"<main>{TWO}<article>{ONE}</article></main>", f"{SECOND} {FIRST}"),
    (f"<div class='lead'>{TWO}</div><article>{ONE}</article>", f"{SECOND} {FIRST}"),
    (f"<main><article>{ONE}</article></main>", FIRST),
])
def test_all_that_the_stretch_covers(body, want):
    assert H.extract(f"<html><body>{FRAME}{body}<footer>x</footer></body></html>", WEIGHTS) == want


def test_best_stretch_against_all_stretches():
    import random
    random.seed(1)
    for _ in range(300):
        s = [random.randint(-5, 5) for _ in range(random.randint(0, 12))]
        lo, hi = H.best_stretch(s)
        assert sum(s[lo:hi]) == max([0, *(sum(s[a:b]) for a in range(len(s)) for b in range(a + 1, len(s) + 1))])


def test_rows(spark):
    pages = spark.createDataFrame([(1, None, None, 7), (None, "u", "<article><p>text</p></article>", 7),
                                   (2, "u", "", 7), (2, "u", "", 7)], "page_id long, url string, html string, text int")
    got = sorted((r.page_id or 0, r.text) for r in H.main_text(pages).collect())
    assert got == [(0, "text"), (1, ""), (2, ""), (2, "")]
    assert H.main_text(pages.limit(0)).count() == 0


def test_given_pages(spark):
    d = "/root/testdata/sf0.001"
    source = {r.page_id: r.html or "" for r in spark.read.parquet(f"{d}/pages.parquet").collect()}
    rows = op2_html_extract(spark, d).collect()
    assert len(rows) == len(source)
    for r in rows:
        marked = re.search(r"<article>(.*?)(?:</article>|\Z)", source[r.page_id], re.S)[1]
        plain = re.sub(r"<[^>]+>", "", re.sub(r"</?(p|h1|br)[^>]*>", " ", marked))
        assert r.text == " ".join(html.unescape(plain).split())
        assert r.n_chars == len(r.text)

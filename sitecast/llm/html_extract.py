"""Main text of web pages by the maximum-scoring subsequence.

A page is a sequence of tags and text runs. Every word scores positive and every
tag negative; one linear scan finds the contiguous stretch of highest total. The
weights come from labelled pages, those that mark their content with an article
or main element: a word's weight is the log-odds of its context lying inside the
content, a tag's is minus the log-odds of lying outside. At most
``LABELLED_PAGES`` pages (a documented bound) are counted;
without any the prior weights hold.

The stretch is then aligned to the page's elements: the smallest element that
covers all its text outside the frame is the content, or the article or main
element around it. If only the whole page covers it, the content is the stretch
with every article and main element that it touches. Elements of the page's frame (menus, headers, footers,
sidebars, notices, adverts, forms, scripts, comments) go wherever they stand.
References are decoded, white space inside a block becomes one blank, and the
blocks are joined by one blank in page order.

Defined results: a null or empty page, or one without text, gives the empty text;
a null page_id or url is kept; repeated rows are extracted each; broken markup
never fails (an open tag or comment at the end is dropped, a stray end tag is
ignored); pages of any length are read whole; extra columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitecast.llm.common import bounded_sample, ship

LABELLED_PAGES = 2000

#: Element names of HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe noembed noframes xmp".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rt rp s samp "
             "small span strike strong sub sup time tt u var wbr img".split())
BLOCK = set("address article aside blockquote body br button canvas caption center col colgroup dd details dialog dir "
            "div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
            "main menu nav noscript ol optgroup option p pre section select summary svg table tbody td template "
            "tfoot th thead tr ul".split())
CLOSES_P = BLOCK - {"br", "button", "option", "optgroup", "caption", "col", "colgroup", "tbody", "td", "tfoot", "th",
                    "thead", "tr", "svg", "canvas", "select", "head", "body", "html"}
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
                "th": {"td", "th"}, "option": {"option"}}
FRAME = set("nav footer aside form menu dialog button select noscript template svg canvas head object audio video".split())
#: Words of class, id and role that mark parts of the frame.
FRAME_WORDS = set("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie "
                  "cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription "
                  "signup sidebar aside menu nav navbar navigation breadcrumb breadcrumbs toolbar pagination pager "
                  "footer comment comments respond reply replies disqus share sharing social related recommended "
                  "widget login search contentinfo complementary".split())
HEADER_WORDS = {"header", "masthead", "topbar"}
#: Words that say nothing about an element beside a frame word
#: (``comment-list``, ``site-footer``, ``ad-container``).
NEUTRAL_WORDS = set("area areas articles bar block body bottom box button buttons center container content form global "
                    "group holder icons inner item items js left links list main outer panel posts primary reader "
                    "readers right secondary section site slot stories thread top unit user users wrap wrapper".split())
#: Frame words of what is never main text, an article in it neither.
HARD_WORDS = set("ad ads adv advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr "
                 "comment comments respond reply replies disqus related recommended".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
                   r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
MARKS = {"class", "id", "role"}
CONTENT = {"article", "main"}
WORDS = re.compile(r"[a-z]+")
HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")


class Element:
    __slots__ = ("name", "kind", "parent", "own", "hard", "frame", "content")

    def __init__(self, name: str, kind: str, parent: Element | None, frame: bool, hard: bool):
        self.name, self.kind, self.parent = name, kind, parent
        self.own, self.hard = frame, hard
        self.frame = frame or bool(parent and parent.frame)
        self.content = name in CONTENT or bool(parent and parent.content)


def frame_mark(token: str, frame_words: set[str], name: str) -> set[str]:
    """The frame words of one class, id or role name if it marks a frame: all
    its words are frame words, or frame words beside neutral ones. Any other
    word (``has-sidebar``, ``notice-period``, ``search-result``) takes the name
    out, and a heading needs a whole name."""
    words = set(WORDS.findall(HUMP.sub("-", token).lower()))
    found = words & frame_words
    rest = words - found
    return found if found and (not rest or name not in HEADINGS and rest <= NEUTRAL_WORDS) else set()


def kind_of(name: str, attributes: str, inside_content: bool) -> tuple[str, bool, bool]:
    """Feature name of an element, whether it belongs to the frame, and whether
    it is a frame that no main text can stand in. A header inside the content is
    the content's own; an article inside another is a comment if marked so."""
    shown = name if name in BLOCK or name in INLINE or name in RAW else "other"
    if name in FRAME or name == "header" and not inside_content:
        return shown, True, False
    nested = name == "article" and inside_content
    if "=" in attributes and (nested or name not in ("html", "body", "article", "main")):
        frame_words = HARD_WORDS if nested else FRAME_WORDS if inside_content else FRAME_WORDS | HEADER_WORDS
        for m in ATTRIBUTE.finditer(attributes):
            if m[1].lower() not in MARKS:
                continue
            for token in (m[2] or m[3] or m[4] or "").split():
                if found := frame_mark(token, frame_words, name):
                    return f"{shown}.frame", True, bool(found & HARD_WORDS)
    return shown, False, False


def parse(page: str) -> Iterator[tuple[str, str, Element | None]]:
    """(feature, text, element) of each tag (empty text) and text run."""
    top: Element | None = None
    pos = 0
    while True:
        m = TOKEN.search(page, pos)
        text = page[pos:m.start() if m else len(page)]
        if text:
            yield f"w:{top.kind if top else 'none'}", text, top
        if not m:
            return
        pos = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:  # an end tag
            at = top
            while at is not None and at.name != name:
                at = at.parent
            if at is not None:
                yield f"/{at.kind}", "", at
                top = at.parent
            elif name in ("p", "br"):
                yield f"/{name}", "", top
            continue
        if name in CLOSES_P or name in SELF_CLOSING:
            drop = SELF_CLOSING.get(name, set()) | ({"p"} if name in CLOSES_P else set())
            at, inside = top, None
            while at is not None and (at.name in INLINE or at.name in drop):
                inside = at if at.name in drop else inside
                at = at.parent
            if inside is not None:
                top = inside.parent
        kind, frame, hard = kind_of(name, m[3] or m[6] or "", bool(top and top.content))
        element = Element(name, kind, top, frame or name in RAW, hard)
        yield kind, "", element
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, pos)
            pos = close.end() if close else len(page)
        elif name not in VOID and not (m[3] or m[6] or "").rstrip().endswith("/"):
            top = element


#: Their content is never shown as it stands.
HIDDEN = {"template", "head", "object", "svg"}


def parsed(page: str) -> list[tuple[str, str, Element | None]]:
    """The items of a page. If its only article or main elements lie inside
    frame elements, those are wrappers: their frame does not pass on to them,
    unless it is one of comments, adverts or the like."""
    items = list(parse(page))
    elements = list({id(e): e for _, _, e in items if e is not None}.values())
    marked = [e for e in elements if e.name in CONTENT]
    if marked and all(e.frame for e in marked):
        for e in elements:
            up = e.parent
            free = e.name in CONTENT and not e.own and not (up and up.content)
            while free and up is not None:
                free, up = up.name not in HIDDEN and not up.hard, up.parent
            e.frame = e.own or not free and bool(e.parent and e.parent.frame)
    return items


def count_features(page: str) -> tuple[Counter, Counter] | None:
    """Counts of each feature inside and outside the content of a labelled
    page: words for text features, tags for the others."""
    inside, outside = Counter(), Counter()
    found = False
    for feature, text, element in parsed(page):
        good = element is not None and element.content and not element.frame
        good = good and not (not text and element.name in ("article", "main"))
        found |= good
        (inside if good else outside)[feature] += len(text.split()) if text else 1
    return (inside, outside) if found else None


#: Before any labelled page is seen.
PRIOR_WORD, PRIOR_TAG, LEAST, MOST = 1.0, -1.0, 0.01, 4.0


def weights(counts: list[tuple[str, int, int]]) -> dict[str, float]:
    """Weight of each feature from its counts inside and outside."""
    total_in = sum(i for f, i, _ in counts if f.startswith("w:")) + 1
    total_out = sum(o for f, _, o in counts if f.startswith("w:")) + 1
    out = {}
    for feature, i, o in counts:
        if feature.startswith("w:"):
            odds = math.log((i + 0.5) / total_in) - math.log((o + 0.5) / total_out)
            out[feature] = min(MOST, max(LEAST, odds))
        else:
            out[feature] = -min(2 * MOST, max(LEAST, math.log((o + 0.5) / (i + 0.5))))
    return out


def best_stretch(scores: list[float]) -> tuple[int, int]:
    """Bounds of the contiguous stretch of highest total, by one scan."""
    best, lo, hi, total, start = 0.0, 0, 0, 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, lo, hi = total, start, i + 1
    return lo, hi


def extract(page: str, weight: dict[str, float]) -> str:
    """The page's main text."""
    items = parsed(page)
    scores = []
    for feature, text, element in items:
        if text:
            n = len(text.split())
            prior = LEAST if element is not None and element.frame else PRIOR_WORD
            scores.append(n * weight.get(feature, prior))
        else:
            scores.append(weight.get(feature, PRIOR_TAG))
    lo, hi = best_stretch(scores)
    if lo == hi:
        return ""
    chosen = align(items, lo, hi)
    blocks: list[str] = []
    run: list[str] = []

    def end_block() -> None:
        if run and (block := " ".join(html.unescape("".join(run)).split())):
            blocks.append(block)
        run.clear()

    for i, (_, text, element) in enumerate(items):
        if not (lo <= i < hi and not chosen[1] or any(within(element, e) for e in chosen[0])):
            continue
        if text:
            if element is None or not element.frame:
                run.append(text)
        elif element is None or element.name not in INLINE:
            end_block()
    end_block()
    return " ".join(blocks)


def within(element: Element | None, outer: Element) -> bool:
    while element is not None and element is not outer:
        element = element.parent
    return element is outer


def align(items: list, lo: int, hi: int) -> tuple[list[Element], bool]:
    """The elements that stand for the stretch, and whether they do so alone;
    if not, the stretch itself belongs to them."""
    path = None
    touched: dict[int, Element] = {}
    for _, text, element in items[lo:hi]:
        if not text or not text.strip() or element is not None and element.frame:
            continue
        chain, at = [], element
        while at is not None:
            chain.append(at)
            at = at.parent
        chain.reverse()
        holder = next((e for e in chain if e.name in CONTENT and not e.frame), None)
        if holder is not None:
            touched[id(holder)] = holder
        if path is None:
            path = chain
        else:
            n = 0
            while n < len(path) and n < len(chain) and path[n] is chain[n]:
                n += 1
            path = path[:n]
    spans = [e for e in path or [] if e.name not in ("html", "body") and e.name not in INLINE]
    around = [e for e in spans if e.name in CONTENT]
    if around:
        return [around[-1]], True
    inner = spans[-1] if spans else None
    if inner is not None and inner.name in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "blockquote", "pre"):
        inner = spans[-2] if len(spans) > 1 else None
    return ([inner], True) if inner is not None else (list(touched.values()), False)


def learn(pages: DataFrame, bound: int = LABELLED_PAGES, key: str = "page_id", page: str = "html") -> dict[str, float]:
    """Feature weights from at most ``bound`` labelled pages. The features are
    element names of HTML, so the table that is collected has a few hundred
    rows at most."""
    ship(pages.sparkSession)
    labelled = bounded_sample(pages.select(key, page).where(F.col(page).rlike("(?i)<(article|main)[ >]")), bound, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, outside = Counter(), Counter()
        for batch in batches:
            for p in batch.column(1):
                if counted := count_features(p.as_py()):
                    inside.update(counted[0])
                    outside.update(counted[1])
        names = sorted(inside.keys() | outside.keys())
        yield pa.RecordBatch.from_pydict({
            "feature": pa.array(names, pa.string()), "inside": pa.array([inside[f] for f in names], pa.int64()),
            "outside": pa.array([outside[f] for f in names], pa.int64())})

    counts = (labelled.mapInArrow(run, "feature string, inside long, outside long")
              .groupBy("feature").agg(F.sum("inside"), F.sum("outside")).collect())
    return weights([tuple(r) for r in counts])


def main_text(pages: DataFrame, weight: dict[str, float] | None = None, key: str = "page_id", url: str = "url",
              page: str = "html") -> DataFrame:
    """key, url, text of every page. ``weight``: what ``learn`` returned; None
    learns from the same pages."""
    ship(pages.sparkSession)
    weight = learn(pages, key=key, page=page) if weight is None else weight

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 500):
                part = batch.slice(lo, 500)
                texts = [extract(p.as_py() or "", weight) for p in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())],
                                                 names=[key, "url", "text"])

    return (pages.select(F.col(key).cast("long").alias(key), F.col(url).cast("string").alias("url"), page)
            .mapInArrow(run, f"{key} long, url string, text string"))

"""Main text of web pages by the maximum-scoring subsequence.

A page is read as words and tags. Words score positive and tags negative, and words in elements that labelled pages
have outside the main text score below zero; one linear scan finds the contiguous region with the highest sum. The main
text is that region's text blocks, without those that score below zero: what stands between an article's words is not a
part of it.

An element is judged by its tag, by what is in it (the share of words in links, sentences) and by the words of its class
and id, each seen together with what is in the element: a ``related`` full of links is another thing than one of
sentences. An article or main element begins anew: what is around it and what it is called says nothing about it. The
weights are learned from labelled pages, in which ambiguous names stand on both sides.
"""

from __future__ import annotations

import html as entities
import math
import random
import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.llm.common import map_batches, named

#: Comments, elements whose content is not text, and tags; quotes may hold ``>``.
MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|iframe|svg|select|object|canvas|title)\b(?:[^>"']|"[^"]*"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<[!?/][^>]*>|<[a-zA-Z][^>]*(?:>|\Z)""",
    re.S | re.I,
)
#: One whole attribute: its name and its value, quoted or not.
ATTRIBUTE = re.compile(r"""([^\s"'=<>/]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
#: Words of a name such as side-bar, side_bar, sideBar or SIDE2.
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SPACE = re.compile(r"\s+")
WORD = re.compile(r"\S+")
#: Tags that stay within a block; all others end one.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
MAIN_TAGS = frozenset(("article", "main"))
#: What is closed by an article or main element, if it was left open.
NEVER_AROUND_MAIN = frozenset("nav header footer form button menu ul ol li p".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
NONE: frozenset[str] = frozenset()
HIDES, MAIN_ONLY, BESIDE = frozenset(("hidden",)), frozenset(("in main",)), frozenset(("beside main",))
#: Ends of sentences and clauses; the least words of prose; the most that an element's names count for, and what is hidden, in log odds.
STOP = re.compile(r"[.!?;:,\u3002\uff0c](?=\s|$)|[\u3002\uff0c]")
LEAST_PROSE, NAMES_COUNT, HIDDEN = 5, 6.0, 20.0
#: Elements whose weights a worker remembers before it forgets them all.
REMEMBERED = 20_000


class Element:
    """An open element and, once it is closed, what is in it: words, words in links, and ends of sentences or clauses."""

    __slots__ = ("attributes", "judged", "links", "main", "name", "parent", "stops", "words")

    def __init__(self, parent: Element | None, name: str, attributes: str):
        self.parent, self.name, self.attributes = parent, name, attributes
        self.main = parent is not None and (parent.main or parent.name in MAIN_TAGS)
        self.words = self.links = self.stops = 0
        self.judged = None

    def make(self) -> str:
        """What is in it: ``linked`` words, ``prose``, or neither."""
        if self.links * 5 > self.words * 2:
            return "linked"
        return "prose" if self.words >= LEAST_PROSE and self.stops * 25 >= self.words and self.links * 4 < self.words else ""


def features(e: Element) -> frozenset[str]:
    """What an element is judged by: its tag, unless it is inline, what is in it, the words of its class, id and role with
    that, and whether it is hidden. The page's own elements, and articles, have none but the last."""
    if e.name in ("html", "body"):
        return NONE
    out, make = set(), e.make()
    if e.name not in INLINE and e.name not in MAIN_TAGS:
        out |= {e.name, f"{e.name} in main" if e.main else e.name, f"{make} in main" if e.main else make} - {""}
    for m in ATTRIBUTE.finditer(e.attributes):
        key, value = m[1].lower(), (m[2] or "").strip("\"'")
        if key in ("class", "id", "role") and e.name not in MAIN_TAGS:
            out.update(f".{w.lower()} {make}" for w in NAME_WORD.findall(value))
        elif key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and re.search(r"display\s*:\s*none", value, re.I):
            out.add("hidden")
    return frozenset(out)


def read(page: str) -> list[tuple[str, str, Element]]:
    """(kind, value, element): kind ``text``, a block's raw text piece; ``in``, an inline tag; or ``tag``.

    Elements left open end with the element around them, paragraphs and list items with the next one.
    """
    top = Element(None, "html", "")
    out, at, open_, names = [], 0, [top], Counter()

    def close(name: str) -> None:
        while names[name]:
            last = open_.pop()
            names[last.name] -= 1
            up = last.parent
            up.words, up.links, up.stops = up.words + last.words, up.links + (last.words if last.name == "a" else last.links), up.stops + last.stops
            if last.name == name:
                return

    def said(text: str) -> None:
        e = open_[-1]
        e.words += len(WORD.findall(text))
        e.stops += len(STOP.findall(text))
        out.append(("text", text, e))

    for m in MARKUP.finditer(page):
        if m.start() > at:
            said(page[at : m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue
        kind = "in" if name in INLINE else "tag"
        if m[2]:
            out.append((kind, name, open_[-1]))
            close(name)
            continue
        if name in MAIN_TAGS:
            while len(open_) > 1 and open_[-1].name in NEVER_AROUND_MAIN:
                close(open_[-1].name)
        elif open_[-1].name == "p" and name not in INLINE or open_[-1].name == name == "li":
            close(open_[-1].name)
        e = Element(open_[-1], name, m[4])
        if name not in VOID and not m[4].endswith("/"):
            open_.append(e)
            names[name] += 1
        out.append((kind, name, e))
    if at < len(page):
        said(page[at:])
    while len(open_) > 1:
        close(open_[-1].name)
    return out


def around(e: Element, beside: bool) -> frozenset[str]:
    """Features of the open elements up to an article or main one; ``beside`` tells that the page has one elsewhere."""
    chain, at = [], e
    while at is not None and at.judged is None:
        chain.append(at)
        at = at.parent
    before = at.judged if at is not None else BESIDE if beside else NONE
    for at in reversed(chain):
        before = at.judged = before & HIDES | MAIN_ONLY if at.name in MAIN_TAGS else before | features(at)
    return before


def has_main(parts: list[tuple[str, str, Element]]) -> bool:
    """Whether article or main elements hold a third of the page's words: then what is beside them is no main text."""
    outer = {id(e): e for _, _, e in parts if e.name in MAIN_TAGS and not e.main}
    top = parts[0][2] if parts else None
    while top is not None and top.parent is not None:
        top = top.parent
    return top is not None and sum(e.words for e in outer.values()) * 3 >= max(1, top.words)


@dataclass(frozen=True)
class Weights:
    """Of elements' features (log odds of main text), of a word in no element, and of each tag; tags never seen get ``other``."""

    features: dict[str, float]
    word: float
    tags: dict[str, float]
    other: float
    #: What tags, and words that are no main text, count inside an article or main element; set, not learned.
    within_main: float = 0.1
    known: dict = field(default_factory=dict, compare=False, repr=False)

    def _sum(self, found: frozenset[str]) -> float:
        """Log odds of a set of features. Names together count no more than ``NAMES_COUNT``, so that they never decide alone."""
        if "hidden" in found:
            return -HIDDEN
        names = sum(self.features.get(f, 0.0) for f in found if f[0] == ".")
        return self.word + sum(self.features.get(f, 0.0) for f in found if f[0] != ".") + max(-NAMES_COUNT, min(NAMES_COUNT, names))

    def odds(self, e: Element, beside: bool) -> float:
        found = around(e, beside)
        if found not in self.known:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            self.known[found] = self._sum(found)
        return self.known[found]

    def read(self, page: str) -> list[tuple[str, str, float, bool]]:
        """(kind, value, odds, in_main) of each part of a page."""
        parts = read(page)
        beside = has_main(parts)
        return [(kind, value, self.odds(e, beside), e.main or e.name in MAIN_TAGS) for kind, value, e in parts]

    def score(self, kind: str, value: str, odds: float, in_main: bool) -> float:
        """Between -1 and 1 a word, below zero a tag. Inside an article what is left out hardly parts what is around it."""
        if kind == "text":
            return len(WORD.findall(value)) * max(-self.within_main if in_main else -1.0, min(1.0, odds))
        return self.tags.get(value, self.other) * (self.within_main if in_main else 1)


def best_region(scores: list[float]) -> tuple[int, int]:
    """First and last index after it of the contiguous run with the highest sum, the first and shortest of equals."""
    best, first, last, run, start = 0.0, 0, 0, 0.0, 0
    for i, s in enumerate(scores):
        if run <= 0:
            run, start = 0.0, i
        run += s
        if run > best:
            best, first, last = run, start, i + 1
    return first, last


def main_text(page: str | None, weights: Weights) -> str:
    """Blocks of the best region joined by two line feeds; empty for null, empty and wordless pages."""
    if not page:
        return ""
    parts = weights.read(page)
    first, last = best_region([weights.score(*part) for part in parts])
    # whole blocks: the region grows to the ends of the blocks in which it begins and ends
    while first and parts[first - 1][0] != "tag":
        first -= 1
    while last < len(parts) and parts[last][0] != "tag":
        last += 1
    blocks, now = [], []
    for kind, value, odds, _ in [*parts[first:last], ("tag", "", 0.0, False)]:
        if kind == "text" and odds > 0:
            now.append(value)
        elif kind == "tag" and value == "br":
            now.append(" ")
        elif kind == "tag":
            text = SPACE.sub(" ", entities.unescape("".join(now))).strip()
            blocks += [text] if text else []
            now = []
    return "\n\n".join(blocks)


#: How pages are built: (tags, names of class or id) of what is main text and what isn't, for the labelled pages.
MAIN_NAMES = "content post-body entry-content article-body story-text main-content page-body text post-content body-copy rich-text".split()
SECTION_NAMES = "section chapter intro summary lead lede abstract body-section columns wide note example result item".split()
#: Names that main text has as well as what is beside it.
AMBIGUOUS = (
    "popular legal comment discussion related related-work share share-price alert tags buttons review feedback poll survey trending ad-hoc "
    "menu-history header logo social search toolbar copyright warning branding rail reply respond recommended"
).split()
ASIDES = (
    (("nav", "div", "ul"), "menu main-nav navbar breadcrumb breadcrumbs toc-nav navigation site-menu pagination pager nav-links".split()),
    (("header", "div"), "site-header masthead top-bar page-header banner login signup".split()),
    (("footer", "div"), "footer site-footer bottom-bar colophon".split()),
    (("aside", "div", "section"), "sidebar side-bar widget related-posts more-stories recent-posts right-rail tag-cloud".split()),
    (("div", "section"), "ad ads advert advertisement advertising ad-slot sponsored sponsor promo promotion promoted ad-banner commercial".split()),
    (("form", "div"), "search-form newsletter subscribe subscription contact-form login-form signup-form".split()),
    (("div", "p", "dialog"), "cookie-notice cookies consent gdpr-banner popup modal notice notices disclaimer overlay toast warning-bar paywall".split()),
    (("div", "ul", "p"), "sharing social-links share-bar follow-us print-tools share-buttons".split()),
    (("div", "section", "ol"), "comments comment-list replies disqus user-comments commentlist comment-section responses".split()),
)


def labelled_pages(n: int = 900, seed: int = 11) -> list[tuple[str, str]]:
    """Pages made from a seed: (html, main text)."""
    rng, pages = random.Random(seed), []

    def word() -> str:
        return "".join(rng.choice("abcdefghilmnoprstuv") for _ in range(rng.randint(2, 9)))

    def words(a: int, b: int) -> str:
        return " ".join(word() for _ in range(rng.randint(a, b)))

    def sentences(a: int, b: int) -> str:
        """Words with the ends of sentences and clauses."""
        out = words(a, b).split()
        for k in range(rng.randint(3, 12), len(out), rng.randint(5, 14)):
            out[k] += rng.choice(".,,;")
        return " ".join(out) + rng.choice(("", ".", ".", ".", "!", "?"))

    def element(tag: str, name: str, inner: str) -> str:
        kind = rng.choice(("class", "class", "id")) if name else ""
        if name and rng.random() < 0.3:
            name += rng.choice((" box", "-wrap", " block", "-container", " clearfix", "-1", " row"))
        return f"<{tag} {kind}='{name}'>{inner}</{tag}>" if name else f"<{tag}>{inner}</{tag}>"

    def links() -> str:
        return "".join(f"<li><a href='/{k}'>{words(1, 3)}</a></li>" for k in range(rng.randint(2, 8)))

    def aside(kind: int | None = None, told: bool = True) -> str:
        """What is no main text. If its name doesn't tell (one never seen, or an ambiguous one), its links do."""
        kind = rng.randrange(len(ASIDES)) if kind is None else kind
        tags, names = ASIDES[kind]
        tag = rng.choice(tags)
        name = rng.choice(names) if tag in ("div", "ul", "ol", "p", "section") or rng.random() < 0.5 else ""
        if not told or rng.random() < 0.25:
            tag, name = rng.choice(("div", "div", "section")), rng.choice((word(), word(), rng.choice(AMBIGUOUS), ""))
            return element(tag, name, rng.choice((f"<ul>{links()}</ul>", f"<h3>{words(1, 3)}</h3><ul>{links()}</ul>", "".join(f"<div><a href='/y'>{words(2, 8)}</a></div>" for _ in range(rng.randint(2, 5))))))
        prose = "".join(f"<p>{sentences(3, 40)}</p>" for _ in range(rng.randint(1, 3)))
        if kind == 8 and tag != "ol":
            inner = "".join(element("div", rng.choice(("comment", "reply", "", "comment-body")), f"<p>{sentences(3, 40)}</p>") for _ in range(rng.randint(1, 4)))
        elif tag == "p":
            inner = sentences(2, 20)
        else:
            inner = rng.choice((f"<ul>{links()}</ul>" if tag not in ("ul", "ol") else links(), words(2, 25), sentences(2, 25), prose, f"<h3>{words(1, 4)}</h3>{prose}", f"<div>{words(1, 5)}</div><a href='/x'>{words(1, 4)}</a>"))
        if tag == "form" or rng.random() < 0.1:
            inner = f"<label>{words(1, 3)}</label><input><button>{words(1, 2)}</button>" + inner * (rng.random() < 0.3)
        if rng.random() < 0.05:  # never shown, whatever it is called
            tag = rng.choice(("div", "section"))
            return f"<{tag} {rng.choice(('hidden', 'aria-hidden=true', 'style=display:none'))}>{prose}</{tag}>"
        return element(tag, name, inner)

    for _ in range(n):
        text: list[str] = []

        def said(a: int, b: int, text: list[str] = text, how: Callable = sentences) -> str:
            text.append(how(a, b))
            return text[-1]

        def part(depth: int = 0, said: Callable = said, text: list[str] = text) -> str:
            k = rng.random()
            if k < 0.46:
                return element("p", rng.choice(("", "", "", "", rng.choice(AMBIGUOUS))), said(1, 90))
            if k < 0.56:
                a, b = words(2, 20), words(1, 4)
                text.append(f"{a} {b}")
                return f"<p>{a} {rng.choice((f'<b>{b}</b>', f'<em>{b}</em>', f'<a href=/x>{b}</a>', f'<span>{b}', f'<b>{b}'))}</p>"
            if k < 0.62:
                return "<{0}>{1}</{0}>".format(rng.choice(("h2", "h3")), said(2, 6, how=words))
            if k < 0.69:
                return element(rng.choice(("ul", "ol")), rng.choice(("", "", rng.choice(AMBIGUOUS))), "".join(f"<li>{said(2, 15)}</li>" for _ in range(rng.randint(2, 5))))
            if k < 0.74:
                return f"<blockquote>{said(8, 30)}</blockquote>"
            if k < 0.79:
                return f"<figure><img src='x'><figcaption>{said(3, 8, how=words)}</figcaption></figure>"
            if k < 0.83:
                return f"<table><tr><td>{said(1, 4, how=words)}</td><td>{said(1, 4, how=words)}</td></tr></table>"
            tag, name = rng.choice(("div", "section")), rng.choice((rng.choice(SECTION_NAMES), rng.choice(AMBIGUOUS), rng.choice(AMBIGUOUS), word(), ""))
            return element(tag, name, "".join(part(depth + 1) for _ in range(rng.randint(1, 3)))) if depth < 2 else f"<p>{said(5, 30)}</p>"

        tag = rng.choice(("article", "article", "main", "div", ""))
        title = f"<h1>{said(3, 9, how=words)}</h1>"
        body = f"<header>{title}</header>" if tag in MAIN_TAGS and rng.random() < 0.3 else title
        body += "".join(part() + (aside(rng.choice((0, 3, 4, 4, 5, 6, 7, 8))) if rng.random() < 0.2 else "") for _ in range(rng.randint(2, 12)))
        body += aside(8) if rng.random() < 0.3 else ""
        before = "".join(aside(k) for k in (0, 1, 4, 6) if rng.random() < 0.6)
        after = "".join(aside(k) for k in (3, 4, 5, 7, 8) if rng.random() < 0.5) + aside(2)
        if tag in MAIN_TAGS and rng.random() < 0.4:  # with an article it may be anything, prose of any name too
            after += element(rng.choice(("div", "section")), rng.choice((word(), rng.choice(AMBIGUOUS))), "".join(f"<p>{sentences(3, 40)}</p>" for _ in range(rng.randint(1, 3))))
        name = rng.choice(MAIN_NAMES) if tag == "div" or rng.random() < 0.4 else ""
        if tag in MAIN_TAGS and rng.random() < 0.4:
            name = rng.choice(("post comments-open has-sidebar", rng.choice(AMBIGUOUS), rng.choice(ASIDES)[1][0]))
        whole = element(tag, name, body) if tag else body
        if tag in MAIN_TAGS and rng.random() < 0.4:
            whole = element("div", rng.choice((rng.choice(AMBIGUOUS), rng.choice(ASIDES)[1][0], word(), "page")), whole)
        pages.append((f"<html><body>{before}{whole}{after}</body></html>", "\n\n".join(text)))
    return pages


def fit_features(pages: list[tuple[str, str]], rounds: int = 400, rate: float = 0.5, shrink: float = 1e-5) -> tuple[dict[str, float], float]:
    """Logistic regression of a text piece's place on the features of the elements around it: (weights, bias)."""
    seen: Counter = Counter()
    for page, text in pages:
        main = set(text.split())
        parts = read(page)
        beside = has_main(parts)
        for kind, value, e in parts:
            if kind == "text" and (own := value.split()) and "hidden" not in around(e, beside):
                inside = sum(w in main for w in own) * 2 > len(own)
                seen[around(e, beside), inside] += min(len(own), 5)
    names = sorted({f for found, _ in seen for f in found})
    at = {f: k for k, f in enumerate(names)}
    x, y, n = np.zeros((len(seen), len(names))), np.zeros(len(seen)), np.zeros(len(seen))
    for row, ((found, inside), count) in enumerate(seen.items()):
        x[row, [at[f] for f in found]], y[row], n[row] = 1, inside, count
    n /= n.sum()
    w, bias, moved, squares = np.zeros(len(names)), 0.5, np.zeros(len(names)), np.full(len(names), 1e-8)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w + bias)))
        g = x.T @ (n * (p - y)) + shrink * w
        squares += g * g
        moved = 0.5 * moved - rate * g / np.sqrt(squares)
        w = w + moved
    return dict(zip(names, w.round(4).tolist(), strict=True)), bias


SCALED_ON = 200


def train(pages: list[tuple[str, str]], scales: tuple[float, ...] = (1.0, 0.7, 0.5, 0.35, 0.25, 0.15, 0.1, 0.05)) -> Weights:
    """Features' weights by logistic regression; tags' by their log odds of standing in main text, kept below zero.

    Tags are scaled against words by the factor under which most of the first ``SCALED_ON`` labelled pages come out whole.
    """
    weights, bias = fit_features(pages)
    inside, outside = Counter(), Counter()
    judge = Weights(weights, bias, {}, 0.0)
    for page, _ in pages:
        for kind, value, odds, _ in judge.read(page):
            (inside if odds > 0 else outside).update({"": len(WORD.findall(value))} if kind == "text" else {value: 1})
    odds_of = lambda k: math.log((inside[k] + 1) / (outside[k] + 1)) - math.log((sum(inside.values()) + 1) / (sum(outside.values()) + 1))
    tags = {k: min(-0.05, odds_of(k)) for k in sorted({*inside, *outside}) if k}
    other = min(tags.values(), default=-1.0) / 2

    def at(scale: float) -> Weights:
        return Weights(weights, bias, {k: scale * v for k, v in tags.items()}, scale * other)

    return at(max(scales, key=lambda c: sum(main_text(page, at(c)) == text for page, text in pages[:SCALED_ON])))


_DEFAULT: list[Weights] = []


def default_weights() -> Weights:
    if not _DEFAULT:
        _DEFAULT.append(train(labelled_pages()))
    return _DEFAULT[0]


def extract(pages: DataFrame, weights: Weights | None = None, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(id, url, text, n_chars) of every page, without a shuffle.

    Null, empty and wordless html gives an empty text. Repeated rows each come back, null ids and
    urls stay, ids may be of any type, other columns are not read, an empty table gives an empty table.
    Pages of any length are read whole, in one pass. Unclosed tags, comments and scripts end where a
    browser would end them, or with the page.
    """
    weights = weights or default_weights()

    def setup():
        def work(pages):
            return None, {"text": [main_text(p, weights) for p in pages]}

        return work

    given = pages.select(named(id).alias("id"), named(url).alias("url"), named(html).cast("string").alias("html"))
    found = map_batches(given, setup, [("text", "string")], carried=2)
    return found.select(F.col("id").alias(id), F.col("url").alias(url), "text", F.length("text").cast("long").alias("n_chars"))

"""Main text of web pages by a tree-structured graphical model over the DOM.

Every element has a hidden state: structure (holds boxes of both kinds), content, a box
of boilerplate, or the inside of such a box.  Parent-child potentials connect the states along the tree and node
potentials tie a state to what is seen of the element (tag, class and id words, how
much text stands in it and how much of that is links).  Sum-product messages go up
from the leaves and down from the root and give the exact marginals; text whose
element is more likely content than boilerplate is kept.

Potentials are estimated by counting on labelled pages.  These are composed by rule
from the words that page authors use for boxes (:func:`labelled_pages`).
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelflife.llm.common import slices

STRUCTURE, CONTENT, BOX, INSIDE = range(4)
BOILER = BOX  # in labels: a box, or the inside of one where the parent is boilerplate

# Elements of the markup language by how a parser treats them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe xmp noembed noframes svg title textarea".split())
FOREIGN = ("svg", "math")  # a slash at the end of the tag makes these two empty
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th "
    "thead tr ul".split())
CLOSES_P = BLOCK - frozenset("body html head caption td th tr tbody thead tfoot option optgroup "
                             "button select legend".split()) | {"table"}
# An opening tag ends an open element of these names, up to the given ones.
IMPLIED_END = {
    "li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)), "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")),
    "tbody": (("tbody", "thead", "tfoot", "tr", "td", "th"), ("table",)),
    "tfoot": (("tbody", "thead", "tfoot", "tr", "td", "th"), ("table",)),
    "option": (("option",), ("select",)), "body": (("head",), ("html",))}

TAG = re.compile(
    r"<(?:!--(?:>|->|.*?(?:-->|--!>|\Z))|[!?][^>]*+(?:>|\Z)|/(?P<end>[a-zA-Z][^\s/>]*+)[^>]*+(?:>|\Z)"
    r"|(?P<start>[a-zA-Z][^\s/>]*+)"
    r"(?P<attrs>(?:[^>=]++|=\s*+\"[^\"]*+(?:\"|\Z)|=\s*+'[^']*+(?:'|\Z)|=)*+)(?P<close>>|\Z))", re.S)
ATTR = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?=[\s=/]|\Z)
    (?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?""", re.I | re.X)
WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")


def cues(attrs: str) -> list[str]:
    """Lower-case words of class, id and role; ``hidden`` for what is not shown."""
    out = []
    for name, value in ATTR.findall(attrs):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            out.append("hidden")
        elif name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                out.append("hidden")
        elif name != "aria-hidden":
            out += {w.lower().rstrip("s") for w in WORD.findall(value)}
    return out


class Page:
    """Elements in document order (a parent stands before its children) and text pieces.

    ``pieces`` lists (element, text); element -1 with no text is a block boundary.
    """

    def __init__(self, html: str):
        self.tags, self.cues, self.parents = ["#root"], [[]], [-1]
        self.own, self.linked = [0], [0]
        self.pieces: list[tuple[int, str]] = []
        self.stack = [0]
        self.open: Counter = Counter()  # how many elements of a name are open
        at, n = 0, len(html)
        while at < n:
            m = TAG.search(html, at)
            text = html[at:m.start()] if m else html[at:]
            if text:
                self._text(text)
            if not m:
                break
            at = m.end()
            if m["end"]:
                self._close(m["end"].lower())
            elif m["start"] and m["close"]:
                tag = m["start"].lower()
                if tag in FOREIGN and m["attrs"].endswith("/"):
                    continue
                if tag in RAW:
                    end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                    at = end.end() if end else n
                else:
                    self._open(tag, m["attrs"])
        self.pieces.append((-1, ""))

    def _open(self, tag: str, attrs: str) -> None:
        if tag == "br":
            self.pieces.append((self.stack[-1], " "))
            return
        if tag in CLOSES_P:
            self._end(("p",), ("td", "th", "button", "table", "caption"))
        if tag in IMPLIED_END:
            names, bounds = IMPLIED_END[tag]
            while self._end(names, bounds):
                pass
        if tag in BLOCK:
            self.pieces.append((-1, ""))
        if tag in VOID:
            return
        self.tags.append(tag)
        self.cues.append(cues(attrs) if attrs and not attrs.isspace() else [])
        self.parents.append(self.stack[-1])
        self.own.append(0)
        self.linked.append(0)
        self.stack.append(len(self.tags) - 1)
        self.open[tag] += 1

    def _cut(self, i: int) -> None:
        """Close the open elements from place ``i`` of the stack on."""
        for e in self.stack[i:]:
            self.open[self.tags[e]] -= 1
        del self.stack[i:]

    def _end(self, names: tuple, bounds: tuple) -> bool:
        """End the innermost open element of ``names``, if none of ``bounds`` stands between."""
        if not any(self.open[t] for t in names):
            return False
        for i in range(len(self.stack) - 1, 0, -1):
            tag = self.tags[self.stack[i]]
            if tag in names:
                self._cut(i)
                self.pieces.append((-1, ""))
                return True
            if tag in bounds:
                return False
        return False

    def _close(self, tag: str) -> None:
        if self.open[tag]:
            i = len(self.stack) - 1
            while self.tags[self.stack[i]] != tag:
                i -= 1
            self._cut(i)
        if tag in BLOCK:
            self.pieces.append((-1, ""))

    def _text(self, text: str) -> None:
        if "&" in text:
            text = unescape(text)
        here = self.stack[-1]
        self.pieces.append((here, text))
        size = len(text.strip())
        if size:
            self.own[here] += size
            if any(self.tags[i] == "a" for i in self.stack[-4:]):
                self.linked[here] += size


# ---- the model ---------------------------------------------------------------------

def _bucket(n: int, *steps: int) -> int:
    return sum(n >= s for s in steps)


def features(page: Page) -> list[tuple]:
    """What is seen of each element: its tag and whether it has class words, and a text
    class; the class and id words themselves are in page.cues.

    The text class joins how long the element's own text is with how much of the text
    below it is links.
    """
    total, linked = list(page.own), list(page.linked)
    for i in range(len(total) - 1, 0, -1):
        p = page.parents[i]
        total[p] += total[i]
        linked[p] += linked[i]
    out = []
    for i, tag in enumerate(page.tags):
        share = _bucket(int(100 * linked[i] / total[i]), 20, 60) if total[i] else 3
        out.append(((tag, bool(page.cues[i])), (_bucket(page.own[i], 1, 30, 120), share)))
    return out


class Model:
    """Edge probabilities and, per feature, the log potentials of the four states.

    Below structure come structure, content and boxes, below content come content and
    boxes, and below a box or its inside comes its inside alone.  Elements inside a
    line of text have edges of their own.  The root is structure, or content where a
    page is bare text.
    """

    ROOT = (1.0, 0.01, 1e-4, 0.0)

    def __init__(self):
        self.edge: dict[bool, tuple[float, ...]] = {}  # SS, SC, SX, CC, CX
        self.tag: dict[tuple, list[float]] = {}
        self.word: dict[str, list[float]] = {}
        self.text: dict[tuple, list[float]] = {}

    def learn(self, pages: list[tuple[Page, list[int]]], smooth: float = 0.5) -> "Model":
        edges, states = Counter(), Counter()
        tags, words, texts = Counter(), Counter(), Counter()
        for page, labels in pages:
            for i, (tag, text) in enumerate(features(page)):
                y = labels[i]
                if y == BOILER and i and labels[page.parents[i]] == BOILER:
                    y = INSIDE
                states[y] += 1
                if i and y != INSIDE:
                    edges[tag[0] not in BLOCK, labels[page.parents[i]], y] += 1
                tags[tag, y] += 1
                texts[text, y] += 1
                for w in set(page.cues[i]):
                    words[w, y] += 1

        def table(counts, smooth=smooth):
            keys = {k for k, _ in counts}
            return {k: [math.log((counts[k, y] + smooth) / (states[y] + smooth * (len(keys) + 1)))
                        for y in range(4)] for k in keys}

        self.tag, self.word, self.text = table(tags), table(words, smooth / 10), table(texts)
        for inline in (False, True):
            s = [edges[inline, STRUCTURE, y] + smooth for y in (STRUCTURE, CONTENT, BOX)]
            c = [edges[inline, CONTENT, y] + smooth for y in (CONTENT, BOX)]
            self.edge[inline] = (*(x / sum(s) for x in s), *(x / sum(c) for x in c))
        return self

    def evidence(self, page: Page) -> list[list[float]]:
        """Node potentials, the largest of each element set to 1."""
        out, none = [], (0.0, 0.0, 0.0, 0.0)
        for (tag, text), cue in zip(features(page), page.cues):
            a, b, c, d = self.tag.get(tag, none)
            w, x, y, z = self.text.get(text, none)
            a, b, c, d = a + w, b + x, c + y, d + z
            for word in cue:
                w, x, y, z = self.word.get(word, none)
                a, b, c, d = a + w, b + x, c + y, d + z
            m = max(a, b, c, d)
            out.append([math.exp(a - m), math.exp(b - m), math.exp(c - m), math.exp(d - m)])
        return out

    def marginals(self, page: Page) -> list[tuple[float, float, float, float]]:
        """P(state) of every element by sum-product on the tree."""
        node = self.evidence(page)
        node[0] = [p * r for p, r in zip(node[0], self.ROOT)]
        edges = [self.edge[tag not in BLOCK] for tag in page.tags]
        n, parents = len(node), page.parents
        up = [None] * n  # message of an element to its parent
        for i in range(n - 1, 0, -1):  # children come before their parent
            a, b, c, d = node[i]
            ss, sc, sx, cc, cx = edges[i]
            p, q = ss * a + sc * b + sx * c, cc * b + cx * c
            m = p + q + d
            up[i] = p, q, d = p / m + 1e-12, q / m + 1e-12, d / m + 1e-12
            own = node[parents[i]]
            a, b, c, e = own[0] * p, own[1] * q, own[2] * d, own[3] * d
            m = max(a, b, c, e)
            own[:] = a / m, b / m, c / m, e / m
        # ``node`` now holds evidence and all messages from below; go down from the root
        out: list = [None] * n
        for i in range(n):
            a, b, c, d = node[i]
            if i:
                ss, sc, sx, cc, cx = edges[i]
                s, t, x, y = out[parents[i]]
                p, q, r = up[i]
                s, t, box = s / p, t / q, (x + y) / r
                a, b, c, d = a * ss * s, b * (sc * s + cc * t), c * (sx * s + cx * t), d * box
            m = a + b + c + d
            out[i] = (a / m, b / m, c / m, d / m) if m else (0.25,) * 4
        return out


def extract(html: str, model: Model) -> str:
    """The main text: kept blocks in page order, one a line; "" if none.

    White space inside a block is what Unicode calls so, no-break and ideographic spaces
    included; it becomes one space.
    """
    page = Page(html)
    keep = [p[CONTENT] >= p[BOX] + p[INSIDE] for p in model.marginals(page)]
    blocks, block = [], []
    for i, text in page.pieces:
        if i >= 0:
            if keep[i]:
                block.append(text)
        elif block:
            line = " ".join("".join(block).split())
            if line:
                blocks.append(line)
            block = []
    return "\n".join(blocks)


# ---- labelled pages -----------------------------------------------------------------

# Words that page authors use in class and id, by kind of box.
CONTENT_WORDS = ("article", "article-body", "post", "post-content", "entry", "entry-content",
                 "story", "story-text", "content", "main", "main-content", "text", "body", "single")
WRAPPER_WORDS = ("page", "wrapper", "container", "site", "row", "column", "layout", "grid", "inner",
                 "outer", "app", "root")
INNER_WORDS = ("lead", "intro", "caption", "byline", "author", "title", "headline", "subtitle", "date",
               "para", "highlight", "quote", "figure", "image", "section", "dropcap", "heading")
BOILER_WORDS = {
    "menu": ("menu", "nav", "navbar", "navigation", "breadcrumb", "topnav", "links", "sitemap",
             "pagination", "toc", "skip", "tabs"),
    "header": ("header", "masthead", "topbar", "branding", "logo", "banner", "site-header", "hero"),
    "footer": ("footer", "copyright", "colophon", "bottom", "legal", "site-footer", "imprint"),
    "sidebar": ("sidebar", "side", "rail", "widget", "related", "recommended", "popular",
                "trending", "aside", "more", "tags", "author-box", "teaser"),
    "notice": ("notice", "cookie", "consent", "alert", "gdpr", "privacy", "newsletter", "paywall",
               "popup", "modal", "disclaimer", "warning", "message", "overlay", "subscribe", "toast"),
    "advert": ("ad", "ads", "advert", "advertisement", "adsense", "sponsor", "sponsored", "promo",
               "promotion", "commercial", "affiliate", "adslot", "adbox"),
    "form": ("form", "search", "login", "signup", "register", "contact", "feedback", "poll"),
    "comments": ("comments", "comment", "replies", "reply", "discussion", "disqus", "respond",
                 "comment-list", "reviews", "thread"),
    "share": ("share", "sharing", "social", "follow", "print", "toolbar", "buttons"),
    "hidden": ("hidden",)}
# Elements that hold such boxes.
BOILER_TAGS = {"menu": ("nav", "nav", "ul", "div", "menu"), "header": ("header", "header", "div"),
               "footer": ("footer", "footer", "div"), "sidebar": ("aside", "aside", "div", "section"),
               "notice": ("div", "section", "p", "dialog", "aside"),
               "advert": ("div", "aside", "ins", "section", "p"),
               "form": ("form", "form", "div"), "comments": ("section", "div", "ol", "ul"),
               "share": ("div", "ul", "p"), "hidden": ("div", "span", "p")}


def labelled_pages(n: int = 400, seed: int = 7) -> list[tuple[Page, list[int]]]:
    """Pages with the state of each element, composed by rule."""
    rng = random.Random(seed)

    def said(low, high):
        return " ".join("w" * rng.randint(2, 9) for _ in range(rng.randint(low, high))) + "."

    def attrs(words, chance=0.85):
        if rng.random() > chance:
            return ""
        name = rng.choice(("class", "class", "id"))
        own = rng.choice(words)
        if rng.random() < 0.2:
            own += " x" + str(rng.randint(1, 9))
        return f' {name}="{own}"'

    def mark(state, html):
        """Opening tags without a mark get their state as first attribute."""
        return re.sub(r"<([a-z]\w*+)(?! s\d)", rf"<\1 s{state}", html)

    def links(k):
        return "".join(f'<li><a href="/x">{said(1, 3)}</a></li>' for _ in range(k))

    def boiler(kind):
        tag = rng.choice(BOILER_TAGS[kind])
        plain = tag in ("nav", "footer", "aside", "header", "form", "dialog", "menu")
        own = attrs(BOILER_WORDS[kind], 0.5 if plain else 1.0)
        if kind == "menu" or kind == "share" or kind == "sidebar" and rng.random() < 0.5:
            inner = links(rng.randint(2, 8))
            inner = inner if tag in ("ul", "menu") else f"<ul>{inner}</ul>"
        elif kind == "header":
            inner = rng.choice((f"<h1>{said(1, 3)}</h1>", f"<h1>{said(1, 3)}</h1><p>{said(1, 5)}</p>",
                                f"<h1><a href='/'>{said(1, 3)}</a></h1>", f"<a href='/'>{said(1, 2)}</a>",
                                f"<div>{said(1, 3)}</div>", said(1, 3), f"<p>{said(2, 6)}</p>"))
        elif kind == "form":
            inner = rng.choice((f"<label>{said(1, 2)}</label><input><button>{said(1, 2)}</button>",
                                f"<p>{said(2, 6)}</p><select><option>{said(1, 1)}</option></select>"
                                f"<fieldset><legend>{said(1, 2)}</legend></fieldset>"))
        elif kind == "comments":
            item = "li" if tag in ("ol", "ul") else rng.choice(("div", "article", "li"))
            inner = "" if item == "li" else f"<h3>{said(1, 2)}</h3>"
            for _ in range(rng.randint(1, 5)):
                cls = rng.choice(("", ' class="comment"', ' class="reply"'))
                inner += f"<{item}{cls}><b>{said(1, 2)}</b><p>{said(3, 50)}</p></{item}>"
        else:
            inner = rng.choice((said(2, 20), f"<p>{said(2, 25)}</p>", f"<a href='/x'>{said(2, 8)}</a>",
                                f"<h3>{said(1, 4)}</h3><p>{said(3, 25)}</p>", f"<span>{said(1, 8)}</span>"))
            if tag == "p":
                inner = said(2, 20)
        if tag != "p" and kind in ("header", "footer", "sidebar", "notice") and rng.random() < 0.35:
            inner += boiler(rng.choice(("menu", "menu", "form", "share", "sidebar")))
        return mark(BOILER, f"<{tag}{own}>{inner}</{tag}>")

    def paragraph():
        inner = said(1, 80)
        if rng.random() < 0.4:
            t = rng.choice(("b", "i", "em", "strong", "span", "code", "u", "q", "sup", "small",
                            *["a href='/x'"] * 7))
            inner += f" <{t}{attrs(INNER_WORDS, 0.3)}>{said(1, 6)}</{t.split()[0]}> "
            inner += said(1, 10) if rng.random() < 0.8 else ""
            inner = said(0, 3) + inner if rng.random() < 0.8 else inner[inner.index("<"):]
        kind = rng.random()
        if kind < 0.72:
            return f"<p{attrs(INNER_WORDS, 0.25)}>{inner}</p>"
        if kind < 0.80:
            return f"<h{rng.randint(2, 4)}>{said(1, 8)}</h2>".replace("</h2>", "")
        if kind < 0.86:
            return "<ul>" + "".join(f"<li>{said(1, 15)}</li>" for _ in range(3)) + "</ul>"
        if kind < 0.90:
            return f"<blockquote><p>{inner}</p></blockquote>"
        if kind < 0.93:
            return f"<table><tr><th>{said(1, 3)}</th><td>{said(1, 5)}</td></tr></table>"
        if kind < 0.96:
            return f"<figure><img><figcaption>{said(2, 9)}</figcaption></figure>"
        return rng.choice((f"<pre>{inner}</pre>", f"<div>{inner}</div>", f"<section><p>{inner}</p></section>",
                           f"<dl><dt>{said(1, 3)}</dt><dd>{inner}</dd></dl>"))

    def content():
        tag = rng.choice(("article", "article", "main", "div", "div", "section"))
        own = attrs(CONTENT_WORDS, 0.5 if tag in ("article", "main") else 1.0)
        title = f"<h1{attrs(INNER_WORDS, 0.3)}>{said(1, 10)}</h1>"
        if rng.random() < 0.2:
            title += f"<p{attrs(INNER_WORDS, 0.5)}>{said(1, 10)}</p>"
        if rng.random() < 0.15:
            title = f"<header>{title}</header>"
        out = mark(CONTENT, title)
        for _ in range(rng.randint(1, 8)):
            out += mark(CONTENT, paragraph())
            if rng.random() < 0.12:
                out += boiler(rng.choice(("advert", "advert", "share", "sidebar", "notice", "form", "menu")))
        if rng.random() < 0.25:
            out += boiler("comments")
        if rng.random() < 0.25:
            cls = attrs(CONTENT_WORDS, 0.6)
            out = mark(CONTENT, f"<div{cls}>") + out + "</div>"
        return mark(CONTENT, f"<{tag}{own}>") + out + f"</{tag}>"

    def wrap(inner, chance):
        if rng.random() > chance:
            return inner
        return mark(STRUCTURE, f"<div{attrs(WRAPPER_WORDS)}>") + inner + "</div>"

    out = []
    for _ in range(n):
        before = [boiler(k) for k in ("header", "menu", "notice", "advert", "form", "hidden")
                  if rng.random() < 0.5]
        after = [boiler(k) for k in ("sidebar", "share", "comments", "advert", "menu", "notice")
                 if rng.random() < 0.4] + ([boiler("footer")] if rng.random() < 0.8 else [])
        rng.shuffle(before)
        middle = wrap(content() + "".join(after[:1]), 0.4) + "".join(after[1:])
        body = wrap("".join(before) + middle, 0.4)
        if rng.random() < 0.15:  # content without a box of its own
            middle = mark(CONTENT, "".join(paragraph() for _ in range(rng.randint(1, 8))))
            middle += "".join(after) if rng.random() < 0.5 else ""
            before = before if rng.random() < 0.5 else []
            body = wrap("".join(before) + middle, 0.3)
        page = _MarkedPage(mark(STRUCTURE, "<html><body>") + body + "</body></html>")
        out.append((page, page.states))
    return out


class _MarkedPage(Page):
    """Reads the states off the marks that :func:`labelled_pages` leaves in the attributes."""

    def __init__(self, html: str):
        self.states = [STRUCTURE]
        super().__init__(html)

    def _open(self, tag: str, attrs: str) -> None:
        before = len(self.tags)
        super()._open(tag, attrs)
        if len(self.tags) > before:
            m = re.match(r"\s+s(\d)", attrs)
            self.states.append(int(m[1]) if m else self.states[self.parents[-1]])


def trained() -> Model:
    return Model().learn(labelled_pages())


def main_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    Null html is empty text; repeated pages are read each; null ids and urls stay; an
    empty table gives no rows.  White space inside a block (a line break too) is one
    space; blocks without text are left out.
    """
    model = trained()
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    schema = rows.select("page_id", "url", F.lit("").alias("text"),
                         F.lit(0).cast("long").alias("n_chars")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "html"):
            texts = [extract(h, model) for h in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(texts, pa.string()),
                 pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, schema)

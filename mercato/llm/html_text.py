"""Main text of web pages: flat text blocks and a decision tree.

A page is read tag by tag into flat blocks: text between block-level tags,
with its words, the share of its characters inside links, and what encloses
it. Each block is described by its own figures and by the word counts and
link densities of its neighbours, and classified as main text or not by a
decision tree. The tree is trained on a small labelled table, the blocks of
``LABELLED``. Main blocks are joined in page order.

What encloses a block is read from tags, roles and the words in ``class`` and
``id``. Class words are only hints: one that begins with a modifier
(``has-sidebar``, ``no-comments``) says nothing of its own, and a container
whose class reads like a side part is taken for a layout wrapper if the page
has no main part outside such containers and most of its plain words are in
it. A link is an ``a`` with ``href``, up to its end tag or that of the block it
began in.

Inside a block character references are decoded and white space becomes one
space; comments, scripts, styles, drawings, form controls and everything in
the head are no text; formulas are. Broken markup is read as it comes: an end
tag closes the nearest open tag of its name or nothing, an unclosed comment
or script ends with the page. A drawing ends at its end tag, its own '/>' or
a block tag inside it; of other hidden elements without an end tag only the
tag is left out, if browsers read their content as markup or it ends in '/>'.

Null and empty pages give an empty text, rows are independent, an empty
table gives an empty result. Each page is read once from start to end.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.frames import typed
from mercato.llm.trees import Tree

# fixed values: tags that start or end a block, tags whose content is no text, cues in class and id
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
RAW = set("script style iframe textarea title".split())  # up to their end tag, else to the page's end
HIDDEN = [*sorted(RAW), "noscript", "template", "svg", "annotation", "annotation-xml"]  # up to their end tag, if there is one
FOREIGN = {"svg", "annotation", "annotation-xml"}  # '/>' closes them
CONTROLS = set("select button canvas audio video object datalist".split())  # up to their end tag or the next block
SIDE_TAGS = set("nav aside footer form menu dialog fieldset".split())
SIDE_CUES = set(
    "nav navbar navigation menu header masthead footer sidebar aside ad ads advert adverts advertisement adbox banner promo promotion "
    "sponsor sponsored cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup share sharing social "
    "related recommended recommendations breadcrumb breadcrumbs comment comments reply replies respond disqus discussion widget "
    "form login search copyright legal pagination pager tags toolbar skip byline meta disclaimer rail teaser teasers trending".split()
)
MODIFIERS = set("no not non has have with without hide is tag tags category cat type format status".split())
MAIN_CUES = set("article content post entry story main text body prose richtext".split())
MAIN_ROLES, SIDE_ROLES = {"main", "article"}, {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "note"}

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({'|'.join(HIDDEN)})(?=[\s/>])"
    r"""(?:(?:[^<>"']|"[^"<]*"|'[^'<]*')*+>|[^>]*>)"""
    r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']|"[^"<]*"|'[^'<]*')*+)>|</?[a-zA-Z!?][^<>]*>""",
    re.S | re.I,
)
END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in HIDDEN}
BREAKOUT = re.compile(rf"<(?:{'|'.join(sorted(BLOCK))})(?=[\s/>])", re.I)  # ends a drawing, but not inside a foreign object
OBJECT = re.compile(r"<foreignobject(?=[\s/>])", re.I)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
HREF = re.compile(r"\bhref\s*=", re.I)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
WORD = re.compile(r"[^\W_]+")
FEATURES = [
    "words", "links", "words_before", "links_before", "words_after", "links_after",
    "in_main", "in_side", "heading", "item", "paragraph", "sentence", "page_has_main",
]


class Container:
    """An element whose class or id reads like a side part."""

    __slots__ = ("has_main", "words")

    def __init__(self):
        self.has_main, self.words = False, 0


class Block:
    __slots__ = ("text", "linked", "main", "side", "tag", "hints")

    def __init__(self, text: str, linked: int, main: bool, side: bool, tag: str, hints: tuple[Container, ...]):
        self.text, self.linked, self.main, self.side, self.tag, self.hints = text, linked, main, side, tag, hints

    def plain_words(self) -> int:
        return round((self.text.count(" ") + 1) * max(0.0, 1 - self.linked / len(self.text)))


class Place:
    """What encloses a block: its tag, whether it is in a main part, in a side part for sure, and in which hinted ones."""

    __slots__ = ("tag", "main", "side", "hints")

    def __init__(self, tag: str = "", main: bool = False, side: bool = False, hints: tuple[Container, ...] = ()):
        self.tag, self.main, self.side, self.hints = tag, main, side, hints


def _unseen(name: str, value: str) -> bool:
    return name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", ""))


def _inside(tag: str, attributes: str, outer: Place) -> Place:
    """The place that a block tag opens."""
    if tag in ("html", "body"):
        return Place(tag, outer.main, outer.side, outer.hints)
    words: set[str] = set()
    roles: set[str] = set()
    side = outer.side or tag in SIDE_TAGS or (tag == "header" and not outer.main)
    if attributes and ("=" in attributes or "hidden" in attributes):
        for name, value in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name == "role":
                roles.add(value)
            elif name in ("class", "id"):
                for token in value.split():
                    parts = WORD.findall(token)
                    if parts and parts[0] not in MODIFIERS:
                        words.update(parts)
            elif _unseen(name, value):
                side = True
    side = side or bool(roles & SIDE_ROLES)
    hinted = bool(words & SIDE_CUES)
    element = tag in ("article", "main") or bool(roles & MAIN_ROLES)
    main = element or (bool(words & MAIN_CUES) and not hinted)
    hints = (*outer.hints, Container()) if hinted else outer.hints
    if main and not side:
        for container in hints:
            container.has_main = True
    return Place(tag, outer.main or (main and not side), side, hints)


def _settle(found: list[Block]) -> None:
    """Decide which hinted containers are side parts and mark their blocks."""
    outside = 0
    for block in found:
        if not block.side:
            for container in block.hints:
                container.words += block.plain_words()
            if not block.hints:
                outside += block.plain_words()
    clear_main = any(b.main and not b.side and not b.hints for b in found)
    for block in found:
        wrappers = 0 if clear_main else sum(c.has_main and c.words > outside for c in block.hints)
        block.side = block.side or wrappers < len(block.hints)


def _hidden_end(page: str, name: str, at: int, ends: dict[str, tuple[int, int]]) -> int:
    """Where the text goes on after the tag of a hidden element that ends at ``at``; ``ends`` holds the end tags found."""
    closed = page[at - 2] == "/"
    if closed and name in FOREIGN:
        return at
    if ends.get(name, (-1, 0))[0] < at:  # the next end tag is not known
        end = END[name].search(page, at)
        ends[name] = end.span() if end else (len(page) + 1, 0)
    start, stop = ends[name]
    if start > len(page):
        return len(page) if name in RAW and not closed else at
    if name == "svg" and (block := BREAKOUT.search(page, at, start)) and not OBJECT.search(page, at, block.start()):
        return block.start()
    return stop


def blocks(page: str) -> list[Block]:
    """The flat text blocks of a page in order."""
    out: list[Block] = []
    open_tags: list[Place] = []  # of the block tags that are open
    parts: list[str] = []
    linked, in_link, control, at = 0, 0, "", 0  # in_link: one more than the depth at which a link began
    ends: dict[str, tuple[int, int]] = {}

    def end_block() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                place = open_tags[-1] if open_tags else Place()
                out.append(Block(text, linked, place.main, place.side, place.tag, place.hints))
            parts.clear()
        linked = 0

    while m := TOKEN.search(page, at):
        if m.start() > at and not control:
            piece = page[at : m.start()]
            parts.append(piece)
            if in_link:
                linked += len(piece.strip())
        at = m.end()
        if m.group(1):
            at = _hidden_end(page, m.group(1).lower(), at, ends)
        name = m.group(3)
        if not name:
            continue
        name = name.lower()
        if name in CONTROLS:
            if m.group(2):
                control = ""
            elif not m.group(4).endswith("/"):
                control = name
        elif control and name == control and m.group(2):
            control = ""
        elif name == "a":
            in_link = 0 if m.group(2) or not HREF.search(m.group(4)) else len(open_tags) + 1
        elif name == "br":
            parts.append(" ")
        elif name not in BLOCK:
            if not control and not m.group(2) and name not in VOID and not m.group(4).endswith("/") and m.group(4):
                if any(_unseen(n.lower(), v.strip("\"'").lower()) for n, v in ATTRIBUTE.findall(m.group(4))):
                    control = name  # up to its end tag or the next block
        else:
            end_block()
            control = ""
            if m.group(2):
                for i in range(len(open_tags) - 1, -1, -1):
                    if open_tags[i].tag == name:
                        del open_tags[i:]
                        break
            elif not m.group(4).endswith("/") and name != "hr":
                if name in ("p", "li") and open_tags and open_tags[-1].tag == name:
                    open_tags.pop()  # a paragraph or item ends where the next one starts
                open_tags.append(_inside(name, m.group(4), open_tags[-1] if open_tags else Place()))
            if len(open_tags) < in_link - 1:
                in_link = 0
    if at < len(page) and not control:
        parts.append(page[at:])
        if in_link:
            linked += len(page[at:].strip())
    end_block()
    _settle(out)
    return out


def features(found: list[Block]) -> list[list[float]]:
    """A row of ``FEATURES`` per block."""
    words = [float(b.text.count(" ") + 1) for b in found]
    links = [min(1.0, b.linked / len(b.text)) for b in found]
    has_main = float(any(b.main and not b.side for b in found))
    w, k = [0.0, *words, 0.0], [0.0, *links, 0.0]
    return [
        [
            words[i], links[i], w[i], k[i], w[i + 2], k[i + 2], float(b.main), float(b.side),
            float(b.tag[:1] == "h" and b.tag[1:].isdigit()), float(b.tag in ("li", "dt", "dd", "td", "th")),
            float(b.tag in ("p", "blockquote", "pre")), float(b.text[-1] in ".!?:;\"'”’»…)"), has_main,
        ]
        for i, b in enumerate(found)
    ]


_LONG = "The council met on Monday to discuss the new bridge, and after two hours of debate the members agreed to ask for another report before spring."
_SHORT = "Nobody was hurt."
_LINKS = "".join(f"<li><a href='/{w}'>{w}</a></li>" for w in ("Home", "News", "Sports", "Contact us"))
_AD = "Buy two pairs of shoes and get the third one free until the end of the week."
_NOTE = "We use cookies to improve your visit. By going on you accept our terms."
#: pages and, in order, which of their blocks are main text
LABELLED = [
    (f"<body><nav><ul>{_LINKS}</ul></nav><div class='ad'>{_AD}</div><article><h1>Bridge report</h1><p>{_LONG}</p><p>{_SHORT}</p><p>Yes.<p>{_LONG}</article><footer>&copy; 2020 The Paper. All rights reserved.</footer>", "0000" "0" "11111" "0"),
    (f"<header><h1>The Daily Paper</h1><p>{_SHORT}</p></header><main><h2>A bridge</h2><p>{_LONG}</p><ul><li>First, the cost.</li><li>Then the time it takes</li></ul><p>{_LONG}</p></main><aside><h3>Most read</h3><p>{_LONG}</p></aside>", "00" "11111" "00"),
    (f"<div id='cookie-notice'><p>{_NOTE}</p></div><div class='post-content'><h1>Title</h1><p>{_LONG}</p><blockquote>{_SHORT}</blockquote><div class='share'>Share this story</div><p>Read <a href='x'>the report of the council</a> too.</p></div><div class='comments'><h3>Comments</h3><p>I was there and I can say that it was the best debate in years, well done to all of them.</p></div>", "0" "111" "0" "1" "00"),
    (f"<table><tr><td><a href=a>Home</a></td><td><a href=b>Archive of the years</a></td></tr></table><p>{_LONG}</p><p>{_LONG} {_LONG}</p><p>{_LONG}</p><p><a href=c>Next page</a></p><div>Copyright 1999</div>", "00" "111" "00"),
    (f"<div><a href=x>Home</a> | <a href=y>About us</a></div><div>{_LONG} {_LONG}</div><div>{_LONG}</div><div><a href=z>Top</a></div>", "0110"),
    (f"<article><header><h1>Storm</h1></header><p>{_LONG}</p><aside><p>{_LONG}</p></aside><p>{_SHORT}</p><form><p>Your mail address</p><p>{_NOTE}</p></form><section class='comments'><article><p>{_LONG}</p></article></section></article>", "11" "0" "1" "000"),
    (f"<main><p><a href=q>A linked opening line of the story that goes on for a while.</a></p><p>{_LONG}</p><h2>Why</h2><p>{_SHORT}</p><table><tr><th>Year</th><td>Cost</td></tr></table></main><div class='related'><ul>{_LINKS}</ul><p>{_AD}</p></div><footer><p>{_LONG}</p></footer>", "111111" "0000" "0" "0"),
    (f"<div class='sidebar'><h3>Archive</h3><ul>{_LINKS}</ul><p>{_LONG}</p></div><div id='content'><p>{_SHORT}</p><p>One</p><p>{_LONG}</p></div><div class='footer'>Contact</div>", "0" "0000" "0" "111" "0"),
    (f"<div>Login</div><div><a href=1>Sports and more</a></div><h1>Harvest</h1><p>{_LONG}</p><p>{_LONG}</p><h2>Outlook</h2><p>{_LONG}</p><div>Terms</div>", "00" "11111" "0"),
    ("<p>The shop opens at nine.</p><p>It closes at five on most days of the week.</p>", "11"),
    ("A page of plain text that has no tags at all but reads like a sentence.", "1"),
    ("<p>Back soon</p>", "1"),
    ("<p>Back soon</p><p>See you then</p><p>or call</p>", "111"),
    ("<article>Back soon</article>", "1"),
    (f"<aside><p>{_AD}</p></aside><article>See you</article><aside><p>{_AD}</p></aside>", "010"),
    (f"<nav><ul>{_LINKS}</ul></nav><article><h1>A</h1><p>One</p><p>Two</p></article><footer><p>{_LONG}</p></footer>", "0000" "111" "0"),
    ("<main><div>Lost</div><div>and found</div><ul><li>a</li><li>b c</li></ul></main><div>Imprint</div>", "1111" "0"),
    (f"<main><div>{_LONG}</div><div>and then</div><div>it ended</div></main><div>Contact</div>", "111" "0"),
    (f"<div class='ad'><p>One</p><p>{_LONG}</p></div><article><div>Two words</div><p><a href=z>a link</a></p><p>{_LONG}</p></article>", "00" "111"),
    ("<div><a href=1>Home</a></div><p>It rained for two days and then the sun came out.</p><p>Nobody minded.</p><div>Imprint</div>", "0110"),
    ("<h1>Notes</h1><p>We met at the station.</p><p>The train was late, so we went home</p>", "111"),
    ("<div>Menu</div><div>Login</div><h1>Notes</h1><p>We met at the station.</p><p>It was late.</p><div>Imprint</div><div>Terms of use</div>", "0011100"),
    (f"<div class='main'><p>{_SHORT}</p><p>Yes</p><p>{_AD}</p></div><p>{_AD}</p>", "1110"),
    ("<div><a href=1>One</a></div><div><a href=2>Two links here</a></div><div>Menu</div>", "000"),
    (f"<div class='layout has-sidebar'><nav><ul>{_LINKS}</ul></nav><article><h1>A</h1><p>{_LONG}</p></article><div class='sidebar'><p>{_AD}</p></div></div>", "0000" "11" "0"),
    (f"<div class='page sidebar-right'><div class='content'><h1>A</h1><p>{_LONG}</p></div><div class='sidebar'><p>{_AD}</p></div></div><footer>Imprint</footer>", "11" "0" "0"),
    (f"<nav><a href=1>Home</a></nav><article><p>First.</p><div class='banner'>{_AD}</div><p>Two</p></article>", "0" "101"),
    (f"<nav><a href=1>Home</a></nav><main><h1>A</h1><p>{_LONG}</p><div class='banner'>{_AD}</div><p>Two</p><div>three</div></main><div>Imprint</div>", "0" "110" "11" "0"),
    (f"<div><h1>A</h1><p>{_LONG}</p><p>{_LONG}</p></div><section class='comments'><article><p>{_LONG}</p></article></section>", "111" "0"),
]


@lru_cache(maxsize=1)
def train(depth: int = 7) -> Tree:
    """The decision tree of the labelled table."""
    x, y = [], []
    for page, labels in LABELLED:
        rows = features(blocks(page))
        if len(rows) != len(labels):
            raise ValueError(f"{len(rows)} blocks, {len(labels)} labels")
        x += rows
        y += [float(c) for c in labels]
    return Tree(depth, min_leaf=1).fit(np.array(x), np.array(y))


def main_texts(pages: list[str], tree: Tree) -> list[str]:
    found = [blocks(p) for p in pages]
    rows = [r for f in found for r in features(f)]
    keep = iter((tree.predict(np.array(rows)) > 0.5).tolist() if rows else [])
    return ["\n".join(b.text for b in f if next(keep)) for f in found]


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    schema, tree = typed("page_id long, url string, text string, n_chars long"), train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                texts = main_texts([p or "" for p in part.column(2).to_pylist()], tree)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=schema.fieldNames(),
                )

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, schema)


def empty_share(extracted: DataFrame) -> DataFrame:
    """``pages, empty, share``: how many pages gave no text, the first thing to look at on an unknown crawl."""
    empty = F.count_if(F.col("n_chars") == 0)
    return extracted.agg(F.count("*").alias("pages"), empty.alias("empty"), F.try_divide(empty, F.count("*")).alias("share"))

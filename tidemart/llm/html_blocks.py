"""Web pages as flat lists of text blocks with what the classifier looks at."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>=]|=\s*"[^"]*"|=\s*'[^']*'|=)*+)>|<[/!?][^>]*>|([^<]+|<)""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([A-Za-z-]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

# Element names by what they do to the text around them.
BLOCK = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main
    menu nav ol p pre section summary table tbody td tfoot th thead title tr ul""".split()
)
HEADING = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
# Their content is no text; it ends at the closing tag and at nothing else.
RAW = frozenset(("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"))
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
# Controls and fallbacks, whose text is not part of the page's text.
UNSEEN = frozenset("button select option datalist svg math template noscript object audio video canvas head".split())
# What can stand in a head; anything else ends it, with or without its closing tag.
IN_HEAD = frozenset("base head link meta noscript script style template title".split())
SPACE = frozenset(("br", "wbr", "img", "input"))
# Closed by the next one of the same kind.
IMPLIED = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th")}
IMPLIED |= {"td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

# Marks of containers. Text in LASTING ones stays apart even within an article of its own, as reader
# comments and teasers often have; an article or main element ends the reach of the others.
LASTING = frozenset(
    "aside comment comments reply replies discussion disqus respond related recommended recommendations".split()
)
APART = LASTING | frozenset(
    """ad ads advert advertisement adverts advertising alert banner breadcrumb breadcrumbs byline complementary
    consent contentinfo cookie cookies copyright dialog footer form gdpr header legal links login masthead menu
    meta modal nav navbar navigation newsletter notice notices notification overlay pager pagination popup
    promo promoted promotion search share sharing sidebar signup skip social sponsor sponsored subscribe subscription
    tags teaser toolbar topbar widget""".split()
)
MAIN = frozenset("article main content entry post story".split())
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_PARTS = re.compile(r"[^a-z0-9]+")

# Names that within an article say what its text is about, or are part of it.
_OF_ARTICLE = frozenset("header byline social legal search links dialog meta".split())
# Names that tell how a container looks, not what it is.
_STATES = frozenset("has no not with without is".split())
# Parts at the end of a name that say nothing of what is in the container.
_WRAPPERS = frozenset(
    """area block box buttons container group holder inner items list outer panel posts section slot thread widgets
    wrap wrapper""".split()
)
# One word for a mark and a wrapper, or for a place and a mark, such as commentlist or topnav.
_MARKED_START = ("comment", "comments", "advert", "sponsor", "cookie", "sidebar", "newsletter", "breadcrumb", "navbar")
_MARKED_END = ("nav", "menu", "comments", "sidebar", "footer", "banner")

# Where a block stands. A container that is only named like a main part counts as one in pages without
# an article or main element.
NEUTRAL, IN_NAMED, IN_MAIN, IN_APART, IN_LASTING = range(5)


@dataclass(slots=True)
class Block:
    """A run of text between block elements: its words, those within links, and where it stands."""

    text: str
    words: int
    link_words: int
    place: int
    heading: bool


_MARKING = frozenset(("nav", "footer", "aside", "form", "header", "dialog", "menu", "article", "main"))


def _named(value: str) -> Iterator[str]:
    """The marks among the names of a class or id, and its words that mark main parts.

    A name is a mark as a whole, or by its last part that is no mere wrapper: ``cookie-notice`` and
    ``comments-area`` are, ``has-sidebar`` and ``content-sidebar-wrap`` are not.
    """
    for name in value.split():
        # Of block__element--state the block counts too.
        for one in {name, re.split("__|--", name)[0]}:
            parts = [part for part in _PARTS.split(_CAMEL.sub(" ", one).lower()) if part]
            yield from MAIN.intersection(parts)
            if not parts or (len(parts) > 1 and parts[0] in _STATES):
                continue
            n_parts = len(parts)
            while len(parts) > 1 and parts[-1] in _WRAPPERS:
                parts.pop()
            last = parts[-1]
            if len(parts) < n_parts and MAIN.intersection(parts) and last not in LASTING:
                continue
            yield last
            yield from (mark for mark in _MARKED_START if last.startswith(mark) and last[len(mark) :] in _WRAPPERS)
            yield from (mark for mark in _MARKED_END if last.endswith(mark))


def _mark(tag: str, attributes: str, outer: int) -> int:
    """What an element says of the text in it. The header of an article is part of it."""
    element, names, hidden = {tag} & _MARKING, set(), False
    if attributes and tag not in ("html", "body"):
        for name, *values in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), "".join(values)
            if name in ("class", "id", "role"):
                names.update(_named(value))
            elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
                hidden = True
            elif name == "style" and "display:none" in value.lower().replace(" ", ""):
                hidden = True
    if outer in (IN_MAIN, IN_NAMED):
        names -= _OF_ARTICLE
        element.discard("header")
    names |= element
    if hidden:
        names.add("dialog")
    if tag in ("article", "main"):  # classes there often name topics
        names -= APART if names & MAIN - {"article"} else APART - LASTING
    if names & LASTING:
        return IN_LASTING
    if names & APART:
        return IN_APART
    if tag in ("article", "main"):
        return IN_MAIN
    return IN_NAMED if names & MAIN else NEUTRAL


def _inner(outer: int, own: int) -> int:
    """The place within an element, given the place around it."""
    if outer == IN_LASTING or own == NEUTRAL or (own == IN_NAMED and outer != NEUTRAL):
        return outer
    return own


_HREF = re.compile(r"\bhref\s*=", re.IGNORECASE)


class _Page:
    def __init__(self):
        self.blocks: list[Block] = []
        self.open: list[tuple[str, int]] = []
        self.n_open: Counter[str] = Counter()
        self.unseen = self.links = 0
        self.parts: list[str] = []
        self.link_words = 0

    def place(self) -> int:
        return self.open[-1][1] if self.open else NEUTRAL

    def end_block(self) -> None:
        if self.parts:
            words = "".join(self.parts).split()
            if words:
                heading = any(tag in HEADING for tag, _ in self.open[-3:])
                block = Block(" ".join(words), len(words), self.link_words, self.place(), heading)
                self.blocks.append(block)
            self.parts, self.link_words = [], 0

    def close(self, tag: str) -> None:
        """Take the innermost such element, and what was left open in it, off the stack."""
        while self.n_open[tag]:
            name, _ = self.open.pop()
            self.n_open[name] -= 1
            self.unseen -= name in UNSEEN
            self.links -= name == "a"
            if name == tag:
                return

    def start(self, tag: str, attributes: str) -> None:
        # The fallbacks in a head hold elements of their own.
        if self.n_open["head"] and (tag == "body" or (tag not in IN_HEAD and self.open[-1][0] == "head")):
            self.close("head")
        if tag in BLOCK:
            self.end_block()
            for name in IMPLIED.get(tag, ()):
                if any(t == name for t, _ in self.open[-2:]):
                    self.close(name)
            if tag != "p" and self.open and self.open[-1][0] == "p":
                self.close("p")
        elif tag == "a" and self.links:
            self.close("a")
        if tag in SPACE:
            self.parts.append(" ")
        # A slash at the end belongs to an unquoted value or says nothing; an anchor that leads nowhere is no link.
        if tag not in VOID and (tag != "a" or _HREF.search(attributes)):
            outer = self.place()
            self.open.append((tag, _inner(outer, _mark(tag, attributes, outer))))
            self.n_open[tag] += 1
            self.unseen += tag in UNSEEN
            self.links += tag == "a"

    def text(self, raw: str) -> None:
        if self.open and self.open[-1][0] == "head" and raw.strip():
            self.close("head")
        if not self.unseen:
            plain = html.unescape(raw) if "&" in raw else raw
            self.parts.append(plain)
            if self.links:
                self.link_words += len(plain.split())


def text_blocks(source: str) -> list[Block]:
    """The blocks of a page in order. Broken markup is read as well as it goes; it never fails."""
    page, at, held, last = _Page(), 0, [], source.rfind(">")
    while at <= last:
        match = _TOKEN.match(source, at)
        at = match.end()
        closing, name, attributes, raw = match.groups()
        if raw is not None:
            held.append(raw)
            continue
        if held:
            page.text("".join(held))
            held = []
        if name is None:
            continue
        tag = name.lower()
        if closing:
            if tag in BLOCK:
                page.end_block()
            page.close(tag)
        elif tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.IGNORECASE).search(source, at)
            at = end.end() if end else len(source)
        else:
            page.start(tag, attributes)
    # No markup ends after the last '>'; only a comment may begin there.
    page.text("".join([*held, source[at:].partition("<!--")[0]]))
    page.end_block()
    unnamed = NEUTRAL if any(b.place == IN_MAIN for b in page.blocks) else IN_MAIN
    for block in page.blocks:
        if block.place == IN_NAMED:
            block.place = unnamed
    return page.blocks

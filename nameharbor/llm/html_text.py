"""Blocks of text of an HTML page, each with the containers that it stands in."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

#: Fixed values of HTML: elements that start a block, that have no content, whose content is not markup, and that are
#: never shown as text of the page.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section
summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript iframe xmp noembed noframes".split())
UNSHOWN = frozenset("template svg math object canvas audio video select button datalist map".split())
#: What a list item, term, cell or row that starts ends, and the containers beyond which it ends nothing.
CLOSES = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu", "dir"})),
    **dict.fromkeys(("dt", "dd"), (frozenset({"dt", "dd"}), frozenset({"dl"}))),
    **dict.fromkeys(("td", "th"), (frozenset({"td", "th"}), frozenset({"tr", "table"}))),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})),
    **dict.fromkeys(("tbody", "thead", "tfoot"), (frozenset({"tbody", "thead", "tfoot", "tr", "td", "th", "caption"}), frozenset({"table"}))),
    "option": (frozenset({"option"}), frozenset({"select", "datalist", "optgroup"})),
}
#: Containers deeper than this count as part of the one they stand in, as in browsers.
DEEPEST = 512
#: Containers that are never part of the text; an article within one of the second kind is a teaser or reply.
APART = frozenset("nav footer menu search".split())
NEVER = frozenset("aside dialog".split())
APART_ROLES = frozenset("navigation contentinfo complementary search dialog alertdialog alert banner menu menubar toolbar tablist".split())
#: Containers that are not part of the text unless the text stands within them.
AROUND = frozenset("form fieldset header".split())
#: Words of a class or id that mark reader comments, and those that mark other parts beside the text. The third ones
#: mark nothing within an article, where they name its own head.
REPLIES = frozenset("comment comments commentlist disqus replies respond".split())
BESIDE = frozenset("""ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs consent cookie cookies copyright
footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo promoted promotion
recommended related share sharing sidebar signup skip skyscraper social sponsor sponsored subscribe subscription toolbar widget widgets""".split())
HEADS = frozenset("banner header masthead".split())
#: First parts of a class that say what its element has, not what it is.
HAS = frozenset("has with no without is show hide".split())
MAIN = frozenset({"article", "main"})

_TAG = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"  # a comment, up to the end where it is not closed
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>=]++|=\s*(?:\"[^\"]*\"|'[^']*')?)*+)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s/>"'=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*|[0-9]+")
_DIGITS = re.compile(r"[0-9]+")
PLAIN, TEXT, ASIDE = 0, 1, 2


@dataclass(slots=True)
class Open:
    """An open container. ``state``: within the page's main text, beside it, or neither; ``framed``: it has a class, id or role."""

    tag: str
    frame: str
    state: int
    fixed: bool
    framed: bool


@dataclass(slots=True)
class Block:
    """``words`` are its text without white space; ``declared``: plain prose of an article or main element, ``marked``: its
    containers say that it stands beside the text; ``inside``: it stands in an article or main element, or the page has none."""

    words: list[str]
    frame: str
    marked: bool
    inside: bool
    declared: bool


def names_of(attributes: dict[str, str]) -> list[str]:
    return (attributes.get("class", "") + " " + attributes.get("id", "")).split()


def marks_of(names: list[str]) -> set[str]:
    """The words of class and id names, without those of names like ``has-sidebar``."""
    out: set[str] = set()
    for name in names:
        words = [w.lower() for w in _WORD.findall(name)]
        if words and words[0] not in HAS:
            out.update(words)
    return out


def _opened(tag: str, rest: str, parent: Open) -> Open:
    attributes = {}
    if "=" in rest or "hidden" in rest:
        attributes = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(rest)}
    names, role = names_of(attributes), attributes.get("role", "").lower()
    marks = marks_of(names) if names else set()
    state, fixed = parent.state, parent.fixed
    main = tag in MAIN or role in ("main", "article") or attributes.get("itemprop") == "articleBody"
    if tag in UNSHOWN or "hidden" in attributes or re.search(r"display\s*:\s*none", attributes.get("style", "")):
        state, fixed = ASIDE, True
    elif main:
        if any(n.lower() in REPLIES or n.lower().startswith("comment-") for n in names):
            state, fixed = ASIDE, True
        elif not fixed:
            state = TEXT
    elif tag in ("html", "body"):
        pass
    elif tag in NEVER or marks & REPLIES:
        state, fixed = ASIDE, True
    elif tag in APART or role in APART_ROLES or marks & (BESIDE - HEADS if state == TEXT else BESIDE) or (
            tag in AROUND and not (tag == "header" and state == TEXT)):
        state = ASIDE
    framed = parent.framed and not (main and state == TEXT) or bool(not main and (names or role))
    frame = parent.frame
    if tag not in ("html", "body"):
        frame += "/" + _DIGITS.sub("#", ".".join([tag, *sorted(names)]))
    return Open(tag, frame, state, fixed, framed)


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in their order. White space, and ``<br>``, only part words; character references are decoded."""
    stack = [Open("", "", PLAIN, False, False)]
    found: list[tuple[list[str], Open]] = []
    parts: list[str] = []
    has_main = False

    def flush() -> None:
        if parts:
            words = "".join(parts).split()
            if words:
                found.append((words, stack[-1]))
            parts.clear()

    def read(text: str) -> None:
        parts.append(html.unescape(text) if "&" in text else text)

    at, size = 0, len(page)
    while at < size:
        match = _TAG.search(page, at)
        if match is None:
            read(page[at:])
            break
        if match.start() > at:
            read(page[at:match.start()])
        at = match.end()
        tag = match["name"]
        if tag is None:
            continue
        tag = tag.lower()
        if match["end"]:
            if tag in BLOCKS or tag in UNSHOWN:
                flush()
                depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == tag), 0)
                if depth:
                    del stack[depth:]
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = close.end() if close else size
        elif tag == "br":
            parts.append(" ")
        elif tag in BLOCKS or tag in UNSHOWN:
            flush()
            if stack[-1].tag == "p" and tag not in UNSHOWN:
                del stack[-1]
            if tag in CLOSES:
                ends, bounds = CLOSES[tag]
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in bounds or stack[i].tag in MAIN or stack[i].tag in UNSHOWN:
                        break
                    if stack[i].tag in ends:
                        del stack[i:]
            if tag not in VOID and len(stack) < DEEPEST:
                stack.append(_opened(tag, match["rest"], stack[-1]))
                has_main |= stack[-1].state == TEXT
    flush()
    return [Block(words, place.frame, place.state == ASIDE, place.state == TEXT or not has_main, place.state == TEXT and not place.framed)
            for words, place in found]

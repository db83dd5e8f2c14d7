"""Visible text of HTML in blocks, each with what its markup says about it."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>?""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([^\s"'=/]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))|([^\s"'=/]+)""")

# Element names of HTML by what they hold.
RAW = frozenset("script style title textarea noscript noembed noframes iframe xmp template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NOT_TEXT = frozenset("head svg canvas object audio video select button datalist dialog map".split())
BOILERPLATE = frozenset("nav footer aside form fieldset menu".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
CLOSE_P = BLOCKS - frozenset("body caption html legend option tbody td tfoot th thead tr dd dt li".split())
P_SCOPE = frozenset("html table td th caption object template button".split())
#: An element of the key ends an open element of the value.
ENDS = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "tr": ("tr", "td", "th"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "option": ("option",),
}
LIST_SCOPE = frozenset("ul ol dl table html body div article section".split())
# Words in class, id and role that name what is not the article.
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies consent "
    "disclaimer disqus footer menu modal nav navbar navigation newsletter notice notification pager pagination popup promo "
    "promotion related reply replies respond share sharing sidebar social sponsor sponsored subscribe toolbar widget "
    "masthead alert complementary contentinfo search".split()
)
# Words that go along with those in one name ("ad-box", "right-sidebar"); a name with any other
# word ("comments-open", "social-science") names something else.
GENERIC = frozenset(
    "area bar block body bottom box button buttons container content form group head header heading holder icon icons "
    "inner item items left link links list main outer panel post posts primary right row secondary section signup site "
    "slot tag top unit view wrap wrapper zone".split()
)
#: Words that make an unmarked wrapper of most of a page the story's.
MUCH = 100
#: Inside an article these are part of it.
IN_ARTICLE = frozenset(["alert"])
#: How closely an element, role or property encloses the article.
MAIN, ARTICLE = 1, 2
MARKS = {"main": MAIN, "article": ARTICLE, "articlebody": ARTICLE}
HEADERS = frozenset("header masthead".split())
WHOLE = frozenset("html body main".split())
WORDS = re.compile(r"[a-z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


@dataclass(slots=True)
class Element:
    """``named``: the elements around it, itself included, that a name says are not the article."""

    tag: str
    article: int
    boilerplate: bool
    hidden: bool
    named: tuple[int, ...] = ()


@dataclass(slots=True)
class Block:
    """Text between two block borders. ``article``: ARTICLE or MAIN inside such an element, else 0."""

    text: str
    article: int
    boilerplate: bool
    named: tuple[int, ...] = ()


def _names(attributes: dict[str, str]) -> set[str]:
    """Words of names that consist of known ones only."""
    found: set[str] = set()
    for key in ("class", "id", "role"):
        for name in attributes.get(key, "").lower().split():
            words = set(WORDS.findall(name))
            # "has-sidebar" and "with-menu" speak of something else on the page.
            if words & NAMES and words <= NAMES | GENERIC or words & HEADERS and words <= HEADERS | GENERIC:
                found.update(words)
    return found


def _element(tag: str, raw: str, parent: Element, number: int) -> Element:
    article, boilerplate, hidden, named = parent.article, parent.boilerplate, parent.hidden, parent.named
    names: set[str] = set()
    if raw.strip(" /\t\r\n"):
        attributes: dict[str, str] = {}
        for m in ATTRIBUTE.finditer(raw):
            key = (m[1] or m[5]).lower()
            attributes.setdefault(key, unescape(m[2] or m[3] or m[4] or ""))
        names = _names(attributes)
        if tag not in WHOLE:
            hidden = hidden or "hidden" in attributes
            hidden = hidden or bool(HIDDEN.search(attributes.get("style", "")))
        article = max(article, MARKS.get(attributes.get("role", "").lower(), 0))
        article = max(article, MARKS.get(attributes.get("itemprop", "").lower(), 0))
    article = max(article, MARKS.get(tag, 0))
    if tag not in WHOLE:
        boilerplate = boilerplate or tag in BOILERPLATE or (not parent.article and tag == "header")
        if parent.article == ARTICLE:
            names -= IN_ARTICLE
        if names & NAMES or (not parent.article and names & HEADERS):
            named = (*named, number)
    return Element(tag, article, boilerplate, hidden or tag in NOT_TEXT, named)


def _close(stack: list[Element], tags: tuple[str, ...], scope: frozenset[str]) -> None:
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in tags:
            del stack[k:]
            return
        if stack[k].tag in scope:
            return


def blocks(html: str) -> Iterator[Block]:
    """The visible blocks in page order, white space made single; empty ones are left out.

    A name does not make a wrapper boilerplate that holds more than half of the page's words,
    if these are a marked article's or at least MUCH.
    """
    found = list(_parsed(html))
    words: dict[int, int] = {}
    marked: set[int] = set()
    total = 0
    for b in found:
        if b.boilerplate:
            continue
        n = b.text.count(" ") + 1
        total += n
        for k in b.named:
            words[k] = words.get(k, 0) + n
            if b.article:
                marked.add(k)
    holds = {k for k, n in words.items() if 2 * n > total and (k in marked or n >= MUCH)}
    for b in found:
        b.boilerplate = b.boilerplate or not holds.issuperset(b.named)
        yield b


def _parsed(html: str) -> Iterator[Block]:
    stack = [Element("", 0, False, False)]
    held: list[str] = []
    owner = stack[0]

    def ended() -> Iterator[Block]:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            yield Block(text, owner.article, owner.boilerplate, owner.named)

    at = 0
    while at < len(html):
        mark = html.find("<", at)
        text = html[at:] if mark < 0 else html[at:mark]
        match = TAG.match(html, mark) if mark >= 0 else None
        if mark >= 0 and match is None:
            text += "<"
        if text and not stack[-1].hidden:
            now = stack[-1]
            if (now.article, now.boilerplate, now.named) != (owner.article, owner.boilerplate, owner.named):
                yield from ended()
            owner = stack[-1]
            held.append(unescape(text))
        if mark < 0:
            break
        if match is None:
            at = mark + 1
            continue
        at = match.end()
        tag = (match[2] or match[5] or "").lower()
        if not tag:
            continue
        if tag in BLOCKS or tag == "br":
            # A line break ends no block, but no word goes on over it.
            if tag == "br":
                held.append(" ")
            else:
                yield from ended()
        if match[1] or match[4]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
                if tag not in BLOCKS and stack[k].tag in BLOCKS:
                    break
            continue
        if tag in CLOSE_P:
            _close(stack, ("p",), P_SCOPE)
        if tag in ENDS:
            _close(stack, ENDS[tag], LIST_SCOPE)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(html, at)
            at = end.end() if end else len(html)
            continue
        if tag in VOID:
            continue
        stack.append(_element(tag, match[3] or match[6] or "", stack[-1], at))
    yield from ended()


def title(html: str) -> str:
    found = re.search(r"<title[^>]*>(.*?)</title", html, re.DOTALL | re.IGNORECASE)
    return " ".join(unescape(found[1]).split()) if found else ""

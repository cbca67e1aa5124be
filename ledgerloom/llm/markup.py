"""Pages to blocks of text, tolerant of unclosed and stray tags; one pass over the page."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*+"|'[^']*+')*+)(?:>|\Z)""", re.S
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_SPLIT = re.compile(r"[^a-z0-9]+")

# Element names by their part in a page.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol option optgroup p pre search section select summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
HIDDEN = frozenset("script style textarea title noscript template iframe xmp noembed noframes head svg canvas object audio video math".split())
NOISE = frozenset("nav footer aside form button select datalist dialog menu search label fieldset".split())
CONTENT = frozenset(("article", "main"))
#: Words in class, id and role attributes that mark menus, headers, footers, sidebars, notices, adverts, forms and comments.
NOISE_WORDS = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments complementary consent contentinfo cookie "
    "cookies discussion disqus footer form gdpr login masthead menu menubar modal nav navbar navigation newsletter notice notices notification pagination "
    "popup promo promoted promotion recommended related replies reply search share sharing sidebar signup social sponsor sponsored subscribe toolbar topbar widget".split()
)
#: What an opening element ends, if it is open in the same container.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_HOLDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}


#: Elements deeper than this share the path of their ancestor at this depth, so that paths stay short on broken pages.
DEPTH = 64


class Block(NamedTuple):
    """path: the element names (with their first class) down to the block, to a depth of DEPTH; content: in an article or
    main element."""

    path: str
    text: str
    noise: bool
    content: bool


class _Open(NamedTuple):
    tag: str
    path: str
    depth: int
    hidden: bool
    noise: bool
    content: bool


def _noise(tag: str, attributes: str, inside: bool) -> tuple[bool, str]:
    """Whether an element is noise, and its first class."""
    if not attributes or attributes.isspace():
        return tag in NOISE or (tag == "header" and not inside), ""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    named = f"{found.get('class', '')} {found.get('id', '')} {found.get('role', '')}".lower()
    words = set(_SPLIT.split(named))
    out = tag in NOISE or (not inside and (tag == "header" or "header" in words))
    if tag in ("html", "body", "main") or (tag == "article" and not words & {"comment", "comments", "reply", "replies"}):
        words = set()
    out = out or bool(words & NOISE_WORDS) or re.search(r"(?:^|[;\s])display\s*:\s*none", found.get("style", "").lower()) is not None
    return out, (found.get("class") or "").split(" ")[0][:40].lower()


def blocks(page: str | None) -> Iterator[Block]:
    """The text blocks of a page in order; hidden elements have none."""
    if not page:
        return
    root = _Open("", "", 0, False, False, False)
    stack, opened, parts, owner, at, n = [root], Counter(), [], root, 0, len(page)

    def close(k: int):
        opened.subtract(x.tag for x in stack[k:])
        del stack[k:]

    def flush():
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        return [Block(owner.path, text, owner.noise, owner.content)] if text else []

    while at < n:
        m = _TOKEN.search(page, at)
        stop = m.start() if m else n
        if stop > at and not stack[-1].hidden:
            if not parts:
                owner = stack[-1]
            parts.append(page[at:stop])
        if not m:
            break
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if opened[tag] > 0:
                k = next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag)
                if tag in BLOCK or stack[-1].noise != stack[k - 1].noise:
                    yield from flush()
                close(k)
            elif tag == "br":
                parts.append(" ")
            continue
        if tag == "br":
            parts.append(" ")
            continue
        top = stack[-1]
        noise, name = _noise(tag, m[3], top.content)
        if tag in BLOCK or noise != top.noise and noise:
            yield from flush()
        if tag in BLOCK:
            ends = set(_ENDS.get(tag, ())) | ({"p"} if tag not in ("option", "optgroup") else set())
            holds = _HOLDS.get(tag, frozenset())
            for k in range(len(stack) - 1, 0, -1):
                t = stack[k].tag
                if t in ends:
                    close(k)
                    break
                if t in holds or t in BLOCK and t not in ("li", "dt", "dd", "p") and t not in ends:
                    break
            top = stack[-1]
        if tag in VOID:
            continue
        label = f"{tag}.{name}" if name else tag
        step = (tag in BLOCK or noise) and top.depth < DEPTH
        inner = _Open(tag, f"{top.path}/{label}" if step else top.path, top.depth + step, top.hidden or tag in HIDDEN, top.noise or noise, top.content or tag in CONTENT)
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        stack.append(inner)
        opened[tag] += 1
    yield from flush()


def visible(page: str | None) -> str:
    """All visible text, one block a line."""
    return "\n".join(b.text for b in blocks(page))

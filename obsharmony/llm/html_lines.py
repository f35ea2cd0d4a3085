"""Text lines of a web page, each with what its place in the page says about it."""

from __future__ import annotations

import html
import re
from collections import Counter

#: What a line's place says: nothing, part of the article, part of the frame around it.
OPEN, ARTICLE, FRAME = 0, 1, 2

_TAG_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_END_OR_QUOTE = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"([a-zA-Z_:-]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_WORD = re.compile(r"[a-z0-9]+")

_RAW = {"script", "style", "textarea", "xmp", "noembed", "noframes", "iframe", "title"}
_RAW_END = {name: re.compile(rf"</{name}\b", re.I) for name in _RAW}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = {
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hr", "html", "legend",
    "li", "main", "menu", "nav", "ol", "option", "p", "pre", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th",
    "thead", "tr", "ul",
}
_FRAME_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "head", "noscript", "template", "select", "button", "svg", "math", "object", "canvas", "audio", "video"}
#: Words in class, id or role that name a part of the frame.
_FRAME_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner", "nav",
    "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "widget", "widgets", "footer", "masthead", "topbar", "toolbar",
    "cookie", "cookies", "consent", "notice", "notices", "gdpr", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription",
    "signup", "login", "search", "searchbox", "share", "sharing", "social", "related", "recommended", "recommendations", "comment",
    "comments", "commentlist", "disqus", "replies", "respond", "copyright", "pagination", "pager", "skip", "contentinfo",
    "complementary", "alert", "alertdialog", "hidden", "form",
}


def _of(attributes: str) -> tuple[set[str], bool]:
    """Words of class, id and role; whether the element is hidden."""
    words, hidden = set(), False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name in ("class", "id", "role"):
            words.update(_WORD.findall(value))
        hidden |= name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and "display:none" in value.replace(" ", ""))
    return words, hidden


class _Scanner:
    """Markup of a page one after the other, in time linear in the page whatever it holds."""

    def __init__(self, page: str):
        self.page = page
        self.none_after = {}  # character: a place from which on there is none
        self.endless: set[int] = set()  # places outside quotes from which no tag ends outside quotes

    def find(self, what: str, at: int) -> int:
        if at >= self.none_after.get(what, len(self.page) + 1):
            return -1
        found = self.page.find(what, at)
        if found < 0:
            self.none_after[what] = at
        return found

    def tag_end(self, at: int) -> int:
        """Place of the > that ends a tag: the first outside quotes, or the first of all if a quote stays open."""
        passed, place = [], at
        while place not in self.endless:
            passed.append(place)
            m = _END_OR_QUOTE.search(self.page, place)
            if m and m[0] == ">":
                return m.start()
            closing = self.find(m[0], m.end()) if m else -1
            if closing < 0:
                break
            place = closing + 1
        self.endless.update(passed)
        return self.find(">", at)

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        """Start and end of the next markup from `at` on; for a tag its slash, name and attributes."""
        page = self.page
        while (start := self.find("<", at)) >= 0:
            if page.startswith("<!--", start):
                end = self.find("-->", start + 4)
                return start, end + 3 if end >= 0 else len(page), "", "", ""
            if page.startswith(("<!", "<?"), start):
                end = self.find(">", start)
                return start, end + 1 if end >= 0 else len(page), "", "", ""
            m = _TAG_NAME.match(page, start + 1) if self.find(">", start) >= 0 else None
            end = self.tag_end(m.end()) if m else -1
            if end >= 0:
                return start, end + 1, m[1], m[2].lower(), page[m.end() : end]
            at = start + 1
        return None

    def raw_end(self, name: str, at: int) -> int:
        """Where the text of a raw element is over: behind its end tag, or at the end of the page."""
        m = _RAW_END[name].search(self.page, at)
        end = self.find(">", m.end()) if m else -1
        return end + 1 if end >= 0 else len(self.page)


def lines(page: str | None) -> list[tuple[str, int]]:
    """Blocks of text in page order with their kind; white space is single, empty blocks are left out.

    Markup that does not close, or closes twice, is read as browsers do: an end tag closes the
    nearest open element of its name, and what stays open ends with the page.
    """
    out: list[tuple[str, int]] = []
    if not page:
        return out
    parts: list[str] = []
    stack: list[tuple[str, int, bool]] = [("", OPEN, False)]  # name, kind, kind given by a tag
    opened: Counter[str] = Counter()  # names in the stack
    linked = total = links = 0
    scanner = _Scanner(page)

    def flush() -> None:
        nonlocal linked, total
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            kind = stack[-1][1]
            # Where the place says nothing, a block that is all links is a menu.
            out.append((text, FRAME if kind == OPEN and total and linked >= 0.8 * total else kind))
        parts.clear()
        linked = total = 0

    at = 0
    while at <= len(page):
        found = scanner.next(at)
        text = page[at : found[0] if found else len(page)]
        if text:
            parts.append(text)
            n = len(text.strip())
            total += n
            linked += n if links else 0
        if not found:
            break
        _, at, close, name, attributes = found
        if not name:
            continue
        if name in _BLOCK:
            flush()
        if close:
            if name == "a":
                links = max(0, links - 1)
            while opened[name]:
                last = stack.pop()[0]
                opened[last] -= 1
                if last == name:
                    break
            continue
        if name in _RAW:
            at = scanner.raw_end(name, at)
            continue
        if name in _VOID or attributes.endswith("/"):
            continue
        if name == "a":
            links += 1
            continue
        if name == "body":
            del stack[1:]
            opened.clear()
        if name not in _BLOCK and name not in _FRAME_TAGS and name not in ("span", "ins"):
            continue
        if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option") and stack[-1][0] == name:
            opened[stack.pop()[0]] -= 1  # these end where the next one begins
        _, kind, by_tag = stack[-1]
        words, hidden = _of(attributes) if attributes and name not in ("html", "body") else (set(), False)
        # An article's own class does not make it a frame, unless it stands in another article or a frame (comments, teasers).
        inner = kind == FRAME or opened["article"] > 0
        marked = name in ("article", "main") and not (inner and words & _FRAME_WORDS)
        named = not marked and (words & _FRAME_WORDS or (kind != ARTICLE and (name == "header" or "header" in words)))
        if hidden or name in _FRAME_TAGS or named:
            kind, by_tag = FRAME, by_tag or name in _FRAME_TAGS
        elif name in ("article", "main") and not (kind == FRAME and by_tag):
            kind = ARTICLE
        stack.append((name, kind, by_tag))
        opened[name] += 1
    flush()
    return out

"""Text blocks of an HTML page in page order, with the path of tags that leads to each."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass
from functools import cache

#: Elements that start and end a block of text (fixed value, HTML's flow elements that are not phrasing).
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe label legend li "
    "main menu nav noscript ol option p pre search section select summary table tbody td tfoot th thead title "
    "tr ul xmp".split()
)
#: Elements without an end tag (fixed value).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no text of the page (fixed value).
RAW = frozenset("script style template textarea noembed noframes".split())
#: Elements that an element of the same group ends when it is left open (fixed value).
_ENDED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th")}
_ENDED_BY |= {"td": ("td", "th"), "th": ("td", "th")}
_SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}
_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)(?:>|\Z)"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|(?P<text>[^<]++|<)",
    re.DOTALL,
)
_MARKS = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
_PART = re.compile(r"[a-z0-9]+")


@dataclass
class Block:
    """A block's path (tag names with marks of class, id and role, outermost first) and its text."""

    path: tuple[str, ...]
    text: str
    link_share: float = 0.0


def _marks(name: str, rest: str) -> tuple[str, ...]:
    found = [name]
    if "=" in rest:
        for _, a, b, c in _MARKS.findall(rest):
            found += [f".{part}" for part in _PART.findall((a or b or c).lower())]
    return tuple(found)


@cache
def _end_of(name: str) -> re.Pattern:
    """The end tag of an element whose content is not parsed; it may hold attributes."""
    return re.compile(f"</{name}(?=[\\s/>])[^>]*>", re.IGNORECASE)


def blocks_of(page: str) -> list[Block]:
    """Blocks with text: character references decoded, white space turned into one blank, trimmed.

    Comments, scripts and styles are left out. Unclosed elements are closed as
    browsers close them; stray end tags are ignored.
    """
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked: list[bool] = []
    links = 0
    at, n = 0, len(page)

    def flush() -> None:
        if parts:
            raw = "".join(parts)
            text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            if text:
                inside = sum(len(p) for p, a in zip(parts, linked) if a)
                path = tuple(mark for _, marks in stack for mark in marks)
                out.append(Block(path, text, inside / max(1, len(raw))))
            parts.clear()
            linked.clear()

    def close(place: int) -> None:
        nonlocal links
        links -= sum(name == "a" for name, _ in stack[place:])
        del stack[place:]

    while at < n:
        token = _TOKEN.match(page, at)
        at = token.end()
        text = token["text"]
        if text is not None:
            parts.append(text)
            linked.append(links > 0)
            continue
        name = token["name"] or token["name2"]
        if name is None:
            continue
        name = name.lower()
        if token["end"] or token["end2"]:
            if name in BLOCK:
                flush()
            for place in range(len(stack) - 1, -1, -1):
                if stack[place][0] == name:
                    close(place)
                    break
            continue
        rest = token["rest"] or token["rest2"] or ""
        if name in RAW:
            end = _end_of(name).search(page, at)
            if not rest.endswith("/"):
                at = end.end() if end else n
            continue
        if name in BLOCK:
            flush()
            for place in range(len(stack) - 1, -1, -1):
                open_name = stack[place][0]
                if open_name == "p" and name not in ("button", "label", "iframe"):
                    close(place)
                    break
                if open_name in _ENDED_BY.get(name, ()):
                    close(place)
                    break
                if open_name in _SCOPE.get(name, ()):
                    break
                if open_name in BLOCK and name not in _ENDED_BY:
                    break
        elif name == "br":
            parts.append(" ")
            linked.append(False)
        if name == "xmp":
            # Its content is text as it stands, up to its end tag.
            end = _end_of(name).search(page, at)
            parts.append(html.escape(page[at : end.start() if end else n]))
            linked.append(links > 0)
            at = end.start() if end else n
        if name not in VOID and not rest.endswith("/"):
            stack.append((name, _marks(name, rest)))
            links += name == "a"
    flush()
    return out

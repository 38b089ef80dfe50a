"""A lenient reader of web pages: elements with parents, and their text in page order."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Quotes delimit a value only directly after "="; elsewhere they are plain characters, and ">" ends the tag.
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>\"'][^\s>]*)?)*?)(/?)(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+))")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

# Fixed sets of element names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template iframe textarea title".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot "
    "th thead tr ul".split()
)
CLOSES_P = BLOCK - {"body", "html", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "option", "optgroup", "button", "select", "legend"}
#: An element ends open ones of these names, up to the nearest of the barriers.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
NAMED = ("class", "id", "role", "itemprop", "aria-label")


@dataclass
class Page:
    """Elements in page order; element 0 is the page itself. ``runs`` are (element, text), and None
    where a block begins or ends."""

    tags: list[str] = field(default_factory=lambda: ["#page"])
    parents: list[int] = field(default_factory=lambda: [-1])
    tokens: list[tuple[str, ...]] = field(default_factory=lambda: [()])
    marks: list[str] = field(default_factory=lambda: [""])
    runs: list[tuple[int, str] | None] = field(default_factory=list)

    def text(self, kept: list[bool]) -> str:
        """The text of the kept elements: blocks with single spaces, joined by empty lines."""
        blocks, held = [], []
        for run in [*self.runs, None]:
            if run is None:
                words = "".join(held).split()
                if words:
                    blocks.append(" ".join(words))
                held = []
            elif kept[run[0]]:
                held.append(run[1])
        return "\n\n".join(blocks)


def _attributes(raw: str) -> tuple[tuple[str, ...], str]:
    """Lower-case words of the naming attributes; the training mark."""
    words, mark = [], ""
    if "=" in raw:
        for name, a, b, c in ATTRIBUTE.findall(raw):
            name = name.lower()
            if name in NAMED:
                words += [w.lower() for w in WORD.findall(a or b or c)]
            elif name == "data-main":
                mark = a
    return tuple(dict.fromkeys(words)), mark


def parse(source: str | None) -> Page:
    """Reads a page, broken or cut off as it may be; null is an empty page."""
    page, source = Page(), (source or "").replace("\0", "")
    tags, runs = page.tags, page.runs
    stack, at, n = [0], 0, len(source)

    def say(raw: str) -> None:
        if raw:
            runs.append((stack[-1], html.unescape(raw) if "&" in raw else raw))

    def close(names: set[str] | frozenset[str], barriers: set[str] | frozenset[str]) -> None:
        """Ends the outermost open element of ``names`` inside the nearest barrier, and all in it."""
        for k in range(len(stack) - 1, 0, -1):
            tag = tags[stack[k]]
            if tag in barriers:
                return
            if tag in names:
                if any(tags[i] in BLOCK for i in stack[k:]):
                    runs.append(None)
                del stack[k:]
                return

    while at < n:
        found = MARKUP.search(source, at)
        if not found:
            say(source[at:])
            break
        say(source[at : found.start()])
        at = found.end()
        if not found[2]:
            continue  # a comment or declaration
        tag = found[2].lower()
        if found[1]:
            if tag == "br":
                say(" ")
            elif tag in ("html", "body"):
                pass  # what follows still belongs to the page
            else:
                close({tag}, {"td", "th"} if tag in ("p", "li", "div", "span", "a") else frozenset())
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.IGNORECASE).search(source, at) if not found[4] else None
            if not found[4]:
                at = end.end() if end else n
            continue
        if tag in CLOSES_P:
            close({"p"}, {"td", "th", "table", "button", "li", "div", "section", "article"})
        if tag in IMPLIED:
            close(*IMPLIED[tag])
        if tag in ("html", "body", "head") and tag in (tags[i] for i in stack):
            continue
        if tag == "body":
            close({"head"}, frozenset())
        words, mark = _attributes(found[3]) if found[3] else ((), "")
        if tag in VOID:
            if tag == "hr":
                runs.append(None)
            else:
                say(" " if tag == "br" else "")
            if tag not in ("img", "input"):
                continue
        tags.append(tag), page.parents.append(stack[-1]), page.tokens.append(words), page.marks.append(mark)
        if tag in BLOCK:
            runs.append(None)
        if tag not in VOID and not found[4]:
            stack.append(len(tags) - 1)
    return page

"""Invented pages with known main text, for training the extractor.

Every element that holds main text carries data-main="1", everything else of a page "0" (the nearest
mark above a text counts). Layouts, names, languages of the chrome and lengths vary at random.
"""

from __future__ import annotations

import random
import re

SYLLABLES = "an en er in on re ti al ra mi ko sa lu be do fa ne po sch ung ent que ción eau ment the and ing".split()
NAMES = {
    "header": ["header", "masthead", "top-bar", "site-header", "banner"],
    "menu": ["nav", "menu", "navbar", "main-menu", "navigation", "breadcrumb", "breadcrumbs"],
    "side": ["sidebar", "side", "aside", "rail", "widget", "related", "recommended", "more-stories", "trending"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-slot", "banner-ad"],
    "notice": ["cookie", "cookie-banner", "consent", "notice", "gdpr", "popup", "modal", "alert", "paywall"],
    "form": ["newsletter", "subscribe", "signup", "search", "login", "contact-form"],
    "share": ["share", "social", "share-buttons", "toolbar", "tags", "byline-links"],
    "comments": ["comments", "comment", "comment-list", "replies", "discussion", "respond", "disqus"],
    "footer": ["footer", "site-footer", "copyright", "legal", "bottom", "colophon"],
    "main": ["content", "article", "post", "entry-content", "story-body", "main", "article-body", "text", "post-content"],
    "wrap": ["wrapper", "container", "page", "layout", "row", "site", "inner"],
}


class Writer:
    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.named = self.r.random()
        # how the page writes paragraphs: most with p, some with plain elements
        self.paragraph = self.r.choice([("<p>", "</p>")] * 6 + [("<div>", "</div>")] * 3 + [("<div><span>", "</span></div>"), ("<section>", "</section>")])

    def word(self) -> str:
        return "".join(self.r.choice(SYLLABLES) for _ in range(self.r.randint(1, 3)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high)))

    def sentences(self, low: int, high: int) -> str:
        return " ".join(self.words(3, 14).capitalize() + self.r.choice([".", ".", ".", "!", "?"]) for _ in range(self.r.randint(low, high)))

    def name(self, kind: str) -> str:
        """A class or id: telling, random or none, as the page's style has it."""
        if self.named < 0.2:
            return ""
        own = self.r.choice(NAMES[kind]) if self.named > 0.4 else f"c{self.r.randint(1, 99)}-{self.word()}"
        return f' {self.r.choice(["class", "class", "id"])}="{own}"'

    def links(self, low: int, high: int) -> str:
        items = [f'<a href="/{self.word()}">{self.words(1, 3)}</a>' for _ in range(self.r.randint(low, high))]
        if self.r.random() < 0.7:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return self.r.choice([" ", " | ", " &middot; "]).join(items)

    def element(self, tags: list[str], kind: str, inner: str, main: int = 0) -> str:
        tag = self.r.choice(tags)
        return f'<{tag}{self.name(kind)} data-main="{main}">{inner}</{tag}>'

    def chrome(self, kind: str) -> str:
        r = self.r
        if kind == "menu":
            return self.element(["nav", "div", "nav", "ul"], kind, self.links(3, 9))
        if kind == "header":
            return self.element(["header", "div"], kind, f"<a href='/'>{self.words(1, 3)}</a><p>{self.words(2, 7)}</p>" + self.links(0, 5))
        if kind == "side":
            inner = f"<h3>{self.words(1, 4)}</h3>" + (self.links(2, 8) if r.random() < 0.6 else f"<p>{self.sentences(1, 3)}</p>")
            return self.element(["aside", "div", "section"], kind, inner)
        if kind == "ad":
            # without a name or a link, nothing would tell an advert's sentences from the text's
            inner = self.sentences(1, 2) if r.random() < 0.7 and self.named >= 0.2 else f"<a href='/ad'>{self.words(2, 8)}</a><img src='x.png'>"
            return self.element(["div", "div", "aside", "section"], kind, inner)
        if kind == "notice":
            return self.element(["div", "section", "dialog"], kind, f"<p>{self.sentences(1, 3)}</p><button>{self.words(1, 2)}</button>")
        if kind == "form":
            inner = f"<p>{self.sentences(1, 2)}</p><label>{self.words(1, 2)}</label><input type='text'><button>{self.words(1, 2)}</button>"
            return self.element(["form", "form", "div"], kind, inner)
        if kind == "share":
            links = " ".join(f'<a href="/{self.word()}">{self.words(1, 2)}</a>' for _ in range(r.randint(2, 5)))
            return self.element(["div", "span", "p"], kind, links)
        if kind == "comments":
            who = "".join(
                f"<{t}{self.name('comments')}><a href='#u'>{self.words(1, 2)}</a><p>{self.sentences(1, 4)}</p></{t}>"
                for t in [r.choice(["div", "li", "article"])] * r.randint(1, 6)
            )
            return self.element(["section", "div", "ol"], kind, f"<h3>{r.randint(2, 90)} {self.words(1, 2)}</h3>" + who)
        inner = f"&copy; {r.randint(1999, 2030)} {self.words(1, 4)}. {self.sentences(0, 2)}" + (self.links(0, 6) if r.random() < 0.5 else "")
        return self.element(["footer", "div"], kind, inner)

    def linked_list(self) -> str:
        """A list whose items are links, or sentences with one: a part of the text, such as sources."""
        items = []
        for _ in range(self.r.randint(2, 6)):
            link = f'<a href="/{self.word()}">{self.words(2, 9)}</a>'
            items.append(f"<li>{link}{self.r.choice(['', '.', ' ' + self.sentences(1, 1)])}</li>")
        return "<ul>" + "".join(items) + "</ul>"

    def body(self) -> list[str]:
        """Blocks of the main text, with chrome between some of them."""
        r, blocks = self.r, []
        if r.random() < 0.8:
            blocks.append(f"<h1>{self.words(3, 10)}</h1>")
        for _ in range(r.choice([1, 1, 2, 3, 4, 6, 9, 14])):
            x = r.random()
            if x < 0.7 and self.paragraph[0] != "<p>":
                blocks.append(self.sentences(1, 6).join(self.paragraph))
            elif x < 0.7:
                ended = r.random() < 0.85
                opened = r.choice(["", "", "<b>", "<em>"])
                blocks.append(f"<p>{opened}{self.sentences(1, 6)}" + ("</p>" if ended and not opened else r.choice(["<br>", "</p>", ""])))
            elif x < 0.76:
                blocks.append(f"<h2>{self.words(2, 6)}</h2>")
            elif x < 0.81:
                items = [self.words(2, 12) if r.random() < 0.6 else self.sentences(1, 2) for _ in range(r.randint(2, 6))]
                tag = r.choice(["ul", "ul", "ol"])
                blocks.append(f"<{tag}>" + "".join(f"<li>{x}</li>" for x in items) + f"</{tag}>")
            elif x < 0.83:
                blocks.append(self.linked_list())
            elif x < 0.85:
                terms = (f"<dt>{self.words(1, 3)}</dt><dd>{self.sentences(1, 2)}</dd>" for _ in range(r.randint(1, 5)))
                blocks.append("<dl>" + "".join(terms) + "</dl>")
            elif x < 0.88:
                blocks.append(f"<blockquote><p>{self.sentences(1, 3)}</p></blockquote>")
            elif x < 0.91:
                cells = lambda: "".join(f"<td>{self.words(1, 3)}</td>" for _ in range(3))
                blocks.append("<table>" + "".join(f"<tr>{cells()}</tr>" for _ in range(r.randint(2, 4))) + "</table>")
            elif x < 0.95:
                blocks.append(f"<p>{self.words(4, 30).replace(' ', ' | ')}</p>")
            else:
                blocks.append(f"<figure><img src='a.jpg'><figcaption>{self.words(3, 9)}</figcaption></figure>")
            if r.random() < 0.08:
                blocks.append(self.chrome(r.choice(["ad", "form", "share", "notice", "side"])))
        return blocks

    def page(self) -> str:
        r = self.r
        kind = r.choice(["article"] * 4 + ["main"] * 2 + ["div"] * 4 + ["section", "section", "td", "td", "bare", "bare", "loose", "loose"])
        blocks = self.body()
        if kind == "loose":  # nothing holds the blocks together, so each is marked, but for chrome, which is already
            blocks = [b if b.split(">", 1)[0].endswith('data-main="0"') else re.sub(r"^<(\w+)", r'<\1 data-main="1"', b) for b in blocks]
        inner = "".join(blocks)
        if kind == "article" and r.random() < 0.3:
            inner = f"<header><h1>{self.words(3, 8)}</h1></header>" + inner
        if r.random() < 0.25:
            inner += self.chrome(r.choice(["share", "comments", "ad"]))
        if kind == "loose":
            main = inner
        elif kind == "bare":
            main = f'<span data-main="1">{inner}</span>'
        elif kind == "td":
            main = f'<table><tr><td data-main="0">{self.links(2, 6)}</td><td data-main="1">{inner}</td></tr></table>'
        else:
            main = f'<{kind}{self.name("main")} data-main="1">{inner}</{kind}>'
        above = [self.chrome(k) for k in ("notice", "header", "menu", "menu", "ad", "form") if r.random() < 0.45]
        below = [self.chrome(k) for k in ("side", "ad", "share", "comments", "side", "form") if r.random() < 0.35]
        if r.random() < 0.3:
            below, above = below[1:], above + below[:1]
        content = "".join([*above, main, *below])
        for _ in range(r.choice([0, 0, 1, 2])):
            content = f'<div{self.name("wrap")}>{content}</div>'
        content += self.chrome("footer") if r.random() < 0.8 else ""
        return f'<html><head><title>{self.words(2, 6)}</title></head><body data-main="0">{content}</body></html>'


def pages(n: int, seed: int = 11) -> list[str]:
    return [Writer(seed * 1_000_003 + k).page() for k in range(n)]

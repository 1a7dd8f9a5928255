"""Labelled pages to train the extractor on, made up from a seeded grammar.

A page is a site's frame (header, menus, notices, adverts, sidebars, footer) around an
article in one of many usual containers, with reader comments, forms and
related links in and after it. Every text stands in a block of its own, and the
grammar knows which blocks are the article's. Words are random letters, so
only tags, attribute names and the shape of texts can be learned.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

#: Tags and attribute names in common use on the web.
ARTICLES = [
    ("article", ""), ("article", ""), ("article", ""), ("main", ""), ("article", "post"), ("div", "content"),
    ("div", "main-content"), ("div", "post-body"), ("div", "entry-content"), ("section", "article-text"),
    ("div", "story"), ("div", "article-body"), ("section", ""), ("div", ""), ("div", "page-text"), ("td", "content"),
]
HEADERS = [("header", ""), ("header", "site-header"), ("div", "header"), ("div", "masthead"), ("div", "top-bar"), ("div", "branding logo")]
MENUS = [("nav", ""), ("nav", "menu"), ("div", "nav"), ("div", "navigation"), ("ul", "menu"), ("div", "navbar"), ("div", "breadcrumbs"), ("div", "toolbar tabs")]
ADVERTS = [("div", "ad"), ("div", "ads"), ("div", "advert"), ("div", "advertisement"), ("div", "sponsored"), ("aside", "ad"), ("div", "promo"), ("div", "banner"), ("section", "sponsor"), ("div", "promotion")]
NOTICES = [("div", "notice"), ("div", "cookie-notice"), ("div", "cookie-banner"), ("div", "alert"), ("div", "consent gdpr"), ("div", "popup modal"), ("div", "subscribe newsletter"), ("div", "paywall"), ("div", "cookies privacy"), ("div", "warning message")]
SIDEBARS = [("aside", ""), ("aside", "sidebar"), ("div", "sidebar"), ("div", "widget"), ("div", "related"), ("div", "trending popular"), ("div", "recommended more"), ("section", "related-posts"), ("div", "side"), ("div", "author-bio about")]
COMMENTS = [("div", "comments"), ("section", "comments"), ("div", "comment"), ("ol", "comment-list"), ("div", "reader-comments"), ("section", "discussion"), ("div", "replies"), ("ul", "responses"), ("div", "disqus thread"), ("div", "user-comments feedback")]
FORMS = [("form", ""), ("form", "search"), ("form", "signup"), ("form", "login"), ("div", "search-form")]
FOOTERS = [("footer", ""), ("footer", "site-footer"), ("div", "footer"), ("div", "copyright"), ("div", "colophon legal"), ("div", "bottom footer-links")]
SHARES = [("div", "share"), ("div", "social"), ("ul", "share-buttons"), ("div", "tags"), ("div", "byline meta"), ("div", "pagination pager")]
WRAPPERS = ["", "wrapper", "container", "page", "row", "layout", "inner", "block", "box"]


class Grammar:
    """One page at a time: pieces of html, and the label of each text in order."""

    def __init__(self, seed: int) -> None:
        self.r = random.Random(seed)
        self.out: list[str] = []
        self.labels: list[int] = []

    def words(self, least: int, most: int) -> str:
        n = self.r.randint(least, most)
        letters = "abcdefghilmnoprstuvàéöñ"
        return " ".join("".join(self.r.choices(letters, k=self.r.randint(2, 10))) for _ in range(n))

    def sentences(self, least: int, most: int) -> str:
        parts = []
        for _ in range(self.r.randint(least, most)):
            text = self.words(1, 22).capitalize()
            parts.append(text.replace(" ", ", ", self.r.randint(0, 2)) + self.r.choice("....?!"))
        return " ".join(parts)

    def open(self, kind: tuple[str, str]) -> str:
        tag, name = kind
        if not name:
            return f"<{tag}>"
        name = self.r.choice([name, name.upper(), name.replace("-", "_")]) if self.r.random() < 0.2 else name
        return f'<{tag} {self.r.choice(["class", "class", "class", "id"])}="{name}">'

    def text(self, tag: str, text: str, label: int, link: bool = False) -> None:
        inner = f'<a href="/{self.r.randint(1, 99)}">{text}</a>' if link else text
        if not link and self.r.random() < 0.1:
            inner = f"<b>{inner}</b>"
        # End tags that html lets authors leave out are left out at times.
        end = "" if tag in ("p", "li") and self.r.random() < 0.15 else f"</{tag}>"
        self.out.append(f"<{tag}>{inner}{end}")
        self.labels.append(label)

    def links(self, kind: tuple[str, str], least: int = 1, most: int = 8) -> None:
        self.out.append(self.open(kind))
        inside = kind[0] == "ul" or self.r.random() < 0.6
        if inside and kind[0] != "ul":
            self.out.append("<ul>")
        for _ in range(self.r.randint(least, most)):
            self.text("li" if inside else self.r.choice(["div", "p"]), self.words(1, 4), 0, link=True)
        if inside and kind[0] != "ul":
            self.out.append("</ul>")
        self.out.append(f"</{kind[0]}>")

    def prose(self, kind: tuple[str, str], least: int, most: int, label: int = 0) -> None:
        """A container with a heading at times, and paragraphs."""
        self.out.append(self.open(kind))
        listed = kind[0] in ("ol", "ul")
        if self.r.random() < 0.4 and not listed:
            self.text(self.r.choice(["h2", "h3", "h4", "div"]), self.words(1, 4), label)
        for _ in range(self.r.randint(least, most)):
            tag = "li" if listed else self.r.choice(["p", "p", "p", "div", "blockquote"])
            self.text(tag, self.sentences(1, 5) if self.r.random() < 0.8 else self.words(1, 8), label)
        self.out.append(f"</{kind[0]}>")

    def bare(self, kind: tuple[str, str]) -> None:
        """Text straight inside a container."""
        text = self.sentences(1, 2) if self.r.random() < 0.7 else self.words(1, 6)
        mark = "&copy; " if kind in FOOTERS and self.r.random() < 0.7 else ""
        self.out.append(f"{self.open(kind)}{mark}{text}</{kind[0]}>")
        self.labels.append(0)

    def form(self) -> None:
        kind = self.r.choice(FORMS)
        self.out.append(self.open(kind))
        for _ in range(self.r.randint(1, 3)):
            self.text(self.r.choice(["label", "div", "p", "button"]), self.words(1, 5), 0)
            self.out.append('<input type="text">')
        self.out.append(f"</{kind[0]}>")

    def frame(self, odds: float, *kinds) -> None:
        for options, style in kinds:
            if self.r.random() < odds:
                kind = self.r.choice(options)
                if style == "links":
                    self.links(kind)
                elif style == "bare" or self.r.random() < 0.4:
                    self.bare(kind if kind[0] not in ("ol", "ul") else ("div", kind[1]))
                else:
                    self.prose(kind, 1, 4)

    def article(self) -> None:
        kind = self.r.choice(ARTICLES)
        cell = kind[0] == "td"
        self.out.append(("<table><tr>" if cell else "") + self.open(kind))
        if self.r.random() < 0.85:
            self.text(self.r.choice(["h1", "h1", "h2"]), self.words(1, 12), 1)
        if self.r.random() < 0.2:
            self.frame(1, (SHARES, "links"))
        for _ in range(self.r.choice([1, 1, 2, 3, 5, 8, 14])):
            chance = self.r.random()
            if chance < 0.78:
                text = self.sentences(1, 9) if self.r.random() < 0.85 else self.words(1, 60)
                self.text("p" if self.r.random() < 0.9 else "div", text, 1)
            elif chance < 0.84:
                self.text(self.r.choice(["h2", "h3"]), self.words(1, 8), 1)
            elif chance < 0.90:
                self.out.append("<ul>")
                for _ in range(self.r.randint(1, 5)):
                    self.text("li", self.words(1, 20), 1)
                self.out.append("</ul>")
            elif chance < 0.95:
                self.text(self.r.choice(["blockquote", "pre", "figcaption"]), self.sentences(1, 3), 1)
            elif chance < 0.975:
                self.out.append("<table>")
                for _ in range(self.r.randint(1, 3)):
                    self.out.append("<tr>")
                    for _ in range(2):
                        self.text("td", self.words(1, 4), 1)
                    self.out.append("</tr>")
                self.out.append("</table>")
            else:
                self.text("p", self.words(2, 9), 1, link=True)
            if self.r.random() < 0.06:
                self.frame(0.5, (ADVERTS, ""), (SIDEBARS, ""), (NOTICES, ""))
        if self.r.random() < 0.25:
            self.frame(0.5, (COMMENTS, ""), (SHARES, "links"), (SIDEBARS, "links"))
        if self.r.random() < 0.1:
            self.form()
        self.out.append(f"</{kind[0]}>" + ("</tr></table>" if cell else ""))

    def page(self) -> tuple[str, list[int]]:
        wrapped, bare = self.r.choice(WRAPPERS), self.r.random() < 0.1
        self.out.append(f"<!DOCTYPE html><html><head><title>{self.words(1, 5)}</title><style>p{{}}</style></head><body>")
        if wrapped:
            self.out.append(self.open(("div", wrapped)))
        if bare:  # nothing but an article
            self.article()
            self.out.append("</body></html>")
            return "".join(self.out), self.labels
        self.frame(0.4, (NOTICES, ""), (HEADERS, "bare"), (HEADERS, "links"), (ADVERTS, ""))
        self.frame(0.75, (MENUS, "links"))
        self.frame(0.3, (ADVERTS, ""), (SIDEBARS, "links"), (NOTICES, "bare"))
        if self.r.random() < 0.15:
            self.form()
        if self.r.random() < 0.96:
            self.article()
        self.frame(0.35, (SHARES, "links"), (COMMENTS, ""), (SIDEBARS, ""), (ADVERTS, ""), (SIDEBARS, "links"))
        if self.r.random() < 0.15:
            self.form()
        self.frame(0.7, (FOOTERS, "bare"))
        self.frame(0.2, (FOOTERS, "links"), (NOTICES, ""))
        if self.r.random() < 0.85:
            self.out.append("</div></body></html>" if wrapped else "</body></html>")
        return "".join(self.out), self.labels


def labelled_pages(count: int, seed: int = 20240604) -> Iterator[tuple[str, list[int]]]:
    """Pages, each with a label for every one of its text blocks: 1 for the article's."""
    for k in range(count):
        yield Grammar(seed + k).page()

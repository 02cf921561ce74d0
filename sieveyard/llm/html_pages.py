"""Labelled pages to train the main-text model on: built from varied layouts, so each element's role is known."""

from __future__ import annotations

import random
import re

#: Classes and ids by which layouts name their parts (values that the model should learn to read).
PARTS = {
    "nav": ("menu", "nav", "navbar", "main-nav", "site-menu", "topnav", "breadcrumb", "breadcrumbs", "pagination", "tabs"),
    "header": ("header", "site-header", "masthead", "page-header", "top", "branding", "logo"),
    "footer": ("footer", "site-footer", "foot", "bottom", "copyright", "legal", "colophon"),
    "aside": ("sidebar", "side", "related", "widget", "recommended", "most-read", "trending", "popular", "tags", "author-box", "toc"),
    "ad": ("ad", "ads", "advert", "advertisement", "banner", "promo", "sponsored", "sponsor", "adbox"),
    "notice": ("notice", "cookie", "cookie-banner", "consent", "gdpr", "alert", "popup", "modal", "newsletter", "subscribe", "paywall"),
    "comments": ("comments", "comment", "comment-list", "responses", "replies", "discussion", "reader-comments", "disqus"),
    "share": ("share", "social", "sharing", "follow-us", "buttons"),
}
CONTENT = ("content", "article", "post", "entry", "story", "main", "article-body", "post-content", "entry-content", "text", "body-text")
_SYLLABLES = ("the", "an", "er", "in", "on", "at", "re", "ti", "en", "ou", "st", "nd", "sch", "que", "ción", "eau", "lich", "ment", "los", "und")


def labelled_page(seed: int) -> str:
    """A page whose elements carry data-y="1" (main text) or "0" where that changes from what stands around them."""
    r = random.Random(seed)
    bare = r.random() < 0.12  # a page that names none of its parts
    word = lambda: "".join(r.choices(_SYLLABLES, k=r.choice((1, 1, 2, 2, 3))))

    def sentence(least: int = 4, most: int = 22) -> str:
        return " ".join(word() for _ in range(r.randint(least, most))).capitalize() + r.choice(".....?!")

    def links(n: int) -> str:
        return r.choice(("", " ", " | ")).join(f'<a href="/{word()}">{" ".join(word() for _ in range(r.randint(1, 3)))}</a>' for _ in range(n))

    def item_list(n: int) -> str:
        return "<ul>" + "".join(f"<li>{links(1)}{r.choice(('</li>', '</li>', ''))}" for _ in range(n)) + "</ul>"

    def box(kind: str, inner: str, tag: str | None = None) -> str:
        semantic = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside"}
        if bare:
            return f'<div data-y="0">{inner}</div>'
        name = tag or (semantic[kind] if kind in semantic and r.random() < 0.5 else r.choice(("div", "div", "section")))
        mark = f' {r.choice(("class", "class", "id"))}="{r.choice(PARTS[kind])}"' if name in ("div", "section", "form", "p") or r.random() < 0.3 else ""
        return f'<{name}{mark} data-y="0">{inner}</{name}>'

    def paragraphs(n: int) -> str:
        out = []
        for _ in range(n):
            text = " ".join(sentence() for _ in range(r.choice((1, 1, 2, 3, 5, 8))))
            if r.random() < 0.25:
                a, b = text.split(" ", 1) if " " in text else (text, "")
                text = f"<{r.choice(('b', 'i', 'em', 'a href=x', 'span'))}>{a} {b}" if r.random() < 0.4 else f"<b>{a}</b> {b}"
            kind = r.random()
            if kind < 0.76:
                out.append(f"<p>{text}{r.choice(('</p>', '</p>', '</p>', '<br>'))}")
            elif kind < 0.82:
                out.append(f"<h2>{sentence(2, 6)[:-1]}</h2>")
            elif kind < 0.87:
                out.append("<ul>" + "".join(f"<li>{sentence(3, 12)}</li>" for _ in range(r.randint(2, 5))) + "</ul>")
            elif kind < 0.90:
                out.append(f"<blockquote><p>{text}</p></blockquote>")
            elif kind < 0.93:
                out.append("<table>" + "".join(f"<tr><td>{word()}</td><td>{sentence(2, 6)}</td></tr>" for _ in range(r.randint(2, 4))) + "</table>")
            elif kind < 0.96:
                out.append(f"<div>{text}</div>")
            else:
                out.append(sentence(1, 3))
        return "".join(out)

    def short(kind: str) -> str:
        return box(kind, r.choice((sentence(3, 14), f"<p>{sentence(4, 16)} {links(1)}</p>", f"{sentence(3, 9)} <button>{word()}</button>", item_list(r.randint(2, 6)))))

    def form() -> str:
        return f'<form data-y="0"><label>{word()}</label><input name=q><button>{word()}</button><select><option>{word()}<option>{word()}</select></form>'

    def comments() -> str:
        one = lambda: f'<{t} class="{r.choice(("comment", "reply", "item"))}"><b>{word()}</b><p>{" ".join(sentence() for _ in range(r.randint(1, 4)))}</p></{t}>' if (t := r.choice(("div", "article", "li"))) else ""
        return box("comments", f"<h3>{r.randint(1, 99)} {word()}</h3>" + "".join(one() for _ in range(r.randint(1, 5))))

    def lines(n: int) -> str:
        """Poems, tables as text, shouted or repeated lines: main text without sentences."""
        few = [" ".join(word() for _ in range(r.randint(1, 9))) for _ in range(r.randint(1, 4))]
        line = lambda: (r.choice(few) if r.random() < 0.6 else " ".join(word() for _ in range(r.randint(1, 14))))
        change = r.choice((str, str, str.upper, lambda x: x.replace(" ", " | "), lambda x: x.replace(" ", "*** ")))
        return "".join(f"<p>{change(line())}{r.choice(('</p>', '<br>'))}" for _ in range(n))

    title = sentence(3, 9)[:-1]
    body = paragraphs(r.choice((4, 8, 14))) if bare else paragraphs(r.choice((1, 2, 3, 5, 8, 14))) if r.random() < 0.7 else lines(r.choice((1, 2, 4, 8, 15, 40)))
    inside = [f() for f in (lambda: short("ad"), lambda: short("share"), lambda: short("aside"), form) if r.random() < 0.2]
    for x in inside:
        at = r.choice([i for i in range(len(body) + 1) if body[i : i + 2] in ("<p", "<h", "<u") or i in (0, len(body))])
        body = body[:at] + x + body[at:]
    tag = "div" if bare else r.choice(("article", "article", "main", "div", "section"))
    mark = f' {r.choice(("class", "id"))}="{r.choice(CONTENT)}"' if not bare and (tag in ("div", "section") or r.random() < 0.4) else ""
    top = f"<{(h := r.choice(('h1', 'h1', 'h2')))}>{title}</{h}>" if r.random() < 0.9 else ""
    if r.random() < 0.25:
        body = "<div>" + body + "</div>" if bare else f'<div class="{r.choice(CONTENT)}">{body}</div>'
    elif r.random() < 0.25:  # parts of the main text may be sections or boxes of their own
        part = "div" if bare else r.choice(("section", "section", "div"))
        body = "".join(f"<{part}>{x}</{part}>" for x in [body, *(f"<h2>{sentence(2, 5)[:-1]}</h2>{paragraphs(r.choice((1, 2, 4)))}" for _ in range(r.choice((1, 2))))])
    if top and not bare and tag in ("article", "main") and r.random() < 0.3:  # an article's own header
        by = f'<p class="{r.choice(("byline", "meta", "date", "author"))}">{word()} {word()}</p>' if r.random() < 0.6 else ""
        top = f"<header>{top}{by}</header>"
    plain = not bare and r.random() < 0.08  # main text that stands in the body itself
    if not plain and not bare and r.random() < 0.08:
        body = f"<p>{'<b>' * (r.random() < 0.3)}{sentence(1, 3)}</p>"
    if plain:
        top, body = (re.sub("<(p|h[1-6]|ul|blockquote|table|div|section|header)(?=[ >])", r'<\1 data-y="1"', x) for x in (f"<h1>{title}</h1>", paragraphs(r.choice((2, 3, 5, 8)))))
    main = top + body if plain else f'<{tag}{mark} data-y="1">{top}{body}{comments() if r.random() < 0.15 else ""}</{tag}>'
    before = [f() for f in (lambda: box("header", f"<h1>{word()}</h1><p>{sentence(2, 7)}</p>" + (item_list(4) if r.random() < 0.4 else "")), lambda: box("nav", r.choice((item_list, links))(r.randint(3, 9))), lambda: short("notice"), lambda: short("ad"), form) if r.random() < 0.55]
    r.shuffle(before)
    after = [f() for f in (comments, lambda: short("aside"), lambda: short("share"), lambda: short("ad"), lambda: short("notice"), lambda: box("footer", r.choice((f"&copy; {word()} &middot; {sentence(3, 12)}", f"<p>{sentence(4, 15)}</p>{links(4)}")))) if r.random() < 0.5]
    aside = short("aside") if r.random() < 0.4 else ""
    middle = aside + main if r.random() < 0.5 else main + aside
    if r.random() < 0.5:
        middle = f'<div class="{r.choice(("wrapper", "container", "row", "page", "layout"))}">{middle}</div>'
    head = f'<!DOCTYPE html><html><head><meta charset="utf-8"><title>{title}</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head><body data-y="0">'
    return head + "".join(before) + middle + "".join(after) + r.choice(("</body></html>", ""))

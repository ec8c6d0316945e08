"""Labelled pages to learn from: layouts of many kinds filled with the words of given pages."""

from __future__ import annotations

import html
import random

#: Names that sites give to the parts of their pages; the first list holds main text.
MAIN = "article main content post entry story body text article-body post-content entry-content story-body main-content page-content prose".split()
PARTS = {
    "menu": "nav menu navbar main-menu topnav breadcrumb breadcrumbs pagination site-nav tabs toc-nav links sitemap".split(),
    "head": "header site-header masthead topbar branding logo banner page-top head".split(),
    "foot": "footer site-footer bottom copyright legal colophon page-footer foot".split(),
    "side": "sidebar aside widget related recommended trending most-read side-column teaser more-stories rail also-read tags categories archive".split(),
    "note": "cookie cookie-banner cookie-notice consent gdpr notice alert privacy newsletter subscribe paywall popup modal announcement disclaimer".split(),
    "ad": "ad ads advert advertisement sponsored promo ad-slot ad-container sponsor banner-ad".split(),
    "form": "search search-form login signup form contact subscribe-form comment-form respond".split(),
    "talk": "comments comment-list discussion replies responses reader-comments disqus comment-thread user-comments feedback".split(),
    "share": "share social social-links share-buttons follow author-bio byline-links".split(),
}
TAGS = {"menu": "nav", "head": "header", "foot": "footer", "side": "aside", "note": "div", "ad": "div", "form": "form", "talk": "section", "share": "div"}
LINES = {
    "foot": ["© {w}", "Copyright 2024 {w}. All rights reserved.", "© {w} · {s}", "Privacy policy | Terms | {w}", "Impressum", "{s}"],
    "note": ["We use cookies to improve this site. {s}", "Accept all", "Subscribe to our newsletter. {s}", "This site uses cookies.", "Wir verwenden Cookies. {s}", "{s}", "Nous utilisons des cookies.", "Utilizamos cookies."],
    "ad": ["{s}", "Advertisement", "Sponsored: {s}", "Buy {w} now. {s}", "Anzeige", "{s} {s}"],
    "share": ["Share", "Tweet", "Follow us", "Share on {w}", "{w}"],
    "head": ["{w}", "{s}", "Welcome to {w}", "{w} {w}"],
}


class Maker:
    """Draws pages; ``texts`` are paragraphs, the words come from them."""

    def __init__(self, texts: list[str], seed: int):
        self.rng = random.Random(seed)
        self.texts = [t for t in texts if t] or ["word"]
        self.words = [w for t in self.texts[:2000] for w in t.split()]

    def word(self) -> str:
        return self.rng.choice(self.words)

    def sentence(self) -> str:
        words = self.rng.choice(self.texts).split()
        n = self.rng.randint(3, 18)
        at = self.rng.randrange(max(1, len(words) - n))
        return " ".join(words[at : at + n])

    def fill(self, line: str) -> str:
        return html.escape(line.replace("{w}", self.word()).replace("{s}", self.sentence()), quote=False)

    def named(self, tag: str, name: str) -> str:
        kind = self.rng.random()
        if kind < 0.12:
            return f"<{tag}>"
        extra = f" {self.rng.choice('col row wrap box block inner clearfix'.split())}{self.rng.randint(1, 9)}" if kind > 0.7 else ""
        return f'<{tag} {self.rng.choice(["class", "id", "class"])}="{name}{extra}">'

    def part(self, kind: str) -> list[tuple[str, int]]:
        """Markup pieces with label 0."""
        r = self.rng
        own = r.random() < 0.5
        tag = TAGS[kind] if own else r.choice(["div", "section", "div"])
        bare = own and tag not in ("div", "section") and r.random() < 0.5
        out = [(f"<{tag}>" if bare else self.named_part(tag, kind), -1)]
        if kind in ("menu", "side", "share") or kind == "foot" and r.random() < 0.4:
            if r.random() < 0.4:
                out.append((f"<{r.choice(['h2', 'h3', 'h4', 'p'])}>{self.fill(r.choice(['{w}', 'Related', 'More {w}', 'Menu', 'Tags', '{w} {w}']))}", 0))
            items = r.randint(2, 9)
            long = kind == "side" and r.random() < 0.5
            listed = r.random() < 0.7
            out.append(("<ul>" if listed else "", -1))
            for _ in range(items):
                label = html.escape(self.sentence() if long else " ".join(self.word() for _ in range(r.randint(1, 3))))
                out.append((f"{'<li>' if listed else '<div>'}<a href='/{r.randint(1, 99)}'>{label}</a>{'</li>' if listed else '</div>'}", 0))
            out.append(("</ul>" if listed else "", -1))
        elif kind == "form":
            for _ in range(r.randint(1, 4)):
                out.append((f"<p><label>{self.fill('{w}')}</label> <input name=a> {self.fill(r.choice(['{w}', '', 'Search', 'E-mail']))}</p>", 0))
            out.append(("<button>Send</button>", 0))
        elif kind == "talk":
            if r.random() < 0.7:
                out.append((f"<h3>{r.choice(['Comments', 'Kommentare', 'Commentaires', 'Comentarios', 'Leave a reply', '3 comments'])}</h3>", 0))
            inner = r.choice(["comment", "comment-body", "reply", "message", ""])
            for _ in range(r.randint(1, 6)):
                body = " ".join(self.sentence() for _ in range(r.randint(1, 4)))
                opened = r.choice(["<li>", "<div>", f'<div class="{inner}">', f'<li class="{inner}">', "<article>"]) if inner else r.choice(["<li>", "<div>"])
                out.append((f"{opened}<p>{html.escape(body)}</p>", 0))
                out.append((f"</{opened[1:].split('>')[0].split()[0]}>", -1))
        else:
            for _ in range(r.randint(1, 3)):
                out.append((f"<{r.choice(['p', 'div', 'span', 'p'])}>{self.fill(r.choice(LINES[kind]))}</{'p'}>" if r.random() < 0.5 else self.fill(r.choice(LINES[kind])), 0))
                out.append(("<div></div>", -1))
        out.append((f"</{tag}>", -1))
        return out

    def named_part(self, tag: str, kind: str) -> str:
        while (opened := self.named(tag, self.rng.choice(PARTS[kind]))) == f"<{tag}>" and tag in ("div", "section"):
            pass
        return opened

    def article(self) -> list[tuple[str, int]]:
        r = self.rng
        tag = r.choice(["article", "main", "div", "div", "section", "article"])
        bare = tag in ("article", "main") and r.random() < 0.6
        out = [(f"<{tag}>" if bare else self.named(tag, r.choice(MAIN)), -1)]
        depth = r.randint(0, 2)
        out += [(f'<div class="{r.choice([*MAIN, "inner", "col", "wrap"])}">', -1) for _ in range(depth)]
        head = r.random()
        if head < 0.8:
            title = f"<h1>{html.escape(self.sentence())}</h1>"
            out.append((f"<header>{title}</header>" if head < 0.15 else title, 1))
        for _ in range(r.choice([1, 1, 2, 3, 5, 8, 12, 20])):
            kind = r.random()
            body = html.escape(r.choice(self.texts), quote=False)
            if kind < 0.1:
                out.append((f"<h{r.randint(2, 4)}>{html.escape(self.sentence())}</h2>", 1))
                out.append(("<div></div>", -1))
            if kind < 0.16:
                out.append(("<ul>", -1))
                out += [(f"<li>{html.escape(self.sentence())}</li>", 1) for _ in range(r.randint(2, 5))]
                out.append(("</ul>", -1))
            elif kind < 0.2:
                out.append((f"<blockquote><p>{body}</p></blockquote>", 1))
            elif kind < 0.3:
                out.append((f"<p><b>{body}<br>", 1))
            elif kind < 0.36:
                out.append((f"<p>{html.escape(self.sentence())}</p>", 1))
            elif kind < 0.42:
                out.append((f"<div>{body}</div>", 1))
            else:
                out.append((f"<p>{body}</p>", 1))
            if r.random() < 0.05:
                out += self.part(r.choice(["ad", "side", "share", "note"]))
        out += [("</div>", -1)] * depth
        return [*out, (f"</{tag}>", -1)]

    def page(self) -> list[tuple[str, int]]:
        """Markup pieces with 1 for main text, 0 for other text, -1 for markup alone."""
        r = self.rng
        some = lambda kinds, most: [x for k in r.sample(kinds, r.randint(0, min(most, len(kinds)))) for x in self.part(k)]
        before, after = some(["head", "menu", "note", "ad", "form", "share"], 4), some(["talk", "side", "share", "ad", "form", "menu", "note"], 4)
        out = [("<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body>", -1), *before]
        wrapped = r.random() < 0.4
        if wrapped:
            out.append((self.named("div", r.choice(["page", "wrapper", "container", "site", "layout"])), -1))
            out += some(["side", "menu"], 1)
        out += self.article() + after
        if r.random() < 0.8:
            out += self.part("foot")
        if wrapped:
            out.append(("</div>", -1))
        return out

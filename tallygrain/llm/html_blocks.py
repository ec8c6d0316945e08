"""HTML pages as sequences of text blocks with their tag paths."""

from __future__ import annotations

import html
import re
import zlib
from dataclasses import dataclass

import numpy as np

BLOCK_TAGS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol option p pre search section select summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose text is never shown as text of the page.
HIDDEN = set("head script style template noscript svg math iframe object canvas audio video textarea title datalist".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag of the key ends an open element of the values, up to the nearest container.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
CONTAINERS = {"ul", "ol", "menu", "dl", "table", "select", "div", "article", "section", "body"}
ATTRIBUTES = r"""(?:"[^"]*"|'[^']*'|[^'">])*+(?:>|$)|[^>]*(?:>|$)"""
TOKEN = re.compile(rf"<!--.*?(?:-->|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)({ATTRIBUTES})|([^<]+|<)", re.S)
HEAD_ENDS = re.compile(r"</head[^>]*>?|(?=<body)", re.I)
NAMES = re.compile(r"\b(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
PART = re.compile(r"[a-z]+|\d+")


@dataclass
class Block:
    """A run of text between block tags: white space is single and trimmed, references are decoded."""

    text: str
    path: list[str]  # tags and name parts of the open elements, outermost first
    tag: str
    linked: float  # share of its characters inside links


def blocks(page: str) -> list[Block]:
    """The visible text blocks of a page in order; tolerates missing and stray end tags."""
    out: list[Block] = []
    stack: list[tuple[str, list[str]]] = []
    text: list[str] = []
    links = 0

    def flush() -> None:
        nonlocal links
        body = " ".join(html.unescape("".join(text)).split())
        if body:
            path = [p for tag, names in stack for p in (tag, *names)]
            tag = next((t for t, _ in reversed(stack) if t in BLOCK_TAGS), "")
            out.append(Block(body, path, tag, min(1.0, links / max(1, sum(map(len, text))))))
        text.clear()
        links = 0

    def close(tag: str) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] == tag:
                del stack[i:]
                return

    at = 0
    while at < len(page):
        m = TOKEN.match(page, at)
        at = m.end()
        if m[4] is not None:
            text.append(m[4])
            if any(t == "a" for t, _ in stack):
                links += len(m[4])
            continue
        if m[2] is None:
            continue
        tag, end, rest = m[2].lower(), bool(m[1]), m[3].removesuffix(">")
        if tag in HIDDEN:
            if not end and not rest.endswith("/"):
                closing = (HEAD_ENDS if tag == "head" else re.compile(rf"</{re.escape(tag)}[^>]*>?", re.I)).search(page, at)
                at = closing.end() if closing else len(page)
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCK_TAGS:
            flush()
        if end:
            close(tag)
        elif tag not in VOID:
            if tag in BLOCK_TAGS and tag not in ("html", "body"):
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == "p":
                        del stack[i:]
                        break
                    if stack[i][0] in ENDS.get(tag, ()):
                        del stack[i:]
                        if tag != "tr":
                            break
                    elif stack[i][0] in CONTAINERS:
                        break
            names = [p for a in NAMES.findall(rest) for p in PART.findall("".join(a).lower())] if rest else []
            if not rest.endswith("/"):
                stack.append((tag, names))
    flush()
    return out


PATH, OWN, WORDS, NUMBERS = 160, 24, 64, 10
WIDTH = PATH + OWN + WORDS + NUMBERS


def _slot(word: str, size: int) -> int:
    return zlib.crc32(word.encode()) % size


def vectors(found: list[Block]) -> np.ndarray:
    """One row for each block: hashed path, hashed own tag, hashed words of the whole text, and shape."""
    x = np.zeros((len(found), WIDTH), np.float32)
    n = len(found)
    for i, b in enumerate(found):
        for p in b.path:
            x[i, _slot(p, PATH)] = 1
        x[i, PATH + _slot(b.tag, OWN)] = 1
        words = b.text.lower().split()
        share = 1 / np.sqrt(len(words))
        for w in words if len(words) < 40 else set(words):
            x[i, PATH + OWN + zlib.crc32(w.encode()) % WORDS] += share
        marks = sum(b.text.count(c) for c in ".,;!?")
        x[i, -NUMBERS:] = [
            np.log1p(len(words)) / 4, np.log1p(len(b.text)) / 6, b.linked, marks / len(words), float(b.text[-1] in ".!?…\"'"), i / n, (n - i) / n,
            float(i == 0), sum(c.isdigit() for c in b.text[:400]) / min(400, len(b.text)), len(b.path) / 20,
        ]
    return np.minimum(x, 4)

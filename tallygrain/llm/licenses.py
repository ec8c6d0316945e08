"""Licence notices found by conditional compression and confirmed by their exact wording.

Candidate windows are stretches of words that hold a cue. For templates of some length they are at
least twice as long as a notice may be and overlap by half, so that every notice lies whole in one.
A window is compressed alone and with each template of that length as a raw zstandard dictionary;
the templates are ranked by what they save and confirmed in this order, as long as they save
anything. A template is confirmed word by word: the words that differ are few, none of them is a
number or a name of a licence, and no negation stands before it. Articles and the like don't count,
nor does the spelling of licence. Of notices that overlap the longest stays, then the one with the
fewest differences, then the template listed first.

Blocks are runs of lines with cue words, grown to the lines of the notices that reach into them.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygrain.llm.frames import per_batch, pick, table
from tallygrain.llm.license_texts import TEMPLATES

#: Words of notices, in lower case; one of them must be in a text for its lines to be looked at.
KEYS = [
    b"license", b"licence", b"copyright", b"(c)", b"\xc2\xa9", b"rights reserved", b"public domain", b"spdx", b"warrant", b"redistribut", b"permission",
    b"creative commons", b"cc by", b"cc-by", b"cc0", b"gpl", b"noninfring", b"liable", b"liability", b"as is", b"sublicens", b"hereby", b"furnished",
    b"copyleft", b"free software", b"unencumbered", b"mozilla", b"apache", b"merchantab",
]
CUES = re.compile(rb"(?<![a-z\x80-\xff])(?:" + b"|".join(map(re.escape, KEYS)) + rb")")
#: One of these sets of words is in a text that is searched, however its lines are broken.
SIGNS = [k.split() for k in KEYS if k != b"as is"]
BYTE_WORD = re.compile(rb"[a-z]+|\d+(?:\.\d+)*")
#: Share of a template's words that may differ.
DIFFERENT = 0.1
#: Words that may come or go in a notice.
PLAIN = set("a an the this is version v".split())
SAME = {"licence": "license", "licenced": "licensed", "licences": "licenses"}
#: Beginnings of words that make a window a candidate.
CUE_WORD = re.compile("licen|copyright|reserved|domain|spdx|warrant|redistribut|permi|commons|cc|gpl|noninfring|liab|sublicen|hereby|furnish|software|disclaim|distribut|waive|rights|accompan|eclipse|program|mozilla|mpl|apache|merchantab|condition")
#: Before a notice, in the same sentence, these words deny it.
NEGATIONS = set("not never no nor without t cannot".split())
#: The level that finds also short matches in short windows: lower ones save nothing by some notices of four words.
LEVEL = 19
#: Shortest window, in words.
WINDOW = 16
#: Words that make another licence of a wording; they may not differ.
TELLING = set("no not non without nc nd sa by cc0 lesser affero gpl lgpl agpl mit bsd apache mozilla isc sharealike noncommercial noderivatives noderivs".split())


def words_at(text: bytes) -> tuple[list[str], list[tuple[int, int]]]:
    """The words of a lower-case text that count, and where their bytes are."""
    words, at = [], []
    for m in BYTE_WORD.finditer(text):
        word = m[0].decode()
        if word not in PLAIN:
            words.append(SAME.get(word, word))
            at.append(m.span())
    return words, at


def words_of(text: str) -> list[str]:
    return words_at(text.lower().encode())[0]


def candidate_blocks(text: bytes) -> list[tuple[int, bytes]]:
    """(first byte, block): runs of lines with cue words at the start of a word; one line without may lie between two with."""
    low = text.lower()
    if not any(k in low for k in KEYS):
        return []
    out: list[tuple[int, bytes]] = []
    at, open_at, end, gap = 0, -1, 0, 0
    for line in low.split(b"\n"):
        if CUES.search(line):
            open_at, end, gap = (at if open_at < 0 else open_at), at + len(line), 0
        elif open_at >= 0:
            gap += 1
            if gap > 1 or not line.strip():
                out.append((open_at, text[open_at:end]))
                open_at = -1
        at += len(line) + 1
    if open_at >= 0:
        out.append((open_at, text[open_at:end]))
    return out


@dataclass
class Match:
    license: str
    saved: float  # share of the block's compressed size that the template saves
    differences: int  # words that differ from the template


class Scanner:
    def __init__(self, templates: list[tuple[str, str]] = TEMPLATES):
        self.names = [n for n, _ in templates]
        self.words = [words_of(t) for _, t in templates]
        self.alone = zstandard.ZstdCompressor(level=LEVEL)
        self.given = []
        for words in self.words:
            given = zstandard.ZstdCompressionDict(" ".join(words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            given.precompute_compress(level=LEVEL)
            self.given.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=given))
        #: Words that may differ, and words of a run that is then whole somewhere, of each template.
        self.may = [int(DIFFERENT * len(w)) for w in self.words]
        self.run = [-(-(len(w) - d) // (d + 1)) for w, d in zip(self.words, self.may, strict=True)]
        self.places: dict[tuple[str, str], list[tuple[int, int]]] = {}
        #: The templates of each window size.
        self.sizes: dict[int, list[int]] = {}
        for i, w in enumerate(self.words):
            if self.run[i] < 2:
                raise ValueError("a template needs two words that count")
            for q in range(len(w) - self.run[i] + 1):
                self.places.setdefault((w[q], w[q + 1]), []).append((i, q))
            size = WINDOW
            while size < 2 * (len(w) + self.may[i]):
                size *= 2
            self.sizes.setdefault(size, []).append(i)
        self.known: dict[tuple[int, str], list[tuple[int, int]]] = {}

    def ranked(self, form: str, size: int) -> list[tuple[int, int]]:
        """(bytes saved, template) of the templates of a window size that save any, the most first."""
        if (size, form) not in self.known:
            if len(self.known) > 20_000:
                self.known.clear()
            block = form.encode()
            alone = len(self.alone.compress(block))
            saved = [(alone - len(self.given[i].compress(block)), i) for i in self.sizes[size]]
            self.known[size, form] = sorted((r for r in saved if r[0] > 0), key=lambda r: (-r[0], r[1]))
        return self.known[size, form]

    def windows(self, words: list[str], size: int) -> list[tuple[int, int]]:
        """(first word, word after the last) of the windows with cues; they overlap by half."""
        half = size // 2
        parts = sorted({p // half for p, w in enumerate(words) if CUE_WORD.match(w)})
        starts = sorted({max(0, k + d) for k in parts for d in (-1, 0)})
        return [(k * half, min(len(words), (k + 2) * half)) for k in starts]

    def differences(self, words: list[str], lo: int, hi: int, template: list[str]) -> tuple[int, bool, int, int]:
        """(words of ``words[lo:hi]`` that differ, does any of them tell licences apart, first and last matched word)."""
        block = words[lo:hi]
        parts = [m for m in SequenceMatcher(None, block, template, autojunk=False).get_matching_blocks() if m.size]
        if not parts:
            return len(template), True, lo, lo
        first, last = parts[0].a, parts[-1].a + parts[-1].size
        extra, missing, a, b = [], [], first, 0
        for m in parts:
            extra += block[a : m.a]
            missing += template[b : m.b]
            a, b = m.a + m.size, m.b + m.size
        missing += template[b:]
        first, last = first + lo, last + lo
        # what follows a shortened end or stands before a shortened start would have been its place
        around = (words[max(0, first - 2) : first] if parts[0].b else []) + (words[last : last + 2] if b < len(template) else [])
        telling = any(w in TELLING or w[0].isdigit() for w in extra + missing) or any(w in TELLING for w in around)
        return len(extra) + len(missing), telling, first, last

    def denied(self, text: bytes, words: list[str], at: list[tuple[int, int]], first: int, last: int) -> bool:
        """Does a negation stand before the notice, or does its identifier go on behind it?"""
        before = first > 0 and words[first - 1] in NEGATIONS and not re.search(rb"[.!?;:]", text[at[first - 1][1] : at[first][0]])
        return before or (words[first] == "spdx" and bool(re.match(rb"\+|[-.]\w", text[at[last - 1][1] :][:2])))

    def confirm(self, text: bytes, words: list[str], at: list[tuple[int, int]], i: int, start: int) -> set[tuple[int, int, int, int, int]]:
        """Template ``i`` with its first word at ``start``: (order, differences, template, first word, word after the last) of notices."""
        template, d, out = self.words[i], self.may[i], set()
        # as long as the template, or with room for words that were put in
        for room in {0, d}:
            count, telling, first, last = self.differences(words, max(0, start - room), start + len(template) + room, template)
            if not telling and count <= d and not self.denied(text, words, at, first, last):
                out.add((count - len(template), count, i, first, last))
        return out

    def find(self, block: str) -> list[Match]:
        """Confirmed notices of a block in the order they stand; several may stand in one block."""
        low = block.encode().lower()
        return [m for m, _, _ in self.notices(low, *words_at(low))]

    def notices(self, text: bytes, words: list[str], at: list[tuple[int, int]]) -> list[tuple[Match, int, int]]:
        """(notice, first word, word after the last) in the order they stand, of a lower-case text with its words."""
        tried, confirmed = set(), set()
        for size in self.sizes:
            for lo, hi in self.windows(words, size):
                held: dict[int, list[int]] = {}
                for p in range(lo, hi - 1):
                    for i, q in self.places.get((words[p], words[p + 1]), ()):
                        if words[p : p + self.run[i]] == self.words[i][q : q + self.run[i]]:
                            held.setdefault(i, []).append(p - q)
                for _, i in self.ranked(" ".join(words[lo:hi]), size):
                    for start in held.get(i, ()):
                        if (i, start) not in tried:
                            tried.add((i, start))
                            confirmed |= self.confirm(text, words, at, i, start)
        return self.settled(words, confirmed)

    def settled(self, words: list[str], confirmed: set[tuple[int, int, int, int, int]]) -> list[tuple[Match, int, int]]:
        """Of the confirmed notices that overlap, the first by order, differences and template."""
        taken = bytearray(len(words))
        found = []
        for _, count, i, first, last in sorted(confirmed):
            if not any(taken[first:last]):
                taken[first:last] = b"\1" * (last - first)
                form = " ".join(words[first:last]).encode()
                saved = 1 - len(self.given[i].compress(form)) / len(self.alone.compress(form))
                found.append((Match(self.names[i], round(saved, 4), count), first, last))
        return sorted(found, key=lambda f: f[1])

    def scan(self, text: bytes) -> list[tuple[int, bytes, list[Match]]]:
        """(first byte, block, its notices): candidate blocks, grown to the lines of the notices that reach into them."""
        low = text.lower()
        if not any(all(w in low for w in s) for s in SIGNS):
            return []
        spans = [(at, at + len(block), None) for at, block in candidate_blocks(text)]
        words, at = words_at(low)
        for match, first, last in self.notices(low, words, at):
            end = text.find(b"\n", at[last - 1][1])
            spans.append((text.rfind(b"\n", 0, at[first][0]) + 1, len(text) if end < 0 else end, match))
        out: list[tuple[int, int, list[Match]]] = []
        for a, b, match in sorted(spans, key=lambda s: s[:2]):
            if out and a < out[-1][1]:
                a, b, held = out[-1][0], max(b, out[-1][1]), out.pop()[2]
            else:
                held = []
            out.append((a, b, held + [match] * (match is not None)))
        return [(a, text[a:b], held) for a, b, held in out]


def scanned(docs: DataFrame) -> DataFrame:
    """(doc_id, start, block, licenses array of (license, saved, differences)): one row for each candidate block.

    ``start`` is the block's first byte in the UTF-8 text. A block without a confirmed notice has an
    empty array. Null and empty texts have no blocks. Each row is searched by itself, so repeated rows
    give repeated blocks and a null id stays null; an empty table gives none, further columns are left out.
    """

    def rows(batch: pa.RecordBatch) -> dict | None:
        scanner = Scanner()
        names = batch.column("doc_id").to_pylist()
        texts = batch.column("text").cast(pa.large_binary()).to_pylist()
        found = [(names[i], at, block.decode(), held) for i, text in enumerate(texts) for at, block, held in scanner.scan(text or b"")]
        if not found:
            return None
        return {
            "doc_id": pa.array([r[0] for r in found], pa.int64()),
            "start": pa.array([r[1] for r in found], pa.int64()),
            "block": [r[2] for r in found],
            "licenses": pa.array(
                [[vars(m) for m in r[3]] for r in found],
                pa.list_(pa.struct([("license", pa.string()), ("saved", pa.float64()), ("differences", pa.int32())])),
            ),
        }

    taken = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return per_batch(taken, rows, "doc_id long, start long, block string, licenses array<struct<license:string,saved:double,differences:int>>")


def license_query(spark, sf_dir: str) -> DataFrame:
    """One row for each notice found, and one with null license for each candidate block without any."""
    blocks = scanned(table(spark, sf_dir, "documents"))
    one = blocks.select("doc_id", "start", F.length("block").alias("block_chars"), F.posexplode_outer("licenses").alias("place", "m"))
    return one.select("doc_id", "start", "block_chars", "place", F.col("m.license").alias("license"), F.col("m.saved").alias("saved"), F.col("m.differences").alias("differences"))

"""BPE with word ends over a trie of distinct words.

The encoding of a prefix is the encoding of a shorter prefix and one last token, and that token is
the only suffix that forms a stable pair with the last token before it. So a depth-first walk over
the trie of a batch's distinct words needs one last token for each node, and prefixes that words
share are encoded once. A word's last symbol carries the end mark; it is a step of its own at the
place where the word ends.
"""

from __future__ import annotations

import json
import unicodedata

import regex

MARK = "</w>"
#: White space as the vocabulary's normaliser knows it.
SPACE = r"\t-\r \x85\xa0  -     　"
WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+"
#: Characters that are classed alike by all versions of Unicode in use: Latin, Greek, Cyrillic, signs.
PLAIN = r"[\x00-\u0377\u0384-\u0523\u1e00-\u1eff\u2000-\u205f\u20a0-\u20b5\u3000]*"
#: Words of earlier batches that a worker remembers.
REMEMBERED = 600_000


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte: itself if printable, else one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class TrieBpe:
    """Encoder and decoder of one vocabulary file in the tokenizers format."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        self.ids: dict[str, int] = data["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.numbers = {**self.ids, **self.special}
        self.names = {i: t for t, i in {**self.ids, **self.special}.items()}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in data["model"]["merges"]]
        self.rank = {p: r for r, p in enumerate(pairs)}
        self.longest = max(len(t.removesuffix(MARK)) for t in self.ids)
        self.letters = {b: c for b, c in byte_characters().items()}
        self.words = regex.compile(WORDS)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.plain = regex.compile(PLAIN)
        self.path = path
        self.made: dict[str, list[tuple[str, str]]] = {}
        for a, b in pairs:
            self.made.setdefault(a + b, []).append((a, b))
        self.spines: dict[tuple[str, bool], list[tuple[str, float]]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.whole: dict[str, bool] = {}
        self.known_ids: dict[str, str] = {}
        self.known_text: dict[str, str] = {}

    def merge(self, symbols: list[str]) -> list[str]:
        """Plain BPE: again and again the leftmost pair of the lowest rank."""
        while len(symbols) > 1:
            rank, at = min((self.rank.get(p, len(self.rank)), i) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)))
            if rank == len(self.rank):
                break
            symbols = [*symbols[:at], symbols[at] + symbols[at + 1], *symbols[at + 2 :]]
        return symbols

    @staticmethod
    def symbols(token: str) -> list[str]:
        body = token.removesuffix(MARK)
        return [*body[:-1], token[len(body) - 1 :]] if body != token else list(token)

    def spine(self, token: str, right: bool) -> list[tuple[str, float]]:
        """The symbols that stand at one edge of a token while it is built, with the rank at which each ends."""
        found = self.spines.get((token, right))
        if found is None:
            found, part, until = [], token, float("inf")
            while True:
                found.append((part, until))
                ways = self.made.get(part)
                if not ways:
                    break
                pair = ways[0] if len(ways) == 1 else self.final_pair(part)
                part, until = pair[right], self.rank[pair]
            self.spines[token, right] = found
        return found

    def final_pair(self, token: str) -> tuple[str, str]:
        """The merge that completes a token, where several would give its string."""
        symbols = self.symbols(token)
        while len(symbols) > 2:
            rank, at = min((self.rank.get(p, len(self.rank)), i) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)))
            symbols = [*symbols[:at], symbols[at] + symbols[at + 1], *symbols[at + 2 :]]
        return symbols[0], symbols[1]

    def stable(self, a: str, b: str) -> bool:
        """Does BPE leave the two tokens as they are, side by side?

        It doesn't if, while both are built in the order of ranks, the symbol at the end of the one
        and that at the start of the other would merge before either is used up (of two equal
        pairs the left one goes first).
        """
        found = self.pairs.get((a, b))
        if found is None:
            found = True
            for x, x_ends in self.spine(a, True):
                for y, y_ends in self.spine(b, False):
                    rank = self.rank.get((x, y))
                    if rank is not None and rank < x_ends and rank <= y_ends:
                        found = False
            if len(self.pairs) >= 500_000:
                self.pairs.clear()
            self.pairs[a, b] = found
        return found

    def alone(self, token: str) -> bool:
        found = self.whole.get(token)
        if found is None:
            found = self.whole[token] = self.merge(self.symbols(token)) == [token]
        return found

    def _last(self, path: str, depth: int, end: str, last: list[str | None]) -> str:
        """Last token of the path's first ``depth`` characters and ``end``.

        last[i] is that of the first i characters; where it is still open, it is found now.
        """
        ids, pairs = self.ids, self.pairs
        for start in range(max(0, depth - self.longest), depth):
            token = path[start:depth] + end
            if token in ids:
                if not start:
                    if self.alone(token):
                        return token
                    continue
                before = last[start]
                if before is None:
                    before = last[start] = self._last(path, start, "", last)
                good = pairs.get((before, token))
                if good or good is None and self.stable(before, token):
                    return token
        raise ValueError(f"no token ends {path[:depth]!r}")

    def encode_words(self, words: list[str]) -> dict[str, list[str]]:
        """Tokens of each distinct word, given in the characters of ``letters``.

        A node's last token is found when a word below first asks for it and holds for all words
        below; far down, where one node might ask for a long chain, it is found on the way.
        """
        trie: dict = {}
        for word in words:
            node = trie
            for c in word:
                node = node.setdefault(c, {})
            node[""] = word
        out: dict[str, list[str]] = {}
        last: list[str | None] = []
        todo = [(0, "", trie)]
        while todo:
            depth, path, node = todo.pop()
            del last[depth:]
            last.append(self._last(path, depth, "", last) if depth > 2 * self.longest else None)
            word = node.pop("", None)
            if word is not None:
                tail = self._last(path, depth, MARK, last)
                tokens, at = [tail], depth - len(tail) + len(MARK)
                while at:
                    token = last[at]
                    if token is None:
                        token = last[at] = self._last(path, at, "", last)
                    tokens.append(token)
                    at -= len(token)
                out[word] = tokens[::-1]
            depth += 1
            todo += [(depth, path + c, child) for c, child in node.items()]
        return out

    def pieces(self, text: str) -> list[str]:
        """Words of a text in order; strings of special tokens are pieces of their own."""
        out: list[str] = []
        for i, part in enumerate(self.specials.split(text) if "<|" in text else [text]):
            if i % 2:
                out.append(part)
            elif part.isascii() or self.plain.fullmatch(part):
                if not part.isascii():
                    part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
                out += self.words.findall(part.lower())
            else:
                out += self.library_pieces(part)
        return out

    def library_pieces(self, text: str) -> list[str]:
        """Words as the library itself splits them, for scripts in which versions of Unicode differ."""
        from tokenizers import Tokenizer

        if not hasattr(self, "library"):
            self.library, self.bytes = Tokenizer.from_file(self.path), {c: b for b, c in self.letters.items()}
        found = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return [bytes(self.bytes[c] for c in w).decode() for w, _ in found]

    def encode_batch(self, texts: list[str]) -> list[tuple[str, str]]:
        """(ids in decimal joined by a space, decoded text) of each text."""
        split = [self.pieces(t) for t in texts]
        fresh = set().union(*split) - self.known_ids.keys()
        if len(self.known_ids) + len(fresh) > REMEMBERED:
            self.known_ids.clear()
            self.known_text.clear()
            fresh = set().union(*split)
        spelt = {w: "".join(map(self.letters.__getitem__, w.encode())) for w in fresh if w not in self.special}
        found = self.encode_words(list(set(spelt.values())))
        for word in fresh:
            tokens = found[spelt[word]] if word in spelt else [word]
            self.known_ids[word] = " ".join(str(self.numbers[t]) for t in tokens)
            self.known_text[word] = " ".join(tokens)
        ids, names = self.known_ids.__getitem__, self.known_text.__getitem__
        return [(" ".join(map(ids, words)), " ".join(map(names, words))) for words in split]

    def decode(self, ids: list[int]) -> str:
        """Names of the tokens joined by spaces, as the file has no decoder; unknown ids are left out."""
        return " ".join(self.names[i] for i in ids if i in self.names)


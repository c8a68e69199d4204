"""Byte-pair vocabularies: exact merges without replaying them over a text.

Two facts carry both operators of this module's users.  A token sequence is
the byte-pair encoding of its bytes exactly when every adjacent pair of it is
the encoding of the pair's own bytes; and every prefix has one such sequence.
So it is enough to know which neighbours are *compatible*, which is found by
merging the few bytes of the pair once and then remembered.

``encode_word`` walks forward from the longest match of an Aho-Corasick
automaton (bytes as Latin-1 characters), tries shorter ones if a neighbour is
incompatible, and steps back where none fits; a position once left by stepping
back is never tried again, so the work is linear in the bytes.

``prefix_counts`` fills a table over all prefixes of a word: the last token of
prefix *i* is the one match ending there that is compatible with the last
token of the prefix before it, and its count is that prefix's count plus one.
"""

from __future__ import annotations

import base64
import json
import re
from array import array
from functools import cached_property, lru_cache
from itertools import pairwise

import ahocorasick
import regex

_MEMO = 1 << 20  # entries a memo may hold before it starts anew
#: A blank that ends one word and starts the next in every pre-tokenised text.
_SAFE_BLANK = re.compile(r"(?<=\S) (?=\S)")
_TWO_BLANKS = re.compile(r"\s\s")


def split_pattern(pattern: str) -> regex.Pattern:
    """The word pattern with white space as Unicode's property, as the
    compiled libraries read it (Python counts four more control characters)."""
    pattern = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
    return regex.compile(pattern)


def safe_pieces(text: str) -> list[str]:
    """``text`` cut before blanks that stand alone between two non-blanks.

    Words never cross such a cut.  Every piece after the first had one blank
    before it, which is left out here."""
    if _TWO_BLANKS.search(text):
        return _SAFE_BLANK.split(text)
    return text.split(" ")


class Vocabulary:
    """Tokens by bytes, and the merge rule: the priority of joining a pair."""

    def __init__(self, ids: dict[bytes, int], joins: dict[tuple[bytes, bytes], int] | None, whole_words: bool) -> None:
        self.ids, self.joins, self.whole_words = ids, joins, whole_words
        self.bytes_of = {i: t for t, i in ids.items()}
        self._fits: dict[tuple[int, int], bool] = {}
        self.longest = max(map(len, ids), default=1)

    @cached_property
    def matcher(self) -> ahocorasick.Automaton:
        """All tokens that merges can reach; built where texts are encoded."""
        matcher = ahocorasick.Automaton()
        for token, i in self.ids.items():
            if token and (len(token) == 1 or self.merge(token) == [token]):
                matcher.add_word(token.decode("latin-1"), (i, len(token)))
        matcher.make_automaton()
        return matcher

    @cached_property
    def sizes(self) -> dict[int, int]:
        return {i: len(t) for t, i in self.ids.items()}

    @cached_property
    def shorter(self) -> dict[int, int]:
        """The longest reachable token that properly begins a token, or -1."""
        reachable = {t.encode("latin-1") for t in self.matcher}
        out = {}
        for token, i in self.ids.items():
            starts = (token[:size] for size in range(len(token) - 1, 0, -1))
            out[i] = next((self.ids[t] for t in starts if t in reachable), -1)
        return out

    def priority(self, a: bytes, b: bytes) -> int | None:
        return self.ids.get(a + b) if self.joins is None else self.joins.get((a, b))

    def merge(self, word: bytes) -> list[bytes]:
        """The merges replayed one by one; for words of a few bytes."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = self.priority(parts[i], parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, a: int, b: int) -> bool:
        """Whether ``b`` may follow ``a``: their bytes encode to just them."""
        known = self._fits.get((a, b))
        if known is None:
            if len(self._fits) >= _MEMO:
                self._fits.clear()
            left, right = self.bytes_of[a], self.bytes_of[b]
            known = self._fits[a, b] = self.merge(left + right) == [left, right]
        return known

    def encode_word(self, word: bytes) -> list[int]:
        if self.whole_words and word in self.ids:
            return [self.ids[word]]
        text, n, fits, known = word.decode("latin-1"), len(word), self.fits, self._fits
        tokens = [m[0] for _, m in self.matcher.iter_long(text)]  # leftmost-longest, end to end
        for k, pair in enumerate(pairwise(tokens), 1):
            able = known.get(pair)
            if not able and (able is not None or not fits(*pair)):
                break
        else:
            return tokens
        token = tokens[k]  # the longest match there is incompatible
        del tokens[k:]
        longest, path, match = self.longest, self.matcher.longest_prefix, self.matcher.get
        sizes, shorter = self.sizes, self.shorter
        at, token = sum([sizes[t] for t in tokens]), shorter[token]
        dead = bytearray(n + 1)
        while at < n:
            while token >= 0:
                end = at + sizes[token]
                if not dead[end]:
                    if not tokens:
                        break
                    before = tokens[-1]
                    able = known.get((before, token))
                    if able or (able is None and fits(before, token)):
                        break
                token = shorter[token]
            if token >= 0:
                tokens.append(token)
                at = end
                if at < n:
                    reach = path(text[at : at + longest])
                    token = match(text[at : at + reach], None)
                    while not token:
                        reach -= 1
                        if reach < 1:
                            raise ValueError("the vocabulary lacks single bytes of this word")
                        token = match(text[at : at + reach], None)
                    token = token[0]
            else:
                dead[at] = 1
                if not tokens:
                    raise ValueError("the vocabulary lacks single bytes of this word")
                token = tokens.pop()
                at -= sizes[token]
                token = shorter[token]
        return tokens

    def prefix_counts(self, word: bytes) -> array:
        """Tokens of word[:i] for every i from 0 to the word's length."""
        n = len(word)
        counts, last = array("l", bytes(8 * (n + 1))), array("l", [-1]) * (n + 1)
        fits = self.fits
        for end, (token, size) in self.matcher.iter(word.decode("latin-1")):
            start = end + 1 - size
            if last[end + 1] < 0 and (start == 0 or (last[start] >= 0 and fits(last[start], token))):
                last[end + 1] = token
                counts[end + 1] = counts[start] + 1
        return counts

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def _byte_letters() -> dict[str, int]:
    """The printable letters that byte-level vocabulary files write for bytes:
    printable Latin-1 stands for itself, the others follow from U+0100."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def load_ranks(path: str) -> Vocabulary:
    """A rank file: a base64 token and its rank on each line; ids are ranks."""
    with open(path, "rb") as file:
        ids = {base64.b64decode(t): int(r) for t, r in (line.split() for line in file if line.strip())}
    return Vocabulary(ids, None, whole_words=True)


@lru_cache(maxsize=2)
def load_json(path: str) -> tuple[Vocabulary, dict[str, int]]:
    """A byte-level tokenizer file: its vocabulary and its added strings."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    letters, model = _byte_letters(), spec["model"]
    added = {t["content"]: t["id"] for t in spec["added_tokens"]}
    if spec["normalizer"] or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        raise ValueError("only byte-level vocabularies without a normaliser are read here")

    def raw(token: str) -> bytes:
        return bytes(letters[c] for c in token)

    ids = {raw(t): i for t, i in model["vocab"].items() if t not in added}
    pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    joins = {(raw(a), raw(b)): i for i, (a, b) in enumerate(pairs)}
    return Vocabulary(ids, joins, whole_words=bool(model.get("ignore_merges"))), added

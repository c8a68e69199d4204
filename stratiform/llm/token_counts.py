"""Token counts (operator 5): exact counts at every prefix of a text.

``bpe.Vocabulary.prefix_counts`` stores, for each distinct word, the exact
token count of each of its prefixes.  A text's counts are running sums over
its pieces plus the table of the piece a cut falls in, so "how many tokens has
this prefix" and "where does the budget end" need no re-encoding.

Defined cases: null or empty text: 0 bytes, 0 tokens; rows keep their repeats;
added strings of the vocabulary inside a text count as one token each, as the
library does by default.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from stratiform.llm import bpe
from stratiform.llm.common import id_text, table

_PIECES = 1 << 20


class PrefixCounter:
    def __init__(self, path: str, pattern: str) -> None:
        self.vocab, added = bpe.load_json(path)
        self.words = bpe.split_pattern(pattern)
        self.added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.marks = tuple(added)
        self.tables: dict[str, tuple[int, ...] | int] = {}
        self.pieces: tuple[dict[str, int], dict[str, int]] = ({}, {})

    def table(self, word: str):
        """Counts of every byte prefix of a word."""
        counts = self.tables.get(word)
        if counts is None:
            counts = self.vocab.prefix_counts(word.encode()).tolist()
            if len(word) < 64:
                counts = bytes(counts) if max(counts) < 256 else tuple(counts)
                if len(self.tables) >= _PIECES:
                    self.tables.clear()
                self.tables[word] = counts
        return counts

    def piece(self, piece: str, later: bool) -> int:
        memo = self.pieces[later]
        count = memo.get(piece)
        if count is None:
            count = sum(self.table(w)[-1] for w in self.words.findall(" " + piece if later else piece))
            if len(piece) < 64:
                if len(memo) >= _PIECES:
                    memo.clear()
                memo[piece] = count
        return count

    def total(self, text: str) -> int:
        if self.added and any(m in text for m in self.marks):
            return sum(1 if i % 2 else self.total(t) for i, t in enumerate(self.added.split(text)))
        first, *rest = bpe.safe_pieces(text)
        memo = self.pieces[1]
        try:
            return self.piece(first, False) + sum(map(memo.__getitem__, rest))
        except KeyError:
            return self.piece(first, False) + sum(self.piece(p, True) for p in rest)

    def cuts(self, text: str) -> tuple[list[int], list[int]]:
        """Code points and tokens of ``text`` up to every place where pieces meet."""
        ends, counts, at, total = [0], [0], 0, 0
        segments = self.added.split(text) if self.added else [text]
        for i, segment in enumerate(segments):
            if i % 2:
                at, total = at + len(segment), total + 1
                ends.append(at)
                counts.append(total)
            elif segment:
                for nth, piece in enumerate(bpe.safe_pieces(segment)):
                    at += len(piece) + (nth > 0)
                    total += self.piece(piece, nth > 0)
                    ends.append(at)
                    counts.append(total)
        return ends, counts

    def _within(self, piece: str):
        """Counts of a piece's code-point prefixes, from the words' tables.

        Cutting a word leaves the words before it as they are, but for runs of
        blanks, whose last blank belongs to the next word only if one follows:
        there the cut piece is split into words once more."""
        spaced = any(c.isspace() for c in piece[1:])
        if spaced or "'" in piece:
            for n in range(1, len(piece) + 1):
                yield sum(self.table(w)[-1] for w in self.words.findall(piece[:n]))
            return
        before = 0
        for word in self.words.findall(piece):
            counts, size = self.table(word), 0
            for char in word:
                size += len(char.encode())
                yield before + counts[size]
            before += counts[-1]

    def longest_within(self, text: str, budget: int) -> int:
        """Code points of the longest prefix up to which no prefix has more
        than ``budget`` tokens."""
        if len(text) * 4 <= budget:
            return len(text)
        at, total = 0, 0
        segments = self.added.split(text) if self.added else [text]
        for i, segment in enumerate(segments):
            for nth, piece in enumerate([segment] if i % 2 else bpe.safe_pieces(segment)):
                piece = " " + piece if nth else piece
                if total + 4 * len(piece) > budget:  # a piece has at most one token a byte
                    if i % 2:  # a cut inside an added string is ordinary text
                        steps = [sum(self.table(w)[-1] for w in self.words.findall(piece[:n])) for n in range(1, len(piece))] + [1]
                    else:
                        steps = self._within(piece)
                    for n, count in enumerate(steps):
                        if total + count > budget:
                            return at + n
                at += len(piece)
                total += 1 if i % 2 else self.piece(piece[1:], True) if nth else self.piece(piece, False)
        return len(text)

    def at(self, text: str, cut: int) -> int:
        """Tokens of text[:cut]."""
        return self.total(text[:cut])


@lru_cache(maxsize=2)
def counter(path: str, pattern: str) -> PrefixCounter:
    return PrefixCounter(path, pattern)


def token_counts(
    docs: DataFrame, path: str, pattern: str, budget: int, id_col: str = "doc_id", text_col: str = "text", with_cuts: bool = False
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, budget_chars[, cut_chars, cut_tokens]).

    ``budget_chars``: code points of the longest prefix within the budget.
    ``with_cuts`` adds the running counts where pieces meet (arrays)."""

    def run(batches):
        own = counter(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = [t or "" for t in part.column(1).to_pylist()]
                totals = [own.total(t) for t in texts]
                columns = [
                    part.column(0),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array(totals, pa.int64()),
                    pa.array([n > budget for n in totals], pa.bool_()),
                    pa.array([own.longest_within(t, budget) for t in texts], pa.int64()),
                ]
                if with_cuts:
                    cuts = [own.cuts(t) for t in texts]
                    columns += [pa.array([c[i] for c in cuts], pa.list_(pa.int64())) for i in (0, 1)]
                yield pa.record_batch(columns, names=names)

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, budget_chars long"
    schema += ", cut_chars array<long>, cut_tokens array<long>" * with_cuts
    names = [c.split()[0] for c in schema.split(", ")]
    return id_text(docs, id_col, text_col).mapInArrow(run, schema)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN, 512)

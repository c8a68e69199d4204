"""Byte-level BPE encoding and decoding (operator 9).

``encode`` adds a text's token ids, ``decode`` the bytes of ids, ``round_trip``
digests both; each is one Arrow pass without a shuffle.  Words repeat, so a task keeps the ids of words
it has met (a bounded memo); each new word goes through the automaton and the
compatibility walk of ``bpe.Vocabulary.encode_word``.

Defined cases: a null or empty text has no ids and decodes to no bytes; rows
keep their order and repeats; other columns are left out (join by the id).
"""

from __future__ import annotations

from array import array
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm import bpe
from stratiform.llm.common import id_text, table

_PIECES, _WORDS = 3 << 18, 1 << 18  # entries of the memos: about 200 MB in all
_BLOCK = 1 << 17  # ids joined at once


class _Memo(dict):
    """Ids by string: what is missing is made, and kept if it is short."""

    def __init__(self, make, entries: int) -> None:
        self.make, self.entries = make, entries

    def __missing__(self, key: str) -> bytes:
        ids = self.make(key)
        if len(key) < 64:
            if len(self) >= self.entries:
                self.clear()
            self[key] = ids
        return ids


class WordCodec:
    """Ids (little-endian 32-bit) of texts, with a memo of pieces and words."""

    def __init__(self, path: str, pattern: str) -> None:
        self.vocab, self.words = bpe.load_ranks(path), bpe.split_pattern(pattern)
        self.known = _Memo(self.word, _WORDS)
        self.pieces = _Memo(lambda piece: self.ids(" " + piece), _PIECES)  # of pieces that follow a blank

    def word(self, word: str) -> bytes:
        return array("i", self.vocab.encode_word(word.encode())).tobytes()

    def ids(self, piece: str) -> bytes:
        return b"".join(map(self.known.__getitem__, self.words.findall(piece)))

    def encode(self, text: str) -> bytes:
        first, *rest = bpe.safe_pieces(text)
        return self.ids(first) + b"".join(map(self.pieces.__getitem__, rest))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> WordCodec:
    return WordCodec(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids): the token ids of every text."""

    def run(batches):
        own = codec(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [own.encode(t or "") for t in part.column(1).to_pylist()]
                ends = np.cumsum([0, *map(len, ids)]) // 4
                values = pa.array(np.frombuffer(b"".join(ids), "<i4"), pa.int32())
                yield pa.record_batch([part.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], names=["doc_id", "ids"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


class Strings:
    """Byte strings by number, in one buffer: many are joined by one gather."""

    def __init__(self, strings: dict[int, bytes]) -> None:
        n = max(strings, default=-1) + 1
        self.sizes = np.zeros(n, np.int64)
        self.sizes[list(strings)] = [len(s) for s in strings.values()]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(strings[i] for i in sorted(strings)), np.uint8)

    def joined(self, numbers: np.ndarray) -> bytes:
        out = []
        for at in range(0, len(numbers), _BLOCK):
            part = numbers[at : at + _BLOCK]
            size = self.sizes[part]
            ends = np.cumsum(size)
            out.append(self.data[np.repeat(self.starts[part] - ends + size, size) + np.arange(ends[-1])].tobytes())
        return b"".join(out)


@lru_cache(maxsize=2)
def strings(path: str) -> tuple[Strings, Strings]:
    """The bytes of each id, and its decimal with a comma."""
    vocab = bpe.load_ranks(path)
    return Strings(vocab.bytes_of), Strings({i: b"%d," % i for i in vocab.bytes_of})


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, ids, data): the bytes that ids stand for."""

    def run(batches):
        tokens, _ = strings(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = part.column(1)
                flat, ends = ids.flatten().to_numpy(), np.cumsum([0, *(ids.value_lengths().fill_null(0).to_pylist())]).tolist()
                data = [tokens.joined(flat[a:b]) for a, b in zip(ends, ends[1:])]
                yield pa.record_batch([part.column(0), part.column(1), pa.array(data, pa.binary())], names=["doc_id", "ids", "data"])

    return encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(run, "doc_id long, ids array<int>, data binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): texts are encoded, the
    ids decoded and both digested in one Arrow pass, so that neither ids nor
    bytes leave the task."""

    def run(batches):
        own, (tokens, decimals) = codec(path, pattern), strings(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows: tuple[list, list, list] = ([], [], [])
                for text in part.column(1):
                    ids = np.frombuffer(own.encode(text.as_py() or ""), "<i4")
                    rows[0].append(len(ids))
                    rows[1].append(sha256(decimals.joined(ids)[:-1]).hexdigest())
                    rows[2].append(sha256(tokens.joined(ids)).hexdigest())
                yield pa.record_batch([part.column(0), pa.array(rows[0], pa.int64()), *(pa.array(r, pa.string()) for r in rows[1:])], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)

"""Packing (operator 2): first-fit decreasing in randomised groups.

``token_pieces`` tokenises whole texts and cuts them at multiples of the
capacity; ``pack`` deals the pieces to groups by a salted hash and places each
group's pieces, longest first, into the first sequence with room.  The first
such sequence is found by a tournament tree whose inner nodes hold the most
room below them, so a group of n pieces costs n log n.  Groups are
independent tasks of about ``group_size`` small rows (lengths, not ids unless
asked for); the few open sequences of each group are the only extra padding.

The tokenizer drops white space and no word crosses it, so chunks between
blanks are encoded by themselves.  Arrow finds the distinct chunks of some
megabytes of texts; each is looked up once in a worker's memo, the new ones are
encoded together, and one gather of their ids gives the ids of all texts.

Defined cases: null and empty texts have only the closing id, one piece of
length 1; equal rows are separate documents (the salt holds the row's place in
its input split); an empty table gives no pieces.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.common import held, id_text, release, row_groups, table, utf8

_MEMO = 1 << 17  # entries at which a memo's young generation becomes the old one
_PART = 1 << 22  # bytes of text whose chunks are looked up together
_BLANKS = bytes.maketrans(b"\t\n\r", b"   ")
_UNPLAIN = re.compile("[^\0-\u024f]|\u0130")  # all others are composed already and lower-cased letter by letter
_END = b"\xff" * 4
_KIND = np.zeros(256, np.uint8)  # 1: a to z, 2: ASCII and no letter or blank
_KIND[:128] = 2
_KIND[[0x20, *range(ord("A"), ord("Z") + 1)]] = 0
_KIND[ord("a") : ord("z") + 1] = 1


class Recent(dict):
    """Ids of the strings met last.  What is found in the old generation moves
    back to the young one; the rest of it goes when the young one is full."""

    def __init__(self) -> None:
        self.old: dict[str, bytes] = {}

    def age(self) -> None:
        if len(self) > _MEMO:
            self.old = self.copy()
            self.clear()


class WordTokenizer:
    """Ids (little-endian unsigned 32-bit) of texts, words encoded once."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.words = regex.compile("\n|" + spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.added = tuple(t["content"] for t in spec["added_tokens"])
        self.last = np.zeros(1 + max(spec["model"]["vocab"].values()), bool)
        self.last[[i for t, i in spec["model"]["vocab"].items() if t.endswith(spec["model"]["end_of_word_suffix"])]] = True
        # The same model for words that are normalised and split already.
        self.split_words = Tokenizer(self.library.model)
        self.split_words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), self.library.pre_tokenizer[1]])
        self.chunks = Recent()
        if self.encode("a b, C") != self.ids("a b, C"):
            raise ValueError("this tokenizer does not drop white space")

    def ids(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _plain(self, text: str) -> bool:
        """Composed already, lower-cased letter by letter, no added string."""
        return (text.isascii() or not _UNPLAIN.search(text)) and not any(a in text for a in self.added)

    def _words_ids(self, new: list[str]) -> dict[str, bytes]:
        found: dict[str, bytes] = {}
        for first in range(0, len(new), 64):
            part = new[first : first + 64]
            ids = np.array(self.split_words.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * np.flatnonzero(self.last[ids]) + 4).tolist()
            if len(ends) != len(part):
                found.update((w, self.ids(w)) for w in part)
                continue
            joined = ids.tobytes()
            found.update((w, joined[a:b]) for w, a, b in zip(part, [0, *ends], ends))
        return found

    def _learned(self, new: list[str]) -> dict[str, bytes]:
        """Ids of distinct chunks.  A plain chunk of letters is one word; the
        other plain ones are split in one go, a line each."""
        plain, found = new, {}
        if not self._plain("\n".join(new)):
            plain = [c for c in new if self._plain(c)]
            found = {c: self.ids(c) for c in set(new).difference(plain)}
        single = [c for c in plain if c.isalpha()]
        mixed = [c for c in plain if not c.isalpha()]
        words = self.words.findall("\n".join(mixed).lower())
        known = self._words_ids(list({c.lower() for c in single}.union(words) - {"\n"}))
        found.update((c, known[c.lower()]) for c in single)
        known["\n"] = _END  # no id, and no id's bytes overlap it
        found.update(zip(mixed, b"".join(map(known.__getitem__, words)).split(_END)))
        return found

    def _values(self, keys: list[str]) -> list[bytes]:
        """Ids of distinct chunks, from the memo or learned together."""
        values = list(map(self.chunks.get, keys))
        places = [i for i, v in enumerate(values) if v is None]
        if places:
            found = list(map(self.chunks.old.get, [keys[i] for i in places]))
            new = [keys[i] for i, v in zip(places, found) if v is None]
            learned = self._learned(new) if new else {}
            for i, v in zip(places, found):
                self.chunks[keys[i]] = values[i] = learned[keys[i]] if v is None else v
            self.chunks.age()
        return values

    def _part_ids(self, data: bytes, bounds: np.ndarray, plain: bool) -> list[bytes]:
        """Ids of the ranges of ``data`` between ``bounds``, each closed by a
        blank.  Chunks lie between blanks; in plain texts a letter and a
        non-letter after it, which no word spans, are parted as well."""
        each = np.frombuffer(data, np.uint8)
        if plain:
            kind = _KIND[each]
            cut = np.flatnonzero((kind[:-1] == 1) & (kind[1:] == 2)) + 1
            each, bounds = np.insert(each, cut, 0x20), bounds + np.searchsorted(cut, bounds)
        ends = np.flatnonzero(each == 0x20) + 1
        offsets = pa.py_buffer(np.concatenate([[0], ends]))
        chunks = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, offsets, pa.py_buffer(each)]).dictionary_encode()
        keys = utf8(chunks.dictionary)[0].tobytes().decode().split(" ")[:-1]
        values = self._values(keys)
        size = np.fromiter(map(len, values), np.int64, len(values)) // 4
        flat, which = np.frombuffer(b"".join(values), "<u4"), chunks.indices.to_numpy()
        sizes = size[which]
        after = np.cumsum(sizes)
        ids = flat[np.arange(sizes.sum()) + np.repeat((np.cumsum(size) - size)[which] - (after - sizes), sizes)]
        row_ends = np.concatenate([[0], after])[np.searchsorted(ends, bounds, side="right")].tolist()
        return [ids[a:b].tobytes() for a, b in zip(row_ends, row_ends[1:])]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text.  Texts are taken together by about ``_PART`` bytes,
        a longer one in parts cut at blanks; each distinct chunk of these is
        looked up once, and the new ones are learned together."""
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: dict[bool, list[tuple[int, bytes]]] = {False: [], True: []}
        size = {False: 0, True: 0}

        def settle(plain: bool) -> None:
            owners, parts = zip(*waiting[plain])
            bounds = np.cumsum([0, *map(len, parts)])
            for at, ids in zip(owners, self._part_ids(b"".join(parts), bounds, plain)):
                out[at].append(ids)
            waiting[plain].clear()
            size[plain] = 0

        for at, text in enumerate(texts):
            low = text.lower()
            plain = self._plain(text) and not any(a in low for a in self.added)
            data = (low if plain else text).encode().translate(_BLANKS) + b" "
            first = 0
            while first < len(data):
                last = data.find(b" ", first + _PART - 1) + 1 or len(data)
                waiting[plain].append((at, data[first:last]))
                size[plain] += last - first
                first = last
                if size[plain] >= _PART:
                    settle(plain)
        for plain, parts in waiting.items():
            if parts:
                settle(plain)
        return [b"".join(parts) for parts in out]

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


@held
@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, place long"


def token_pieces(
    docs: DataFrame, path: str, capacity: int, closing_id: int, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False
) -> DataFrame:
    """One row per piece: its document, span, checksum[, and ids]."""
    schema = PIECE + ", ids array<int>" * keep_ids
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        release(keep=tokenizer)
        own, closing, place = tokenizer(path), np.array([closing_id], "<u4").tobytes(), 0
        for batch in batches:
            for first, last in row_groups(utf8(batch.column(1))[1], _PART):
                part = batch.slice(first, last - first)
                rows: list[tuple] = []
                for doc_id, ids in zip(part.column(0).to_pylist(), own.encode_all([text or "" for text in part.column(1).to_pylist()])):
                    ids += closing
                    total = len(ids) // 4
                    for start in range(0, total, capacity):
                        piece = ids[4 * start : 4 * (start + capacity)]
                        row = (doc_id, start, len(piece) // 4, zlib.crc32(piece), total, place)
                        rows.append((*row, np.frombuffer(piece, "<u4").astype(np.int32)) if keep_ids else row)
                    place += 1
                columns = list(zip(*rows)) if rows else [()] * len(names)
                types = [pa.int64()] * 6 + [pa.list_(pa.int32())] * keep_ids
                yield pa.record_batch([pa.array(list(c), t) for c, t in zip(columns, types)], names=names)

    return id_text(docs, id_col, text_col).mapInArrow(run, schema)


def first_fit(lengths: np.ndarray, capacity: int) -> tuple[list[int], list[int]]:
    """Sequence and offset of each length, in the given order: the first
    sequence with room, found by walking down a tournament tree of room."""
    leaves = 1
    while leaves < len(lengths):
        leaves *= 2
    room = [capacity] * (2 * leaves)
    bins, offsets = [], []
    for length in lengths.tolist():
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < length:
                node += 1
        bins.append(node - leaves)
        offsets.append(capacity - room[node])
        room[node] -= length
        while node > 1:
            node //= 2
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
    return bins, offsets


def pack(pieces: DataFrame, capacity: int, n_groups: int, seed: int = 17) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``; columns as from ``token_pieces``."""
    group = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "start", "ids_crc32", "place"), F.lit(n_groups)).cast("long")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)

    def run(key, rows):
        length = rows["length"].to_numpy()
        keys = [rows[c].to_numpy() for c in ("place", "ids_crc32", "start")]
        order = np.lexsort([*keys, rows["doc_id"].fill_null(-(1 << 63)).to_numpy(), -length])
        bins, offsets = first_fit(length[order], capacity)
        out = rows.drop_columns(["pack_group"]).take(pa.array(order))
        first = key[0].as_py() << 32
        return out.append_column("sequence_id", pa.array(np.array(bins, np.int64) + first)).append_column("offset", pa.array(offsets, pa.int64()))

    grouped = pieces.withColumn("pack_group", group).groupBy("pack_group")
    return grouped.applyInArrow(run, schema + ", sequence_id long, offset long")


def packed(docs: DataFrame, path: str, capacity: int = 2048, closing_id: int = 1, group_size: int = 4096) -> DataFrame:
    """Every document's pieces with their place in a sequence."""
    n_groups = max(1, -(-docs.count() // group_size))
    out = pack(token_pieces(docs, path, capacity, closing_id), capacity, n_groups)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))

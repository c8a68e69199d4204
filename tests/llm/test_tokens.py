"""Token operators against the compiled libraries."""

from __future__ import annotations

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from llm_tables import documents, empty_tables, tables  # noqa: F401 - fixtures
from stratiform.llm import bpe, common, packing, queries
from stratiform.llm.bpe_codec import codec
from stratiform.llm.token_counts import counter

QUERIES = queries.queries()
ODD = ["", "  ", "a  b   c", "\n\n\n x", "\x1c\x1ca\x85 b", "a" * 900, " " * 700, "don't we'll  's x'", "日本語 🙂🙂 é", "<|endoftext|> a<|endoftext|>", "x​y\xa0\xa0z", " a ", "abc \n def", "=-" * 400, "İ Σς ﬁ"]
ODD.append("".join(chr(random.Random(1).randrange(32, 0x2FFF)) for _ in range(800)))


@pytest.fixture(scope="module")
def ranks():
    with open(P.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        found = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=found, special_tokens={})


def test_word_ids_equal_replayed_merges():
    vocab = bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
    rng = random.Random(3)
    for _ in range(300):
        word = bytes(rng.choice(b" theraonis\xc3\xa9") for _ in range(rng.randint(1, 14)))
        want = [word] if word in vocab.ids else vocab.merge(word)
        assert [vocab.bytes_of[i] for i in vocab.encode_word(word)] == want


@pytest.mark.parametrize("text", ODD)
def test_codec_round_trip(ranks, text):
    own = codec(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    ids = np.frombuffer(own.encode(text), "<i4").tolist()
    assert ids == ranks.encode_ordinary(text)
    assert own.vocab.decode(ids) == text.encode()


def test_counts_at_every_prefix():
    library, own = Tokenizer.from_file(P.path("byte_bpe_50k.json")), counter(P.path("byte_bpe_50k.json"), P.PATTERN)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for text in ODD:
        text = text[:220]
        each = [count(text[:n]) for n in range(len(text) + 1)]
        assert [own.at(text, n) for n in range(len(text) + 1)] == each
        ends, counts = own.cuts(text)
        assert counts == [each[e] for e in ends]
        for budget in (0, 1, 5, 40):
            want = next((n - 1 for n, c in enumerate(each) if c > budget), len(text))
            assert own.longest_within(text, budget) == want
        if "<" not in text:
            for word in own.words.findall(text)[:20]:
                assert own.table(word)[-1] == count(word)


def test_op5(spark, tables, documents):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = Counter()
    for r in documents:
        n = len(library.encode(r[1] or "", add_special_tokens=False).ids)
        want[r[0], len((r[1] or "").encode()), n, n > 512] += 1
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op5_token_counts"](spark, tables).collect())
    assert got == want


def test_op9(spark, tables, documents, ranks):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = Counter()
    for r in documents:
        ids = ranks.encode_ordinary(r[1] or "")
        want[r[0], len(ids), sha(",".join(map(str, ids)).encode()), sha((r[1] or "").encode())] += 1
    assert Counter(map(tuple, QUERIES["op9_bpe_codec"](spark, tables).collect())) == want


def test_first_fit_equals_plain_search():
    rng = np.random.default_rng(2)
    for lengths in (np.sort(rng.integers(1, 101, 300))[::-1], np.full(7, 100), np.array([1]), np.array([], int)):
        room: list[int] = []
        want = []
        for n in lengths:
            k = next((i for i, r in enumerate(room) if r >= n), len(room))
            room += [100] * (k == len(room))
            want.append((k, 100 - room[k]))
            room[k] -= n
        assert list(zip(*packing.first_fit(lengths, 100))) == want


class Counted:
    """A tokenizer whose calls are counted."""

    def __init__(self, inner, calls):
        self.inner, self.calls = inner, calls

    def __getattr__(self, name):
        self.calls.append(name)
        return getattr(self.inner, name)


def test_new_words_of_many_texts_are_learned_together():
    own = packing.WordTokenizer(P.path("word_bpe_49k.json"))
    calls: list[str] = []
    for name, value in list(vars(own).items()):
        if isinstance(value, Tokenizer):
            setattr(own, name, Counted(value, calls))
    texts = [f"{chr(97 + k // 26)}{chr(97 + k % 26)}qz and more" for k in range(640)]
    got = own.encode_all(texts)
    assert 0 < len(calls) <= 12
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize(("memo", "part"), [(1 << 20, 1 << 16), (5, 3), (1, 1)])
def test_texts_encoded_together_equal_the_library(monkeypatch, memo, part):
    monkeypatch.setattr(packing, "_MEMO", memo)
    monkeypatch.setattr(packing, "_PART", part)
    own = packing.WordTokenizer(P.path("word_bpe_49k.json"))
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    odd = ["", " \n\t ", "The the THE, the.", "it's IT'S 'lly x''s ..'s", "a\x1cb \x1f c", "a\xa0b\x85c\x0bd\u2003e", "\xa0", "\x1c",
           "<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|> <| |>", "</w> a</w>b", "\u0130stanbul \u03a3\u0391\u03a3 \u03a3", "e\u0301 \u00e9 \u1e9e \u00df \u023a",
           "\u4e16\u754c \U0001f600\U0001f600 \u0e01\u0e33", "x1y22 \u00bd\u00b2 \u00aa\u00ba", "\x00 a\x00b \ufffe \u00ad", "new lines\r\nand\n\nmore"]
    texts = [*odd, " ".join(odd), *reversed(odd)]
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert own.encode_all(texts) == want and own.encode_all(texts) == want
    assert [own.encode(t) for t in texts] == want
    assert own.encode_all([]) == []


def test_a_chunk_that_many_texts_hold_is_looked_up_once():
    own = packing.WordTokenizer(P.path("word_bpe_49k.json"))
    looked: list[str] = []

    class Watched(type(own.chunks)):
        def __getitem__(self, key):
            looked.append(key)
            return super().__getitem__(key)

        def get(self, key, *default):
            looked.append(key)
            return super().get(key, *default)

    own.chunks = Watched()
    rng = random.Random(8)
    texts = [" ".join(rng.choice(["Some", "some,", "words", "(here)", "x1.", "it's"]) for _ in range(60)) for _ in range(200)]
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    assert [np.frombuffer(ids, "<u4").tolist() for ids in own.encode_all(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert 0 < len(looked) <= 40  # 12,000 chunks


def test_chunks_parted_at_signs_have_the_library_s_ids(monkeypatch):
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rng = random.Random(6)
    letters = ["abcXYZ'stD .,;!?01-_\n\t\r", "aé ÀÖ·«»×ß'\xa0\x85\x1c\x0b\0ȺɐŉİS.1", "aΣ.'é日🙂\u0301 İi,<|>", "".join(map(chr, range(0x250)))]
    marks = ["", "", "", "", "<|endoftext|>", "<|ENDOFTEXT|>", "x<|EndOfText|>y"]
    texts = ["".join(rng.choices(rng.choice(letters), k=rng.randrange(50))) + rng.choice(marks) + "a's" for _ in range(400)]
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    for part in (1, 40, 1 << 20):
        monkeypatch.setattr(packing, "_PART", part)
        assert packing.WordTokenizer(P.path("word_bpe_49k.json")).encode_all(texts) == want


def test_a_worker_keeps_a_bounded_number_of_words_and_the_frequent_ones():
    own = packing.WordTokenizer(P.path("word_bpe_49k.json"))
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    word = lambda k: "".join(chr(97 + k // 26**i % 26) for i in range(5))
    texts = [" ".join(["often", "seen", *map(word, range(k, k + 2000))]) for k in range(0, 900_000, 2000)]
    for first in range(0, len(texts), 50):
        got = own.encode_all(texts[first : first + 50])
        assert np.frombuffer(got[-1], "<u4").tolist() == library.encode(texts[first : first + 50][-1], add_special_tokens=False).ids
    memos = [v for v in vars(own).values() if isinstance(v, dict)]
    older = [v for memo in memos for v in getattr(memo, "__dict__", {}).values() if isinstance(v, dict)]
    assert 0 < sum(map(len, [*memos, *older])) <= 1_400_000  # two for each word before: 1.8 million
    calls: list[str] = []
    for name, value in list(vars(own).items()):
        if isinstance(value, Tokenizer):
            setattr(own, name, Counted(value, calls))
    own.encode("often seen seen often")
    assert not calls


def test_op2(spark, tables, documents):
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = Counter()
    for r in documents:
        ids = [*library.encode(r[1] or "", add_special_tokens=False).ids, 1]
        for a in range(0, len(ids), 2048):
            piece = np.array(ids[a : a + 2048], "<u4").tobytes()
            want[r[0], a, len(piece) // 4, zlib.crc32(piece), len(ids)] += 1
    got = QUERIES["op2_packing"](spark, tables).collect()
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for pieces in by.values():
        ends = [0, *np.cumsum([n for _, n in sorted(pieces)])]
        assert [a for a, _ in sorted(pieces)] == ends[:-1] and ends[-1] <= 2048
    assert len(by) <= sum(k[2] * n for k, n in want.items()) / 2048 + 2


@pytest.mark.parametrize("name", ["op2_packing", "op5_token_counts", "op9_bpe_codec"])
def test_empty_table(spark, empty_tables, name):
    assert QUERIES[name](spark, empty_tables).count() == 0


def test_pieces_can_carry_ids(spark):
    docs = spark.createDataFrame([(1, "hello world " * 9)], "doc_id long, text string")
    found = packing.token_pieces(docs, P.path("word_bpe_49k.json"), 8, 1, keep_ids=True).orderBy("start").collect()
    assert [i for r in found for i in r.ids][-1] == 1 and all(len(r.ids) == r.length for r in found)


def test_workers_let_go_of_what_other_operators_keep():
    path = P.path("word_bpe_49k.json")
    own = packing.tokenizer(path)
    common.release(keep=packing.tokenizer)
    assert packing.tokenizer(path) is own
    common.release()
    assert packing.tokenizer.cache_info().currsize == 0
    assert packing.tokenizer(path).encode("two words") == own.encode("two words")

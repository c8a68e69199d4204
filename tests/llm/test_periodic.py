"""Periodic runs against a scan of every period of every document."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np

from llm_tables import documents, empty_tables, save, tables  # noqa: F401 - fixtures
from stratiform.llm import periodic_runs, queries

QUERIES = queries.queries()
COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def plain_runs(words):
    """Every maximal stretch of every period, smallest periods only."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i:
                stretch = words[i : j + q]
                if len(stretch) >= max(6, 4 * q) and not any(all(a == b for a, b in zip(stretch, stretch[p:])) for p in range(1, q)):
                    found.append((i, len(stretch), q))
            i = j + 1
    return sorted(found)


def plain_plant(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    words = plain_plant(doc_id, re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    found = plain_runs(words)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    top = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    said = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(found), *top, 1000 * top[1] // top[2] if found else None, sha(said), sha(kept))


def awkward(rng):
    texts = ["a a a a a", "a a a a a a", "a b a b a b a", "a b a b a b a b", "a a " * 7, "x" * 300 + " " + "x " * 50, "\x0b\x0c a\x1cb a\x1cb a\x1cb a\x1cb a\x1cb a\x1cb"]
    for _ in range(120):
        words = []
        while len(words) < rng.randint(10, 200):
            block = [rng.choice("abc" if rng.random() < 0.5 else "abcdefghij") for _ in range(rng.randint(1, 12))]
            whole = block * rng.randint(1, 7)
            words += whole[: len(whole) - rng.randint(0, len(block) - 1)]
        texts.append(" ".join(words))
    ids = [i for i in range(40_000) if zlib.crc32(str(i).encode()) % 10 == 0][:60]
    texts += [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randint(1, 400))) for _ in ids]
    return [(i, t) for i, t in zip([*range(100_000, 100_000 + len(texts) - len(ids)), *ids], texts)]


def test_op13(spark, tables, documents, scratch_dir):
    frame = QUERIES["op13_periodic_runs"](spark, tables)
    assert frame.columns == COLUMNS
    assert Counter(map(tuple, frame.collect())) == Counter(expected(r[0], r[1]) for r in documents)
    more = awkward(random.Random(6))
    folder = save(spark, scratch_dir, [(i, t, "en", "s", 1, None, None, None, None, None, None) for i, t in more])
    got = {tuple(r) for r in QUERIES["op13_periodic_runs"](spark, folder).collect()}
    want = {expected(i, t) for i, t in more}
    assert sum(r[1] > 0 for r in want) > 100
    assert got == want


def test_op13_empty(spark, empty_tables):
    assert QUERIES["op13_periodic_runs"](spark, empty_tables).collect() == []


def test_find_runs_on_small_alphabets():
    rng = random.Random(7)
    for _ in range(1500):
        w = [rng.randrange(rng.randint(1, 3)) for _ in range(rng.randint(0, 40))] * rng.randint(1, 5)
        assert periodic_runs.find_runs(np.array(w, np.int64)) == plain_runs(w)


def test_a_gram_that_recurs_inside_the_period():
    """Every short gram of this period occurs twice in it."""
    half = [0, 1, 2, 3, 4, 5, 6]
    w = (half + [7, 8] + half + [9, 10, 11]) * 5
    assert periodic_runs.find_runs(np.array(w)) == [(0, len(w), 19)]


def test_long_document_stays_linear():
    rng = np.random.default_rng(1)
    w = np.concatenate([np.zeros(200_000, np.int64), np.tile(rng.integers(1, 9, 50_000), 4), rng.integers(10, 14, 100_000)])
    found = periodic_runs.find_runs(w)
    assert (0, 200_000, 1) in found and (200_000, 200_000, 50_000) in found


def test_runs_and_collapsed(spark):
    docs = spark.createDataFrame([(1, "so a b a b a b a b c"), (2, None), (3, "plain words only")], "doc_id long, text string")
    assert [tuple(r) for r in periodic_runs.runs(docs).collect()] == [(1, 1, 8, 2)]
    assert {r.doc_id: r.text for r in periodic_runs.collapsed(docs).collect()} == {1: "so a b c", 2: "", 3: "plain words only"}

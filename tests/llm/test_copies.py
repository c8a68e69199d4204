"""Copy-finding operators against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import tracemalloc
from collections import Counter
from functools import lru_cache
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from llm_tables import documents, empty_tables, tables  # noqa: F401 - fixtures
from stratiform.llm import common, hilbert, jaccard, metric_join, queries, suffix_dedup

QUERIES = queries.queries()
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text) -> frozenset:
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def classes(n: int, links) -> list[int]:
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= (label[a], label[b]) != (low, low)
            label[a] = label[b] = low
    return label


def jaccard_classes(texts) -> list[int]:
    sets = [shingles(t) for t in texts]
    links = [(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    return classes(len(sets), links)


def test_op4(spark, tables, documents):
    label = jaccard_classes([r[1] for r in documents])
    least: dict[int, int] = {}
    for r, c in zip(documents, label):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    want = Counter((r[0], len(shingles(r[1])), least.get(c)) for r, c in zip(documents, label))
    assert Counter(map(tuple, QUERIES["op4_jaccard_join"](spark, tables).collect())) == want
    kept = jaccard.one_of_each(spark.read.parquet(f"{tables}/documents.parquet"))
    assert kept.columns == spark.read.parquet(f"{tables}/documents.parquet").columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(least[c] for c in set(label))


@pytest.mark.parametrize("bound", [0, 3, 6, 64])
def test_every_boundary_gives_the_same_components(spark, tables, documents, bound, monkeypatch):
    want = Counter(map(tuple, QUERIES["op4_jaccard_join"](spark, tables).collect()))
    monkeypatch.setattr(jaccard, "boundary", lambda sets: bound)
    assert Counter(map(tuple, QUERIES["op4_jaccard_join"](spark, tables).collect())) == want


@pytest.mark.parametrize("bound", [None, 0, 64])
def test_links_and_their_number(spark, tables, documents, bound, monkeypatch):
    """Every link between different texts, also inside a component, and copies."""
    if bound is not None:
        monkeypatch.setattr(jaccard, "boundary", lambda sets: bound)
    sets = [shingles(r[1]) for r in documents]
    count, distinct = [0] * len(sets), set()
    for i, j in itertools.combinations(range(len(sets)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            count[i] += 1
            count[j] += 1
            if sets[i] != sets[j]:
                distinct.add(frozenset((sets[i], sets[j])))
    pairs, member = jaccard.links(spark.read.parquet(f"{tables}/documents.parquet"))
    rows, got = member.collect(), [(r.a, r.b) for r in pairs.collect()]
    assert Counter((r.doc_id, r.n_shingles, r.n_links) for r in rows) == Counter((r[0], len(s), n) for r, s, n in zip(documents, sets, count))
    reps = Counter(r.rep for r in rows)
    assert len(got) == len(set(got)) == len(distinct) > 20 and all(a < b and a in reps and b in reps for a, b in got)
    assert sorted(reps.values()) == sorted([*Counter(s for s in sets if s).values(), *[1] * sets.count(frozenset())])


def test_long_rows_are_hashed_in_parts(monkeypatch):
    import pyarrow as pa

    column = pa.array(["w" + " w".join(map(str, range(3000))), "y z", "q" * 5000 + " a b c d"])
    whole = {(f + r, h) for f, _, rows, hashes in jaccard.row_shingles(column) for r, h in zip(rows.tolist(), hashes.tolist())}
    monkeypatch.setattr(jaccard, "CHUNK_BYTES", 512)
    monkeypatch.setattr(jaccard, "row_groups", lambda o: ((i, i + 1) for i in range(len(o) - 1)))
    parts = {(f + r, h) for f, _, rows, hashes in jaccard.row_shingles(column) for r, h in zip(rows.tolist(), hashes.tolist())}
    assert parts == whole


def removed(texts) -> list[bytearray]:
    seen, out = set(), []
    for text in texts:
        data = (text or "").encode()
        mask = bytearray(len(data))
        for k in range(len(data) - 99):
            window = data[k : k + 100]
            if window in seen:
                mask[k : k + 100] = b"\1" * 100
            seen.add(window)
        out.append(mask)
    return out


def test_op8(spark, tables, documents):
    order = sorted(documents, key=lambda r: -1 if r[0] is None else r[0])
    want = Counter()
    for r, mask in zip(order, removed([r[1] for r in order])):
        data = (r[1] or "").encode()
        keep = bytes(c for c, m in zip(data, mask) if not m)
        spans = sum(1 for k, m in enumerate(mask) if m and not (k and mask[k - 1]))
        want[r[0], len(data), sum(mask), spans, hashlib.sha256(keep).hexdigest()] += 1
    assert Counter(map(tuple, QUERIES["op8_suffix_dedup"](spark, tables).collect())) == want


def test_a_line_in_many_surroundings_is_no_group(spark, monkeypatch):
    """One trigger with a phrase of its own in each document, some documents
    copied in part and some whole: its windows are spread over the parts."""
    dictionaries, ordered = [], suffix_dedup._ordered
    monkeypatch.setattr(suffix_dedup, "HOT", 50, raising=False)
    monkeypatch.setattr(suffix_dedup, "_ordered", lambda d, n: dictionaries.append(d) or ordered(d, n))
    rng = random.Random(2)
    prose = lambda n: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    line = prose(95)
    texts = [prose(70) + line + prose(70) for _ in range(600)]
    texts += [prose(20) + t[k : k + 130] + prose(20) for k, t in enumerate(texts[:60])] + texts[300:330] + [prose(3000), None, "é" * 300]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.n_removed, bytes(r.kept)) for r in suffix_dedup.deduplicated(common.fresh(frame)).collect()}
    want = {}
    for k, (text, mask) in enumerate(zip(texts, removed(texts))):
        want[k] = sum(mask), bytes(c for c, m in zip((text or "").encode(), mask) if not m)
    assert got == want and sum(n for n, _ in want.values()) > 10_000
    sizes = [r.size for r in dictionaries[0].groupBy("part").agg(F.sum(F.octet_length("blob")).alias("size")).collect()]
    assert max(sizes) < sum(sizes) / 4


def test_long_rows_lose_no_window(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(1)
    text = "".join(rng.choice(list("ab "), 3000))
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 200)
    monkeypatch.setattr(suffix_dedup, "row_groups", lambda o: ((i, i + 1) for i in range(len(o) - 1)))
    windows = set()
    for data, bounds, rows, shift in suffix_dedup._pieces(pa.array([text, "x" * 99, "y" * 101])):
        a, b, *_, piece = suffix_dedup.phrases(data, bounds)
        for i, j, p in zip(a, b, piece):
            windows |= {(int(rows[p]), int(k - bounds[p] + shift[p])) for k in range(i, j + 1)}
    assert windows == {(0, k) for k in range(len(text) - 99)} | {(2, 0), (2, 1)}


def test_equal_windows_have_equal_triggers():
    rng = np.random.default_rng(5)
    shared = rng.integers(97, 101, 140)
    data = np.concatenate([rng.integers(97, 123, 300), shared, rng.integers(97, 123, 200), shared, np.full(150, 97)]).astype(np.uint8)
    a, b, t, *_ = suffix_dedup.phrases(data, np.array([0, len(data)]))
    place = {int(k): int(x - k) for i, j, x in zip(a, b, t) for k in range(i, j + 1)}
    assert sorted(place) == list(range(len(data) - 99))
    assert all(place[300 + k] == place[640 + k] for k in range(41))


def test_op7(spark, tables):
    rows = sorted(spark.read.parquet(f"{tables}/embeddings.parquet").collect())
    sound = lambda v: bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    links = []
    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = rows[i].embedding, rows[j].embedding
        if sound(a) and sound(b) and len(a) == len(b):
            a, b = np.array(a, float), np.array(b, float)
            if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.95:
                links.append((i, j))
    count = Counter(itertools.chain(*links))
    label = classes(len(rows), links)
    want = sorted((r.vec_id, count[i], rows[label[i]].vec_id, label[i] == i) for i, r in enumerate(rows))
    assert sorted(map(tuple, QUERIES["op7_metric_join"](spark, tables).collect())) == want
    assert len(links) > 100


def test_op7_blocks(spark, tables, monkeypatch):
    from stratiform.llm import metric_join

    want = sorted(map(tuple, QUERIES["op7_metric_join"](spark, tables).collect()))
    monkeypatch.setattr(metric_join, "HOME_BLOCK", 16)
    monkeypatch.setattr(metric_join, "MEMBER_BLOCK", 24)
    monkeypatch.setattr(metric_join, "LEADING", 2)
    monkeypatch.setattr(metric_join, "PER_PIVOT", 20)
    assert sorted(map(tuple, QUERIES["op7_metric_join"](spark, tables).collect())) == want


def test_curve_visits_neighbours():
    for n, bits in ((2, 3), (3, 3), (4, 2)):
        points = np.array(list(itertools.product(range(1 << bits), repeat=n)))
        index = hilbert.curve_index([points[:, i] for i in range(n)], bits)
        assert sorted(index) == list(range(len(points)))
        assert (np.abs(np.diff(points[np.argsort(index)], axis=0)).sum(axis=1) == 1).all()


def test_op3(spark, tables, documents):
    import zlib

    got = QUERIES["op3_hilbert_shards"](spark, tables).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in documents)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    shards: dict[int, list] = {}
    for r in got:
        shards.setdefault(r.shard, []).append((r.slot, r.curve))
    counts = [len(shards[s]) for s in range(8)]
    assert max(counts) - min(counts) <= 1
    ordered = [c for s in range(8) for _, c in sorted(shards[s])]
    assert all(sorted(k for k, _ in rows) == list(range(len(rows))) for rows in shards.values())
    assert ordered == sorted(ordered)
    bounds = hilbert.shard_bounds(QUERIES["op3_hilbert_shards"](spark, tables), ["size"]).collect()
    assert sum(b.n_rows for b in bounds) == len(documents) and all(b.min_size <= b.max_size for b in bounds)


@pytest.mark.parametrize("name", ["op3_hilbert_shards", "op4_jaccard_join", "op7_metric_join", "op8_suffix_dedup"])
def test_empty_table(spark, empty_tables, name):
    assert QUERIES[name](spark, empty_tables).count() == 0


@pytest.mark.parametrize("shift", [0, 60])
def test_later_windows(shift, monkeypatch):
    """Also where many windows share a hash (``shift`` drops its bits)."""
    rng = np.random.default_rng(7)
    part = rng.integers(97, 100, 130)
    buffer = np.concatenate([part, rng.integers(97, 100, 150), part]).astype(np.uint8)
    fixed = suffix_dedup.RangeHash.fixed
    monkeypatch.setattr(suffix_dedup.RangeHash, "fixed", lambda self, width: fixed(self, width) >> np.uint64(shift))
    start = rng.permutation(len(buffer) - 99)
    seen, want = set(), []
    for k in start.tolist():
        window = buffer[k : k + 100].tobytes()
        want.append(window in seen)
        seen.add(window)
    assert suffix_dedup.later_windows(buffer, start).tolist() == want


def _thue_morse(n: int) -> tuple[str, str]:
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [1024, 4096])
def test_long_words_do_not_collide(spark, n):
    """A polynomial modulo 2**64 has the same value on both of these words."""
    a, b = _thue_morse(n)
    rows = [(1, a), (2, b), (3, a), (4, f"{a} x"), (5, f"{b} x")]
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == {1: 1, 2: 2, 3: 1, 4: 4, 5: 5}


def test_sketches_never_differ_more_than_the_sets():
    rng = np.random.default_rng(4)
    for size in (1, 5, 60, 900, 4000):
        for _ in range(20):
            every = rng.integers(0, 1 << 62, size * 2, dtype=np.int64).view(np.uint64)
            a, b = every[: size + size // 3], every[size // 3 :][:size]
            differ = len(np.setxor1d(a, b))
            bits = int(np.bitwise_count(jaccard.sketch(a).view(np.uint64) ^ jaccard.sketch(b).view(np.uint64)).sum())
            assert bits <= differ


def test_one_group_of_near_copies_and_one_hot_list(spark):
    """Large buckets: copies that link only to some others, and documents that
    share frequent lines without linking."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(5))
    base = [word() for _ in range(60)]
    rows = []
    for _ in range(150):  # a walk: each differs from the last in a word or two
        base[rng.randrange(60)] = word()
        rows.append(" ".join(base))
    lines = [" ".join(word() for _ in range(12)) for _ in range(14)]
    rows += [" ".join(rng.sample(lines, 7)) for _ in range(200)]
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(frame).collect()}
    assert got == dict(enumerate(jaccard_classes(rows)))
    assert len(set(got.values())) > 20


def test_vectors_whose_hashes_collide_stay_apart(spark, monkeypatch):
    real = F.xxhash64
    monkeypatch.setattr(metric_join.F, "xxhash64", lambda *c: real(*c) % 2 if len(c) == 2 and not isinstance(c[0], str) else real(*c))
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(40)]
    rows += [(40 + i, v) for i, v in rows[:5]]
    got = metric_join.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 0.99).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == {i: (int(i % 40 < 5), i % 40) for i, _ in rows}


def test_tasks_that_hash_shingles_take_little_memory(monkeypatch):
    """What other operators keep is gone before the first batch, and a full
    buffer of shingles is dealt out in less than 56 bytes for each of them."""
    run = []
    monkeypatch.setattr(jaccard, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    jaccard._entries(SimpleNamespace(mapInArrow=lambda f, schema: run.append(f)), 7)
    kept = lru_cache(lambda: "of another operator")
    monkeypatch.setattr(common, "_held", [kept])
    kept()
    rng, n = random.Random(3), jaccard._FLUSH // 20 + 5
    words = [chr(97 + i) + chr(97 + j) for i in range(26) for j in range(26)]
    texts = [" ".join(rng.choices(words, k=n)) for _ in range(20)]
    at_start = []

    def batches():
        at_start.append(kept.cache_info().currsize)
        for text in texts:
            yield pa.record_batch([pa.array([1]), pa.array([text])], names=["doc_id", "text"])

    tracemalloc.start()
    try:
        got = [len(b) for b in run[0](batches())]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert at_start == [0] and sum(got) == 20 + 7
    assert peak < 56 * jaccard._FLUSH

"""Winnowing against a plain version of the selection rule."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from llm_tables import documents, empty_tables, save, tables  # noqa: F401 - fixtures
from stratiform.llm import queries, winnowing
from stratiform.llm.winnowing import GRAM, WINDOW

QUERIES = queries.queries()
COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def tokens(text):
    return re.findall("[0-9A-Za-z\u00aa-\u0dff\u10a0-\u1fff\uac00-\ud7af]{1,32}|[^ \\t\\n\\x0b\\f\\r]", text)


def grams(text):
    own = tokens(text) or [text]
    return [tuple(own[i : i + GRAM]) for i in range(max(1, len(own) - GRAM + 1))]


def gram_hashes(spark, texts):
    """The hash of every gram, by Spark; the selection below is plain Python."""
    every = sorted({g for t in texts if t for g in grams(t)})
    frame = spark.createDataFrame([(list(g),) for g in every], "g array<string>")
    frame = frame.select("g", F.xxhash64(*[F.get("g", F.lit(j)) for j in range(GRAM)]).alias("h"))
    return {tuple(r.g): r.h & ~0xFFF for r in frame.collect()}


def plain_winnow(text, hashes):
    if not text:
        return []
    own = [hashes[g] for g in grams(text)]
    found = []
    for i in range(max(1, len(own) - WINDOW + 1)):
        window = own[i : i + WINDOW]
        at = max(j for j, h in enumerate(window) if h == min(window)) + i
        if not found or found[-1][1] != at:
            found.append((own[at], at))
    return found


def show(entries):
    out, last = [], 0
    for h, at in entries:
        out.append(f"{(h | (at - last)) & ((1 << 64) - 1):016X}")
        last = at
    return "".join(out)


def alike(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def ties(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "text string").select("text", F.xxhash64("text").alias("h"))
    return {r.text: r.h for r in frame.collect()}


def expected(spark, rows):
    rows = [(i, t or "") for i, t in rows]
    tie = ties(spark, {t for _, t in rows})
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, tie[r[1]], r[1].encode()))
    following = [r[1] for r in rows[1:]] + [rows[0][1]]
    edited = [t[: len(t) - len(t) // 2] + after[: len(t) // 2] for (_, t), after in zip(rows, following)]
    hashes = gram_hashes(spark, [t for _, t in rows] + edited)
    out = []
    for (i, t), after, e in zip(rows, following, edited):
        own, new, other = (plain_winnow(x, hashes) for x in (t, e, after))
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), show(own), show(new), alike(own, new), alike(own, other)))
    return Counter(out)


def test_op12(spark, tables, documents):
    frame = QUERIES["op12_winnowing"](spark, tables)
    assert frame.columns == COLUMNS
    assert Counter(map(tuple, frame.collect())) == expected(spark, [r[:2] for r in documents])


def test_op12_sizes_ties_and_one_row(spark, scratch_dir):
    rng = random.Random(2)
    texts = ["ab" * 40, "a " * 9000, "é ß " * 90, "🙂" * 70, "今天天气很好" * 9, " \n ", "\x00" * 60, "x, " * 30]
    texts += [" ".join(rng.choice("abc") for _ in range(n)) for n in (1, GRAM - 1, GRAM, GRAM + 1, GRAM + WINDOW - 2, GRAM + WINDOW - 1, GRAM + WINDOW, 10_000)]
    rows = [(i, t, None, None, None, None, None, None, None, None, None) for i, t in enumerate(texts)]
    rows += [(3, f"same id {i} " + texts[5 + i % 10], *rows[0][2:]) for i in range(40)]  # one id holds most rows
    rows += [((1 << 62) + 1, "far", *rows[0][2:]), (-(1 << 62), "near", *rows[0][2:])]
    got = QUERIES["op12_winnowing"](spark, save(spark, f"{scratch_dir}/a", rows)).collect()
    assert Counter(map(tuple, got)) == expected(spark, [r[:2] for r in rows])
    got = QUERIES["op12_winnowing"](spark, save(spark, f"{scratch_dir}/b", rows[6:7])).collect()
    assert Counter(map(tuple, got)) == expected(spark, [rows[6][:2]])


def test_op12_empty(spark, empty_tables):
    assert QUERIES["op12_winnowing"](spark, empty_tables).collect() == []


def test_shared_passages_are_always_seen(spark):
    rng = random.Random(4)
    word = lambda n: "".join(f"{rng.choice('abcdefgh') * rng.randint(1, 3)} " for _ in range(n))
    passages = [word(GRAM + WINDOW - 1) for _ in range(40)]
    rows = [(2 * i + j, word(rng.randint(0, 50)) + p + word(rng.randint(0, 50))) for i, p in enumerate(passages) for j in (0, 1)]
    found = winnowing.winnowed(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by = {}
    for r in found:
        by.setdefault(r.doc_id, set()).add(r.hash)
    assert all(by[2 * i] & by[2 * i + 1] for i in range(len(passages)))


def test_no_python_in_the_plan(spark, tables):
    plan = QUERIES["op12_winnowing"](spark, tables)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExistingRDD"))

"""Conversation structure repair against a plain cheapest-path search."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

from stratiform.llm import conversation_repair as cr
from stratiform.llm import queries

QUERIES = queries.queries()
SCHEMA = "conv_id long, turn long, role string, text string, at string, cost long, kind int, n int"
SOLID = re.compile(r"[^\x20\x09-\x0D]")
GOOD = re.compile(r"(s?(ua)+)?")


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        lot = zlib.crc32(key.encode()) % 20
        text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
        out += [(conv, turn, "user" if lot == 4 else role, text)] * (0 if lot == 0 else 2 if lot == 3 else 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()))


def fault(i, rows):
    solid = SOLID.findall(rows[i][3])
    if not solid:
        return "blank"
    if rows[i][2:] in [r[2:] for r in rows[:i]]:
        return "duplicate"
    return "truncated" if solid[-1] not in ".!?" else ""


def plain_repair(rows):
    """(cost, audit, repaired) by uniform-cost search over whole states."""
    faults = [fault(i, rows) for i in range(len(rows))]
    queue, seen = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, last, said = heapq.heappop(queue)
        if (i, last) in seen:
            continue
        seen.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit, said
        # what may come next: s only first, u first or after s or a, a after u
        ok = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
        for role in ("user", "assistant"):
            if role[0] in ok:
                heapq.heappush(queue, (cost + 2, audit + "I", i, role[0], (*said, (role, ""))))
        if i < len(rows):
            _, _, role, text = rows[i]
            heapq.heappush(queue, (cost + 3, audit + "D", i + 1, last, said))
            if faults[i] not in ("blank", "duplicate"):
                cut = faults[i] == "truncated"
                if role[:1] and role[:1] in ok:
                    heapq.heappush(queue, (cost + cut, audit + "K", i + 1, role[0], (*said, (role, text))))
                for new in ("user", "assistant"):
                    if new[0] in ok:
                        heapq.heappush(queue, (cost + 2 + cut, audit + "R", i + 1, new[0], (*said, (new, text))))
    raise AssertionError


def expected(rows, ids):
    convs = defaultdict(list)
    for r in rows:
        convs[r[0]].append(r)
    out = {}
    for conv in ids:
        own = in_order(convs[conv])
        faults = [fault(i, own) for i in range(len(own))]
        turns = {r[1] for r in own} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, said = plain_repair(own)
        assert GOOD.fullmatch("".join(r[:1] for r, _ in said))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha)
    return out


def conversations(rng, n=60):
    rows = []
    words = ["Yes.", "No!", "", " \n", "cut off", "Why?", None, "a. ", "b .\t", "日本。", "x "]
    for conv in [*range(n), None]:
        for turn in sorted(rng.sample(range(30), rng.randint(1, 12))):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", None, "", "User", "s"])
            rows.append((conv, rng.choice([turn] * 12 + [None]), role, rng.choice(words + [f"{conv} {turn}."] * 9)))
    rows += rng.sample(rows, 15)  # repeated rows
    return rows


def found(frame):
    return {r[0]: tuple(r)[1:] for r in frame.collect()}


def save(spark, folder, rows):
    spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA).repartition(3).write.parquet(f"{folder}/conversations.parquet")


def test_op11(spark, scratch_dir):
    rows = conversations(random.Random(3))
    save(spark, scratch_dir, rows)
    frame = QUERIES["op11_conversation_repair"](spark, scratch_dir)
    assert frame.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    want = expected(plain_damage(rows), {r[0] for r in rows})
    assert found(frame) == want
    convs = spark.read.parquet(f"{scratch_dir}/conversations.parquet")
    assert found(cr.repaired(cr.damaged(convs), convs, piece=2)) == want


def test_op11_empty(spark, scratch_dir):
    save(spark, scratch_dir, [])
    assert QUERIES["op11_conversation_repair"](spark, scratch_dir).collect() == []


def test_a_conversation_over_many_partitions(spark):
    """One conversation holds nearly all rows: cut by range borders and pieces."""
    rng = random.Random(8)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice([f"{t}.", f"{t}", "same.", ""])) for t in range(3000)]
    rows += [(c, t, "user", "Hi.") for c in (6, 8) for t in range(2)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert cr.edits(cr._plain(frame).select("conv_id", "turn", cr.F.col("text").cast("binary").alias("digest"), cr.F.lit(2).alias("cls"), cr.F.lit(False).alias("cut"), cr.F.lit(False).alias("blank"), cr.F.lit(1).alias("times"))).where("conv_id = 7").count() > 3
    assert found(cr.repaired(frame)) == expected(rows, {6, 7, 8})
    said = cr.messages(frame).where("conv_id = 7").orderBy("place").collect()
    assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in said).encode()).hexdigest() == expected(rows, {7})[7][-1]


def test_search_equals_plain_search():
    rng = random.Random(5)
    names = {1: "system", 2: "user", 3: "assistant", 4: "tool"}
    for _ in range(1500):
        n = rng.randint(0, 9)
        rows = [rng.choice([1, 2, 2, 2, 3, 3, 3, 4]) | rng.choice([0, 0, 8]) for _ in range(n)]
        gone = [rng.choice([0, 0, 0, 1, 2]) for _ in range(n + 1)]
        full = []
        for i in range(n + 1):
            full += [(0, 0, "user", "")] * gone[i]
            full += [(0, 0, names[rows[i] & 7], f"{i}" + ("" if rows[i] & 8 else "."))] if i < n else []
        assert cr.Search(rows, gone).best(0, None) == plain_repair(full)[:2]


def test_extreme_turns(spark):
    rows = [(1, -(1 << 63), "user", "a."), (1, (1 << 63) - 1, "assistant", "b.")]
    got = cr.repaired(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert got[0].gaps == (1 << 63) - 1 and got[0].audit == "KK"

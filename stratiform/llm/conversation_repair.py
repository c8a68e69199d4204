"""Conversation structure repair (operator 11): iterative-deepening A*.

A conversation is repaired by edits that make its role initials match
``(s?(ua)+)?``: keep (0), rerole to user or assistant (2), delete (3; required
for blank and duplicate rows), insert an empty user or assistant row (2); a
truncated row that stays adds 1.  The result is the cheapest audit, the string
of edit initials, least in ASCII among equals.

``Search`` runs depth-first in ASCII edit order (D, I, K, R) under a cost bound
that grows by one until a path is accepted, so the first accepting path is the
answer.  A table keeps, for each state (row, last role), the greatest remaining
budget with which it failed.  The heuristic is the least cost of every row that
is left plus two for each of disjoint pairs of neighbours that cannot both stay
as they are.  Rows that must go are deleted before anything is inserted (D
sorts before I), so they are counted, not searched.

On Spark: equal rows of a turn are counted by a partial aggregate, the first
turn of each content likewise; only these narrow rows (no text) are sorted by
range, so a conversation with a third of all rows lies in many partitions.
Conversations inside a partition are searched whole.  Those cut by a partition
border or longer than ``PIECE`` rows are pieces: each is searched from every
role to every role, a forward pass over the pieces' costs and ranks (some
bytes a piece) picks the borders' roles.  Prefix-freedom of the audits makes
that choice exact.  Texts travel once, sorted by conversation and streamed
through the hash; a task holds one audit, never a conversation's texts.

Defined cases: a null role or text is one space; a null conversation id is a
conversation; rows are ordered by turn, nulls first, rows of one turn by a
SHA-256 digest of role and text; equal rows are duplicates; roles are told apart by
their first letter, other initials are never kept; a conversation without rows
has zeros, an empty audit and the hash of nothing; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.common import fresh, table

PIECE = 256  # rows searched at once
_MEMO = 1 << 15  # audits of short conversations that a task remembers
_FREE, _SYSTEM, _USER, _ASSISTANT = range(4)  # the last role so far; _FREE: none
_OTHER = 4  # class of a row whose initial is none of s, u, a
_TRUNCATED = 8  # flag beside the class
_CLASS = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}
_TURN = (_USER, _USER, _ASSISTANT, _USER)  # the role that an insert or rerole takes after each
_BLANKS = " \t\n\x0b\x0c\r"
_ENDS = [(p, q) for p in range(4) for q in range(4)] + [(p, None) for p in range(4)]


def follows(last: int, cls: int) -> bool:
    """May a row of this class stand after the last role as it is?"""
    if cls == _SYSTEM:
        return last == _FREE
    return cls == _TURN[last]


class Search:
    """Cheapest and ASCII-least edits of one stretch of rows.

    ``rows`` are class codes of the rows that may stay; ``gone[i]`` rows before
    row i (after the last: ``gone[-1]``) must be deleted.
    """

    def __init__(self, rows: list[int], gone: list[int]) -> None:
        self.rows, self.gone = rows, gone
        self.forced = 3 * sum(gone)

    def _estimates(self, goal: int | None) -> tuple[list[int], list[int]]:
        """Least cost of the rows from i on, and twice the number of disjoint
        pairs among them that cannot both stay; the goal pairs with the last."""
        n = len(self.rows)
        base, pairs = [0] * (n + 1), [0] * (n + 2)
        ends = (_ASSISTANT,) if goal is None else (goal,)
        for i in range(n - 1, -1, -1):
            cls, cut = self.rows[i] & 7, self.rows[i] >= _TRUNCATED
            base[i] = base[i + 1] + (2 if cls == _OTHER else 0) + cut
            if cls == _OTHER:
                bad = False
            elif i == n - 1:
                bad = cls not in ends
            else:
                after = self.rows[i + 1] & 7
                bad = after != _OTHER and not follows(cls, after)
            pairs[i] = max(pairs[i + 1], 2 + pairs[i + 2] if bad else 0)
        return base, pairs

    def best(self, start: int, goal: int | None) -> tuple[int, str] | None:
        """(cost, audit) from the last role ``start`` to ``goal``, or to an
        accepting end with inserts after the last row (None)."""
        n = len(self.rows)
        if goal is not None and goal != start:
            if goal == _FREE or not n:
                return None
            if goal == _SYSTEM and (start != _FREE or _SYSTEM not in {r & 7 for r in self.rows}):
                return None
        base, pairs = self._estimates(goal)
        failed: dict[tuple[int, int], int] = {}
        least = lambda i, q: base[i] + (pairs[i] if i == n or self.rows[i] & 7 == _OTHER or follows(q, self.rows[i] & 7) else max(pairs[i], 2 + pairs[i + 1]))
        for bound in range(least(0, start), 3 * n + 8):
            path = self._deepen(start, goal, bound, least, failed)
            if path is not None:
                return bound + self.forced, self._audit(path)
        return None

    def _deepen(self, start: int, goal: int | None, bound: int, least, failed: dict) -> list[str] | None:
        rows, n = self.rows, len(self.rows)
        path: list[str] = []
        stack = [(0, start, bound, self._moves(0, start, goal))]
        while stack:
            i, q, left, moves = stack[-1]
            if i == n and (q == goal if goal is not None else q in (_FREE, _ASSISTANT)):
                return path
            for edit, cost, j, r in moves:
                rest = left - cost
                if rest >= least(j, r) and failed.get((j, r), -1) < rest:
                    path.append(edit)
                    stack.append((j, r, rest, self._moves(j, r, goal)))
                    break
            else:
                failed[i, q] = max(failed.get((i, q), -1), left)
                stack.pop()
                if path:
                    path.pop()
        return None

    def _moves(self, i: int, q: int, goal: int | None) -> Iterator[tuple[str, int, int, int]]:
        """(edit, cost, next row, last role after it) in ASCII order."""
        turn = _TURN[q]
        if i == len(self.rows):
            if goal is None:
                yield "I", 2, i, turn
            return
        cls, cut = self.rows[i] & 7, int(self.rows[i] >= _TRUNCATED)
        yield "D", 3, i + 1, q
        yield "I", 2, i, turn
        if cls != _OTHER and follows(q, cls):
            yield "K", cut, i + 1, cls
        yield "R", 2 + cut, i + 1, turn

    def _audit(self, path: list[str]) -> str:
        out, row = ["D" * self.gone[0]], 0
        for edit in path:
            out.append(edit)
            if edit != "I":
                row += 1
                out.append("D" * self.gone[row])
        return "".join(out)


_FOUND = "conv_id long, at long, whole boolean, cost long, audit string, costs array<long>, audits array<string>, blank long, duplicate long, truncated long, illegal long, first int, last int, turns long, low long, high long"


class _Stretch:
    """Rows of one conversation so far: what the search needs, and counts."""

    def __init__(self, conv, begins: bool) -> None:
        self.conv, self.begins = conv, begins
        self.rows: list[int] = []
        self.gone = [0]
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None

    def add(self, turn, cls: int, cut: bool, blank: bool, new: bool, n: int) -> None:
        if self.first is None:
            self.first = cls
        else:
            self.illegal += not legal(self.last, cls)
        self.illegal += n - 1
        self.last = cls
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        if blank:
            self.blank += n
        else:
            self.duplicate += n - new
            self.truncated += new and cut
        if blank or not new:
            self.gone[-1] += n
        else:
            self.rows.append(cls | (_TRUNCATED if cut else 0))
            self.gone.append(n - 1)

    def facts(self) -> tuple:
        return self.blank, self.duplicate, self.truncated, self.illegal, self.first, self.last, self.turns, self.low, self.high


def legal(a: int, b: int) -> bool:
    return (a, b) in ((_SYSTEM, _USER), (_USER, _ASSISTANT), (_ASSISTANT, _USER))


def _record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _arrow(spec: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    return pa.schema([(n, kinds[t]) for n, t in (f.split(" ") for f in spec.split(", "))])


def _searched(batches: Iterable[pa.RecordBatch], piece: int) -> Iterator[pa.RecordBatch]:
    """Sorted narrow rows to searched conversations and pieces of them."""
    base, seq = TaskContext.get().partitionId() << 32, 0
    memo: dict[tuple, tuple[int, str] | None] = {}
    schema, out = _arrow(_FOUND), []
    now: _Stretch | None = None

    def close(ends: bool) -> None:
        nonlocal seq
        search = Search(now.rows, now.gone)
        cost = audit = costs = audits = None
        if now.begins and ends:
            key = (*now.rows, -1, *now.gone)
            found = memo.get(key)
            if found is None:
                found = search.best(_FREE, None)
                if len(key) < 64:
                    if len(memo) >= _MEMO:
                        memo.clear()
                    memo[key] = found
            cost, audit = found
        else:
            each = [search.best(p, q) for p, q in _ENDS]
            costs, audits = [x and x[0] for x in each], [x and x[1] for x in each]
        out.append((now.conv, base | seq, audit is not None, cost, audit, costs, audits, *now.facts()))
        seq += 1

    for batch in batches:
        for conv, turn, cls, cut, blank, new, n in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None:
                now = _Stretch(conv, False)  # may go on from the partition before
            elif conv != now.conv:
                close(True)
                now = _Stretch(conv, True)
            elif len(now.rows) >= piece:
                close(False)
                now = _Stretch(conv, False)
            now.add(turn, cls, cut, blank, new, n)
        if len(out) >= 4096:
            yield _record(out, schema)
            out.clear()
    if now is not None:
        close(False)  # may go on in the partition after
    if out:
        yield _record(out, schema)


def _chosen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which ends of each piece the whole conversation's best audit takes.

    Pieces come sorted by conversation and place.  ``order`` ranks the best
    audits up to here by ASCII; two of them differ inside some earlier piece, so
    a later piece cannot change their order."""
    spec = _arrow("at long, pick int")
    conv, places, parents = None, [], bytearray()
    cost: dict[int, int] = {}
    order: dict[int, int] = {}
    pending = None

    def step(costs, ranks, last: bool) -> dict[int, tuple]:
        best: dict[int, tuple] = {}
        for p, c in cost.items():
            for k, (a, q) in enumerate(_ENDS):
                if a == p and (q is None) == last and costs[k] is not None:
                    key = (c + costs[k], order[p], ranks[k], p, k)
                    q = 0 if last else q
                    if q not in best or key < best[q]:
                        best[q] = key
        return best

    def finish() -> pa.RecordBatch:
        _, costs, ranks, at = pending
        _, _, _, state, pick = step(costs, ranks, True)[0]
        rows = [(at, pick)]
        for t in range(len(places) - 1, -1, -1):
            before = parents[4 * t + state]
            rows.append((places[t], _ENDS.index((before, state))))
            state = before
        return _record(rows, spec)

    for batch in batches:
        for c, at, costs, ranks in zip(*(x.to_pylist() for x in batch.columns)):
            if pending is not None and c == conv:
                best = step(pending[1], pending[2], False)
                places.append(pending[3])
                parents.extend(best[q][3] if q in best else 0 for q in range(4))
                ranked = sorted(best, key=lambda q: best[q][1:3])
                cost = {q: best[q][0] for q in best}
                order = {q: i for i, q in enumerate(ranked)}
            else:
                if pending is not None:
                    yield finish()
                conv, places, parents = c, [], bytearray()
                cost, order = {_FREE: 0}, {_FREE: 0}
            pending = (c, costs, ranks, at)
    if pending is not None:
        yield finish()


def edits(rows: DataFrame, piece: int = PIECE) -> DataFrame:
    """Audits and counts from (conv_id, turn, digest, cls, cut, blank, times):
    a row for each conversation, or for each piece of it in the order of ``at``."""
    key = ["conv_id", "turn", "digest"]
    counted = rows.groupBy(*key, "cls", "cut", "blank").agg(F.sum("times").alias("n"))
    place = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    first = rows.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(F.min(place).alias("first"))
    joined = counted.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")))
    narrow = joined.withColumn("new", place == F.col("first"))
    sort = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("digest")]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    narrow = narrow.repartitionByRange(n, *sort).sortWithinPartitions(*sort)
    found = fresh(narrow.select("conv_id", "turn", "cls", "cut", "blank", "new", "n").mapInArrow(lambda b: _searched(b, piece), _FOUND))
    pieces = found.where("NOT whole")
    # Audits of one start differ; their rank is all the choice needs.
    ranks = F.transform("audits", lambda a: F.size(F.filter("audits", lambda b: b < a)))
    by = [F.col("conv_id").asc_nulls_first(), F.col("at")]
    lined = pieces.select("conv_id", "at", "costs", ranks.alias("ranks")).repartition(n, "conv_id").sortWithinPartitions(*by)
    picks = lined.mapInArrow(_chosen, "at long, pick int")
    picked = pieces.join(picks, "at").withColumn("cost", F.get("costs", F.col("pick"))).withColumn("audit", F.get("audits", F.col("pick")))
    out = [c for c in found.columns if c not in ("costs", "audits", "whole")]
    return found.where("whole").select(*out).union(picked.select(*out))


_DIGEST = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_MESSAGES = "conv_id long, place long, edit string, role string, text string"


class _Repair:
    """One conversation in a stream: its audit first, then its rows."""

    def __init__(self, conv) -> None:
        self.conv = conv
        self.audits: list[str] = []
        self.audit: str | None = None
        self.counts = [0, 0, 0, 0, 0]
        self.turns, self.low, self.high, self.last = 0, None, None, None
        self.at, self.state, self.place = 0, _FREE, 0
        self.sha = hashlib.sha256()

    def note(self, r: dict) -> None:
        self.audits.append(r["audit"])
        self.counts = [a + r[k] for a, k in zip(self.counts, ("blank", "duplicate", "truncated", "illegal", "cost"))]
        if self.last is not None:
            self.counts[3] += not legal(self.last, r["first"])
        self.last = r["last"]
        if r["low"] is not None:
            self.turns += r["turns"] - (self.high is not None and self.high == r["low"])
            self.low, self.high = r["low"] if self.low is None else self.low, r["high"]

    def _say(self, edit: str, role: str, text: str) -> tuple:
        self.sha.update(f"{chr(10) if self.place else ''}{role}:{text}".encode())
        self.place += 1
        return self.conv, self.place - 1, edit, role, text

    def inserts(self) -> Iterator[tuple]:
        if self.audit is None:
            self.audit = "".join(self.audits)
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            self.state = _TURN[self.state]
            yield self._say("I", "user" if self.state == _USER else "assistant", "")

    def row(self, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = _CLASS[role[0]]
        elif edit == "R":
            self.state = _TURN[self.state]
            role = "user" if self.state == _USER else "assistant"
        if edit != "D":
            yield self._say(edit, role, text)

    def digest(self) -> tuple:
        gaps = 0 if self.low is None else min(self.high - self.low + 1 - self.turns, (1 << 63) - 1)
        return self.conv, gaps, *self.counts, self.audit, self.sha.hexdigest()


def _repaired(spec: str, messages: bool):
    schema = _arrow(spec)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out, held = None, [], 0
        for batch in batches:
            for r in batch.to_pylist():
                if now is None or r["conv_id"] != now.conv:
                    if now is not None:
                        end = list(now.inserts())
                        out += end if messages else [now.digest()]
                    now = _Repair(r["conv_id"])
                if r["kind"] == 1:
                    now.note(r)
                elif r["kind"] == 2:
                    for _ in range(r["times"]):
                        said = list(now.row(r["role"], r["text"]))
                        if messages:
                            out += said
                            held += len(r["text"])
                if len(out) >= 4096 or held > 1 << 22:
                    yield _record(out, schema)
                    out, held = [], 0
        if now is not None:
            end = list(now.inserts())
            out += end if messages else [now.digest()]
        if out:
            yield _record(out, schema)

    return run


def _stream(rows: DataFrame, ids: DataFrame, piece: int = PIECE) -> DataFrame:
    """Per conversation: its id, its audit (pieces in order), its rows."""
    role, text = F.col("role"), F.col("text")
    core = F.rtrim(text, F.lit(_BLANKS))
    cls = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in _CLASS.items() for x in kv]), F.substring(role, 1, 1)), F.lit(_OTHER))
    digest = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))
    cut = ~(core.endswith(".") | core.endswith("!") | core.endswith("?"))
    known = rows.select("conv_id", "turn", role, text, "times", digest.alias("digest"), cls.alias("cls"), cut.alias("cut"), (core == "").alias("blank"))
    audits = edits(known.select("conv_id", "turn", "digest", "cls", "cut", "blank", "times"), piece)
    none = lambda frame, kind: frame.withColumn("kind", F.lit(kind))
    both = none(ids, 0).unionByName(none(audits, 1), allowMissingColumns=True)
    both = both.unionByName(none(known.select("conv_id", "turn", "role", "text", "times", "digest"), 2), allowMissingColumns=True)
    sort = [F.col("conv_id").asc_nulls_first(), F.col("kind"), F.col("at"), F.col("turn").asc_nulls_first(), F.col("digest")]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return both.repartition(n, "conv_id").sortWithinPartitions(*sort).drop("turn", "digest")


def _plain(convs: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    return convs.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), text("role"), text("text"))


def repaired(rows: DataFrame, ids: DataFrame | None = None, piece: int = PIECE) -> DataFrame:
    """Faults, cost, audit and hash per conversation of (conv_id, turn, role,
    text) and optionally ``times``; ``ids`` may name conversations without rows."""
    rows = rows if "times" in rows.columns else _plain(rows).withColumn("times", F.lit(1))
    ids = (rows if ids is None else ids).select("conv_id").distinct()
    return _stream(rows, ids, piece).mapInArrow(_repaired(_DIGEST, False), _DIGEST)


def messages(rows: DataFrame) -> DataFrame:
    """The repaired conversations: (conv_id, place, edit, role, text)."""
    rows = rows if "times" in rows.columns else _plain(rows).withColumn("times", F.lit(1))
    return _stream(rows, rows.select("conv_id").distinct()).mapInArrow(_repaired(_MESSAGES, True), _MESSAGES)


def damaged(convs: DataFrame) -> DataFrame:
    """The query's damage: by checksum of id and turn, one row in twenty each is
    dropped, emptied, stripped of its stops, repeated, or given to the user."""
    spaced = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    rows = _plain(convs)
    lot: Column = F.crc32(F.concat(spaced(F.col("conv_id")), F.lit(":"), spaced(F.col("turn"))).cast("binary")) % 20
    rows = rows.withColumn("lot", lot).where("lot <> 0")
    text = F.when(F.col("lot") == 1, "").when(F.col("lot") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("lot") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.when(F.col("lot") == 3, 2).otherwise(1).alias("times"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    convs = table(spark, sf_dir, "conversations")
    return repaired(damaged(convs), _plain(convs))

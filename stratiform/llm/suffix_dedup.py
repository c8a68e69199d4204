"""Suffix dedup (operator 8): prefix-free parsing and hash ranks, no suffix array.

A byte goes if it lies in a ``LENGTH``-byte string that also starts earlier in
the corpus (smaller document, or earlier in the same one).

*Triggers.*  Each window of LENGTH bytes has a trigger: the ``TRIGGER``-byte
string in it of least rolling hash (the leftmost of equals).  It depends on
the window's bytes alone, so equal windows have equal triggers at equal
places.  Consecutive windows with one trigger form a *phrase*: the bytes from
the first such window's start to the last one's end.  Phrases overlap by more
than a trigger, so none is a prefix of another's continuation; every window
lies in exactly one phrase.

*Parse and dictionary.*  The parse is the list of phrase occurrences, sent as
packed hashes by trigger.  A phrase that occurred earlier is removed whole.
A trigger whose phrases are all equal is settled by that.  Only triggers with
several different phrases (the edges of repeats, edits inside near copies) go
on, once per distinct phrase: their bytes are the *dictionary*.

*Equal windows.*  Hash ranking replaces the suffix arrays of dictionary and
parse, which are not built: within a trigger's group the dictionary's windows
of LENGTH bytes are sorted by 64-bit rolling hashes, neighbours of one hash
are compared byte by byte, and the place in the corpus tells which of equal
windows is first.  The windows found are those a lexicographic order would
give; the order of different windows is not known.

Highly repetitive text costs one parse entry a phrase and no window.  Copies
within one input split are settled before the shuffle, so the entries of a
trigger grow with splits and distinct phrases, not with copies.

*Hot triggers.*  A first pass over the texts counts the distinct phrases of a
trigger.  From ``HOT`` on (a line that many documents have in surroundings of
their own) no group holds the trigger: its phrases meet by phrase hash, and
the windows of those left are dealt by a 128-bit digest, which alone tells
them apart.  Both spread evenly over the parts.

Row ids
come from the place in the input, so ``docs`` must be a stable scan: a stored
table or a checkpoint.

Defined cases: null and empty texts lose nothing; windows never cross rows;
rows that repeat an id are ordered by their place in the input, as are null
ids, which come before all others; texts under LENGTH bytes stay whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.common import CHUNK_BYTES, RangeHash, fresh, mix, pack, release, row_groups, table, unpack, utf8

LENGTH = 100
TRIGGER = 50
PART_BYTES = 4 << 20  # text bytes whose phrases share a part
HOT = 10_000  # distinct phrases from which a trigger has no group of its own
FEW = 4  # distinct phrases of a trigger from which a task reports it
_FLUSH = 200_000  # phrases a task holds before it sorts and sends them
_PLACE = np.uint64((1 << 24) - 1)
_CTX = np.uint64((1 << 48) - 1)
_LOW = np.uint64((1 << 32) - 1)
_SIGN = np.uint64(1 << 63)
_ROW_BLOCK = np.uint64(9)


def _home(rows: np.ndarray, n: int) -> np.ndarray:
    return (mix(rows >> _ROW_BLOCK) % np.uint64(n)).astype(np.int64)


def _pieces(column: pa.Array):
    """Bytes, piece bounds, and each piece's row and place in it; a long row
    in pieces that share LENGTH - 1 bytes, so that no window is lost."""
    data, offsets = utf8(column)
    for first, last in row_groups(offsets):
        part = data[offsets[first] : offsets[last]]
        if len(part) <= 2 * CHUNK_BYTES:
            yield part, offsets[first : last + 1] - offsets[first], np.arange(first, last), np.zeros(last - first, np.int64)
            continue
        for at in range(0, len(part) - LENGTH + 1, CHUNK_BYTES):
            own = part[at : at + CHUNK_BYTES + LENGTH - 1]
            yield own, np.array([0, len(own)]), np.array([first]), np.array([at])


def phrases(data: np.ndarray, bounds: np.ndarray):
    """First and last window, trigger place, trigger hash, phrase hash, and
    piece of every phrase."""
    n = len(data) - LENGTH + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none
    hashes = RangeHash(data)
    each = hashes.fixed(TRIGGER)
    least = (each & ~_PLACE) | np.arange(len(each), dtype=np.uint64)
    span, width = 1, LENGTH - TRIGGER + 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    place = (np.minimum(least[:n], least[width - span : width - span + n]) & _PLACE).astype(np.int64)
    step = np.zeros(len(data) + 1, np.int64)
    size = np.diff(bounds)
    np.add.at(step, bounds[:-1][size >= LENGTH], 1)
    np.add.at(step, bounds[1:][size >= LENGTH] - LENGTH + 1, -1)
    valid = np.cumsum(step)[:n] > 0
    same = valid[1:] & valid[:-1] & (place[1:] == place[:-1])
    first, last = valid.copy(), valid.copy()
    first[1:] &= ~same
    last[:-1] &= ~same
    a, b = np.flatnonzero(first), np.flatnonzero(last)
    t = place[a]
    whole = mix(hashes.of(a, b + LENGTH) + (t - a).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    # Least hashes crowd at the low end, where one range of them would hold a
    # large share of all triggers; mixed once more they spread evenly over the parts.
    return a, b, t, mix(each[t]), whole, np.searchsorted(bounds, a, side="right") - 1


def _as_rows(columns: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.Table:
    return pa.table([pa.array([c[i] for c in columns], t) for i, t in enumerate(types)], names=names)


def _by(key: np.ndarray, n: int, columns: list[np.ndarray]):
    """(value, columns) for each value of ``key`` present."""
    order = np.argsort(key, kind="stable")
    columns = [c[order] for c in columns]
    edge = np.searchsorted(key[order], np.arange(n + 1))
    for k in np.flatnonzero(np.diff(edge)):
        yield int(k), [c[edge[k] : edge[k + 1]] for c in columns]


def _settle(group: np.ndarray, whole: np.ndarray, earlier: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sort order by (group, phrase, place) and which entries come first of
    their phrase; ``earlier``: the order of places, most significant first."""
    order = np.lexsort((*reversed(earlier), whole, group))
    g, w = group[order], whole[order]
    first = np.ones(len(g), bool)
    first[1:] = (g[1:] != g[:-1]) | (w[1:] != w[:-1])
    return order, first


def hot_triggers(rows: DataFrame) -> np.ndarray:
    """Triggers of about ``HOT`` distinct phrases or more: sums of what tasks
    report, which leave out fewer than ``FEW`` for each ``_FLUSH`` phrases."""

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush():
            trigger, whole = (np.concatenate(c) for c in zip(*held))
            held.clear()
            order, first = _settle(trigger, whole, [])
            found, count = np.unique(trigger[order][first], return_counts=True)
            return pa.record_batch([pa.array(found[count >= FEW].view(np.int64)), pa.array(count[count >= FEW].astype(np.int64))], names=["trigger", "n"])

        for batch in batches:
            for data, bounds, _, _ in _pieces(batch.column(2)):
                held.append(phrases(data, bounds)[3:5])
                if sum(len(h[0]) for h in held) >= _FLUSH:
                    yield flush()
        if held:
            yield flush()
        release()

    counts = rows.mapInArrow(run, "trigger long, n long").groupBy("trigger").agg(F.sum("n").alias("n"))
    return np.array([r["trigger"] for r in counts.where(F.col("n") >= HOT).select("trigger").collect()], np.int64).view(np.uint64)


def _parse(rows: DataFrame, n: int, hot: np.ndarray) -> DataFrame:
    """(part, blob): occurrences by trigger; from ``n`` on, settled ones; from
    ``2 * n`` on, those of hot triggers by phrase."""

    def run(batches):
        held: list[list[np.ndarray]] = []

        def flush():
            trigger, whole, number, row, t, before, after = (np.concatenate(c) for c in zip(*held))
            held.clear()
            order, first = _settle(trigger, whole, [number, row, t])
            columns = [c[order] for c in (trigger, whole, number, row, t, before, after)]
            out = []
            done = [c[~first] for c in columns]
            for home, (r, a, b) in _by(_home(done[3], n), n, [done[3], done[4] - done[5], done[4] + done[6]]):
                out.append((n + home, pack(r, a, b)))
            trigger, whole, number, row, t, before, after = (c[first] for c in columns)
            part = (((trigger >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)
            if len(hot):
                spread = (((whole >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)
                part = np.where(np.isin(trigger, hot), 2 * n + spread, part)
            for p, (tr, w, num, r, t_, be, af) in _by(part, 3 * n, [trigger & _LOW, whole & _CTX, number, row, t, before, after]):
                sort = np.argsort(tr, kind="stable")
                tr, w, num, r, t_, be, af = (c[sort] for c in (tr, w, num, r, t_, be, af))
                gap = r - num  # the same for all rows where ids run like rows
                out.append((p, pack(np.diff(tr, prepend=np.uint64(0)), w, num - num.min(), gap - gap.min(), t_, be, af, np.array([num.min(), gap.min()]))))
            for at in range(0, len(out), 16):
                yield from _as_rows(out[at : at + 16], [pa.int32(), pa.binary()], ["part", "blob"]).to_batches()

        for batch in batches:
            row_id, ids = batch.column(0).to_numpy().view(np.uint64), batch.column(1)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            number = np.where(known, ids.fill_null(0).to_numpy().view(np.uint64) ^ _SIGN, np.uint64(0))
            for data, bounds, rows_, shift in _pieces(batch.column(2)):
                a, b, t, trigger, whole, piece = phrases(data, bounds)
                row, place = rows_[piece], t - bounds[piece] + shift[piece]
                held.append([trigger, whole, number[row], row_id[row], place.astype(np.uint64), (t - a).astype(np.uint64), (b - t + TRIGGER).astype(np.uint64)])
                if sum(len(h[0]) for h in held) >= _FLUSH:
                    yield from flush()
        if held:
            yield from flush()
        release()

    return rows.mapInArrow(run, "part int, blob binary")


# ``after`` is the last window's distance from the trigger plus TRIGGER, which
# keeps it above zero: a window starts at most LENGTH - TRIGGER before it.


def _settled(parse: DataFrame, n: int) -> DataFrame:
    """(home, kind, blob): kind 0, removed windows; kind 1, phrases whose
    trigger has several, with its part, or ``n`` if it is hot."""

    def run(key, group):
        release()
        part = key[0].as_py()
        if n <= part < 2 * n:
            return _as_rows([(part - n, 0, b) for b in group["blob"].to_pylist()], [pa.int32(), pa.int32(), pa.binary()], ["home", "kind", "blob"])
        columns: list[list[np.ndarray]] = []
        for blob in group["blob"].to_pylist():
            gaps, whole, number, gap, t, before, after, least = unpack(blob)
            number = number + least[0]
            columns.append([np.cumsum(gaps), whole, number, number + gap + least[1], t, before, after])
        trigger, whole, number, row, t, before, after = (np.concatenate(c) for c in zip(*columns))
        order, first = _settle(trigger, whole, [number, row, t])
        trigger, row, t, before, after = (c[order] for c in (trigger, row, t, before, after))
        out = [(h, 0, pack(r, a, b)) for h, (r, a, b) in _by(_home(row[~first], n), n, [row[~first], (t - before)[~first], (t + after)[~first]])]
        trigger, row, t, before, after = (c[first] for c in (trigger, row, t, before, after))
        many = np.full(len(trigger), part >= 2 * n)
        same = trigger[1:] == trigger[:-1]
        many[1:] |= same
        many[:-1] |= same
        out += [(h, 1, pack(r, t_, be, af, np.array([min(part, n)]))) for h, (r, t_, be, af) in _by(_home(row[many], n), n, [c[many] for c in (row, t, before, after)])]
        return _as_rows(out, [pa.int32(), pa.int32(), pa.binary()], ["home", "kind", "blob"])

    return parse.groupBy("part").applyInArrow(run, "home int, kind int, blob binary")


def _texts(rows: DataFrame, n: int) -> DataFrame:
    """(home, kind 2, blob): texts by blocks of rows, compressed together."""

    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            row_id = batch.column(0).to_numpy().view(np.uint64)
            ids = batch.column(1)
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            number = np.where(known, ids.fill_null(0).to_numpy().view(np.uint64) ^ _SIGN, np.uint64(0))
            data, offsets = utf8(batch.column(2))
            cut = np.flatnonzero(np.diff(row_id >> _ROW_BLOCK)) + 1
            for a, b in zip([0, *cut], [*cut, len(row_id)]):
                if a < b:
                    head = pack(row_id[a:b], number[a:b], np.diff(offsets[a : b + 1]).astype(np.uint64))
                    body = squeeze.compress(data[offsets[a] : offsets[b]].tobytes())
                    blob = len(head).to_bytes(8, "little") + head + body
                    yield pa.record_batch([pa.array(_home(row_id[a : a + 1], n), pa.int32()), pa.array([2], pa.int32()), pa.array([blob], pa.binary())], names=["home", "kind", "blob"])

    return rows.mapInArrow(run, "home int, kind int, blob binary")


def digests(text: bytes) -> list[bytes]:
    """128 bits for each window."""
    return [hashlib.blake2b(text[k : k + LENGTH], digest_size=16).digest() for k in range(len(text) - LENGTH + 1)]


def _dictionary(blocks: DataFrame, n: int) -> DataFrame:
    """(part, blob): the bytes of phrases that share their trigger; from ``n``
    on, digests and places of the windows of hot triggers, by digest."""

    def run(_key, group):
        release()
        kinds, blobs = group["kind"].to_pylist(), group["blob"]
        asked = [unpack(blobs[i].as_py()) for i, k in enumerate(kinds) if k == 1]
        out: list[tuple[int, bytes]] = []
        if asked:
            row, t, before, after = (np.concatenate([a[i] for a in asked]) for i in range(4))
            part = np.concatenate([np.repeat(a[4], len(a[0])) for a in asked])
            order = np.argsort(row, kind="stable")
            row, t, before, after, part = (c[order] for c in (row, t, before, after, part))
            number, pieces = np.zeros(len(row), np.uint64), [b""] * len(row)
            for i, k in enumerate(kinds):
                if k != 2:
                    continue
                blob = blobs[i].as_py()
                size = int.from_bytes(blob[:8], "little")
                rows, numbers, lengths = unpack(blob[8 : 8 + size])
                lo, hi = np.searchsorted(row, [rows[0], rows[-1] + np.uint64(1)])
                if lo == hi:
                    continue
                ends = np.cumsum(np.concatenate([[0], lengths.astype(np.int64)]))
                body = zstandard.ZstdDecompressor().decompress(blob[8 + size :], max_output_size=max(1, int(ends[-1])))
                at = np.searchsorted(rows, row[lo:hi])
                number[lo:hi] = numbers[at]
                start = ends[at] + (t[lo:hi] - before[lo:hi]).astype(np.int64)
                end = ends[at] + (t[lo:hi] + after[lo:hi]).astype(np.int64) - TRIGGER + LENGTH
                pieces[lo:hi] = [body[a:b] for a, b in zip(start.tolist(), end.tolist())]
            texts = np.empty(len(pieces), object)
            texts[:] = pieces
            for p, (r, num, first, text) in _by(part.astype(np.int64), n + 1, [row, number, t - before, texts]):
                if p == n:
                    each = np.frombuffer(b"".join([d for x in text for d in digests(x)]), np.uint64).reshape(-1, 2)
                    count = np.array([len(x) - LENGTH + 1 for x in text])
                    within = (np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)).astype(np.uint64)
                    columns = [each[:, 0], each[:, 1], np.repeat(num, count), np.repeat(r, count), np.repeat(first, count) + within]
                    out += [(n + k, pack(*c)) for k, c in _by((each[:, 0] % np.uint64(n)).astype(np.int64), n, columns)]
                    continue
                head = pack(r, num, first, np.array([len(x) for x in text]))
                out.append((p, len(head).to_bytes(8, "little") + head + zstandard.ZstdCompressor(level=1).compress(b"".join(text))))
        return _as_rows(out, [pa.int32(), pa.binary()], ["part", "blob"])

    return blocks.groupBy("home").applyInArrow(run, "part int, blob binary")


def later_windows(buffer: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Which of the windows at ``start`` (in corpus order) equal an earlier
    one.  They are ranked by their rolling hashes, eight bytes each instead of
    LENGTH; neighbours of one rank are compared
    byte by byte."""
    n = len(buffer) - LENGTH + 1
    rank = np.empty(max(n, 0), np.uint64)
    for at in range(0, n, CHUNK_BYTES):
        rank[at : at + CHUNK_BYTES] = RangeHash(buffer[at : at + CHUNK_BYTES + LENGTH - 1]).fixed(LENGTH)
    rank = rank[start]
    order = np.argsort(rank, kind="stable")
    rank = rank[order]
    same = np.flatnonzero(rank[1:] == rank[:-1])
    later = np.zeros(len(start), bool)
    later[order[same + 1]] = True
    view = np.lib.stride_tricks.sliding_window_view(buffer, LENGTH) if len(same) else None
    for at in range(0, len(same), 20_000):
        i = same[at : at + 20_000]
        differ = i[(view[start[order[i]]] != view[start[order[i + 1]]]).any(axis=1)]
        for value in set(rank[differ].tolist()):  # two strings of one hash: told apart by their bytes
            lo, hi = (int(np.searchsorted(rank, np.uint64(value), side)) for side in ("left", "right"))
            seen: set[bytes] = set()
            for k in order[lo:hi].tolist():
                window = view[start[k]].tobytes()
                later[k] = window in seen
                seen.add(window)
    return later


def _ordered(dictionary: DataFrame, n: int) -> DataFrame:
    """(home, kind 0, blob): windows of the dictionary that came earlier."""

    def run(key, group):
        release()
        if key[0].as_py() >= n:
            high, low, number, row, window = (np.concatenate(c) for c in zip(*map(unpack, group["blob"].to_pylist())))
            order = np.lexsort((window, row, number, low, high))
            later = order[1:][(high[order][1:] == high[order][:-1]) & (low[order][1:] == low[order][:-1])]
            row, window = row[later], window[later]
            out = [(h, 0, pack(r, w, w + np.uint64(TRIGGER))) for h, (r, w) in _by(_home(row, n), n, [row, window])]
            return _as_rows(out, [pa.int32(), pa.int32(), pa.binary()], ["home", "kind", "blob"])
        head, body = [], []
        for blob in group["blob"].to_pylist():
            size = int.from_bytes(blob[:8], "little")
            head.append(unpack(blob[8 : 8 + size]))
            body.append(zstandard.ZstdDecompressor().decompress(blob[8 + size :], max_output_size=max(1, int(head[-1][3].sum()))))
        row, number, first, length = (np.concatenate(c) for c in zip(*head))
        buffer = np.frombuffer(b"".join(body), np.uint8)
        place = np.cumsum(np.concatenate([[0], length.astype(np.int64)]))[:-1]
        order = np.lexsort((first, row, number))
        row, first, place = row[order], first[order], place[order]
        count = length[order].astype(np.int64) - LENGTH + 1
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        later = later_windows(buffer, np.repeat(place, count) + within)
        row, window = np.repeat(row, count)[later], (np.repeat(first, count) + within.astype(np.uint64))[later]
        out = [(h, 0, pack(r, w, w + np.uint64(TRIGGER))) for h, (r, w) in _by(_home(row, n), n, [row, window])]
        return _as_rows(out, [pa.int32(), pa.int32(), pa.binary()], ["home", "kind", "blob"])

    return dictionary.groupBy("part").applyInArrow(run, "home int, kind int, blob binary")


def spans_of(blobs: list[bytes]) -> dict[int, tuple[list[int], list[int]]]:
    """Row to starts and ends of its maximal removed byte runs."""
    if not blobs:
        return {}
    row, a, b = (np.concatenate(c) for c in zip(*map(unpack, blobs)))
    a, b = a.astype(np.int64), b.astype(np.int64) - TRIGGER + LENGTH
    order = np.lexsort((a, row))
    row, a, b = row[order], a[order], b[order]
    new = np.ones(len(row), bool)
    new[1:] = row[1:] != row[:-1]
    # The furthest end so far within a row: rows are set apart by an offset.
    apart = (np.cumsum(new) - 1) * (int(b.max()) + 1)
    far = np.maximum.accumulate(b + apart)
    first = new.copy()
    first[1:] |= a[1:] + apart[1:] > far[:-1]
    at = np.flatnonzero(first)
    last = np.append(at[1:], len(row)) - 1
    owner, start, end = row[at], a[at], far[last] - apart[last]
    edge = [0, *(np.flatnonzero(owner[1:] != owner[:-1]) + 1).tolist(), len(owner)]
    return {int(owner[i]): (start[i:j].tolist(), end[i:j].tolist()) for i, j in zip(edge, edge[1:])}


def _stored(rows: DataFrame, n: int) -> DataFrame:
    """(home, kind 2, blob): all columns of blocks of rows, compressed."""

    def run(batches):
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for batch in batches:
            row_id = batch.column(0).to_numpy().view(np.uint64)
            cut = np.flatnonzero(np.diff(row_id >> _ROW_BLOCK)) + 1
            for a, b in zip([0, *cut], [*cut, len(row_id)]):
                if a < b:
                    sink = pa.BufferOutputStream()
                    with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
                        writer.write_batch(batch.slice(a, b - a))
                    yield pa.record_batch([pa.array(_home(row_id[a : a + 1], n), pa.int32()), pa.array([2], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["home", "kind", "blob"])

    return rows.mapInArrow(run, "home int, kind int, blob binary")


def _cut(data: bytes, starts: list[int], ends: list[int]) -> bytes:
    return b"".join(data[a:b] for a, b in zip([0, *ends], [*starts, len(data)])) if starts else data


def _with_spans(docs: DataFrame, id_col: str, text_col: str, make, schema) -> DataFrame:
    """``make(rows, spans)`` of every block of ``docs``; rows are an Arrow
    table of the row number and the columns of ``docs``.

    Rows travel compressed by blocks to the same place as the marks, which
    moves less than a join of texts with their spans."""
    name = "__row"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    marks, n = _marks(docs, id_col, text_col)
    rows = docs.select(F.monotonically_increasing_id().alias(name), *docs.columns)

    def run(_key, group):
        release()
        kinds, blobs = group["kind"].to_pylist(), group["blob"]
        spans = spans_of([blobs[i].as_py() for i, k in enumerate(kinds) if k == 0])
        return pa.concat_tables([make(pa.ipc.open_stream(blobs[i].as_py()).read_all(), spans) for i, k in enumerate(kinds) if k == 2])

    return _stored(rows, n).union(marks).groupBy("home").applyInArrow(run, schema)


def _marks(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """(home, kind 0, blob): windows that came earlier, and the number of homes."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    n_bytes = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    n = max(32, n_bytes // PART_BYTES)
    settled = fresh(_settled(_parse(rows, n, hot_triggers(rows)), n))
    blocks = _texts(rows, n).union(settled.where("kind = 1"))
    return settled.where("kind = 0").union(_ordered(_dictionary(blocks, n), n)), n


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): the remaining bytes."""
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def make(rows: pa.Table, spans: dict) -> pa.Table:
        found = [spans.get(r & (2**64 - 1), ([], [])) for r in rows.column(0).to_pylist()]
        old = [(t or "").encode() for t in rows.column(2).to_pylist()]
        new = [_cut(d, *f) for d, f in zip(old, found)]
        sizes = [[len(d) for d in old], [len(d) - len(k) for d, k in zip(old, new)], [len(f[0]) for f in found]]
        return pa.table([rows.column(1), *(pa.array(x, pa.int64()) for x in sizes), pa.array(new, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return _with_spans(narrow, "doc_id", "text", make, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with texts cut; a character cut in two is dropped whole."""
    names = docs.columns
    at = names.index(text_col) + 1

    def make(rows: pa.Table, spans: dict) -> pa.Table:
        found = [spans.get(r & (2**64 - 1)) for r in rows.column(0).to_pylist()]
        new = [t if f is None else _cut(t.encode(), *f).decode("utf-8", "ignore") for t, f in zip(rows.column(at).to_pylist(), found)]
        columns = [pa.array(new, pa.string()) if i == at else rows.column(i) for i in range(1, rows.num_columns)]
        return pa.table(columns, names=names)

    return _with_spans(docs, id_col, text_col, make, docs.schema)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = deduplicated(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

"""Periodic run detection (operator 13): seed and extend on diagonals.

A run is a stretch of words with smallest period q and at least max(6, 4 q)
words that no neighbouring word extends.  Then words q apart agree over at
least 3 q places (5 for q = 1, 6 for q = 2), so periods are searched in classes
[2**j, 2**(j+1)), each with the longest k-gram that every run of the class must
hold: k = 3 * 2**j (5 for j = 0).

* Index: k-grams get exact numbers by joining numbers of shorter grams (lengths
  double); a position whose gram occurs once in its document leaves at once, so
  plain prose is gone after a few steps.
* Pairs: only *consecutive* occurrences of a gram in a document, at a distance
  of the class.  None is missed: k is at least 1.5 q, so an occurrence between
  two that are q apart would give the run a smaller period (Fine and Wilf).
  For the same reason a distance found is the smallest period of its stretch.
* Extension along the diagonal of the lag, left and right, to the first words
  that differ; a table holds the furthest place covered for each lag, and seeds
  below it are skipped.  Stretches have exponent 2.5 or more, so their number
  and the work are near linear.

Documents are independent: one Arrow pass, no shuffle; a task holds one batch
of at most ``CHUNK_BYTES`` of text, or one longer document.

Defined cases: a null, empty or blank text has no words, no runs and collapses
to nothing; a null id is planted nothing; repeated rows are separate documents;
other columns are left out.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from stratiform.llm.common import id_text, release, row_groups, table, utf8

LEAST, EXPONENT = 6, 4  # a run has at least so many words, and so many periods
Run = tuple[int, int, int]  # start, length, period


def _joined(left: np.ndarray, right: np.ndarray, shift: int) -> np.ndarray:
    """Numbers of the grams made of ``left`` at i and ``right`` at i + shift;
    -1 where the gram does not occur twice."""
    out = np.full(len(left), -1, np.int64)
    at = np.flatnonzero((left[: max(0, len(left) - shift)] >= 0) & (right[shift:] >= 0)) if shift < len(left) else np.zeros(0, np.int64)
    if len(at):
        _, number, count = np.unique(left[at] * (right.max() + 1) + right[at + shift], return_inverse=True, return_counts=True)
        again = count[number] > 1
        out[at[again]] = number[again]
    return out


def _seeds(grams: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray]:
    """(lag, position) of consecutive occurrences low to 2 * low - 1 apart,
    sorted."""
    at = np.flatnonzero(grams >= 0)
    at = at[np.argsort(grams[at], kind="stable")]
    lag = np.diff(at)
    fits = (grams[at[1:]] == grams[at[:-1]]) & (lag >= low) & (lag < 2 * low)
    lag, at = lag[fits], at[:-1][fits]
    order = np.lexsort((at, lag))
    return lag[order], at[order]


def _reach(w: np.ndarray, i: int, lag: int, step: int) -> int:
    """How many places from i on, in the direction of ``step``, agree with the
    words ``lag`` later."""
    done, width = 0, 32
    while True:
        if step > 0:
            a, b = w[i + done : i + done + width], w[i + done + lag : i + done + lag + width]
            a = a[: len(b)]
        else:
            first = max(0, i - done - width + 1)
            a, b = w[first : i - done + 1][::-1], w[first + lag : i - done + 1 + lag][::-1]
        differ = np.flatnonzero(a != b)
        if len(differ):
            return done + int(differ[0])
        done += len(a)
        if len(a) < width:
            return done
        width *= 2


def _extended(w: np.ndarray, k: int, lags: np.ndarray, at: np.ndarray) -> Iterator[Run]:
    """Stretches grown from the seeds of one class."""
    edges = np.flatnonzero(np.diff(lags, prepend=-1, append=-1))
    for a, b in zip(edges[:-1], edges[1:]):
        lag, seeds = int(lags[a]), at[a:b]
        t = 0
        while t < len(seeds):
            seed = int(seeds[t])
            start = seed - _reach(w, seed - 1, lag, -1) if seed else seed
            furthest = seed + k + _reach(w, seed + k, lag, 1)
            yield start, furthest - start + lag, lag
            t = int(np.searchsorted(seeds, furthest))  # the table's entry for this lag


def find_runs(w: np.ndarray) -> list[Run]:
    """Runs of a sequence of words given as numbers from 0 on.  Sequences laid
    end to end must not share a number: then no run crosses a border."""
    if len(w) < LEAST:
        return []
    grams = {1: np.where(np.bincount(w)[w] > 1, w, -1)}
    for m in (2, 4):
        grams[m] = _joined(grams[m // 2], grams[m // 2], m // 2)
    found, low = [], 1
    while True:
        if low == 1:
            k, index = 5, _joined(grams[4], grams[1], 4)
        else:
            k, index = 3 * low, _joined(grams[2 * low], grams[low], 2 * low)
        found += _extended(w, k, *_seeds(index, low))
        low *= 2
        if 2 * low not in grams:
            grams[2 * low] = _joined(grams[low], grams[low], low)
            grams = {m: g for m, g in grams.items() if m >= low}
        if not (grams[2 * low] >= 0).any():
            break
    return sorted((s, n, q) for s, n, q in found if n >= max(LEAST, EXPONENT * q))


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The query's damage: one document in ten goes on periodically from some
    word on, by its id's checksum."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def _scanned(batch: pa.RecordBatch, plant: bool) -> Iterator[tuple[int | None, list[bytes], list[Run]]]:
    """(id, words, runs) of each row."""
    data, offsets = utf8(batch.column(1))
    ids = batch.column(0)
    for first, last in row_groups(offsets):
        docs, numbers, base, starts = [], [], 0, [0]
        for i in range(first, last):
            words = data[offsets[i] : offsets[i + 1]].tobytes().split()  # bytes split at just these six blanks
            doc_id = ids[i].as_py()
            words = planted(doc_id, words) if plant else words
            known: dict[bytes, int] = {}
            numbers.append(np.array([known.setdefault(x, len(known)) for x in words], np.int64) + base)
            base += len(known)
            docs.append((doc_id, words))
            starts.append(starts[-1] + len(words))
        runs = find_runs(np.concatenate(numbers))
        edges = np.searchsorted([r[0] for r in runs], starts) if runs else [0] * len(starts)
        for j, (doc_id, words) in enumerate(docs):
            yield doc_id, words, [(s - starts[j], n, q) for s, n, q in runs[edges[j] : edges[j + 1]]]


def kept_words(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """Words that no run contains after its first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep)]


def _pass(docs: DataFrame, spec: str, types: list[pa.DataType], row, plant: bool) -> DataFrame:
    names = [f.split(" ")[0] for f in spec.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            for doc_id, words, runs in _scanned(batch, plant):
                for r in row(doc_id, words, runs):
                    out.append(r)
                    held += len(r[-1]) if isinstance(r[-1], bytes) else 0
                if held > 1 << 23:
                    yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                    out, held = [], 0
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
        release()

    return docs.mapInArrow(run, spec)


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, start, length, period): a row for each run."""
    spec = "doc_id long, start long, length long, period long"
    return _pass(id_text(docs, id_col, text_col), spec, [pa.int64()] * 4, lambda i, _, found: [(i, *r) for r in found], False)


def collapsed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): the words that stay when each run keeps one period."""

    def row(doc_id, words, found):
        yield doc_id, b" ".join(kept_words(words, found))

    out = _pass(id_text(docs, id_col, text_col), "doc_id long, text binary", [pa.int64(), pa.binary()], row, False)
    return out.selectExpr("doc_id", "decode(text, 'UTF-8') AS text")


_DIGEST = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _digest(doc_id, words, found) -> Iterator[tuple]:
    top = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    milli = 1000 * top[1] // top[2] if found else None
    said = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    shas = (hashlib.sha256(x).hexdigest() for x in (said.encode(), b" ".join(kept_words(words, found))))
    yield doc_id, len(found), *top, milli, *shas


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = id_text(table(spark, sf_dir, "documents"))
    return _pass(docs, _DIGEST, [pa.int64()] * 6 + [pa.string()] * 2, _digest, True)

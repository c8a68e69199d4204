"""Secret scans (operator 1): patterns plus a randomness test battery.

Base spans come from three fixed patterns.  Beyond them every run of 20 or
more encoding characters is a candidate.  Its encoding (hex, base32, letters,
alphanumeric, base64, ...) is inferred from the characters used, and three
tests ask whether it looks uniform in that alphabet: chi-squared over equal
bins, Wald-Wolfowitz runs about the middle, and lag-one serial correlation.
Fisher's method joins the three p-values into one score; near 0 is random.

Which scores are random enough is decided with false-discovery control per
length class and encoding, because short runs and small alphabets give the
tests little power.  The null distribution has two sources.  Typed decoys are
simulated and depend on neither the size nor the script of the corpus: words
of several languages as people type them in the encoding's characters (joined,
capitalised, with numbers and marks); each stratum has ``TYPED`` of them and
one more for each run, so that the smallest share that can be told shrinks as
the runs grow.  Corpus decoys are prose of the documents, one of each length
class and text, joined to one run and tested in one of the alphabets.  The
threshold of a stratum is the lowest score at which the expected share of
decoy-like runs among the accepted ones is at most ``FALSE_SHARE``
(Benjamini and Hochberg's rule); the share of decoys at a score is that of
both sources together, or of the corpus' own if that is larger.  Equal runs
are one run there, and equal decoys one decoy.  Only counts by stratum and
score bin reach the driver.

``scan`` gives spans per document, ``redact`` replaces them in the text; both
are one pass over the texts, and only hashes of runs and decoys are shuffled.

Defined cases: null text is empty and has no spans; equal rows each get theirs;
a base span is never dropped, and a candidate that touches one is not added
again; a stratum in which the tests cannot tell random from typed accepts none.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.common import fresh, row_groups, table, utf8

KINDS = ("assign", "access", "hex", "random")
#: Fixed patterns of the base kinds (ASCII letters in either case in the first).
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
LEAST = {"assign": 6, "access": 20, "hex": 24}

LEAST_RUN = 20
LENGTH_CLASSES = (20, 24, 32, 48, 64, 96)  # least length of each class
FALSE_SHARE = 0.01
TYPED = 21_000  # simulated decoys of a stratum
_BINS = 400  # score bins of 0.05 from 0 downwards
_LOWER, _UPPER, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ENCODINGS = (
    ("hex", _DIGIT + "abcdef"),
    ("HEX", _DIGIT + "ABCDEF"),
    ("base32", _UPPER + "234567"),
    ("lower", _LOWER),
    ("lower36", _DIGIT + _LOWER),
    ("upper36", _DIGIT + _UPPER),
    ("letters", _UPPER + _LOWER),
    ("base62", _UPPER + _LOWER + _DIGIT),
    ("base64", _UPPER + _LOWER + _DIGIT + "+/"),
    ("base64url", _UPPER + _LOWER + _DIGIT + "-_"),
    ("any", _UPPER + _LOWER + _DIGIT + "+/-_"),
)
_PLACES = [{c: i for i, c in enumerate(letters)} for _, letters in ENCODINGS]

_IS_HEX, _IS_RUN = np.zeros(256, bool), np.zeros(256, bool)
_IS_HEX[[ord(c) for c in _DIGIT + "abcdef"]] = True
_IS_RUN[[ord(c) for c in ENCODINGS[-1][1]]] = True


def encoding_of(run: str) -> int:
    """The first encoding that has all characters of the run."""
    used = set(run)
    return next(i for i, places in enumerate(_PLACES) if used <= places.keys())


def _normal_tail(z: float) -> float:
    return max(math.erfc(abs(z) / math.sqrt(2)), 1e-300)


def _chi2_tail(x: float, df: int) -> float:
    """Upper tail by Wilson and Hilferty's cube root."""
    z = ((x / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    return max(0.5 * math.erfc(z / math.sqrt(2)), 1e-300)


def battery(run: str, encoding: int) -> tuple[float, float, float]:
    """p-values: uniformity, runs, serial correlation."""
    places = _PLACES[encoding]
    at = [places[c] for c in run]
    n, size = len(at), len(places)
    bins = max(2, min(size, n // 2))
    counts = Counter(a * bins // size for a in at)
    expected = Counter(a * bins // size for a in range(size))
    chi = sum((counts[b] - n * e / size) ** 2 / (n * e / size) for b, e in expected.items())
    uniform = _chi2_tail(chi, bins - 1)
    upper = [a >= size / 2 for a in at]
    n1 = sum(upper)
    n2 = n - n1
    if n1 and n2:
        runs = 1 + sum(a != b for a, b in zip(upper, upper[1:]))
        mean = 2 * n1 * n2 / n + 1
        var = (mean - 1) * (mean - 2) / (n - 1)
        changes = _normal_tail((runs - mean) / math.sqrt(var)) if var > 0 else 1.0
    else:
        changes = 2.0 ** (1 - n) if n < 900 else 1e-300
    centre = sum(at) / n
    spread = sum((a - centre) ** 2 for a in at)
    serial = _normal_tail(sum((a - centre) * (b - centre) for a, b in zip(at, at[1:])) / spread * math.sqrt(n)) if spread else 1e-300
    return uniform, changes, serial


def score(run: str, encoding: int | None = None) -> float:
    """log10 of the joint p-value, at most 0; lower is less random."""
    p = battery(run, encoding_of(run) if encoding is None else encoding)
    x = -sum(math.log(v) for v in p)  # half of Fisher's statistic, 6 degrees of freedom
    return max(-20.0, (math.log(1 + x + x * x / 2) - x) / math.log(10)) if x < 600 else -20.0


_erfc = np.vectorize(math.erfc, otypes=[float])


def scores(at: np.ndarray, encoding: int) -> np.ndarray:
    """``score`` of many runs of one length, given as places in the alphabet."""
    (rows, n), size = at.shape, len(_PLACES[encoding])
    tail = lambda z: np.maximum(_erfc(np.abs(z) / math.sqrt(2)), 1e-300)
    bins = max(2, min(size, n // 2))
    counts = np.bincount((np.arange(rows)[:, None] * bins + at * bins // size).ravel(), minlength=rows * bins).reshape(rows, bins)
    expected = np.bincount(np.arange(size) * bins // size, minlength=bins) * (n / size)
    chi, df = ((counts - expected) ** 2 / expected).sum(axis=1), bins - 1
    z = ((chi / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df))
    uniform = np.maximum(0.5 * _erfc(z / math.sqrt(2)), 1e-300)
    upper = at >= size / 2
    n1 = upper.sum(axis=1)
    mean = 2 * n1 * (n - n1) / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1)
    changes = np.where(var > 0, tail((1 + (upper[:, 1:] != upper[:, :-1]).sum(axis=1) - mean) / np.sqrt(np.where(var > 0, var, 1))), 1.0)
    changes = np.where((n1 == 0) | (n1 == n), 2.0 ** (1 - n) if n < 900 else 1e-300, changes)
    off = at - at.mean(axis=1, keepdims=True)
    spread = (off**2).sum(axis=1)
    serial = np.where(spread > 0, tail((off[:, 1:] * off[:, :-1]).sum(axis=1) / np.where(spread > 0, spread, 1) * math.sqrt(n)), 1e-300)
    x = -(np.log(uniform) + np.log(changes) + np.log(serial))
    return np.where(x < 600, np.maximum(-20.0, (np.log(1 + x + x * x / 2) - x) / math.log(10)), -20.0)


def stratum(length: int, encoding: int) -> int:
    """Length class and encoding, within which runs and decoys are compared."""
    return (sum(length >= least for least in LENGTH_CLASSES) - 1) * len(ENCODINGS) + encoding


def base_spans(text: str, hex_runs: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base kinds."""
    out = [(a, 2, b) for a, b in hex_runs if b - a >= LEAST["hex"]]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST["assign"]]
    return sorted(out)


#: Words of several languages, also in transcription, and syllables for others.
_WORDS = (
    "the of and to in is that for it as was with be by on not he his but at are this have from or had an they which one you were all her she there would their we him been has when who will no more if out so "
    "value name file data user index count list type string number test config server client report image table account order price update create delete section chapter house water people world country history "
    "der die und den von zu das mit sich des auf nicht ein eine als auch werden nach wird oder zwischen geschichte le les et pour dans que une est pas plus avec leur comme histoire pays el los las para como pero entre "
    "ciudad tiempo di che non sono della citta na ne chto kak eto bylo gorod vremya ulitsa zhong guo ren shi de wo bu ta xue sheng beijing shanghai watashi desu tokyo kawa yama hito kitab madina bayt nehir sehir"
).split()
_SYLLABLES = "ka ke ki ko ra re ri ro sa se shi so ta te ti to na ne ni no ma mi mo la li lo pa pe po ba be bi da de di do ga go va ve vo ha chi zha xin jing yan tion ment ing er ver lich keit ova ski grad".split()
_FORMS = ("joined", "capitalised", "marked")


def typed(rng: random.Random, encoding: int, form: int, length: int) -> str:
    """A run of ``length`` characters that a person may type in the encoding."""
    letters, out, n = ENCODINGS[encoding][1], [], 0
    lower, upper, marks = "a" in letters, "A" in letters, [m for m in "+/-_" if m in letters]
    full = {len(letters)} if "z" in letters.lower() else set()
    mark = rng.choice(marks) if marks else ""
    while n < length:
        word = rng.choice(_WORDS) if rng.random() < 0.6 else "".join(rng.choices(_SYLLABLES, k=rng.randint(2, 4)))
        word = word if lower else word.upper()
        if lower and upper and (form == 1 or (form == 2 and rng.random() < 0.3)):
            word = word.capitalize()
        if not full:
            word = "".join(c for c in word if c in letters)
        if form == 2:
            number = str(rng.choice((rng.randint(0, 99), rng.randint(1900, 2030), rng.randint(0, 9999)))) if "0" in letters and rng.random() < 0.3 else ""
            number = "".join(c for c in number if c in letters) if number else ""
            word += number + (mark if rng.random() < 0.8 else "")
        elif not full and "2" in letters and not word:
            continue
        out.append(word)
        n += len(word)
    return "".join(out)[:length]


@lru_cache(maxsize=None)
def _typed_places(encoding: int, form: int) -> np.ndarray:
    """A long text of one form in places of the alphabet, in pieces of their own mark."""
    rng, places = random.Random(f"{encoding} {form}"), _PLACES[encoding]
    longest = LENGTH_CLASSES[-1] * (TYPED // len(_FORMS) // 100)
    lookup = np.zeros(128, np.int64)
    lookup[[ord(c) for c in places]] = list(places.values())
    return lookup[np.frombuffer("".join(typed(rng, encoding, form, longest) for _ in range(100)).encode(), np.uint8)]


@lru_cache(maxsize=None)
def typed_counts(cls: int) -> np.ndarray:
    """Counts of the simulated decoys of a stratum by score bin; their length
    is the least of the class, at which the tests tell least."""
    nth, encoding = divmod(cls, len(ENCODINGS))
    length, each = LENGTH_CLASSES[nth], TYPED // len(_FORMS)
    found = np.concatenate([scores(_typed_places(encoding, form)[: each * length].reshape(each, length), encoding) for form in range(len(_FORMS))])
    return np.bincount(np.minimum(np.floor(-found * (_BINS / 20)).astype(np.int64), _BINS - 1), minlength=_BINS)


def twin(run: str, encoding: int) -> float:
    """Score of the typed decoy of a run."""
    rng = random.Random(run)
    length = max(least for least in LENGTH_CLASSES if least <= len(run))
    return score(typed(rng, encoding, rng.randrange(len(_FORMS)), length), encoding)


def _id(run: str, encoding: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{encoding} {run}".encode(), digest_size=8).digest(), "little", signed=True)


def decoys(text: str) -> list[tuple[int, str]]:
    """(encoding, run) of each length class: prose of the document as it would
    be typed in an encoding's letters.  Place, length and encoding follow from
    the text's length, so the corpus covers all encodings; where the prose at
    the place is too short, the rest of the text and then its beginning follow."""
    n, out = len(text), []
    for nth, least in enumerate(LENGTH_CLASSES) if n >= LEAST_RUN else ():
        encoding, length, at = (n + 2 * nth) % len(ENCODINGS), least + n // 7 % 4, (n * 37 + least * 59) % 101 * n // 101
        letters, near = ENCODINGS[encoding][1], at + 10 * length + 40
        for prose in (text[at:near], text[at:] + text[:at]) if near < n or at else (text,):
            prose = prose if "a" in letters and "Z" in letters else prose.lower() if "a" in letters else prose.upper()
            run = "".join(re.findall("[A-Za-z]+", prose))
            run = "".join(filter(_PLACES[encoding].__contains__, run))[:length]
            if len(run) == length:
                out.append((encoding, run))
                break
    return out


def _runs(data: np.ndarray, offsets: np.ndarray, member: np.ndarray, least: int):
    """(row, start, end) of maximal runs of member bytes within rows."""
    solid = np.concatenate([[False], member[data], [False]])
    edge = np.flatnonzero(solid[1:] != solid[:-1])
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    inner = inner[solid[inner] & solid[inner + 1]]  # a run over a row's end is two
    edge = np.sort(np.concatenate([edge, inner, inner]))
    start, end = edge[::2], edge[1::2]
    keep = end - start >= least
    start, end = start[keep], end[keep]
    return np.searchsorted(offsets, start, side="right") - 1, start, end


def findings(column: pa.Array):
    """Per row: its text, base spans, and candidate runs (start, end, run)."""
    data, offsets = utf8(column)
    for first, last in row_groups(offsets):
        part, ends = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        chars = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])
        found = []
        for member, least in ((_IS_HEX, LEAST["hex"]), (_IS_RUN, LEAST_RUN)):
            by_row: dict[int, list[tuple[int, int]]] = {}
            for row, a, b in zip(*(x.tolist() for x in _runs(part, ends, member, least))):
                base = chars[ends[row]]
                by_row.setdefault(row, []).append((int(chars[a] - base), int(chars[b] - base)))
            found.append(by_row)
        raw = part.tobytes()
        for row in range(last - first):
            text = raw[ends[row] : ends[row + 1]].decode()
            base = base_spans(text, found[0].get(row, []))
            runs = [(a, b) for a, b in found[1].get(row, []) if not any(s < b and a < e for s, _, e in base)]
            yield text, base, [(a, b, text[a:b]) for a, b in runs]


_SCANNED = "doc_id long, base array<struct<start:long,kind:int,end:long>>, runs array<struct<start:long,end:long,cls:int,score:double,id:long,twin:double>>, decoys array<struct<cls:int,score:double,id:long>>"


def scan_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base spans, scored candidates and decoys of every row."""

    def run(batches):
        types = [pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("cls", pa.int32()), ("score", pa.float64()), ("id", pa.int64()), ("twin", pa.float64())])), pa.list_(pa.struct([("cls", pa.int32()), ("score", pa.float64()), ("id", pa.int64())]))]
        for batch in batches:
            base, runs, null = [], [], []
            for text, spans, candidates in findings(batch.column(1)):
                base.append([{"start": a, "kind": k, "end": b} for a, k, b in spans])
                runs.append([{"start": a, "end": b, "cls": stratum(b - a, e), "score": score(s, e), "id": _id(s, e), "twin": twin(s, e)} for a, b, s in candidates for e in [encoding_of(s)]])
                null.append([{"cls": stratum(len(d), e), "score": score(d, e), "id": _id(d, e)} for e, d in decoys(text)])
            yield pa.record_batch([batch.column(0), *(pa.array(c, t) for c, t in zip((base, runs, null), types))], names=["doc_id", "base", "runs", "decoys"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, _SCANNED)


def thresholds(scanned: DataFrame, false_share: float = FALSE_SHARE) -> dict[int, float]:
    """Least accepted score by stratum; one that accepts none is absent."""
    slot = F.least(F.floor(-F.col("score") * (_BINS / 20)), F.lit(_BINS - 1)).cast("int").alias("slot")
    both = scanned.select(F.explode("runs").alias("r"))
    runs = both.select("r.cls", F.lit(0).alias("source"), "r.id", "r.score")
    corpus = scanned.select(F.explode("decoys").alias("r")).select("r.cls", F.lit(1).alias("source"), "r.id", "r.score")
    twins = both.select("r.cls", F.lit(2).alias("source"), "r.id", F.col("r.twin").alias("score"))
    distinct = runs.union(corpus).union(twins).select("cls", "source", "id", slot).distinct()
    tally = {}
    for r in distinct.groupBy("cls", "source", "slot").agg(F.count(F.lit(1)).alias("n")).collect():
        tally.setdefault(r["cls"], np.zeros((3, _BINS)))[r["source"], r["slot"]] += r["n"]
    out = {}
    for cls, counts in tally.items():
        runs_n, corpus_n, twins_n = counts.sum(axis=1)
        if not runs_n:
            continue
        found, own, simulated = counts.cumsum(axis=1)
        simulated = simulated + typed_counts(cls).cumsum()
        share = np.maximum((1 + own + simulated) / (1 + corpus_n + twins_n + TYPED), own / max(corpus_n, 1))
        accepted = np.flatnonzero((found > 0) & (share * runs_n <= false_share * found))
        if len(accepted):
            out[cls] = -(accepted[-1] + 1) * 20 / _BINS
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, dict[int, float]]:
    """(doc_id, spans of every kind in order) and the thresholds used."""
    scanned = fresh(scan_rows(docs, id_col, text_col))
    least = thresholds(scanned)
    accept = lambda r: F.coalesce(F.coalesce(*[F.when(r["cls"] == c, r["score"] > t) for c, t in least.items()], F.lit(False)), F.lit(False)) if least else F.lit(False)
    added = F.transform(F.filter("runs", accept), lambda r: F.struct(r["start"].alias("start"), F.lit(3).alias("kind"), r["end"].alias("end")))
    return scanned.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("spans")), least


def redact(docs: DataFrame, least: dict[int, float], mark: str = "[SECRET]", text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by ``mark``; other columns as they are."""
    at = docs.columns.index(text_col)

    def clean(text: str, base, runs) -> str:
        spans = [(a, b) for a, _, b in base] + [(a, b) for a, b, s in runs if (c := stratum(b - a, encoding_of(s))) in least and score(s) > least[c]]
        out, done = [], 0
        for a, b in sorted(spans):
            if a >= done:
                out += [text[done:a], mark]
            done = max(done, b)
        return "".join([*out, text[done:]]) if spans else text

    def run(batches):
        for batch in batches:
            old = batch.column(at)
            new = pa.array([clean(*f) for f in findings(old)], pa.string())
            new = pa.compute.if_else(pa.compute.is_null(old), pa.scalar(None, pa.string()), new)
            columns = [new if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned, _ = scan(table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(k) for k in KINDS])
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return scanned.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"),
        joined("spans").alias("spans"),
    )

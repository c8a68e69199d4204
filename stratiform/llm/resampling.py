"""Quality classifier (operator 10): importance resampling.

Generative models of hashed n-grams are counted twice: the *raw* ones over
every document, the *target* ones over labelled good documents.  One pair has
word unigrams and bigrams, the other letter n-grams (``WIDTH`` bytes).  A
document has two mean log ratios of target to raw: of all its word n-grams,
``sum / (n + PRIOR)``, and of its worst passage, the ``PASSAGE`` letter n-grams
in a row with the least sum.  The first tells odd documents, the second a few
odd words in an ordinary document, which the mean over a long text hides.

The weight is ``SHARPNESS`` times the lesser of the two, the passage shifted so
that both have one cut; length alone neither admits nor rejects a document.
Documents are sampled without replacement by Gumbel top-k: the k largest of
weight plus Gumbel noise (a hash of the id and the seed, so reruns agree).
``SHARPNESS`` is the inverse temperature: as it falls, the sample nears a
uniform one.  k is given, or the number of documents whose weight reaches the
cut.  Cuts are calibrated on the held-out half of the labelled sample; a lost
good document costs ``COST`` times an admitted bad one there.

Bounded: only the labelled sample (``max_labelled`` rows, those of least
hash) and the bucket counts (``buckets + LETTER_BUCKETS`` rows) reach the
driver.  Raw counts, weights, k and the k-th key cover all documents and whole
texts; a text of any length is read in slices.

Defined cases: null and empty texts have ratios of 0; without labels of both
kinds every document is kept; contradicting labels of one id count as bad; rows
of one id share their noise, and ties with the k-th key are all kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from stratiform.llm.common import CHUNK_BYTES, RangeHash, fresh, lowered, mix, release, row_groups, table, utf8, words

BUCKETS = 1 << 15
MAX_LABELLED = 20_000
PRIOR = 50
WIDTH, PASSAGE = 5, 4
LETTER_BUCKETS = 1 << 18
LETTER_PRIOR = 2.0
SHARPNESS = 300.0
COST = 20
SEED = 11


def ngram_buckets(column: pa.Array, buckets: int):
    """(first row, rows, n-gram's row, n-gram's bucket) of parts of a column."""
    data, offsets = utf8(column)
    for first, last in row_groups(offsets):
        part = lowered(data[offsets[first] : offsets[last]])
        starts, ends, rows = words(part, offsets[first : last + 1] - offsets[first])
        word = RangeHash(part).of(starts, ends)
        same = rows[1:] == rows[:-1]
        pair = mix(word[:-1] * np.uint64(3) + word[1:])[same]
        grams = np.concatenate([word, pair]) & np.uint64(buckets - 1)
        yield first, last - first, np.concatenate([rows, rows[1:][same]]), grams.astype(np.int64)


def letter_grams(column: pa.Array, buckets: int = LETTER_BUCKETS):
    """(rows, buckets, whole) of the n-grams that start at each byte, in slices
    of the column: ``whole`` marks those that end in their row.  The last
    ``WIDTH + PASSAGE - 2`` bytes of a slice are repeated by the next, so only
    the first ``CHUNK_BYTES`` n-grams are a slice's own."""
    data, offsets = utf8(column)
    for first in range(0, len(data), CHUNK_BYTES):
        part = lowered(data[first : first + CHUNK_BYTES + WIDTH + PASSAGE - 2])
        grams = (RangeHash(part).fixed(WIDTH) & np.uint64(buckets - 1)).astype(np.int64)
        at = np.arange(first, first + len(grams))
        rows = np.searchsorted(offsets, at, side="right") - 1
        yield rows, grams, at + WIDTH <= offsets[rows + 1]


@dataclass
class Model:
    word_ratio: np.ndarray
    letter_ratio: np.ndarray

    def means(self, column: pa.Array) -> np.ndarray:
        """Mean log ratio of every row's word n-grams."""
        out = np.zeros(len(column))
        for first, n, rows, grams in ngram_buckets(column, len(self.word_ratio)):
            count = np.bincount(rows, minlength=n)
            total = np.bincount(rows, weights=self.word_ratio[grams], minlength=n)
            out[first : first + n] = total / (count + PRIOR)
        return out

    def passages(self, column: pa.Array) -> np.ndarray:
        """Mean log ratio of every row's worst passage, at most 0.  A passage
        never crosses rows: what its row lacks counts as 0."""
        out = np.zeros(len(column))
        for rows, grams, whole in letter_grams(column, len(self.letter_ratio)):
            ratio = np.append(np.where(whole, self.letter_ratio[grams], 0.0), np.zeros(PASSAGE))
            total = sum(ratio[i : i + len(grams)] for i in range(PASSAGE))
            own = np.flatnonzero(whole[:CHUNK_BYTES])
            if len(own):
                starts = np.flatnonzero(np.diff(rows[own], prepend=-1))
                at = rows[own][starts]
                out[at] = np.minimum(out[at], np.minimum.reduceat(total[own], starts) / PASSAGE)
        return out


def labelled_sample(labels: DataFrame, max_labelled: int = MAX_LABELLED) -> dict[int, tuple[bool, bool]]:
    """id -> (good, held out) of at most ``max_labelled`` labelled documents."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    good = F.min(F.col("quality").cast("int") - F.coalesce(F.col("toxic").cast("int"), F.lit(0))) >= 1
    spread = F.xxhash64(F.col("doc_id").cast("long"), F.lit("labelled sample"))
    rows = known.groupBy("doc_id").agg(good.alias("good")).withColumn("spread", spread).orderBy("spread", "doc_id").limit(max_labelled)
    return {r["doc_id"]: (r["good"], bool(r["spread"] & 1)) for r in rows.collect()}


def fit(docs: DataFrame, sample: dict[int, tuple[bool, bool]], buckets: int = BUCKETS, letter_buckets: int = LETTER_BUCKETS) -> Model:
    """Counts all models in one pass; a task sends one row per bucket."""
    target_ids = np.array(sorted(i for i, (good, held) in sample.items() if good and not held), np.int64)
    size = buckets + letter_buckets  # word buckets first

    def count(batches):
        release()
        counts = np.zeros((2, size), np.int64)
        for batch in batches:
            ids = batch.column(0).fill_null(-(1 << 62)).to_numpy()
            chosen = np.isin(ids, target_ids)
            for first, n, rows, grams in ngram_buckets(batch.column(1), buckets):
                counts[0, :buckets] += np.bincount(grams, minlength=buckets)
                counts[1, :buckets] += np.bincount(grams[chosen[first : first + n][rows]], minlength=buckets)
            for rows, grams, whole in letter_grams(batch.column(1), letter_buckets):
                own = np.flatnonzero(whole[:CHUNK_BYTES])
                counts[0, buckets:] += np.bincount(grams[own], minlength=letter_buckets)
                counts[1, buckets:] += np.bincount(grams[own][chosen[rows[own]]], minlength=letter_buckets)
        seen = np.flatnonzero(counts[0])
        yield pa.record_batch([pa.array(seen), pa.array(counts[0][seen]), pa.array(counts[1][seen])], names=["bucket", "raw", "target"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = rows.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    found = found.toArrow()  # one row a bucket
    counts = np.zeros((2, size))
    counts[:, found["bucket"].to_numpy()] = found["raw"].to_numpy(), found["target"].to_numpy()
    word, letter = counts[:, :buckets] + 1, counts[:, buckets:]
    word = np.log(word / word.sum(axis=1, keepdims=True))
    share = letter[1].sum() / max(letter[0].sum(), 1.0)
    return Model(word[1] - word[0], np.log((letter[1] + LETTER_PRIOR) / (share * letter[0] + LETTER_PRIOR)))


def with_ratios(rows: DataFrame, model: Model, names: tuple[str, str] = ("mean", "passage"), text_col: str = "text") -> DataFrame:
    """All columns of ``rows`` and the documents' two mean log ratios."""
    at, fields = rows.columns.index(text_col), [*rows.columns, *names]

    def run(batches):
        release()
        for batch in batches:
            text = batch.column(at)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(model.means(text)), pa.array(model.passages(text))], names=fields)

    return rows.mapInArrow(run, StructType([*rows.schema.fields, *[StructField(n, DoubleType()) for n in names]]))


def gumbel(id_col: Column, seed: int | Column = SEED) -> Column:
    bits = F.xxhash64(id_col, seed if isinstance(seed, Column) else F.lit(seed)).bitwiseAND(F.lit((1 << 52) - 1))
    return -F.log(-F.log((bits + F.lit(0.5)) / F.lit(float(1 << 52))))


def kth_largest(rows: DataFrame, column: str, k: int) -> float:
    """The exact k-th largest value: a histogram narrowed until the bin that
    holds it has few rows.  Only bin counts and that bin reach the driver."""
    low, high, n = rows.agg(F.min(column), F.max(column), F.count(column)).first()
    if k >= n:
        return low if n else float("-inf")
    while True:
        inside = rows.where(F.col(column).between(low, high))
        step = (high - low) / 1024
        size = rows.where(F.col(column) > high).count()
        if step <= 0 or low + step == low:
            return high
        slot = F.least(F.floor((F.col(column) - low) / step), F.lit(1023))
        for r in inside.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("lo"), F.max(column).alias("hi")).orderBy(F.desc("slot")).collect():
            if size + r["n"] >= k:
                if r["lo"] == r["hi"]:
                    return r["lo"]
                if r["n"] <= 1000:
                    values = rows.where(F.col(column).between(r["lo"], r["hi"])).select(column).collect()
                    return sorted((v[0] for v in values), reverse=True)[k - size - 1]
                low, high = r["lo"], r["hi"]
                break
            size += r["n"]


def calibrated_cut(scored: DataFrame, sample: dict[int, tuple[bool, bool]], column: str) -> float:
    """The value from which held-out documents are good at the least cost."""
    spark = scored.sparkSession
    held = [(i, good) for i, (good, is_held) in sample.items() if is_held]
    if not held:
        return float("-inf")
    marks = F.broadcast(spark.createDataFrame(held, "doc_id long, good boolean"))  # at most max_labelled rows
    rows = scored.join(marks, "doc_id").groupBy("doc_id").agg(F.min(column).alias("value"), F.first("good").alias("good")).collect()
    if len({r["good"] for r in rows}) < 2:
        return float("-inf")
    rows.sort(key=lambda r: r["value"])
    value, good = np.array([r["value"] for r in rows]), np.array([r["good"] for r in rows])
    loss = np.concatenate([[0], COST * np.cumsum(good)]) + np.concatenate([np.cumsum((~good)[::-1])[::-1], [0]])
    at = int(np.argmin(loss))
    if at == 0:
        return float("-inf")
    return float(value[at - 1] + value[min(at, len(value) - 1)]) / 2


@dataclass
class Resampling:
    model: Model
    least_key: float
    k: int
    scored: DataFrame
    shift: float
    sharpness: float = SHARPNESS
    seed: int = SEED

    def weight(self, mean: Column, passage: Column) -> Column:
        return log_weight(mean, passage, self.shift, self.sharpness)

    def key(self, id_col: Column, weight: Column) -> Column:
        return weight + gumbel(id_col.cast("long"), self.seed)


def log_weight(mean: Column, passage: Column, shift: float, sharpness: float) -> Column:
    return F.least(mean, passage - F.lit(shift)) * F.lit(sharpness)


def calibrated(scored: DataFrame, sample: dict[int, tuple[bool, bool]]) -> tuple[float, float]:
    """(cut, shift): documents whose lesser of ``mean`` and ``passage - shift``
    reaches the cut are good.  The passage is judged on what the mean admits."""
    if len({good for good, _ in sample.values()}) < 2:
        return float("-inf"), float("-inf")
    cut = calibrated_cut(scored, sample, "mean")
    low = calibrated_cut(scored.where(F.col("mean") >= F.lit(cut)), sample, "passage")
    if low == float("-inf"):
        return cut, low
    if cut == float("-inf"):  # the mean admits all: any value below it will do
        cut = scored.agg(F.min("mean")).first()[0]
    return cut, min(low - cut, 0.0)  # texts without n-grams stay at 0


def resample(
    docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, max_labelled: int = MAX_LABELLED,
    sharpness: float = SHARPNESS, k: int | None = None, seed: int = SEED,
) -> Resampling:
    """The fitted models, the sample size and the least key sampled."""
    sample = labelled_sample(labels, max_labelled)
    model = fit(docs, sample, buckets)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ratios = fresh(with_ratios(rows, model).drop("text"))
    cut, shift = calibrated(ratios, sample)
    weighted = ratios.withColumn("weight", log_weight(F.col("mean"), F.col("passage"), shift, sharpness))
    scored = weighted.withColumn("sample_key", F.col("weight") + gumbel(F.col("doc_id"), seed))
    if k is None:
        k = scored.where(F.col("weight") >= F.lit(cut * sharpness)).count()
    return Resampling(model, kth_largest(scored, "sample_key", k) if k else float("inf"), k, scored, shift, sharpness, seed)


def sampled(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that importance resampling takes, all their columns."""
    made = resample(docs, labels, **options)
    tag = "_"
    while any(c.lower() in (f"{tag}mean", f"{tag}passage") for c in docs.columns):
        tag += "_"
    names = f"{tag}mean", f"{tag}passage"
    weight = made.weight(*map(F.col, names))
    return with_ratios(docs, made.model, names).where(made.key(F.col("doc_id"), weight) >= F.lit(made.least_key)).select(*docs.columns)


def op10_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, both ratios, log weight, perturbed key, and whether it was sampled."""
    made = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return made.scored.withColumn("kept", F.col("sample_key") >= F.lit(made.least_key))

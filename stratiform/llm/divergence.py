"""Quality rules (operator 6): divergence from language references.

Everything is DataFrame functions.  Per document: a histogram of character
classes (lower and upper letters, digits, blanks, symbols, others) and one of
common words.  The references are means of these shares over the documents of
a language that pass the base rules; its common words are the ``COMMON`` most
frequent words of letters, of any length.  A document is rejected if
its Jensen-Shannon distance to its language's reference exceeds the limit of
either histogram; documents with too few characters or words for a histogram
to mean much are not judged by it.

The documents are read twice (common words, histograms) and never shuffled:
the first pass sends counts by (language, word); the second writes one narrow
row per document to the checkpoint folder, from which the references are
averaged and the verdicts made.  Common words and references have one row per
language, whatever their number.  Both are written before they are joined, so
the planner knows their size: it broadcasts them while they are small, and
otherwise shuffles the documents by language, where the adaptive skew join
splits a hot language and replicates its single row.

Repeated eight-word windows are found inside the row: 64-bit hashes of the
windows are sorted with their places, equal neighbours mark repeats, and one
fold adds up the words they cover.

Defined cases: null text has no words and fails the base rules, as do empty
texts; a null language is a language of its own; equal rows get equal verdicts;
if no document of a language passes the base rules, only the base rules judge.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratiform.llm.common import fresh, let, table
from stratiform.session import checkpoint_dir

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]+"
WINDOW = 8
COMMON = 32
LEAST_CHARS = 100
LEAST_WORDS = 50
CLASS_LIMIT = 0.30
WORD_LIMIT, WORD_NOISE = 0.20, 1.5  # limit plus noise / sqrt(words): few words scatter more
CLASSES = ("lower", "upper", "blank", "digit", "symbol", "other")


def repeated_words(words: Column) -> Column:
    """Words inside windows of eight that occur twice or more."""
    return let(words, _repeated_words)


def _repeated_words(words: Column) -> Column:
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(F.slice(words, i + 1, WINDOW)))

    def covered(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twin(s):
            same = lambda j, x: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
            return F.filter(s, lambda x, j: ((j > 0) & same(F.greatest(j - 1, F.lit(0)), x)) | same(j + 1, x))

        places = let(placed, lambda s: F.sort_array(F.transform(twin(s), lambda x: x["i"])))
        start = F.struct(F.lit(0).alias("total"), F.lit(0).alias("end"))
        step = lambda acc, i: F.struct((acc["total"] + i + WINDOW - F.greatest(i, acc["end"])).alias("total"), (i + WINDOW).alias("end"))
        return F.aggregate(places, start, step, lambda acc: acc["total"])

    many = let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0)))
    return F.when(n >= WINDOW, many).otherwise(F.lit(0)).cast("long")


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Base counts, character classes and words of every document."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.concat(F.lit("="), F.col(lang_col).cast("string")), F.lit("")).alias("lang"),
    )
    rows = rows.withColumn("r0", F.regexp_replace("text", r"\p{Ll}+", "")).withColumn("r1", F.regexp_replace("r0", r"\p{Lu}+", ""))
    rows = rows.withColumn("r2", F.regexp_replace("r1", BLANKS, "")).withColumn("r3", F.regexp_replace("r2", "[0-9]+", "")).withColumn("r4", F.regexp_replace("r3", SYMBOLS, ""))
    sizes = [F.char_length(c) for c in ("text", "r0", "r1", "r2", "r3", "r4")]
    classes = F.array(*[a - b for a, b in zip(sizes, sizes[1:])], sizes[-1])
    rows = rows.select(
        "doc_id",
        "lang",
        F.array_remove(F.split("text", BLANKS, -1), "").alias("words"),
        F.filter(F.split("text", "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.char_length("text").cast("long").alias("n_chars"),
        classes.alias("classes"),
    )
    rows = rows.select(
        "doc_id",
        "lang",
        "words",
        "n_chars",
        "classes",
        F.size("words").cast("long").alias("n_words"),
        (F.col("n_chars") - F.get("classes", F.lit(2))).cast("long").alias("word_chars"),
        F.get("classes", F.lit(4)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
    )
    return rows.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def common_words(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, common): the most frequent words of each language."""
    lang = F.coalesce(F.concat(F.lit("="), F.col(lang_col).cast("string")), F.lit(""))
    words = F.split(F.col(text_col).cast("string"), BLANKS, -1)
    counts = docs.select(lang.alias("lang"), F.explode(words).alias("word")).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.where(F.col("word").rlike(r"^\p{L}+$"))
    best = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = counts.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= COMMON)
    return top.groupBy("lang").agg(F.sort_array(F.collect_list("word")).alias("common"))


def word_counts(words: Column, common: Column) -> Column:
    """Counts of all other words and, after them, of each common word."""
    places = F.transform(words, lambda w: F.coalesce(F.array_position(common, w), F.lit(0)).cast("int"))
    count = lambda p: F.transform(F.sequence(F.lit(0), F.size(common)), lambda k: F.size(p) - F.size(F.array_remove(p, k)))
    return let(places, count)


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One narrow row per document with both histograms, written once: the
    references and the verdicts are read off it."""
    common = stored(common_words(docs, text_col, lang_col))
    rows = features(docs, id_col, text_col, lang_col).join(common, "lang", "left")
    rows = rows.withColumn("common", F.coalesce("common", F.array().cast("array<string>")))
    return fresh(rows.withColumn("word_counts", word_counts(F.col("words"), F.col("common"))).drop("words", "common"))


def shares(counts: Column, total: Column) -> Column:
    return F.transform(counts, lambda c: c / total)


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two histograms."""
    part = lambda a, m: F.when(a > 0, a * F.log2(a / m)).otherwise(F.lit(0.0))
    terms = F.zip_with(p, q, lambda a, b: (part(a, (a + b) / 2) + part(b, (a + b) / 2)) / 2)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, x: s + x), F.lit(0.0)))


def references(rows: DataFrame) -> DataFrame:
    """(lang, class_ref, word_ref), a row for every language: mean shares over
    documents that pass the base rules, all documents read."""
    passed = rows.where("NOT base_failed")
    words, classes = shares(F.col("word_counts"), F.col("n_words")), shares(F.col("classes"), F.col("n_chars"))
    means = passed.groupBy("lang").agg(
        F.max(F.size("word_counts")).alias("bins"),
        F.array(*[F.avg(F.get(classes, F.lit(i))) for i in range(len(CLASSES))]).alias("class_ref"),
        F.array(*[F.avg(F.get(words, F.lit(i))) for i in range(COMMON + 1)]).alias("word_ref"),
    )
    return means.select("lang", "class_ref", F.slice("word_ref", F.lit(1), F.col("bins")).alias("word_ref"))


def stored(languages: DataFrame) -> DataFrame:
    """Written to the shared checkpoint folder as files: unlike a checkpoint
    these have a known size, by which the planner chooses the join."""
    spark = languages.sparkSession
    path = f"{checkpoint_dir(spark)}/languages-{uuid.uuid4().hex}"
    languages.write.parquet(path)
    return spark.read.schema(languages.schema).parquet(path)


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Base counts, both distances and the verdict of every document."""
    rows = measured(docs, id_col, text_col, lang_col)
    rows = rows.join(stored(references(rows)), "lang", "left")
    known = F.col("word_ref").isNotNull()
    classes, words = shares(F.col("classes"), F.col("n_chars")), shares(F.col("word_counts"), F.col("n_words"))
    rows = rows.withColumn("class_distance", F.when(known & (F.col("n_chars") >= LEAST_CHARS), distance(classes, F.col("class_ref"))))
    rows = rows.withColumn("word_distance", F.when(known & (F.col("n_words") >= LEAST_WORDS), distance(words, F.col("word_ref"))))
    limit = WORD_LIMIT + WORD_NOISE / F.sqrt(F.greatest("n_words", F.lit(1)))
    far = (F.coalesce("class_distance", F.lit(0.0)) > CLASS_LIMIT) | (F.coalesce("word_distance", F.lit(0.0)) > limit)
    return rows.withColumn("kept", ~F.col("base_failed") & ~far)


def op6_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "word_distance"
    )

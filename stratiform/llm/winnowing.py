"""Document fingerprints (operator 12): winnowing in DataFrame functions only.

A text is cut into tokens: words of up to 32 letters or digits of scripts that
put blanks between words, and every other code point that is no blank.  Every
``GRAM`` tokens in a row are hashed; of each ``WINDOW`` consecutive hashes the
least is chosen, of equal ones the rightmost, and kept with its position.  Two
texts that share ``GRAM + WINDOW - 1`` tokens in a row share a whole window, and
so a chosen hash.

A value is the hash's upper 52 bits over the lower bits of its place.  Minima
of windows come from three passes that each join two minima 1, 2 and 4 places
apart (the right one wins a tie); slices of an array for each window would copy
it every time.  The place follows from the window's number and the lower bits.
Hashes are computed gram by gram: SQL functions keep no running state that a
rolling update could use at less cost.  A row's arrays hold its tokens, so a
task needs some thirty bytes a byte of its longest text.

An entry of the fingerprint packs the 52-bit hash and, in the lower 12 bits,
the distance to the entry before it (at most ``WINDOW``), so positions cost
nothing.  ``next_documents`` gives each row its successor by id without a
global window: ids are cut into buckets at quantiles, each bucket also gets the
first row of the next one, and windows run inside buckets (one shuffle of the
texts).

Defined cases: a null text is empty and has no entries; a text of blanks only
has one entry, its hash; one of fewer than ``GRAM`` tokens is one gram, one of
fewer grams than a window has one window; two empty fingerprints are alike
(1.0), an empty and another are not (0.0); rows follow each other by id (nulls
first), then by a hash of the text and the text; after the last comes the
first, the only row follows itself; repeated rows stay; an empty table gives no
rows; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stratiform.llm.common import id_text, let, table

GRAM, WINDOW = 5, 8  # tokens of a gram, grams of a window (a power of two)
#: Runs of letters and digits of alphabets; any other code point alone.
TOKENS = r"[0-9A-Za-z\u00AA-\u0DFF\u10A0-\u1FFF\uAC00-\uD7AF]{1,32}|[^ \t\n\x0B\f\r]"
_PLACE = (1 << 12) - 1  # lower bits of a value
_NONE = "array<struct<hash:bigint,pos:int>>"


def _values(tokens: Column) -> Column:
    """Hash and place of each gram."""
    last = F.greatest(F.size(tokens) - GRAM, F.lit(0))
    gram = lambda i: F.xxhash64(*[F.get(tokens, i + j) for j in range(GRAM)])
    return F.transform(F.sequence(F.lit(0), last), lambda i: gram(i).bitwiseAND(F.lit(~_PLACE)).bitwiseOR(i.bitwiseAND(F.lit(_PLACE))))


def _minima(values: Column) -> Column:
    """The value chosen in each window."""
    level = lambda v: v.bitwiseOR(F.lit(_PLACE))
    shifted = lambda x, by: F.slice(x, by + 1, F.greatest(F.size(x) - by, F.lit(0)))
    joined = lambda by: lambda x: F.zip_with(x, shifted(x, by), lambda a, b: F.when(level(b) <= level(a), b).otherwise(a))
    least, by = values, 1
    while by < WINDOW:
        least = let(least, joined(by))
        by *= 2
    return let(least, lambda x: F.slice(x, F.lit(1), F.greatest(F.size(x) - WINDOW + 1, F.lit(1))))


def _entries(tokens: Column) -> Column:
    def placed(x: Column, i: Column, all_: Column) -> Column:
        pos = i + F.pmod(x.bitwiseAND(F.lit(_PLACE)) - i, F.lit(_PLACE + 1))
        return F.when((i == 0) | (x != F.get(all_, i - 1)), F.struct(x.bitwiseAND(F.lit(~_PLACE)).alias("hash"), pos.cast("int").alias("pos")))

    return let(_minima(_values(tokens)), lambda w: F.filter(F.transform(w, lambda x, i: placed(x, i, w)), lambda e: e.isNotNull()))


def chosen(text: Column) -> Column:
    """array<struct<hash, pos>> of a string, by position; empty for none."""
    whole = F.array(F.struct(F.xxhash64(text).bitwiseAND(F.lit(~_PLACE)).alias("hash"), F.lit(0).alias("pos")))
    tokens = F.regexp_extract_all(text, F.lit(TOKENS), F.lit(0))
    found = let(tokens, lambda t: F.when(F.size(t) > 0, _entries(t)).otherwise(whole))
    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast(_NONE)).otherwise(found)


def packed(entries: Column) -> Column:
    """array<long>: hash over the distance to the entry before."""
    step = lambda e, i, x: x["pos"] - F.when(i == 0, 0).otherwise(F.get(e, i - 1)["pos"])
    return let(entries, lambda e: F.transform(e, lambda x, i: x["hash"].bitwiseOR(step(e, i, x).cast("long"))))


def printed(values: Column) -> Column:
    """A fingerprint as text: 16 hexadecimal digits for each entry."""
    return F.array_join(F.transform(values, lambda v: F.lpad(F.hex(v), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two fingerprints' hashes."""
    hashes = lambda x: F.array_distinct(F.transform(x, lambda v: v.bitwiseAND(F.lit(~_PLACE))))

    def of(x: Column, y: Column) -> Column:
        common = F.size(F.array_intersect(x, y))
        return F.when((F.size(x) == 0) & (F.size(y) == 0), 1.0).when(common == 0, 0.0).otherwise(common / (F.size(x) + F.size(y) - common))

    return let(hashes(a), lambda x: let(hashes(b), lambda y: of(x, y)))


def winnowed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, hash, pos): the chosen grams of every row."""
    return id_text(docs, id_col, text_col).select("doc_id", F.inline(chosen(F.col("text"))))


def _at_most(cuts: list[float], key: Column) -> Column:
    """How many of the sorted ``cuts`` are at most ``key``, by bisection."""
    bits = len(cuts).bit_length()
    padded = cuts + [float("inf")] * ((1 << bits) - 1 - len(cuts))
    listed = F.expr(f"array({','.join(f"double('{c!r}')" for c in padded)})")
    steps = F.expr(f"array({','.join(str(1 << b) for b in range(bits - 1, -1, -1))})")
    return F.aggregate(steps, F.lit(0), lambda low, s: F.when(F.element_at(listed, low + s) <= key, low + s).otherwise(low)) if bits else F.lit(0)


def next_documents(rows: DataFrame, derived: dict[str, Column]) -> DataFrame:
    """``rows`` (doc_id, text) with ``derived`` columns, and struct ``next`` of
    text and derived columns of the row that follows by id.

    Derived columns are computed after the shuffle, which carries texts only.
    The driver holds one first id and one cut for each bucket; there are four
    buckets for each shuffle partition, whatever the input.
    """
    tie = F.xxhash64("text")
    # Not decreasing in (id, tie), so buckets are ranges of that order; a repeated
    # id with many texts is cut too.
    key = F.coalesce(F.col("doc_id").cast("double") + (tie / F.lit(2.0**64) + 0.5), F.lit(float("-inf")))
    keyed = rows.withColumn("tie", tie).withColumn("key", key)
    n = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    share = F.expr(f"array({','.join(f'{i / n}D' for i in range(1, n))})")
    cuts = keyed.agg(F.percentile_approx("key", share, 20 * n)).first()[0]
    keyed = keyed.withColumn("bucket", _at_most(sorted(cuts or []), F.col("key"))).drop("key")
    heads = keyed.groupBy("bucket").agg(F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "tie")).alias("head")).collect()
    heads = sorted((r["bucket"], r["head"]["doc_id"], r["head"]["tie"]) for r in heads)
    before = {b: heads[i - 1][0] for i, (b, _, _) in enumerate(heads)}
    first = {b: (i, t) for b, i, t in heads}
    spell = lambda f, kind: F.expr(f"CAST(array({','.join('NULL' if (v := f(b)) is None else str(v) for b in range(n))}) AS array<{kind}>)")
    at = F.col("bucket") + 1
    own = lambda k: F.element_at(spell(lambda b: first.get(b, (None, None))[k], "decimal(20,0)"), at).cast("long")
    is_head = F.col("doc_id").eqNullSafe(own(0)) & F.col("tie").eqNullSafe(own(1))
    previous = F.element_at(spell(before.get, "int"), at)
    place = lambda bucket, guest: F.struct(bucket.alias("bucket"), F.lit(guest).alias("guest"))
    home = place(F.col("bucket"), 0)
    places = F.when(is_head, F.array(home, place(previous, 1))).otherwise(F.array(home))
    placed = keyed.withColumn("places", places).select(*rows.columns, "tie", F.inline("places"))
    order = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").asc_nulls_first(), "tie", "text")
    dealt = placed.repartition("bucket").withColumns(derived)
    named = dealt.withColumn("next", F.lead(F.struct("text", *derived)).over(order))
    return named.where("guest = 0").select(*rows.columns, *derived, "next")


def compared_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited form (its second half is the
    beginning of the next document), and how alike they are."""
    rows = id_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    rows = next_documents(rows, {"own": packed(chosen(F.col("text")))})
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.col("next.text"), F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), "own", F.col("next.own").alias("next"), edited.alias("edited"))
    rows = rows.withColumn("changed", packed(chosen(F.col("edited"))))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        printed(F.col("own")).alias("fingerprint"),
        printed(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
    )


def op12_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compared_with_next(table(spark, sf_dir, "documents"))

"""Secret scan, quality rules, resampling and the pipeline."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import string
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_tables import documents, empty_tables, tables  # noqa: F401 - fixtures
from stratiform.llm import divergence, packing, queries, resampling, secrets
from stratiform.llm.common import table
from test_copies import jaccard_classes, removed

QUERIES = queries.queries()
SF_ORACLE = "/root/testdata/sf0.01"
BLANK = re.compile(r"[\x20\x09-\x0D]+")
PATTERNS = (
    re.compile(r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))"""),
    re.compile(r"AKIA[A-Z0-9]+"),
    re.compile(r"[0-9a-f]+"),
)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    fits = (lambda m: len(m[2]) >= 6, lambda m: len(m[0]) >= 20, lambda m: len(m[0]) >= 24)
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in p.finditer(text) if fits[k](m))


def test_op1(spark, tables, documents):
    got = QUERIES["op1_secret_scan"](spark, tables).collect()
    want = Counter()
    for r in documents:
        spans = base_spans(r[1] or "")
        joined = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        want[r[0], *(sum(k == i for _, k, _ in spans) for i in range(3)), hashlib.sha256(joined.encode()).hexdigest()] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    for r in got:
        base = [s for s in r.spans.split(",") if s and not s.startswith("random")]
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == r.base_sha256


def test_battery_tells_random_from_prose():
    rng = random.Random(8)
    for letters in ("0123456789abcdef", string.ascii_letters + string.digits, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"):
        found = [secrets.score("".join(rng.choice(letters) for _ in range(48))) for _ in range(200)]
        assert np.mean(np.array(found) > -2) > 0.95
    prose = "itwastheseasonofthelongrainsandallthattimethehousestoodemptyonthehillsidenearthesea"
    assert secrets.score("a" * 40) < -6 and secrets.score("ab" * 24) < -4
    assert secrets.score(prose) < -2 and secrets.score(prose, 7) < -8


def test_false_discovery_control_accepts_random_runs_only(spark):
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("etaoinshrdlu" * 2 + "cmfwyp") for _ in range(n))
    clean = [" ".join(word(rng.randint(2, 8)) for _ in range(130)) for _ in range(3000)]
    key = lambda: "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(52))
    planted = {i: key() for i in range(0, 3000, 10)}
    texts = [(i, f"{t} {planted[i]}" if i in planted else t + " " + word(52)) for i, t in enumerate(clean)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found, least = secrets.scan(docs)
    hits = {r.doc_id for r in found.where("size(spans) > 0").collect()}
    assert len(hits & planted.keys()) > 0.9 * len(planted)
    assert len(hits - planted.keys()) <= 0.03 * len(hits)
    clean_text = {r.doc_id: r.text for r in secrets.redact(docs, least).collect()}
    assert all(planted[i] not in clean_text[i] for i in hits & planted.keys())


@pytest.mark.parametrize("words", ["дом река город время человек слово ветер", "今天 天气 很好 我们 去 学校", "house river town time people word wind"])
def test_random_spans_need_neither_size_nor_script(spark, words):
    rng = random.Random(5)
    key = lambda: "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(64))
    planted = {i: key() for i in range(0, 60, 3)}
    name = lambda: "_".join(rng.choice("internal network controller session manager request handler default timeout".split()) for _ in range(9))
    prose = lambda: " ".join(rng.choice(words.split(" ")) for _ in range(60))
    docs = spark.createDataFrame([(i, f"{prose()} {planted.get(i) or name()} {prose()}") for i in range(60)], "doc_id long, text string")
    found, least = secrets.scan(docs)
    hits = {r.doc_id for r in found.where("size(spans) > 0").collect()}
    assert len(hits & planted.keys()) >= 0.9 * len(planted) and not hits - planted.keys()
    clean = {r.doc_id: r.text for r in secrets.redact(docs, least).collect()}
    assert all(planted[i] not in clean[i] for i in hits)


def test_equal_runs_count_once(spark):
    rng = random.Random(6)
    key = "".join(rng.choice(string.ascii_letters + string.digits) for _ in range(64))
    same = "internal_network_controller_session_manager_request_handler_default"
    docs = spark.createDataFrame([(i, f"{same if i else key} end") for i in range(500)], "doc_id long, text string")
    assert [r.doc_id for r in secrets.scan(docs)[0].where("size(spans) > 0").collect()] == [0]


def test_scores_of_many_runs_equal_the_battery():
    rng = random.Random(7)
    for encoding, (_, letters) in enumerate(secrets.ENCODINGS):
        runs = [secrets.typed(rng, encoding, form, 40) for form in (0, 1, 2)] + ["".join(rng.choices(letters, k=40)), letters[0] * 40]
        at = np.array([[letters.index(c) for c in run] for run in runs])
        assert np.allclose(secrets.scores(at, encoding), [secrets.score(run, encoding) for run in runs])


def base_counts(text: str) -> tuple:
    words = [w for w in BLANK.split(text) if w]
    lines = [x for x in text.split("\n") if BLANK.sub("", x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit), failed


def test_op6(spark, tables, documents):
    got = QUERIES["op6_divergence"](spark, tables).collect()
    assert Counter(tuple(r)[:7] for r in got) == Counter((r[0], *base_counts(r[1] or "")) for r in documents)
    assert not any(r.kept for r in got if r.base_failed)


def test_op6_native():
    import inspect

    source = inspect.getsource(divergence)
    assert not re.search(r"udf|mapIn|applyIn|\.rdd|pandas", source)


@pytest.mark.parametrize("threshold", ["10m", "-1"])  # broadcast; shuffled by language
def test_op6_judges_every_language(spark, threshold):
    rng = random.Random(12)
    langs = [f"x-{i:03d}" for i in range(300)]
    texts = [(lang, " ".join("".join(rng.choice("aeinorst") for _ in range(rng.randint(1, 6))) for _ in range(90))) for lang in langs for _ in range(6)]
    odd = [(lang, " ".join(f"{rng.randint(10**6, 10**7)}#" for _ in range(90))) for lang in langs]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(texts + odd)], "doc_id long, lang string, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = {r.doc_id: r for r in divergence.judged(docs).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(got) == 7 * len(langs) and not any(r.base_failed for r in got.values())
    assert all(r.class_distance is not None and r.word_distance is not None for r in got.values())
    assert all(r.kept == (i < len(texts)) for i, r in got.items())


def test_op6_common_words_of_any_length(spark):
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("aeinorst") for _ in range(rng.randint(7, 12)))
    usual = [word() for _ in range(30)]
    texts = [" ".join(rng.choice(usual) for _ in range(400)) for _ in range(40)] + [" ".join(word() for _ in range(400)) for _ in range(3)]
    docs = spark.createDataFrame([(i, t, "zz") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    counts = Counter(w for t in texts for w in t.split(" "))
    want = sorted(sorted(counts, key=lambda w: (-counts[w], w))[: divergence.COMMON])
    assert divergence.common_words(docs).first()["common"] == want
    assert {r.doc_id for r in divergence.judged(docs).where("NOT kept").collect()} == {40, 41, 42}


def test_distance_is_jensen_shannon(spark):
    from pyspark.sql import functions as F

    p, q = [0.5, 0.5, 0.0], [0.1, 0.6, 0.3]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    kl = lambda x: sum(a * math.log2(a / c) for a, c in zip(x, m) if a)
    row = spark.createDataFrame([(p, q)], "p array<double>, q array<double>").select(divergence.distance(F.col("p"), F.col("q"))).first()
    assert abs(row[0] - math.sqrt((kl(p) + kl(q)) / 2)) < 1e-12


def test_quality_verdicts_follow_labels(spark):
    labels = {r.doc_id: r for r in table(spark, SF_ORACLE, "labels").collect()}
    rules = {r.doc_id: r for r in QUERIES["op6_divergence"](spark, SF_ORACLE).collect()}
    good = [i for i, r in labels.items() if r.quality == 1 and not rules[i].base_failed]
    bad = [i for i, r in labels.items() if r.quality == 0]
    assert all(rules[i].kept for i in good)
    assert sum(not rules[i].kept for i in bad) > 0.8 * len(bad)
    drawn = {r.doc_id: r.kept for r in QUERIES["op10_importance_resampling"](spark, SF_ORACLE).collect()}
    sample = resampling.labelled_sample(table(spark, SF_ORACLE, "labels"))
    held = [i for i, (_, out) in sample.items() if out]  # not seen by the models
    assert sum(drawn[i] for i in held if labels[i].quality == 1) >= 0.99 * sum(labels[i].quality == 1 for i in held)
    assert sum(not drawn[i] for i in held if labels[i].quality == 0) > 0.7 * sum(labels[i].quality == 0 for i in held)


def test_op10_model_and_weights(spark, tables, documents):
    """Models, ratios and weights anew, n-gram by n-gram from tiny texts."""
    made = resampling.resample(table(spark, tables, "documents"), table(spark, tables, "labels"))
    sample = resampling.labelled_sample(table(spark, tables, "labels"))
    known = {}

    def word_grams(text):
        found = [w for w in BLANK.split("".join(c.lower() if c.isascii() else c for c in text)) if w]
        keys = [(w,) for w in found] + list(zip(found, found[1:]))
        for key in set(keys) - known.keys():
            known[key] = int(next(resampling.ngram_buckets(pa.array([" ".join(key)]), resampling.BUCKETS))[3][-1])
        return [known[key] for key in keys]

    def letter_grams(text):
        data = "".join(c.lower() if c.isascii() else c for c in text).encode()
        keys = [data[i : i + resampling.WIDTH] for i in range(len(data) - resampling.WIDTH + 1)]
        for key in set(keys) - known.keys():
            known[key] = int(next(resampling.letter_grams(pa.array([key])))[1][0])
        return [known[key] for key in keys]

    raw, target = (Counter(), Counter()), (Counter(), Counter())
    grams = {}
    for i, text, *_ in documents:
        grams[text] = grams.get(text) or (word_grams(text or ""), letter_grams(text or ""))
        for side in range(2):
            raw[side].update(grams[text][side])
            if i in sample and sample[i] == (True, False):
                target[side].update(grams[text][side])
    sizes = [c.total() + resampling.BUCKETS for c in (target[0], raw[0])]
    word = lambda g: math.log((target[0][g] + 1) / sizes[0]) - math.log((raw[0][g] + 1) / sizes[1])
    share, a = target[1].total() / raw[1].total(), resampling.LETTER_PRIOR
    letter = lambda g: math.log((target[1][g] + a) / (raw[1][g] * share + a))
    rows = {r.doc_id: r for r in made.scored.collect()}
    for i, text, *_ in documents:
        words, letters = grams[text]
        mean = sum(map(word, words)) / (len(words) + resampling.PRIOR)
        least = min([0.0, *[sum(map(letter, letters[j : j + resampling.PASSAGE])) / resampling.PASSAGE for j in range(len(letters))]])
        assert abs(rows[i].mean - mean) < 1e-9 and abs(rows[i].passage - least) < 1e-9
        assert abs(rows[i].weight - made.sharpness * min(mean, least - made.shift)) < 1e-6


def test_op10_draws_follow_top_k(spark):
    """Over many seeds the share of draws of each row is that of sampling k
    rows without replacement by weight."""
    weights, k, seeds = [0.0, 0.5, 1.0, 1.5, -1.0], 2, 20_000
    odds = [math.exp(w) for w in weights]
    want = [0.0] * len(odds)
    for order in itertools.permutations(range(len(odds)), k):
        p, left = 1.0, sum(odds)
        for i in order:
            p, left = p * odds[i] / left, left - odds[i]
        for i in order:
            want[i] += p
    rows = spark.createDataFrame(list(enumerate(weights)), "doc_id long, weight double")
    keyed = rows.crossJoin(spark.range(seeds).withColumnRenamed("id", "seed")).withColumn("key", F.col("weight") + resampling.gumbel(F.col("doc_id"), F.col("seed")))
    drawn = keyed.groupBy("seed").agg(F.sort_array(F.collect_list(F.struct("key", "doc_id")), asc=False).alias("rows"))
    got = {r.doc_id: r.n for r in drawn.select(F.explode(F.slice("rows", 1, k))).select("col.doc_id").groupBy("doc_id").agg(F.count("*").alias("n")).collect()}
    for i, p in enumerate(want):
        assert abs(got[i] / seeds - p) < 5 * math.sqrt(p * (1 - p) / seeds)


def test_op10_temperature_and_size(spark, tables, documents):
    docs, labels = table(spark, tables, "documents"), table(spark, tables, "labels")
    sharp = {r.doc_id for r in resampling.sampled(docs, labels, k=20, sharpness=1e9).collect()}
    top = resampling.resample(docs, labels, k=20, sharpness=1e9)
    keys = sorted((r.weight for r in top.scored.collect()), reverse=True)
    assert top.k == 20 and all(r.weight >= keys[19] - 1 for r in top.scored.collect() if r.doc_id in sharp)
    flat = [{r.doc_id for r in resampling.sampled(docs, labels, k=20, sharpness=0.0, seed=s).collect()} for s in (1, 2)]
    assert flat[0] != flat[1] and all(20 <= len(f) + 2 for f in flat)


def test_op10_worst_passage_finds_few_bad_words(spark, scratch_dir):
    """A few bad words in long ordinary documents, in slices of any size."""
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice(string.ascii_lowercase) for _ in range(6)) for _ in range(300)]
    docs, labels = [], []
    for i in range(600):
        words, bad = [rng.choice(vocabulary) for _ in range(400)], i % 6 == 0
        if bad:
            for _ in range(2):
                words[rng.randrange(400)] = rng.choice(["zzqzqz", "qqzqzzq"])
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    kept = {r.doc_id for r in resampling.sampled(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert not any(i % 6 == 0 for i in kept)
    assert len(kept) >= 0.99 * 500


@pytest.mark.parametrize("size", [7, 64, 1000])
def test_op10_slices_do_not_change_passages(monkeypatch, documents, size):
    column = pa.array([t for _, t, *_ in documents[:40]])
    model = resampling.Model(np.zeros(4), np.random.default_rng(1).normal(size=resampling.LETTER_BUCKETS))
    whole = model.passages(column)
    monkeypatch.setattr(resampling, "CHUNK_BYTES", size)
    assert np.array_equal(model.passages(column), whole)


def test_op10_counts_and_top_k(spark, tables, documents):
    made = resampling.resample(table(spark, tables, "documents"), table(spark, tables, "labels"))
    rows = made.scored.collect()
    assert len(rows) == len(documents)
    keys = sorted((r.sample_key for r in rows), reverse=True)
    assert made.k == 0 or made.least_key == keys[min(made.k, len(keys)) - 1]
    kept = QUERIES["op10_importance_resampling"](spark, tables).where("kept").collect()
    assert made.k <= len(kept) <= made.k + 2
    assert all(r.weight == 0 for r in rows if r.doc_id in (0, 1, 2))


@pytest.mark.parametrize("values", [[1.0], [2.0] * 50, [float(i % 97) for i in range(3000)], [-1e9, 0.0, 1e-9, 1e9] * 3])
def test_kth_largest(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    for k in {1, 2, len(values) // 2 or 1, len(values)}:
        if k <= len(values):
            assert resampling.kth_largest(rows, "x", k) == sorted(values, reverse=True)[k - 1]


@pytest.mark.parametrize("name", ["op1_secret_scan", "op6_divergence", "op10_importance_resampling", "pipeline"])
def test_empty_table(spark, empty_tables, name):
    query = queries.on_workers(corpus_pipeline.run) if name == "pipeline" else QUERIES[name]
    assert query(spark, empty_tables).count() == 0


def test_pipeline_stages(spark, tables, scratch_dir):
    """Each stage against a plain version on what the stage before kept."""
    import public_tokenizers

    docs = table(spark, tables, "documents")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = sorted(docs.collect(), key=lambda r: (r[0] is None, r[0] or 0))
        stage(spark, docs, tables).write.parquet(f"{scratch_dir}/{name}")
        docs = spark.read.parquet(f"{scratch_dir}/{name}")
        after = docs.collect()
        kept[name] = after
        texts = [r["text"] for r in before] if "text" in before[0] else []
        if name != "packing":
            assert docs.columns == columns
        if name == "quality_classifier":
            gone = {r.doc_id for r in before} - {r.doc_id for r in after}
            assert all("$$$" in (r["text"] or "") for r in before if r.doc_id in gone)
        elif name == "near_duplicates":
            label = jaccard_classes(texts)
            assert Counter(r["text"] for r in after) == Counter(before[min(i for i, c in enumerate(label) if c == own)]["text"] for own in set(label))
        elif name == "repeated_passages":
            masks = removed([r["text"] for r in sorted(before, key=lambda r: (r[0] is not None, r[0] or 0))])
            want = Counter()
            for r, mask in zip(sorted(before, key=lambda r: (r[0] is not None, r[0] or 0)), masks):
                data = (r["text"] or "").encode()
                want[r["text"] if not any(mask) else bytes(c for c, m in zip(data, mask) if not m).decode("utf-8", "ignore")] += 1
            assert Counter(r["text"] for r in after) == want
        elif name == "secret_scan":
            assert len(after) == len(before) and not any(base_spans(r["text"] or "") for r in after)
            assert Counter(t for t in texts if not base_spans(t or "")) <= Counter(r["text"] for r in after)
        else:
            own = packing.tokenizer(public_tokenizers.path("word_bpe_49k.json"))
            assert sum(r.length for r in after) == sum(len(own.encode(t or "")) // 4 + 1 for t in texts)
            assert all(r.n_chars == len(r["text"]) for r in kept["secret_scan"] if r["text"] is not None)

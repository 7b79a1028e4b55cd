import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import tablewright.llm.queries as q
from tablewright.llm import language, quality, toxicity

FOLDER = "/root/testdata/sf0.01"
ODD = [(None, None), (1, None), (2, ""), (3, " "), (4, "1234 !?"), (5, "a"), (6, "日本"), (7, "word " * 30_000), (7, "word " * 30_000), (8, "…")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(d, t, None, 5, "x") for d, t in ODD], "doc_id long, text string, lang string, score int, id string")


def held_out(doc_id, divisor, remainder):
    return zlib.crc32(str(doc_id).encode()) % divisor == remainder


def test_languages_of_held_out_documents(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = q.QUERIES["op5_language"](spark, FOLDER).collect()
    assert len(rows) == len(truth) and all(r.held_out == held_out(r.doc_id, 4, 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)


def test_language_edges(spark, odd):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    filters = language.fit(documents)
    found = [(r.doc_id, r.lang_pred) for r in language.detect(odd, filters).collect()]
    assert len(found) == len(ODD)
    preds = dict(found)
    assert all(preds[i] == "und" for i in (None, 1, 2, 3, 4, 8)) and preds[5] in filters.languages and preds[7] in filters.languages
    nothing = language.fit(odd)
    assert {r.lang_pred for r in language.detect(odd, nothing).collect()} == {"und"}
    assert language.detect(odd.where("false"), filters).count() == 0


def plain_language(training, texts, spec):
    """Predictions without Bloom filters: sets of n-grams per language, by the same rule; ties go to the commonest language."""

    def grams(text):
        own = "".join(c.lower() if c.isascii() and c.isalpha() else c if not c.isascii() else " " for c in text).encode()
        own = b" ".join(own.split())
        padded = b" " + own + b" "
        return [padded[i : i + 4] for i in range(len(padded) - 3)]

    counts = {}
    for text, lang in training:
        for g in grams(text):
            counts.setdefault(lang, {})[g] = counts.get(lang, {}).get(g, 0) + 1
    totals = {k: sum(c.values()) for k, c in counts.items()}
    top = {}
    for k, c in counts.items():
        for g, n in c.items():
            if n >= spec.least:
                top[g] = max(top.get(g, 0), n / totals[k])
    held = {k: {g for g, n in c.items() if n >= spec.least and n / totals[k] >= spec.share * top[g]} for k, c in counts.items()}
    shares = [{k: sum(g in own for g in grams(t)) / max(len(grams(t)), 1) for k, own in held.items()} for t in texts]
    return shares


def test_more_than_64_languages(spark):
    """Each of 150 made-up languages has its own letters; filters of three numbers a slot keep them apart, as plain sets do."""
    names = [f"l{i:03d}" for i in range(150)]

    def words(i, salt):
        return " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + (i * 7) % 26)}{'xyzw'[(salt + k) % 4]}{chr(97 + i % 26)}" for k in range(12))

    training = [(words(i, s), k) for i, k in enumerate(names) for s in range(3)]
    rows = [(n, t, k) for n, (t, k) in enumerate(training)]
    filters = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(filters.languages) == 150 and filters.masks.shape[0] == 3
    asked = spark.createDataFrame([(i, words(i, 5)) for i in range(150)], "doc_id long, text string")
    found = {r.doc_id: r.lang_pred for r in language.detect(asked, filters).collect()}
    shares = plain_language(training, [words(i, 5) for i in range(150)], filters)
    for i, own in enumerate(shares):
        best = max(own.values())
        assert own[found[i]] >= best - 0.02 and found[i] == names[i]


@pytest.mark.parametrize("name, label, least", [("op8_quality", "quality", 0.97), ("op10_toxicity", "toxic", 0.9)])
def test_scores_of_held_out_documents(spark, name, label, least):
    truth = {r.doc_id: r[label] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = q.QUERIES[name](spark, FOLDER).collect()
    assert len(rows) == 1000 and all(r.held_out == held_out(r.doc_id, 3, 1) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= least * len(held)


@pytest.mark.parametrize("kind", [quality, toxicity])
def test_classifier_edges(spark, odd, kind):
    labelled = spark.createDataFrame([(i, f"good plain words number {i}" if i % 2 else f"BAD!! ***rubbish {i}***", i % 2) for i in range(60)] + [(None, "x", 1), (99, None, 1), (98, "y", None), (97, "z", 7)], "doc_id long, text string, label int")
    model = kind.fit(labelled)
    scores = kind.score(odd, model).collect()
    assert len(scores) == len(ODD) and all(0 <= r.score <= 1 for r in scores)
    assert kind.score(odd.where("false"), model).count() == 0
    both = kind.score(labelled.where("doc_id < 60"), model).collect()
    assert all((r.score > 0.5) == bool(r.label) for r in both)
    empty = kind.fit(labelled.where("false"))
    assert {round(r.score, 3) for r in kind.score(odd, empty).collect()} == {0.5}


def plain_toxicity(rows, texts, sizes, smooth, penalty, steps, least):
    """Scores of ``texts`` by a dense version of the classifier, fitted on rows (text, label)."""

    def grams(text):
        own = "".join(" " if c.isspace() or c.isascii() and not c.isalpha() and c != "'" else c.lower() if len(c.lower()) == 1 else c for c in text or "")
        return {own[i : i + n] for n in sizes for i in range(len(own) - n + 1)}

    y = np.array([label for _, label in rows], float)
    held = [grams(t) for t, _ in rows]
    pos, neg = y.sum(), len(y) - y.sum()
    names = sorted({g for h in held for g in h})
    p = np.array([sum(g in h for h, k in zip(held, y) if k) for g in names])
    n = np.array([sum(g in h for h, k in zip(held, y) if not k) for g in names])
    common = p + n >= least
    names = [g for g, c in zip(names, common) if c]
    ratio = np.log((p + smooth) / (pos + 2 * smooth) / ((n + smooth) / (neg + 2 * smooth)))[common]
    x = np.array([[g in h for g in names] for h in held]) * ratio
    w, b = np.zeros(len(names)), np.log(pos / neg)
    m, v, mb, vb = np.zeros(len(names)), np.zeros(len(names)), 0.0, 0.0
    for step in range(1, steps + 1):
        error = (1 / (1 + np.exp(-(x @ w + b))) - y) / len(y)
        g, gb = x.T @ error + penalty * w, error.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        w = w - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        b = b - 0.05 * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.999**step)) + 1e-8)
    z = np.array([[g in grams(t) for g in names] for t in texts]) * ratio @ w + b
    return 1 / (1 + np.exp(-z))


def test_toxicity_like_a_plain_version(spark):
    rows = [(f"gentle été words {i} 日本", 0) if i % 3 else (f"Vile!! RUBBISH{i} naïve été Ünder", 1) for i in range(30)]
    texts = ["", "gentle rubbish", "VILE***", "日本 Ü naïve", "x" * 5000 + " vile", "gentle rubbish"]
    spec = toxicity.Toxicity(sizes=(2, 3, 4), features=100_000, steps=40)
    labelled = spark.createDataFrame([(i, t, k) for i, (t, k) in enumerate(rows)], "doc_id long, text string, label int").repartition(3)
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.score for r in toxicity.score(asked, toxicity.fit(labelled, spec)).collect()}
    expected = plain_toxicity(rows, texts, spec.sizes, spec.smooth, spec.penalty, spec.steps, spec.least)
    assert [found[i] for i in range(len(texts))] == pytest.approx(expected.tolist(), abs=1e-6)


def test_stages_take_odd_rows(spark, odd):
    docs = odd.select("doc_id", "text", "lang", F.lit("s").alias("source"), F.length("text").cast("long").alias("n_chars"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for rows in (docs, docs.where("false")):
            assert stage(spark, rows, FOLDER).columns == corpus_pipeline.COLUMNS
            stage(spark, rows, FOLDER).count()
    assert {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER).collect()} == {None, 1, 2, 3, 4, 5, 6, 7, 8}
    assert corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER).count() == 9


def test_pipeline_packs_what_the_stages_keep(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, FOLDER).toPandas(), docs.schema)
        after = {r.doc_id for r in docs.collect()}
        assert before is None or after <= before
        before = after
    packed = corpus_pipeline.pack_sequences(spark, docs, FOLDER)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == before


def test_stages_decide_by_row_also_without_ids_or_with_repeated_ones(spark):
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").first().text
    body = " ".join(f"word{i} plain{i * 7}" for i in range(60))
    rows = [(5, body), (None, body + " tail"), (5, "another text under the same id " * 5), (3, body), (None, "short"), (None, f"before {item} after"), (7, f"{item}"), (7, "clean row of the same id")]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER).collect()
    assert sorted(r.text[:9] for r in kept) == sorted([body[:9], "another t", "short", item[:9], "clean row"])  # of the two with the item, that with an id
    assert [r.doc_id for r in kept if r.text == body] == [3]
    left = {(r.doc_id, r.text[:9]) for r in corpus_pipeline.drop_leaks(spark, docs, FOLDER).collect()}
    assert left == {(d, t[:9]) for d, t in rows if item not in t}

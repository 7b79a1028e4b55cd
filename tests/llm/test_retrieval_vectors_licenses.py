import random

import brute
import numpy as np
import pytest

import tablewright.llm.queries as q
from tablewright.llm import licenses
from tablewright.llm.decontaminate import Decontamination, _subsequence, leaks
from tablewright.llm.forest import Forest, near_vectors

FOLDER = "/root/testdata/sf0.001"


def test_subsequence_has_the_greatest_length_and_keeps_order():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(1, 14))] for _ in range(2))
        used = [x for x, u in zip(a, _subsequence(a, b)) if u]
        assert len(used) == brute.common_subsequence(a, b)
        rest = iter(b)
        assert all(x in rest for x in used)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    # Common words, and rare ones that are hardly ever repeated.
    word = lambda: f"c{rng.randrange(20)}" if rng.random() < 0.4 else f"r{rng.randrange(10**7)}"
    items = [" ".join(word() for _ in range(rng.randrange(15, 50))) + ". " + " ".join(word() for _ in range(8)) for _ in range(12)]
    docs = [" ".join(word() for _ in range(rng.randrange(1, 400))) for _ in range(300)]
    planted = set()
    for i, item in enumerate(items):
        words = item.split()
        paraphrase = [w if k % 6 else word() for k, w in enumerate(words)]
        for d, text in ((3 * i, item.upper()), (3 * i + 1, " ".join(paraphrase))):
            at = rng.randrange(len(docs[d]))
            docs[d] = docs[d][:at] + " " + text + " " + docs[d][at:]
            planted.add((d, i))
    return list(enumerate(items)), list(enumerate(docs)), planted


def test_planted_passages_and_paraphrases_are_found_and_no_others(spark, corpus):
    items, docs, planted = corpus
    rows = docs + [(5000, None), (5001, ""), (None, items[0][1]), (1, docs[1][1])]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, item_id int, cosine string")
    bench = spark.createDataFrame(items + [(100, None), (101, ""), (102, "too short"), (None, "no id " * 9)], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in leaks(df, bench, Decontamination(rank=16)).collect()}
    assert set(found) == planted
    assert all(r.common == 1 for k, r in found.items() if k[0] % 3 == 0)
    assert leaks(df.where("false"), bench).count() == 0
    assert leaks(df, bench.where("false")).count() == 0
    assert leaks(df, bench.where("item_id = 102")).count() == 0


def test_a_passage_without_the_answer_is_no_leak(spark, corpus):
    items, docs, _ = corpus
    question = items[0][1].split(". ")[0]
    df = spark.createDataFrame([(1, docs[200][1] + " " + question), (2, docs[201][1] + " " + items[0][1])] + [(10 + i, t) for i, t in docs[202:240]], "doc_id long, text string")
    found = leaks(df, spark.createDataFrame(items[:1], "item_id long, text string"), Decontamination(common=0.3))
    assert [(r.doc_id, r.item_id) for r in found.collect()] == [(2, 0)]


@pytest.mark.parametrize("n_other", [200, 300_000])
def test_short_items_and_paraphrases_at_every_offset_whatever_the_corpus(spark, n_other):
    rng = random.Random(6)
    items = [[f"c{rng.randrange(20)}" if k % 2 else f"i{n}x{k}" for k in range(n)] for n in (15, 18, 24, 30)]
    docs, planted = [], set()
    for i, item in enumerate(items):
        for text in (item, [w if k % 4 else f"p{k}" for k, w in enumerate(item, 1)]):
            for offset in range(16):
                planted.add((len(docs), i))
                docs.append((len(docs), " ".join([*(f"u{k}" for k in range(offset)), *text, *(f"v{k}" for k in range(50))])))
    other = spark.range(n_other).selectExpr("id + 10000 AS doc_id", "concat('c', id % 20, ' w', id) AS text")
    df = spark.createDataFrame(docs, "doc_id long, text string").union(other)
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in leaks(df, bench).collect()} == planted


def test_items_of_any_length_are_found(spark):
    items = {0: 1, 1: 3, 2: 161, 3: 400, 4: 960, 5: 3000, 6: 5}
    items = {i: [f"i{i}x{k}" if k % 2 or n < 9 else f"c{k % 14}" for k in range(n)] for i, n in items.items()}
    docs, planted, copies = [], set(), set()
    for i, item in items.items():
        for offset in (0, 7, 13, 500):
            before, after = ([f"i{(i + 3) % 7}x{k % 3 + 4}" for k in range(n)] for n in (offset, 60))
            for text in (item, [w if k % 5 else f"p{k}" for k, w in enumerate(item, 1)]):
                if text == item or len(item) > 5:
                    planted.add((len(docs), i))
                    copies |= {(len(docs), i)} if text == item else set()
                docs.append((len(docs), " ".join([*before, *text, *after])))
    docs += [(1000, " ".join(items[4])), (1001, "i1x0 i1x1 and i1x2"), (1002, "i1x0 i1x1"), (1003, "i1x2 other")]
    planted.add((1000, 4))
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in items.items()], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.common for r in leaks(df, bench).collect()}
    assert set(found) == planted and all(found[k] == 1 for k in copies)


def test_leaks_of_the_smallest_tables(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    whole = {(d.doc_id, i.item_id) for d in docs for i in items if i.text in d.text}
    assert {(r.doc_id, r.item_id) for r in q.QUERIES["op1_decontamination"](spark, FOLDER).collect()} >= whole


def vectors_frame(spark, rows):
    return spark.createDataFrame([(i, v, k, "x", 1) for i, v, k in rows], "vec_id long, embedding array<float>, label int, key string, members int")


def test_vectors_like_brute_force(spark):
    rng = np.random.default_rng(3)
    rows, n = [], 0
    for k in range(60):
        base = rng.standard_normal(24)
        for _ in range(1 + k % 7):
            v = np.float32(base + rng.standard_normal(24) * 0.15 * (k % 4)).tolist()
            rows.append((n, v, k % 3))
            n += 1
    one = rows[0][1]
    odd = [None, [], [0.0] * 24, [float("nan")] + one[1:], [float("inf")] + one[1:], [None] + one[1:]]
    rows += [(n + i, v, 0) for i, v in enumerate(odd)] + [(n + 20, one, None), (n + 21, one, 0), (n + 22, [x * 4 for x in one], 0)]
    expected = brute.near_vectors(rows, 0.93)
    found = near_vectors(vectors_frame(spark, rows + [(None, one, 0)]), Forest(leaf=8, tile=4))
    got = {r.vec_id: (r.n_links, r.component_id) for r in found.where("vec_id IS NOT NULL").collect()}
    assert got == expected
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.where("vec_id IS NOT NULL").collect())
    assert near_vectors(vectors_frame(spark, [])).count() == 0
    assert near_vectors(vectors_frame(spark, rows[-9:-3])).where("n_links > 0").count() == 0


def test_license_scan_like_brute_force(spark):
    grant = licenses.TEMPLATES and next(t for n, t in licenses.TEMPLATES.items() if n == "mit-grant")
    texts = [
        None, "", "The MIT License", "the mit\nlicense the-MIT_license!", "cc by nc by nc", "apache license version 2 apache license, version 2.0", "thé mit license the mit",
        "x " * 50 + grant.upper() + " y", " ".join(grant.split()[:25]) + " some other words " + " ".join(grant.split()[25:]), " ".join(grant.split()[:9]),
        "the mit license " * 2000, "the" * 5000 + " mit license", "in the and of", "to any person obtaining to any person obtaining",
    ]
    rows = [(i, t) for i, t in enumerate(texts)] + [(2, texts[2]), (None, texts[2])]
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, places string, n_words int")
    scanned = licenses.scan(df)
    for r in scanned.collect():
        n, places = brute.license_places(texts[r.doc_id if r.doc_id is not None else 2], licenses.PHRASES.items())
        assert (r.n_words, sorted((p.start, p.label) for p in r.places)) == (n, places)
    by_id = {r.doc_id: r for r in licenses.digest(scanned).collect()}
    assert by_id[7].labels == "mit-grant" and by_id[7].score == 1.0 and by_id[8].labels == "mit-grant" and by_id[9].labels == ""
    assert by_id[3].n_base == 2 and (by_id[3].first_word, by_id[3].last_word, by_id[3].base_labels) == (0, 3, "mit")
    assert by_id[0].first_word is None and by_id[0].score == 0 and licenses.scan(df.where("false")).count() == 0
    spans = next(r for r in scanned.collect() if r.doc_id == 8).spans
    assert spans[0].start == 0 and spans[0].end == len(grant.split()) + 3


def test_a_template_inside_a_longer_one_has_its_own_matches(spark):
    line, notice = licenses.TEMPLATES["apache-2-line"], licenses.TEMPLATES["apache-2-notice"]
    texts = ['Licensed under the Apache License, Version 2.0 (the "License")', line + " and others", notice, line, " ".join(notice.split()[:7]), "x " + line + " the license y"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = {r.doc_id: r.labels for r in licenses.digest(licenses.scan(df)).collect()}
    assert labels == {0: "apache-2,apache-2-line", 1: "apache-2,apache-2-line", 2: "apache-2,apache-2-line,apache-2-notice", 3: "apache-2,apache-2-line", 4: "apache-2,apache-2-line", 5: "apache-2,apache-2-line"}


def test_automaton_statistics_like_brute_force():
    rng = random.Random(4)
    for _ in range(60):
        sequences = [[rng.randrange(3) for _ in range(rng.randrange(1, 9))] for _ in range(3)]
        inside = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        automaton = licenses.SuffixAutomaton(sequences)
        stream = [rng.randrange(4) for _ in range(30)]
        for i, (length, state) in enumerate(automaton.statistics(stream)):
            assert length == max(n for n in range(i + 2) if n == 0 or tuple(stream[i + 1 - n : i + 1]) in inside)
            if length:
                own = tuple(stream[i + 1 - length : i + 1])
                assert automaton.places[state] == {(k, p) for k, s in enumerate(sequences) for p in range(len(s)) if tuple(s[max(0, p + 1 - length) : p + 1]) == own}


def test_phrases_of_one_and_two_words(spark):
    phrases = (("mit license", "mit"), ("unlicense", "un"), ("mit license x", "x"))
    text = "MIT license, the unlicense mit license x unlicense"
    df = spark.createDataFrame([(1, text), (2, "mit licenses"), (3, "unlicense")], "doc_id long, text string")
    found = {r.doc_id: sorted((p.label, p.start, p.length) for p in r.places) for r in licenses.scan(df, licenses.LicenseScan(phrases=phrases)).collect()}
    assert found == {1: [("mit", 0, 2), ("mit", 4, 2), ("un", 3, 1), ("un", 7, 1), ("x", 4, 3)], 2: [], 3: [("un", 0, 1)]}


def test_every_copy_of_a_template_has_its_span(spark):
    """All chains, as a plain search over the words says: whole copies, and one with a word in between."""
    line = licenses.TEMPLATES["apache-2-line"]
    words = line.split()
    broken = " ".join([*words[:5], "zzz", *words[5:]])
    texts = [f"{line} {line}", f"x {line} y {line} z " * 3, f"{broken} and {line}", " ".join(words[: len(words) // 3]), ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [(s.start, s.end, round(s.share, 3)) for s in r.spans if s.label == "apache-2-line"] for r in licenses.scan(df).collect()}
    own = brute.license_places(line, ())[0]
    for i, text in enumerate(texts):
        whole = [start for start, _ in brute.license_places(text, [(" ".join(brute_words(line)), "x")])[1]]
        assert [s for s, e, share in found[i] if share == 1.0 and e - s == own] == whole
    assert len(found[1]) == 6 and len(found[2]) == 2 and found[2][0][0] == 0 and found[2][0][1] > 5
    assert found[3] == [] and found[4] == []


def brute_words(text):
    import re

    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.lower(text))


def plain_passages(texts, vocabulary, block):
    """TF-IDF vectors of length one of all blocks of all texts, over the vocabulary; other words only add to the length."""
    import numpy as np

    tokens = [brute_words(t or "") for t in texts]
    n = len(texts)
    idf = np.array([np.log((1 + n) / (1 + sum(w in t for t in tokens))) + 0.1 for w in vocabulary])
    other, place, rows = np.log(1 + n) + 0.1, {w: i for i, w in enumerate(vocabulary)}, []
    for own in tokens:
        for at in range(0, len(own), block):
            row, square = np.zeros(len(vocabulary)), 0.0
            for w in own[at : at + block]:
                square += idf[place[w]] ** 2 if w in place else other**2
                if w in place:
                    row[place[w]] += idf[place[w]]
            rows.append(row / np.sqrt(square))
    return idf, np.array(rows)


def test_latent_space_like_a_plain_decomposition(spark):
    """The projection equals that of numpy's SVD over all passages, at full rank and, nearly, at a small one."""
    import numpy as np
    import pyarrow as pa

    from tablewright.llm import decontaminate as d
    from tablewright.llm import text as tx

    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(30)] + [f"other{i}" for i in range(20)]
    texts = [" ".join(rng.choice(words, size=n)) for n in rng.integers(1, 120, 60)] + ["", "other1", "w3", "w3 w3 w3"]
    items = [" ".join(words[i : i + 10]) for i in (0, 10, 20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    known = d._items(benchmark, Decontamination(), "item_id", "text")
    # The vocabulary is in order of its hashes.
    raw, offsets = tx.buffer(pa.array(words[:30]))
    order = np.argsort(tx.word_hashes(raw, *tx.words(raw, offsets, tx.ALNUM)[:2]))
    idf, passages = plain_passages(texts, [words[i] for i in order], 16)
    rows = d.numbered(docs, known)
    for rank, tolerance in ((30, 1e-6), (12, 0.35)):
        found, space = d.latent_space(rows, known, Decontamination(rank=rank))
        assert np.allclose(found, idf)
        _, values, axes = np.linalg.svd(passages, full_matrices=False)
        plain = axes[:rank].T
        assert space.shape[1] == rank and np.allclose(space.T @ space, np.eye(rank), atol=1e-6)
        # What the passages keep of their length.
        kept, most = np.linalg.norm(passages @ space) ** 2, (values[:rank] ** 2).sum()
        assert most * (1 - tolerance) <= kept <= most * (1 + 1e-9)
        if rank == 30:
            assert np.allclose(space @ space.T, plain @ plain.T, atol=1e-6)

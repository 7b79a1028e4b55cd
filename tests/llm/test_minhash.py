import random

import brute
import numpy as np
import pytest

from tablewright.llm import text as tx
from tablewright.llm.graph import components
from tablewright.llm.minhash import NearDuplicates, near_duplicates, super_minhash
import tablewright.llm.queries as q

SCHEMA = "doc_id long, text string, key string, kept string, component_id string"


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "x", None, "y") for d, t in rows], SCHEMA)


def result(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect() if r.doc_id is not None)


def family(seed, words, copies, changed):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = [base]
    for _ in range(copies):
        own = list(base)
        for i in rng.sample(range(words), changed):
            own[i] = f"x{rng.randrange(10**6)}"
        out.append(own)
    return [" ".join(x) for x in out]


def test_signatures_estimate_similarity_without_bias():
    rng = np.random.default_rng(1)
    errors = []
    for n in (3, 40, 400, 4000):
        for _ in range(10):
            a, b, c = (rng.integers(0, 2**63, n, dtype=np.uint64) for _ in range(3))
            x, y = np.concatenate((a, b)), np.concatenate((a, c))
            s = super_minhash(np.concatenate((x, y)), np.array([0, 2 * n, 4 * n]), 125)
            errors.append((s[0] == s[1]).mean() - 1 / 3)
    assert abs(np.mean(errors)) < 0.02 and max(map(abs, errors)) < 0.2


def test_signature_of_a_set_does_not_depend_on_its_neighbours():
    rng = np.random.default_rng(2)
    sets = [rng.integers(0, 2**63, n, dtype=np.uint64) for n in (1, 0, 7, 2000)]
    bounds = np.concatenate(([0], np.cumsum([len(x) for x in sets])))
    together = super_minhash(np.concatenate(sets), bounds, 25)
    for row, x in zip(together, sets):
        assert (row == super_minhash(x, np.array([0, len(x)]), 25)[0]).all()


def test_like_brute_force(spark):
    texts = family(1, 60, 6, 1) + family(2, 200, 8, 3) + family(3, 30, 3, 2) + family(4, 400, 12, 16)
    texts += ["", "   ", None, "one", "ONE", "a b c", "A\tb\nc", "a b c d", "a b c e"] + [texts[3]] * 5
    rows = list(enumerate(texts))
    random.Random(5).shuffle(rows)
    spec = NearDuplicates(shingle=4, tile=4)
    expected = brute.near_duplicates(rows, 4)
    assert result(near_duplicates(frame(spark, rows), spec)) == sorted((d, n, c, c == d) for d, (n, c) in expected.items())


def test_chain_is_one_group(spark):
    # Neighbours are close, the ends are not, so groups need links that no star around one document gives.
    words = [f"w{i}" for i in range(160)]
    rows = [(i, " ".join(words[8 * i : 8 * i + 100])) for i in range(8)]
    assert {c for _, (_, c) in brute.near_duplicates(rows, 4).items()} == {0}
    assert {r[2] for r in result(near_duplicates(frame(spark, rows), NearDuplicates(shingle=4)))} == {0}


def test_nulls_and_repeated_rows(spark):
    rows = [(None, "p q r s t"), (7, "a b c d e f"), (7, "a b c d e f"), (7, "k l m n o p"), (9, "k l m n o p"), (3, None)]
    found = near_duplicates(frame(spark, rows), NearDuplicates(shingle=4))
    assert result(found) == [(3, 0, 3, True), (7, 3, 7, True), (7, 3, 7, True), (7, 3, 7, True), (9, 3, 7, False)]
    without = found.where("doc_id IS NULL").collect()
    assert len(without) == 1 and without[0].component_id is None and without[0].kept
    assert near_duplicates(frame(spark, []), NearDuplicates()).count() == 0


def test_query_on_the_smallest_tables(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    expected = sorted((d, n, c, c == d) for d, (n, c) in brute.near_duplicates(rows, 4).items())
    assert result(q.QUERIES["op9_minhash"](spark, folder)) == expected


@pytest.mark.parametrize("links", [[(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)] + [(50, 29)], [(5, 4), (4, 5), (3, 3)]])
def test_components(spark, links):
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for p in links if p[0] != p[1] for x in p}
    assert found == {x: min(nodes) for x in nodes}


def test_words_stop_at_text_borders():
    import pyarrow as pa

    raw, offsets = tx.buffer(pa.array(["ab", "cd e", None, "", "É x", "Ab" + "c" * 5000]))
    starts, ends, bounds = tx.words(raw, offsets, tx.NON_SPACE)
    assert [bytes(raw[a:b]).decode()[:3] for a, b in zip(starts, ends)] == ["ab", "cd", "e", "É", "x", "Abc"]
    assert bounds.tolist() == [0, 1, 3, 3, 3, 5, 6]
    h = tx.word_hashes(raw, starts, ends)
    assert len(set(h.tolist())) == 6
    alone = tx.buffer(pa.array(["aB" + "c" * 5000]))
    assert tx.word_hashes(*alone[:1], np.array([0]), np.array([5002]))[0] == h[5]
    few = tx.buffer(pa.array(["ab"]))
    assert tx.word_hashes(*few[:1], np.array([0]), np.array([2]))[0] == h[0]

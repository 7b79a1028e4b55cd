import hashlib
import json
import math

import numpy as np
import pytest

import tablewright.llm.queries as q
from tablewright.llm import bpe, tokenizer, vector_codes
from tablewright.llm.vector_codes import Codes, compress, nearest, with_group_error
from tablewright.llm.whitening import cross_products, whiten

FOLDER = "/root/testdata/sf0.001"
TEXTS = [
    None, "", " ", "\n\t", "Plain words, don't they'll I'm we've 12 cents!", "x" * 9000, "ab " * 30000, "café CAFÉ Straße ΣΑΣ İstanbul", "éä ﬁ ①²½   x",
    "a<|endoftext|>b <|startoftext|><|endoftext|>", "<|endoftext", "日本語 тест العربية 😀👍", "'s't're''!!''s", "\x00\x1c\x85​", "it's--'tis '90s 'VE",
    "ｄｏｎ＇ｔ <|ENDOFTEXT|> é <|endoftext|>s 's",
]


def plain_digests(text):
    whole = tokenizer.load(tokenizer.default_path()).whole
    ids = whole.encode(text or "", add_special_tokens=False).ids
    decoded = whole.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_encoding_and_decoding_equal_the_library(spark):
    rows = [(i, t, b"x", 1, "d") for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], None, None, None), (None, "no id", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids binary, n_tokens int, decoded string")
    whole = tokenizer.load(tokenizer.default_path()).whole
    found = bpe.decode(bpe.encode(docs)).collect()
    assert len(found) == len(rows)
    assert sorted(r.doc_id for r in found if r.doc_id is not None) == sorted(r[0] for r in rows if r[0] is not None)
    for r in found:
        text = ("no id" if r.doc_id is None else TEXTS[r.doc_id]) or ""
        ids = whole.encode(text, add_special_tokens=False).ids
        assert (r.n_tokens, np.frombuffer(r.ids, "<u4").tolist()) == (len(ids), ids)
        assert r.decoded == whole.decode(ids, skip_special_tokens=False)
    assert bpe.decode(bpe.encode(docs.where("false"))).count() == 0


def test_encoding_query_on_the_smallest_tables(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    found = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in q.QUERIES["op12_bpe"](spark, FOLDER).collect()}
    assert found == {d: plain_digests(t) for d, t in texts.items()}


def test_merges_whose_order_isnt_that_of_their_products(tmp_path):
    """Lowest rank first, then leftmost, also where a merge uses the product of a later one."""
    with open(tokenizer.default_path(), encoding="utf-8") as file:
        spec = json.load(file)
    vocab = {c + s: i for i, (c, s) in enumerate((c, s) for s in ("", "</w>") for c in bpe.byte_characters())}
    merges = [("ab", "a"), ("a", "b"), ("ab", "ab"), ("b", "a"), ("aba", "b</w>")]
    for a, b in merges:
        vocab.setdefault(a + b, len(vocab))
    for a in ("ab",):
        vocab.setdefault(a, len(vocab))
    spec["model"].update(vocab=vocab, merges=merges)
    spec["added_tokens"] = []
    path = tmp_path / "small.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    table = bpe.Merges(str(path))
    assert not table.ordered

    def plain(word):
        symbols = [*word[:-1], word[-1] + "</w>"]
        rank = {m: i for i, m in enumerate(merges)}
        while True:
            found = min(((rank[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in rank), default=None)
            if found is None:
                return [vocab[s] for s in symbols]
            i = found[1]
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]

    words = ["abababab", "ababa", "a", "ab", "aabbab", "bababa", "zab"]
    ids, bounds = table.encode(words)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [plain(w) for w in words]


def vector_rows():
    rng = np.random.default_rng(3)
    base = rng.normal(0, 0.4, (60, 5)).tolist()
    rows = [(i, v, i % 3) for i, v in enumerate(base)]
    rows += [(70 + i, base[0], None) for i in range(20)] + [(3, base[4], 1), (None, base[5], 2), (90, [0.5, 0.25], None)]
    rows += [(91, None, 0), (92, [1.0, None, 0.0, 0.0, 0.0], 0), (93, [float("nan")] * 5, 1), (94, [float("inf")] + [0.0] * 4, 1), (95, [], 0), (96, [-0.0] * 5, 0)]
    return rows


SCHEMA = "vec_id long, embedding array<double>, label int, x int, codes string, n int, error string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "c", 2, "e") for r in rows], SCHEMA)


def usable(rows, scale, multiple):
    """(id, whole vector, label), with zeros at the end of short ones."""
    good = [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]
    width = max((len(v) for _, v, _ in good), default=0)
    width += -width % multiple
    return [(i, [math.floor(scale * c) for c in v] + [0] * (width - len(v)), k) for i, v, k in good]


def check_whitening(found, rows):
    good = usable(rows, 256, 1)
    distinct = sorted({tuple(x) for _, x, _ in good})
    n, d = len(distinct), len(distinct[0])
    sums = [sum(x[i] for x in distinct) for i in range(d)]
    centred = np.array([[v - s / n for v, s in zip(x, sums)] for x in distinct])
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:4], axes[:, ::-1][:, :4]
    assert len(found) == len(good) * len(values)
    by = {}
    for r in found:
        by.setdefault((r.vec_id, r.component), []).append(r)
    signs = {}
    for i, x, _ in good:
        for k in range(len(values)):
            exact = sum((n * a - s) ** 2 for a, s in zip(x, sums))
            same = [r for r in by[i, k + 1] if r.deviation == exact]
            assert same and same[0].n == n
            w = (np.array(x) - np.array(sums) / n) @ axes[:, k] / math.sqrt(values[k])
            if abs(w) > 1e-3:
                signs.setdefault(k, np.sign(w) * np.sign(same[0].whitened))
            assert any(abs(r.whitened - w * signs.get(k, 1)) < 1e-6 * max(1, abs(w)) for r in same)
            assert abs(same[0].explained - values[k] / np.trace(covariance)) < 1e-9
            assert same[0].identity_error < 1e-9


def test_whitening_like_plain_numpy(spark):
    rows = vector_rows()
    check_whitening(whiten(frame(spark, rows)).collect(), rows)


def test_whitening_of_the_smallest_tables(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    check_whitening(q.QUERIES["op11_whitening"](spark, FOLDER).collect(), rows)


def test_whitening_without_rows_or_variance(spark):
    assert whiten(frame(spark, vector_rows()).where("false")).count() == 0
    assert whiten(frame(spark, [(1, [], 0), (2, None, 0)])).count() == 0
    one = whiten(frame(spark, [(1, [0.5, 2.0], 0), (1, [0.5, 2.0], 0)])).collect()
    assert [(r.vec_id, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 1, 0, None, None, None)] * 4
    # Variance along one component alone, and numbers whose deviation leaves a long.
    line = sorted(whiten(frame(spark, [(1, [0.0, 1.0], 0), (2, [1e300, 1.0], 0)])).collect(), key=lambda r: (r.vec_id, r.component))
    assert [(r.component, r.deviation, r.explained) for r in line] == [(1, None, 1.0), (2, None, 0.0)] * 2
    assert [abs(r.whitened) if r.whitened is not None else None for r in line] == [1.0, None] * 2


@pytest.mark.parametrize("low, high", [(-300, 300), (0, 1), (-(2**62), 2**62), (5, 6)])
def test_bit_planes_give_exact_products(low, high):
    x = np.random.default_rng(1).integers(low, high, (333, 7))
    sums, products = cross_products(x)
    big = x.astype(object)
    assert (sums == big.sum(axis=0)).all() and (products == big.T @ big).all()


def plain_codes(rows, spec):
    good = usable(rows, spec.scale, spec.parts)
    size = len(good[0][1]) // spec.parts
    cut = [[x[p * size : (p + 1) * size] for p in range(spec.parts)] for _, x, _ in good]
    first = sorted((r for r in good if r[0] is not None), key=lambda r: (r[0], r[1]))[: spec.entries]
    books = [[x[p * size : (p + 1) * size] for _, x, _ in first] for p in range(spec.parts)]

    def best(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))

    for _ in range(spec.rounds):
        for p in range(spec.parts):
            own = [best(v[p], books[p])[1] for v in cut]
            for k in range(len(books[p])):
                members = [v[p] for v, e in zip(cut, own) if e == k]
                if members:
                    books[p][k] = [sum(c) // len(members) for c in zip(*members)]
    out = []
    for (i, _, k), v in zip(good, cut):
        found = [best(v[p], books[p]) for p in range(spec.parts)]
        out.append((i, k, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    by_label = {}
    for _, k, _, e in out:
        by_label[k] = by_label.get(k, 0) + e
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted((str(i), c, e, by_label[k]) for i, k, c, e in out), digest


@pytest.mark.parametrize("spec", [Codes(), Codes(2, 3, 4, 64), Codes(5, 100, 2, 10)])
def test_codes_like_plain_k_means(spark, spec):
    rows = vector_rows()
    found = compress(frame(spark, rows), spec)
    expected, digest = plain_codes(rows, spec)
    assert vector_codes.codebook_digest(found.codebooks) == digest
    given = with_group_error(found.rows).collect()
    assert sorted((str(r.vec_id), bytes(r.codes).hex(), r.error, r.label_error) for r in given) == expected


def test_codes_query_on_the_smallest_tables(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    found = q.QUERIES["op13_vector_codes"](spark, FOLDER).collect()
    expected, digest = plain_codes(rows, Codes())
    assert {r.codebooks_sha256 for r in found} == {digest}
    assert sorted((str(r.vec_id), r.code, r.error, r.label_error) for r in found) == expected


def test_codes_without_rows_and_of_huge_numbers(spark):
    empty = compress(frame(spark, vector_rows()).where("false"))
    assert with_group_error(empty.rows).count() == 0 and vector_codes.codebook_digest(empty.codebooks) == hashlib.sha256(b"").hexdigest()
    huge = compress(frame(spark, [(1, [1e300], 0), (2, [-1e300], 0), (3, [0.0], None)]), Codes(1, 2, 3))
    assert [(r.vec_id, bytes(r.codes), r.error) for r in huge.rows.orderBy("vec_id").collect()] == [(1, b"\0", None), (2, b"\1", 0), (3, b"\0", None)]


@pytest.mark.parametrize("kind", [np.int64, object])
@pytest.mark.parametrize("entries, span", [(1, 50), (2, 2), (16, 3), (16, 4000)])
def test_nearest_entry_like_full_search(kind, entries, span):
    rng = np.random.default_rng(entries + span)
    x, book = rng.integers(-span, span, (2000, 4)).astype(kind), rng.integers(-span, span, (entries, 4)).astype(kind)
    if entries > 1:
        book[1] = book[0]
    at, distance = nearest(x, book, rng.integers(0, entries, 2000))
    full = ((x[:, None] - book[None]) ** 2).sum(axis=-1)
    assert (at == full.argmin(axis=1)).all() and (distance == full.min(axis=1)).all()

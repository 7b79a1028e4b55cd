import zlib

import numpy as np
import oracle
import pytest

import tablewright.llm.queries as q
from tablewright.llm import packing, tokenizer
from tablewright.llm.lines import without_repeated_lines
from tablewright.llm.packing import Packing, hilbert_keys, pack
from tablewright.llm.tokens import token_counts

FOLDER = "/root/testdata/sf0.001"
TEXTS = [
    None, "", " ", "\n\t", "Plain words, don't they'll I'm we've 12 cents!", "x" * 9000, "ab " * 3000, "café CAFÉ Straße ΣΑΣ İstanbul", "éä ﬁ ①²½   x",
    "a<|endoftext|>b <|startoftext|><|endoftext|>", "<|endoftext", "日本語 тест العربية 😀👍", "'s't're''!!''s", "\x00\x1c\x85​", "it's--'tis '90s 'VE",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "a", 1, 2) for i, t in enumerate(TEXTS)] + [(4, TEXTS[4], "b", 0, 0), (None, "no id", None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, block string, n_tokens int, ids int")


@pytest.fixture(scope="module")
def whole():
    return tokenizer.load(tokenizer.default_path()).whole


def check_pieces(pieces, texts, whole, length=4096):
    """Every id of every document stands once, in gapless sequences that are full or a power of two long."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert by_doc.keys() == texts.keys()
    for doc, own in by_doc.items():
        ids = [i for t in texts[doc][:1] for i in whole.encode(t or "", add_special_tokens=False).ids + [2]]
        assert sum(p.length for p in own) == len(ids) * len(texts[doc])
        for p in own:
            part = np.array(ids[p.start : p.start + p.length], "<u4").tobytes()
            assert p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(part)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= length and at & (at - 1) == 0


def test_counts_equal_the_library(docs, whole):
    found = sorted((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(docs, limit=50).collect() if r.doc_id is not None)
    n = [len(whole.encode(t or "", add_special_tokens=False)) for t in TEXTS]
    expected = [(i, len((t or "").encode()), n[i], n[i] > 50) for i, t in [*enumerate(TEXTS), (4, TEXTS[4])]]
    assert found == sorted(expected)
    assert token_counts(docs.where("false")).count() == 0


def test_counts_of_the_smallest_tables(spark, whole):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    found = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in q.QUERIES["op7_tokens"](spark, FOLDER).collect()}
    n = {d: len(whole.encode(t, add_special_tokens=False)) for d, t in texts.items()}
    assert found == {d: (len(t.encode()), n[d], n[d] > 2048) for d, t in texts.items()}


def test_packing_keeps_every_id(spark, docs, whole):
    texts = {}
    for i, t in [*enumerate(TEXTS), (4, TEXTS[4]), (None, "no id")]:
        texts.setdefault(i, []).append(t)
    from tablewright.llm.packing import piece_checksum

    pieces = pack(docs, Packing(length=64, task_tokens=1000)).withColumn("ids_crc32", piece_checksum()).collect()
    check_pieces(pieces, texts, whole, 64)
    assert pack(docs.where("false")).count() == 0


@pytest.mark.parametrize("remembered", [0, 3, 10**6])
def test_ids_of_texts_whatever_is_remembered(whole, monkeypatch, remembered):
    monkeypatch.setattr(packing, "REMEMBERED_WORDS", remembered)
    monkeypatch.setattr(packing, "REMEMBERED_PRETOKENS", remembered)
    monkeypatch.setattr(packing, "GATHERED_WORDS", 5)
    ids_of = packing._Ids(tokenizer.default_path())
    for texts in ([t or "" for t in TEXTS], ["don't"], [""], [t or "" for t in TEXTS[::-1]], ["new words, don't", "a<|endoftext|>b"]):
        values, n = ids_of(texts, 2)
        expected = [whole.encode(t, add_special_tokens=False).ids + [2] for t in texts]
        assert [x.tolist() for x in np.split(values, np.cumsum(n)[:-1])] == expected


def test_packing_query_on_the_smallest_tables(spark, whole):
    texts = {r.doc_id: [r.text] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    check_pieces(q.QUERIES["op6_packing"](spark, FOLDER).collect(), texts, whole)


@pytest.mark.parametrize("n, bits", [(2, 4), (3, 3)])
def test_curve_visits_every_cell_by_unit_steps(n, bits):
    grid = np.stack(np.meshgrid(*[np.arange(2**bits)] * n, indexing="ij"), -1).reshape(-1, n)
    keys = hilbert_keys(grid, bits)
    assert sorted(keys) == list(range(len(grid)))
    path = grid[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_lines_like_brute_force(spark):
    rows = [
        (1, "a\nb\nc\nd"), (2, "x\na\nb\nc\nd\ny"), (3, "a\nb"), (4, None), (5, ""), (6, "\n\n\n\n"), (7, "\n\n\n\n"), (8, "q\nq\nq\nq\nq"),
        (9, "b\nc\nd\ne\nx\na\nb"), (9, "b\nc\nd\ne\nx\na\nb"), (None, "a\nb\nc"), (10, "m\nn\na\nb\nc"),
    ]
    df = spark.createDataFrame([(d, t, "z", 3, 4) for d, t in rows], "doc_id long, text string, _id string, n_lines int, p int")
    seen, expected = set(), []
    for d, t in sorted({r for r in rows if r[0] is not None}, key=lambda r: r[0]):
        lines = (t or "").split("\n")
        gone = set()
        for i in range(len(lines) - 2):
            span = tuple(lines[i : i + 3])
            if any(span):
                if span in seen:
                    gone |= {i, i + 1, i + 2}
                seen.add(span)
        kept = None if t is None else "\n".join(x for i, x in enumerate(lines) if i not in gone)
        expected += [(d, 0 if t is None else len(lines), len(gone), kept)] * sum(r == (d, t) for r in rows)
    found = without_repeated_lines(df)
    assert sorted((r.doc_id, r.n_lines, r.n_removed, r.text) for r in found.where("doc_id IS NOT NULL").collect()) == sorted(expected, key=lambda r: r[0])
    assert [r.text for r in found.where("doc_id IS NULL").collect()] == ["a\nb\nc"]
    assert without_repeated_lines(df.where("false")).count() == 0


@pytest.mark.parametrize("name", sorted(q.ORACLES))
def test_query_equals_its_sql(spark, name):
    assert oracle.difference(q.QUERIES[name](spark, FOLDER), oracle.connect(FOLDER), q.ORACLES[name]) is None

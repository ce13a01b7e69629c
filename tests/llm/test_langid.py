from itertools import product
from math import isclose, log

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from argent.llm import langid as M

PIECES = ["▁", "a", "b", "ab", "▁a", "ba", "▁ab", "aba"]


def segmentations(symbols):
    """All ways to cut a tuple of symbols into pieces, as tuples of pieces."""
    for cuts in product([0, 1], repeat=len(symbols) - 1):
        parts, at = [], 0
        for k, c in enumerate((*cuts, 1), 1):
            if c:
                parts.append(symbols[at:k])
                at = k
        yield parts


@pytest.fixture(scope="module")
def pieces():
    return M.load_pieces(public_tokenizers.path("piece_bpe_32k.model"))


def test_forward_sum_and_expected_counts_equal_brute_force():
    lattice = M.Lattice(PIECES)
    r = np.random.default_rng(1)
    p = r.random((lattice.size, 2))
    p /= p.sum(axis=0)
    number = {tuple(ord(c) for c in t): k for k, t in enumerate(PIECES)} | {(M._BYTE + b,): len(PIECES) + b for b in range(256)}
    words = ["a", "ab", "aba", "abab", "bb", "aéb", "ü"]
    got = lattice.log_probability(words, p)
    for w, row in zip(words, got):
        (symbols,) = lattice.symbols(w)
        ways = [[number.get(tuple(x)) for x in s] for s in segmentations(tuple(symbols))]
        total = [sum(np.prod([p[k, lang] for k in way]) for way in ways if None not in way) for lang in (0, 1)]
        assert all(isclose(x, log(t), rel_tol=1e-9) for x, t in zip(row, total))
    counts = np.array([3.0, 1, 2, 1, 1, 5, 1])
    want = np.zeros(lattice.size)
    for w, n in zip(words, counts):
        (symbols,) = lattice.symbols(w)
        ways = [way for s in segmentations(tuple(symbols)) if None not in (way := [number.get(tuple(x)) for x in s])]
        weights = np.array([np.prod([p[k, 0] for k in way]) for way in ways])
        for way, x in zip(ways, weights / weights.sum() * n):
            np.add.at(want, way, x)
    assert np.allclose(lattice.expected(words, counts, p[:, 0]), want)


def test_long_runs_are_cut_and_never_underflow(pieces):
    lattice = M.Lattice(pieces)
    p = np.full((lattice.size, 1), 1e-9)
    words = ["x" * 5000, "漢" * 3000, "\U0001f600" * 10, "a"]
    assert np.isfinite(lattice.log_probability(words, p)).all()
    assert all(len(run) <= M.SYMBOLS for w in words for run in lattice.symbols(w))
    assert M.words_of("Don't42STOP²x́") == ["don", "t", "stop", "x́"] and M.words_of("12-_") == []


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = M.op12_language_id(spark, sf)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"] and out.count() == docs.count()
    held = out.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right"), F.min("score").alias("s"), F.max("score").alias("t")).first()
    assert held.right > 0.99 and 0 <= held.s <= held.t <= 1


def test_defined_results(spark, pieces, docs, no_docs):
    learn = spark.createDataFrame([("the cat and the dog", "en"), ("le chat et le chien", "fr"), ("nothing", None), (None, "xx")], "text string, lang string")
    model = M.train(learn, "text", "lang", pieces, 2)
    assert model.languages == ["en", "fr"] and np.allclose(model.p.sum(axis=0), 1, atol=1e-3)
    again = M.train(learn.repartition(3), "text", "lang", pieces, 2)
    assert (again.p == model.p).all()
    rows = [(1, "the dog"), (1, "le chien " * 20000), (2, None), (3, ""), (4, "12 !"), (None, "le chat")]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id long, t string, score string, _text string").repartition(2)
    out = sorted(((r.doc_id, r.lang_pred, round(r.score, 3) > 0.5) for r in M.identified(df.select("doc_id", "t"), "t", ["doc_id"], model, pieces).collect()), key=repr)
    assert out == sorted([(1, "en", True), (1, "fr", True), (2, "und", False), (3, "und", False), (4, "und", False), (None, "fr", True)], key=repr)
    nothing = M.train(no_docs, "text", "lang", pieces)
    got = M.identified(docs, "text", ["doc_id", "node"], nothing, pieces).collect()
    assert len(got) == docs.count() and {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}
    assert M.identified(no_docs, "text", ["doc_id"], model, pieces).count() == 0
    ids = spark.createDataFrame([(None,), (1,), (5,)], "doc_id long")
    import zlib
    assert [r[0] for r in ids.select(M.held_out(F.col("doc_id"))).collect()] == [zlib.crc32(s) % 3 == 1 for s in (b"", b"1", b"5")]

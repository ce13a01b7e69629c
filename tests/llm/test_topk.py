import math

import numpy as np

from argent.llm import topk as M


def brute(rows, queries, k):
    out = []
    ok = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows
          if v and all(c is not None and math.isfinite(c) for c in v)]
    for q, x in ok:
        if q is None or q not in queries:
            continue
        scores = sorted((-sum(a * b for a, b in zip(x, y)), i is None, i or 0) for i, y in ok if i != q and len(y) == len(x))
        out += [(q, r + 1, None if n else i, -s) for r, (s, n, i) in enumerate(scores[:k])]
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect()), key=repr)


def test_whole_table_is_exact(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert got(M.op3_topk(spark, sf)) == brute(rows, {i for i, _ in rows if i % 50 == 0}, 5)


def test_ties_hot_vector_blocks_and_bad_rows(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_ROWS", 64)
    monkeypatch.setattr(M, "GROUP_QUERIES", 3)
    r = np.random.default_rng(5)
    rows = [(i, [float(c) for c in np.float32(r.normal(0, 0.4, 8))]) for i in range(300)]
    rows += [(300 + i, [0.5, -0.25, 0.0, 1.0, -1.0, 0.125, 0.0, 2.0]) for i in range(150)]
    rows += [(1000, None), (1001, []), (1002, [1.0, None] * 4), (1003, [float("nan")] * 8), (1004, [float("inf")] + [0.0] * 7),
             (1005, [0.0] * 8), (1006, [3.0]), (1007, [-3.0]), (None, [0.9] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    queries = {0, 50, 100, 300, 301, 1000, 1003, 1005, 1006}
    asked = df.filter(df.vec_id.isin(list(queries)))
    assert got(M.top_k(df, asked, 5)) == brute(rows, queries, 5)


def test_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert M.top_k(df, df, 5).count() == 0


def test_bitmap_sum_is_exact():
    r = np.random.default_rng(1)
    bits = {w: r.integers(0, 2, (n, 200)).astype(bool) for w, n in {0: 5, 1: 1, 3: 8, 4: 2}.items()}
    sums = M.add_slices({w: M._bitmap(b) for w, b in bits.items()})
    total = sum((1 << w) * b.sum(axis=0) for w, b in bits.items())
    back = sum((1 << w) * np.unpackbits(s.view(np.uint8), bitorder="little", count=200).astype(int)
               for w, s in enumerate(sums) if s is not None)
    assert (back == total).all()
    live = M._bitmap(np.ones(200, bool))
    for k in (1, 5, 200):
        assert M.kth_value(sums, live, k) == np.sort(total)[-k]


def test_huge_components_and_scores(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_ROWS", 40)
    r = np.random.default_rng(8)
    sizes = [1.0, 1e6, 1e9, 1e15, 1e17, 1e30, 1e306]
    rows = [(i, [float(c) * sizes[int(r.integers(0, 7))] for c in r.normal(0, 1, 4)]) for i in range(150)]
    rows += [(200 + i, [1e18 * (-1) ** i] * 4) for i in range(20)] + [(300, [0.0] * 4), (301, [-1e300] * 4), (302, [0.5, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    hold = lambda s: max(-M.MOST, min(M.MOST, s))
    x = {i: [hold(math.floor(c * 256)) if abs(c) < 1e300 else int(math.copysign(M.MOST, c)) for c in v] for i, v in rows}
    queries = [0, 25, 50, 75, 100, 125, 200, 201, 300, 301, 302]
    want = []
    for q in queries:
        best = sorted((-hold(sum(a * b for a, b in zip(x[q], y))), i) for i, y in x.items() if i != q)[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert got(M.top_k(df, df.filter(df.vec_id.isin(queries)), 5)) == sorted(want, key=repr)

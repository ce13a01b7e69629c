import collections
import re

import pytest

from argent.llm import mixing as M
import corpus_pipeline


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes):
    """Share by weight; cap; share the excess again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    capped, total = {}, sum(sizes.values())
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s: 3.0 * sizes[s] for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return {**capped, **share}
        capped.update(over)


def check(rows, docs):
    sizes = collections.Counter()
    for _, t, s in docs:
        sizes[s] += size(t)
    want = brute_targets(dict(sizes))
    taken = collections.Counter()
    for r, s in rows:
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s], abs=1e-6)
        assert 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1


def test_whole_table(spark, sf):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    source = {i: s for i, _, s in docs}
    out = M.op5_mixing(spark, sf).collect()
    assert sorted(r.doc_id for r in out) == sorted(source)
    assert all(r.size == size(t) for r in out for i, t, _ in [docs[r.doc_id]] if i == r.doc_id)
    check([(r, source[r.doc_id]) for r in out], docs)
    assert sorted(out) == sorted(M.op5_mixing(spark, sf).collect())


def test_epochs_before_fraction_and_key_order(spark, sf):
    rows = M.mixed(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.s].append(r)
    for group in by.values():
        assert len({r.epochs for r in group}) == 1
        assert sum(0 < r.part < r.size for r in group) <= 1


def test_edges(spark, docs, no_docs):
    rows = M.mixed(docs).collect()
    assert len(rows) == docs.count()
    plain = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    check([(r, None if r.s_null else r.s) for r in rows], plain)
    assert M.mixed(no_docs).count() == 0
    back = M.repeated(docs)
    assert back.columns == docs.columns and back.count() > 0 and M.repeated(no_docs).count() == 0


def test_stage_follows_weights(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = corpus_pipeline.mix(spark, docs, sf).collect()
    sizes, taken, largest = collections.Counter(), collections.Counter(), collections.Counter()
    for r in docs.collect():
        sizes[r.source] += size(r.text)
        largest[r.source] = max(largest[r.source], size(r.text))
    for r in out:
        taken[r.source] += size(r.text)
    want = brute_targets(dict(sizes))
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)

import zlib

import numpy as np

from argent.llm import toxicity as M
import corpus_pipeline


def auc(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y]
    neg = [s for s, y in zip(scores, labels) if not y]
    return np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    out = {r.doc_id: r for r in M.op4_toxicity(spark, sf).collect()}
    docs = [r.doc_id for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()]
    assert sorted(out) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in out.items())
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out.values())
    held = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if out[r.doc_id].held_out]
    assert auc([out[r.doc_id].score for r in held], [r.toxic for r in held]) > 0.95
    assert np.mean([out[r.doc_id].predicted for r in held if not r.toxic]) < 0.01
    assert np.mean([out[r.doc_id].predicted for r in held if r.toxic]) > 0.85


def test_label_model_finds_accurate_and_correlated_voters():
    r = np.random.default_rng(3)
    y = r.random(3000) < 0.2
    good = (y & (r.random(3000) < 0.8)) | (~y & (r.random(3000) < 0.02))
    poor = r.random(3000) < 0.3
    votes = np.column_stack([good, good, poor, good | poor]).astype(float)
    noisy = np.where(r.random(3000) < 0.002, ~y, y).astype(float)
    post, rates, weight = M.label_model(votes, noisy)
    assert weight[0] < 0.6 and weight[1] < 0.6  # twins share their evidence
    assert ((post > 0.5) == y).mean() > 0.93
    assert rates[1, 0] > 0.6 > 0.1 > rates[0, 0] and abs(rates[1, 2] - rates[0, 2]) < 0.1


def test_edges(spark, docs, no_docs):
    out = M.scored(docs, M.STATED, "text", ["doc_id"]).collect()
    assert len(out) == docs.count()
    by = {r.doc_id: r.score for r in out}
    assert by[None] > 0.5 > by[1] == by[2] and by[3] == by[4]
    assert M.scored(no_docs, M.STATED, "text", ["doc_id"]).count() == 0
    kept = M.scored(docs, M.STATED, "text", [], only_clean=True)
    assert kept.columns == docs.columns
    assert sorted(kept.collect(), key=repr) == sorted((r for r in docs.collect() if r.doc_id is not None), key=repr)
    assert M.fit([], []) is M.STATED and M.fit(["a"], [0]) is M.STATED


def test_stage_rejects_toxic_and_keeps_clean(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    left = {r.doc_id for r in corpus_pipeline.toxicity(spark, docs, sf).collect()}
    toxic, clean = ([i for i, y in labels.items() if y == v] for v in (1, 0))
    assert sum(i in left for i in clean) / len(clean) > 0.98
    assert sum(i in left for i in toxic) / len(toxic) < 0.2


def test_sample_goes_on_after_a_text_that_does_not_fit(spark, monkeypatch):
    monkeypatch.setattr(M, "SAMPLE_ROWS", 50)
    monkeypatch.setattr(M, "SAMPLE_BYTES", 6400)
    ids = spark.range(200).selectExpr("id as doc_id", "xxhash64(id) as h").filter(~M.held_out("doc_id")).orderBy("h").collect()
    order = [r.doc_id for r in ids]
    for big in (1, 4, 60):  # so many texts at the head of the hash order are over the budget
        sizes = {i: 7000 if k < big else 100 for k, i in enumerate(order)}
        docs = spark.createDataFrame([(i, str(i).ljust(n, "x")) for i, n in sizes.items()], "doc_id long, text string")
        labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic")
        texts, y = M.sample(docs, labels)
        assert [int(t.rstrip("x")) for t in texts] == order[big:big + 50]
        assert y == [i % 2 for i in order[big:big + 50]]

import hashlib

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from argent.llm import common
from argent.llm.lshforest import one_of_each
from argent.llm.mixing import mixed, repeated
from argent.llm.toxicity import op4_toxicity

CLASHING = ["_id", "_node", "_node_", "_s", "_n", "_t", "_copies", "_copy", "row", "id", "node", "copies", "kept_node", "no_source", "size", "root"]


def test_stages_take_columns_of_any_name(spark, docs):
    wide = docs.drop("node").select("*", *[F.lit(f"mine {c}").alias(c) for c in CLASHING])
    for stage in (one_of_each, repeated):
        out = stage(wide)
        assert out.columns == wide.columns and out.count() > 0
        assert out.where(" or ".join(f"`{c}` <> 'mine {c}'" for c in CLASHING)).count() == 0
    plain = docs.drop("node")
    for stage in (one_of_each, repeated):
        assert sorted(map(repr, stage(wide).select(plain.columns).collect())) == sorted(map(repr, stage(plain).collect()))


def test_rows_that_repeat_id_and_text_leave_a_defined_one(spark):
    text = "one two three four five six seven eight nine ten"
    df = spark.createDataFrame([(1, text, k) for k in range(5)] + [(2, text, 9)], "doc_id long, text string, n int")
    kept = {tuple(r) for k in (1, 3, 6) for r in one_of_each(df.repartition(k)).collect()}
    assert kept == {(1, text, 0)}


def test_encode_equals_the_library(spark, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for r in docs.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), tokenizer.decode(ids, skip_special_tokens=False))]
        want.append((r.doc_id, r.source, len(ids), *sha))
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in P.encode(spark, docs, "").collect())


def test_run_is_its_stages(spark, sf):
    """The rows of the whole pipeline follow from its stages' own results."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    clean = P.toxicity(spark, docs, sf)
    kept = sorted(r.doc_id for r in op4_toxicity(spark, sf).where("predicted = 0").collect())
    assert clean.columns == docs.columns and sorted(r.doc_id for r in clean.collect()) == kept
    one = P.near_duplicates(spark, clean, sf)
    texts = [r.text for r in one.collect()]
    assert len(texts) == len(set(texts)) and one.columns == docs.columns
    mixed_rows = P.mix(spark, one, sf)
    words = F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), 1))
    took = {r.source: r.w for r in mixed_rows.groupBy("source").agg(F.sum(words).alias("w")).collect()}
    longest = one.agg(F.max(words)).first()[0]
    for r in mixed(one).groupBy("s").agg(F.max("target").alias("target")).collect():
        assert abs(took.get(r.s, 0) - r.target) <= longest
    final = P.run(spark, sf)
    assert final.columns == ["doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(repr, final.collect())) == sorted(map(repr, P.encode(spark, mixed_rows, sf).collect()))


def test_a_task_gives_back_what_it_held(monkeypatch):
    """At its end, and where its rows are no longer wanted."""
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(1))
    run = common.tidy(lambda batches: (b + 1 for b in batches))
    assert list(run(iter([1, 2]))) == [2, 3] and len(given) == 1
    some = run(iter([1, 2]))
    assert next(some) == 2 and len(given) == 1
    some.close()
    assert len(given) == 2

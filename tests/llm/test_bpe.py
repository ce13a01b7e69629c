import hashlib

import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from argent.llm import bpe as M

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
VOCABULARY = M.Vocabulary(M.load_vocabulary(PATH), public_tokenizers.PATTERN)


def expected(text):
    ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
    shown = ",".join(map(str, ids))
    back = LIBRARY.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(shown.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


def ours(texts):
    e = M.Encoder(VOCABULARY)
    cuts = [e.cut(t) for t in texts]
    e.settle()
    return [[i for k in c for i in e.ids[k].split(",")] for c in cuts], ["".join(e.text[k] for k in c) for c in cuts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(list("ab t'sh1é漢😀 \n\t\r!_²") + ["<|endoftext|>", "the", "aaaa"]), max_size=40)
                .map("".join), max_size=8))
def test_ids_equal_the_library(texts):
    ids, back = ours(texts)
    for t, i, d in zip(texts, ids, back):
        assert [int(x) for x in i] == LIBRARY.encode(t, add_special_tokens=False).ids
        assert d == t  # exact round trip


def test_overlapping_pairs_and_long_words():
    texts = ["a" * n for n in (1, 2, 3, 4, 5, 7, 5001)] + ["ab" * 4000, " " * 999, "=" * 777]
    ids, _ = ours(texts)
    assert [[int(x) for x in i] for i in ids] == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


def test_tables(spark, sf, docs, no_docs):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = M.op6_bpe(spark, sf).collect()
    assert sorted(r.doc_id for r in out) == sorted(texts)
    for r in out:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(texts[r.doc_id])
    edge = M.digests(docs, "text", ["doc_id", "node"], PATH, public_tokenizers.PATTERN).collect()
    want = sorted((r.doc_id, r.node, *expected(r.text)) for r in docs.collect() if r.doc_id and r.node)
    assert sorted(tuple(r) for r in edge if r.doc_id and r.node) == want and len(edge) == docs.count()
    assert M.digests(no_docs, "text", ["doc_id"], PATH, public_tokenizers.PATTERN).count() == 0

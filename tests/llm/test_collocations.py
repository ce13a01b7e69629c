import re
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from argent.llm import collocations as M


def brute(rows, least, covered, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + m])) for m in range(1, 5) for i in range(len(w) - m + 1))
    out = []
    for lang in n:
        phrases = {p: c for (x, p), c in f.items() if x == lang and len(p) > 1 and c >= least}
        kept = []
        for p, a in phrases.items():
            if any(len(q) > len(p) and 100 * c >= covered * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, c in phrases.items()):
                continue
            cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(kept)[:top])]
    return sorted(out)


WORDS = "the of New new york é漢 a b c d \x00x İ end".split(" ")


def corpus(seed=3, n=300):
    r = np.random.default_rng(seed)
    marks = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "!?"]
    rows = [("".join(r.choice(WORDS, p=None) + r.choice(marks) for _ in range(r.integers(1, 60))), [None, "en", "fr", "und"][k % 4]) for k in range(n)]
    return rows + [(None, "en"), ("", None), (" ., ", "x"), ("one two three four five " * 4000, "long"), *[("same text here", "en")] * 50]


def test_equals_brute_force(spark, monkeypatch):
    rows = corpus()
    df = spark.createDataFrame([(t, g, "x", 1) for t, g in rows], "text string, lang string, word string, ids int").repartition(5)
    for least, covered, top, words, entries in ((5, 80, 40, 500, 200), (2, 50, 7, 10**6, 10**6)):
        monkeypatch.setattr(M, "BLOCK_WORDS", words)
        monkeypatch.setattr(M, "SHARD_ENTRIES", entries)
        got = sorted(tuple(r) for r in M.phrases(df, least=least, covered=covered, top=top).collect())
        assert got == brute(rows, least, covered, top)


def test_empty_and_rare(spark):
    df = spark.createDataFrame([], "text string, lang string")
    assert M.phrases(df).collect() == []
    assert M.phrases(spark.createDataFrame([("a b", None), (None, None)], df.schema)).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 32), st.sampled_from([2, 3, 4]), st.integers(1, 400), st.integers(0, 2**32))
def test_filter_round_trip(b, n, size, seed):
    r = np.random.default_rng(seed)
    wide, narrow = M.halves(n, b)
    hi = r.integers(0, 1 << min(wide, 63), size, dtype=np.uint64)
    lo = r.integers(0, 1 << min(narrow, 63), size, dtype=np.uint64)
    p, q = M.permute(hi, lo, wide, narrow)
    back = M.permute(p, q, wide, narrow, back=True)
    assert (back[0] == hi).all() and (back[1] == lo).all() and int(p.max()) < 1 << wide and int(q.max()) < 1 << narrow
    times = r.integers(1, 1000, size)
    hi, lo, counts = M.tally(p, q, times, narrow, wide + narrow)
    assert counts.sum() == times.sum() and len({*zip(hi.tolist(), lo.tolist())}) == len(hi)
    again = M.unpack(M.pack(hi, lo, counts, wide, narrow), wide, narrow)
    assert all((x == y).all() for x, y in zip(again, (hi, lo, counts)))


def test_permutation_is_one_to_one():
    hi, lo = (x.reshape(-1).astype(np.uint64) for x in np.meshgrid(np.arange(16), np.arange(4)))
    p, q = M.permute(hi, lo, 4, 2)
    assert len({*zip(p.tolist(), q.tolist())}) == 64

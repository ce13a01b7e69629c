import collections
import math
import random

import pytest

from argent.llm import lshforest as M
import corpus_pipeline


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """{row: (class id, links)} by comparing all rows."""
    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    parent, links = list(range(n)), [0] * n

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(n):
        for b in range(a + 1, n):
            x, y = sets[a], sets[b]
            same = (rows[a][1] or "") == (rows[b][1] or "")
            if same or (x and y and len(x & y) >= 0.8 * len(x | y)):
                links[a] += 1
                links[b] += 1
                parent[max(find(a), find(b))] = min(find(a), find(b))
    smallest = {}
    for a in range(n):
        i = rows[a][0]
        r = find(a)
        smallest[r] = i if smallest.get(r) is None else (smallest[r] if i is None else min(i, smallest[r]))
    return sorted(((rows[a][0], smallest[find(a)], links[a]) for a in range(n)), key=repr)


def exact_pairs(texts, threshold):
    """All pairs of different texts of at least ``threshold``, by exact prefix filtering: with grams in one
    order, rarest first, the first len - ceil(threshold * len) + 1 of each of two near sets share a gram."""
    sets = [shingles(t) for t in texts]
    counts = collections.Counter(g for x in sets for g in x)
    held, out = collections.defaultdict(list), {}
    for a, x in enumerate(sets):
        met = set()
        for g in sorted(x, key=lambda g: (counts[g], g))[:len(x) - math.ceil(threshold * len(x) - 1e-9) + 1]:
            met.update(held[g])
            held[g].append(a)
        for b in met:
            shared = len(x & sets[b])
            if shared >= threshold * (len(x) + len(sets[b]) - shared):
                out[b, a] = shared / (len(x) + len(sets[b]) - shared)
    return out


def test_classes_and_links_against_an_exact_join(spark):
    """10,000 documents: recall of the links, and no link too many."""
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").collect()]
    ids = collections.defaultdict(list)
    for i, t in rows:
        ids[t].append(i)
    texts = sorted(ids)
    pairs = exact_pairs(texts, M.THRESHOLD)
    links = {t: len(ids[t]) - 1 for t in texts}
    parent = {t: t for t in texts}

    def find(t):
        while parent[t] != t:
            t = parent[t]
        return t

    for a, b in pairs:
        x, y = texts[a], texts[b]
        links[x], links[y] = links[x] + len(ids[y]), links[y] + len(ids[x])
        parent[find(x)] = find(y)
    smallest = collections.defaultdict(list)
    for t in texts:
        smallest[find(t)] += ids[t]
    want = {i: (min(smallest[find(t)]), links[t]) for i, t in rows}
    out = {r.doc_id: (r.class_id, r.n_links) for r in M.op9_ngram_jaccard(spark, "/root/testdata/sf0.1").collect()}
    found, there = sum(n for _, n in out.values()), sum(n for _, n in want.values())
    print(f"documents {len(rows)}, pairs of different texts {len(pairs)}, links {found // 2} of {there // 2}, classes that differ "
          f"{sum(out[i][0] != want[i][0] for i in want)}, least similar pair {min(pairs.values()):.3f}")
    assert pairs and out.keys() == want.keys()
    assert all(out[i][1] <= want[i][1] for i in want) and found >= 0.999 * there


def got(df):
    return sorted(((r.id, r.class_id, r.links) for r in df.collect()), key=repr)


def test_prefix_reaches_the_recall():
    n = M.prefix_length(M.TREES, M.LONGEST, M.THRESHOLD, M.RECALL)
    assert 1 - (1 - 0.8 ** n) ** M.TREES >= M.RECALL > 1 - (1 - 0.8 ** (n + 1)) ** M.TREES


def test_whole_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = M.op9_ngram_jaccard(spark, sf).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in out), key=repr) == brute(rows)


@pytest.mark.parametrize("nodes,grams", [(512, 1_000_000), (7, 600)])
def test_near_groups_in_blocks(spark, monkeypatch, nodes, grams):
    monkeypatch.setattr(M, "BLOCK_NODES", nodes)
    monkeypatch.setattr(M, "BLOCK_GRAMS", grams)
    r = random.Random(4)
    rows = []
    for base in range(4):
        words = [f"w{r.randrange(5000)}" for _ in range(120)]
        for copy in range(40 if base == 0 else 6):
            edited = list(words)
            for _ in range(r.randrange(4)):
                edited[r.randrange(len(edited))] = f"x{r.randrange(10 ** 6)}"
            rows.append((len(rows), " ".join(edited)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(M.classes(df)) == brute(rows)


def test_edges_and_stage(spark, docs, no_docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(M.classes(docs)) == brute(rows)
    assert M.classes(no_docs).count() == 0 and M.one_of_each(no_docs).count() == 0
    left = corpus_pipeline.near_duplicates(spark, docs, "")
    assert left.columns == docs.columns
    kept = left.collect()
    groups = collections.Counter(c for _, c, _ in brute(rows))
    assert len(kept) == len(groups)
    assert {r.doc_id for r in kept} == set(groups)


def test_stage_on_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, sf).collect()}
    assert left == {c for _, c, _ in brute([(r.doc_id, r.text) for r in docs.collect()])}


def _variants(similar, count):
    """Pairs of texts of 204 words whose similarity is near ``similar``: one run of words replaced."""
    r = random.Random(9)
    rows = []
    for _ in range(count):
        words = [f"w{r.randrange(10 ** 6)}" for _ in range(204)]
        lost = round(200 * (1 - similar) / (1 + similar))
        rows += [(len(rows), " ".join(words)), (len(rows) + 1, " ".join(words[:204 - lost] + [f"z{r.randrange(10 ** 6)}" for _ in range(lost)]))]
    return rows


@pytest.mark.parametrize("similar,depths", [(0.97, [9]), (0.803, [9, 7])])
def test_prefix_is_shortened_as_far_as_the_verified_pairs_ask(spark, monkeypatch, similar, depths):
    seen, cells = [], M.cells
    monkeypatch.setattr(M, "cells", lambda nodes, depth, step=0: seen.append(depth) or cells(nodes, depth, step))
    rows = _variants(similar, 60) + [(1000 + i, "one and the same text of some words here") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(M.classes(df)) == brute(rows)
    assert seen == depths


def test_a_cell_is_compared_again_only_where_it_grew(spark):
    schema = "cell binary, node binary"
    old = spark.createDataFrame([(b"\0a", b"a"), (b"\0a", b"b"), (b"\0c", b"c"), (b"\0c", b"d")], schema)
    new = spark.createDataFrame([(b"\1a", b"a"), (b"\1a", b"b"), (b"\1c", b"c"), (b"\1c", b"d"), (b"\1c", b"e"),
                                 (b"\1f", b"f"), (b"\1f", b"g")], schema)
    assert {bytes(r.cell) for r in M.changed(new, old).collect()} == {b"\1c", b"\1f"}

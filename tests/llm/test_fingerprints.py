import collections
import hashlib
import random
import re

from pyspark.sql import functions as F

from argent.llm import fingerprints as M


def test_order_free_equality_insert_and_delete(spark):
    df = spark.createDataFrame([(1, "a\nb\nc"), (2, "c\na\nb"), (3, "a\nb"), (4, "c"), (5, "a\nb\nb")], "k int, t string")
    fp = {r.k: r for r in M.fingerprint(df, ["k"], "t").select("k", M.as_text(F.col("fingerprint")).alias("s")).collect()}
    assert fp[1].s == fp[2].s and len({fp[i].s for i in (1, 3, 4, 5)}) == 4
    both = M.fingerprint(df, ["k"], "t")
    a, b, whole = (both.filter(f"k = {k}").select(F.col("fingerprint").alias(n)) for k, n in ((3, "a"), (4, "b"), (1, "w")))
    row = a.crossJoin(b).crossJoin(whole).select(
        M.as_text(M.add(F.col("a"), F.col("b"))).alias("sum"), M.as_text(F.col("w")).alias("w"), M.as_text(F.col("a")).alias("a"),
        M.as_text(M.subtract(F.col("w"), F.col("b"))).alias("less")).first()
    assert row["sum"] == row["w"] and row["less"] == row["a"]


def brute(rows):
    """(doc_id, n_chars, edited sha) in descending id, NULL ids last."""
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (i, t) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        h = len(t) // 2
        out.append((i, len(t), hashlib.sha256((t[:len(t) - h] + nxt[:h]).encode()).hexdigest()))
    return out


def clauses(t):
    pieces = [c for line in t.split("\n") for c in re.split(M.CLAUSE_END, line)]
    return collections.Counter(w for c in pieces for w in ([c] if len(c) <= M.LONGEST else re.findall(M.WINDOW, c)))


def test_edited_texts_match_brute_force(spark, sf, docs, no_docs):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = M.op1_fingerprints(spark, sf).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in out) == sorted(brute(rows))
    edge = M.edited_fingerprints(docs).collect()
    want = brute([(r.doc_id, r.text) for r in docs.collect()])  # the repeated rows are equal
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in edge), key=repr) == sorted(want, key=repr)
    assert M.edited_fingerprints(no_docs).count() == 0
    one = M.edited_fingerprints(docs.filter("doc_id = 7")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_equal_texts_and_likeness(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = {r.doc_id: r for r in M.op1_fingerprints(spark, sf).collect()}
    by_text = collections.defaultdict(set)
    for i, t in texts.items():
        by_text[t].add(out[i].fingerprint)
    assert all(len(s) == 1 for s in by_text.values())
    assert len({next(iter(s)) for s in by_text.values()}) == len(by_text)
    ids = sorted(texts, reverse=True)

    errors = []
    for i, k in zip(ids, ids[1:]):
        t, h = texts[i], len(texts[i]) // 2
        a, b = clauses(t), clauses(t[:len(t) - h] + texts[k][:h])
        errors.append(abs(out[i].near_edited - sum((a & b).values()) / sum((a | b).values())))
        assert 0 <= out[i].near_edited <= 1 and 0 <= out[i].near_next <= 1
    assert sum(errors) / len(errors) < 0.1


def test_repeated_clauses_count_once_each(spark):
    pairs = []
    for k in range(60):  # each clause 6 to 35 times, half of the text kept
        kept, old, new = ([f"{w} {k} {i}." for i in range(12)] for w in ("kept", "old", "new"))
        times = 6 + k // 2
        pairs.append((k, " ".join((kept + old) * times), " ".join((kept + new) * times)))
    df = spark.createDataFrame(pairs, "k int, a string, b string")
    fps = M.fingerprint(df, ["k"], "a").withColumnRenamed("fingerprint", "x") \
        .join(M.fingerprint(df, ["k"], "b").withColumnRenamed("fingerprint", "y"), "k")
    got = {r.k: r.s for r in fps.select("k", M.likeness(F.col("x"), F.col("y")).alias("s")).collect()}
    for k, a, b in pairs:
        x, y = clauses(a), clauses(b)
        assert abs(got[k] - sum((x & y).values()) / sum((x | y).values())) < 0.25


def test_documents_with_repeated_clauses(spark):
    sf = "/root/testdata/sf0.1"

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = {r.doc_id: r.near_edited for r in M.op1_fingerprints(spark, sf).collect()}
    ids = sorted(texts, reverse=True)
    checked, errors = 0, []
    for i, k in zip(ids, ids[1:]):
        t, h = texts[i], len(texts[i]) // 2
        a, b = clauses(t), clauses(t[:len(t) - h] + texts[k][:h])
        if max(a.values()) > 2 or max(b.values()) > 2:
            checked += 1
            errors.append(abs(out[i] - sum((a & b).values()) / sum((a | b).values())))
    assert checked > 100 and max(errors) < 0.3


def test_texts_without_ascii_marks(spark):
    """Half kept of: plain words, Chinese with and without marks, one long token."""
    draw = random.Random(3)
    words = lambda n: " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 9))) for _ in range(n))
    han = lambda n, mark: "".join(chr(0x4E00 + draw.randrange(3000)) + (mark if k % 9 == 8 else "") for k in range(n))
    makers = {"words": lambda: words(400), "han": lambda: han(1800, ""), "marked": lambda: han(1800, "\uFF0C"),
              "token": lambda: words(600).replace(" ", "")}
    pairs = [(name, k, a, a[:len(a) // 2] + b[len(b) // 2:]) for name, make in makers.items() for k in range(12)
             for a, b in [(make(), make())]]
    df = spark.createDataFrame(pairs, "name string, k int, a string, b string")
    fps = M.fingerprint(df, ["name", "k"], "a").withColumnRenamed("fingerprint", "x") \
        .join(M.fingerprint(df, ["name", "k"], "b").withColumnRenamed("fingerprint", "y"), ["name", "k"])
    got = {(r.name, r.k): r.s for r in fps.select("name", "k", M.likeness(F.col("x"), F.col("y")).alias("s")).collect()}
    for name, k, a, b in pairs:
        x, y = clauses(a), clauses(b)
        exact = sum((x & y).values()) / sum((x | y).values())
        assert abs(got[name, k] - exact) < 0.2 and 0.15 < got[name, k] < 0.6, (name, got[name, k], exact)


def test_windows_meet_again_after_an_insertion(spark):
    draw = random.Random(5)
    text = " ".join("".join(draw.choice("abcdefghij") for _ in range(draw.randint(2, 9))) for _ in range(600))
    x, y = clauses(text), clauses("put before " + text)
    assert sum((x & y).values()) / sum((x | y).values()) > 0.6


def test_one_very_long_text(spark):
    n = 240_000  # clauses, all different; half of them kept, nothing added
    a = "\n".join(f"clause {i}" for i in range(n))
    b = "\n".join(f"clause {i}" for i in range(n // 2))
    df = spark.createDataFrame([(1, a), (2, b)], "k int, t string")
    fp = M.fingerprint(df, ["k"], "t")
    x, y = (fp.filter(f"k = {k}").select(F.col("fingerprint").alias(c)) for k, c in ((1, "x"), (2, "y")))
    s = x.crossJoin(y).select(M.likeness(F.col("x"), F.col("y")).alias("s")).first().s
    assert abs(s - 1 / 2) < 0.15


def test_native_plan(spark, sf):
    plan = M.op1_fingerprints(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SinglePartition" not in plan

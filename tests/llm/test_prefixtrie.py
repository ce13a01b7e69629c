import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from argent.llm import prefixtrie as M


def brute(convs):
    """Nodes of the trie of conversations {id: [(role, text)]}."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids = defaultdict(list)
    for k in members:
        if k:
            kids[k[:-1]].append(k)
    out, sums = [], {}
    for k in sorted(members, key=len, reverse=True):
        own = (len(members[k]) - 1) * (len(k[-1][1].encode()) if k else 0)
        sums[k] = (sum(sums[x][0] for x in kids[k]) or (not kids[k]) * 1, own + sum(sums[x][1] for x in kids[k]))
        out.append((members[k][0], len(k), members[k[:-1]][0] if k else None, len(members[k]), len(kids[k]), *sums[k],
                    hashlib.sha256(",".join(map(str, ends[k])).encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_long_short_and_shared_conversations(spark):
    """Several blocks, turnless members, ends at and beside block ends."""
    r = random.Random(5)
    trunk = [("user", f"turn {k} é") for k in range(40)]
    convs = {c: trunk[:r.choice([0, 1, 7, 8, 9, 15, 16, 17, 33, 40])] + [("a", r.choice("xyz")) for _ in range(r.choice([0, 0, 1, 3]))]
             for c in range(-20, 60)}
    convs[99], convs[100] = [], [("u", "")] * 25
    turns = spark.createDataFrame([(c, k, role, text, "x") for c, ts in convs.items() for k, (role, text) in enumerate(ts)],
                                  "conv_id long, turn long, role string, text string, key string").repartition(4)
    members = spark.createDataFrame([(c,) for c in convs], "conv_id long")
    assert result(M.trie(members, M.turn_ids(turns))) == brute(convs)


def test_rebuilt_with_nulls_ties_and_repeats(spark):
    rows = [(c, None if k == 2 else k, None if k == 1 else "user", None if k == 3 else f"t{min(c, 12) if k > 2 else 0}{k}")
            for c in [*range(1, 40), -7, -5, 101] for k in range(c % 12)]
    rows += [(None, 1, "user", "nobody"), (3, 1, "user", "b"), (3, 1, "user", "a"), (3, 1, "user", "a"), (44, 0, "", ""), (45, 0, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    by = defaultdict(list)
    for r in M.turn_ids(df).orderBy("conv_id", "at").collect():
        by[r.conv_id].append(r.tid)
    said = {t: None for ts in by.values() for t in ts}
    clean = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tid = f"{len(text.encode())}:{hashlib.sha256(f'{len(role)}:{role}{text}'.encode()).hexdigest()[:32]}"
            clean[c].append((turn is not None, turn or 0, role, tid, text))
            said[tid] = (role, text)
    for c, ts in clean.items():
        assert by[c] == [t[3] for t in sorted(ts)]
    made = {}
    for c in by:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        made[c] = [said[t] for t in by.get(base, [])[:h] + by[c][h:]]
    assert result(M.trie(*M.rebuilt(M.turn_ids(df)))) == brute(made)


@pytest.mark.parametrize("piece", [1, 3, 4096])
def test_digests_in_pieces(spark, monkeypatch, piece):
    monkeypatch.setattr(M, "PIECE", piece)
    df = spark.range(-5, 200).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("key"), F.col("id").alias("conv_id"))
    got = {r.key: r.ends_sha256 for r in M.end_digests(df.repartition(4)).collect()}
    hot = [k for k in range(-5, 200) if (k % 3 if k >= 0 else -(-k % 3)) > 0]
    assert got["hot"] == hashlib.sha256(",".join(map(str, hot)).encode()).hexdigest() and len(got) == 206 - len(hot)


def test_no_conversations(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert M.trie(*M.rebuilt(M.turn_ids(df))).collect() == []

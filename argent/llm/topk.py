"""Exact top-k by inner product over a bit-sliced index.

Vectors are quantised to integers. Their rows are dealt to blocks; a block's
index holds, for every component, one bitmap (a bit a row) per binary digit of
the component above the block's smallest value. For a query the index adds the
component's slices, weighted by the query's digits, with full adders on whole
bitmaps (three bitmaps of one weight become a sum and a carry of the next); a
negative weight uses the complement of the slices. The result is the score of
all rows of the block as bitmaps, most significant first.

``DROPPED`` low slices of each component stay out of the sum, which is then a
lower bound of the score, less than ``slack`` below it. The k-th largest lower
bound is found from the most significant slice downward; every row whose lower
bound is within the slack of it is a boundary row, whose score is computed
exactly from its stored integers. So no row of the true top k is missed.

Sums have as many slices as they need, and exact scores are computed in whole
numbers of any length where 64 bits might not hold them. A component or score
beyond +-(2^63 - 1) is held at that bound; rows are ranked by the score shown.

Queries go to every block in groups of bounded size; a block returns at most k
rows for a query, of which the k best over all blocks stay.

Defined results: vectors that are NULL, empty, or hold NULL or non-finite
components take no part; vectors are compared with those of their own length;
rows that carry the query's id are the query's own; of rows that repeat a
query's id the least vector is the query; ties go to the smaller id, NULL ids
last; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from argent.llm.common import landed, ship, table

SCALE = 256
BLOCK_ROWS = 8192
GROUP_QUERIES = 4096
#: Low slices of a component that are left to the exact step.
DROPPED = 2
#: Bound of components and scores.
MOST = (1 << 63) - 1


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(``id``, ``x``): integer components of the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    usable = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    return vectors.filter(v.isNotNull() & (F.size(v) > 0) & usable).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(v, lambda c: F.greatest(F.floor(c * scale).cast("long"), F.lit(-MOST))).alias("x"))


def _bitmap(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    n = bits.shape[-1]
    padded = np.zeros((*bits.shape[:-1], -(-n // 64) * 64), bool)
    padded[..., :n] = bits
    return np.packbits(padded, axis=-1, bitorder="little").view(np.uint64)


def index_block(key: tuple, rows: pa.Table) -> pa.Table:
    """One index row for a block: ids, integers, and the bitmaps."""
    x = np.array(rows.column("x").to_pylist(), np.int64).reshape(rows.num_rows, -1)
    low = x.min(axis=0)
    above = (x.view(np.uint64) - low.view(np.uint64)).T  # right modulo 2^64, whatever the range
    digits = max(1, int(above.max()).bit_length())
    slices = np.stack([_bitmap((above >> np.uint64(b)) & np.uint64(1) == 1) for b in range(digits)], axis=1)
    return pa.table({
        "width": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()),
        "n": pa.array([rows.num_rows], pa.int32()), "digits": pa.array([digits], pa.int32()),
        "ids": pa.array([rows.column("id").to_pylist()], pa.list_(pa.int64())),
        "low": pa.array([low.tobytes()], pa.binary()), "x": pa.array([x.tobytes()], pa.binary()),
        "slices": pa.array([slices.tobytes()], pa.binary())})


def add_slices(by_weight: dict[int, np.ndarray]) -> list[np.ndarray]:
    """Sum of weighted bitmaps as bitmaps, least significant first."""
    out, weight = [], 0
    pending = dict(by_weight)
    while pending:
        maps = pending.pop(weight, None)
        carries = []
        while maps is not None and len(maps) > 1:
            if len(maps) == 2:
                carries.append(maps[:1] & maps[1:])
                maps = maps[:1] ^ maps[1:]
                break
            thirds = len(maps) // 3
            a, b, c = maps[:thirds], maps[thirds:2 * thirds], maps[2 * thirds:3 * thirds]
            half = a ^ b
            carries.append((a & b) | (c & half))
            maps = np.concatenate((half ^ c, maps[3 * thirds:]))
        if carries:
            more = pending.get(weight + 1)
            pending[weight + 1] = np.concatenate(carries if more is None else [more, *carries])
        out.append(maps[0] if maps is not None else None)
        weight += 1
    return out


def kth_value(slices: list, live: np.ndarray, k: int) -> int:
    """Largest v such that at least k live rows reach v, digit by digit from
    the most significant slice. At least k rows are live."""
    sure, open_, value = 0, live, 0
    for w in range(len(slices) - 1, -1, -1):
        ones = open_ & slices[w] if slices[w] is not None else np.zeros_like(open_)
        count = int(np.bitwise_count(ones).sum())
        if sure + count >= k:
            open_, value = ones, value | (1 << w)
        else:
            sure += count
            open_ = open_ ^ ones
    return value


def at_least(slices: list, live: np.ndarray, value: int) -> np.ndarray:
    """Bitmap of the live rows whose sum is at least ``value``."""
    if value <= 0:
        return live
    if value >> len(slices):
        return np.zeros_like(live)
    above, equal = np.zeros_like(live), live
    for w in range(len(slices) - 1, -1, -1):
        s = slices[w] if slices[w] is not None else np.zeros_like(live)
        if value >> w & 1:
            equal = equal & s
        else:
            above = above | (equal & s)
            equal = equal & ~s
    return above | equal


def exact_scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of the rows with ``q``, held at the bound of 64 bits."""
    largest = max(abs(int(x.min())), int(x.max())) if x.size else 0
    if largest * sum(map(abs, q.tolist())) <= MOST:
        return x @ q
    return np.array([max(-MOST, min(MOST, s)) for s in (x.astype(object) @ q.astype(object)).tolist()], np.int64)


def search_block(k: int):
    def run(key: tuple, index: pa.Table, queries: pa.Table) -> pa.Table:
        found: tuple[list, list, list] = ([], [], [])
        if index.num_rows and queries.num_rows:
            row = index.to_pylist()[0]
            n, width, digits, ids = row["n"], row["width"], row["digits"], row["ids"]
            x = np.frombuffer(row["x"], np.int64).reshape(n, width)
            low = np.frombuffer(row["low"], np.int64)
            slices = np.frombuffer(row["slices"], np.uint64).reshape(width, digits, -1)
            both = np.stack((slices, ~slices))  # digits and their complements
            every = _bitmap(np.ones(n, bool))
            own: dict = {}
            for at, i in enumerate(ids):
                own.setdefault(i, []).append(at)
            order = np.array([np.iinfo(np.int64).max if i is None else i for i in ids])
            first = min(DROPPED, digits - 1)
            for q, qx in zip(queries.column("id").to_pylist(), queries.column("x").to_pylist()):
                live = every
                if q in own:
                    live = every.copy()
                    for at in own[q]:
                        live[at // 64] &= ~np.uint64(1 << (at % 64))
                rows = int(np.bitwise_count(live).sum())
                if not rows:
                    continue
                qx = np.array(qx, np.int64)
                size, sign = np.abs(qx), (qx < 0).astype(np.int64)
                by_weight: dict[int, list] = {}
                for j in range(int(size.max()).bit_length()):
                    dims = np.flatnonzero(size >> j & 1)
                    for b in range(first, digits) if len(dims) else ():
                        by_weight.setdefault(j + b, []).append(both[sign[dims], dims, b])
                sums = add_slices({w: np.concatenate(m) for w, m in by_weight.items()})
                slack = sum(size.tolist()) * ((1 << first) - 1)
                # a score is the whole sum less this; those held at a bound are ties
                shift = sum(s * ((1 << digits) - 1) if n else 0 for s, n in zip(size.tolist(), sign)) \
                    - sum(a * b for a, b in zip(low.tolist(), qx.tolist()))
                kth = kth_value(sums, live, min(k, rows)) if sums else 0
                kth = 0 if kth - shift <= -MOST else min(kth, MOST + shift)
                near = at_least(sums, live, kth - slack) if sums else live
                at = np.flatnonzero(np.unpackbits(near.view(np.uint8), bitorder="little", count=n))
                score = exact_scores(x[at], qx)
                best = np.lexsort((order[at], -score))[:k]
                for p in best.tolist():
                    found[0].append(q), found[1].append(ids[at[p]]), found[2].append(int(score[p]))
        return pa.table({"query_id": pa.array(found[0], pa.int64()), "vec_id": pa.array(found[1], pa.int64()),
                         "score": pa.array(found[2], pa.int64())})
    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = SCALE) -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``) of each query's k best rows."""
    ship(vectors.sparkSession)
    rows = quantised(vectors, id_col, vector_col, scale).withColumn("_at", F.monotonically_increasing_id())
    count = rows.count()
    blocks = max(1, -(-count // BLOCK_ROWS))
    placed = rows.select(F.size("x").alias("width"), F.pmod(F.xxhash64("_at"), F.lit(blocks)).cast("int").alias("block"), "id", "x")
    index = landed(placed.groupBy("width", "block").applyInArrow(
        index_block, "width int, block int, n int, digits int, ids array<long>, low binary, x binary, slices binary"), "index")
    asked = quantised(queries, id_col, vector_col, scale).groupBy("id").agg(F.min("x").alias("x"))
    asked = landed(asked.select(F.size("x").alias("width"), "id", "x"), "queries")
    groups = max(1, -(-asked.count() // GROUP_QUERIES))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int"))
    to_blocks = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    copies = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    keys = ["width", "block", "part"]
    found = copies.groupBy(*keys).cogroup(to_blocks.groupBy(*keys)).applyInArrow(
        search_block(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def op3_topk(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return top_k(rows, rows.filter("vec_id % 50 = 0"), 5)

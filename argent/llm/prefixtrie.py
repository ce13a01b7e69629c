"""Prefix trie of conversations by SQL ROLLUP over positional turn columns.

Every turn (role and text) becomes a turn id: the text's UTF-8 bytes and 128
bits of a SHA-256 digest. A conversation becomes one row per block of
``WIDTH`` turns, with the block's turn ids in ``WIDTH`` columns, and
``ROLLUP`` over those columns aggregates all its prefixes together;
``grouping_id`` tells a rolled-up column from one past the end. A further block
is keyed by the node where the prior block ends. That node is named by a sum of
240-bit digests of (position, turn id) over all turns before the block, so
all blocks of all conversations go through one ROLLUP, however long they are.

Sums over a subtree come from the same ROLLUP rather than from walking the
tree. Each node belongs to its smallest member (its owner). As a member that is
smallest at a node is smallest at every deeper node of its own path, the nodes
below a node split into the owners' nodes, so a sum over members gives the sum
over nodes (:func:`trie`).

The digest of the members that end at a node is streamed: ids are sorted by
(node, id) over range partitions, joined to pieces of ``PIECE`` ids, and only
the pieces of a node meet in one task, one piece in memory at a time.

Defined results: rows without a conversation id take no part; a NULL role or
text is empty; turns go by ``turn`` (NULL first), then role, then turn id;
repeated rows are repeated turns; texts of any length count whole; an empty
table has no members, so no nodes. Only the four named columns are read, so
others may have any name. The turns of one conversation are numbered by a window over it
(one task, spilling, texts left out); a node's row meets its parent's in a
join, where a parent with very many children is left to Spark's skew split.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from argent.llm.common import landed, ship, table

#: Turns of a block (columns of the ROLLUP).
WIDTH = 8
#: Ids that are joined to one piece of text before a digest.
PIECE = 4096
#: Sums of 60-bit digests that name a prefix.
LANES = 4
_T = [f"t{j}" for j in range(1, WIDTH + 1)]


def turn_ids(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
             text: str = "text") -> DataFrame:
    """(conv_id, at, tid): every turn's place in its conversation, from 0, and its id."""
    said = F.coalesce(F.col(text).cast("string"), F.lit(""))
    by = F.coalesce(F.col(role).cast("string"), F.lit(""))
    tid = F.concat_ws(":", F.octet_length(said), F.substring(F.sha2(F.concat(F.length(by), F.lit(":"), by, said), 256), 1, 32))
    rows = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), by.alias("role"), tid.alias("tid"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "tid")
    return rows.select("conv_id", (F.row_number().over(order) - 1).cast("long").alias("at"), "tid")


def _bytes(tid: Column) -> Column:
    return F.substring_index(tid, ":", 1).cast("long")


def paths(members: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per member (``conv_id``) and block of its ``turns`` (conv_id,
    at, tid): t1.. the turn ids, ``prior`` and ``next`` the names of the prefixes before
    and through the block, ``len`` and ``total`` the member's turns and bytes, ``before``
    the bytes before the block, and on its last block ``end``, the node where it ends."""
    digest = F.sha2(F.concat_ws(":", "at", "tid"), 256)
    lanes = [F.conv(F.substring(digest, 15 * k + 1, 15), 16, 10).cast("decimal(20,0)") for k in range(LANES)]
    place = F.col("at") % WIDTH
    per_block = turns.groupBy("conv_id", F.expr(f"at div {WIDTH}").alias("block")).agg(
        *[F.max(F.when(place == j, F.col("tid"))).alias(t) for j, t in enumerate(_T)],
        F.count(F.lit(1)).alias("m"), F.sum(_bytes(F.col("tid"))).alias("size"),
        *[F.sum(lane).alias(f"e{k}") for k, lane in enumerate(lanes)])
    whole = Window.partitionBy("conv_id")
    so_far = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def name(skip_own: bool) -> Column:
        return F.concat_ws(".", *[((F.sum(f"e{k}").over(so_far)) - (F.col(f"e{k}") if skip_own else 0)).cast("decimal(38,0)")
                                  for k in range(LANES)])

    rows = per_block.select(
        "conv_id", "block", *_T, "m", name(True).alias("prior"), name(False).alias("next"),
        F.sum("m").over(whole).alias("len"), F.sum("size").over(whole).alias("total"),
        (F.sum("size").over(so_far) - F.col("size")).alias("before"))
    nothing = F.lit(".".join("0" * LANES))
    rows = members.select("conv_id").join(rows, "conv_id", "left").select(
        "conv_id", *_T, F.coalesce("prior", nothing).alias("prior"), "next",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("block", "m", "len", "total", "before")])
    last = F.col("block") * WIDTH + F.col("m") == F.col("len")
    return rows.withColumn("end", F.when(last, _key(F.array_compact(F.array(*_T)), F.col("m"))))


def _key(tids: Column, d: Column) -> Column:
    """Name of the node after ``d`` turn ids of a block: the next block's own start if it is full."""
    inside = F.concat_ws("|", F.col("block"), F.col("prior"), F.array_join(F.slice(tids, F.lit(1), d), "|"))
    start = F.concat_ws("|", F.col("block") + 1, F.col("next"), F.lit(""))
    return F.sha2(F.when(d == WIDTH, start).otherwise(inside), 256)


def _rolled(rows: DataFrame, sums: str) -> DataFrame:
    """All prefixes of ``rows`` with their aggregates, one row per node."""
    columns = ", ".join(_T)
    rolled = rows.sparkSession.sql(
        f"""SELECT block, prior, {columns}, {WIDTH} - bit_count(grouping_id()) AS d, max(next) AS next,
                   max(before) AS before, min(conv_id) AS conv_id, count(*) AS n_convs, {sums}
            FROM {{rows}} GROUP BY block, prior, ROLLUP({columns})""", rows=rows)
    tids = F.array_compact(F.array(*_T))
    # a prefix past the end of its members repeats a shorter one; block 0 alone holds the root
    rolled = rolled.withColumn("tids", tids).where(
        ((F.col("d") == 0) & (F.col("block") == 0)) | ((F.col("d") > 0) & (F.size("tids") == F.col("d"))))
    earlier = F.slice("tids", F.lit(1), F.greatest(F.col("d") - 1, F.lit(0)))
    depth = F.col("block") * WIDTH + F.col("d")
    return rolled.select(
        "*", depth.alias("depth"), _key(F.col("tids"), F.col("d")).alias("key"),
        F.when(depth > 0, _key(earlier, F.greatest(F.col("d") - 1, F.lit(0)))).alias("parent"),
        F.when(F.col("d") > 0, _bytes(F.element_at("tids", F.greatest(F.col("d"), F.lit(1))))).otherwise(0).alias("size"),
        (F.col("before") + F.aggregate(earlier, F.lit(0).cast("long"), lambda a, t: a + _bytes(t))).alias("above"))


def trie(members: DataFrame, turns: DataFrame) -> DataFrame:
    """The nodes of the trie of ``members`` (conv_id, each once) with ``turns``
    (conv_id, at, tid), the root first: conv_id (its smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Sums over the subtree of a node u, with P the bytes above u's last text:
    its leaves are the members that own a childless node. The sum of n_convs * bytes
    over its nodes is the sum of (total - P) over its members. The sum
    of bytes over its nodes is ``own``, the bytes of the nodes a member owns, summed over its
    members, where the smallest one counts total - P instead.
    """
    ship(members.sparkSession)
    rows = landed(paths(members, turns), "paths")
    owners = _rolled(rows, "max(len) AS longest").groupBy("conv_id").agg(
        F.sum("size").alias("own"), F.max((F.col("longest") == F.col("depth")).cast("long")).alias("leaf"))
    known = rows.join(owners, "conv_id", "left").fillna(0, ["own", "leaf"])
    nodes = _rolled(known, "sum(total) AS totals, sum(own) AS owned, sum(leaf) AS n_leaves, "
                           "min_by(own - total, conv_id) AS first")
    saved = F.col("totals") - F.col("n_convs") * F.col("above") - F.col("owned") + F.col("first") + F.col("above")
    nodes = landed(nodes.select("key", "parent", "depth", "conv_id", "n_convs", "n_leaves", saved.alias("saved_tokens")), "nodes")
    children = nodes.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("key")).agg(
        F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    ends = end_digests(rows.where(F.col("end").isNotNull()).select(F.col("end").alias("key"), "conv_id"))
    out = nodes.join(children, "key", "left").join(ends, "key", "left").join(parents, "parent", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs",
                      F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves", "saved_tokens",
                      F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


# ------------------------------------------------- digests of sorted ids

def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, id) to (key, first id, up to PIECE ids joined by commas)."""
    def out(key: str, ids: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key]), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])],
                                          names=["key", "first", "ids"])

    key, ids = None, []
    for batch in batches:
        for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if ids and (k != key or len(ids) == PIECE):
                yield out(key, ids)
                ids = []
            key = k
            ids.append(c)
    if ids:
        yield out(key, ids)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by (key, first) to one digest a key, one piece at a time."""
    def out(key: str, state) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], names=["key", "ends_sha256"])

    key, state = None, None
    for batch in batches:
        for k, ids in zip(batch.column(0), batch.column(2)):
            k, ids = k.as_py(), ids.as_py().encode()
            if state is not None and k == key:
                state.update(b"," + ids)
                continue
            if state is not None:
                yield out(key, state)
            key, state = k, hashlib.sha256(ids)
    if state is not None:
        yield out(key, state)


def end_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): SHA-256 of each key's conv_ids, ascending, joined by commas."""
    pieces = (ends.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
              .mapInArrow(_pieces, "key string, first long, ids string"))
    return (pieces.repartition("key").sortWithinPartitions("key", "first")
            .mapInArrow(_digest, "key string, ends_sha256 string"))


# ------------------------------------------------------------- the query

def rebuilt(turns: DataFrame, group: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """(members, turns) where each conversation c begins with the first h turns
    of conversation c - c % ``group`` and goes on with its own after its first h,
    h being the CRC-32 of c in decimal modulo ``heads``."""
    turns = landed(turns, "turns")
    base = (turns.where((F.col("conv_id") % group == 0) & (F.col("at") < heads - 1)).groupBy(F.col("conv_id").alias("base"))
            .agg(F.sort_array(F.collect_list(F.struct("at", "tid"))).alias("head")))  # at most heads - 1 turns
    members = turns.where(F.col("at") == 0).select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
        (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int").alias("h"))
    members = members.join(base, "base", "left").select(
        "conv_id", "h", F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.array()).alias("head"))
    members = landed(members, "members")
    shared = members.select("conv_id", F.explode("head").alias("x")).select("conv_id", "x.at", "x.tid")
    own = turns.join(members.select("conv_id", "h", F.size("head").alias("begun")), "conv_id").where(
        F.col("at") >= F.col("h")).select("conv_id", (F.col("at") - F.col("h") + F.col("begun")).alias("at"), "tid")
    return members.select("conv_id"), shared.unionByName(own)


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    members, turns = rebuilt(turn_ids(table(spark, sf_dir, "conversations")))
    return trie(members, turns)


ORACLE = """
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
turns AS (
  SELECT conv_id, r, x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r,
    strlen(x) || ':' || substr(sha256(length(r) || ':' || r || x), 1, 32)) - 1 AS pos FROM said),
convs AS (
  SELECT c, c - c % 5 AS base, xor(list_reduce(list_prepend(4294967295::UBIGINT,
      flatten(list_transform(string_split(c::VARCHAR, ''), lambda s: [ascii(s)::UBIGINT, 0, 0, 0, 0, 0, 0, 0]))),
      lambda a, b: xor(xor(a, b) // 2, (xor(a, b) % 2) * 3988292384::UBIGINT)),
      4294967295::UBIGINT) % 9 AS h
  FROM (SELECT DISTINCT conv_id AS c FROM turns)),
begun AS (
  SELECT c, base, h, (SELECT count(*) FROM turns WHERE conv_id = base AND pos < h) AS nb FROM convs),
rebuilt AS (
  SELECT c, pos, r, x FROM begun JOIN turns ON conv_id = base AND pos < h
  UNION ALL SELECT c, nb + pos - h::BIGINT, r, x FROM begun JOIN turns ON conv_id = c AND pos >= h),
paths AS (
  SELECT c, coalesce(p, []) AS p, coalesce(b, []) AS b FROM convs LEFT JOIN (
    SELECT c, list(length(r) || ':' || r || x ORDER BY pos) AS p, list(strlen(x) ORDER BY pos) AS b
    FROM rebuilt GROUP BY c) USING (c)),
members AS (SELECT c, d, p[1:d] AS k, b, len(p) AS n FROM (SELECT *, unnest(range(0, len(p) + 1)) AS d FROM paths)),
nodes AS (
  SELECT k, d, min(c) AS conv_id, count(*) AS n_convs, max(CASE WHEN d > 0 THEN b[d] ELSE 0 END) AS size,
         max(n) = d AS leaf, coalesce(string_agg(CASE WHEN n = d THEN c::VARCHAR END, ',' ORDER BY c), '') AS ends
  FROM members GROUP BY k, d),
up AS (SELECT k[1:e] AS k, e, leaf, (n_convs - 1) * size AS saved FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM nodes)),
sums AS (SELECT k, e AS d, sum(leaf::INT) AS n_leaves, sum(saved) AS saved_tokens FROM up GROUP BY ALL),
kids AS (SELECT k[1:d - 1] AS k, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL)
SELECT n.conv_id, n.d::BIGINT AS depth, q.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
       saved_tokens::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN sums USING (k, d) LEFT JOIN kids USING (k, d)
LEFT JOIN nodes q ON q.d = n.d - 1 AND q.k = n.k[1:n.d - 1]
"""

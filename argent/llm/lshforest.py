"""Near duplicates by n-gram Jaccard similarity: a MinHash LSH forest, then
exact verification.

1. Equal texts are one *node* (MD5 of the text); only nodes are compared.
2. A node's set of word n-grams (lower-cased words, runs of non-white-space,
   five to a gram; a shorter text is one gram) is MinHashed. Each of ``TREES``
   prefix tries keeps the node's own sequence of ``LONGEST`` minimum hashes; a
   prefix of the sequence names a place in the trie.
3. Nodes at one place of a trie at the current depth form a run, named after
   its smallest node. Runs of different tries with one name are united to a
   *cell*, so a group of near copies is compared in a few cells, not once a
   trie. A large cell is dealt in blocks; each pair of blocks is a unit of work
   of bounded size.
4. Each unit computes exact Jaccard similarities of all its pairs and returns
   one row per node: its number of links and the smallest node that it is
   connected with. A pair that meets in several cells is counted in the first
   of them only. No row per pair is ever made, and no pair is left out.
5. The first step matches the whole sequences. The least similar pair verified
   so far tells the recall: a pair of similarity s meets at depth d with
   probability 1 - (1 - s^d)^TREES. While that is below ``RECALL``, the matched
   prefix is shortened to the depth that reaches it, and cells that the shorter
   prefix leaves as they were are not compared again. At the threshold itself
   the depth is 7, so there are at most three steps. Where no pair shows up that
   asks for it, pairs meet by whole sequences, which finds a lone pair at the
   threshold with probability 0.99.
6. Connected components of those rows give the classes.

Defined results: a NULL text counts as empty; texts without words equal only
texts of the same bytes; repeated rows are documents of their own, linked with
each other; a NULL id is kept; a class id is the smallest id in it; an empty
table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from argent.llm.common import boxed, landed, scratch_path, ship, table, tidy
from argent.operators.joins import fits_broadcast

WORDS = 5
THRESHOLD = 0.8
TREES = 32
#: Minimum hashes in a trie's sequence, and bytes kept of each.
LONGEST = 9
HASH_BYTES = 2
RECALL = 0.999
#: Bounds of a block: nodes, and n-grams of all its nodes.
BLOCK_NODES = 512
BLOCK_GRAMS = 1_000_000
#: Words whose hash a task remembers before it starts anew.
REMEMBERED = 200_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


def prefix_length(trees: int, longest: int, similarity: float, recall: float) -> int:
    """Shorten the matched prefix from ``longest`` values until a pair of this
    similarity shares it in some trie with at least the target recall."""
    length = longest
    while length > 1 and 1 - (1 - similarity ** length) ** trees < recall:
        length -= 1
    return length


class WordHashes(dict):
    """Word -> its hash; kept by a task, never by a worker."""

    def __missing__(self, word: str) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def grams(text: str, n: int, known: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word n-grams."""
    if len(known) > REMEMBERED:
        known.clear()
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.array([known[w] for w in words], np.uint64)
    width = min(n, len(h))
    out = np.zeros(len(h) - width + 1, np.uint64)
    for i in range(width):
        out = (out + h[i:i + len(out)]) * _MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20240229)
    a = r.integers(0, 1 << 31, count, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return a, r.integers(0, 1 << 32, count, dtype=np.uint32)


def sequences(shingles: np.ndarray, a: np.ndarray, b: np.ndarray, trees: int) -> list[bytes]:
    """Per trie the sequence of minimum hashes, ``HASH_BYTES`` of each."""
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(a), np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(short), 256):
        part = short[at:at + 256, None] * a[None, :]
        part += b[None, :]
        np.minimum(least, part.min(axis=0), out=least)
    # the minima are small numbers: mixed, so that the bytes kept tell them apart
    kept = ((least.astype(np.uint64) + np.uint64(1)) * _MIX >> np.uint64(64 - 8 * HASH_BYTES)).astype(">u2").tobytes()
    width = len(kept) // trees
    return [kept[t * width:(t + 1) * width] for t in range(trees)]


def signed(docs: DataFrame, id_col: str, text_col: str, words: int = WORDS, trees: int = TREES,
           longest: int = LONGEST) -> DataFrame:
    """Per row: ``id``, ``node`` and ``keys``, a sequence per trie (none if the
    text has no word)."""

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = _permutations(trees * longest)
        known = WordHashes()
        for batch in batches:
            keys = []
            for t in batch.column(2):
                g = grams(t.as_py(), words, known)
                keys.append(sequences(g, a, b, trees) if len(g) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(keys, pa.list_(pa.binary()))],
                names=["id", "node", "keys"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).cast("long").alias("id"), F.unhex(F.md5(text)).alias("node"),
                       text.alias("text")).mapInArrow(run, "id long, node binary, keys array<binary>")


def cells(nodes: DataFrame, depth: int, step: int = 0) -> DataFrame:
    """(``cell``, ``node``): which nodes have to be compared with each other, as
    they share a prefix of ``depth`` hashes in a trie. ``nodes`` has ``node`` and
    ``keys``. A cell is named after the step and a node of it."""
    prefix = F.substring("key", 1, HASH_BYTES * depth)
    placed = nodes.select("node", F.posexplode("keys").alias("tree", "key")) \
        .select("node", F.xxhash64("tree", prefix).alias("place"))
    runs = placed.groupBy("place").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("n")) \
        .filter("n > 1").drop("n")
    return placed.join(runs, "place").select(
        F.concat(F.lit(bytes([step])), F.col("least")).alias("cell"), "node").distinct()


def changed(new: DataFrame, old: DataFrame) -> DataFrame:
    """The rows of ``new`` (``cell``, ``node``) whose cell has not all the same
    nodes as a cell of ``old`` of that name."""
    def marks(cells_of: DataFrame) -> DataFrame:
        h = F.xxhash64("node")
        return cells_of.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"),
                                            F.sum(F.shiftrightunsigned(h, 32)).alias("s")) \
            .select("cell", F.expr("substring(cell, 2)").alias("name"), "n", "x", "s")
    fresh = marks(new).join(marks(old).drop("cell"), ["name", "n", "x", "s"], "left_anti").select("cell")
    return new.join(fresh, "cell", "left_semi")


def _near(sets: list[np.ndarray], left: int, cross: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Boolean matrix of the pairs of sets whose Jaccard similarity reaches the
    threshold, and the similarities; ``cross``: only between the first ``left``
    sets and the rest."""
    sizes = np.array([len(s) for s in sets])
    if len(sets) == 2:
        both = np.array([[0, len(np.intersect1d(sets[0], sets[1], assume_unique=True))]])
        both = np.vstack((both, both[:, ::-1]))
    else:
        owner = np.repeat(np.arange(len(sets)), sizes)
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        new = np.concatenate(([True], flat[1:] != flat[:-1]))
        gram = np.cumsum(new) - 1
        shared = np.bincount(gram)[gram] > 1  # a gram of one set is in no intersection
        gram, owner = gram[shared], owner[shared]
        gram = np.cumsum(np.concatenate(([0], (gram[1:] != gram[:-1]).astype(np.int64)))) if len(gram) else gram
        both = np.zeros((len(sets), len(sets)), np.float32)
        step = max(1, min(8192, 16_000_000 // max(1, len(sets))))
        for at in range(0, int(gram[-1]) + 1 if len(gram) else 0, step):
            lo, hi = np.searchsorted(gram, [at, at + step])
            x = np.zeros((len(sets), step), np.float32)
            x[owner[lo:hi], gram[lo:hi] - at] = 1
            both += x @ x.T
    total = sizes[:, None] + sizes[None, :]
    # |A n B| / |A u B| >= t, with whole numbers on both sides but t
    near = both >= threshold * (total - both) - 1e-9
    near[np.diag_indices(len(sets))] = False
    if cross:
        near[:left, :left] = False
        near[left:, left:] = False
    return near, both / np.maximum(total - both, 1)


def _roots(near: np.ndarray) -> np.ndarray:
    """Smallest index connected with each index."""
    root = np.arange(len(near))
    while True:
        best = np.where(near, root[None, :], len(near)).min(axis=1)
        new = np.minimum(root, best)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _unit(rows: list[tuple], threshold: float) -> tuple[list, list, list, list]:
    """One unit of work. Rows: node, copies, cells of the node, grams, block,
    with cell and block pair as the unit's key in front."""
    cell, i, j = rows[0][:3]
    rows.sort(key=lambda r: (r[7], r[3]))
    left = sum(r[7] == i for r in rows)
    sets = [np.frombuffer(r[6], np.uint64) for r in rows]
    near, likeness = _near(sets, left, i != j, threshold)
    touched = np.flatnonzero(near.any(axis=1))
    if not len(touched):
        return [], [], [], []
    # a pair counts in the first cell that has both
    here = np.array([[c < cell for c in r[5]].count(True) for r in rows])
    first = near
    if here.any():
        first = near.copy()
        earlier = [set(c for c in r[5] if c < cell) for r in rows]
        names = {c: k for k, c in enumerate(sorted(set().union(*earlier)))}
        member = np.zeros((len(rows), len(names)), np.float32)
        for k, e in enumerate(earlier):
            member[k, [names[c] for c in e]] = 1
        first &= (member @ member.T) == 0
    copies = np.array([r[4] for r in rows], np.int64)
    links = (first * copies[None, :]).sum(axis=1)
    order = np.argsort(np.array([r[3] for r in rows], object), kind="stable")
    root = _roots(near[np.ix_(order, order)])
    lead = {int(order[k]): rows[int(order[root[k]])][3] for k in range(len(rows))}
    least = float(likeness[near].min())
    return ([rows[k][3] for k in touched], [int(links[k]) for k in touched], [lead[int(k)] for k in touched],
            [least] * len(touched))


def verified(members: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str,
             words: int = WORDS, threshold: float = THRESHOLD, step: int = 0) -> DataFrame:
    """(``node``, ``links``, ``root``, ``least``) for every unit that links a
    node; ``least`` is the smallest similarity that links in the unit. Only the
    cells of ``step`` are compared; pairs of earlier ones have been counted."""
    spark = docs.sparkSession
    now = F.substring("cell", 1, 1) == F.lit(bytes([step]))
    of_node = members.groupBy("node").agg(F.sort_array(F.collect_set("cell")).alias("cells"),
                                          F.bool_or(now).alias("now")).filter("now").drop("now")
    wanted = landed(of_node.join(nodes.select("node", "id", "copies"), "node"), "candidates")
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.unhex(F.md5(text)).alias("node"), F.col(id_col).cast("long").alias("_id"), text.alias("text"))
    keys = wanted.select("node", F.col("id").alias("_first"))
    if fits_broadcast(keys):
        keys = F.broadcast(keys)
    texts = texts.join(keys, "node").filter(F.col("_id").eqNullSafe(F.col("_first"))).select("node", "text")

    @tidy
    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            sets = [grams(t.as_py(), words, known) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "size", "grams"])

    sets = texts.mapInArrow(shingle, "node binary, size long, grams binary") \
        .groupBy("node").agg(F.first("size").alias("size"), F.first("grams").alias("grams"))
    full = landed(wanted.join(sets, "node").select("node", "copies", "cells", "size", "grams"), "grams")
    placed = full.select("node", "size", F.explode("cells").alias("cell")).filter(now)
    # only cells beyond one block are looked up: at most one for each full block
    blocks = landed(placed.groupBy("cell").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_NODES), F.ceil(F.sum("size") / BLOCK_GRAMS)).cast("int").alias("blocks"))
        .filter("blocks > 1"), "blocks")
    if fits_broadcast(blocks):
        blocks = F.broadcast(blocks)
    dealt = placed.join(blocks, "cell", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))) \
        .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")) \
        .select("node", "cell", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")) \
        .select("node", "cell", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    units = dealt.join(full, "node").select("cell", "i", "j", "node", "copies", "cells", "grams", "block") \
        .repartition(max(8, int(spark.conf.get("spark.sql.shuffle.partitions"))), "cell", "i", "j") \
        .sortWithinPartitions("cell", "i", "j")

    @tidy
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        out: tuple[list, list, list, list] = ([], [], [], [])

        def settle() -> None:
            if len(held) > 1:
                for to, new in zip(out, _unit(held, threshold)):
                    to.extend(new)

        def batch_of() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.binary()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary()),
                 pa.array(out[3], pa.float64())], names=["node", "links", "root", "least"])
            for x in out:
                x.clear()
            return made

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if held and held[0][:3] != row[:3]:
                    settle()
                    held = []
                held.append(row)
            if len(out[0]) > 5000:
                yield batch_of()
        settle()
        yield batch_of()

    return units.mapInArrow(compare, "node binary, links long, root binary, least double")


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``): the smallest node of each node's component.
    ``edges`` has ``node`` and ``root``, either may be any node. Each round a
    node takes the smallest label among its own, its neighbours' and that of
    its label; rounds are written to the shared folder."""
    spark = edges.sparkSession
    pairs = landed(edges.filter("node != root").select("node", F.col("root").alias("other"))
                   .union(edges.filter("node != root").select(F.col("root"), F.col("node"))).distinct(), "edges")
    labels = landed(pairs.groupBy("node").agg(F.min("other").alias("other"))
                    .select("node", F.least("node", "other").alias("root")), "labels")
    base = scratch_path(spark, uuid.uuid4().hex)
    for step in range(1000):
        near = pairs.join(labels.select(F.col("node").alias("other"), F.col("root").alias("near")), "other") \
            .groupBy("node").agg(F.min("near").alias("near"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("jump"))
        new = labels.join(near, "node", "left").join(jump, "root", "left") \
            .select("node", F.least("root", "near", "jump").alias("new"), F.col("root").alias("old"))
        path = f"{base}/{step}"
        new.write.parquet(path)
        new = spark.read.parquet(path)
        labels = new.select("node", F.col("new").alias("root"))
        if not new.filter("new != old").limit(1).count():
            return labels
    raise RuntimeError("components did not settle")


def linked(nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(``node``, ``links``, ``root``): the forest's descent. Prefixes are
    shortened until the least similar verified pair has the target recall."""
    depth, step, members, found, least = LONGEST, 0, None, None, 1.0
    while True:
        new = cells(nodes, depth, step)
        new = landed(new if members is None else changed(landed(new, "runs"), members), "cells")
        members = new if members is None else members.union(new)
        now = landed(verified(members, nodes, docs, id_col, text_col, step=step), "links")
        found = now if found is None else found.union(now)
        lowest = now.agg(F.min("least")).first()[0]
        least = min(least, 1.0 if lowest is None else max(lowest, THRESHOLD))
        shorter = prefix_length(TREES, depth, least, RECALL)
        if shorter == depth:
            return found.select("node", "links", "root")
        depth, step = shorter, step + 1


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id``, ``node`` (MD5 of the text),
    ``class_id`` (smallest id of the class) and ``links`` (other rows whose
    similarity reaches the threshold, copies included)."""
    ship(docs.sparkSession)
    rows = landed(signed(docs, id_col, text_col), "signed")
    nodes = landed(rows.groupBy("node").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"),
                                            F.first("keys").alias("keys")), "nodes")
    found = linked(nodes, docs, id_col, text_col)
    labels = components(found.select("node", "root"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    of_node = nodes.select("node", "id", "copies").join(labels, "node", "left").join(links, "node", "left").select(
        "node", "id", F.coalesce("root", "node").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    smallest = of_node.groupBy("root").agg(F.min("id").alias("class_id"))
    known = of_node.join(smallest, "root").select("node", "class_id", "links", "root")
    return rows.select("id", "node").join(known, "node")


def op9_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "class_id", F.col("links").alias("n_links"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` without near duplicates: of each class the row with the
    smallest id (NULL ids last, then by text) stays, with all its columns,
    which may have any name."""
    known = classes(docs, id_col, text_col)
    rank = F.struct(F.col("id").isNull().alias("a"), F.coalesce("id", F.lit(0)).alias("b"), F.col("node").alias("c"))
    kept = landed(known.groupBy("root").agg(F.min(rank).alias("r"), F.count(F.lit(1)).alias("n")).select(
        F.col("r.c").alias("kept_node"), F.when(~F.col("r.a"), F.col("r.b")).alias("kept_id")), "kept")
    if fits_broadcast(kept):
        kept = F.broadcast(kept)
    node = F.unhex(F.md5(F.coalesce(F.col(text_col), F.lit(""))))
    out = boxed(docs, node=node, id=F.col(id_col).cast("long")).join(
        kept, (F.col("node") == F.col("kept_node")) & F.col("id").eqNullSafe(F.col("kept_id")), "left_semi")
    # rows that repeat id and text are one group: the first of them as text stays
    if known.groupBy("id", "node").count().filter("count > 1").limit(1).count():
        out = out.groupBy("id", "node").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return out.select("row.*")

"""Phrase collocations counted exactly in counting quotient filters.

1. Each task cuts its texts into words and pieces and lands them in *blocks*
   of about ``BLOCK_WORDS`` words: one row with the block's word numbers, and
   one row per distinct (language, word) of the block with its count.
2. The block counts are summed per (language, word). Words that occur at least
   ``least`` times get dense ids; no phrase that counts can hold another word,
   so the others end a piece. The ids return to the blocks by a join on the
   word, one row per block and word, so a frequent word costs one row a block.
3. Each block packs its n-grams of 2 to 4 ids into two halves of whole ids,
   permutes the packed value invertibly (a Feistel network over the halves),
   and counts equal ones in a counting quotient filter: the leading bits of the
   permuted value are the quotient (one occupied bit per quotient, one run-end
   bit per entry), the rest is the full remainder, and counts take one byte or
   an escape. Nothing is lost: quotient and remainder give the n-gram back. A
   block's filter is cut into shards by its leading bits.
4. The sorted filters of a shard are merged: equal entries add their counts.
   The permutation spreads n-grams evenly, so a shard holds about
   ``SHARD_ENTRIES`` entries whatever the words are. Entries with at least
   ``least`` occurrences go back to ids.
5. Cuts, scores, covered phrases and ranks are DataFrame joins and windows.

The number of filters is blocks x shards, as many as a shuffle has parts.
Memory: a task holds one block (or one text, if that is longer) or one shard.

Defined results: a NULL text counts as empty, a NULL language as ``und``;
texts of any length are counted whole; repeated rows count each time; an empty
table gives an empty result. Only the text and the language are read, so other
columns may have any name. Ties in rank are broken by the phrase (byte order).
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from argent.llm.common import landed, ship, table

#: Words, and the marks that end a piece (both over UTF-8 bytes).
TOKENS = re.compile(rb"[^ \t.,;:!?\n-\r]+|[.,;:!?\n-\r]")
MARKS = b".,;:!?\n\x0b\x0c\r"
#: Words, and distinct words, after which a block ends.
BLOCK_WORDS = 2_000_000
BLOCK_DISTINCT = 800_000
#: Entries that a merged shard should hold.
SHARD_ENTRIES = 1_000_000
#: Longest phrase: two halves of two ids each.
LONGEST = 4
_U = np.uint64
_BLOCK = "block long, lang string, word binary, local int, n long, ids binary"


# ---------------------------------------------------------------- blocks

class _Numbers(dict):
    """Word -> number within the block; marks are 0."""

    def __init__(self, lang: str, names: list):
        super().__init__({bytes([m]): 0 for m in MARKS})
        self.lang, self.names = lang, names

    def __missing__(self, word: bytes) -> int:
        self.names.append((self.lang, word))
        self[word] = number = len(self.names)
        return number


def _block_rows(block: int, names: list, ids: array) -> Iterator[pa.RecordBatch]:
    numbers = np.frombuffer(ids, np.int32)
    counts = np.bincount(numbers, minlength=len(names) + 1)[1:]
    m = len(names)
    columns = ["block", "lang", "word", "local", "n", "ids"]
    yield pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), pa.nulls(1, pa.string()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int32()),
         pa.array([int(counts.sum())], pa.int64()), pa.array([numbers.tobytes()], pa.binary())], names=columns)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.full(m, block), pa.int64()), pa.array([x[0] for x in names], pa.string()),
         pa.array([x[1] for x in names], pa.binary()), pa.array(np.arange(1, m + 1), pa.int32()),
         pa.array(counts, pa.int64()), pa.nulls(m, pa.binary())], names=columns)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block = TaskContext.get().partitionId() << 32
    names, by_lang, ids = [], {}, array("i")
    for batch in batches:
        for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
            numbers = by_lang.get(lang)
            if numbers is None:
                numbers = by_lang[lang] = _Numbers(lang, names)
            ids.extend(map(numbers.__getitem__, TOKENS.findall(text.as_py().lower())))  # bytes: only A-Z change
            ids.append(0)
            if len(ids) >= BLOCK_WORDS or len(names) >= BLOCK_DISTINCT:
                yield from _block_rows(block, names, ids)
                block += 1
                names, by_lang, ids = [], {}, array("i")
    if names:
        yield from _block_rows(block, names, ids)


def blocks(df: DataFrame, text: str, lang: str) -> DataFrame:
    """The landed blocks of ``df``: word rows, and per block one row of numbers."""
    ship(df.sparkSession)
    rows = df.select(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("t"),
                     F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("l"))
    return landed(rows.mapInArrow(_cut, _BLOCK), "blocks")


def dense_ids(df: DataFrame) -> DataFrame:
    """``df`` landed with dense ids from 1: the rows of a part are numbered
    from where the parts before it end (one row per part goes to the driver)."""
    rows = landed(df.withColumn("at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("at", 33)
    sizes = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("m")).orderBy("part").collect()
    first, at = [], 1
    for row in sizes:
        first.append((row["part"], at))
        at += row["m"]
    offsets = df.sparkSession.createDataFrame(first, "part long, first long")
    numbered = rows.withColumn("part", part).join(F.broadcast(offsets), "part")
    return numbered.withColumn("id", F.col("first") + F.col("at").bitwiseAND((1 << 33) - 1)).drop("part", "first", "at")


# ------------------------------------------------------- quotient filters

def _mix(x: np.ndarray, key: int) -> np.ndarray:
    x = (x + _U(key)) * _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


def permute(hi: np.ndarray, lo: np.ndarray, high_bits: int, low_bits: int, back: bool = False):
    """An invertible map of (hi, lo), given their widths; ``back`` undoes it."""
    high, low = _U((1 << high_bits) - 1), _U((1 << low_bits) - 1)
    rounds = range(1, 5)
    if back:
        for k in reversed(rounds):
            lo = (lo - _mix(hi, 2 * k + 1)) & low
            hi = (hi - _mix(lo, 2 * k)) & high
    else:
        for k in rounds:
            hi = (hi + _mix(lo, 2 * k)) & high
            lo = (lo + _mix(hi, 2 * k + 1)) & low
    return hi, lo


def tally(hi: np.ndarray, lo: np.ndarray, counts: np.ndarray | None, low_bits: int, bits: int):
    """Equal (hi, lo) as one entry with the sum of their counts, sorted."""
    if not len(hi):
        return hi, lo, np.zeros(0, np.int64)
    if bits <= 64:
        key = (hi << _U(low_bits)) | lo
        if counts is None:
            key, n = np.unique(key, return_counts=True)
        else:
            order = np.argsort(key, kind="stable")
            key = key[order]
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            key, n = key[starts], np.add.reduceat(counts[order], starts)
        return key >> _U(low_bits), key & _U((1 << low_bits) - 1), n
    order = np.lexsort((lo, hi))
    hi, lo = hi[order], lo[order]
    starts = np.flatnonzero(np.concatenate(([True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1]))))
    ones = np.ones(len(hi), np.int64) if counts is None else counts[order]
    return hi[starts], lo[starts], np.add.reduceat(ones, starts)


def _planes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of each value."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _values(data: memoryview, m: int, width: int) -> np.ndarray:
    out = np.zeros((m, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8, m * width).reshape(m, width)
    return out.reshape(-1).view("<u8").astype(_U)


def _widths(m: int, high_bits: int, low_bits: int) -> tuple[int, int, int]:
    """(quotient bits, remainder bytes of hi, of lo): at most 2 quotients an entry."""
    rest = max(0, -(-(high_bits - (2 * m).bit_length() + 1) // 8))
    return max(0, high_bits - 8 * rest), rest, -(-low_bits // 8)


def pack(hi: np.ndarray, lo: np.ndarray, counts: np.ndarray, high_bits: int, low_bits: int) -> bytes:
    """The counting quotient filter of sorted, distinct entries."""
    m = len(hi)
    q, rest, low = _widths(m, high_bits, low_bits)
    quotient = (hi >> _U(high_bits - q)).astype(np.int64) if q else np.zeros(m, np.int64)
    occupied = np.zeros(1 << q, bool)
    occupied[quotient] = True
    run_end = np.concatenate((quotient[1:] != quotient[:-1], [True]))
    remainder = hi & _U((1 << (high_bits - q)) - 1)
    small = np.minimum(counts, 255).astype(np.uint8)
    return b"".join((m.to_bytes(8, "little"), np.packbits(occupied).tobytes(), np.packbits(run_end).tobytes(),
                     _planes(remainder, rest), _planes(lo, low), small.tobytes(),
                     counts[counts >= 255].astype("<i8").tobytes()))


def unpack(data: bytes, high_bits: int, low_bits: int):
    """The entries of a filter: sorted hi and lo, and their counts."""
    view, m, at = memoryview(data), int.from_bytes(data[:8], "little"), 8
    q, rest, low = _widths(m, high_bits, low_bits)

    def take(size: int) -> memoryview:
        nonlocal at
        at += size
        return view[at - size:at]

    occupied = np.unpackbits(np.frombuffer(take(-(-(1 << q) // 8)), np.uint8), count=1 << q)
    run_end = np.unpackbits(np.frombuffer(take(-(-m // 8)), np.uint8), count=m)
    run = np.concatenate(([0], np.cumsum(run_end[:-1], dtype=np.int64)))
    hi = _values(take(m * rest), m, rest)
    if q:
        hi |= np.flatnonzero(occupied)[run].astype(_U) << _U(high_bits - q)
    lo = _values(take(m * low), m, low)
    counts = np.frombuffer(take(m), np.uint8).astype(np.int64)
    counts[counts == 255] = np.frombuffer(view[at:], "<i8")
    return hi, lo, counts


def halves(n: int, b: int) -> tuple[int, int]:
    """Widths of the two halves of n packed ids of b bits."""
    return (b if n == 2 else 2 * b), (b if n < 4 else 2 * b)


def _filters(ids: np.ndarray, b: int, longest: int, shard_bits: int):
    """(n, shard, filter) of a block's id sequence, where 0 ends a piece."""
    here = ids > 0
    for n in range(2, longest + 1):
        count = len(ids) - n + 1
        if count <= 0:
            return
        whole = here[:count].copy()
        for k in range(1, n):
            whole &= here[k:count + k]
        at = np.flatnonzero(whole)
        if not len(at):
            return
        high_bits, low_bits = halves(n, b)
        hi, lo = np.zeros(len(at), _U), np.zeros(len(at), _U)
        for k in range(n):
            if k < high_bits // b:
                hi = (hi << _U(b)) | ids[at + k]
            else:
                lo = (lo << _U(b)) | ids[at + k]
        hi, lo = permute(hi, lo, high_bits, low_bits)
        hi, lo, counts = tally(hi, lo, None, low_bits, high_bits + low_bits)
        s = min(shard_bits, high_bits)
        left = high_bits - s
        shard = (hi >> _U(left)).astype(np.int64)
        ends = np.searchsorted(shard, np.arange((1 << s) + 1))
        hi = hi & _U((1 << left) - 1)
        for k in np.flatnonzero(np.diff(ends)).tolist():
            i, j = ends[k], ends[k + 1]
            yield n, k, pack(hi[i:j], lo[i:j], counts[i:j], left, low_bits)


def frequent_ngrams(cut: DataFrame, words: DataFrame, least: int, longest: int = LONGEST) -> DataFrame:
    """``ids`` (array) and ``f`` of all n-grams of 2 to ``longest`` ids that
    occur at least ``least`` times in the blocks ``cut``, given the ids of ``words``."""
    size, total = words.agg(F.max("id"), F.sum("f")).first()
    if not size:
        return cut.sparkSession.createDataFrame([], "ids array<long>, f long")
    b = int(size).bit_length()
    shard_bits = max(0, (int(total) // SHARD_ENTRIES).bit_length())

    def fill(payload: pa.Table, known: pa.Table) -> pa.Table:
        numbers = np.frombuffer(payload.column("ids")[0].as_py(), np.int32)
        to_id = np.zeros(int(numbers.max(initial=0)) + 1, _U)
        to_id[known.column("local").to_numpy()] = known.column("id").to_numpy().astype(_U)
        out = list(_filters(to_id[numbers], b, longest, shard_bits))
        return pa.table({"n": pa.array([x[0] for x in out], pa.int32()), "shard": pa.array([x[1] for x in out], pa.int32()),
                         "filter": pa.array([x[2] for x in out], pa.binary())})

    def merge(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        n, shard = key[0].as_py(), key[1].as_py()
        high_bits, low_bits = halves(n, b)
        left = high_bits - min(shard_bits, high_bits)
        parts = [unpack(x.as_py(), left, low_bits) for x in rows.column("filter")]
        hi, lo, counts = tally(*(np.concatenate(x) for x in zip(*parts)), low_bits, left + low_bits)
        keep = counts >= least
        hi, lo = hi[keep] | (_U(shard) << _U(left)), lo[keep]
        hi, lo = permute(hi, lo, high_bits, low_bits, back=True)
        mask, columns = _U((1 << b) - 1), []
        for half, ids in ((hi, high_bits // b), (lo, low_bits // b)):
            columns += [(half >> _U(b * (ids - 1 - k))) & mask for k in range(ids)]
        flat = np.stack(columns, axis=1).astype(np.int64)
        ids = pa.ListArray.from_arrays(np.arange(0, flat.size + 1, n, dtype=np.int32), pa.array(flat.reshape(-1)))
        return pa.table({"ids": ids, "f": pa.array(counts[keep], pa.int64())})

    known = (cut.where(F.col("word").isNotNull()).select("block", "lang", "word", "local")
             .join(words.select("lang", "word", "id"), ["lang", "word"])
             .select(F.col("block").alias("of"), "local", "id"))
    payload = cut.where(F.col("ids").isNotNull()).select("block", "ids")
    filters = payload.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(fill, "n int, shard int, filter binary")
    return filters.groupBy("n", "shard").applyInArrow(merge, "ids array<long>, f long")


# ---------------------------------------------------------------- phrases

def _wide(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(20,0)")


def phrases(df: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, covered: int = 80,
            top: int = 2000, longest: int = LONGEST) -> DataFrame:
    """Each language's ``top`` phrases (see the module's docstring): lang,
    rank, phrase, its count ``a``, the counts ``l`` and ``r`` of the two parts
    at its lowest-scoring cut, all words ``n`` of the language, and the score.
    Phrases inside a longer one with at least ``covered`` percent of their
    count are left out. ``longest`` is at most 4."""
    if not 2 <= longest <= LONGEST:
        raise ValueError(f"longest must be 2 to {LONGEST}")
    cut = blocks(df, text, lang)
    counts = landed(cut.where(F.col("word").isNotNull()).groupBy("lang", "word").agg(F.sum("n").alias("f")), "words")
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    words = landed(dense_ids(counts.where(F.col("f") >= least)), "ids")
    grams = landed(frequent_ngrams(cut, words, least, longest), "ngrams")
    every = grams.unionAll(words.select(F.array("id"), "f"))

    cuts = grams.select("ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k"))
    cuts = (cuts.withColumn("left", F.slice("ids", F.lit(1), F.col("k")))
            .withColumn("right", F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")))
            .join(every.select(F.col("ids").alias("left"), F.col("f").alias("l")), "left")
            .join(every.select(F.col("ids").alias("right"), F.col("f").alias("r")), "right"))
    cuts = cuts.withColumn("product", _wide("a") * F.lit(2_000_000).cast("decimal(7,0)"))
    cuts = cuts.withColumn("score", F.expr("product div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    scored = cuts.groupBy("ids", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("worst"))

    longer = grams.where(F.size("ids") > 2).select("ids", "f", F.explode(F.sequence(F.lit(2), F.size("ids") - 1)).alias("m"))
    longer = longer.select("ids", "f", "m", F.explode(F.sequence(F.lit(1), F.size("ids") - F.col("m") + 1)).alias("i"))
    inside = longer.groupBy(F.slice("ids", F.col("i"), F.col("m")).alias("ids")).agg(F.max("f").alias("most"))
    scored = scored.join(inside, "ids", "left").where(
        F.col("most").isNull() | (_wide("most") * F.lit(100) < _wide("a") * F.lit(covered)))

    best = scored.select("ids", "a", "worst.score", "worst.l", "worst.r", F.col("ids")[0].alias("id")).join(
        words.select("id", "lang"), "id").drop("id")
    order = [F.desc("score"), F.desc("a")]
    best = best.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("place") <= top)
    spelled = best.select("*", F.posexplode("ids").alias("at", "id")).join(words.select("id", "word"), "id")
    spelled = spelled.groupBy("lang", "ids", "a", "l", "r", "score").agg(
        F.sort_array(F.collect_list(F.struct("at", "word"))).alias("spelled"))  # at most `longest` words
    spelled = spelled.withColumn("phrase", F.concat_ws(" ", F.transform("spelled", lambda x: x["word"].cast("string"))))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order, F.asc("phrase")))
    ranked = spelled.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark, sf_dir: str) -> DataFrame:
    return phrases(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\n\x0B\x0C\r]')) AS piece FROM documents)),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
grams AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM pieces, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m)),
f AS (SELECT lang, m, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
cuts AS (SELECT c.*, k, array_to_string(w[1:k], ' ') AS p, array_to_string(w[k + 1:], ' ') AS q
         FROM (SELECT *, unnest(range(1, m)) AS k FROM c) c),
scores AS (
  SELECT cuts.*, x.f AS l, y.f AS r, (2000000 * a) // (x.f + y.f) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = p JOIN f y ON y.lang = cuts.lang AND y.phrase = q),
worst AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
subs AS (SELECT lang, a, s, array_to_string(w[i:i + s - 1], ' ') AS sub
         FROM (SELECT *, unnest(range(1, m - s + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS s FROM c))),
inside AS (SELECT lang, sub, max(a) AS most FROM subs GROUP BY ALL),
kept AS (SELECT worst.* FROM worst LEFT JOIN inside ON inside.lang = worst.lang AND sub = phrase
         WHERE most IS NULL OR 100 * most < 80 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

"""Order-independent document fingerprints (homomorphic multiset hash).

A paragraph (a line of the text, split at ``\\n``) is hashed to a wide vector;
a document's fingerprint is the sum of its paragraphs' vectors, each lane
modulo a power of two. So paragraph order does not matter, equal multisets of
paragraphs have equal fingerprints, and inserting or deleting a paragraph adds
or subtracts its vector (:func:`add`, :func:`subtract`).

A paragraph's vector has three blocks:

* ``EXACT`` lanes modulo 2^32, seeded 32-bit hashes of the whole paragraph;
  they decide equality;
* ``SKETCH`` lanes modulo 2^32, summed over the paragraph's clauses: clause
  ``c`` adds a fixed-point Cauchy (1-stable) weight of its hash to lane ``i``.
  The difference of two fingerprints is then Cauchy in every lane, its scale
  the sum of the absolute differences of the clause counts, however often a
  clause repeats. Its estimate gives :func:`likeness`; the standard error of
  the scale is 1/8 of it at 128 lanes. Lanes that wrap stay a small share up
  to some million clauses of difference; tested at 240,000;
* one lane modulo 2^32 that counts clauses.

A clause ends at white space after an ASCII mark or after a full-width mark. One of
more than ``LONGEST`` code points (text without marks, or a script that has none)
is cut into windows of 24 to 40 code points that end at white space where there
is any; after an insertion, windows are the same again from the next mark on, or sooner.

Only built-in expressions are used. Defined results: a NULL text counts as the
empty text, which is one empty paragraph; repeated rows and ties each keep
their own row; an empty table gives an empty result; other columns of the
input, whatever their names, are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from argent.llm.common import shuffle_partitions, table

EXACT = 8
SKETCH = 128
#: Sketch units to a Cauchy weight of 1.
UNIT = 64
#: Where a clause ends inside a paragraph: at white space after an ASCII mark, and after a full-width mark.
CLAUSE_END = r"(?<=[.!?,;:])\s+|(?<=[\u3002\uFF01\uFF0C\uFF1F\uFF1B\uFF1A\u3001\u0964\u061F\u06D4])\s*"
#: Code points of the longest clause that is taken whole.
LONGEST = 120
#: A window of a longer clause: 24 code points, and on to the first white space, 40 at most.
WINDOW = r"(?s).{24}\S{0,15}\s?|.+"

_LOW = 0xFFFFFFFF


def exploded(df: DataFrame, text: str) -> DataFrame:
    """One row per clause of column ``text``; ``_paragraph`` is set on the
    first clause of each paragraph only."""
    lines = df.select("*", F.explode(F.split(F.col(text), "\n")).alias("_line")).drop(text)
    windows = lambda c: F.when(F.char_length(c) <= LONGEST, F.array(c)).otherwise(
        F.regexp_extract_all(c, F.lit(WINDOW), F.lit(0)))
    clauses = F.flatten(F.transform(F.split(F.col("_line"), CLAUSE_END), windows))
    pieces = lines.select("*", F.posexplode(clauses).alias("_pos", "_clause"))
    return pieces.withColumn("_paragraph", F.when(F.col("_pos") == 0, F.col("_line"))) \
        .drop("_line", "_pos")


def vector_sums() -> list[Column]:
    """Aggregates over :func:`exploded` rows that sum the wide vectors.

    A clause adds less than 2^32 to a lane, so no sum can overflow below 2^31
    clauses. Each half of a hash of the clause's hash makes one lane's weight.
    """
    out = []
    for i in range(EXACT // 2):
        h = F.xxhash64(F.lit(i), F.col("_paragraph"))
        first = F.col("_paragraph").isNotNull()
        out.append(F.sum(F.when(first, h.bitwiseAND(F.lit(_LOW))).otherwise(0)).alias(f"_e{2 * i}"))
        out.append(F.sum(F.when(first, F.shiftrightunsigned(h, 32)).otherwise(0)).alias(f"_e{2 * i + 1}"))
    clause = F.xxhash64("_clause")
    for j in range(SKETCH // 2):
        h = F.xxhash64(F.lit(1000 + j), clause)
        for i, half in enumerate((h.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(h, 32))):
            angle = (half + 0.5) * (math.pi / 2 ** 32) - math.pi / 2
            weight = F.rint(F.tan(angle) * UNIT).cast("long")
            out.append(F.sum(weight.bitwiseAND(F.lit(_LOW))).alias(f"_s{2 * j + i}"))
    out.append(F.count(F.lit(1)).alias("_n"))
    return out


def packed() -> Column:
    """The summed columns as a fingerprint ``struct<exact, sketch, n>``: two
    lanes to a long."""
    low = lambda c: c.bitwiseAND(F.lit(_LOW))
    pairs = lambda lane, n: F.array(*[
        F.shiftleft(low(F.col(f"{lane}{i}")), 32).bitwiseOR(low(F.col(f"{lane}{i + 1}"))) for i in range(0, n, 2)])
    exact, sketch = pairs("_e", EXACT), pairs("_s", SKETCH)
    return F.struct(exact.alias("exact"), sketch.alias("sketch"), low(F.col("_n")).alias("n"))


def fingerprint(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """One row per distinct ``keys`` with the fingerprint of its texts (the
    multiset union, when a key has several rows). The partial aggregate sums
    within each map task, so a hot key moves one vector per task."""
    cut = df.select(*keys, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    return exploded(cut, "_text").groupBy(*keys).agg(*vector_sums()).select(
        *keys, packed().alias("fingerprint"))


def _each(x: Column) -> list[Column]:
    """The two lanes of one packed long, lowest first."""
    return [x.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(x, 32)]


def _lanes(a: Column, b: Column, sign: int) -> Column:
    def mix(x: Column, y: Column) -> Column:
        low, high = (F.pmod(p + sign * q, F.lit(1 << 32)) for p, q in zip(_each(x), _each(y)))
        return low.bitwiseOR(F.shiftleft(high, 32))
    return F.struct(F.zip_with(a["exact"], b["exact"], mix).alias("exact"),
                    F.zip_with(a["sketch"], b["sketch"], mix).alias("sketch"),
                    F.pmod(a["n"] + sign * b["n"], F.lit(1 << 32)).alias("n"))


def add(a: Column, b: Column) -> Column:
    """Fingerprint of the paragraphs of both (insertion)."""
    return _lanes(a, b, 1)


def subtract(a: Column, b: Column) -> Column:
    """Fingerprint after the paragraphs of ``b`` are deleted from ``a``."""
    return _lanes(a, b, -1)


def _let(value: Column, f) -> Column:
    """``f(value)`` with ``value`` computed once, however often ``f`` names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def likeness(a: Column, b: Column) -> Column:
    """Estimated multiset Jaccard similarity of the clauses (0 to 1); exactly
    1 for equal fingerprints."""
    def apart_in(x: Column, y: Column) -> Column:
        return F.array(*[F.abs(F.pmod(p - q + (1 << 31), F.lit(1 << 32)) - (1 << 31)).cast("double")
                         for p, q in zip(_each(x), _each(y))])
    def scale_of(lanes: Column) -> Column:
        middle = (F.get(lanes, F.lit(SKETCH // 2 - 1)) + F.get(lanes, F.lit(SKETCH // 2))) / 2
        return _let(middle, lambda m: m * (1 + F.aggregate(lanes, F.lit(0.0), lambda s, x: s + (
            x * x - m * m) / F.greatest(x * x + m * m, F.lit(1e-9))) * (2.0 / SKETCH)))
    # the median, and from it one step of scoring: the error of the maximum likelihood
    scale = _let(F.array_sort(F.flatten(F.zip_with(a["sketch"], b["sketch"], apart_in))), scale_of)
    # both counts are exact, so what is apart lies between their difference and their sum
    both = (a["n"] + b["n"]).cast("double")
    known = F.greatest(F.abs(a["n"] - b["n"]).cast("double"), scale / float(UNIT))
    share = _let(F.least(both, known), lambda apart: (both - apart) / (both + apart))
    return F.when((a["exact"] == b["exact"]) & (a["n"] == b["n"]), F.lit(1.0)).otherwise(share)


def as_text(fp: Column) -> Column:
    """The fingerprint in lowercase hexadecimal, lanes of fixed width."""
    wide = lambda x: F.lpad(F.hex(x), 16, "0")
    return F.lower(F.array_join(F.transform(F.concat(fp["exact"], fp["sketch"], F.array(fp["n"])), wide), ""))


def with_next(df: DataFrame, key: str, text: str) -> DataFrame:
    """Rows of ``df`` (columns ``key``, ``text``) with ``next_text``, the text
    of the next row in descending ``key`` order; after the last, the first.

    NULL keys come last; rows of one key are ordered by text. Rows are dealt
    to key ranges whose upper ends are keys that occur, so a range's first row
    is known before the shuffle: it goes as a guest to the range before it and
    serves that range's last row. One shuffle, no global window. Extra output
    columns: ``range_id``, ``place`` (order in the range), ``guest``.
    """
    spark = df.sparkSession
    order = F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)))
    ranges = 4 * shuffle_partitions(spark)
    ends = df.select(order.alias("k")).agg(
        F.percentile_approx("k", [i / ranges for i in range(1, ranges)] + [1.0], 20 * ranges).alias("q"),
        F.min("k").alias("low"), F.max("k").alias("high")).first()
    bounds = sorted(set((ends["q"] or []) + ([ends["high"]] if ends["q"] else [])))
    last = max(len(bounds) - 1, 0)
    array = F.array(*[F.lit(int(b)) for b in bounds]) if bounds else F.array(F.lit(0))
    steps = [1 << s for s in range(max(last.bit_length(), 1) - 1, -1, -1)]
    find = F.aggregate(  # binary search: how many ends are below the key
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda at, s: F.when((at + s <= last) & (F.get(array, at + s - 1) < F.col("_k")), at + s).otherwise(at))
    placed = df.select("*", order.alias("_k")).withColumn("_r", find)
    end = F.get(array, F.col("_r")) == F.col("_k")
    wraps = F.col("_k") == F.lit(ends["high"] if bounds else 0)
    # descending order: range r is followed by range r - 1, range 0 by the highest key
    guests = F.concat(F.array(F.struct(F.col("_r").alias("range_id"), F.lit(0).alias("guest"))),
                      F.when(end & ~wraps, F.array(F.struct((F.col("_r") + 1).alias("range_id"), F.lit(1).alias("guest"))))
                      .when(wraps, F.array(F.struct(F.lit(0).alias("range_id"), F.lit(1).alias("guest"))))
                      .otherwise(F.array().cast("array<struct<range_id:int,guest:int>>")))
    rows = placed.select("*", F.inline(guests))
    w = Window.partitionBy("range_id").orderBy("guest", F.col("_k").desc(), F.xxhash64(text), text)
    return rows.select("*", F.lead(text).over(w).alias("next_text"), F.row_number().over(w).alias("place")) \
        .drop("_k", "_r")


def op1_fingerprints(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return edited_fingerprints(docs)


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (``doc_id``, ``text``): its fingerprint, that of its
    edited text (the last half replaced by the start of the next document) and
    their likeness. All after the one shuffle stays within key ranges."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(docs, "doc_id", "text")
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("n_chars", n.cast("long")).withColumn(
        "edited", F.concat(F.expr("substring(text, 1, char_length(text) - cast(floor(char_length(text) / 2) as int))"),
                           F.coalesce(F.substring("next_text", F.lit(1), half), F.lit("")))) \
        .withColumn("edited_sha256", F.sha2("edited", 256))
    keys = ["range_id", "place", "guest", "doc_id", "n_chars", "edited_sha256"]
    both = rows.select(*keys, F.inline(F.array(
        F.struct(F.lit(0).alias("which"), F.col("text").alias("_text")),
        F.struct(F.lit(1).alias("which"), F.col("edited").alias("_text")))))
    hashed = exploded(both, "_text").groupBy(*keys, "which").agg(*vector_sums()).select(
        *keys, "which", packed().alias("fp"))
    each = hashed.groupBy(*keys).agg(F.max(F.when(F.col("which") == 0, F.col("fp"))).alias("fp"),
                                     F.max(F.when(F.col("which") == 1, F.col("fp"))).alias("edited_fp"))
    w = Window.partitionBy("range_id").orderBy("place")
    out = each.withColumn("next_fp", F.lead("fp").over(w)).filter("guest = 0")
    return out.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("fp")).alias("fingerprint"),
                      as_text(F.col("edited_fp")).alias("edited_fingerprint"),
                      likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                      likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))

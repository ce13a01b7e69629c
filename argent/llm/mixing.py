"""Mixing sources to target weights (Efraimidis-Spirakis sampling).

Every document draws an exponential key, ``-ln(u) / quality`` with ``u`` hashed
from its id and a seed; in ascending key order a source's documents are a
weighted sample without replacement of any length. A source's target in words
is met by complete epochs first (every document once each), then by the
documents at the start of the key order whose running sum of words fits what
remains; the document at the boundary gives only the words that are missing.

Targets: sources in code point order (NULL last) weigh 5, 2, 1, repeating, and
share all words of the input by weight. No target exceeds ``CAP`` times its
source's words; what is cut off is shared again by weight until none is above.
That is the level ``L`` with ``target = min(CAP * size, L * weight)``, found in
closed form over the sources sorted by ``CAP * size / weight``.

The running sum never gathers a source in one task: keys are cut into bins,
(source, bin) totals are summed first, and only the rows of one bin are sorted
together. Only built-in expressions are used.

Defined results: NULL and blank texts have no words, are taken 0 times and get
0 words; a NULL source is a source; rows that repeat an id are rows of their
own (same key, any order among equals); an empty table gives an empty result;
other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from argent.llm.common import boxed, landed, table, unit_interval

CAP = 3
WEIGHTS = (5, 2, 1)
SEED = 17
#: Rows that one bin of a source holds on average, and bounds of the bin count.
BIN_ROWS = 50_000
BINS = (64, 65_536)

#: A word is a run of anything but these characters.
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality(words: Column, chars: Column) -> Column:
    """Quality weight in [0.05, 1]: 1 for words of six characters on average
    (white space included) in texts of 20 words or more, less for texts that
    are short or made of very short or very long words."""
    even = F.exp(-F.abs(F.log(chars / (words * 6.0))))
    return F.when(words > 0, F.greatest(F.lit(0.05), even * F.least(F.lit(1.0), words / 20.0))).otherwise(0.05)


def targets(sizes: DataFrame) -> DataFrame:
    """``s_null``, ``s``, ``source_size``, ``target`` per source, from
    (``s_null``, ``s``, ``source_size``). One row a source passes through the
    windows, never a document."""
    everything = Window.partitionBy()
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy("s_null", "s")) - 1) \
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]),
                                           (F.col("rank") % len(WEIGHTS) + 1).cast("int"))) \
        .withColumn("cap", (CAP * F.col("source_size")).cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    level = ranked.withColumn("before", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))) \
        .withColumn("weights", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))) \
        .withColumn("total", F.sum("source_size").over(everything)) \
        .withColumn("level", F.max((F.col("total") - F.col("before")) / F.col("weights")).over(everything))
    return level.select("s_null", "s", "source_size",
                        F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: ``id``, ``size``, ``source_size``,
    ``target``, ``epochs`` (complete passes), ``part`` (words of the fractional
    pass) and ``taken`` (all its words in the mix)."""
    spark = docs.sparkSession
    words = word_count(F.col(text_col))
    key = -F.log(unit_interval(F.xxhash64(F.lit(SEED), F.col("id")))) / quality(F.col("size"), F.col("chars"))
    skinny = docs.select(F.col(id_col).alias("id"), F.col(source_col).isNull().alias("s_null"),
                         F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("s"), words.alias("size"),
                         F.coalesce(F.char_length(text_col), F.lit(0)).alias("chars")) \
        .select("id", "s_null", "s", "size", key.alias("key"))
    rows = landed(skinny, "sizes")
    bins = max(BINS[0], min(BINS[1], rows.count() // BIN_ROWS))
    rows = rows.withColumn("bin", F.floor(F.col("key") / (1 + F.col("key")) * bins).cast("int"))
    totals = landed(rows.groupBy("s_null", "s", "bin").agg(F.sum("size").alias("words")), "totals")
    goals = targets(totals.groupBy("s_null", "s").agg(F.sum("words").alias("source_size")))
    in_bins = Window.partitionBy("s_null", "s").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("before", F.coalesce(F.sum("words").over(in_bins), F.lit(0))).drop("words") \
        .join(goals, ["s_null", "s"])
    in_bin = Window.partitionBy("s_null", "s", "bin").orderBy("key", "id", "size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inside", F.coalesce(F.sum("size").over(in_bin), F.lit(0))) \
        .join(offsets, ["s_null", "s", "bin"])
    goal = F.floor(F.col("target") + 1e-6).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0).cast("long")
    out = placed.withColumn("goal", goal).withColumn("epochs", epochs) \
        .withColumn("left", F.col("goal") - F.col("epochs") * F.col("source_size")) \
        .withColumn("part", F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - F.col("before") - F.col("inside"))))
    return out.select("id", "s_null", "s", "size", "source_size", "target", "epochs", "part",
                      (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"))


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with all
    its columns. Documents stay whole: the one at a boundary is in if at least
    half of it is wanted. Ids are expected to be unique within a source; rows
    that repeat an id get the largest number of copies of any of them. A
    document without words is kept once: it costs no budget. Columns may have any name."""
    size, part = F.col("size"), F.col("part")
    copies = mixed(docs, id_col, text_col, source_col).select(
        F.col("id").alias("of_id"), F.col("s_null").alias("of_null"), F.col("s").alias("of_source"),
        F.when(size == 0, 1).otherwise(F.col("epochs") + F.when(2 * part >= size, 1).otherwise(0)).cast("int").alias("copies")) \
        .groupBy("of_id", "of_null", "of_source").agg(F.max("copies").alias("copies")).filter("copies > 0")
    source = F.col(source_col)
    rows = boxed(docs, id=F.col(id_col), no_source=source.isNull(), source=F.coalesce(source.cast("string"), F.lit("")))
    out = rows.join(copies, F.col("id").eqNullSafe(F.col("of_id")) & (F.col("no_source") == F.col("of_null"))
                    & (F.col("source") == F.col("of_source")))
    return out.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")

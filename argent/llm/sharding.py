"""Shards in random order: a two-pass external shuffle.

Pass 1 scatters the records uniformly into buckets that fit in a task's memory,
by a seeded hash of the record's id and text. Pass 2 brings each bucket's
records into a canonical order, shuffles them by Fisher-Yates with a generator
seeded by (seed, bucket), and writes them. Buckets laid end to end are one
random permutation of the input; shard ``s`` of ``n`` holds its places
``floor(s * rows / n)`` up to the next shard's first, so the shards' row counts
are at most one apart (law ``rows``). Each shard is a folder of Parquet files
with whole records and their ``slot``.

Records that repeat id and text hash alike; where one such key alone would fill
a good part of a bucket, its records are scattered by their place in the scan
instead. Nothing but one bucket is ever in one task's memory.

Defined results: a NULL text has no bytes; NULL ids are ids like others;
repeated rows each get a slot; an empty table gives empty shards; other columns
are carried along unread. A column whose name is ``shard`` or ``slot`` in any
case is written with underscores added until the name is free (names that begin
with ``_argent`` are reserved).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from argent.llm.common import scratch_path, ship, table
from argent.operators.joins import fits_broadcast

SEED = 41
#: Text bytes of a bucket on average, and the least number of buckets a shard.
BUCKET_BYTES = 32 * 1024 * 1024
BUCKETS_PER_SHARD = 4


def record_bytes(text: str):
    """UTF-8 bytes of the text plus one for its end."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def free_names(columns: list[str], taken: list[str]) -> list[str]:
    """``columns``, those among ``taken`` (in any case) with underscores added."""
    used = {c.lower() for c in [*columns, *taken]}
    out = []
    for c in columns:
        if c.lower() in taken:
            while c.lower() in used:
                c += "_"
            used.add(c.lower())
        out.append(c)
    return out


def write_shards(docs: DataFrame, path: str, shards: int, id_col: str = "doc_id", text_col: str = "text",
                 seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write ``docs`` shuffled into ``path/shard=<s>``; returns a frame that
    reads the written records (with ``shard`` and ``slot``)."""
    spark = docs.sparkSession
    ship(spark)
    names = free_names(docs.columns, ["shard", "slot"])
    id_col, text_col = (names[docs.columns.index(c)] for c in (id_col, text_col))
    docs = docs.toDF(*names)
    total = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(record_bytes(text_col)).alias("b")).first()
    rows, buckets = total["n"], max(BUCKETS_PER_SHARD * shards, -(-int(total["b"] or 0) // bucket_bytes))
    hashed = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))
    hot_rows = max(100, rows // (4 * buckets))
    hot = docs.select(hashed.alias("_argent_hot")).groupBy("_argent_hot").count() \
        .filter(F.col("count") > hot_rows).select("_argent_hot")
    tagged = docs.withColumn("_argent_hash", hashed)
    if hot.limit(1).count():
        if fits_broadcast(hot):
            hot = F.broadcast(hot)
        tagged = tagged.withColumn("_argent_row", F.monotonically_increasing_id()) \
            .join(hot, F.col("_argent_hash") == F.col("_argent_hot"), "left") \
            .withColumn("_argent_hash", F.when(F.col("_argent_hot").isNull(), F.col("_argent_hash"))
                        .otherwise(F.xxhash64("_argent_hash", "_argent_row"))).drop("_argent_row", "_argent_hot")
    placed = tagged.withColumn("_argent_bucket", F.pmod(F.xxhash64("_argent_hash", F.lit(seed)), F.lit(buckets)).cast("int"))
    counts = placed.groupBy("_argent_bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("_argent_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_argent_bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_argent_start"))
    schema = T.StructType([*placed.schema.fields, T.StructField("_argent_at", T.LongType())])

    def fisher_yates(key: tuple, bucket: pa.Table) -> pa.Table:
        canonical = bucket.take(pc.sort_indices(bucket, sort_keys=[("_argent_hash", "ascending")]))
        order = np.random.Generator(np.random.PCG64([seed, key[0].as_py()])).permutation(bucket.num_rows)
        out = canonical.take(pa.array(order))
        return out.append_column("_argent_at", pa.array(np.arange(out.num_rows), pa.int64()))

    mixed = placed.groupBy("_argent_bucket").applyInArrow(fisher_yates, schema).join(
        F.broadcast(starts) if buckets <= 1_000_000 else starts, "_argent_bucket") \
        .withColumn("shard", F.expr(f"cast(((_argent_start + _argent_at + 1) * {shards} - 1) div {max(rows, 1)} as int)")) \
        .withColumn("slot", F.expr(f"_argent_start + _argent_at - (cast(shard as long) * {rows}) div {shards}"))
    mixed.drop("_argent_bucket", "_argent_start", "_argent_at", "_argent_hash").write.partitionBy("shard").parquet(path)
    fields = [f for f in docs.schema.fields] + [T.StructField("slot", T.LongType()), T.StructField("shard", T.IntegerType())]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def op2_sharding(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = write_shards(docs.select("doc_id", "text"), scratch_path(spark, "shards"), 8)
    return out.select("doc_id", record_bytes("text").alias("size"),
                      F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
                      F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))

"""Lookup and semi joins.

Broadcast only behind a measured size: :func:`fits_broadcast` counts the
rows and sums the bytes of the small side with one distributed aggregate
before the join is planned. Beyond the bound the join is a shuffle join on
the key and a second value that spreads what would pile up in one task: fact rows
with a NULL key, which never match, and the rows of a hot key, found by a
mergeable frequency sketch (:func:`hot_keys`), whose dimension rows are
copied once per spread value. Other keys are not copied; rows that are equal
in every column stay together. A fact stored in buckets of the key
(:class:`argent.sources.layers.CatalogStore`) is joined where it lies
(``spread=False``): only the dimension moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Default bounds for broadcasting a lookup side.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024

#: Values over which the rows with a NULL key are spread on the shuffle path.
NULL_SPREAD = 4096
_SPREAD = "__argent_spread"
_COPIES = "__argent_copies"
#: Most keys that are treated as hot, and items that their sketch tracks.
HOT_MOST = 1000
HOT_TRACKED = 16_384
_SKETCHED = (T.BooleanType, T.IntegralType, T.FractionalType, T.StringType, T.DateType, T.TimestampType)

_FIXED_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4,
    T.LongType: 8, T.FloatType: 4, T.DoubleType: 8, T.DateType: 4,
    T.TimestampType: 8, T.TimestampNTZType: 8,
}


def _hashable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _hashable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_hashable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, getattr(T, "VariantType", T.MapType)))


def _width(field: T.StructField):
    for cls, width in _FIXED_WIDTH.items():
        if isinstance(field.dataType, cls):
            return F.lit(width)
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0))
    # Nested values: their text form is an upper-bound proxy of their size.
    return F.coalesce(F.octet_length(F.col(f"`{field.name}`").cast("string")), F.lit(0))


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, approximate bytes) of ``df``, from one distributed aggregate."""
    width = sum((_width(f) for f in df.schema.fields), F.lit(0))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return int(row["n"]), int(row["b"] or 0)


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate of ``df`` (no job). For file scans it
    is based on the compressed file size, so the data in memory is at least
    about this large; it is not an upper bound."""
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        unknown = int(df.sparkSession.conf.get("spark.sql.defaultSizeInBytes",
                                               str(2 ** 63 - 1)).rstrip("bB"))
    except Exception:  # noqa: BLE001 -- an estimate is optional
        return None
    # a relation Spark cannot size gets the default: that is "unknown"
    return None if size >= unknown else size


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                   max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes.

    A side whose *estimate* is already far above the byte bound is refused
    without a job, so a huge table is not read once just to learn that it
    is huge; everything else is measured exactly.
    """
    estimate = estimated_bytes(df)
    if estimate is not None and estimate > 4 * max_bytes:
        return False
    rows, size = measure(df)
    return rows <= max_rows and size <= max_bytes


def lookup_join(fact: DataFrame, dim: DataFrame, on: str, how: str = "left",
                broadcast: bool | None = None, split_hot: bool = True, spread: bool = True,
                max_rows: int = BROADCAST_MAX_ROWS,
                max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Join a lookup ``dim`` onto ``fact`` by one key column named ``on``.

    ``broadcast=None`` measures ``dim`` and broadcasts it only within
    ``max_rows``/``max_bytes``; ``True``/``False`` force the choice. Without
    ``split_hot`` a hot key is left to AQE's skew-join split. ``spread=False``
    beyond the bound joins on the key alone, for a fact stored in buckets of it. The
    output columns are those of ``fact.join(dim, on, how)``: key first.
    """
    if broadcast is None:
        broadcast = fits_broadcast(dim, max_rows, max_bytes)
    if broadcast:
        return fact.join(F.broadcast(dim), on, how)
    if not spread or how not in ("left", "left_outer", "leftouter", "inner"):
        return fact.join(dim, on, how)
    # one pass over the fact: the spread value of a NULL key is one the
    # dimension never has, that of a hot key is one of its copies
    key = F.col(f"`{on}`")
    values = [F.col(f"`{f.name}`") for f in fact.schema.fields if _hashable(f.dataType)]
    drawn = F.xxhash64(*values)
    value = F.when(key.isNull(), 1 + F.pmod(drawn, F.lit(NULL_SPREAD))).otherwise(F.lit(0))
    hot = hot_keys(fact, on) if split_hot else []
    if not hot:
        return fact.withColumn(_SPREAD, value.cast("int")).join(
            dim.withColumn(_SPREAD, F.lit(0)), [on, _SPREAD], how).drop(_SPREAD)
    copies = F.broadcast(fact.sparkSession.createDataFrame(  # at most HOT_MOST rows
        hot, T.StructType([fact.schema[on], T.StructField(_COPIES, T.IntegerType())])))
    value = F.when(F.col(_COPIES).isNotNull(), F.pmod(drawn, F.col(_COPIES))).otherwise(value)
    spread_fact = fact.join(copies, on, "left").withColumn(_SPREAD, value.cast("int")).drop(_COPIES)
    each = F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_COPIES), F.lit(1)) - 1))
    spread_dim = dim.join(copies, on, "left").withColumn(_SPREAD, each).drop(_COPIES)
    return spread_fact.join(spread_dim, [on, _SPREAD], how).drop(_SPREAD)


def hot_keys(df: DataFrame, on: str) -> list[tuple]:
    """(key, copies) of the keys that hold more rows than an average shuffle
    partition (and a thousandth of all): ``copies`` parts of such a key
    are about as large as an average partition. One pass over the key column with
    a mergeable sketch of ``HOT_TRACKED`` items, whose error is far below a
    thousandth of the rows; the answer has at most ``HOT_MOST`` keys."""
    if not isinstance(df.schema[on].dataType, _SKETCHED):
        return []
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = df.select(F.col(f"`{on}`").alias("k")).where(F.col("k").isNotNull())
    row = keys.agg(F.expr(f"approx_top_k(k, {HOT_MOST}, {HOT_TRACKED})").alias("top"), F.count("k").alias("n")).first()
    return [(x["item"], min(partitions, -(-x["count"] * partitions // row["n"]))) for x in row["top"] or ()
            if x["count"] * min(partitions, HOT_MOST) > row["n"]]


def hottest_share(df: DataFrame, on: str) -> float:
    """Share of the rows that the most frequent value of ``on`` holds, NULL
    counted as a value (0 for no rows); one pass with the sketch of :func:`hot_keys`."""
    if not isinstance(df.schema[on].dataType, _SKETCHED):
        raise ValueError(f"{on}: the frequencies of {df.schema[on].dataType.simpleString()} are not measured")
    top = F.expr(f"approx_top_k(k, 1, {HOT_TRACKED}) FILTER (WHERE k IS NOT NULL)")
    row = df.select(F.col(f"`{on}`").alias("k")).agg(
        top.alias("top"), F.count("k").alias("n"), F.count(F.lit(1)).alias("rows")).first()
    most = max([x["count"] for x in row["top"] or ()] + [row["rows"] - row["n"]])
    return most / row["rows"] if row["rows"] else 0.0


def semi_join(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys`` (O22): each row at most
    once, whatever the multiplicity in ``keys``."""
    return df.join(keys, on, "left_semi")


def rows_referenced_by(df: DataFrame, id_col: str, ref_col: str) -> DataFrame:
    """Rows of ``df`` whose ``id_col`` is named in some row's ``ref_col``
    (parent rows). Every column and every duplicate row of ``df`` is kept.

    The referenced ids are de-duplicated with a partial aggregate first, so
    a parent referenced by a third of the table sends one row per map task
    into the join's shuffle.
    """
    refs = (df.select(F.col(ref_col).alias(id_col))
            .filter(F.col(id_col).isNotNull())
            .distinct())
    return semi_join(df, refs, id_col)

"""Deterministic keep-one-row-per-key.

``dropDuplicates([key])`` keeps an arbitrary row, so two runs can disagree.
``keep_one`` keeps the first row of each key under a total order: the
caller's order (e.g. newest version first), then every remaining orderable
column ascending with NULLs first. Any row it keeps is one the original job
could have kept.

Plan shape: ``row_number() == 1`` over ``partitionBy(keys)`` is planned by
Spark with a *partial* ``WindowGroupLimit`` before the shuffle and a final one
after it. Each map task sends at most one row per key, so a key holding a
third of the table shuffles one row per map task, not a third of the table.
NULL keys form one group, as with ``dropDuplicates``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RANK = "__keep_one_rank"
_UNORDERABLE = tuple(t for t in (T.MapType, getattr(T, "VariantType", None)) if t is not None)


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, _UNORDERABLE):
        return False
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return True


def tie_break_columns(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """Every non-key orderable column, ascending, NULLs first."""
    key_set = set(keys)
    return [F.col(f"`{f.name}`").asc_nulls_first() for f in df.schema.fields
            if f.name not in key_set and _orderable(f.dataType)]


def keep_one(df: DataFrame, keys: Sequence[str] | str,
             order: Sequence[Column] = ()) -> DataFrame:
    """One row per ``keys``: the first under ``order`` + all other columns."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    window = (Window.partitionBy(*[F.col(f"`{k}`") for k in keys])
              .orderBy(*order, *tie_break_columns(df, keys)))
    return (df.withColumn(_RANK, F.row_number().over(window))
            .filter(F.col(_RANK) == 1)
            .drop(_RANK))


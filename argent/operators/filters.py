"""Row predicates. Plain Column predicates: Catalyst pushes
them into the Parquet scan, nested paths included."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from argent.functions.columns import non_empty  # noqa: F401  (O19)


def all_of(*predicates: Column) -> Column:
    """Conjunction."""
    return reduce(lambda a, b: a & b, predicates)


def not_null(*paths: str) -> Column:
    """Every path, top-level or nested (``user.id``), is not NULL."""
    return all_of(*[F.col(p).isNotNull() for p in paths])


def is_true(path: str) -> Column:
    """``col == True``: NULL and false are both dropped."""
    return F.col(path) == F.lit(True)


def greater_than(left: Column | str, right) -> Column:
    """``left > right`` (O18, O21); ``right`` a column or a literal."""
    lhs = F.col(left) if isinstance(left, str) else left
    rhs = right if isinstance(right, Column) else F.lit(right)
    return lhs > rhs

"""Declarative column contracts.

A contract lists, per output column, its name, its type and where it comes
from (a path into the input, possibly nested, or an expression). The
``select`` of a pipeline is generated from it: one projection, every cast a
safe cast, every column aliased -- so the output names, order and types are
fixed by the contract, whatever the input types were.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from argent.functions.columns import as_type, audit_timestamp, safe_cast

#: Marker for the load-time audit column.
AUDIT = "@audit"


@dataclass(frozen=True)
class Out:
    """One output column. ``type=None`` passes the value through uncast
    (nested arrays kept as they are, O14)."""
    name: str
    type: str | None
    source: str | Callable[[], Column] | None = None


@dataclass(frozen=True)
class Contract:
    name: str
    columns: tuple[Out, ...]
    key: tuple[str, ...] = ()
    #: keep-one order, as functions building Columns over the output columns
    order: tuple[Callable[[], Column], ...] = field(default=())

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    def spark_schema(self, df: DataFrame | None = None) -> T.StructType:
        fields = []
        for c in self.columns:
            if c.type is None:
                if df is None:
                    raise ValueError(f"{self.name}.{c.name}: pass-through type needs the frame")
                fields.append(df.schema[c.name])
            else:
                fields.append(T.StructField(c.name, as_type(c.type), True))
        return T.StructType(fields)


def source_column(spec: Out, run_ts: str | None) -> Column:
    if spec.source == AUDIT:
        return audit_timestamp(run_ts)
    if callable(spec.source):
        return spec.source()
    return F.col(spec.source or spec.name)


def project(df: DataFrame, columns: Sequence[Out], run_ts: str | None = None) -> DataFrame:
    """One ``select`` with a safe cast and alias per contract column."""
    raw = [source_column(c, run_ts) for c in columns]
    # Analysis only (no job): learn the input types so text -> integer takes
    # the permissive rule and numbers -> integer a plain truncating cast.
    probe = df.select(*[r.alias(f"_c{i}") for i, r in enumerate(raw)]).schema
    exprs = []
    for i, (spec, col) in enumerate(zip(columns, raw)):
        if spec.type is None:
            exprs.append(col.alias(spec.name))
        else:
            exprs.append(safe_cast(col, spec.type, probe[i].dataType).alias(spec.name))
    return df.select(*exprs)


def conform(df: DataFrame, contract: Contract) -> None:
    """Fail with a clear message when ``df`` does not match the contract."""
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in contract.spark_schema(df).fields]
    if got != want:
        raise ValueError(f"{contract.name}: schema {got} differs from contract {want}")

"""Bring a frame to a declared schema by name.

Stored tables drift: nested fields come in another order, with extra fields,
or with numbers as text. Every declared field is looked up by its name at its
own level, cast safely where its type differs, and extra fields are ignored. A
missing one is reported by its full path. NULL structs stay NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from argent.functions.columns import safe_cast


def _find(have: T.StructType, name: str) -> T.StructField | None:
    for f in have.fields:
        if f.name == name:
            return f
    return next((f for f in have.fields if f.name.lower() == name.lower()), None)


def _field(have: T.StructType, name: str, path: str) -> T.StructField:
    found = _find(have, name)
    if found is None:
        raise ValueError(f"missing declared field {path}")
    return found


def missing_fields(have: T.DataType, want: T.DataType, path: str = "") -> set[str]:
    """Paths of the declared fields that ``have`` lacks at any level."""
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        out: set[str] = set()
        for f in want.fields:
            where = f"{path}.{f.name}" if path else f.name
            found = _find(have, f.name)
            out |= {where} if found is None else missing_fields(found.dataType, f.dataType, where)
        return out
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return missing_fields(have.elementType, want.elementType, f"{path}[]")
    return set()


def stored_types(have: T.DataType, want: T.DataType, path: str = "", lenient: bool = False) -> T.DataType:
    """``want`` with the stored leaf types: what a reader is asked for, so that
    it resolves by name and prunes extra fields at every level. ``lenient``
    leaves out declared fields that are not stored."""
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        out = []
        for f in want.fields:
            where = f"{path}.{f.name}" if path else f.name
            if lenient and _find(have, f.name) is None:
                continue
            found = _field(have, f.name, where)
            out.append(T.StructField(found.name, stored_types(found.dataType, f.dataType, where, lenient), True))
        return T.StructType(out)
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return T.ArrayType(stored_types(have.elementType, want.elementType, f"{path}[]", lenient), True)
    return have


def _same(have: T.DataType, want: T.DataType) -> bool:
    """Same names, order and types; whether NULLs are allowed is ignored."""
    return have.simpleString() == want.simpleString()


def shaped(col: Column, have: T.DataType, want: T.DataType, path: str, lenient: bool = False) -> Column:
    if _same(have, want):
        return col
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        return F.when(col.isNotNull(), F.struct(*_fields(lambda n: col.getField(n), have, want, f"{path}.", lenient)))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(col, lambda x: shaped(x, have.elementType, want.elementType, f"{path}[]", lenient))
    if isinstance(have, T.NullType):
        return F.lit(None).cast(want)
    if isinstance(want, (T.StructType, T.ArrayType)) or isinstance(have, (T.StructType, T.ArrayType)) \
            and not isinstance(want, T.StringType):
        raise ValueError(f"{path}: stored as {have.simpleString()}, declared as {want.simpleString()}")
    return safe_cast(col, want, have)


def _fields(get, have: T.StructType, want: T.StructType, prefix: str, lenient: bool) -> list[Column]:
    out = []
    for f in want.fields:
        if lenient and _find(have, f.name) is None:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        found = _field(have, f.name, f"{prefix}{f.name}")
        out.append(shaped(get(found.name), found.dataType, f.dataType, f"{prefix}{f.name}", lenient).alias(f.name))
    return out


def shaped_like(df: DataFrame, schema: T.StructType, lenient: bool = False) -> DataFrame:
    """The declared columns of ``df`` in order, by name at every level;
    ``lenient`` makes a declared field that is missing NULL."""
    return df.select(*_fields(lambda n: F.col(f"`{n}`"), df.schema, schema, "", lenient))

"""Column-level building blocks.

Every function returns a ``Column`` made of built-in Spark expressions, so it
stays inside whole-stage codegen and never leaves the JVM.

Casts follow the permissive (ANSI off) results of the original job while
running under ANSI on: malformed text becomes NULL instead of failing the
job, and text with a decimal part still gives its integer part.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str

# What the permissive cast strips on both sides: white space and control
# characters of ASCII.
_STRIPPED = r"[\x00-\x20\x7F]*"
# Text that it accepts: an integer with an optional decimal part ("12", "-3",
# "7.9", "12."), or a decimal part alone, even an empty one (".5", "-.25", ".",
# "+.", which give 0).
INTEGER_TEXT = rf"\A{_STRIPPED}[+-]?([0-9]+([.][0-9]*)?|[.][0-9]*){_STRIPPED}\z"
DECIMALS_ALONE = rf"\A{_STRIPPED}[+-]?[.]"
# At most 15 digits, so that the nearest double is on the same side of every
# integer, and in range.
SHORT_NUMBER = {T.IntegerType: r"\A[+-]?[0-9]{1,9}(?:[.][0-9]{0,5})?\z",
                T.LongType: r"\A[+-]?(?:[0-9]{1,15}|[0-9]{1,9}[.][0-9]{0,5})\z"}

# Text that the permissive cast takes for a boolean.
BOOLEAN_TEXT = rf"\A{_STRIPPED}(?i:t|true|y|yes|1|f|false|n|no|0){_STRIPPED}\z"

_TYPE_NAMES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
}


def as_type(name_or_type: str | T.DataType) -> T.DataType:
    if isinstance(name_or_type, T.DataType):
        return name_or_type
    return _TYPE_NAMES[name_or_type]


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_to_integer(c: ColumnOrName, target: str | T.DataType = "int") -> Column:
    """Integer from text, as the permissive cast does it, without failing.

    ``"12.7"`` -> 12, ``"-0.9"`` -> 0, ``".5"`` and ``"."`` -> 0, ``"\\t12"`` -> 12,
    ``"1e3"``/``"abc"``/``""`` -> NULL, out of range -> NULL.
    """
    target_type = as_type(target)
    text = _col(c).cast("string")
    # What a double holds exactly, to the digit: one regex and one parse. The
    # others are validated by a regex, and only validated digits reach the cast,
    # which strips them itself (a failing cast costs a thrown exception per
    # value, ~15 us).
    exact = F.when(text.rlike(SHORT_NUMBER[type(target_type)]), text.try_cast("double").try_cast(target_type)) \
        if type(target_type) in SHORT_NUMBER else F
    return exact.when(
        text.rlike(INTEGER_TEXT),
        F.when(text.rlike(DECIMALS_ALONE), F.lit(0).cast(target_type))
        .otherwise(F.substring_index(text, ".", 1).try_cast(target_type)))


def safe_cast(c: ColumnOrName, target: str | T.DataType,
              source: T.DataType | None = None) -> Column:
    """Cast that yields NULL instead of an error.

    ``source`` is the type of ``c`` when known; text going to an integer type
    uses :func:`text_to_integer`. Numbers going to an integer type truncate,
    and NULL on overflow (the old runtime wrapped around, which gives a wrong
    id; documented deviation).
    """
    target_type = as_type(target)
    col = _col(c)
    if isinstance(target_type, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        if source is None or isinstance(source, T.StringType):
            return text_to_integer(col, target_type)
        return col.try_cast(target_type)
    if isinstance(target_type, T.StringType):
        # Every type has a text form; a plain cast cannot fail.
        return col.cast(target_type)
    if isinstance(target_type, T.BooleanType) and isinstance(source, T.StringType):
        # other text would cost a thrown exception a value
        return F.when(col.rlike(BOOLEAN_TEXT), col.try_cast(target_type))
    return col.try_cast(target_type)


def epoch_ms_to_timestamp(c: ColumnOrName, source: T.DataType | None = None) -> Column:
    """Unix epoch milliseconds (number or text) to a timestamp.

    Uses exact integer milliseconds; the ``seconds / 1000`` double form is a
    microsecond off for negative sub-second values.
    """
    return F.timestamp_millis(safe_cast(c, "long", source))


def timestamp_text(c: ColumnOrName) -> Column:
    """Timestamp as text in the session time zone (O44):
    ``2023-11-14 22:13:20.123`` -- no ``T``, no zone, trailing zeros dropped."""
    return _col(c).cast("string")


def last_element(array_path: str, field: str | None = None) -> Column:
    """Field of the last element of an array, NULL when the array is NULL or
    empty or its last element is NULL (O33, O34).

    ``array_path`` may be a nested path such as ``"evento.rateio"``. Taking
    the field first (``arr.field``) and then the last item lets the Parquet
    reader prune the read to that one nested field.
    """
    target = f"{array_path}.{field}" if field else array_path
    return F.try_element_at(F.col(target), F.lit(-1))


def last_of(c: Column) -> Column:
    """Last element of an array column; NULL for NULL or empty arrays."""
    return F.try_element_at(c, F.lit(-1))


def first_element(c: ColumnOrName) -> Column:
    """First element, NULL when NULL or empty."""
    return F.try_element_at(_col(c), F.lit(1))


def has_elements(c: ColumnOrName) -> Column:
    """True when the array has at least one element; false for empty and
    for NULL arrays (O37)."""
    return F.coalesce(F.size(_col(c)) > 0, F.lit(False))


def non_empty(c: ColumnOrName) -> Column:
    """Predicate: array is not NULL and has elements."""
    col = _col(c)
    return col.isNotNull() & (F.size(col) > 0)


def complex_text(c: ColumnOrName, as_json: bool = False) -> Column:
    """Nested value as text (O39): Spark's text form (``[{1, x}, null]``,
    what the original produces) or, as an opt-in, JSON."""
    return F.to_json(_col(c)) if as_json else _col(c).cast("string")


def surrogate_key(*parts: ColumnOrName, sep: str = "-") -> Column:
    """Text key joined by ``sep``; NULL parts are skipped."""
    return F.concat_ws(sep, *[_col(p) for p in parts])


def audit_timestamp(run_ts: str | None = None) -> Column:
    """Load-time audit column as text.

    ``run_ts`` is the run's timestamp text, the same for every table of one
    run; without it the query's own ``current_timestamp`` is used.
    """
    if run_ts is None:
        return F.current_timestamp().cast("string")
    return F.lit(run_ts).cast("string")


def default_or(c: ColumnOrName, default) -> Column:
    """``coalesce(c, default)``."""
    return F.coalesce(_col(c), F.lit(default))


def tag(value: str) -> Column:
    """Constant text tag column."""
    return F.lit(value).cast("string")

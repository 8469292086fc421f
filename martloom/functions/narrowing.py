"""Casts to a table's declared column types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WIDTH = {T.ByteType(): 1, T.ShortType(): 2, T.IntegerType(): 4, T.LongType(): 8}
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def _always_fits(source: T.DataType | None, to: T.DataType) -> bool:
    if source is None:
        return False
    if isinstance(to, T.DoubleType) or isinstance(to, T.FloatType) and not isinstance(source, T.DoubleType):
        # No decimal reaches the range of a float; a double does.
        return isinstance(source, T.NumericType)
    if source in _WIDTH and to in _WIDTH:
        return _WIDTH[source] <= _WIDTH[to]
    return isinstance(to, T.StringType) and isinstance(source, T.AtomicType)


def _in_range(column: Column, source: T.DataType | None, to: T.DataType) -> Column | None:
    """Whether a number fits an integer type, where bounds can tell. A fraction
    is cut off, so everything short of the next integer fits."""
    if to not in _WIDTH:
        return None
    limit = 2 ** (8 * _WIDTH[to] - 1)
    if source in _WIDTH:
        return column.between(-limit, limit - 1)
    if isinstance(source, _FRACTIONAL) and to != T.LongType():
        return (column > -limit - 1) & (column < limit)
    return None


def _finite(cast: Column, column: Column, source: T.DataType | None, to: T.DataType) -> Column:
    """``cast`` to a fraction, NULL where it became infinite and the value is
    not; a text may say so itself."""
    if not isinstance(to, (T.FloatType, T.DoubleType)):
        return cast
    infinite = [F.lit(float("inf")).cast(to), F.lit(float("-inf")).cast(to)]
    if isinstance(source, T.DoubleType):
        meant = column.isin(float("inf"), float("-inf"))
    else:
        meant = F.lower(F.trim(column.cast("string"))).rlike("^[+-]?inf(inity)?$")
    return F.when(cast.isin(*infinite) & ~meant, F.lit(None).cast(to)).otherwise(cast)


def narrow(
    column: Column,
    to: T.DataType,
    label: str,
    on_overflow: str = "raise",
    source: T.DataType | None = None,
) -> Column:
    """Cast that either fails or yields NULL for a value that does not fit.

    Both choices are spelled out, so neither depends on the session's ANSI
    setting. A known ``source`` type that always fits needs no check; numbers
    are compared with the bounds, which is far cheaper than a failing cast.
    """
    if on_overflow not in ("raise", "null"):
        raise ValueError(f"on_overflow must be 'raise' or 'null', got {on_overflow!r}")
    if _always_fits(source, to):
        return column.cast(to)
    fits = _in_range(column, source, to)
    cast = F.when(fits, column.cast(to)) if fits is not None else _finite(column.try_cast(to), column, source, to)
    if on_overflow == "null":
        return cast
    message = F.concat(
        F.lit(f"{label}: value does not fit {to.simpleString()}: "), column.cast("string")
    )
    lost = column.isNotNull() & cast.isNull() if fits is None else ~fits
    return F.when(lost, F.raise_error(message).cast(to)).otherwise(
        cast if fits is None else column.cast(to)
    )


def narrow_to(df: DataFrame, schema: T.StructType, on_overflow: str = "raise") -> DataFrame:
    """Columns of ``schema``, matched by name, in its order and types."""
    wanted, given = schema.fieldNames(), df.columns
    missing = [name for name in wanted if name not in given]
    extra = [name for name in given if name not in wanted]
    if missing or extra:
        raise ValueError(f"columns do not match the table: missing {missing}, unknown {extra}")
    types = {field.name: field.dataType for field in df.schema}

    def fitted(field: T.StructField) -> Column:
        column, source = F.col(f"`{field.name}`"), types[field.name]
        if source == field.dataType:
            return column
        return narrow(column, field.dataType, field.name, on_overflow, source).alias(field.name)

    return df.select(*(fitted(field) for field in schema))

"""Numeric casts with the rounding rules of the data contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def to_int(df: DataFrame, name: str) -> Column:
    """Cast a column to int, null when it is no number or does not fit.

    Text rounds half away from zero, floating point rounds half to even and
    whole numbers pass through.
    """
    kind, c = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.StringType):
        # Decimal and exponent forms, single underscores between digits, and 0x with digits;
        # a type suffix as in 12d makes it no number.
        shown = F.regexp_replace(F.trim(c), r"(?<=[0-9A-Fa-f])_(?=[0-9A-Fa-f])", "")
        plain = F.when(shown.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), shown)
        coded = F.when(shown.rlike("^0[xX][0-9A-Fa-f]+$"), F.conv(F.substring(shown, 3, 64), 16, 10))
        return F.coalesce(coded.try_cast("int"), F.round(plain.try_cast("double")).try_cast("int"))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.rint(c).try_cast("int")
    if isinstance(kind, T.DecimalType):
        return F.round(c).try_cast("int")
    return c.try_cast("int")


def ratio(top: Column, bottom: Column) -> Column:
    """Division that is null, never an error, over zero."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))


def sum_when(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def scaled_short(c: Column, scale: int, clip: float) -> Column:
    """Clip to [0, clip], scale, round half to even, store in 16 bits."""
    clipped = F.least(F.greatest(c, F.lit(0.0)), F.lit(float(clip)))
    return F.rint(clipped * F.lit(scale)).cast("short")

"""Null, sentinel and text normalisation as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_or_null(c: Column) -> Column:
    """String value, NULL for NULL, NaN, blank or the literal MISSING."""
    s = F.trim(c.cast("string"))
    return F.when(~s.isin("", "MISSING", "NaN"), c.cast("string"))


def is_missing(c: Column) -> Column:
    return text_or_null(c).isNull()


def number(c: Column, default: float | None = None) -> Column:
    """Double value of anything; unparsable, NaN and sentinel values give the default."""
    d = c.cast("string").try_cast("double")
    d = F.when(~F.isnan(d), d)
    return d if default is None else F.coalesce(d, F.lit(float(default)))


def number_in(df: DataFrame, name: str, default: float | None = None) -> Column:
    """``number`` of a column; one that is numeric already is not spelled out and read again."""
    if df.schema[name].dataType.typeName() not in ("double", "float", "integer", "long"):
        return number(F.col(name), default)
    d = F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))
    return d if default is None else F.coalesce(d, F.lit(float(default)))


def missing_in(df: DataFrame, name: str) -> Column:
    """``is_missing`` of a column, without spelling out numbers."""
    kind = df.schema[name].dataType.typeName()
    if kind in ("integer", "long"):
        return F.col(name).isNull()
    return F.col(name).isNull() | F.isnan(name) if kind in ("double", "float") else is_missing(F.col(name))


def finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def none_text(c: Column) -> Column:
    """Text spellings of a null ("None", "nan", "null", "") become NULL."""
    return F.when(~F.lower(F.trim(c)).isin("none", "nan", "null", ""), c)


def upper_text(c: Column) -> Column:
    return F.upper(F.trim(c))


def fill(c: Column, value) -> Column:
    return F.coalesce(c, F.lit(value))


def zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def flag(cond: Column) -> Column:
    """0/1 integer; an unknown condition counts as false."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def at_least(c: Column, low: float) -> Column:
    """Clip below; unlike greatest() a NULL stays NULL."""
    return F.when(c < low, F.lit(float(low))).otherwise(c)


def clip(c: Column, low: float, high: float) -> Column:
    return F.when(c < low, F.lit(float(low))).when(c > high, F.lit(float(high))).otherwise(c)


def lookup(c: Column, mapping: dict, default=None) -> Column:
    """Small fixed mapping as a CASE, cheaper than a map literal under codegen."""
    expr = None
    for k, v in mapping.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr if default is None else expr.otherwise(F.lit(default))


def half_up(c: Column, digits: int = 0) -> Column:
    """``round`` of a double. Only next to a tie is the number spelled out in decimals, which takes longer than all else in a row."""
    y = c * 10.0**digits if digits else c
    near = F.floor(y + 0.5)
    clear = (F.abs(y) < 1e9) & (F.abs(y - near) < 0.499999)
    return F.when(clear, near / F.lit(10.0**digits)).otherwise(F.round(c, digits))


def grade_letter(c: Column) -> Column:
    """First letter of a production grade such as 'C3'; blank gives NULL."""
    s = F.trim(c)
    return F.when(s != "", F.substring(s, 1, 1))


def display(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1000)))


def money(c: Column) -> Column:
    """$1,234 with half-even rounding; amounts that round to zero have no sign."""
    return F.concat(F.lit("$"), F.format_number(F.bround(c).cast("bigint"), 0))


def percent(c: Column) -> Column:
    """12.3% with half-even rounding."""
    return F.concat(F.format_number(c * 100, 1), F.lit("%"))


def whole(c: Column) -> Column:
    """Truncated to an integer, as text."""
    return c.cast("bigint").cast("string")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Every NaN of every float column to NULL (Spark sorts NaN above all numbers)."""
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df

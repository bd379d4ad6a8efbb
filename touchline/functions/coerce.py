"""Null, number and id clean-up of text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.schemas import NA_TOKENS


def null_if_missing(text: Column) -> Column:
    """Null for every text a CSV reader takes for a missing value."""
    return F.when(~text.isin(*NA_TOKENS), text)


def strip_decimal_suffix(text: Column) -> Column:
    """Drop one trailing ``.0``, the trace of an id that was read as a float."""
    kept = F.left(text, F.length(text) - 2)
    return F.when(F.endswith(text, F.lit(".0")), kept).otherwise(text)


def try_double(text: Column) -> Column:
    """Null unless the text is a plain number (no Java ``d``/``f`` suffix)."""
    last = F.lower(F.right(F.rtrim(text), F.lit(1)))
    return F.when(~last.isin("d", "f"), text.try_cast("double"))


def int_or_zero(text: Column) -> Column:
    """Truncate to int; 0 when the text is no number or out of range."""
    return F.coalesce(try_double(text).try_cast("int"), F.lit(0))


def float_or_zero(text: Column) -> Column:
    """Float32 value; 0 when the text is no number."""
    number = try_double(text)
    return F.coalesce(F.when(~F.isnan(number), number).try_cast("float"), F.lit(0.0).cast("float"))


def id_text(column: Column, data_type: str) -> Column:
    """Text of an id column; a whole floating number prints without exponent."""
    if data_type in ("float", "double"):
        whole = column == F.floor(column)
        return F.when(whole, F.floor(column).cast("string")).otherwise(column.cast("string"))
    return column.cast("string")


def clamp(value: Column, low: float = 0.0, high: float = 100.0) -> Column:
    """Limit a coordinate to the pitch; null stays null."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))

"""Bring raw text frames into the declared warehouse schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType, IntegerType, StructField

from touchline.functions import coerce
from touchline.operators.recent import latest_per_key
from touchline.schemas import FACTS, WarehouseTable


def _default(field: StructField) -> Column:
    if isinstance(field.dataType, FloatType):
        return F.lit(0.0).cast("float")
    if isinstance(field.dataType, IntegerType):
        return F.lit(0)
    return F.lit("")


def _clean(field: StructField, source_type: str, strip: bool) -> Column:
    text = coerce.null_if_missing(coerce.id_text(F.col(field.name), source_type))
    if isinstance(field.dataType, FloatType):
        return coerce.float_or_zero(text)
    if isinstance(field.dataType, IntegerType):
        return coerce.int_or_zero(text)
    text = F.coalesce(text, F.lit(""))
    return coerce.strip_decimal_suffix(text) if strip else text


def normalise(
    raw: DataFrame,
    table: WarehouseTable,
    strip_columns: tuple[str, ...] | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Rename, pad missing columns, drop extra ones, fill nulls and cast.

    Columns come out in declared order. ``strip_columns`` lose a trailing
    ``.0``: by default the ids of a fact table, and every text column of a
    dimension (names included). ``keep`` names further columns to pass through.
    """
    if strip_columns is None:
        strip_columns = table.id_columns if table is FACTS else tuple(table.columns)
    renamed = raw.withColumnsRenamed(table.rename)
    types = dict(renamed.dtypes)
    return renamed.select(
        *[
            (
                _clean(field, types[field.name], field.name in strip_columns)
                if field.name in types
                else _default(field)
            ).alias(field.name)
            for field in table.schema
        ],
        *keep,
    )


def dedupe(dimension: DataFrame, key: tuple[str, ...], load_order: str) -> DataFrame:
    """Keep the row loaded last per key; drops the load order column."""
    return latest_per_key(dimension, key, [load_order])

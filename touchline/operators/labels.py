"""Texts for event codes, from a code dictionary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_labels(
    rows: DataFrame,
    dictionary: DataFrame,
    codes: dict[str, str],
    labels: dict[str, str],
) -> DataFrame:
    """Left join of dictionary labels; the code itself where there is none.

    ``codes`` maps row columns to dictionary columns, ``labels`` maps dictionary
    label columns to output names. Codes compare as text.
    """
    keys = {f"__{name}": F.col(name).cast("string") for name in codes.values()}
    texts = {f"__{name}": F.col(name) for name in labels}
    lookup = dictionary.select(*[c.alias(n) for n, c in {**keys, **texts}.items()])
    matches = [rows[left].cast("string") == lookup[f"__{right}"] for left, right in codes.items()]
    fallback = F.concat_ws("/", *[rows[left].cast("string") for left in codes])
    return rows.join(lookup, matches, "left").select(
        *rows.columns,
        *[F.coalesce(lookup[f"__{name}"], fallback).alias(out) for name, out in labels.items()],
    )


def code_list(text: Column) -> Column:
    """The codes of a list in text form, such as ``[{'id': 101}, {'id': 1801}]``, in order."""
    return F.regexp_extract_all(text, F.lit("[0-9]+"), F.lit(0))


def with_label_lists(
    rows: DataFrame,
    key: tuple[str, ...],
    codes: str,
    dictionary: DataFrame,
    code: str = "tag",
    label: str = "label",
    out: str = "labels",
) -> DataFrame:
    """Add the labels of a column of code lists, in their order; a code without one stands for
    itself. ``key`` tells rows apart; a row without codes gets an empty list."""
    each = rows.select(*key, F.posexplode(codes).alias("__place", "__code"))
    lookup = dictionary.select(F.col(code).cast("string").alias("__code"), F.col(label).alias("__label"))
    named = each.join(lookup, "__code", "left").select(
        *key, F.struct("__place", F.coalesce("__label", "__code").alias("text")).alias("__named")
    )
    lists = named.groupBy(*key).agg(F.sort_array(F.collect_list("__named"))["text"].alias(out))
    none = F.array().cast("array<string>")
    return rows.join(lists, [*key], "left").withColumn(out, F.coalesce(out, none))

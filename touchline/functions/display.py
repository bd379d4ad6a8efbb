"""Presentation columns: labels, markers, colours and number formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline import schemas


def _lookup(key: Column, table: dict, default) -> Column:
    pairs = [F.lit(item) for pair in table.items() for item in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def marker(event_type: Column) -> Column:
    return _lookup(event_type, schemas.MARKERS, schemas.DEFAULT_MARKER)


def marker_size(event_type: Column) -> Column:
    return _lookup(event_type, schemas.MARKER_SIZES, schemas.DEFAULT_MARKER_SIZE)


def team_colour(team_name: Column, name_a: Column, name_b: Column) -> Column:
    """Colour by configured team name; the away side wins a shared name."""
    return (
        F.when(team_name == name_b, F.lit(schemas.COLOUR_B))
        .when(team_name == name_a, F.lit(schemas.COLOUR_A))
        .otherwise(F.lit(schemas.DEFAULT_COLOUR))
    )


def glow_colour(colour: Column) -> Column:
    return F.when(colour == schemas.COLOUR_A, F.lit(schemas.GLOW_A)).otherwise(
        F.lit(schemas.GLOW_OTHER)
    )


def short_label(name: Column, fallback: Column) -> Column:
    """Last word of a name, cut to ten characters; the fallback if no name."""
    word = F.when(name.isNotNull(), F.regexp_extract(name, r"(\S+)\s*$", 1)).otherwise(fallback)
    return F.substring(word, 1, schemas.LABEL_LENGTH)


def title_case(text: Column) -> Column:
    """Capitalise each run of letters, also after a hyphen or a digit."""
    runs = F.split(F.lower(text), r"(?<=\P{L})")
    return F.array_join(F.transform(runs, F.initcap), "")


def legend_label(team_name: Column, event_type: Column) -> Column:
    return F.concat_ws(" ", team_name, title_case(event_type))


def percent_text(share: Column) -> Column:
    """One decimal and a percent sign; ties round half up."""
    return F.format_string("%.1f%%", share)


def thousands_text(number: Column) -> Column:
    return F.format_number(number, 0)

"""Lookups in small fixed tables, written as expressions."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def constant(value: object) -> str:
    """SQL text of a constant: text, number, NULL or a list of these."""
    if value is None:
        return "NULL"
    if isinstance(value, (list, tuple)):
        return f"array({', '.join(map(constant, value))})"
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    return str(value)


def literal_list(values: Sequence[object]) -> Column:
    """A constant array, parsed in one go instead of value by value."""
    return F.expr(constant(list(values)))


def literal_table(spark: SparkSession, columns: Sequence[str], rows: Iterable[Sequence[object]]) -> DataFrame:
    """A small constant table, held in the plan itself (no Python rows, no file)."""
    values = ", ".join(f"({', '.join(map(constant, row))})" for row in rows)
    names = ", ".join(f"`{name}`" for name in columns)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})")


def given_table(spark: SparkSession, schema: str, rows: Iterable[Mapping[str, object]]) -> DataFrame:
    """A small table of values that come from data, held in the plan as one constant (not as SQL text)."""
    text = json.dumps(list(rows), ensure_ascii=True)
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{schema}>>")))


def literal_map(table: Mapping[str, object]) -> Column:
    """A constant map; Catalyst folds it, so a row pays for the lookup only."""
    return F.expr(f"map({', '.join(constant(cell) for pair in table.items() for cell in pair)})")


def lookup(table: Mapping[str, object], key: Column, default: object = None) -> Column:
    """``table[key]``, or ``default`` for an unknown or NULL key."""
    found = F.try_element_at(literal_map(table), key)
    if default is None:
        return found
    return F.coalesce(found, F.expr(constant(default)))


def contains_any(text: Column, words: Iterable[str]) -> Column:
    return reduce(lambda seen, word: seen | text.contains(word), words, F.lit(False))


def first_contained(text: Column, table: Iterable[tuple[str, object]], default: object = None) -> Column:
    """Value of the first key that occurs in ``text``, ignoring case.

    The keys are tried in table order inside one CASE, so there is no join and
    no pair of rows to rank afterwards.
    """
    lowered = F.lower(text)
    found = None
    for key, value in table:
        hit = lowered.contains(key.lower())
        found = F.when(hit, F.lit(value)) if found is None else found.when(hit, F.lit(value))
    return found.otherwise(F.lit(default))


def split_location(text: Column) -> tuple[Column, Column]:
    """``"City, Country"`` -> (city, country)."""
    parts = F.split(text, ",")
    return F.trim(F.get(parts, 0)), F.trim(F.get(parts, 1))

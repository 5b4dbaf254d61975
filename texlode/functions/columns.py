"""Small helpers to build column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often it is used."""
    return F.transform(F.array(value), body)[0]


def sub(value: Column, pattern: str, replacement: str = "") -> Column:
    return F.regexp_replace(value, F.lit(pattern), F.lit(replacement))


def sub_if(value: Column, needle: str, pattern: str, replacement: str = "") -> Column:
    """Regex replacement behind a plain substring test, which is far cheaper."""
    return let(
        value,
        lambda v: F.when(F.contains(v, F.lit(needle)), sub(v, pattern, replacement)).otherwise(v),
    )


def find_all(value: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(value, F.lit(pattern), F.lit(group))


def swap(value: Column, old: str, new: str) -> Column:
    return F.replace(value, F.lit(old), F.lit(new))


def fold_replace(value: Column, items: Column, new: Callable[[Column], Column]) -> Column:
    """Replace each string of ``items`` in turn, literally and everywhere."""
    return F.aggregate(items, value, lambda text, item: F.replace(text, item, new(item)))

"""Small Column helpers shared by the other function modules."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def lookup(mapping: Mapping[str, str | int], key: Column) -> Column:
    """Value of a small fixed mapping, NULL for an unknown key."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), key)


def blank(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def round_half_even(c: Column, digits: int = 0) -> Column:
    return F.bround(c, digits)


def round_half_up(c: Column) -> Column:
    return F.floor(c + F.lit(0.5))

"""Metadata filter dictionaries compiled to one predicate.

Forms: ``{"f": v}``, ``{"f <=": v}`` (also ``<``, ``>``, ``>=``), ``{"f": (a, b)}``
for IN, ``{"f OR g": [a, b]}`` paired by position, ``{"f NOT": v}``. Entries are
ANDed; a NULL field matches neither a condition nor its NOT.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARE = {
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
}


def _matches(c: Column, value: Any) -> Column:
    return c.isin(*value) if isinstance(value, (list, tuple)) else c == F.lit(value)


def compile_filter(filters: Mapping[str, Any], columns: Iterable[str]) -> Column:
    """One predicate over ``columns``; unknown names and operators raise ``ValueError``."""
    known = set(columns)

    def field(name: str) -> Column:
        if name not in known:
            raise ValueError(f"unknown filter column: {name!r}")
        return F.col(name)

    def one(key: str, value: Any) -> Column:
        names = key.split(" OR ")
        if len(names) > 1:
            if not isinstance(value, (list, tuple)) or len(value) != len(names):
                raise ValueError(f"{key!r} needs one value per field")
            return reduce(lambda a, b: a | b, [_matches(field(n), v) for n, v in zip(names, value)])
        name, _, operator = key.partition(" ")
        if not operator:
            return _matches(field(name), value)
        if operator == "NOT":
            return ~_matches(field(name), value)
        if operator in _COMPARE:
            return _COMPARE[operator](field(name), F.lit(value))
        raise ValueError(f"unknown filter operator: {operator!r}")

    if not filters:
        return F.lit(True)
    return reduce(lambda a, b: a & b, [one(k, v) for k, v in filters.items()])

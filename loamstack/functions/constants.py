"""Constant lists and tables as one parsed expression each: a call for every value makes large plans slow to build."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal(value: str | int) -> str:
    """A value as it stands in an expression."""
    return str(value) if isinstance(value, int) else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def listed(values) -> str:
    return f"array({', '.join(map(literal, values))})" if len(values) else "cast(array() as array<string>)"


def array(values) -> Column:
    """A constant array; an empty one is of strings."""
    return F.expr(listed(values))


def table(pairs: dict[str, str]) -> Column:
    """A constant map; values are expressions."""
    return F.expr(f"map({', '.join(f'{literal(k)}, {v}' for k, v in pairs.items())})")


def look(pairs: dict, key: Column) -> Column:
    """The value of ``key`` in a constant map, null if it isn't there."""
    return F.try_element_at(table({k: literal(v) for k, v in pairs.items()}), key)

"""Small helpers for building column expressions.

Longer expressions are kept as SQL text of a lambda: one call to the JVM builds
what would otherwise take hundreds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column] | str) -> Column:
    """``body`` of ``value``, with ``value`` computed once per row.

    ``body`` is a function of a Column, or the text of a SQL lambda. Inside a
    lambda a column that the optimizer has folded into the expression would be
    computed again for every element; a lambda variable is not.
    """
    if isinstance(body, str):
        return each(F.array(value), body)[0]
    return F.transform(F.array(value), body)[0]


def each(values: Column, body: str) -> Column:
    """``transform(values, body)`` with the lambda given as SQL text."""
    return F.call_function("transform", values, F.expr(body))


def let_sql(value: str, name: str, body: str) -> str:
    """The same binding inside SQL text."""
    return f"transform(array({value}), {name} -> {body})[0]"


def bucket(key: Column, buckets: int) -> Column:
    """Folder number of a key in the stored tables."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

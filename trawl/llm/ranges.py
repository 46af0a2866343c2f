"""Rows next to each other in a global order, found without a global sort in one task."""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a range. The driver holds two keys of each range.
ROWS_PER_RANGE = 4_000


def key_ranges(
    rows: DataFrame, keys: Sequence[Column], per_range: int = ROWS_PER_RANGE
) -> list[tuple[tuple, tuple]]:
    """First and last key of ranges of about ``per_range`` rows, ascending.

    ``keys`` must not be null. Equal keys are in one range.
    """
    slim = rows.select(F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)]).alias("key"))
    parts = max(1, math.ceil(rows.count() / per_range))
    cols = [F.col(f"key.k{i}") for i in range(len(keys))]
    found = (
        slim.repartitionByRange(parts, *cols)
        .groupBy(F.spark_partition_id().alias("part"))
        .agg(F.min("key").alias("low"), F.max("key").alias("high"))
        .select("low", "high").collect()
    )
    return sorted((tuple(r["low"]), tuple(r["high"])) for r in found)


def placed(
    rows: DataFrame,
    keys: Sequence[Column],
    ranges: list[tuple[tuple, tuple]],
    below: bool = True,
    above: bool = True,
    wrap: bool = False,
) -> DataFrame:
    """``rows`` with ``at.range`` and ``at.role``, 0 in their own range.

    The first row of a range comes again in the range below it with role 1
    (``below``), the last one in the range above with role -1 (``above``); with
    ``wrap`` the very last one also in the lowest range. So each range, dealt to
    a task by its number, holds the neighbours of all its rows.
    """
    highs = [high for _, high in ranges]
    lows = {low: i for i, (low, _) in enumerate(ranges)}
    tops = {high: i for i, high in enumerate(highs)}

    @F.arrow_udf("array<struct<range:int,role:int>>")
    def places(*columns: pa.Array) -> pa.Array:
        out = []
        for key in zip(*[c.to_pylist() for c in columns]):
            at = [{"range": bisect_left(highs, key), "role": 0}]
            if below and lows.get(key, 0) > 0:
                at.append({"range": lows[key] - 1, "role": 1})
            if above and (top := tops.get(key)) is not None:
                if top + 1 < len(highs):
                    at.append({"range": top + 1, "role": -1})
                elif wrap:
                    at.append({"range": 0, "role": -1})
            out.append(at)
        kind = pa.list_(pa.struct([("range", pa.int32()), ("role", pa.int32())]))
        return pa.array(out, kind)

    return rows.select("*", F.explode(places(*keys)).alias("at"))


def by_range(rows: DataFrame, ranges: list, *order: Column | str) -> DataFrame:
    """Rows of :func:`placed` dealt by ``range``, as many tasks as ranges, and sorted.

    So a task reads a few ranges, however many there are.
    """
    tasks = max(1, len(ranges))
    return rows.repartition(tasks, "range").sortWithinPartitions("range", *order)

"""Split the timeline of keys that hold too many rows for one task.

A window over one key runs in one task, and an equi-join by key brings all its rows together. Both break when one key holds
a large share of the data. Such rows are dealt by range of (key, time) instead: Spark samples them, so neither a burst nor a
date that stands for something else makes a range larger than others, and any type that can be sorted will do. What a range
must know of those before and behind it is one row per key and range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import written

# Rows of one key that a single window task takes without trouble (it spills, but does not straggle).
ROWS_PER_SLICE = 4_000_000

KEY, SLICE = "__key", "__slice"


def key_struct(keys: Sequence[str]) -> Column:
    """All keys as one value. Structs compare with NULL equal to NULL, so a NULL key is a group like any other."""
    return F.struct(*[F.col(k) for k in keys])


def heavy_keys(df: DataFrame, keys: Sequence[str], at: str | None, rows_per_slice: int) -> DataFrame | None:
    """``__key, __n`` of the keys that hold more than ``rows_per_slice`` rows; None when there is no such key.

    Reads only the key and time columns and counts before it shuffles. Rows without a time are not counted; without ``at``
    all rows are. The result has fewer than
    ``rows / rows_per_slice`` rows.
    """
    narrow = (df.where(F.col(at).isNotNull()) if at else df).select(key_struct(keys).alias(KEY))
    heavy = written(narrow.groupBy(KEY).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > rows_per_slice), "heavy-keys")
    return None if heavy.isEmpty() else heavy


def in_ranges(df: DataFrame, order: Sequence[str], ranges: int, rows_per_slice: int | None = None) -> DataFrame:
    """The rows, stored once, with the number of the range of ``order`` that they lie in: about equally many in each, rows
    equal in ``order`` in the same.

    A range takes a task, and the driver a sample of rows for each. Where no rows are equal in ``order``, give
    ``rows_per_slice``: more ranges than a shuffle has tasks are then cut within these tasks.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if rows_per_slice and ranges > tasks:
        # Counts the rows of a task in their order; numbers of later tasks are higher.
        number = F.monotonically_increasing_id()
        placed = df.repartitionByRange(tasks, *order).sortWithinPartitions(*order).withColumn(SLICE, number)
        place = F.col(SLICE) % F.lit(1 << 33)
        return written(placed.withColumn(SLICE, F.col(SLICE) - place % F.lit(rows_per_slice)), "ranges")
    dealt = df.repartitionByRange(max(1, ranges), *order).withColumn(SLICE, F.spark_partition_id())
    return written(dealt, "ranges")


def rows_of(df: DataFrame, heavy: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of heavy keys, with the key struct."""
    return df.withColumn(KEY, key_struct(keys)).join(heavy.select(KEY), KEY, "left_semi")


def other_rows(df: DataFrame, heavy: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of all other keys."""
    return df.withColumn(KEY, key_struct(keys)).join(heavy, KEY, "left_anti").drop(KEY)

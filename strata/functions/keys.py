"""Hash keys and the total order of change events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns that differ between two readings of the same source row, so they never take part in ordering.
VOLATILE_COLUMNS = (
    "ingestion_ts",
    "processed_ts",
    "gold_processed_ts",
    "ingest_batch",
    "__bucket",
    "__part",
    "__gen",
)

_HEX, _PLAIN = bytearray(b"\x01"), bytearray(b"\x00")


def surrogate_key(*columns: str | Column, separator: str = "||") -> Column:
    """SHA-256 hex digest of the columns joined by ``separator``; NULL parts are skipped."""
    return F.sha2(F.concat_ws(separator, *[_col(c).cast("string") for c in columns]), 256)


def packed(text: Column) -> Column:
    """Text as bytes, lower-case hex digits (surrogate keys) in half as many, for rows that are shuffled. NULL stays."""
    digits = F.unhex(text)
    marked = lambda mark, value: F.concat(F.lit(mark), value)
    return F.when(F.lower(F.hex(digits)) == text, marked(_HEX, digits)).otherwise(marked(_PLAIN, text.cast("binary")))


def unpacked(value: Column) -> Column:
    """The text of :func:`packed`."""
    rest = F.substring(value, 2, 2**31 - 1)
    return F.when(F.substring(value, 1, 1) == F.lit(_HEX), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def row_hash(df: DataFrame, ignore: Sequence[str] = VOLATILE_COLUMNS) -> Column:
    """64-bit hash of a row's content.

    Columns are taken by name order and Spark's hash passes over NULLs, so a column that is added later (NULL in older
    rows) leaves the hash of older rows as it was.
    """
    names = sorted(
        f.name for f in df.schema.fields if f.name not in ignore and not _has_map(f.dataType)
    )
    return F.xxhash64(*[F.col(f"`{n}`") for n in names]) if names else F.lit(0).cast("bigint")


def event_order(
    df: DataFrame, sequence_by: str | Column, tie_break: Sequence[str] | None = None
) -> list[Column]:
    """(sequence, tie-break columns, row hash): the same total order in every batch and arrival order.

    Without an explicit ``tie_break`` the source file decides between events of equal sequence, if it is known: the one
    modified last, of equally old ones the last by name.
    """
    return [_col(sequence_by), *[F.col(c) for c in _ties(df, tie_break)], row_hash(df)]


def order_columns(
    df: DataFrame, sequence_by: str | Column, tie_break: Sequence[str] | None = None
) -> tuple[list[str], dict[str, Column]]:
    """The same order as column names, and those of them that have to be added to the frame."""
    by_name = isinstance(sequence_by, str)
    sequence = sequence_by if by_name else "__seq"
    added = {"__hash": row_hash(df), **({} if by_name else {sequence: sequence_by})}
    return [sequence, *_ties(df, tie_break), "__hash"], added


def _ties(df: DataFrame, tie_break: Sequence[str] | None) -> Sequence[str]:
    if tie_break is not None:
        return tie_break
    return [c for c in ("file_modified", "file_name") if c in df.columns]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _has_map(t: T.DataType) -> bool:
    if isinstance(t, T.MapType):
        return True
    if isinstance(t, T.ArrayType):
        return _has_map(t.elementType)
    if isinstance(t, T.StructType):
        return any(_has_map(f.dataType) for f in t.fields)
    return False

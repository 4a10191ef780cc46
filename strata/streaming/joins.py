"""A join of two endless streams that forgets rows that can't meet any more."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bounds:
    """``at`` is the event time (timestamp) of both sides. A header lies at most ``within`` before or after its details; rows
    arrive at most ``lateness`` after the newest row of their side (both as SQL intervals: "2 days")."""

    at: str
    within: str
    lateness: str


@dataclass(frozen=True)
class JoinRun:
    """What a run came to: the last watermark, the rows it had dropped for being older, and the rows kept as state after
    each batch (of the last hundred batches)."""

    watermark: str | None
    dropped: int
    state_rows: tuple[int, ...]


def join_header_stream(details: DataFrame, headers: DataFrame, keys: Sequence[str], header_columns: Sequence[str], bounds: Bounds) -> DataFrame:
    """Every detail row with the named columns of its header, as ``join_header``, for streams without end.

    Both sides have a watermark, and the times of a pair differ by at most ``within``. So Spark knows when a stored row can
    meet no row to come, and drops it: the state holds some ``lateness`` + ``within`` of both streams.
    """
    left = details.withWatermark(bounds.at, bounds.lateness)
    named = [F.col(k).alias(f"__{k}") for k in keys]
    right = headers.select(*named, *header_columns, F.col(bounds.at).alias("__at")).withWatermark("__at", bounds.lateness)
    near = F.expr(f"__at BETWEEN {bounds.at} - INTERVAL {bounds.within} AND {bounds.at} + INTERVAL {bounds.within}")
    for k in keys:
        near = near & (F.col(k) == F.col(f"__{k}"))
    return left.join(right, near, "inner").drop("__at", *[f"__{k}" for k in keys])


def run_join(joined: DataFrame, path: str, checkpoint: str) -> JoinRun:
    """Append all pairs that are there to the Parquet files below ``path``, each once."""
    query = (
        joined.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    progress = [p for p in query.recentProgress if p["stateOperators"]]
    marks = [p["eventTime"]["watermark"] for p in progress if p["eventTime"].get("watermark")]
    return JoinRun(
        max(marks, default=None),
        sum(o["numRowsDroppedByWatermark"] for p in progress for o in p["stateOperators"]),
        tuple(sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in progress),
    )


def given_up(details: DataFrame, joined: DataFrame, row_keys: Sequence[str], bounds: Bounds, watermark: str) -> DataFrame:
    """The detail rows, of a batch read, that the stream will never join: they came later than the watermark allows, or
    their header did not come in time. With the reason, for quarantine."""
    past = F.col(bounds.at) < F.expr(f"TIMESTAMP '{watermark}' - INTERVAL {bounds.within}")
    missed = details.where(past).join(joined.select(*row_keys), list(row_keys), "left_anti")
    return missed.withColumn("quarantine_reason", F.lit("no header in time"))

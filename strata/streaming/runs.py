"""Run a stream over what is there, and stop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from strata.session import settings

# State grows with the rows that may still be joined, so it lies on the disks of executors and not in their heaps; a bounded
# cache is all the memory it takes.
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


def run_available(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand all available input to ``handle`` in micro-batches and wait for the end."""
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def append_flow(stream: DataFrame, table: str, checkpoint: str, path: str | None = None) -> DataFrame:
    """Append all available rows of a stream to a named Parquet table, each row once, and return the table.

    State is kept by :data:`STATE_ON_DISK`, unless the session or an older checkpoint says otherwise.
    """
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if path:
        writer = writer.option("path", path)
    with settings(stream.sparkSession, STATE_ON_DISK):
        query = writer.toTable(table)
    query.awaitTermination()
    return stream.sparkSession.read.table(table)

"""Where intermediate tables live: always the folder every executor can reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master may go without that setting: it then gets a temporary folder of its own. On a cluster a missing
    setting is an error, because a machine-local folder is lost with its machine.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="strata-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/strata/{label}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Session settings for a while, as far as nobody has chosen others."""
    ours = {k: v for k, v in values.items() if spark.conf.get(k, None) is None}
    for k, v in ours.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in ours:
            spark.conf.unset(k)


# Shuffle files go when the job that made them ends, and not when the driver happens to collect its garbage.
SHUFFLES_GO = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def written(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Store a frame in the shared folder, well compressed, and read it back.

    Cuts the lineage, survives lost executors, and gives Spark the true size, so that joins with the result are
    broadcast only when they are below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    with settings(spark, SHUFFLES_GO):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a stored frame that nothing will read again."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)

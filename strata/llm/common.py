"""Small helpers of the operators: reading tables, Arrow batches, files in the shared folder."""

from __future__ import annotations

import io
import pathlib
import uuid
import zipfile
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import scratch_path, shared_dir

UID = "__uid"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_text(df: DataFrame, text: str) -> DataFrame:
    """The frame with NULL texts as empty ones."""
    return df.withColumn(text, F.coalesce(F.col(text), F.lit("")))


def positional(df: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """The frame with its columns named by place, so that no name can clash, and the new names of ``names``."""
    places = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*places), [places[df.columns.index(n)] for n in names]


def with_columns(schema: T.StructType, **types: str) -> T.StructType:
    """The schema with more columns at its end. A column of the same name (in any case) gives way to the new one."""
    new = {name.lower() for name in types}
    kept = [f for f in schema.fields if f.name.lower() not in new]
    return T.StructType(kept + [T.StructField(n, T._parse_datatype_string(t)) for n, t in types.items()])


def append_columns(
    df: DataFrame, text: str, make: Callable[[], Callable[[list[str]], tuple]], drop: tuple[str, ...] = (), **types: str
) -> DataFrame:
    """Columns that Python derives from the texts of an Arrow batch; all other columns pass through.

    ``make`` runs once per task and returns the function from texts to one list (or array) per new column.
    """
    whole = with_columns(df.schema, **types)
    schema = T.StructType([f for f in whole.fields if f.name not in drop])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, f = to_arrow_schema(schema), make()
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            made = dict(zip(types, f(texts), strict=True))
            columns = [
                pa.array(made[a.name], a.type) if a.name in made else batch.column(batch.schema.get_field_index(a.name)).cast(a.type)
                for a in arrow
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return arrow_map(df, run, schema)


def numbered(df: DataFrame) -> DataFrame:
    """Adds a number per row. Only what is stored right after is stable: write the frame before using the number."""
    return df.withColumn(UID, F.monotonically_increasing_id())


def arrow_map(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """``mapInArrow`` with this package at hand in the Python workers, wherever the driver imported it from."""
    _ship(df.sparkSession)
    return df.mapInArrow(f, schema)


def _ship(spark: SparkSession) -> None:
    context = spark.sparkContext
    if getattr(context, "_strata_shipped", False):
        return
    package, content = pathlib.Path(__file__).resolve().parent.parent, io.BytesIO()
    with zipfile.ZipFile(content, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    folder, name = shared_dir(spark), f"{package.name}-{uuid.uuid4().hex[:12]}.zip"
    Store(folder).put(name, content.getvalue())
    context.addPyFile(f"{folder}/{name}")
    context._strata_shipped = True


class Store:
    """Files in the shared folder, opened inside tasks. The folder may be in any store that pyarrow can open."""

    def __init__(self, base: str) -> None:
        self.base = base.rstrip("/")
        self.local = urlsplit(self.base).scheme in ("", "file")

    def _open(self) -> tuple[pyarrow.fs.FileSystem, str]:
        if self.local:
            return pyarrow.fs.LocalFileSystem(), urlsplit(self.base).path
        return pyarrow.fs.FileSystem.from_uri(self.base)

    def create(self, name: str) -> tuple[pa.NativeFile, str]:
        """A new file for this attempt of a task: its name ends in a number of its own, so that a repeated attempt
        never touches the file of another. Readers learn the names that count from the rows the task returns."""
        fs, root = self._open()
        fs.create_dir(root, recursive=True)
        own = f"{name}-{uuid.uuid4().hex[:12]}"
        return fs.open_output_stream(f"{root}/{own}"), own

    def put(self, name: str, content: bytes) -> None:
        fs, root = self._open()
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/{name}") as f:
            f.write(content)

    def read(self, name: str) -> np.ndarray:
        """The bytes of a file; mapped into memory where the store is a file system."""
        fs, root = self._open()
        if self.local:
            size = fs.get_file_info(f"{root}/{name}").size
            return np.memmap(f"{root}/{name}", np.uint8, "r") if size else np.empty(0, np.uint8)
        with fs.open_input_file(f"{root}/{name}") as f:
            return np.frombuffer(f.read(), np.uint8)


def stored(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write a frame to the shared folder, well compressed, and read it back: cuts the lineage, and what it holds
    (numbers of rows too) stays the same from then on, whichever executors are lost."""
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a stored frame that nothing will read again."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)

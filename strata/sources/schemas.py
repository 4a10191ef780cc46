"""Remembered schemas that grow when new columns arrive."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaStore:
    """Versions of one schema, each a one-row file in an append-only folder; the newest version counts."""

    _ROW = "version long, schema string"

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._path = spark, path
        spark.createDataFrame([], self._ROW).coalesce(1).write.mode("ignore").parquet(path)

    def load(self) -> T.StructType | None:
        newest = self._newest()
        return T.StructType.fromJson(json.loads(newest.schema)) if newest.version else None

    def save(self, schema: T.StructType) -> None:
        """Keep a schema if it differs from the newest version. Replays therefore add nothing."""
        newest = self._newest()
        text = json.dumps(schema.jsonValue())
        if newest.schema != text:
            row = [((newest.version or 0) + 1, text)]
            self._spark.createDataFrame(row, self._ROW).coalesce(1).write.mode("append").parquet(self._path)

    def _newest(self):
        stored = self._spark.read.schema(self._ROW).parquet(self._path)
        return stored.agg(
            F.max("version").alias("version"), F.max_by("schema", "version").alias("schema")
        ).first()


def merge_schemas(stored: T.StructType | None, observed: T.StructType, widen: bool = False) -> T.StructType:
    """Stored columns keep place and type; new ones, also inside structs and arrays of structs, come after them.

    Names are compared without case, as Spark resolves them, and keep the spelling they were first seen with. With
    ``widen`` a column takes the narrowest type that holds both: for schemas of one batch, where no order decides.
    """
    if stored is None:
        return _nullable(observed)
    seen = {f.name.lower(): f for f in observed.fields}
    known = [
        T.StructField(f.name, _merge_types(f.dataType, seen[f.name.lower()].dataType, widen) if f.name.lower() in seen else f.dataType)
        for f in stored.fields
    ]
    names = {n.lower() for n in stored.names}
    return T.StructType(known + [f for f in _nullable(observed).fields if f.name.lower() not in names])


_NUMBERS = (T.IntegerType, T.LongType, T.DoubleType)
_TIMES = (T.DateType, T.TimestampType)


def _merge_types(stored: T.DataType, observed: T.DataType, widen: bool) -> T.DataType:
    if isinstance(stored, T.StructType) and isinstance(observed, T.StructType):
        return merge_schemas(stored, observed, widen)
    if isinstance(stored, T.ArrayType) and isinstance(observed, T.ArrayType):
        return T.ArrayType(_merge_types(stored.elementType, observed.elementType, widen))
    if not widen or stored == observed:
        return stored
    for family in (_NUMBERS, _TIMES):
        if isinstance(stored, family) and isinstance(observed, family):
            return max(stored, observed, key=lambda t: family.index(type(t)))
    return T.StringType()


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])

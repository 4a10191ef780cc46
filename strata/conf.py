"""Locations and layer names of a deployment."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class PipelineConf:
    """Where files land, where tables and checkpoints are kept, and how the three layers are called.

    All paths must be on storage that every executor reaches.
    """

    source_path: str
    table_path: str
    checkpoint_path: str
    bronze_schema: str = "bronze"
    silver_schema: str = "silver"
    gold_schema: str = "gold"
    buckets: int = 64
    max_files_per_trigger: int = 1000

    @classmethod
    def from_session(cls, spark: SparkSession, **overrides) -> PipelineConf:
        """Take every setting the session configuration has under the field's name."""
        found = {
            name: int(value) if field.type in ("int", int) else value
            for name, field in cls.__dataclass_fields__.items()
            if (value := spark.conf.get(name, None)) is not None
        }
        return cls(**{**found, **overrides})

    def landing(self, dataset: str) -> str:
        return f"{self.source_path}/{dataset}"

    def schema_store(self, dataset: str) -> str:
        return f"{self.source_path}/schemas/{dataset}"

    def table(self, layer: str, name: str) -> str:
        return f"{self.table_path}/{layer}/{name}"

    def checkpoint(self, flow: str) -> str:
        return f"{self.checkpoint_path}/{flow}"

"""Named SQL rules: look them up, drop or set aside the rows that break them, count the breaches."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RULES_SCHEMA = T.StructType(
    [
        T.StructField("pipeline_name", T.StringType()),
        T.StructField("dataset_name", T.StringType()),
        T.StructField("rule_name", T.StringType()),
        T.StructField("sql_constraint", T.StringType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
        T.StructField("ordinal", T.IntegerType()),
    ]
)


def rules_frame(spark: SparkSession, rules: Iterable[tuple]) -> DataFrame:
    """A rule catalogue from (pipeline, dataset, rule, predicate, tags) tuples, numbered in their order."""
    return spark.createDataFrame([(*r[:4], list(r[4]), i) for i, r in enumerate(rules)], RULES_SCHEMA)


def get_rules(rules: DataFrame, pipeline: str, dataset: str) -> dict[str, str]:
    """{rule name: predicate} of one dataset. A catalogue is a handful of rows.

    With a column ``ordinal`` the highest of equal names holds. Without one a table has no order, so the same name with
    different predicates is an error.
    """
    rows = rules.where(
        (F.col("pipeline_name") == pipeline) & (F.col("dataset_name") == dataset)
    )
    if "ordinal" in rules.columns:
        return {r.rule_name: r.sql_constraint for r in rows.orderBy("ordinal").collect()}
    found: dict[str, str] = {}
    for r in rows.select("rule_name", "sql_constraint").distinct().orderBy("rule_name").collect():
        if r.rule_name in found:
            raise ValueError(f"rule {r.rule_name} of {dataset} has different predicates and no ordinal")
        found[r.rule_name] = r.sql_constraint
    return found


def rules_by_tag(rules: DataFrame, tag: str) -> DataFrame:
    """The rules that carry a tag."""
    return rules.where(F.array_contains("tags", tag))


def expect_all_or_drop(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Keep the rows for which every rule is true; a rule that yields NULL counts as broken.

    The predicates stay as they are written, so that the scan can use them.
    """
    for predicate in rules.values():
        df = df.where(predicate)
    return df


def quarantine(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """The rows that :func:`expect_all_or_drop` leaves out, with the names of the rules they break."""
    broken = F.array_compact(
        F.array(*[F.when(~_holds(p), F.lit(name)) for name, p in rules.items()])
    )
    if not rules:
        return df.where(F.lit(False)).withColumn("quarantine_reason", F.lit(None).cast("string"))
    return df.where(~_all_hold(rules)).withColumn(
        "quarantine_reason", F.concat_ws(",", broken)
    )


def rule_metrics(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """(rule_name, passed, failed) for every rule, from one pass over the data."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(_holds(p)).alias(f"__r{i}") for i, p in enumerate(rules.values())],
    )
    lines = [
        F.struct(
            F.lit(name).alias("rule_name"),
            F.col(f"__r{i}").alias("passed"),
            (F.col("__rows") - F.col(f"__r{i}")).alias("failed"),
        )
        for i, name in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*lines)))


def observe_rules(df: DataFrame, rules: Mapping[str, str]) -> tuple[DataFrame, Observation]:
    """The same rows, and an observation that counts passed rows per rule while they are written: no pass of its own."""
    seen = Observation()
    counts = [F.count_if(_holds(p)).alias(f"r{i}") for i, p in enumerate(rules.values())]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


def observed_metrics(spark: SparkSession, seen: Observation, rules: Mapping[str, str]) -> DataFrame:
    """What :func:`rule_metrics` gives, from an observation whose rows have been written."""
    counts = seen.get
    rows = [(name, counts[f"r{i}"], counts["rows"] - counts[f"r{i}"]) for i, name in enumerate(rules)]
    return spark.createDataFrame(rows, "rule_name string, passed bigint, failed bigint")


def _holds(predicate: str) -> Column:
    return F.coalesce(F.expr(predicate), F.lit(False))


def _all_hold(rules: Mapping[str, str]) -> Column:
    condition = F.lit(True)
    for predicate in rules.values():
        condition = condition & _holds(predicate)
    return condition

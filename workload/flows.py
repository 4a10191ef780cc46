"""Ingestion and incremental operators: test tables are first written as landing files or event files, then streamed."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import replace

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions import cast_columns
from strata.operators import asof_left_join
from strata.plans import MaintainedSummary, join_header, recompute_facts
from strata.session import scratch_path, written
from strata.sources import Landing, SchemaStore, bronze_frame, bronze_stream, ingest
from strata.streaming import Bounds, ChangeSpec, KeyedTarget, append_flow, cdc_flow, join_header_stream, run_available, run_join
from workload.batch import comparable_facts, day, fact_asof_join
from workload.roles import (
    EVENT_DELETE,
    EVENT_KEYS,
    EVENT_SEQUENCE,
    LINE_KEYS,
    LINE_TIES,
    customer_history,
    dimensions,
    sale_headers,
    sale_lines,
    table,
)

BATCHES = 3


class Landed:
    """A landing folder in scratch space, with its bronze table."""

    def __init__(self, spark: SparkSession, format: str, infer_types: bool = False, one_pass: bool = False):
        self.spark, self.root = spark, scratch_path(spark, "landing")
        self.landing = Landing(f"{self.root}/in", format, infer_types, one_pass=one_pass)
        self.store = SchemaStore(spark, f"{self.root}/schema")

    def drop_csv(self, df: DataFrame, partitions: list[str] = []) -> None:
        df.write.mode("append").option("header", "true").partitionBy(*partitions).csv(self.landing.path)

    def drop_json(self, df: DataFrame) -> None:
        """Each task writes its rows as one JSON array. Such a file is read by one task, hence the many tasks here."""
        files = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        rows = df.repartition(files).select(F.to_json(F.struct(*df.columns)).alias("value"))
        rows.mapInPandas(_json_array, "value string").write.mode("append").text(self.landing.path)

    def ingest(self) -> DataFrame:
        ingest(self.spark, self.landing, f"{self.root}/bronze", f"{self.root}/checkpoint", self.store)
        return self.bronze()

    def bronze(self) -> DataFrame:
        return bronze_frame(self.spark, f"{self.root}/bronze", self.store)


def _json_array(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    yield pd.DataFrame({"value": ["["]})
    first = True
    for batch in batches:
        if len(batch):
            text = batch["value"].str.cat(sep="\n,")
            yield pd.DataFrame({"value": [text if first else "," + text]})
            first = False
    yield pd.DataFrame({"value": ["]"]})


def ingest_json_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sales_from_json(Landed(spark, "json", infer_types=True), sf_dir)


def ingest_json_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, every file read once and kept as VARIANT."""
    return _sales_from_json(Landed(spark, "json", infer_types=True, one_pass=True), sf_dir)


def _sales_from_json(landed: Landed, sf_dir: str) -> DataFrame:
    item = lambda n, share: F.struct(F.lit(n).alias("line_item_id"), (F.col("o_totalprice") * share).alias("line_total"))
    landed.drop_json(
        table(landed.spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("transaction_id"),
            F.struct(F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status")).alias("terms"),
            F.col("o_totalprice").alias("total_amount"),
            F.array(item(1, 0.5), item(2, 0.25)).alias("line_items"),
        )
    )
    return landed.ingest().selectExpr(
        "transaction_id",
        "terms.priority",
        "terms.status",
        "total_amount",
        "CAST(size(line_items) AS INT) AS n_items",
        "line_items[0].line_total AS first_total",
        "_rescued_data IS NULL AND ingestion_ts IS NOT NULL AND file_name IS NOT NULL AS complete",
    )


def ingest_csv_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = Landed(spark, "csv")
    landed.drop_csv(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"))
    return landed.ingest().select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


def ingest_csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = Landed(spark, "csv", infer_types=True)
    landed.drop_csv(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", day("o_orderdate").alias("day"), "o_orderpriority")
    )
    bronze = landed.ingest()
    kinds = {f.name: f.dataType.simpleString() for f in bronze.schema.fields}
    return bronze.select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        "o_totalprice",
        day("day").alias("day"),
        "o_orderpriority",
        F.lit(kinds["day"]).alias("day_type"),
    )


def partition_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = Landed(spark, "csv", infer_types=True)
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", F.year("l_shipdate").alias("year"), F.quarter("l_shipdate").alias("quarter")
    )
    landed.drop_csv(lines.hint("rebalance", F.col("year"), F.col("quarter")), ["year", "quarter"])
    return landed.ingest().selectExpr(
        "CAST(l_orderkey AS BIGINT) AS l_orderkey", "CAST(l_partkey AS BIGINT) AS l_partkey", "l_quantity", "year", "quarter"
    )


def file_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per value of a folder name, found again in the name of the file each row came from."""
    landed = Landed(spark, "csv")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"))
    landed.drop_csv(orders, ["status"])
    origin = F.regexp_extract("file_name", "/status=([^/]+)/", 1).alias("origin")
    return landed.ingest().groupBy(origin, "status").agg(F.count(F.lit(1)).alias("n_rows"))


def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second layout brings a new column in the middle."""
    landed = Landed(spark, "csv")
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS id", "o_orderstatus AS extra", "o_orderpriority AS name")
    landed.drop_csv(orders.where("extra = 'F'").select("id", "name"))
    landed.ingest()
    landed.drop_csv(orders.where("extra <> 'F'").select("id", "extra", "name"))
    return landed.ingest().select("id", "name", "extra")


def rescued_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    landed = Landed(spark, "csv", infer_types=True)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    landed.drop_csv(orders.where("o_orderstatus <> 'P'"))
    landed.ingest()
    text = F.concat(F.lit("n/a "), "o_orderkey").alias("o_totalprice")
    landed.drop_csv(orders.where("o_orderstatus = 'P'").select("o_orderkey", text, "o_orderstatus"))
    return landed.ingest().select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "o_totalprice", "o_orderstatus", F.col("_rescued_data").alias("rescued")
    )


def _streamed(spark: SparkSession, df: DataFrame, *shuffle_by: str) -> DataFrame:
    """The rows in another order, as a stream of at least three micro-batches."""
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), BATCHES)
    path = scratch_path(spark, "events")
    df.repartition(files, *shuffle_by).write.parquet(path)
    per_batch = math.ceil(files / BATCHES)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def ingest_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops. The second has files a month older than the first, with names that readers would take for patterns."""
    landed = Landed(spark, "csv")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    landed.drop_csv(orders.where("o_orderstatus = 'F'"))
    landed.ingest()
    landed.drop_csv(orders.where("o_orderstatus <> 'F'"))
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(landed.landing.path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    seen = {r.file_name.rsplit("/", 1)[-1] for r in landed.bronze().select("file_name").distinct().collect()}
    month = 30 * 86400 * 1000
    for i, status in enumerate(files.listStatus(folder)):
        name = status.getPath().getName()
        if name.startswith("part-") and name not in seen:
            other = hadoop.Path(folder, f"part [{i}] {{a,b}} {i}.csv")
            files.rename(status.getPath(), other)
            files.setTimes(other, status.getModificationTime() - month, -1)
    return landed.ingest().select("o_orderkey", "o_orderstatus", "o_orderpriority")


def schema_evolution_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two layouts in one drop, whole numbers in one and decimals in the other, and a header in another case later."""
    landed = Landed(spark, "csv", infer_types=True)
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS id", "o_totalprice AS price", "o_orderstatus AS status", "o_orderpriority AS name")
    landed.drop_csv(orders.where("status = 'F'").selectExpr("id", "CAST(FLOOR(price) AS BIGINT) AS price", "name"))
    landed.drop_csv(orders.where("status = 'O'").select("id", "price", "status", "name"))
    landed.ingest()
    landed.drop_csv(orders.where("status = 'P'").selectExpr("id AS ID", "price AS Price", "name AS NAME"))
    out = landed.ingest()
    return out.select(F.col("id").cast("bigint").alias("id"), "price", "name", "status", F.col("_rescued_data").alias("rescued"))


def silver_misfits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that a cast can't keep: gone from the silver rows, kept beside them with the reason."""
    root = scratch_path(spark, "misfits")
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey"), F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("n/a "), "o_orderkey")).otherwise(F.lit("2024-01-31")).alias("due"),
        day("o_orderdate").alias("day"),
    )
    target = KeyedTarget(spark, f"{root}/silver", ChangeSpec(("o_orderkey",), "day", buckets=8))
    casts = {"due": "date"}
    cdc_flow(_streamed(spark, orders, "o_orderkey"), target, f"{root}/checkpoint", lambda df: cast_columns(df, casts), None, f"{root}/aside", casts)
    lost = spark.read.parquet(f"{root}/aside").where("misfit_row IS NOT NULL")
    kept = lost.select(F.get_json_object("misfit_row", "$.o_orderkey").cast("bigint").alias("o_orderkey"), F.get_json_object("quarantine_reason", "$.due").alias("lost"))
    return target.read().join(kept, "o_orderkey", "left").select("o_orderkey", F.col("due").isNull().alias("due_is_null"), "lost")


def append_only_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events appended to a named table by one stream, which a second stream reads."""
    root = scratch_path(spark, "append")
    events = _streamed(spark, table(spark, sf_dir, "events"), "event_id")
    spark.sql("DROP TABLE IF EXISTS strata_events")
    spark.sql("DROP TABLE IF EXISTS strata_purchases")
    append_flow(events, "strata_events", f"{root}/c1", f"{root}/events")
    purchases = spark.readStream.table("strata_events").where("event_type = 'purchase'")
    return append_flow(purchases, "strata_purchases", f"{root}/c2", f"{root}/purchases")


def stream_join_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams joined on the transaction, then to stored history, in one append-mode query.

    For input that ends, because it keeps every row as state. For streams without end: ``header_detail_stream``, or
    ``recompute_facts`` where times are not known to be near each other.
    """
    root = scratch_path(spark, "joined")
    lines = _streamed(spark, sale_lines(spark, sf_dir).select(*LINE_KEYS, "product_id", "l_suppkey", "line_total"), "product_id")
    headers = _streamed(spark, sale_headers(spark, sf_dir), "customer_id")
    joined = join_header(lines, headers, ["transaction_id"], ["customer_id", "transaction_date"])
    out = asof_left_join(
        joined, customer_history(spark, sf_dir), ["customer_id"], "transaction_date", ["dim_customer_key"], unknown="-1"
    )
    spark.sql("DROP TABLE IF EXISTS strata_joined")
    stored = append_flow(out, "strata_joined", f"{root}/checkpoint", f"{root}/table")
    return stored.withColumn("transaction_date", day("transaction_date"))


SLICES = 5


def _in_time_order(spark: SparkSession, df: DataFrame, at: str, borders: list[float]) -> DataFrame:
    """The rows as a stream whose micro-batches follow each other in time. They are worked out once, whatever the number of
    micro-batches, and stored by their place in it."""
    files, path, places = int(spark.conf.get("spark.sql.shuffle.partitions")), scratch_path(spark, "timed"), scratch_path(spark, "places")
    place = F.lit(0)
    for border in borders:
        place = place + (F.unix_timestamp(at) > border).cast("int")
    df.withColumn("__place", place).write.partitionBy("__place").option("compression", "zstd").parquet(places)
    placed = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("__place", T.IntegerType())])).parquet(places)
    for number in range(len(borders) + 1):
        placed.where(F.col("__place") == number).drop("__place").repartition(files).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)


def header_detail_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and orders as two streams that go on, joined with bounded state."""
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey", "o_totalprice AS total_amount", "CAST(o_orderdate AS TIMESTAMP) AS sold_at")
    orders = orders.join(table(spark, sf_dir, "customer").selectExpr("c_custkey AS o_custkey"), "o_custkey")
    orders = written(orders.selectExpr("o_orderkey AS transaction_id", "o_custkey AS customer_id", "total_amount", "sold_at"), "orders")
    lines = sale_lines(spark, sf_dir).select(*LINE_KEYS, "product_id", "l_suppkey", "line_total").join(orders.select("transaction_id", "sold_at"), "transaction_id")
    borders = orders.select(F.unix_timestamp("sold_at").alias("t")).approxQuantile("t", [k / SLICES for k in range(1, SLICES)], 0.01)
    root, bounds = scratch_path(spark, "timed-join"), Bounds("sold_at", "1 day", "30 days")
    joined = join_header_stream(
        _in_time_order(spark, lines, "sold_at", borders), _in_time_order(spark, orders, "sold_at", borders), ["transaction_id"], ["customer_id", "total_amount"], bounds
    )
    run_join(joined, f"{root}/out", f"{root}/checkpoint")
    return spark.read.schema(joined.schema).parquet(f"{root}/out").drop("sold_at")


def summary_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary after three batches: facts with wrong amounts and facts that never were; the amounts put right; the false
    facts gone and the rest come. The last batch comes twice."""
    facts = written(fact_asof_join(spark, sf_dir), "facts")
    summary = MaintainedSummary(spark, scratch_path(spark, "summary"), buckets=16)
    early, wrong = facts.where("line_item_id % 3 <> 0"), F.col("line_item_id") == 1
    doubled = F.when(wrong, F.col("line_total") * 2 + 0.1).otherwise(F.col("line_total"))
    false = facts.where("line_item_id = 2").withColumn("transaction_id", -F.col("transaction_id") - 1)
    summary.update(facts.limit(0), early.withColumn("line_total", doubled).unionByName(false), ("facts", 0))
    summary.update(early.where(wrong).withColumn("line_total", doubled), early.where(wrong), ("facts", 1))
    for _ in range(2):
        summary.update(false, facts.where("line_item_id % 3 = 0"), ("facts", 2))
    return summary.read()


def named_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A silver and a gold table, upserted twice and once more with the same rows, then read by name from another session."""
    root, events = scratch_path(spark, "named"), table(spark, sf_dir, "events")
    spark.sql("CREATE SCHEMA IF NOT EXISTS strata_named")
    spec = replace(_EVENT_SPEC, apply_as_deletes=EVENT_DELETE)
    for name, kind in (("users", spec), ("user_history", replace(spec, scd_type=2, except_columns=("props",)))):
        target = KeyedTarget(spark, f"{root}/{name}", kind)
        for part in ("event_id % 2 = 0", "event_id % 2 = 1", "event_id % 2 = 0"):
            target.upsert(events.where(part))
        target.declare(f"strata_named.{name}", f"{name} from events", {"quality": "test"})
    return spark.newSession().sql(
        "SELECT h.user_id, count(*) AS versions, max(u.event_id) AS current_event FROM strata_named.user_history h"
        " LEFT JOIN strata_named.users u ON u.user_id = h.user_id GROUP BY h.user_id"
    )


_EVENT_SPEC = ChangeSpec(tuple(EVENT_KEYS), EVENT_SEQUENCE, tie_break=("event_id",), buckets=8)


def _incremental(spark: SparkSession, sf_dir: str, spec: ChangeSpec) -> KeyedTarget:
    root = scratch_path(spark, "target")
    target = KeyedTarget(spark, f"{root}/table", spec)
    cdc_flow(_streamed(spark, table(spark, sf_dir, "events"), "event_id"), target, f"{root}/checkpoint")
    return target


def incremental_scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _incremental(spark, sf_dir, replace(_EVENT_SPEC, apply_as_deletes=EVENT_DELETE)).read()


def incremental_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = replace(_EVENT_SPEC, scd_type=2, apply_as_deletes=EVENT_DELETE, except_columns=("props",))
    return _incremental(spark, sf_dir, spec).read()


def _backwards(spark: SparkSession, sf_dir: str, spec: ChangeSpec) -> DataFrame:
    """The newest third of the events first, the oldest last, and the newest again."""
    events = table(spark, sf_dir, "events")
    low, high = events.approxQuantile("event_id", [1 / 3, 2 / 3], 0.01)
    parts = [events.where(F.col("event_id") > high), events.where(F.col("event_id").between(low + 1, high)), events.where(F.col("event_id") <= low)]
    target = KeyedTarget(spark, scratch_path(spark, "target"), spec)
    for part in [*parts, parts[0]]:
        target.upsert(part)
    return target.read()


def scd1_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _backwards(spark, sf_dir, _EVENT_SPEC)


def scd2_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _backwards(spark, sf_dir, replace(_EVENT_SPEC, scd_type=2, except_columns=("props",)))


def fact_asof_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines arrive in micro-batches; each batch corrects the line table and the facts of its transactions."""
    root = scratch_path(spark, "facts")
    by_sale = dict(bucket_keys=("transaction_id",), buckets=8)
    lines = KeyedTarget(spark, f"{root}/lines", ChangeSpec(tuple(LINE_KEYS), "modified_date", tie_break=tuple(LINE_TIES), **by_sale))
    facts = KeyedTarget(spark, f"{root}/facts", ChangeSpec(tuple(LINE_KEYS), "modified_date", tie_break=("gold_processed_ts",), **by_sale))
    headers, history = sale_headers(spark, sf_dir), dimensions(spark, sf_dir)

    def handle(batch: DataFrame, _: int) -> None:
        lines.upsert(batch)
        recompute_facts(batch, lines, headers, history, facts)

    stream = _streamed(spark, sale_lines(spark, sf_dir), "product_id", "l_suppkey")
    run_available(stream, handle, f"{root}/checkpoint")
    return comparable_facts(facts.read())


def bronze_to_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to append-only bronze to current rows: the whole way of one dataset."""
    landed = Landed(spark, "csv")
    # As text, because the CSV writer would shorten the time to milliseconds.
    landed.drop_csv(table(spark, sf_dir, "events").drop("props").withColumn("ts", F.col("ts").cast("string")))
    landed.ingest()
    stream = bronze_stream(spark, f"{landed.root}/bronze", landed.store)
    spec = ChangeSpec(
        ("user_id",),
        "ts",
        tie_break=("event_id",),
        apply_as_deletes=EVENT_DELETE,
        except_columns=("_rescued_data", "ingestion_ts", "file_name", "file_modified", "ingest_batch"),
        buckets=8,
    )
    target = KeyedTarget(spark, f"{landed.root}/silver", spec)
    types = {"event_id": "bigint", "user_id": "bigint", "value": "double", "ts": "timestamp_ntz"}
    cdc_flow(
        stream,
        target,
        f"{landed.root}/silver-checkpoint",
        lambda df: cast_columns(df, types),
        {"valid_user": "user_id IS NOT NULL", "known_type": "event_type LIKE '%i%'"},
        f"{landed.root}/quarantine",
    )
    return target.read()


QUERIES = {
    "ingest_json_stream": ingest_json_stream,
    "ingest_json_variant": ingest_json_variant,
    "ingest_csv_stream": ingest_csv_stream,
    "ingest_csv_typed": ingest_csv_typed,
    "partition_columns": partition_columns,
    "file_lineage": file_lineage,
    "schema_evolution": schema_evolution,
    "rescued_data": rescued_data,
    "ingest_backlog": ingest_backlog,
    "schema_evolution_types": schema_evolution_types,
    "silver_misfits": silver_misfits,
    "append_only_table": append_only_table,
    "stream_join_append": stream_join_append,
    "header_detail_stream": header_detail_stream,
    "summary_incremental": summary_incremental,
    "named_targets": named_targets,
    "incremental_scd1": incremental_scd1,
    "incremental_scd2": incremental_scd2,
    "scd1_out_of_order": scd1_out_of_order,
    "scd2_out_of_order": scd2_out_of_order,
    "fact_asof_incremental": fact_asof_incremental,
    "bronze_to_silver": bronze_to_silver,
}

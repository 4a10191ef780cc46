"""Batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions import cast_columns, explode_items, flatten_struct, surrogate_key
from strata.operators import (
    asof_left_join,
    asof_ordered,
    current_versions,
    dated_within,
    expect_all_or_drop,
    get_rules,
    observe_rules,
    observed_metrics,
    quarantine,
    rule_metrics,
    rules_by_tag,
    rules_frame,
    scd1,
    scd2,
    versions_begun_by,
)
from strata.plans import join_header, sales_facts, sales_facts_bucketed, sales_summary, sales_summary_bucketed
from strata.session import scratch_path, written
from strata.conf import PipelineConf
from strata.sources import create_layers, preview, register_table, replace_table, use_schema
from workload.roles import (
    EVENT_DELETE,
    EVENT_KEYS,
    EVENT_SEQUENCE,
    LINE_KEYS,
    LINE_TIES,
    bucketed,
    current_lines,
    customer_changes,
    customer_history,
    dimensions,
    sale_headers,
    sale_lines,
    table,
)

# Rule predicates.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}$"
EVENT_RULES = {
    "valid_user": "user_id IS NOT NULL",
    "valid_type": "event_type LIKE '%i%'",
    "valid_value": "value >= 1",
}
CATALOGUE = [
    ("orders-check", "orders", "valid_customer", "o_custkey IS NOT NULL", ["validity", "orders"]),
    ("orders-check", "orders", "valid_price", "o_totalprice > 0", ["validity", "orders"]),
    ("orders-check", "orders", "large", "o_totalprice > 100000", ["volume", "orders"]),
    ("lines-check", "lineitem", "valid_quantity", "l_quantity > 10", ["validity", "lineitem"]),
    ("lines-check", "lineitem", "returned", "l_returnflag = 'R'", ["volume", "lineitem"]),
    ("lines-check", "lineitem", "valid_discount", "l_discount BETWEEN 0 AND 0.05", ["validity", "lineitem"]),
]


def day(column: str):
    """Dates leave as text, so that both engines hand over the same type."""
    return F.col(column).cast("date").cast("string")


def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/orders.parquet"
    schema = spark.read.parquet(path).schema
    return register_table(spark, "strata_orders", schema, path, "orders", {"quality": "raw"})


def scan_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n_rows"))


def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(
        table(spark, sf_dir, "orders").select("o_totalprice", "o_orderkey"), 10, ["o_totalprice", "o_orderkey"]
    )


def cast_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_totalprice").cast("string").alias("price"),
        F.substring(F.col("o_orderdate").cast("string"), 1, 10).alias("ordered"),
        F.when(F.col("o_orderstatus") == "P", F.lit("none")).otherwise(F.substring("o_orderpriority", 1, 1)).alias("rank"),
    )
    typed = cast_columns(raw, {"order_id": "int", "price": "double", "ordered": "date", "rank": "double"})
    return typed.withColumn("ordered", day("ordered"))


def flatten_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = table(spark, sf_dir, "customer").select(
        "c_custkey", F.struct("c_name", "c_nationkey", "c_mktsegment").alias("details"), "c_acctbal"
    )
    return flatten_struct(nested, "details")


def explode_line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two items per line document; documents of returned lines have no array, of accepted ones an empty array."""
    item = lambda number, product, quantity: F.struct(
        number.alias("line_item_id"), product.alias("product_id"), quantity.alias("quantity")
    )
    items = F.array(
        item(F.col("l_linenumber"), F.col("l_partkey"), F.col("l_quantity")),
        item(F.col("l_linenumber") + 100, F.col("l_suppkey"), F.col("l_quantity") * 2),
    )
    documents = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("transaction_id"),
        F.when(F.col("l_returnflag") == "R", F.lit(None))
        .when(F.col("l_returnflag") == "A", F.slice(items, 1, 0))
        .otherwise(items)
        .alias("line_items"),
    )
    return explode_items(documents, "line_items", ["transaction_id"])


def order_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date"))
    customer = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    return orders.select("o_orderkey", surrogate_key(customer, "day").alias("order_hash"))


def _events_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.expr("CAST(nullif(user_id, 7) AS STRING)").alias("user_id"),
        F.expr("nullif(event_type, 'click')").alias("event_type"),
        "value",
    )


def drop_invalid_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return expect_all_or_drop(_events_with_gaps(spark, sf_dir), EVENT_RULES)


def quarantine_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine(_events_with_gaps(spark, sf_dir), EVENT_RULES)


def event_rule_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_metrics(_events_with_gaps(spark, sf_dir), EVENT_RULES)


def rule_metrics_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted while the rows that hold are written."""
    rows, seen = observe_rules(_events_with_gaps(spark, sf_dir), EVENT_RULES)
    expect_all_or_drop(rows, EVENT_RULES).write.parquet(scratch_path(spark, "valid-events"))
    return observed_metrics(spark, seen, EVENT_RULES)


def rule_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return expect_all_or_drop(pages, {"secure": "url LIKE 'https://%.%'"})


def rule_rlike(spark: SparkSession, sf_dir: str) -> DataFrame:
    sign = F.when(F.col("c_nationkey") < 5, F.lit("")).otherwise(F.lit("@"))
    email = F.concat(F.regexp_replace("c_name", "#", "."), sign, F.lower("c_mktsegment"), F.lit(".com"))
    people = table(spark, sf_dir, "customer").select("c_custkey", email.alias("email"))
    return expect_all_or_drop(people, {"valid_email": f"email RLIKE '{EMAIL_PATTERN}'"})


def layers_and_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layers named by session settings; a table declared in the current one, read by its bare name through a view."""
    spark.conf.set("bronze_schema", "strata_raw")
    try:
        conf = PipelineConf.from_session(spark, source_path="", table_path="", checkpoint_path="")
    finally:
        spark.conf.unset("bronze_schema")
    before, root = spark.catalog.currentDatabase(), scratch_path(spark, "layers")
    create_layers(spark, {conf.bronze_schema: "rows as they came", conf.silver_schema: "current rows"}, {"env": "test"})
    use_schema(spark, conf.bronze_schema)
    try:
        spark.sql("DROP TABLE IF EXISTS named_orders")
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
        replace_table(orders, "named_orders", root, "all orders")
        spark.read.table("named_orders").createOrReplaceTempView("orders_view")
        return spark.sql("SELECT * FROM orders_view")
    finally:
        use_schema(spark, before)


def rules_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue as a stored table; the rules of one dataset are looked up and measured on all its rows."""
    stored = replace_table(rules_frame(spark, CATALOGUE), "strata_rules", scratch_path(spark, "rules"), "rules")
    measured = rule_metrics(table(spark, sf_dir, "orders"), get_rules(stored, "orders-check", "orders"))
    texts = stored.where("dataset_name = 'orders'").select("rule_name", "sql_constraint")
    return measured.join(texts, "rule_name")


def tagged_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = rules_by_tag(rules_frame(spark, CATALOGUE), "validity")
    lines = table(spark, sf_dir, "lineitem")
    return rule_metrics(lines, get_rules(tagged, "lines-check", "lineitem"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


_TIES = ["event_id"]


def scd1_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd1(_events(spark, sf_dir), EVENT_KEYS, EVENT_SEQUENCE, _TIES)


def scd1_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd1(_events(spark, sf_dir), EVENT_KEYS, EVENT_SEQUENCE, _TIES, apply_as_deletes=EVENT_DELETE)


def scd1_except_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd1(
        _events(spark, sf_dir),
        EVENT_KEYS,
        EVENT_SEQUENCE,
        _TIES,
        apply_as_deletes=EVENT_DELETE,
        except_columns=["props", "event_type", "_rescued_data"],
    )


def scd1_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = scd1(sale_lines(spark, sf_dir), LINE_KEYS, "modified_date", LINE_TIES)
    return latest.withColumn("modified_date", day("modified_date"))


def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2(_events(spark, sf_dir), EVENT_KEYS, EVENT_SEQUENCE, _TIES, except_columns=["props"])


def scd2_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return current_versions(scd2_history(spark, sf_dir)).drop("__END_AT")


def scd2_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2(
        _events(spark, sf_dir),
        EVENT_KEYS,
        EVENT_SEQUENCE,
        _TIES,
        apply_as_deletes=EVENT_DELETE,
        except_columns=["props"],
    )


def scd2_track(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2(
        _events(spark, sf_dir),
        EVENT_KEYS,
        EVENT_SEQUENCE,
        _TIES,
        except_columns=["props", "value"],
        track_columns=["event_type"],
    )


def scd2_heavy_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key holds two fifths of all events; its timeline is cut into slices."""
    events = _events(spark, sf_dir).selectExpr(
        "event_id", "ts", "if(event_type IN ('click', 'view'), -1, user_id) AS user_id", "event_type"
    )
    return scd2(
        events,
        EVENT_KEYS,
        EVENT_SEQUENCE,
        _TIES,
        apply_as_deletes=EVENT_DELETE,
        track_columns=["event_type"],
        rows_per_slice=1000,
    )


def scd2_heavy_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key holds most events, its sequence is text, and a fifth of it lies on one sentinel date."""
    moment = "concat(if(event_id % 5 = 0, '9999-12-31', date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSSSSS')), ' ', lpad(event_id, 12, '0'))"
    events = _events(spark, sf_dir).selectExpr(
        "event_id", f"{moment} AS moment", "if(event_type IN ('click', 'view', 'purchase'), -1, user_id) AS user_id", "event_type"
    )
    return scd2(events, EVENT_KEYS, "moment", _TIES, apply_as_deletes=EVENT_DELETE, track_columns=["event_type"], rows_per_slice=500)


def header_detail_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = sale_lines(spark, sf_dir).select(*LINE_KEYS, "product_id", "l_suppkey", "line_total")
    headers = sale_headers(spark, sf_dir)
    return join_header(lines, headers, ["transaction_id"], ["customer_id", "payment_type", "total_amount"])


def _owned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS transaction_id", "l_linenumber", "l_partkey", "CAST(l_shipdate AS DATE) AS ship_date"
    )
    owners = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS transaction_id", "o_custkey")
    return join_header(lines, owners, ["transaction_id"], ["o_custkey"])


def asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line with the customer version valid on its ship date."""
    out = asof_left_join(
        _owned_lines(spark, sf_dir),
        customer_history(spark, sf_dir),
        {"o_custkey": "customer_id"},
        "ship_date",
        {"dim_customer_key": "dim_customer_key", "priority": "priority"},
        unknown="-1",
    )
    return out.withColumn("ship_date", day("ship_date"))


def asof_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, by one ordered pass over lines and versions."""
    columns = {"dim_customer_key": "dim_customer_key", "priority": "priority"}
    out = asof_ordered(_owned_lines(spark, sf_dir), customer_history(spark, sf_dir), {"o_custkey": "customer_id"}, "ship_date", columns, unknown="-1")
    return out.withColumn("ship_date", day("ship_date"))


def asof_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event of a user with the order that was the latest at its time, where all users share one history: one key, as
    many versions as there are moments of orders, dealt to ranges."""
    orders = table(spark, sf_dir, "orders").selectExpr("1 AS shop", "o_orderdate AS since", "o_orderkey")
    history = written(scd2(orders, ["shop"], "since", ["o_orderkey"], rows_per_slice=1000), "shop-history")
    events = _events(spark, sf_dir).selectExpr("event_id", "1 AS shop", "ts")
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return asof_ordered(events, history, ["shop"], "ts", {"o_orderkey": "latest_order"}, ranges=ranges).select("event_id", "latest_order")


def late_dimension_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines whose customer version is another one once the changes of the two highest priorities have come late."""
    late = customer_changes(spark, sf_dir).where("priority IN ('1-URGENT', '2-HIGH')")
    changed = versions_begun_by(customer_history(spark, sf_dir), late, ["customer_id"], "modified_date")
    lines = dated_within(_owned_lines(spark, sf_dir), written(changed, "changed-versions"), {"o_custkey": "customer_id"}, "ship_date")
    return lines.withColumn("ship_date", day("ship_date"))


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_facts(current_lines(spark, sf_dir), sale_headers(spark, sf_dir), dimensions(spark, sf_dir))


def comparable_facts(facts: DataFrame) -> DataFrame:
    dates = ["transaction_date", "created_date", "modified_date"]
    return facts.drop("gold_processed_ts").withColumns({c: day(c) for c in dates})


def _facts_bucketed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, bool]:
    """The log of lines, the headers and the dimensions are stored in buckets first. Corrections are folded within buckets.
    With the facts: has no transaction too many rows for one task?"""
    lines = bucketed(sale_lines(spark, sf_dir), "sale_lines", ["transaction_id"])
    headers = bucketed(sale_headers(spark, sf_dir), "sale_headers", ["transaction_id"])
    current = lines.per_key(lambda df: scd1(df, LINE_KEYS, "modified_date", LINE_TIES))
    return sales_facts_bucketed(current, headers, dimensions(spark, sf_dir)), lines.heavy is None and headers.heavy is None


def fact_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable_facts(_facts_bucketed(spark, sf_dir)[0])


def summary_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact itself in buckets of its transaction, summed within them."""
    exact = {c: F.col(c).cast("decimal(18,2)") for c in ("line_total", "quantity")}
    facts, even = _facts_bucketed(spark, sf_dir)
    facts = facts.withColumns(exact)
    # Facts come dealt by transaction. Heavy transactions are counted where there may be some.
    how = {"rows_per_key": None, "dealt": True} if even else {}
    stored = bucketed(facts if even else written(facts, "facts"), "facts", ["transaction_id"], **how)
    return _comparable_sums(sales_summary_bucketed(stored))


def fact_asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable_facts(_facts(spark, sf_dir))


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    exact = {c: F.col(c).cast("decimal(18,2)") for c in ("line_total", "quantity")}
    return _comparable_sums(sales_summary(_facts(spark, sf_dir).withColumns(exact)))


def _comparable_sums(sums: DataFrame) -> DataFrame:
    return sums.withColumns(
        {
            "transaction_date": day("transaction_date"),
            "total_amount": F.col("total_amount").cast("double"),
            "total_quantity": F.col("total_quantity").cast("double"),
        }
    )


QUERIES = {
    "scan_table": scan_table,
    "scan_count": scan_count,
    "preview_limit": preview_limit,
    "cast_projection": cast_projection,
    "flatten_struct": flatten_customer,
    "explode_line_items": explode_line_items,
    "surrogate_key": order_key,
    "expect_all_or_drop": drop_invalid_events,
    "quarantine": quarantine_events,
    "rule_metrics": event_rule_metrics,
    "rule_metrics_observed": rule_metrics_observed,
    "rule_like": rule_like,
    "rule_rlike": rule_rlike,
    "rules_table": rules_table,
    "layers_and_names": layers_and_names,
    "rules_by_tag": tagged_rules,
    "scd1_latest": scd1_latest,
    "scd1_delete": scd1_delete,
    "scd1_except_columns": scd1_except_columns,
    "scd1_composite": scd1_composite,
    "scd2_history": scd2_history,
    "scd2_current": scd2_current,
    "scd2_delete": scd2_delete,
    "scd2_track": scd2_track,
    "scd2_heavy_key": scd2_heavy_key,
    "scd2_heavy_text": scd2_heavy_text,
    "header_detail_join": header_detail_join,
    "asof_join": asof_join,
    "asof_ordered": asof_in_order,
    "asof_hot_key": asof_hot_key,
    "late_dimension_facts": late_dimension_facts,
    "fact_asof_join": fact_asof_join,
    "fact_bucketed": fact_bucketed,
    "summary_bucketed": summary_bucketed,
    "sales_summary": summary,
}

"""The same results in SQL."""

from __future__ import annotations

from workload.batch import CATALOGUE

_DAY = "CAST(CAST({0} AS DATE) AS VARCHAR) AS {1}"


def _metrics(rows: str, rules: dict[str, str], more: str = "") -> str:
    """One SELECT per rule: rows that pass, rows that do not."""
    texts = {name: more.format(predicate=p.replace("'", "''")) for name, p in rules.items()}
    return " UNION ALL ".join(
        f"SELECT '{name}' AS rule_name, count(*) FILTER (WHERE {p}) AS passed,"
        f" count(*) - count(*) FILTER (WHERE {p}) AS failed{texts[name]} FROM {rows}"
        for name, p in rules.items()
    )


def _rules(dataset: str, tag: str) -> dict[str, str]:
    return {r[2]: r[3] for r in CATALOGUE if r[1] == dataset and tag in r[4]}


_GAPS = (
    "(SELECT event_id, CAST(nullif(user_id, 7) AS VARCHAR) AS user_id, nullif(event_type, 'click') AS event_type, value FROM events)"
)
_EVENT_RULES = {
    "valid_user": "user_id IS NOT NULL",
    "valid_type": "event_type LIKE '%i%'",
    "valid_value": "value >= 1",
}
_ALL_HOLD = "user_id IS NOT NULL AND event_type LIKE '%i%' AND value >= 1"


def _latest(columns: str, where: str = "") -> str:
    return (
        f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn"
        f" FROM events) WHERE rn = 1{where}"
    )


_EVENT = "event_id, ts, user_id, event_type, value"
_VERSIONS = (
    "WITH one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS rn"
    " FROM {events}) WHERE rn = 1),"
    " v AS (SELECT *, ts AS __START_AT, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS __END_AT FROM one)"
)
_HISTORY = _VERSIONS.format(events="events") + f" SELECT {_EVENT}, __START_AT, __END_AT FROM v"


def _tracked(events: str, state: str, columns: str, where: str) -> str:
    return (
        f"WITH one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, ts ORDER BY event_id DESC) AS rn"
        f" FROM {events}) WHERE rn = 1),"
        f" c AS (SELECT *, lag({state}) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM one),"
        f" k AS (SELECT * FROM c WHERE before IS NULL OR before <> {state}),"
        " v AS (SELECT *, ts AS __START_AT, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS __END_AT FROM k)"
        f" SELECT {columns}, __START_AT, __END_AT FROM v{where}"
    )


_HEAVY = (
    "(SELECT event_id, ts, CASE WHEN event_type IN ('click', 'view') THEN -1 ELSE user_id END AS user_id, event_type"
    " FROM events)"
)

_HEAVY_TEXT = (
    "(SELECT event_id, concat(CASE WHEN event_id % 5 = 0 THEN '9999-12-31' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END, ' ',"
    " lpad(CAST(event_id AS VARCHAR), 12, '0')) AS ts,"
    " CASE WHEN event_type IN ('click', 'view', 'purchase') THEN -1 ELSE user_id END AS user_id, event_type FROM events)"
)

_CUSTOMERS = (
    "cust AS (SELECT customer_id, priority, d, lead(d) OVER (PARTITION BY customer_id ORDER BY d) AS e,"
    " sha256(concat_ws('||', CAST(customer_id AS VARCHAR), CAST(d AS VARCHAR))) AS k FROM"
    " (SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS d, max(o_orderpriority) AS priority"
    " FROM orders GROUP BY 1, 2))"
)


def _periodic(name: str, key: str, period: str, effective: str, source: str, date: str) -> str:
    return (
        f"{name} AS (SELECT {key}, d, lead(d) OVER (PARTITION BY {key} ORDER BY d) AS e,"
        f" sha256(concat_ws('||', CAST({key} AS VARCHAR), CAST(d AS VARCHAR))) AS k FROM"
        f" (SELECT {key}, date_trunc('{period}', {date}) AS p, {effective}({date}) AS d FROM {source} GROUP BY 1, 2))"
    )


def _valid(alias: str, key: str) -> str:
    return (
        f" LEFT JOIN {alias} ON {alias}.{key} = x.{key} AND x.transaction_date >= {alias}.d"
        f" AND x.transaction_date < coalesce({alias}.e, DATE '9999-12-31')"
    )


_FACTS = (
    "WITH h AS (SELECT o_orderkey AS transaction_id, o_orderkey % 97 AS employee_id, o_custkey AS customer_id,"
    " c_nationkey AS location_id, CAST(o_orderdate AS DATE) AS transaction_date, o_totalprice AS total_amount,"
    " o_orderpriority AS payment_type FROM orders JOIN customer ON c_custkey = o_custkey),"
    " li AS (SELECT *, CAST(l_shipdate AS DATE) AS ship FROM lineitem),"
    " l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber"
    " ORDER BY ship DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM li) WHERE rn = 1),"
    " pl AS (SELECT l_partkey AS product_id, ship FROM li),"
    f" {_CUSTOMERS},"
    f" {_periodic('emp', 'employee_id', 'year', 'min', 'h', 'transaction_date')},"
    f" {_periodic('loc', 'location_id', 'year', 'max', 'h', 'transaction_date')},"
    f" {_periodic('prod', 'product_id', 'quarter', 'min', 'pl', 'ship')},"
    " x AS (SELECT l.l_orderkey AS transaction_id, l.l_linenumber AS line_item_id, l.l_partkey AS product_id,"
    " l.l_quantity AS quantity, l.l_extendedprice AS unit_price, l.l_discount AS discount_pct,"
    " l.l_extendedprice AS line_total, l.ship, h.* EXCLUDE (transaction_id) FROM l JOIN h ON h.transaction_id = l.l_orderkey),"
    " f AS (SELECT sha256(concat_ws('||', CAST(x.transaction_id AS VARCHAR), CAST(x.line_item_id AS VARCHAR),"
    " CAST(x.ship AS VARCHAR))) AS fact_sale_details_key, x.transaction_id,"
    " CAST(x.transaction_date AS VARCHAR) AS transaction_date, x.line_item_id,"
    " coalesce(emp.k, '-1') AS dim_employee_key, coalesce(cust.k, '-1') AS dim_customer_key,"
    " coalesce(loc.k, '-1') AS dim_location_key, prod.k AS dim_product_key,"
    " x.quantity, x.unit_price, x.discount_pct, x.line_total, x.total_amount, x.payment_type,"
    " CAST(x.transaction_date AS VARCHAR) AS created_date, CAST(x.transaction_date AS VARCHAR) AS modified_date FROM x"
    f"{_valid('emp', 'employee_id')}{_valid('cust', 'customer_id')}{_valid('loc', 'location_id')}{_valid('prod', 'product_id')})"
)

ORACLES = {
    "scan_table": "SELECT * FROM orders",
    "scan_count": "SELECT count(*) AS n_rows FROM lineitem",
    "preview_limit": "SELECT o_totalprice, o_orderkey FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10",
    "cast_projection": (
        "SELECT CAST(o_orderkey AS INTEGER) AS order_id, o_totalprice AS price, "
        + _DAY.format("o_orderdate", "ordered")
        + ", TRY_CAST(CASE WHEN o_orderstatus = 'P' THEN 'none' ELSE substr(o_orderpriority, 1, 1) END AS DOUBLE) AS rank"
        " FROM orders"
    ),
    "flatten_struct": "SELECT c_custkey, c_name, c_nationkey, c_mktsegment, c_acctbal FROM customer",
    "explode_line_items": (
        "SELECT l_orderkey AS transaction_id, l_linenumber AS line_item_id, l_partkey AS product_id,"
        " l_quantity AS quantity FROM lineitem WHERE l_returnflag NOT IN ('R', 'A') UNION ALL"
        " SELECT l_orderkey, l_linenumber + 100, l_suppkey, l_quantity * 2 FROM lineitem"
        " WHERE l_returnflag NOT IN ('R', 'A')"
    ),
    "surrogate_key": (
        "SELECT o_orderkey, sha256(concat_ws('||', CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END,"
        " CAST(CAST(o_orderdate AS DATE) AS VARCHAR))) AS order_hash FROM orders"
    ),
    "expect_all_or_drop": f"SELECT * FROM {_GAPS} WHERE {_ALL_HOLD}",
    "quarantine": (
        f"SELECT *, concat_ws(',', CASE WHEN user_id IS NULL THEN 'valid_user' END,"
        " CASE WHEN NOT coalesce(event_type LIKE '%i%', false) THEN 'valid_type' END,"
        f" CASE WHEN NOT value >= 1 THEN 'valid_value' END) AS quarantine_reason FROM {_GAPS}"
        f" WHERE NOT coalesce({_ALL_HOLD}, false)"
    ),
    "rule_metrics": _metrics(_GAPS, _EVENT_RULES),
    "rule_like": "SELECT page_id, url FROM pages WHERE url LIKE 'https://%.%'",
    "rule_rlike": (
        "SELECT * FROM (SELECT c_custkey, replace(c_name, '#', '.') || CASE WHEN c_nationkey < 5 THEN '' ELSE '@' END ||"
        " lower(c_mktsegment) || '.com' AS email FROM customer)"
        r" WHERE regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$')"
    ),
    "rules_table": _metrics("orders", _rules("orders", "orders"), ", '{predicate}' AS sql_constraint"),
    "rules_by_tag": _metrics("lineitem", _rules("lineitem", "validity")),
    "scd1_latest": _latest(f"{_EVENT}, props"),
    "scd1_delete": _latest(f"{_EVENT}, props", " AND event_type <> 'error'"),
    "scd1_except_columns": _latest("event_id, ts, user_id, value", " AND event_type <> 'error'"),
    "scd1_composite": (
        "SELECT l_orderkey AS transaction_id, l_linenumber AS line_item_id, l_partkey AS product_id, l_suppkey,"
        " l_quantity AS quantity, l_extendedprice AS unit_price, l_discount AS discount_pct,"
        " l_extendedprice AS line_total, " + _DAY.format("l_shipdate", "modified_date") + " FROM (SELECT *, row_number()"
        " OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY CAST(l_shipdate AS DATE) DESC, l_partkey DESC, l_suppkey DESC)"
        " AS rn FROM lineitem) WHERE rn = 1"
    ),
    "scd2_history": _HISTORY,
    "scd2_current": _VERSIONS.format(events="events") + f" SELECT {_EVENT}, __START_AT FROM v WHERE __END_AT IS NULL",
    "scd2_delete": _HISTORY + " WHERE event_type <> 'error'",
    "scd2_track": _tracked("events", "event_type", "event_id, ts, user_id, event_type", ""),
    "scd2_heavy_key": _tracked(
        _HEAVY, "event_type", "event_id, ts, user_id, event_type", " WHERE event_type <> 'error'"
    ),
    "scd2_heavy_text": _tracked(_HEAVY_TEXT, "event_type", "event_id, ts AS moment, user_id, event_type", " WHERE event_type <> 'error'"),
    "header_detail_join": (
        "SELECT l_orderkey AS transaction_id, l_linenumber AS line_item_id, l_partkey AS product_id, l_suppkey,"
        " l_extendedprice AS line_total, o_custkey AS customer_id, o_orderpriority AS payment_type,"
        " o_totalprice AS total_amount FROM lineitem JOIN orders ON o_orderkey = l_orderkey"
        " JOIN customer ON c_custkey = o_custkey"
    ),
    "asof_join": (
        f"WITH {_CUSTOMERS}, x AS (SELECT *, CAST(l_shipdate AS DATE) AS d FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"
        " SELECT l_orderkey AS transaction_id, l_linenumber, l_partkey, CAST(x.d AS VARCHAR) AS ship_date, o_custkey,"
        " coalesce(k, '-1') AS dim_customer_key, coalesce(priority, '-1') AS priority FROM x LEFT JOIN cust"
        " ON customer_id = o_custkey AND x.d >= cust.d AND x.d < coalesce(e, DATE '9999-12-31')"
    ),
    "late_dimension_facts": (
        f"WITH {_CUSTOMERS}, late AS (SELECT DISTINCT o_custkey AS c, CAST(o_orderdate AS DATE) AS day FROM orders"
        " WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')),"
        " x AS (SELECT *, CAST(l_shipdate AS DATE) AS ship FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"
        " SELECT l_orderkey AS transaction_id, l_linenumber, l_partkey, CAST(ship AS VARCHAR) AS ship_date, o_custkey FROM x"
        " JOIN cust ON customer_id = o_custkey AND ship >= d AND ship < coalesce(e, DATE '9999-12-31')"
        " SEMI JOIN late ON c = customer_id AND day = d"
    ),
    "asof_hot_key": (
        "WITH v AS (SELECT o_orderdate AS d, max(o_orderkey) AS o_orderkey FROM orders GROUP BY 1)"
        " SELECT event_id, o_orderkey AS latest_order FROM events ASOF LEFT JOIN v ON ts >= d"
    ),
    "fact_asof_join": _FACTS + " SELECT * FROM f",
    "sales_summary": (
        _FACTS + " SELECT transaction_id, transaction_date, dim_customer_key, dim_location_key, dim_product_key,"
        " payment_type, CAST(sum(CAST(line_total AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,"
        " CAST(sum(CAST(quantity AS DECIMAL(18,2))) AS DOUBLE) AS total_quantity, count(*) AS line_item_count"
        " FROM f GROUP BY 1, 2, 3, 4, 5, 6"
    ),
    "ingest_json_stream": (
        "SELECT o_orderkey AS transaction_id, o_orderpriority AS priority, o_orderstatus AS status,"
        " o_totalprice AS total_amount, CAST(2 AS INTEGER) AS n_items, o_totalprice * 0.5::DOUBLE AS first_total,"
        " true AS complete FROM orders"
    ),
    "ingest_csv_stream": (
        "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,"
        " c_mktsegment FROM customer"
    ),
    "ingest_csv_typed": (
        "SELECT o_orderkey, o_totalprice, " + _DAY.format("o_orderdate", "day") + ", o_orderpriority,"
        " 'date' AS day_type FROM orders"
    ),
    "partition_columns": (
        "SELECT l_orderkey, l_partkey, l_quantity, CAST(year(l_shipdate) AS INTEGER) AS year,"
        " CAST(quarter(l_shipdate) AS INTEGER) AS quarter FROM lineitem"
    ),
    "file_lineage": (
        "SELECT o_orderstatus AS origin, o_orderstatus AS status, count(*) AS n_rows FROM orders GROUP BY o_orderstatus"
    ),
    "schema_evolution": (
        "SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS name,"
        " CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS extra FROM orders"
    ),
    "rescued_data": (
        "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS o_totalprice, o_orderstatus,"
        " CASE WHEN o_orderstatus = 'P' THEN '{\"o_totalprice\":\"n/a ' || o_orderkey || '\"}' END AS rescued FROM orders"
    ),
    "ingest_backlog": "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus, o_orderpriority FROM orders",
    "schema_evolution_types": (
        "SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN floor(o_totalprice) ELSE o_totalprice END AS price,"
        " o_orderpriority AS name, CASE WHEN o_orderstatus = 'O' THEN o_orderstatus END AS status,"
        " CAST(NULL AS VARCHAR) AS rescued FROM orders"
    ),
    "silver_misfits": (
        "SELECT o_orderkey, o_orderstatus = 'P' AS due_is_null,"
        " CASE WHEN o_orderstatus = 'P' THEN 'n/a ' || o_orderkey END AS lost FROM orders"
    ),
    "layers_and_names": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
    "append_only_table": "SELECT * FROM events WHERE event_type = 'purchase'",
    "stream_join_append": (
        f"WITH {_CUSTOMERS}, x AS (SELECT *, CAST(o_orderdate AS DATE) AS d FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"
        " SELECT l_orderkey AS transaction_id, l_linenumber AS line_item_id, l_partkey AS product_id, l_suppkey,"
        " l_extendedprice AS line_total, o_custkey AS customer_id, CAST(x.d AS VARCHAR) AS transaction_date,"
        " coalesce(k, '-1') AS dim_customer_key FROM x LEFT JOIN cust"
        " ON customer_id = o_custkey AND x.d >= cust.d AND x.d < coalesce(e, DATE '9999-12-31')"
    ),
    "incremental_scd1": _latest(f"{_EVENT}, props", " AND event_type <> 'error'"),
    "incremental_scd2": _HISTORY + " WHERE event_type <> 'error'",
    "scd1_out_of_order": _latest(f"{_EVENT}, props"),
    "scd2_out_of_order": _HISTORY,
    "fact_asof_incremental": _FACTS + " SELECT * FROM f",
    "bronze_to_silver": (
        "SELECT event_id, ts, user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id"
        " ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE event_type LIKE '%i%') WHERE rn = 1"
        " AND event_type <> 'error'"
    ),
}

# Other ways to the same results.
ORACLES["asof_ordered"] = ORACLES["asof_join"]
ORACLES["header_detail_stream"] = ORACLES["header_detail_join"].replace(", o_orderpriority AS payment_type", "")
ORACLES["rule_metrics_observed"] = ORACLES["rule_metrics"]
ORACLES["ingest_json_variant"] = ORACLES["ingest_json_stream"]
ORACLES["fact_bucketed"] = ORACLES["fact_asof_join"]
ORACLES["summary_bucketed"] = ORACLES["sales_summary"]
ORACLES["summary_incremental"] = ORACLES["sales_summary"]
ORACLES["named_targets"] = (
    "WITH current AS (" + ORACLES["scd1_delete"] + "), history AS (" + ORACLES["incremental_scd2"] + ")"
    " SELECT h.user_id, count(*) AS versions, max(c.event_id) AS current_event FROM history h LEFT JOIN current c ON c.user_id = h.user_id GROUP BY 1"
)

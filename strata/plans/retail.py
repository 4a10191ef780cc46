"""The retail store: six sources through bronze, silver and gold.

Each flow is a method that processes what is new since it last ran, and returns. :meth:`RetailStore.run` calls them in the
order in which they need each other.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.conf import PipelineConf
from strata.functions import cast_columns, explode_items, flatten_struct, stamp, surrogate_key
from strata.operators.asof import dated_within, versions_begun_by
from strata.operators.quality import get_rules, rules_frame
from strata.plans.facts import Dimension, MaintainedSummary, join_header, recompute_facts
from strata.session import written
from strata.sources import (
    Landing,
    SchemaStore,
    bronze_frame,
    bronze_stream,
    create_layers,
    ingest,
    register_table,
)
from strata.streaming import ChangeSpec, KeyedTarget, cdc_flow, run_available

# The rule catalogue (pipeline, dataset, rule, predicate, tags).
RULES = (
    ("employees-etl", "silver_employees", "valid_id", "employee_id IS NOT NULL", ("validity", "employee")),
    ("employees-etl", "silver_employees", "valid_email", "email LIKE '%@%.%'", ("validity", "employee")),
    ("location-etl", "silver_location", "valid_id", "location_id IS NOT NULL", ("validity", "location")),
    ("departments-etl", "silver_departments", "valid_id", "dept_id IS NOT NULL", ("validity", "departments")),
)

# The columns of a customer that leave bronze.
CUSTOMER_COLUMNS = (
    "customer_id", "first_name", "last_name", "email", "phone_number", "gender", "date_of_birth", "ssn",
    "preferred_contact_method", "status", "created_date", "modified_date",
    "address_line1", "address_line2", "city", "postal_code", "state", "country",
    "file_name", "operation", "operation_date",
)

# The fields of a sale's line.
_LINE_FIELDS = ("line_item_id", "product_id", "quantity", "unit_price", "discount_pct", "line_total")
_LINE_ITEMS = (
    "array<struct<line_item_id:bigint,product_id:string,quantity:bigint,unit_price:double,discount_pct:double,line_total:double>>"
)
_FILE = ("file_modified", "file_name")
_DATES = {"created_date": "date", "modified_date": "date"}
_INTERNAL = ("_rescued_data", "ingestion_ts", "file_modified", "ingest_batch")


@dataclass(frozen=True)
class Dataset:
    """What differs between the sources."""

    name: str
    key: str
    format: str = "csv"
    infer_types: bool = False
    types: Mapping[str, str] = field(default_factory=lambda: _DATES)
    # Output columns, where they are a fixed list; otherwise all columns pass.
    columns: Sequence[str] | None = None
    structs: Sequence[str] = ()
    silver_sequence: str = "modified_date"
    silver_deletes: str | None = None
    except_columns: Sequence[str] = _INTERNAL
    dimension_key: str | None = None
    # Columns that have this type whatever the first files hold.
    hints: Mapping[str, str] = field(default_factory=dict)


DATASETS = {
    d.name: d
    for d in (
        Dataset(
            "customers",
            "customer_id",
            format="json",
            infer_types=True,
            types={**_DATES, "date_of_birth": "date", "operation_date": "date"},
            columns=CUSTOMER_COLUMNS,
            structs=("address",),
            silver_sequence="operation_date",
            silver_deletes="operation = 'DELETE'",
            except_columns=("operation", "operation_date", "file_modified"),
            dimension_key="dim_customer_key",
        ),
        Dataset("departments", "dept_id", dimension_key="dim_department_key"),
        Dataset(
            "employees",
            "employee_id",
            infer_types=True,
            types={
                **_DATES,
                "employee_id": "int",
                "hire_date": "date",
                "termination_date": "date",
                "pay": "double",
            },
            except_columns=(*_INTERNAL, "year", "month", "day"),
            dimension_key="dim_employee_key",
            hints={"pay": "double"},
        ),
        Dataset("location", "location_id", dimension_key="dim_location_key"),
        Dataset("products", "product_id", dimension_key="dim_product_key"),
        Dataset(
            "sales",
            "transaction_id",
            format="json",
            infer_types=True,
            types={**_DATES, "transaction_date": "date"},
            except_columns=(*_INTERNAL, "line_items"),
            hints={"line_items": _LINE_ITEMS, "total_amount": "double"},
        ),
    )
}

# Dimensions of the fact in output order: dataset, whether the unknown member stands in for a missing version.
_FACT_DIMENSIONS = (("employees", True), ("customers", True), ("location", True), ("products", False))


class RetailStore:
    """The flows of one deployment."""

    def __init__(self, spark: SparkSession, conf: PipelineConf, rules: DataFrame | str | None = None):
        """``rules`` is a catalogue, or the name of the table that holds it, which is read whenever a flow runs."""
        self.spark, self.conf = spark, conf
        self.rules = rules if rules is not None else rules_frame(spark, RULES)

    # -- tables -----------------------------------------------------------------------------------------------------

    def schema_store(self, name: str) -> SchemaStore:
        return SchemaStore(self.spark, self.conf.schema_store(name))

    def bronze(self, name: str) -> DataFrame:
        return bronze_frame(self.spark, self._bronze_path(name), self.schema_store(name))

    def silver(self, name: str) -> KeyedTarget:
        if name == "sale_details":
            spec = ChangeSpec(
                ("transaction_id", "line_item_id"),
                "modified_date",
                except_columns=_FILE,
                bucket_keys=("transaction_id",),
            )
        else:
            d = DATASETS[name]
            spec = ChangeSpec(
                (d.key,),
                d.silver_sequence,
                apply_as_deletes=d.silver_deletes,
                except_columns=tuple(d.except_columns),
            )
        return self._target(self.conf.silver_schema, name, spec)

    def dimension(self, name: str) -> KeyedTarget:
        d = DATASETS[name]
        spec = ChangeSpec((d.key,), "modified_date", scd_type=2, except_columns=tuple(d.except_columns))
        return self._target(self.conf.gold_schema, f"dim_{name}", spec)

    @cached_property
    def fact(self) -> KeyedTarget:
        """A recomputed fact has the sequence of the one it replaces, so the time of computing decides."""
        spec = ChangeSpec(
            ("transaction_id", "line_item_id"),
            "modified_date",
            tie_break=("gold_processed_ts",),
            bucket_keys=("transaction_id",),
        )
        return self._target(self.conf.gold_schema, "fact_sale_details", spec)

    @cached_property
    def kept_summary(self) -> MaintainedSummary:
        """The summary follows the fact batch by batch."""
        path = self.conf.table(self.conf.gold_schema, "v_sales_summary")
        return MaintainedSummary(self.spark, path, buckets=self.conf.buckets)

    def summary(self) -> DataFrame:
        """The stored summary."""
        return self.kept_summary.read()

    # -- flows ------------------------------------------------------------------------------------------------------

    def create_layers(self) -> None:
        c = self.conf
        layers = {c.bronze_schema: "rows as they came", c.silver_schema: "current rows", c.gold_schema: "history and facts"}
        create_layers(self.spark, layers, {"env": "dev"})

    def load_bronze(self, name: str) -> None:
        d = DATASETS[name]
        landing = Landing(
            self.conf.landing(name), d.format, d.infer_types, max_files=self.conf.max_files_per_trigger, hints=d.hints
        )
        ingest(self.spark, landing, self._bronze_path(name), self.conf.checkpoint(f"bronze_{name}"), self.schema_store(name))

    def load_silver(self, name: str) -> None:
        d = DATASETS[name]
        shape = lambda df: stamp(_shape(d, df), "processed_ts")
        self._cdc(name, name, self.silver(name), f"silver_{name}", shape)

    def load_sale_details(self) -> None:
        carry = ["transaction_id", "location_id", "created_date", "modified_date", *_FILE]

        def lines(df: DataFrame) -> DataFrame:
            items = explode_items(df, "line_items", carry, _LINE_FIELDS)
            return stamp(cast_columns(items, _DATES), "processed_ts")

        self._cdc("sales", "sale_details", self.silver("sale_details"), "silver_sale_details", lines)

    def load_dimension(self, name: str) -> None:
        """History comes from the change log itself: quality rules and deletes of silver do not touch it."""
        d = DATASETS[name]

        def versions(df: DataFrame) -> DataFrame:
            key = surrogate_key(d.key, "modified_date").alias(d.dimension_key)
            return stamp(_shape(d, df).select(key, "*"), "gold_processed_ts")

        self._cdc(name, None, self.dimension(name), f"gold_dim_{name}", versions)

    def load_facts(self) -> None:
        """Recompute the facts of every transaction that was sent again, from both silver tables as they are now."""
        stream = self._stream("sales")
        run_available(
            stream, lambda batch, n: self._recompute(batch.select("transaction_id"), ("facts", n)), self.conf.checkpoint("gold_facts")
        )

    def refresh_facts(self, name: str) -> None:
        """Recompute the facts dated in an interval whose valid version has changed since the last refresh.

        Call it after :meth:`load_dimension`. While there are no facts there is nothing to do: :meth:`load_facts` uses the
        dimensions as they are.
        """
        d, history = DATASETS[name], self.dimension(name)

        def handle(batch: DataFrame, n: int) -> None:
            if not (self.fact.has_rows() and history.has_rows()):
                return
            kind = history.table.schema()[d.key].dataType
            events = _shape(d, batch).select(F.col(d.key).try_cast(kind).alias(d.key), "modified_date").distinct()
            buckets = [r[0] for r in events.select(history.bucket()).distinct().collect()]
            changed = written(versions_begun_by(history.read(buckets), events, [d.key], "modified_date"), "changed-versions")
            self._recompute(dated_within(self._dated(d.key, changed), changed, [d.key], "transaction_date"), (name, n))

        run_available(self._stream(name), handle, self.conf.checkpoint(f"gold_refresh_{name}"))

    def _dated(self, key: str, members: DataFrame) -> DataFrame:
        """``transaction_id``, member key and ``transaction_date`` of the sales or lines that refer to one of the members."""
        sales = self.silver("sales").read()
        holder = sales if key in sales.columns else self.silver("sale_details").read()
        wanted = members.select(F.col(key).try_cast(holder.schema[key].dataType).alias(key)).distinct()
        rows = holder.join(wanted, key, "left_semi")
        if holder is sales:
            return rows.select("transaction_id", key, "transaction_date")
        return join_header(rows.select("transaction_id", key), sales, ["transaction_id"], ["transaction_date"])

    def load_summary(self) -> None:
        """Name the summary in the catalog. Its rows follow the fact with every batch."""
        if self.kept_summary.table.schema() is not None:
            self.kept_summary.declare(f"{self.conf.gold_schema}.v_sales_summary", "Sales per transaction", {"quality": "gold"})

    def run(self, refresh: bool = True) -> None:
        """All flows once. With ``refresh``, facts follow dimension rows that came after them."""
        self.create_layers()
        for name in DATASETS:
            self.load_bronze(name)
            self.load_silver(name)
        self.load_sale_details()
        dimensions = [d.name for d in DATASETS.values() if d.dimension_key]
        for name in dimensions:
            self.load_dimension(name)
        if refresh:
            for name, _ in _FACT_DIMENSIONS:
                self.refresh_facts(name)
        self.load_facts()
        self.load_summary()

    def register(self) -> None:
        """Name all tables in the catalog, and views ``<layer>_<table>`` of this session on those of silver and gold."""
        c = self.conf
        for name in DATASETS:
            rows = self.bronze(name)
            schema = rows.drop("ingest_batch").schema.add("ingest_batch", "integer")
            register_table(
                self.spark,
                f"{c.bronze_schema}.{name}",
                schema,
                self._bronze_path(name),
                f"{name} as they landed",
                partitioned_by=["ingest_batch"],
            )
            self._name(self.silver(name), c.silver_schema, name, f"current {name}", "silver")
            if DATASETS[name].dimension_key:
                self._name(self.dimension(name), c.gold_schema, f"dim_{name}", f"history of {name}", "gold")
        self._name(self.silver("sale_details"), c.silver_schema, "sale_details", "current lines of sales", "silver")
        self._name(self.fact, c.gold_schema, "fact_sale_details", "lines of sales with the valid dimension versions", "gold")

    # -- inside -----------------------------------------------------------------------------------------------------

    def _bronze_path(self, name: str) -> str:
        return self.conf.table(self.conf.bronze_schema, name)

    def _target(self, layer: str, name: str, spec: ChangeSpec) -> KeyedTarget:
        return KeyedTarget(self.spark, self.conf.table(layer, name), replace(spec, buckets=self.conf.buckets))

    def _name(self, target: KeyedTarget, schema: str, name: str, comment: str, quality: str) -> None:
        target.declare(f"{schema}.{name}", comment, {"quality": quality})
        target.register(f"{schema}_{name}")

    def _stream(self, name: str) -> DataFrame:
        return bronze_stream(self.spark, self._bronze_path(name), self.schema_store(name))

    def _cdc(
        self,
        source: str,
        dataset: str | None,
        target: KeyedTarget,
        flow: str,
        transform: Callable[[DataFrame], DataFrame],
    ) -> None:
        """``dataset`` names the silver table whose rules apply; None applies no rules."""
        pipeline = "sales-etl" if source == "sales" else f"{source}-etl"
        catalogue = self.spark.read.table(self.rules) if isinstance(self.rules, str) else self.rules
        rules = get_rules(catalogue, pipeline, f"silver_{dataset}") if dataset else {}
        aside = self.conf.table("quarantine", flow)
        cdc_flow(self._stream(source), target, self.conf.checkpoint(flow), transform, rules, aside, DATASETS[source].types)

    def _recompute(self, transactions: DataFrame, batch: tuple[str, int]) -> None:
        sides = self.silver("sale_details"), self.silver("sales")
        recompute_facts(transactions, *sides, self._dimensions(), self.fact, self.kept_summary, batch)

    def _dimensions(self) -> list[Dimension]:
        out = []
        for name, has_unknown in _FACT_DIMENSIONS:
            d = DATASETS[name]
            keys, columns = {d.key: d.key}, {d.dimension_key: d.dimension_key}
            history = self.dimension(name).read()
            out.append(Dimension(history, keys, columns) if has_unknown else Dimension(history, keys, columns, None))
        return out


def _shape(d: Dataset, df: DataFrame) -> DataFrame:
    flat = cast_columns(flatten_struct(df, *d.structs), d.types)
    # The file's time decides between events of one day; it does not leave the table.
    return flat.select(*d.columns, "file_modified") if d.columns else flat

import pytest
from pyspark.sql import functions as F

from strata.functions import surrogate_key
from strata.functions.keys import packed, unpacked
from strata.operators import scd2
from strata.operators.skew import SLICE, in_ranges
from strata.plans import Dimension, recompute_facts, sales_facts, sales_summary
from strata.streaming import ChangeSpec, KeyedTarget
from strata.streaming.buckets import rounds


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_packed_text_comes_back(spark):
    texts = ["ab12", "AB12", "", "abc", "x", "0", None, "é", "a" * 64]
    out = spark.createDataFrame([(t,) for t in texts], "t string").select("t", packed(F.col("t")).alias("p"))
    got = out.select("t", unpacked(F.col("p")).alias("u"), F.octet_length("p").alias("n")).collect()
    assert all(r.t == r.u for r in got) and got[-1].n == 33


@pytest.fixture
def sale(spark):
    """Two lines of one sale, whose header came twice, with two times; one line of a sale without a time."""
    lines = spark.sql(
        "SELECT * FROM VALUES (1L, 1, 7L, 2D, 3D, 0D, 6D, DATE'2024-01-05'), (1L, 2, 8L, 2D, 3D, 0D, 6D, DATE'2024-01-05'),"
        " (2L, 1, 7L, 2D, 3D, 0D, 6D, NULL)"
        " t(transaction_id, line_item_id, product_id, quantity, unit_price, discount_pct, line_total, modified_date)"
    )
    heads = spark.sql(
        "SELECT *, 5D AS total_amount, 'cash' AS payment_type, transaction_date AS created_date, transaction_date AS modified_date"
        " FROM VALUES (1L, 1L, 1L, 1L, DATE'2024-01-10'), (1L, 1L, 1L, 1L, DATE'2024-01-10'), (1L, 1L, 1L, 1L, DATE'2024-03-10'),"
        " (2L, 1L, 1L, 1L, CAST(NULL AS DATE)) t(transaction_id, employee_id, customer_id, location_id, transaction_date)"
    )
    return lines, heads


def history(spark, key, start, value):
    return spark.sql(f"SELECT {key} AS id, '{value}' AS name, DATE'{start}' AS __START_AT, CAST(NULL AS DATE) AS __END_AT")


def test_repeated_headers_times_and_missing_versions(spark, sale):
    of = lambda key, start, value, unknown, **how: Dimension(history(spark, 1 if key != "product_id" else 7, start, value), {key: "id"}, {"name": f"dim_{key}"}, unknown, **how)
    dims = [of("customer_id", "2024-02-01", "ab", "-1"), of("location_id", "2024-01-01", "Text", "-1", small=True), of("product_id", "2024-02-01", "cd", None)]
    out = sales_facts(*sale, dims).select("transaction_id", "line_item_id", F.col("transaction_date").cast("string").alias("d"), "dim_customer_id", "dim_location_id", "dim_product_id")
    january, march = ("2024-01-10", "-1", "Text", None), ("2024-03-10", "ab", "Text")
    want = [(1, n, *january) for n in (1, 2) for _ in range(2)] + [(1, 1, *march, "cd"), (1, 2, *march, None), (2, 1, None, "-1", "-1", None)]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)


def test_made_keys_take_part_in_no_shuffle_and_are_the_same(spark, sale, rows):
    kinds = {"customer_id": "INT", "product_id": "BIGINT"}  # the first is of another type than the fact's, so it travels

    def dims(how):
        for key, name, start, value, unknown in (("customer_id", "c", "2024-02-01", 1, "-1"), ("product_id", "p", "2024-01-06", 7, None)):
            versions = spark.sql(f"SELECT CAST({value} AS {kinds[key]}) AS id, DATE'{start}' AS __START_AT, CAST(NULL AS DATE) AS __END_AT")
            versions = versions.withColumn(name, surrogate_key("id", "__START_AT"))
            yield Dimension(versions, {key: "id"}, {name: f"dim_{name}"}, unknown, **how(name))

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = sales_facts(*sale, [*dims(lambda _: {})]).drop("gold_processed_ts")
        made = sales_facts(*sale, [*dims(lambda name: {"made": {name: ("id", "__START_AT")}})]).drop("gold_processed_ts")
        assert made.schema == plain.schema and rows(made) == rows(plain)
        assert {r.dim_p is None for r in made.collect()} == {True, False} and {r.dim_c == "-1" for r in made.collect()} == {True, False}
        below = lambda df: df._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning", 1)[1]
        for name in ("__out_dim_c", "__out_dim_p"):
            assert name in below(plain) and name not in below(made)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_facts_are_worked_out_in_rounds_of_buckets(spark, sale, rows, tmp_path, monkeypatch):
    monkeypatch.setattr("strata.plans.facts.TRANSACTIONS_AT_ONCE", 1)
    monkeypatch.setattr("strata.streaming.target.ROWS_AT_ONCE", 1)
    assert rounds({3: 2, 1: 5, 2: 1, 0: 2}, 4) == [[0], [1], [2, 3]] and rounds({}, 4) == []
    lines, heads = sale
    more = heads.where("transaction_id = 2").selectExpr("transaction_id + 1 AS transaction_id", "* EXCEPT (transaction_id)")
    heads = heads.where("transaction_id = 1 AND transaction_date < DATE'2024-02-01'").dropDuplicates().unionByName(more)
    lines = lines.withColumn("modified_date", F.lit("2024-01-05").cast("date"))
    lines = lines.unionByName(lines.where("transaction_id = 2").withColumn("transaction_id", F.lit(3).cast("bigint")))
    heads = heads.withColumn("modified_date", F.lit("2024-01-05").cast("date"))
    spec = ChangeSpec(("transaction_id", "line_item_id"), "modified_date", tie_break=(), bucket_keys=("transaction_id",), buckets=4)
    stored, facts = KeyedTarget(spark, str(tmp_path / "lines"), spec), KeyedTarget(spark, str(tmp_path / "facts"), spec)
    stored.upsert(lines)
    dims = [Dimension(history(spark, 7, "2024-01-01", "ab"), {"product_id": "id"}, {"name": "k"}, None)]
    replaced, replace = [], facts.table.replace
    monkeypatch.setattr(facts.table, "replace", lambda df: (replaced.append(df), replace(df)))
    buckets = lines.select(stored.bucket()).distinct().count()
    for _ in range(2):
        recompute_facts(lines, stored, heads, dims, facts)
        assert rows(facts.read().drop("gold_processed_ts")) == rows(sales_facts(lines, heads, dims).drop("gold_processed_ts"))
    assert buckets > 1 and len(replaced) == 2 * lines.join(heads, "transaction_id").select(stored.bucket()).distinct().count()
    recompute_facts(lines.limit(0), stored, heads, dims, facts)


def test_summary_of_facts_needs_no_shuffle_and_lines_carry_no_texts(spark, sale):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        facts = sales_facts(*sale, [Dimension(history(spark, 7, "2024-01-01", "ab"), {"product_id": "id"}, {"name": "k"}, None)])
        assert exchanges(sales_summary(facts, ["transaction_id", "k"])) == exchanges(facts.select("transaction_id", "k", "line_total", "quantity"))
        for part in facts._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning")[:-1]:
            assert "sha2" not in part.split("SortMergeJoin")[-1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_more_slices_than_tasks_are_cut_within_tasks(spark):
    events = spark.range(400).selectExpr("1 AS k", "id AS s", "id % 3 AS v")
    cut = in_ranges(events, ["k", "s"], 80, 5)
    assert len(cut.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    sizes = cut.groupBy(SLICE).agg(F.count("*").alias("n"), F.min("s").alias("a"), F.max("s").alias("b")).orderBy(SLICE).collect()
    assert max(r.n for r in sizes) <= 5 and all(x.b < y.a for x, y in zip(sizes, sizes[1:]))
    both = [scd2(events, ["k"], "s", [], rows_per_slice=n).collect() for n in (5, None)]
    assert sorted(both[0]) == sorted(both[1])


def test_target_folds_with_one_shuffle(spark, tmp_path):
    target = KeyedTarget(spark, str(tmp_path / "t"), ChangeSpec(("k",), "s", buckets=2))
    rows = spark.sql("SELECT id AS k, 1 AS s, sha2(CAST(id AS STRING), 256) AS t FROM range(20)")
    target.upsert(rows)
    assert exchanges(target._folded(target.table.read().unionByName(rows))) == 1
    target.upsert(rows.where("k < 5").selectExpr("k", "2 AS s", "'new' AS t"))
    assert sorted(r.k for r in target.read().where("t = 'new'").collect()) == [0, 1, 2, 3, 4] and target.read().count() == 20

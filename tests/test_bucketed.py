import os
import re
import time

import pytest
from pyspark.sql import functions as F

from strata.operators import scd1
from strata.plans import sales_summary, sales_summary_bucketed
from strata.session import written
from strata.sources import join_bucketed, open_bucketed, store_bucketed


@pytest.fixture
def store(spark, tmp_path):
    spark.sql("CREATE SCHEMA IF NOT EXISTS bucketed_test")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")

    def put(df, name, keys, rows_per_key=1000, buckets=4):
        return store_bucketed(df, f"bucketed_test.{name}", str(tmp_path / name), keys, buckets, rows_per_key)

    yield put
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"\bExchange\b", plan))


def lines(spark, n=40):
    return spark.range(n).selectExpr("id % 10 AS t", "CAST(id DIV 10 AS INT) AS line", "id AS amount")


def test_join_and_fold_need_no_shuffle(spark, store, rows):
    heads = spark.range(3, 13).selectExpr("id AS t", "concat('h', id) AS name", "'unused' AS other")
    left, right = store(lines(spark), "lines", ["t"]), store(heads, "heads", ["t"])
    folded = left.per_key(lambda df: scd1(df.withColumn("line", F.lit(0)), ["t", "line"], "amount", []))
    out = join_bucketed(folded, right, ["name"])
    assert shuffles(out) == 0
    assert rows(out) == sorted([(30 + t, 0, f"h{t}", t) for t in range(3, 10)], key=repr)
    assert out.columns == ["t", "line", "amount", "name"]


def test_shuffle_files_go_when_a_frame_is_stored(spark, store):
    def files():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for n in found.mkString("\n").split() if "/shuffle_" in n}

    def left(before, seconds=20):
        until = time.time() + seconds
        while files() - before and time.time() < until:
            time.sleep(0.1)
        return files() - before

    before = files()
    kept = lines(spark).repartition(3, "line")
    kept.collect()
    assert files() - before  # those of other jobs stay for the garbage collector
    before = files()
    store(lines(spark), "lines_alone", ["t"])
    assert written(lines(spark).repartition(3, "line"), "alone").count() == 40
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10000)
    stored = {n for n in left(before) if n.endswith(".data")}
    # Only the counts that look for heavy keys and the count above are left.
    assert sum(os.path.getsize(n) for n in stored if os.path.exists(n)) < 400
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_heavy_and_null_keys_are_kept_apart_and_nothing_is_lost(spark, store, rows):
    log = lines(spark).unionByName(spark.range(30).selectExpr("7 AS t", "CAST(id + 100 AS INT) AS line", "id AS amount"))
    log = log.unionByName(spark.range(25).selectExpr("CAST(NULL AS BIGINT) AS t", "CAST(id AS INT) AS line", "id AS amount"))
    heads = spark.range(10).selectExpr("id AS t", "concat('h', id) AS name")
    heads = heads.unionByName(spark.range(22).selectExpr("2 AS t", "concat('x', id) AS name"))
    left, right = store(log, "log", ["t"], rows_per_key=20), store(heads, "names", ["t"], rows_per_key=20)
    assert {r.t for r in left.heavy.select("t").distinct().collect()} == {None, 7}
    assert {r.t for r in right.heavy.select("t").distinct().collect()} == {2}
    assert rows(left.rows()) == rows(log)
    assert rows(join_bucketed(left, right, ["name"])) == rows(log.join(heads, ["t"]))


def test_table_is_found_by_name_and_replaced_whole(spark, store, tmp_path, rows):
    first = store(lines(spark), "again", ["t"], rows_per_key=2)
    assert first.heavy is not None
    other = spark.range(5).selectExpr("id AS label", "id AS t")
    store_bucketed(other, "bucketed_test.again", str(tmp_path / "other"), ["label"], 2)
    found = open_bucketed(spark, "bucketed_test.again")
    assert found.keys == ("label",) and found.heavy is None
    assert rows(found.rows()) == rows(other)
    assert first.rows().count() == 40


def test_summary_within_buckets(spark, store, rows):
    facts = lines(spark, 60).selectExpr("t", "line % 2 AS kind", "amount AS line_total", "1 AS quantity")
    whole = sales_summary(facts, ["t", "kind"])
    for limit in (1000, 3):
        out = sales_summary_bucketed(store(facts, f"facts_{limit}", ["t"], limit), ["t", "kind"])
        assert rows(out) == rows(whole)
        assert limit == 3 or shuffles(out) == 0
    with pytest.raises(ValueError, match="several buckets"):
        sales_summary_bucketed(open_bucketed(spark, "bucketed_test.facts_1000"), ["kind"])


def test_empty_table_other_keys_and_tables_without_buckets(spark, store):
    empty = store(lines(spark).limit(0), "empty", ["t"])
    assert join_bucketed(empty, empty.per_key(lambda df: df.withColumnRenamed("amount", "more")), ["more"]).count() == 0
    with pytest.raises(ValueError, match="different keys"):
        join_bucketed(empty, store(lines(spark), "by_line", ["line"]), ["amount"])
    lines(spark).createOrReplaceTempView("plain_lines")
    with pytest.raises(ValueError, match="no buckets"):
        open_bucketed(spark, "plain_lines")

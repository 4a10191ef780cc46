import bisect
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import asof_left_join, asof_ordered, dated_within, scd2, versions_begun_by

DAY0 = dt.date(2020, 1, 1)


def make(spark, seed, versions=60, facts=300):
    rng = random.Random(seed)
    day = lambda n: DAY0 + dt.timedelta(n)
    dim, lookup = [], {}
    for k in ["hot", "b", "c"]:
        starts = sorted(rng.sample(range(400), versions if k == "hot" else 3))
        lookup[k] = starts
        for i, s in enumerate(starts):
            dim.append((k, f"{k}{i}", day(s), day(starts[i + 1]) if i + 1 < len(starts) else None))
    rows, want = [], []
    for i in range(facts):
        k, n = rng.choice(["hot", "hot", "b", "c", "none", None]), rng.randrange(-20, 450)
        rows.append((i, k, day(n)))
        at = bisect.bisect_right(lookup.get(k, []), n) - 1
        want.append((i, f"{k}{at}" if at >= 0 else None))
    dims = spark.createDataFrame(dim, "id string, ver string, __START_AT date, __END_AT date")
    return spark.createDataFrame(rows, "i int, k string, d date"), dims, want


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
@pytest.mark.parametrize("per_key", [None, 1, 7, 1000])
def test_asof_finds_the_valid_version(spark, per_key, threshold):
    facts, dim, want = make(spark, 7)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        out = asof_left_join(facts, dim, {"k": "id"}, "d", {"ver": "v"}, versions_per_key=per_key)
        got = sorted((r.i, r.v) for r in out.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == want


@pytest.mark.parametrize("fact_type", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("dim_type", ["date", "timestamp_ntz"])
def test_asof_with_mixed_time_types(spark, fact_type, dim_type):
    facts, dim, want = make(spark, 8)
    facts = facts.withColumn("d", F.col("d").cast(fact_type))
    dim = dim.withColumns({c: F.col(c).cast(dim_type) for c in ("__START_AT", "__END_AT")})
    out = asof_left_join(facts, dim, {"k": "id"}, "d", ["ver"], versions_per_key=5)
    assert sorted((r.i, r.ver) for r in out.collect()) == want
    assert out.schema["d"].dataType.simpleString() == fact_type


def test_boundaries_unknown_and_far_future(spark):
    dim = spark.createDataFrame(
        [("a", "1", dt.date(2020, 1, 1), dt.date(2020, 2, 1)), ("a", "2", dt.date(2020, 2, 1), None)],
        "k string, v string, __START_AT date, __END_AT date",
    )
    days = ["2019-12-31", "2020-01-01", "2020-01-31", "2020-02-01", "9999-12-30", "9999-12-31"]
    facts = spark.createDataFrame([("a", dt.date.fromisoformat(d)) for d in days], "k string, d date")
    out = asof_left_join(facts, dim, ["k"], "d", ["v"], unknown="-1").orderBy("d")
    assert [r.v for r in out.collect()] == ["-1", "1", "1", "2", "2", "-1"]


def test_numeric_time_and_cardinality(spark):
    dim = spark.range(100).selectExpr("id % 2 AS k", "id AS __START_AT", "id + 2 AS __END_AT", "id AS v")
    facts = spark.range(0, 150).selectExpr("id AS f", "id % 2 AS k", "id AS at")
    out = asof_left_join(facts, dim, ["k"], "at", ["v"], versions_per_key=5)
    assert out.count() == 150
    assert out.where("f < 100 AND NOT (v <=> f) OR f >= 100 AND v IS NOT NULL").count() == 0


def test_hot_fact_key_is_split_when_the_dimension_is_too_large_to_broadcast(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(60_000).selectExpr("id AS f", "if(id % 3 = 0, 0, id) AS k", "id AS at")
        dim = spark.range(60_000).selectExpr("id AS k", "0L AS __START_AT", "CAST(NULL AS BIGINT) AS __END_AT", "id AS v")
        out = asof_left_join(facts, dim, ["k"], "at", ["v"], versions_per_key=None)
        query = out.agg(F.count("*"), F.sum(F.expr("int(v = k)")))
        assert tuple(query.collect()[0]) == (60_000, 60_000)
        assert "skew=true" in query._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_text_keys_meet_number_keys(spark):
    dim = spark.createDataFrame([("7", 1), ("x", 1)], "k string, __START_AT int").selectExpr(
        "k", "__START_AT", "CAST(NULL AS INT) AS __END_AT", "k AS v"
    )
    facts = spark.createDataFrame([(7, 5), (8, 5)], "k int, at int")
    assert [r.v for r in asof_left_join(facts, dim, ["k"], "at", ["v"]).orderBy("k").collect()] == ["7", None]
    back = asof_left_join(dim.withColumn("at", F.lit(2)), facts.selectExpr("k", "1 AS __START_AT", "NULL AS __END_AT", "k AS w"), ["k"], "at", ["w"])
    assert sorted(r.w or 0 for r in back.collect()) == [0, 7]


@pytest.mark.parametrize("ranges", [None, 1, 2, 5, 16])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ordered_pass_finds_the_valid_version(spark, seed, ranges):
    facts, dim, want = make(spark, seed)
    out = asof_ordered(facts, dim, {"k": "id"}, "d", {"ver": "v"}, ranges=ranges)
    assert sorted((r.i, r.v) for r in out.collect()) == want
    assert out.columns == ["i", "k", "d", "v"]


@pytest.mark.parametrize("versions_per_key", [None, 2])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_versions_begun_by_late_events_hold_all_facts_that_change(spark, seed, versions_per_key):
    rng = random.Random(seed)
    events = [(rng.choice([*"abc", None]), rng.choice([None, *range(30)]), i, rng.random() < 0.4) for i in range(40)]
    log = spark.createDataFrame(events, "k string, t int, v int, late boolean")
    facts = spark.createDataFrame([(i, rng.choice([*"abcd", None]), rng.choice([None, *range(-2, 33)])) for i in range(200)], "i int, k string, at int")
    ordered = log.where("t IS NOT NULL")
    history = scd2(ordered, ["k"], "t", ["v"])
    begins = lambda h: {r.i: r.b for r in asof_left_join(facts, h, ["k"], "at", {"__START_AT": "b"}).collect()}
    before, after = begins(scd2(ordered.where("NOT late"), ["k"], "t", ["v"])), begins(history)
    late = log.where("late")
    got = [r.i for r in dated_within(facts, versions_begun_by(history, late, ["k"], "t"), ["k"], "at", versions_per_key=versions_per_key).collect()]
    moments = {(r.k, r.t) for r in late.collect()}
    want = {i for i, k, _ in facts.collect() if after[i] is not None and (k, after[i]) in moments}
    assert len(got) == len(set(got)) and set(got) == want
    assert {i for i in after if before[i] != after[i]} <= want


def test_ordered_pass_drops_versions_that_have_ended(spark):
    """A gap between versions, a NULL time, a NULL start, and a range that begins in the gap."""
    dim = spark.createDataFrame([("a", 10, 20, "1"), ("a", 30, None, "2"), ("a", None, None, "x"), ("b", 5, 6, "3")], "k string, __START_AT int, __END_AT int, v string")
    facts = spark.createDataFrame([(k, t) for k in "ab" for t in (None, 4, 5, 6, 10, 19, 20, 25, 29, 30, 99)], "k string, at int")
    want = asof_left_join(facts, dim, ["k"], "at", ["v"], unknown="-").collect()
    for ranges in (None, 3, 40):
        got = asof_ordered(facts, dim, ["k"], "at", ["v"], unknown="-", ranges=ranges).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, want), key=repr)


def test_ordered_pass_is_one_exchange_even_for_very_many_versions(spark):
    dim = spark.range(100_000).selectExpr("0 AS k", "id AS __START_AT", "id + 1 AS __END_AT", "id AS v")
    facts = spark.range(50_000).selectExpr("id AS f", "0 AS k", "id * 2 AS at")
    out = asof_ordered(facts, dim, ["k"], "at", ["v"])
    assert out.where("v <> at OR v IS NULL").count() == 0 and out.count() == 50_000
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    spread = asof_ordered(facts, dim, ["k"], "at", ["v"], ranges=8)
    assert spread.where("v <> at OR v IS NULL").count() == 0 and spread.count() == 50_000

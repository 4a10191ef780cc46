import random

import pytest
from pyspark.sql import functions as F

from strata.operators import current_versions, scd1, scd2, split_unsequenced

SCHEMA = "k string, seq int, op string, a int, src string"


def events(n, seed, keys=5, span=40):
    rng = random.Random(seed)
    key = lambda: None if rng.random() < 0.1 else f"k{rng.choice([0, 0, 0, *range(keys)])}"
    return [
        (key(), rng.randrange(span), rng.choice(["PUT", "PUT", "PUT", "DELETE"]), rng.randrange(3), f"f{i:04d}")
        for i in range(n)
    ]


def history(rows, track=False, deletes=True):
    """The definition, written for one key at a time."""
    out = []
    by_key = {}
    for r in rows:
        by_key.setdefault(r[0], []).append(r)
    for group in by_key.values():
        last = {}
        for r in sorted(group, key=lambda r: (r[1], r[4])):
            last[r[1]] = r
        line = [last[s] for s in sorted(last)]
        if track:
            gone = lambda r: deletes and r[2] == "DELETE"
            line = [r for i, r in enumerate(line) if i == 0 or (r[3], gone(r)) != (line[i - 1][3], gone(line[i - 1]))]
        for i, r in enumerate(line):
            if not (deletes and r[2] == "DELETE"):
                out.append((*r, r[1], line[i + 1][1] if i + 1 < len(line) else None))
    return sorted(out, key=repr)


def as_tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("rows_per_slice", [None, 3, 20])
@pytest.mark.parametrize("track", [False, True])
@pytest.mark.parametrize("deletes", [False, True])
def test_scd2_equals_definition(spark, rows_per_slice, track, deletes):
    data = events(300, seed=1)
    out = scd2(
        spark.createDataFrame(data, SCHEMA).repartition(5),
        ["k"],
        "seq",
        tie_break=["src"],
        apply_as_deletes="op = 'DELETE'" if deletes else None,
        track_columns=["a"] if track else None,
        rows_per_slice=rows_per_slice,
    )
    assert as_tuples(out) == history(data, track, deletes)


@pytest.mark.parametrize("as_type", ["date", "timestamp", "timestamp_ntz", "double", "string"])
def test_slices_follow_every_sequence_type(spark, as_type):
    df = spark.createDataFrame(events(200, seed=2), SCHEMA)
    day = F.date_add(F.lit("1969-12-20").cast("date"), F.col("seq"))
    seq = {"date": day, "double": F.col("seq") / 7 - 2, "string": F.format_string("%05d", "seq")}.get(
        as_type, (day.cast("timestamp") + F.expr("make_dt_interval(0, seq, seq)")).cast(as_type)
    )
    df = df.withColumn("seq", seq)
    whole = scd2(df, ["k"], "seq", ["src"], rows_per_slice=None)
    assert as_tuples(scd2(df, ["k"], "seq", ["src"], rows_per_slice=4)) == as_tuples(whole)


def test_scd1_equals_definition_in_any_arrival_order(spark):
    data = events(200, seed=3)
    want = {}
    for r in data:
        if r[0] not in want or (r[1], r[4]) > (want[r[0]][1], want[r[0]][4]):
            want[r[0]] = r
    want = sorted(((r[0], r[1], r[3], r[4]) for r in want.values() if r[2] != "DELETE"), key=repr)
    for seed in range(3):
        shuffled = random.Random(seed).sample(data, len(data))
        df = spark.createDataFrame(shuffled, SCHEMA).repartition(4)
        got = scd1(df, ["k"], "seq", ["src"], "op = 'DELETE'", except_columns=["op", "absent"])
        assert as_tuples(got) == want


def test_equal_events_without_tie_break_are_decided_by_content(spark):
    data = [("k", 1, "PUT", i, None) for i in range(20)]
    picks = set()
    for seed in range(4):
        shuffled = random.Random(seed).sample(data, len(data))
        df = spark.createDataFrame(shuffled, SCHEMA)
        picks.add(scd1(df, ["k"], "seq").first().a)
        picks.add(scd2(df, ["k"], "seq").first().a)
    assert len(picks) == 1


def test_late_column_does_not_change_the_pick(spark):
    data = [("k", 1, "PUT", i, None) for i in range(20)]
    df = spark.createDataFrame(data, SCHEMA)
    wider = df.select(F.lit(None).cast("int").alias("b_new"), *reversed(df.columns))
    assert scd1(df, ["k"], "seq").first().a == scd1(wider, ["k"], "seq").first().a


def test_sequence_expression_and_null_sequence(spark):
    df = spark.createDataFrame([("a", 1, "PUT", 1, "x"), ("a", None, "PUT", 2, "y")], SCHEMA)
    good, bad = split_unsequenced(df, "seq")
    assert (good.count(), bad.first().quarantine_reason) == (1, "sequence is NULL")
    assert scd1(df, ["k"], -F.col("seq")).first().a == 1
    assert scd2(df, ["k"], F.col("seq") + 0).count() == 1


def test_composite_keys_and_current(spark):
    df = spark.createDataFrame(
        [("a", 1, "PUT", 1, "x"), ("a", 2, "PUT", 2, "x"), ("a", 2, "PUT", 3, "y")], SCHEMA
    )
    assert as_tuples(scd1(df, ["k", "src"], "seq").select("a")) == [(2,), (3,)]
    assert as_tuples(current_versions(scd2(df, ["k"], "seq", ["src"])).select("a")) == [(3,)]


def test_intervals_are_disjoint_and_at_most_one_is_open(spark):
    out = scd2(spark.createDataFrame(events(300, 5), SCHEMA), ["k"], "seq", ["src"], rows_per_slice=10)
    out.createOrReplaceTempView("h")
    open_versions = spark.sql("SELECT k FROM h WHERE __END_AT IS NULL GROUP BY k HAVING count(*) > 1")
    gaps = spark.sql(
        "SELECT * FROM (SELECT __END_AT, lead(__START_AT) OVER (PARTITION BY k ORDER BY __START_AT) nxt FROM h)"
        " WHERE NOT (__END_AT <=> nxt)"
    )
    assert open_versions.count() == 0 and gaps.count() == 0


def test_heavy_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("if(id % 3 = 0, 0, id) AS k", "id AS seq", "id AS a")
    plan = scd1(df, ["k"], "seq")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")


@pytest.mark.parametrize("shape", ["even", "sentinel", "burst"])
def test_no_slice_is_much_larger_than_asked(spark, shape):
    from strata.operators.skew import KEY, SLICE, heavy_keys, in_ranges, rows_of

    when = {"even": "id", "sentinel": "if(id = 0, 253402214400, id)", "burst": "if(id % 10 = 0, id * 100000, id)"}[shape]
    rows = spark.range(50_000).selectExpr("1 AS k", f"timestamp_seconds({when}) AS at").unionByName(spark.range(5).selectExpr("2 AS k", "timestamp_seconds(id) AS at"))
    heavy = heavy_keys(rows, ["k"], "at", 1_000)
    assert [(r[0].k, r[1]) for r in heavy.collect()] == [(1, 50_000)]
    sizes = [r["count"] for r in in_ranges(rows_of(rows, heavy, ["k"]), [KEY, "at"], 50).groupBy(SLICE).count().collect()]
    assert sum(sizes) == 50_000 and max(sizes) <= 2_000 and len(sizes) == 50


def test_ranges_of_a_heavy_key_are_even(spark):
    """A text sequence, one sentinel date with a tenth of the rows, and a burst: no range has more than twice the mean."""
    from strata.operators.skew import SLICE, in_ranges

    rows = spark.range(40_000).selectExpr(
        "'hot' AS k", "CASE WHEN id % 10 = 0 THEN concat('9999-12-31 ', id) WHEN id % 3 = 0 THEN concat('2024-05-05 ', id) ELSE concat('20', id) END AS seq"
    )
    sizes = [r["count"] for r in in_ranges(rows, ["k", "seq"], 10).groupBy(SLICE).count().collect()]
    assert len(sizes) == 10 and sum(sizes) == 40_000 and max(sizes) <= 2 * 4_000


@pytest.mark.parametrize("track", [None, ["a"]])
def test_heavy_key_with_a_text_sequence(spark, track):
    data = [(k, f"s{n:03d}", op, a, src) for k, n, op, a, src in events(300, seed=5) if n is not None]
    rows = spark.createDataFrame(data, "k string, seq string, op string, a int, src string")
    whole = scd2(rows, ["k"], "seq", ["src"], "op = 'DELETE'", track_columns=track, rows_per_slice=None)
    cut = scd2(rows, ["k"], "seq", ["src"], "op = 'DELETE'", track_columns=track, rows_per_slice=9)
    assert as_tuples(cut) == as_tuples(whole)
